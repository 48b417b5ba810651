"""Classification, requirement extraction, scoring and quality gates over whole tables.

The given texts carry no job vocabulary, so these queries pass their own small vocabularies; the operators are the same.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom import fixed_values as fx
from jobloom.functions import text as tx
from jobloom.operators import classify as cl, quality as qa, requirements as rq, scoring as sc
from jobloom.plans.publication import staging_header, write_packed, write_snapshot, write_staging
from jobloom.plans.registry import ADS, HISTORY, TODAY, ads, ads_history, pick, query, sql_ascii, sql_caseless, sql_resume, sql_search, today
from jobloom.session import ensure_checkpoint_dir, materialize, table

# ---------------------------------------------------------------- classification

AREAS = {
    "Romance": (r"\bque\b", r"\bdes\b", "mente", r"\belle\b"), "Germanic": (r"\bder\b", "schen", r"\bund\b", "einan"),
    "English": (r"\bthe\b", "tion", r"\bthat\b", "ing ?the"), "Iberian": (r"\bpara\b", "ado", r"\blos\b"),
}
LEVEL_WORDS = (("Low", r"\bthe\b|\bder\b"), ("Mid", r"\band\b|\bque\b"), ("High", r"\bof\b|\bund\b"))


def _sql_area() -> str:
    parts = []
    for rank, (name, patterns) in enumerate(AREAS.items()):
        points = " + ".join(f"(CASE WHEN regexp_matches(t, '{p}') THEN 3 ELSE 0 END) + (CASE WHEN regexp_matches(d, '{p}') THEN 1 ELSE 0 END)" for p in patterns)
        parts.append(f"SELECT doc_id, category, '{name}' AS name, {rank} AS rank, {points} AS points FROM x")
    return " UNION ALL ".join(parts)


@query("cls_01_seniority", f"""WITH x AS (SELECT doc_id, ' ' || {sql_ascii("text")} || ' ' AS t, CASE doc_id % 5 WHEN 0 THEN 'Sênior' WHEN 1 THEN '' ELSE source END AS level FROM documents)
SELECT doc_id, CASE WHEN level = 'Sênior' THEN 'Sênior/Especialista' WHEN level = 'src3' THEN 'Liderança' WHEN regexp_matches(t, '\\bof\\b|\\bund\\b') THEN 'High'
  WHEN regexp_matches(t, '\\band\\b|\\bque\\b') THEN 'Mid' WHEN regexp_matches(t, '\\bthe\\b|\\bder\\b') THEN 'Low' ELSE 'Não informado' END AS seniority FROM x""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(
        "doc_id", tx.fold_ascii(F.col("text")).alias("t"), F.array(F.lit("?"), pick(F.col("doc_id"), "Sênior", "", *[F.col("source")] * 3)).alias("levels")
    )
    mapped = {**fx.STRUCTURED_LEVELS, "src3": "Liderança"}
    return rows.select("doc_id", cl.seniority(F.col("t"), F.col("levels"), LEVEL_WORDS, mapped).alias("seniority"))


@query("cls_02_area_scoring", f"""WITH x AS (SELECT doc_id, ' ' || {sql_ascii("text")} || ' ' AS t, substr({sql_ascii("text")}, 1, 600) AS d, CASE WHEN doc_id % 9 = 0 THEN 'fixed' ELSE '' END AS category FROM documents),
s AS ({_sql_area()}), b AS (SELECT doc_id, category, arg_max(name, points * 10 - rank) AS name, max(points) AS points FROM s GROUP BY ALL)
SELECT doc_id, CASE WHEN category = 'fixed' THEN 'Given' WHEN points >= 3 THEN name ELSE 'Outros' END AS area FROM b""")
def _(spark, folder):
    rows = table(spark, folder, "documents").select(
        "doc_id", tx.fold_ascii(F.col("text")).alias("t"), cl.folded_lead(F.col("text")).alias("d"),
        F.array(F.lit("other"), F.when(F.col("doc_id") % 9 == 0, " Fixed ").otherwise("")).alias("categories"),
    )
    return rows.select("doc_id", cl.area(F.col("t"), F.col("d"), F.col("categories"), AREAS, {"fixed": "Given"}).alias("area"))


#: Titles for the shipped areas: one area, several, none, words inside words.
_TITLES = (
    "Analista de Dados", "Desenvolvedor Java", "Customer Success", "Product Owner", "UX Designer", "Gerente de Marketing e Vendas", "SDR", "Analista de suporte SQL", "Recrutamento e seleção",
    "Contador", "Advogado", "Engenheiro civil", "Comprador", "Médico", "Data Engineer / DevOps", "Piloto", "Business Analyst", "Social media e CRM", "Help desk", "Front end React", "Vendedor", "Naval",
)


def _sql_shipped() -> str:
    quoted = lambda p: p.replace("'", "''")
    parts = []
    for rank, (name, patterns) in enumerate(fx.AREA_PATTERNS.items()):
        points = " + ".join(f"(CASE WHEN regexp_matches(t, '{quoted(p)}') THEN 3 ELSE 0 END) + (CASE WHEN regexp_matches(d, '{quoted(p)}') THEN 1 ELSE 0 END)" for p in patterns)
        parts.append(f"SELECT doc_id, '{quoted(name)}' AS name, {rank} AS rank, {points} AS points FROM x")
    return " UNION ALL ".join(parts)


_TITLE_SQL = f"list_extract({list(_TITLES)}, CAST(doc_id % {len(_TITLES)} AS INTEGER) + 1)"


@query("cls_02_shipped_areas", f"""WITH x AS (SELECT doc_id, ' ' || {sql_ascii(_TITLE_SQL)} || ' ' AS t, substr({sql_ascii(f"list_extract({list(_TITLES)}, CAST(doc_id % 5 AS INTEGER) + 1) || ' ' || text")}, 1, 600) AS d FROM documents),
s AS ({_sql_shipped()}), b AS (SELECT doc_id, arg_max(name, points * 100 - rank) AS name, max(points) AS points FROM s GROUP BY ALL)
SELECT doc_id, CASE WHEN points >= 3 THEN name ELSE 'Outros' END AS area FROM b""")
def _(spark, folder):
    rows = table(spark, folder, "documents").select(
        "doc_id", pick(F.col("doc_id"), *_TITLES).alias("title"), F.concat_ws(" ", pick(F.col("doc_id"), *_TITLES[:5]), "text").alias("description")
    )
    rows = rows.select("doc_id", tx.fold_ascii("title").alias("t"), cl.folded_lead(F.col("description")).alias("d"))
    return rows.select("doc_id", cl.area(F.col("t"), F.col("d"), F.array().cast("array<string>")).alias("area"))


_RULES = (("Articles", r"\b(der|die|das|les|los)\b"), ("Links", r"\b(and|und|que)\b"), ("Pronouns", r"\b(elle|that|this)\b"))
_SQUEEZED = f"' ' || regexp_replace({sql_search('text')}, '[^a-z0-9]+', ' ', 'g') || ' '"


def _sql_rules(rules, other: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{label}'" for label, p in rules) + f" ELSE '{other}' END"


@query("cls_03_rule_list", f"WITH x AS (SELECT doc_id, {_SQUEEZED} AS t FROM documents) SELECT doc_id, {_sql_rules(_RULES, 'Outros')} AS category FROM x")
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", cl.staging_category(F.col("text"), _RULES).alias("category"))


@query("cls_04_staging_seniority", f"WITH x AS (SELECT doc_id, {_SQUEEZED} AS t FROM documents) SELECT doc_id, {_sql_rules(tuple(reversed(_RULES)), 'Não informado')} AS seniority FROM x")
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", cl.staging_seniority(F.col("text"), tuple(reversed(_RULES))).alias("seniority"))


@query("cls_05_language_level", f"""WITH x AS (SELECT doc_id, {sql_search('text')} AS t FROM documents)
SELECT doc_id, CASE WHEN NOT regexp_matches(t, '\\b(the|der|les)\\b') THEN 'Não identificado' WHEN regexp_matches(t, '\\b(the|der|les)\\b.{{0,45}}\\b(of|und)\\b') THEN 'A'
  WHEN regexp_matches(t, '\\b(the|der|les)\\b.{{0,60}}\\b(and|von)\\b') THEN 'B' ELSE 'Mencionado' END AS level FROM x""")
def _(spark, folder):
    levels = (("A", 45, "of|und"), ("B", 60, "and|von"))
    return table(spark, folder, "documents").select("doc_id", cl.language_level(F.col("text"), r"\b(the|der|les)\b", levels).alias("level"))


_MODAL = {"cues": "the|der|les|los", "rules": (("Híbrido", "of|und"), ("Presencial", "and|que"), ("Remoto", "to|von"))}
_MODAL_SQL = "CASE " + " ".join(f"WHEN regexp_matches({{0}}, '\\b(the|der|les|los)\\b.{{{{0,55}}}}\\b({w})\\b') THEN '{label}'" for label, w in _MODAL["rules"]) + " ELSE '' END"


@query("cls_06_stated_modality", f"""WITH x AS (SELECT doc_id, substr({sql_search('text')}, 1, 12000) AS t, {sql_search("text")} AS w FROM documents)
SELECT doc_id, {_MODAL_SQL.format('t')} AS modality, CASE WHEN regexp_matches(w, '\\b(the|that)\\b') THEN 'Remoto' WHEN regexp_matches(w, '\\b(der|die)\\b') THEN 'Presencial' ELSE 'Não informada' END AS workplace FROM x""")
def _(spark, folder):
    rules = (("Remoto", r"\b(the|that)\b"), ("Presencial", r"\b(der|die)\b"))
    return table(spark, folder, "documents").select(
        "doc_id", cl.stated_modality(F.col("text"), **_MODAL, chars=fx.MODALITY_TEXT_CHARS).alias("modality"), cl.staging_workplace(F.col("text"), rules).alias("workplace")
    )


@query("cls_07_contradiction_alerts", f"""WITH x AS (SELECT doc_id, {_MODAL_SQL.format(sql_search("'modalidade ' || text"))} AS tm, {_MODAL_SQL.format(sql_search('text'))} AS dm,
  CASE doc_id % 3 WHEN 0 THEN 'Remoto' WHEN 1 THEN 'Híbrido' ELSE 'Não informada' END AS w, CASE doc_id % 2 WHEN 0 THEN 'Brasil' ELSE 'Recife' END AS place FROM documents)
SELECT doc_id, concat_ws('|', CASE WHEN w = 'Não informada' THEN 'A modalidade não foi informada pela plataforma' END,
  CASE WHEN tm <> '' AND w <> 'Não informada' AND tm <> w THEN 'O título indica ' || lower(tm) || ', mas a plataforma classifica como ' || lower(w) END,
  CASE WHEN dm <> '' AND w <> 'Não informada' AND dm <> w THEN 'A descrição pode indicar modalidade ' || lower(dm) END,
  CASE WHEN w = 'Remoto' AND place = 'Recife' THEN 'Confirme a elegibilidade para: Recife' END,
  CASE WHEN doc_id % 5 = 0 THEN 'Os detalhes não foram recuperados nesta atualização' END) AS alerts FROM x""")
def _(spark, folder):
    i = F.col("doc_id")
    alerts = cl.contradiction_alerts(
        F.col("text"), pick(i, "Brasil", "Recife"), F.col("text"), pick(i, "Remoto", "Híbrido", "Não informada"), i % 5 != 0, title_chars=None, **_MODAL
    )
    return table(spark, folder, "documents").select(i, F.array_join(alerts, "|").alias("alerts"))


@query("cls_08_market_of_place", """SELECT page_id, CASE WHEN contains(lower(url), 'blog') OR contains(lower(url), '/es/') THEN 'BR' ELSE url END AS country,
  CASE WHEN contains(lower(url), 'blog') OR contains(lower(url), '/es/') THEN 'BR' WHEN contains(lower(url), '.net') THEN 'Global remote' ELSE 'Global' END AS market FROM pages""")
def _(spark, folder):
    reach = cl.market_of_place(F.col("url"), ("blog", "/es/"), (".net",))
    return table(spark, folder, "pages").select("page_id", F.inline(F.array(reach)))


@query("cls_09_multiplicity", """WITH x AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN ['Brasil'] WHEN 1 THEN ['Brazil', p_name] WHEN 2 THEN [p_name, p_type] ELSE ['Multiple Locations'] END AS l FROM part)
SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN 'on-site' ELSE 'remote' END AS work_model, CASE p_partkey % 4 WHEN 1 THEN l[2] ELSE 'Brasil' END AS place FROM x""")
def _(spark, folder):
    k = F.col("p_partkey")
    places = pick(k, F.array(F.lit("Brasil")), F.array(F.lit("Brazil"), "p_name"), F.array("p_name", "p_type"), F.array(F.lit("Multiple Locations")))
    rows = table(spark, folder, "part").select(k, places.alias("l"))
    model = cl.multiplicity_work_model(F.col("l"))
    return rows.select(k, model.alias("work_model"), cl.multiplicity_place(F.col("l"), model).alias("place"))


# ---------------------------------------------------------------- requirements

CUES = rq.Cues(
    mandatory=("on the", "de la", "und der"), preferred=("in the", "que la", "die der"), stop=("to the", "and the", "les de"),
    mandatory_cues=("that ", "elle "), preferred_cues=("with ", "para "),
)
ENTRIES = (
    rq.Entry("the", "The", ("the",), "skill"), rq.Entry("tion", "Tion", ("tion the", "mente"), "skill"), rq.Entry("der", "Der", ("der", "dié"), "skill"),
    rq.Entry("que", "Que", ("que", "QUE "), "language"), rq.Entry("ing", "Inging", ("inging",), "skill"), rq.Entry("by", "By", ("by", "von"), "education"),
    rq.Entry("rare", "Rare", ("los el",), "skill"), rq.Entry("man", "Manual", ("which", "eanan"), "manual"),
)
VOCABULARY = rq.Vocabulary(ENTRIES, CUES)
_JOBS_SQL = f"SELECT doc_id, {sql_caseless('text')} AS t FROM documents"


def _jobs(spark, folder) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", F.concat(F.lit("https://jobs.example.com/"), F.col("doc_id").cast("string")).alias("url"), F.col("text").alias("description"),
        F.when(F.col("doc_id") % 4 == 0, F.array(F.lit("Inging"), F.lit("los el"))).otherwise(F.array().cast("array<string>")).alias("skills"),
    )


def _least(words, fn) -> str:
    return "least(" + ", ".join(fn(w) for w in words) + ")"


_AT = lambda w: f"CASE WHEN instr(t, '{w}') > 0 THEN instr(t, '{w}') - 1 END"


@query("fit_01_section_split", f"""WITH x AS ({_JOBS_SQL}), m AS (SELECT doc_id, t, {_least(CUES.mandatory, _AT)} AS ms, {_least(CUES.preferred, _AT)} AS ps FROM x),
e AS (SELECT *, ms + (CASE {" ".join(f"WHEN substr(t, ms + 1, {len(w)}) = '{w}' THEN {len(w)}" for w in CUES.mandatory)} END) AS me, ps + (CASE {" ".join(f"WHEN substr(t, ps + 1, {len(w)}) = '{w}' THEN {len(w)}" for w in CUES.preferred)} END) AS pe FROM m),
s AS (SELECT *, {", ".join(f"{_AT(w)} AS s{i}" for i, w in enumerate(CUES.stop))} FROM e)
SELECT doc_id, me AS mandatory_start, CASE WHEN me IS NOT NULL THEN coalesce(least({", ".join(f"CASE WHEN s{i} > me THEN s{i} END" for i in range(3))}, CASE WHEN ps > me THEN ps END), length(t)) END AS mandatory_end,
  pe AS preferred_start, CASE WHEN pe IS NOT NULL THEN coalesce(least({", ".join(f"CASE WHEN s{i} > pe THEN s{i} END" for i in range(3))}), length(t)) END AS preferred_end FROM s""")
def _(spark, folder):
    folded = table(spark, folder, "documents").select("doc_id", tx.fold_caseless("text").alias("t"))
    located = folded.select("doc_id", F.length("t").alias("n"), VOCABULARY.hits(F.col("t")).alias("h"))
    located = located.select("doc_id", rq.sections(F.col("h"), F.col("n"), VOCABULARY).alias("s"))
    return located.select("doc_id", *[F.col(f"s.{c}") for c in ("mandatory_start", "mandatory_end", "preferred_start", "preferred_end")])


#: Aliases whose every mention is asked for its kind; longer than four letters, so they count as plain substrings.
MENTIONED = rq.Vocabulary([rq.Entry("a", "A", ("inging", "los el", "tion the"), "skill"), rq.Entry("b", "B", ("mente", "schen"), "skill")], CUES)
_MENTIONS = ("inging", "los el", "tion the", "mente", "schen")


def _rfind(words) -> str:
    one = lambda w: f"CASE WHEN instr(r, '{w[::-1]}') > 0 THEN length(w) - instr(r, '{w[::-1]}') + 1 - {len(w)} ELSE -1 END"
    return "greatest(" + ", ".join(one(w) for w in words) + ")"


@query("fit_02_context_kind", f"""WITH x AS (SELECT doc_id, {sql_caseless('text')} AS t FROM documents), a AS (SELECT unnest({list(_MENTIONS)}) AS alias),
g AS (SELECT doc_id, alias, t, string_split(t, alias) AS parts FROM x, a WHERE contains(t, alias)),
o AS (SELECT doc_id, alias, substr(t, 1, CAST(list_sum([length(q) FOR q IN list_slice(parts, 1, i)]) + (i - 1) * length(alias) AS BIGINT)) AS before FROM (SELECT *, unnest(range(1, len(parts))) AS i FROM g)),
y AS (SELECT doc_id, alias, length(before) AS start, right(before, 520) AS w, reverse(right(before, 520)) AS r FROM o),
z AS (SELECT *, {_rfind(CUES.preferred)} AS p, {_rfind(CUES.mandatory)} AS m, {_rfind(CUES.preferred_cues)} AS pc, {_rfind(CUES.mandatory_cues)} AS mc FROM y)
SELECT doc_id, alias, start, CASE WHEN p > m THEN 'preferred' WHEN m >= 0 THEN 'mandatory' WHEN pc > mc THEN 'preferred' WHEN mc >= 0 THEN 'mandatory' ELSE 'context' END AS kind FROM z""")
def _(spark, folder):
    located = table(spark, folder, "documents").select("doc_id", tx.fold_caseless("text").alias("t"))
    located = located.select("doc_id", MENTIONED.hits(F.col("t")).alias("h"))
    found = located.select("doc_id", F.explode(rq.mention_kinds(F.col("h"), MENTIONED)).alias("k"))
    alias = F.element_at(F.lit(list(_MENTIONS)), F.col("k.phrase") + 1)
    return found.select("doc_id", alias.alias("alias"), F.col("k.start").cast("long").alias("start"), "k.kind")


@query("fit_03_entry_kinds")
def _(spark, folder):
    ranked = rq.with_entry_ranks(rq.with_hits(_jobs(spark, folder), VOCABULARY), VOCABULARY)
    return ranked.select("doc_id", F.explode("_ranked").alias("e")).select("doc_id", "e.entry", "e.rank")


#: Words that introduce fragments in the given texts.
UNKNOWN_CUE = r"(?iu)(?:the|der|les|los)\s+(?:of|and|de|und|die|for)\s+([^.;:\n]{2,170})"


@query("fit_04_unknown_requirements")
def _(spark, folder):
    located = rq.with_hits(_jobs(spark, folder), VOCABULARY, UNKNOWN_CUE)
    found = located.select("doc_id", rq.unknown_requirements(F.col("_cues"), rq.covered_fragments(VOCABULARY)).alias("u"))
    return found.select("doc_id", F.inline("u"))


@query("fit_05_group_reconciliation", """SELECT p_partkey, p_name || '|PL/SQL' AS mandatory, p_type || '|X' AS preferred, p_brand AS context FROM part""")
def _(spark, folder):
    empty = F.array().cast("array<string>")
    groups = rq.reconcile(
        F.array(F.col("p_name"), F.lit("SQL"), F.lit("PL/SQL")), F.array(F.upper("p_name"), F.col("p_type"), F.lit("X")),
        F.array(F.lower("p_type"), F.col("p_brand"), F.lit("pl/sql")), empty, F.lit(False),
    )
    return table(spark, folder, "part").select("p_partkey", *[F.array_join(groups[g], "|").alias(g) for g in ("mandatory", "preferred", "context")])


@query("fit_06_confidence", """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' AND l_linenumber >= 3 THEN 95 WHEN l_returnflag = 'R' AND l_linenumber + l_partkey % 3 >= 2 THEN 85
  WHEN l_linestatus = 'O' AND l_linenumber + l_partkey % 3 >= 2 THEN 75 WHEN l_linenumber + l_partkey % 3 >= 3 THEN 65 WHEN l_linenumber + l_partkey % 3 > 0 THEN 45 ELSE 20 END AS confidence FROM lineitem""")
def _(spark, folder):
    mined = (F.col("l_partkey") % 3).cast("int")
    value = rq.confidence(F.col("l_returnflag") == "R", F.col("l_linestatus") == "O", F.col("l_linenumber"), mined, F.lit(0))
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", value.alias("confidence"))


@query("fit_07_decode_and_fallback", """SELECT 'c' || c_custkey AS url, n.n_name AS mandatory, m.n_name || '|' || n.n_name AS context, c_custkey % 100 AS confidence, true AS scoreable
FROM customer JOIN nation n ON n.n_nationkey = c_nationkey JOIN nation m ON m.n_nationkey = c_custkey % 25
UNION ALL SELECT 'p' || p_partkey, '', p_name || '|' || p_type, 0, false FROM part""")
def _(spark, folder):
    terms = table(spark, folder, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    none = F.array().cast("array<int>")
    k = F.col("c_custkey")
    packed = table(spark, folder, "customer").select(
        F.concat(F.lit("c"), k.cast("string")).alias("url"), F.array("c_nationkey", F.lit(999)).alias("m"), none.alias("p"),
        F.array((k % 25).cast("int"), "c_nationkey").alias("c"), none.alias("x"), (k % 100).cast("int").alias("q"),
    )
    decoded = rq.unpacked(packed, terms)
    summary = table(spark, folder, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("url"), F.concat_ws("; ", "p_name", "p_type", "p_name").alias("skills"))
    both = decoded.unionByName(rq.fallback(summary))
    return both.select("url", F.array_join("mandatory", "|").alias("mandatory"), F.array_join("context", "|").alias("context"), "confidence", "scoreable")


@query("snk_02_requirement_index")
def _(spark, folder):
    # the index feeds the term table and the packed rows
    index = materialize(rq.build_index(_jobs(spark, folder), VOCABULARY, "doc_id"))
    terms = rq.index_terms(index)
    packed = rq.packed(index, terms)
    return packed.select("url", *[F.array_join(F.transform(c, lambda v: v.cast("string")), ",").alias(c) for c in "mpcx"], "q")


# ---------------------------------------------------------------- résumés

RESUME_ENTRIES = (
    rq.Entry("english-basic", "One", ("the ",), "language"), rq.Entry("english-fluent", "Two", ("entre", "that"), "language"),
    rq.Entry("x", "Three", ("der", "los"), "skill"), rq.Entry("y", "Four", ("que", "inging"), "skill"), rq.Entry("z", "Five", ("mente", "erer"), "skill"),
    rq.Entry("w", "Six", ("by", "von"), "skill"),
)
RESUME_VOCABULARY = rq.Vocabulary(RESUME_ENTRIES, CUES)
_WHOLE = lambda w: f"regexp_matches(t, '(^|[^a-z0-9]){w}($|[^a-z0-9])')"
_COVER = {
    "one": f"({_WHOLE('the')} OR {_WHOLE('one')} OR {_WHOLE('two')} OR contains(t, 'entre') OR {_WHOLE('that')})",
    "two": f"({_WHOLE('two')} OR contains(t, 'entre') OR {_WHOLE('that')})",
    "three": f"(contains(t, 'three') OR {_WHOLE('der')} OR {_WHOLE('los')})",
    "four": f"({_WHOLE('four')} OR {_WHOLE('que')} OR contains(t, 'inging'))",
    "five": f"({_WHOLE('five')} OR contains(t, 'mente') OR {_WHOLE('erer')})",
    "six": f"({_WHOLE('six')} OR {_WHOLE('by')} OR {_WHOLE('von')})",
}
#: A résumé is the user's turns; a term counts when one turn carries it, so no text is gathered per person.
_RESUMES_SQL = "turns AS (SELECT conv_id, " + sql_resume("text") + " AS t FROM conversations WHERE role = 'user'), resumes AS (SELECT conv_id, sum(length(t)) AS n, " + ", ".join(
    f"bool_or({test}) AS {label}" for label, test in _COVER.items()) + " FROM turns GROUP BY 1)"


def _resumes(spark, folder) -> DataFrame:
    turns = table(spark, folder, "conversations").filter("role = 'user'").select("conv_id", tx.fold_resume("text").alias("t"))
    labelled = turns.select("conv_id", F.length("t").alias("n"), sc.covered_labels(F.col("t"), RESUME_VOCABULARY).alias("labels"))
    # at most one entry per label and person, combined map-side
    return labelled.groupBy(F.col("conv_id").alias("resume_id")).agg(
        F.sum("n").alias("length"),
        F.array_compact(F.array(*[F.max(F.when(F.array_contains("labels", label), label)) for label in _COVER])).alias("terms"),
    )


@query("fit_08_requirement_match", f"""WITH {_RESUMES_SQL} SELECT conv_id AS resume_id, concat_ws('|', {", ".join(f"CASE WHEN {label} THEN '{label}' END" for label in _COVER)}) AS terms FROM resumes""")
def _(spark, folder):
    return _resumes(spark, folder).select("resume_id", F.array_join("terms", "|").alias("terms"))


@query("fit_08_phrase_match", "WITH labels AS (SELECT DISTINCT lower(p_name) AS label FROM part UNION SELECT 'that of the' UNION SELECT 'entre del que' UNION SELECT 'des verlich'), turns AS (SELECT conv_id, turn, "
       + sql_resume("text") + """ AS t FROM conversations WHERE role = 'user'),
w AS (SELECT label, [x FOR x IN string_split(label, ' ') IF length(x) > 1 AND x NOT IN ('of', 'the', 'que', 'del_')] AS tokens FROM labels),
m AS (SELECT conv_id, turn, label, contains(t, label) AS whole, len(tokens) AS n,
  len([x FOR x IN tokens IF CASE WHEN length(x) <= 4 THEN regexp_matches(t, '(^|[^a-z0-9])' || x || '($|[^a-z0-9])') ELSE contains(t, x) END]) AS k FROM turns, w)
SELECT conv_id || '/' || turn AS resume_id, label FROM m WHERE whole OR (n > 0 AND k * 1.0 / n >= 0.72)""")
def _(spark, folder):
    labels = table(spark, folder, "part").select(F.lower("p_name").alias("label"))
    extra = table(spark, folder, "part").select(F.explode(F.lit(["that of the", "entre del que", "des verlich"])).alias("label"))
    turns = table(spark, folder, "conversations").filter("role = 'user'").select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("resume_id"), tx.fold_resume("text").alias("t")
    )
    return sc.phrase_coverage(turns, labels.unionByName(extra).distinct(), "resume_id", "t")


#: What a document asks for: mandatory, preferred and context labels by presence, confidence by size.
_ASKS_SQL = f"""d AS (SELECT doc_id, source, {sql_caseless('text')} AS t, text AS title FROM documents),
asks AS (SELECT doc_id, title, [x FOR x IN [CASE WHEN contains(t, 'tion') THEN 'one' END, CASE WHEN contains(t, 'entre') THEN 'two' END, CASE WHEN contains(t, 'schen') THEN 'three' END, CASE WHEN contains(t, 'ing the') THEN 'four' END] IF x IS NOT NULL] AS m,
  [x FOR x IN [CASE WHEN contains(t, 'ado') THEN 'five' END, CASE WHEN contains(t, 'eau') THEN 'six' END] IF x IS NOT NULL] AS p,
  [x FOR x IN [CASE WHEN doc_id % 2 = 0 THEN 'three' END] IF x IS NOT NULL] AS c, CASE doc_id % 3 WHEN 0 THEN 95 WHEN 1 THEN 45 ELSE 20 END AS q FROM d)"""
_PERSON_TERMS = "[x FOR x IN [" + ", ".join(f"CASE WHEN {label} THEN '{label}' END" for label in _COVER) + "] IF x IS NOT NULL]"
_PAIR_SQL = f"""people AS (SELECT conv_id, n, {_PERSON_TERMS} AS terms FROM resumes),
pair AS (SELECT conv_id, n, doc_id, title, q, len(m) AS ma, len(p) AS pa, len(c) AS ca, len(list_intersect(m, terms)) AS mh, len(list_intersect(p, terms)) AS ph, len(list_intersect(c, terms)) AS ch FROM people, asks {{where}}),
raw AS (SELECT *, (CASE WHEN ma > 0 THEN mh * 80.0::DOUBLE / ma ELSE 0 END + CASE WHEN pa > 0 THEN ph * 15.0::DOUBLE / pa ELSE 0 END + CASE WHEN ca > 0 THEN ch * 5.0::DOUBLE / ca ELSE 0 END)
  * coalesce(100.0::DOUBLE / nullif(CASE WHEN ma > 0 THEN 80 ELSE 0 END + CASE WHEN pa > 0 THEN 15 ELSE 0 END + CASE WHEN ca > 0 THEN 5 ELSE 0 END, 0), 1) AS s0, CASE WHEN ma > 0 THEN mh * 1.0::DOUBLE / ma END AS r FROM pair),
capped AS (SELECT *, CASE WHEN ma >= 4 AND r < 0.5 THEN least(s0, 55) WHEN ma - mh >= 2 AND r < 0.75 THEN least(s0, 69) WHEN ma - mh >= 1 AND ma <= 3 THEN least(s0, 79) ELSE s0 END AS s1 FROM raw),
scored AS (SELECT *, CAST(greatest(0, least(100, floor(round(CASE WHEN ma = 0 AND q < 60 THEN least(s1, 75) ELSE s1 END, 9) + 0.5))) AS INTEGER) AS score,
  CAST(floor(q * (CASE WHEN n >= 900 THEN 100 WHEN n >= 450 THEN 80 WHEN n >= 220 THEN 55 ELSE 30 END) / 100.0 + 0.5) AS INTEGER) AS coverage FROM capped)"""


def _asks(spark, folder) -> DataFrame:
    t = F.col("t")
    when = lambda words: F.array_compact(F.array(*[F.when(test, label) for test, label in words]))
    rows = table(spark, folder, "documents").select("doc_id", tx.fold_caseless("text").alias("t"), F.col("text").alias("title"))
    return rows.select(
        F.col("doc_id").alias("url"), "title",
        when([(t.contains("tion"), "one"), (t.contains("entre"), "two"), (t.contains("schen"), "three"), (t.contains("ing the"), "four")]).alias("m"),
        when([(t.contains("ado"), "five"), (t.contains("eau"), "six")]).alias("p"), when([(F.col("doc_id") % 2 == 0, "three")]).alias("c"),
        pick(F.col("doc_id"), 95, 45, 20).alias("q"),
    )


@query("fit_09_score", f"""WITH {_RESUMES_SQL}, {_ASKS_SQL}, {_PAIR_SQL.replace('{where}', 'WHERE conv_id = doc_id % (SELECT max(conv_id) + 1 FROM conversations)')}
SELECT conv_id AS resume_id, doc_id AS url, score, coverage, ma - mh AS gaps, CASE WHEN score >= 85 THEN 'Aderência muito forte' WHEN score >= 70 THEN 'Aderência forte' WHEN score >= 55 THEN 'Aderência parcial' ELSE 'Aderência baixa' END AS label FROM scored""")
def _(spark, folder):
    # every document meets one person: its number modulo the number of people
    people = table(spark, folder, "conversations").agg((F.max("conv_id") + 1).alias("_people"))
    asks = _asks(spark, folder).withColumnsRenamed({"m": "mandatory", "p": "preferred", "c": "context", "q": "confidence"})
    asks = asks.join(F.broadcast(people)).withColumn("_person", F.col("url") % F.col("_people"))  # one row
    pairs = _resumes(spark, folder).join(asks, F.col("resume_id") == F.col("_person"))
    pairs = pairs.withColumns({"manual": F.array().cast("array<string>"), "scoreable": F.lit(True)})
    out = sc.evaluate(pairs, "terms", "length", ["resume_id", "url"])
    return out.select("resume_id", "url", "score", "coverage", F.size("gaps").alias("gaps"), "label")


def _rank_sql(k: int) -> str:
    return f"""WITH {_RESUMES_SQL}, {_ASKS_SQL}, {_PAIR_SQL.replace('{where}', '')}
SELECT conv_id AS resume_id, doc_id AS url, score, coverage, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, coverage DESC, {sql_search('title')}, title, doc_id) AS place FROM scored QUALIFY place <= {k}"""


@query("fit_10_rank", _rank_sql(30))
def _(spark, folder):
    return sc.rank(_resumes(spark, folder), _asks(spark, folder), 30).select("resume_id", "url", "score", "coverage", "place")


@query("jon_10_scoring_join", _rank_sql(3))
def _(spark, folder):
    return sc.rank(_resumes(spark, folder), _asks(spark, folder), 3).select("resume_id", "url", "score", "coverage", "place")


@query("srt_03_top_jobs", f"SELECT resume_id, string_agg(place || ':' || url || ':' || score || ':' || coverage, ' ' ORDER BY place) AS listed FROM ({_rank_sql(5)}) GROUP BY 1")
def _(spark, folder):
    best = sc.rank(_resumes(spark, folder), _asks(spark, folder), 5)
    entry = F.struct("place", F.concat_ws(":", *[F.col(c).cast("string") for c in ("place", "url", "score", "coverage")]).alias("text"))
    # five entries per résumé
    listed = F.array_sort(F.collect_list(entry))
    return best.groupBy("resume_id").agg(F.array_join(F.transform(listed, lambda e: e["text"]), " ").alias("listed"))


_SKILLS = {"One": ("the", "one"), "Two": ("two", "entre", "that"), "Three": ("three", "der", "los"), "Four": ("four", "que", "inging"), "Five": ("five", "mente", "erer"), "Six": ("six", "by", "von")}


@query("fit_11_recognized_skills", "WITH d AS (SELECT conv_id, turn, " + sql_resume("text") + " AS t FROM conversations) SELECT conv_id, turn, concat_ws('|', "
       + ", ".join("CASE WHEN " + " OR ".join(_WHOLE(w) if len(w) <= 4 else f"contains(t, '{w}')" for w in words) + f" THEN '{label}' END" for label, words in _SKILLS.items()) + ") AS skills FROM d")
def _(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", tx.fold_resume("text").alias("t"))
    return turns.select("conv_id", "turn", F.array_join(sc.recognized_skills(F.col("t"), RESUME_VOCABULARY), "|").alias("skills"))


# ---------------------------------------------------------------- quality gates


def _audit_folder(spark) -> str:
    """A new folder next to the checkpoints; each run writes and audits a version of its own there."""
    return f"{ensure_checkpoint_dir(spark)}/audit-{uuid.uuid4().hex}"


def _rules_sql(rules: dict[str, str], rows: str) -> str:
    """``rule, violations`` from one aggregate per rule."""
    return " UNION ALL ".join(f"SELECT '{rule}' AS rule, CAST({value} AS BIGINT) AS violations" + ("" if value.isdigit() else f" FROM {rows}") for rule, value in rules.items())


#: The whole history as a snapshot of 5,000 rows at least, with a private column.
_SNAPSHOT_RULES = {
    "minimum_rows": "greatest(5000 - count(*), 0)", "https_link": "count(*) FILTER (WHERE NOT starts_with(regexp_replace(url, 'http://', 'https://'), 'https://'))",
    "older_than_cutoff": f"count(*) FILTER (WHERE pub < '2024-02-29' AND NOT (source = 'gupy' AND expires_date >= '{TODAY}'))",
    "autozone_abroad": "count(*) FILTER (WHERE source = 'autozone' AND country <> 'BR')", "script_in_title": "count(*) FILTER (WHERE contains(lower(title), '<script'))",
    "code_range": "0", "jobs_missing_columns": "0", "jobs_private_columns": "1", "jobs_too_large": "CASE WHEN sum(strlen(title)) > 18 * 1048576 THEN 1 ELSE 0 END",
    "header_private_columns": "0", "header_cutoff": "0", "header_count": "0", "missing_dictionaries": "0",
}


@query("val_01_snapshot_rules", f"WITH {HISTORY}, r AS (SELECT *, coalesce(nullif(published_date, ''), first_seen_date) AS pub FROM hist) {_rules_sql(_SNAPSHOT_RULES, 'r')}")
def _(spark, folder):
    from jobloom.operators import snapshot as sn

    stored = materialize(ads_history(spark, folder).withColumn("position", F.col("doc_id")))
    rows = sn.public_columns(stored, (F.lit("x@example.com").alias("email"),)).withColumn("np", F.lit(1)).drop("dedupe_key")
    shot = sn.Snapshot(rows, sn.first_appearance_codes(stored, sn.DICTIONARIES, "position"))
    return write_snapshot(spark, _audit_folder(spark), shot, stored, today(), minimum=5000).report()


_WORDS = "CASE WHEN trim({0}, ' \n\t') = '' THEN 0 ELSE len(regexp_split_to_array(trim({0}, ' \n\t'), '\\s+')) END"
_META = "length({0}) > {1} OR contains(lower({0}), 'description') OR " + _WORDS.format("{0}") + " > 28"
_INDEX_RULES = {
    "term_too_long": "count(*) FILTER (WHERE length(text) > 80)",
    "term_personal_data": "count(*) FILTER (WHERE regexp_matches(text, '(?i)\\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{2,}\\b') OR regexp_matches(text, '(?:\\+?\\d[\\s().-]*){9,}'))",
    "term_many_words": f"count(*) FILTER (WHERE {_WORDS.format('text')} > 12)",
    "entry_link": "count(*) FILTER (WHERE NOT starts_with(url, 'https://'))", "confidence_range": "count(*) FILTER (WHERE q > 100)", "code_range": "count(*) FILTER (WHERE m[1] >= (SELECT count(*) FROM x))",
    "metadata_t": f"count(*) FILTER (WHERE {_META.format('text', 180)})", "metadata_e": f"count(*) FILTER (WHERE {_META.format('source', 140)})", "metadata_l": "0", "metadata_w": "0", "metadata_d": "0",
    "entries_missing_columns": "0", "entries_unknown_columns": "1", "entries_repeated_url": "count(*) - count(DISTINCT url)", "entries_too_large": "CASE WHEN sum(strlen(text)) > 8 * 1048576 THEN 1 ELSE 0 END",
    "index_schema": "1", "index_count": "1",
}


@query("val_02_index_rules", f"""WITH x AS (SELECT doc_id, text, source, 'http' || (CASE WHEN doc_id % 50 = 0 THEN '' ELSE 's' END) || '://x/' || (doc_id // 3) AS url, [CASE WHEN doc_id % 40 = 0 THEN doc_id + 1000000000 ELSE 3 END] AS m, doc_id % 110 AS q FROM documents)
{_rules_sql(_INDEX_RULES, 'x')}""")
def _(spark, folder):
    i, none = F.col("doc_id"), F.array().cast("array<bigint>")
    blank = F.lit("")
    rows = table(spark, folder, "documents")
    entries = rows.select(
        F.concat(F.when(i % 50 == 0, "http").otherwise("https"), F.lit("://x/"), F.floor(i / 3).cast("string")).alias("url"),
        F.array(F.when(i % 40 == 0, i + 1_000_000_000).otherwise(3)).alias("m"), none.alias("p"), none.alias("c"), none.alias("x"), (i % 110).alias("q"),
        F.col("text").alias("t"), F.col("source").alias("e"), blank.alias("l"), blank.alias("w"), blank.alias("d"), F.lit("?").alias("notes"),
    )
    terms = rows.select(i.alias("code"), F.col("text").alias("label"))
    header = spark.range(1).select(F.lit(2).alias("schema_version"), F.lit(-1).cast("long").alias("count"))
    return write_packed(spark, _audit_folder(spark), terms, entries, header=header).report()


_STAGING_RULES = {
    "blank_required": "count(*) FILTER (WHERE trim(title) = '')", "workplace_domain": "count(*) FILTER (WHERE w = 'remote')", "demo_tenant": "count(*) FILTER (WHERE company = ' Demo ')",
    "link_pattern": "count(*) FILTER (WHERE starts_with(url, 'http:'))", "missing_lists": "count(*) FILTER (WHERE no_lists)", "jobs_missing_columns": "1", "jobs_private_columns": "1",
    "jobs_repeated_id": "count(id) - count(DISTINCT id)", "jobs_too_large": "CASE WHEN count(*) * 150 > 15 * 1048576 THEN 1 ELSE 0 END", "no_jobs": "0", "staging_schema": "0", "total_jobs": "1", "collected_at": "1", "companies": "0", "workplace_sum": "0",
}


@query("val_03_staging_rules", f"""WITH x AS (SELECT o_orderkey, 'o' || (o_orderkey - o_orderkey % 2 * (CASE WHEN o_orderkey % 50 = 1 THEN 1 ELSE 0 END)) AS id, CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE 'T' END AS title,
  CASE WHEN o_custkey % 90 = 0 THEN ' Demo ' ELSE 'c' || o_custkey END AS company, CASE o_orderkey % 5 WHEN 0 THEN 'Remoto' WHEN 1 THEN 'remote' ELSE 'Híbrido' END AS w, CASE WHEN o_orderkey % 4 = 0 THEN 'http://t.inhire.app/vagas/1' ELSE 'https://t-1.inhire.app/vagas/1' END AS url,
  o_orderkey % 11 = 0 AS no_lists FROM orders) {_rules_sql(_STAGING_RULES, 'x')}""")
def _(spark, folder):
    k, none = F.col("o_orderkey"), F.array().cast("array<string>")
    number = k - (k % 2) * F.when(k % 50 == 1, 1).otherwise(0)
    rows = table(spark, folder, "orders").select(
        F.concat(F.lit("o"), number.cast("string")).alias("id"), F.when(k % 7 == 0, " ").otherwise("T").alias("title"),
        F.when(F.col("o_custkey") % 90 == 0, " Demo ").otherwise(F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).alias("company"), pick(k, "Remoto", "remote", *["Híbrido"] * 3).alias("workplaceType"),
        F.when(k % 4 == 0, "http://t.inhire.app/vagas/1").otherwise("https://t-1.inhire.app/vagas/1").alias("url"),
        *[F.lit("x").alias(c) for c in ("category", "seniority")], F.when(k % 11 != 0, none).alias("contractTypes"), none.alias("alerts"), F.lit("").alias("about"),
        F.lit("").alias("detailFetchedAt"),
    )
    # the header counts one row too many and has no date; the rows lack their location and carry a private column
    header = staging_header(rows, F.lit("someday")).withColumn("total_jobs", F.col("total_jobs") + 1)
    checked = {**qa.staging_rules(unique=False), "blank_required": F.count_if(F.trim("title") == "")}
    return write_staging(spark, _audit_folder(spark), rows, header, rules=checked).report()


@query("val_05_private_leaks", """SELECT count(*) FILTER (WHERE length(text) > 0 AND (contains(CASE doc_id % 3 WHEN 0 THEN 'Vaga: ' || text || '.' WHEN 1 THEN reverse(text) ELSE lang END, text) OR contains(source, text))) AS leaks FROM documents""")
def _(spark, folder):
    title = pick(F.col("doc_id"), F.concat(F.lit("Vaga: "), "text", F.lit(".")), F.reverse("text"), F.col("lang"))
    rows = table(spark, folder, "documents").select("text", title.alias("title"), "source")
    return qa.private_text_leaks(rows, ["title", "source"], "text")
