"""Text, date, number and list functions over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom import fixed_values as fx
from jobloom.functions import arrays as ar, dates as dt, numbers as nu, text as tx
from jobloom.plans.registry import NOW, ads, ADS, now, pick, query, sql_ascii, sql_caseless, sql_equivalence, sql_resume, sql_search, sql_squeeze
from jobloom.session import ensure_checkpoint_dir, table


def _docs(spark, folder, **columns) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", *[c.alias(n) for n, c in columns.items()])


# ---------------------------------------------------------------- folds


#: Words in compatibility characters that are put after each text, and what they fold to.
_FORMS = ("ＳＱＬ", "x²", "ｎｏｄｅ．ｊｓ", "①", "Ｃ＃")
_FORMS_SQL = "(CASE doc_id % 5 WHEN 0 THEN 'sql' WHEN 1 THEN 'x2' WHEN 2 THEN 'node.js' WHEN 3 THEN '1' ELSE 'c#' END)"


def _with_form() -> Column:
    return F.concat_ws(" ", "text", pick(F.col("doc_id"), *_FORMS))


@query("str_01a_fold_ascii", f"SELECT doc_id, md5({sql_ascii('text')} || ' ' || {_FORMS_SQL}) AS folded FROM documents")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder, folded=F.md5(tx.fold_ascii(_with_form())))


@query("str_01b_fold_caseless", f"SELECT doc_id, md5(trim({sql_caseless('text')} || ' ' || {_FORMS_SQL})) AS folded FROM documents")
def _(spark, folder):
    return _docs(spark, folder, folded=F.md5(tx.fold_caseless(_with_form())))


@query("str_01c_fold_search", f"SELECT doc_id, md5({sql_search('text')}) AS searched, md5({sql_resume('text')}) AS resume FROM documents")
def _(spark, folder):
    return _docs(spark, folder, searched=F.md5(tx.fold_search("text")), resume=F.md5(tx.fold_resume("text")))


@query("str_02_stop_tokens", f"SELECT doc_id, md5({sql_equivalence('text')}) AS key_text FROM documents")
def _(spark, folder):
    return _docs(spark, folder, key_text=F.md5(tx.equivalence_text("text")))


# ---------------------------------------------------------------- HTML


# these names also count without their semicolon, as at the end of a cut title
_UNESC = "{}"
for _name, _char in (("copy", "'©'"), ("middot", "'·'"), ("quot", "chr(34)"), ("lt", "'<'"), ("gt", "'>'"), ("amp", "'&'")):
    _UNESC = f"regexp_replace({_UNESC}, '&{_name};?', {_char}, 'g')"


@query("str_03_strip_html", "SELECT page_id, substr(trim(regexp_replace(" + _UNESC.format("regexp_replace(html, '<[^>]+>', ' ', 'g')")
       + ", '\\s{2,}', ' ', 'g'), ' \n\t\r'), 1, 6000) AS text FROM pages")
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", tx.strip_html("html").alias("text"))


@query("str_04_decode_html", "WITH a AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?i)<\\s*br\\s*/?\\s*>', chr(10), 'g'), '(?i)</(p|li|div|h[1-6]|ul|ol)>', chr(10), 'g'), '<[^>]*>', ' ', 'g') AS t FROM pages)"
       " SELECT page_id, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(t, '&quot;', chr(34)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '[\\t\\r ]+', ' ', 'g'), ' *\\n+ *', chr(10), 'g'), ' \n\t\r') AS text FROM a")
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", tx.decode_html("html").alias("text"))


@query("str_05_clean_text", f"SELECT page_id, substr({sql_squeeze('html')}, 1, 500) AS text FROM pages")
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", tx.clean_text("html", 500).alias("text"))


@query("str_06_slugs", f"""WITH t AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages),
s AS (SELECT page_id, regexp_replace(regexp_replace(replace({sql_search('t')}, '&', ' e '), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS a,
  regexp_replace(regexp_replace({sql_ascii('t')}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS b FROM t)
SELECT page_id, coalesce(nullif(a, ''), 'vaga') AS slug, coalesce(nullif(regexp_replace(substr(b, 1, 40), '-+$', ''), ''), 'vaga') AS cut FROM s""")
def _(spark, folder):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, folder, "pages").select("page_id", tx.slugify(title).alias("slug"), tx.title_slug(title, 40).alias("cut"))


# ---------------------------------------------------------------- labels and places


@query("str_07_work_model_label", """WITH x AS (SELECT o_orderkey, o_orderkey % 11 = 0 AS flag, CASE o_orderkey % 6 WHEN 0 THEN 'Trabalho Remoto' WHEN 1 THEN 'HYBRID schedule'
  WHEN 2 THEN 'presencial' WHEN 3 THEN 'In-Office / Home-Office' WHEN 4 THEN NULL ELSE o_orderpriority END AS raw FROM orders)
SELECT o_orderkey, CASE WHEN flag OR o_orderkey % 6 IN (0, 3) THEN 'remote' WHEN o_orderkey % 6 = 1 THEN 'hybrid' WHEN o_orderkey % 6 = 2 THEN 'on-site' ELSE '' END AS work_model FROM x""")
def _(spark, folder):
    k = F.col("o_orderkey")
    raw = pick(k, "Trabalho Remoto", "HYBRID schedule", "presencial", "In-Office / Home-Office", F.lit(None), F.col("o_orderpriority"))
    return table(spark, folder, "orders").select(k, tx.work_model(raw, k % 11 == 0).alias("work_model"))


@query("str_08_split_location", """WITH x AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name || ', SP, BR' WHEN 1 THEN c_name || ', Brasil' WHEN 2 THEN ' ' || c_name || ' , BR' ELSE '' END AS place FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN '' ELSE trim(split_part(place, ',', 1)) END AS city, CASE WHEN c_custkey % 4 = 0 THEN 'SP' ELSE '' END AS state,
  CASE WHEN c_custkey % 4 IN (0, 2) THEN 'BR' ELSE '' END AS country FROM x""")
def _(spark, folder):
    k, name = F.col("c_custkey"), F.col("c_name")
    place = pick(k, F.concat(name, F.lit(", SP, BR")), F.concat(name, F.lit(", Brasil")), F.concat(F.lit(" "), name, F.lit(" , BR")), "")
    return table(spark, folder, "customer").select(k, place.alias("place")).select(k, F.inline(F.array(tx.split_location("place"))))


@query("str_09_city_names", """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || '|Olinda' WHEN 1 THEN c_name ELSE '' END AS cities FROM customer""")
def _(spark, folder):
    k, name = F.col("c_custkey"), F.col("c_name")
    place = pick(k, F.concat(name, F.lit(", PE · BR - Olinda | Brasil")), F.concat(F.lit("Remoto ; "), name, F.lit(", X")), "Worldwide")
    return table(spark, folder, "customer").select(k, F.array_join(tx.city_names(place), "|").alias("cities"))


@query("str_10_tidy_location", """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'São Paulo, SP' WHEN 1 THEN c_mktsegment[1] || lower(c_mktsegment[2:]) || ', RJ' ELSE c_name END AS place FROM customer""")
def _(spark, folder):
    k = F.col("c_custkey")
    raw = pick(k, "SAO PAULO, sp, Brasil", F.concat("c_mktsegment", F.lit(", rj, BR")), F.concat("c_name", F.lit(", Pernambuco, Brazil")))
    return table(spark, folder, "customer").select(k, tx.tidy_location(raw).alias("place"))


@query("str_11_board_location", """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name || ' · Recife' WHEN 1 THEN c_mktsegment WHEN 2 THEN 'Porto Alegre, RS' ELSE '' END AS place FROM customer""")
def _(spark, folder):
    k = F.col("c_custkey")
    raw = pick(k, F.concat(F.lit("Remote - "), "c_name", F.lit("; Recife | Recife")), F.concat(F.lit("Híbrido / "), "c_mktsegment"), "Presencial - ", "")
    title = pick(k, "x", "y", "Dev | Porto Alegre / RS", "Dev | Remoto / RS")
    return table(spark, folder, "customer").select(k, tx.board_location(raw, title).alias("place"))


@query("str_13_company_from_slug", """SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'Empresa confidencial' WHEN 1 THEN 'Empresa não informada' ELSE 'Supplier#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || ' Corp' END AS company FROM supplier""")
def _(spark, folder):
    k = F.col("s_suppkey")
    slug = pick(k, "Confidential", " ", F.concat(F.lower("s_name"), F.lit("-corp-42")), F.concat("s_name", F.lit("-CORP")))
    return table(spark, folder, "supplier").select(k, tx.company_from_slug(slug).alias("company"))


@query("str_14_label_maps", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Gupy' WHEN 1 THEN 'Portal não informado' WHEN 2 THEN 'We Work Remotely' ELSE o_orderstatus END AS source,
  CASE o_orderkey % 4 WHEN 0 THEN 'Remoto' WHEN 1 THEN 'Híbrido' WHEN 2 THEN 'Presencial' ELSE 'Não informada' END AS workplace,
  CASE o_orderkey % 4 WHEN 0 THEN 'Brasil' WHEN 1 THEN 'Global remoto' WHEN 2 THEN 'Não informado' ELSE o_orderstatus END AS market,
  CASE o_orderkey % 4 WHEN 0 THEN 'CNPJ' WHEN 1 THEN 'CLT' WHEN 2 THEN '' ELSE o_orderstatus END AS contract FROM orders""")
def _(spark, folder):
    k, other = F.col("o_orderkey"), F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        k,
        tx.source_label(pick(k, "gupy", "", "weworkremotely", other)).alias("source"),
        tx.workplace_label(pick(k, "Remoto", "híbrido", "On-Site", other)).alias("workplace"),
        tx.market_label(pick(k, "BR", "Global remote", "", other)).alias("market"),
        tx.contract_label(pick(k, " pj ", "CLT", "", other)).alias("contract"),
    )


#: The letters of the whole text; a company line holds at most 140 characters.
_LETTERS = "coalesce(nullif(trim(regexp_replace(text, '[^A-Za-z]+', ' ', 'g')), ''), 'Texto')"


@query("str_12_card_lines", f"""WITH w AS (SELECT doc_id, source, {_LETTERS} AS w FROM documents), c AS (SELECT *, doc_id % 4 = 0 OR length('Firma ' || w) > 140 AS hidden FROM w)
SELECT doc_id, w || ' Dev' AS title, CASE WHEN hidden THEN 'Empresa confidencial' ELSE 'Firma ' || w END AS company,
  CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'Cidade ' || source END AS city, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'PE' END AS state,
  CASE doc_id % 5 WHEN 0 THEN '2024-04-30' WHEN 1 THEN '2024-04-29' WHEN 2 THEN '2024-04-27' WHEN 3 THEN '2023-12-12' ELSE '2022-03-01' END AS published_date,
  CASE doc_id % 2 WHEN 0 THEN 'hybrid' ELSE 'on-site' END AS work_model, CASE doc_id % 7 WHEN 0 THEN 'CLT|Cooperado' ELSE 'PJ' END AS contracts, hidden AS blind FROM c""")
def _(spark, folder):
    from jobloom.sources.cards import normalize_cards

    i = F.col("doc_id")
    words = F.coalesce(F.nullif(F.trim(F.regexp_replace("text", "[^A-Za-z]+", " ")), F.lit("")), F.lit("Texto"))
    title = F.concat(words, F.lit(" Dev"))
    body = F.concat_ws(
        "\n", F.lit(" NOVA "), title, F.lit("4,5"), pick(i, "Hoje", "Ontem", "há  3 dias", "12 dez", "1 mar 2022"), F.lit("R$ 1.000"),
        F.when(i % 3 == 0, "Todo Brasil").otherwise(F.concat(F.lit("Cidade "), "source", F.lit(" - PE, 12,5 Km de você"))),
        F.when(i % 4 != 0, F.concat(F.lit("Firma "), words)),
        # too long for a company name
        F.concat(F.when(i % 2 == 0, "Híbrido ").otherwise("Presencial "), F.when(i % 7 == 0, "CLT cooperado ").otherwise("prestadora de serviços "), F.repeat(F.lit("x "), 75)),
        F.lit("Candidatar-me"),
    )
    cards = table(spark, folder, "documents").select(
        i, F.concat(F.lit("https://x.example/vaga__"), i.cast("string"), F.lit(".aspx?z=1")).alias("href"), F.lit("Nova\n").alias("title"), body.alias("text"),
    )
    rows = normalize_cards(cards, F.lit("2024-04-30"), keep=("doc_id",))
    return rows.select(
        "doc_id", "title", "company", "city", "state", "published_date", "work_model", F.array_join("contract_types", "|").alias("contracts"),
        F.col("blind_selection").alias("blind"),
    )


@query("str_16_csv_cell", """SELECT p_partkey, '"' || (CASE WHEN p_partkey % 3 = 0 THEN '''' ELSE '' END) || replace((CASE p_partkey % 3 WHEN 0 THEN '=' WHEN 1 THEN 'a"b' ELSE '' END) || p_name, '"', '""') || '"' AS cell FROM part""")
def _(spark, folder):
    k = F.col("p_partkey")
    return table(spark, folder, "part").select(k, tx.csv_cell(F.concat(pick(k, "=", 'a"b', ""), "p_name")).alias("cell"))


def _quoted_cell(value: str) -> str:
    return f"""'"' || (CASE WHEN regexp_matches({value}, '^[=+@-]') THEN '''' ELSE '' END) || replace({value}, '"', '""') || '"'"""


_CSV_CELLS = ["p_name", "p_brand", "'Portal'", "'Área'", "'Pleno'", "'Remoto'", "'Brasil'", "'Recife'", "p_type || ' | ' || p_brand", "CASE WHEN p_size % 2 = 0 THEN 'Sim' ELSE 'Não' END", "'Não'", "''", "'2024-01-01'", "'2024-04-30'", "'https://x/' || p_partkey"]
_CSV_HEAD = ";".join(f'"{h}"' for h in fx.CSV_HEADERS)
_CSV_LINE = " || ';' || ".join(map(_quoted_cell, _CSV_CELLS))


@query("snk_03_csv_rows", f"SELECT '{_CSV_HEAD}' AS line UNION ALL SELECT {_CSV_LINE} FROM part")
def _(spark, folder):
    """The exported document: written with its byte order mark (which reading takes off) and line ends, then read back line by line."""
    from jobloom.operators.search import csv_rows
    from jobloom.operators.sinks import write_csv

    fixed = {"sourceLabel": "Portal", "category": "Área", "seniority": "Pleno", "workplaceType": "Remoto", "market": "Brasil", "location": "Recife", "currency": "BRL", "publishedAt": "2024-01-01", "lastSeenAt": "2024-04-30"}
    rows = table(spark, folder, "part").select(
        F.col("p_name").alias("title"), F.col("p_brand").alias("company"), *[F.lit(v).alias(c) for c, v in fixed.items()],
        F.concat(F.lit("https://x/"), F.col("p_partkey").cast("string")).alias("url"),
        F.array("p_type", "p_brand").alias("contractTypes"), (F.col("p_size") % 2 == 0).alias("pcd"), F.lit(False).alias("blindSelection"),
        F.lit(None).cast("double").alias("salaryMin"), F.lit(None).cast("double").alias("salaryMax"),
    )
    path = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    write_csv(csv_rows(rows), path)
    return spark.read.option("lineSep", "\r\n").text(path).withColumnRenamed("value", "line")


_ALIAS_TEXT = sql_caseless("text")


@query("str_17_alias_match", f"""WITH d AS (SELECT doc_id, {_ALIAS_TEXT} AS t FROM documents)
SELECT doc_id, regexp_matches(t, '(^|[^a-z0-9])der($|[^a-z0-9])') AS short_alias, contains(t, 'tion the') AS long_alias,
  regexp_matches(t, '(^|[^a-z0-9])the, ($|[^a-z0-9])') AS odd, regexp_matches(t, '(^|[^a-z0-9])es\\.($|[^a-z0-9])') AS dotted FROM d""")
def _(spark, folder):
    folded = _docs(spark, folder, t=tx.fold_caseless("text"))
    t = F.col("t")
    return folded.select(
        "doc_id", tx.has_alias(t, "der").alias("short_alias"), tx.has_alias(t, "tion the").alias("long_alias"),
        t.rlike("(?<![a-z0-9])the, (?![a-z0-9])").alias("odd"), tx.has_alias(t, "es.").alias("dotted"),
    )


@query("str_18_contract_words", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'CLT|PJ' WHEN 1 THEN 'PJ|Freelancer' WHEN 2 THEN '' ELSE 'Temporário' END AS regime,
  CASE o_orderkey % 4 WHEN 0 THEN 'CLT|' || o_orderstatus ELSE o_orderpriority END AS choices FROM orders""")
def _(spark, folder):
    k = F.col("o_orderkey")
    regime = pick(k, "regime PJ ou CLT", "Pessoa jurídica / freelance", "other", "contrato temporario")
    choice = F.when(k % 4 == 0, F.concat(F.lit("CLT OU "), "o_orderstatus")).otherwise(F.col("o_orderpriority"))
    return table(spark, folder, "orders").select(
        k, F.array_join(tx.labels_in_text(regime, fx.REGIME_CONTRACTS), "|").alias("regime"),
        F.array_join(tx.split_alternatives(choice), "|").alias("choices"),
    )


@query("str_19_inclusion_flags", """SELECT doc_id, doc_id % 3 = 0 OR regexp_matches(text, '(?i)\\bpcd\\b') AS pcd, doc_id % 5 = 0 AS affirmative FROM documents""")
def _(spark, folder):
    i = F.col("doc_id")
    extended = F.concat_ws(" ", "text", F.when(i % 3 == 0, "Vaga PcD"))
    offer = F.when(i % 5 == 0, "vaga exclusiva para pessoas com deficiência").otherwise(F.col("source"))
    return _docs(spark, folder, pcd=tx.matches(extended, fx.PCD_TEXT), affirmative=tx.matches(offer, fx.PCD_TEXT_AFFIRMATIVE))


@query("str_20_urls", """SELECT page_id, regexp_replace(url, '[?#].*$', '') AS canonical, regexp_extract(url, '/([0-9]+)', 1) AS native_id,
  replace(replace(replace(replace(replace(replace(url, '%', '%25'), ':', '%3A'), '/', '%2F'), '?', '%3F'), '=', '%3D'), '&', '%26') AS half_encoded FROM pages""")
def _(spark, folder):
    encoded = F.replace(tx.percent_encode("url"), F.lit("%23"), F.lit("#"))
    return table(spark, folder, "pages").select(
        "page_id", tx.canonical_url("url").alias("canonical"), F.regexp_extract("url", "/([0-9]+)", 1).alias("native_id"), encoded.alias("half_encoded")
    )


@query("str_21_first_non_blank", """SELECT o_orderkey, coalesce(nullif(CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderstatus END, ''), CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END, '') AS value FROM orders""")
def _(spark, folder):
    k = F.col("o_orderkey")
    a, b = F.when(k % 2 == 0, "").otherwise(F.col("o_orderstatus")), F.when(k % 3 != 0, F.col("o_orderpriority"))
    return table(spark, folder, "orders").select(k, tx.first_non_blank(a, b).alias("value"))


@query("str_22_location_text", """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN c_name || ', PE, Brasil' WHEN 2 THEN c_mktsegment || ' | ' || c_name || ', PE' ELSE '' END AS place FROM customer""")
def _(spark, folder):
    from jobloom.sources.json_items import location_text

    k, name = F.col("c_custkey"), F.col("c_name")
    record = F.to_json(F.struct(name.alias("name"), name.alias("city"), F.lit("PE").alias("state"), F.lit("Brasil").alias("country")))
    listed = F.to_json(F.array(F.struct(F.col("c_mktsegment").alias("name"), F.lit(None).cast("string").alias("state")), F.struct(name.alias("name"), F.lit("PE").alias("state"))))
    raw = pick(k, F.to_json(F.array(name)), record, listed, "{}")
    value = F.when(k % 4 == 0, F.try_variant_get(F.try_parse_json(raw), "$[0]", "variant")).otherwise(F.try_parse_json(raw))
    return table(spark, folder, "customer").select(k, location_text(value).alias("place"))


# ---------------------------------------------------------------- dates


@query("dat_01_iso_date", """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00+00:00') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT10:20:30+00:00')
  WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT10:20:00-03:00') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 4 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00+00:00') END AS d FROM orders""")
def _(spark, folder):
    k, d = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    raw = pick(
        k, F.when(seconds > 10_000_000, seconds.cast("string")), F.concat(d, F.lit("T10:20:30.999Z")), F.concat(d, F.lit(" 10:20-03:00")), F.concat(d, F.lit(" at noon")),
        "soon", (seconds * 1000).cast("string"),
    )
    return table(spark, folder, "orders").select(k, dt.iso_date(raw).alias("d"))


@query("dat_02_months_ago", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 2 MONTH AS DATE)::VARCHAR AS cutoff, (CAST(o_orderdate AS DATE) - INTERVAL 14 MONTH)::DATE::VARCHAR AS far FROM orders")
def _(spark, folder):
    d = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select("o_orderkey", dt.publication_cutoff(d, 2).alias("cutoff"), dt.publication_cutoff(d, 14).alias("far"))


@query("dat_03_local_day", "SELECT event_id, CAST(ts - INTERVAL 3 HOUR AS DATE)::VARCHAR AS day FROM events")
def _(spark, folder):
    return table(spark, folder, "events").select("event_id", dt.local_day("ts").cast("string").alias("day"))


_MON = "['jan','fev','mar','abr','mai','jun','jul','ago','set','out','nov','dez'][month(o_orderdate)]"


@query("dat_04_relative_date", f"""WITH x AS (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '1998-12-01' WHEN 1 THEN '1998-11-30' WHEN 2 THEN (DATE '1998-12-01' - (o_orderkey % 30)::INTEGER)::DATE::VARCHAR WHEN 3 THEN d::VARCHAR
  ELSE CASE WHEN strftime(d, '%m-%d') = '02-29' THEN '' WHEN strftime(d, '1998-%m-%d') > '1998-12-02' THEN strftime(d, '1997-%m-%d') ELSE strftime(d, '1998-%m-%d') END END AS d FROM x""")
def _(spark, folder):
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    names = F.array(*[F.lit(m) for m in fx.MONTHS])
    month = F.get(names, F.month(d) - 1)
    day = F.dayofmonth(d).cast("string")
    raw = pick(k, " Hoje", "ONTEM", F.concat(F.lit("há "), (k % 30).cast("string"), F.lit(" dias")), F.concat_ws(" ", day, month, F.year(d).cast("string")), F.concat_ws(" ", day, month))
    rows = table(spark, folder, "orders")
    return rows.select(k, dt.relative_date(raw, F.lit("1998-12-01")).alias("d"))


@query("dat_05_short_date", f"""SELECT o_orderkey, (CASE WHEN month(o_orderdate) > 6 THEN '1997' ELSE '1998' END) || strftime(o_orderdate, '-%m-%d') AS d FROM orders""")
def _(spark, folder):
    d = F.col("o_orderdate").cast("date")
    month = F.get(F.array(*[F.lit(m) for m in fx.MONTHS]), F.month(d) - 1)
    raw = F.concat(F.lit("em "), F.dayofmonth(d).cast("string"), F.lit(" "), month)
    return table(spark, folder, "orders").select("o_orderkey", dt.short_date(raw, F.lit("1998-06-15")).alias("d"))


@query("dat_06_portal_formats", """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT08:09:10-03:00')
  WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00+00:00') ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00.000Z') END AS d FROM orders""")
def _(spark, folder):
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    value = pick(
        k, dt.english_date(F.date_format(d, "MMM d, yyyy")), dt.slash_date(F.date_format(d, "dd/MM/yyyy")),
        dt.mail_date(F.concat(F.date_format(d, "E, dd MMM yyyy"), F.lit(" 08:09:10 -0300"))),
        dt.epoch_date(F.unix_millis(d)), dt.iso_instant(F.date_format(d, "yyyy-MM-dd")),
    )
    return table(spark, folder, "orders").select(k, value.alias("d"))


@query("dat_07_activity_time", f"""SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE least(epoch(o_orderdate) + CASE o_orderkey % 3 WHEN 0 THEN 43200 WHEN 1 THEN 3600 ELSE 43200 END, epoch(TIMESTAMP '1998-12-01')) END AS BIGINT) AS activity FROM orders""")
def _(spark, folder):
    k, d = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    published = F.when(k % 9 == 0, "").otherwise(pick(k, d, F.concat(d, F.lit("T01:00:00Z")), ""))
    seen = F.when(k % 9 == 0, "?").otherwise(d)
    return table(spark, folder, "orders").select(k, dt.activity_seconds(published, seen, F.to_timestamp(F.lit("1998-12-01"))).alias("activity"))


@query("dat_09_date_chain", f"WITH {ADS} SELECT doc_id, coalesce(nullif(published_date, ''), nullif(expires_date, ''), '2024-01-01') AS d FROM ads")
def _(spark, folder):
    chain = tx.first_non_blank("published_date", "expires_date", F.lit("2024-01-01"))
    return ads(spark, folder).select("doc_id", chain.alias("d"))


# ---------------------------------------------------------------- numbers


@query("mth_01_money", """SELECT c_custkey, round(CASE WHEN c_custkey % 3 = 0 THEN 1500.5 ELSE abs(c_acctbal) END, 2) AS low,
  CASE WHEN c_custkey % 3 = 0 THEN round(1500.5 + c_custkey, 2) END AS high, CASE WHEN c_custkey % 3 <> 2 THEN 'BRL' END AS currency,
  CASE WHEN c_custkey % 3 <> 2 THEN CASE WHEN c_custkey % 3 = 0 THEN 1500.5 ELSE abs(c_acctbal) END END AS reais FROM customer""")
def _(spark, folder):
    k = F.col("c_custkey")
    pt = lambda c: F.translate(F.format_number(c, 2), ",.", ".,")
    balance = F.abs("c_acctbal")
    raw = pick(k, F.concat(F.lit("De R$ 1.500,50 a "), pt((k + 1500.5).cast("double"))), F.concat(F.lit("R$ "), pt(balance)), pt(balance))
    rows = table(spark, folder, "customer").select(k, nu.money(raw).alias("m"), nu.reais(raw).alias("r"))
    return rows.select(k, F.round("m.low", 2).alias("low"), F.round("m.high", 2).alias("high"), F.col("m.currency").alias("currency"), F.col("r.low").alias("reais"))


@query("mth_02_tolerant_number", "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 2 THEN c_acctbal END AS n FROM customer")
def _(spark, folder):
    k, text = F.col("c_custkey"), F.col("c_acctbal").cast("string")
    raw = pick(k, F.replace(text, F.lit("."), F.lit(",")), F.concat(F.lit(" "), text), "a combinar")
    return table(spark, folder, "customer").select(k, nu.tolerant_number(raw).alias("n"))


@query("mth_03_visible_salary", """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CASE WHEN p_size % 3 = 0 THEN nullif(p_retailprice, 0) ELSE p_size END END AS low,
  CASE WHEN p_size % 2 = 0 AND p_size % 3 <> 0 THEN nullif(p_retailprice, 0) END AS high, CASE WHEN p_size % 2 = 0 THEN 'BRL' END AS currency FROM part""")
def _(spark, folder):
    size = F.col("p_size")
    simple = size % 3 == 0
    value = nu.visible_salary(
        size % 2 == 0, F.when(simple, "simple").otherwise("range"), F.when(~simple, size.cast("double")).otherwise(F.lit(0.0)), F.col("p_retailprice")
    )
    return table(spark, folder, "part").select("p_partkey", F.inline(F.array(value)))


@query("mth_04_rounding", """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax <> 0 THEN round_even(l_tax * 12.5, 2) END AS amount, CAST(floor(l_quantity * 1.37 + 0.5) AS INTEGER) AS half_up,
  CAST(greatest(0, least(100, floor(l_extendedprice / 700 - 20 + 0.5))) AS INTEGER) AS clamped FROM lineitem""")
def _(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", nu.published_amount(F.col("l_tax") * 12.5).alias("amount"),
        nu.round_half_up(F.col("l_quantity") * 1.37).alias("half_up"),
        nu.clamp(nu.round_half_up(F.col("l_extendedprice") / 700 - 20)).alias("clamped"),
    )


@query("mth_05_salary_text", """WITH x AS (SELECT p_partkey, translate(format('{:,.2f}', p_retailprice), ',.', '.,') AS low, translate(format('{:,.2f}', p_retailprice * 2), ',.', '.,') AS high FROM part)
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'R$' || chr(160) || low || ' a R$' || chr(160) || high WHEN 1 THEN 'A partir de R$' || chr(160) || low WHEN 2 THEN 'Até R$' || chr(160) || high ELSE '' END AS salary FROM x""")
def _(spark, folder):
    k, price = F.col("p_partkey"), F.col("p_retailprice")
    low, high = F.when(k % 4 <= 1, price), F.when((k % 4 == 0) | (k % 4 == 2), price * 2)
    return table(spark, folder, "part").select(k, nu.salary_text(low, high, F.lit("BRL")).alias("salary"))


@query("bol_01_true_text", "SELECT o_orderkey, o_orderkey % 5 < 3 AS flag FROM orders")
def _(spark, folder):
    k = F.col("o_orderkey")
    return table(spark, folder, "orders").select(k, nu.is_true_text(pick(k, " TRUE", "1", "Sim ", "não", F.lit(None))).alias("flag"))


# ---------------------------------------------------------------- lists and JSON


@query("arr_01_names", """SELECT p_partkey, p_name || CASE WHEN p_brand <> p_name THEN '|' || p_brand ELSE '' END AS names FROM part""")
def _(spark, folder):
    from jobloom.sources.json_items import names

    raw = F.concat(
        F.lit("["), F.to_json(F.struct(F.concat(F.lit(" "), "p_name").alias("name"))), F.lit(',"'), F.col("p_brand"), F.lit('",null,{"title":"'),
        F.col("p_name"), F.lit('"},""]'),
    )
    return table(spark, folder, "part").select("p_partkey", F.array_join(names(F.try_parse_json(raw)), "|").alias("names"))


@query("arr_02_list_or_scalar", """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name || '|' || p_type WHEN 1 THEN p_name ELSE '' END AS vals, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS meta FROM part""")
def _(spark, folder):
    from jobloom.sources.json_items import metadata_values, values

    k = F.col("p_partkey")
    raw = pick(k, F.to_json(F.array("p_name", "p_type", "p_name")), F.concat(F.lit('"'), "p_name", F.lit('"')), "null")
    field = F.struct(F.when(k % 2 == 0, "Employment Type:").otherwise("Other").alias("name"), F.col("p_brand").alias("value"))
    meta = F.try_parse_json(F.to_json(F.array(field)))
    return table(spark, folder, "part").select(
        k, F.array_join(values(F.try_parse_json(raw)), "|").alias("vals"),
        F.array_join(metadata_values(meta, fx.METADATA_CONTRACT_NAMES), "|").alias("meta"),
    )


@query("arr_03_joined_lists", "SELECT p_partkey, substr(p_name || ' · ' || p_type || ' · ' || p_brand, 1, 20) AS joined, string_split(p_name || ' · ' || p_type, ' · ')[2] AS second FROM part")
def _(spark, folder):
    text = ar.joined(F.array("p_name", "p_type", "p_name", "p_brand"), 20)
    back = ar.unjoined(F.concat_ws(" · ", "p_name", F.lit(""), "p_type"))
    return table(spark, folder, "part").select("p_partkey", text.alias("joined"), F.get(back, F.lit(1)).alias("second"))


@query("arr_04_skill_tokens", "SELECT p_partkey, p_name || '|' || p_type || '|' || p_brand AS skills FROM part")
def _(spark, folder):
    text = F.concat_ws(" ; ", "p_name", F.lit("x"), "p_type", F.concat("p_name", F.lit(" · "), "p_brand"))
    return table(spark, folder, "part").select("p_partkey", F.array_join(ar.skill_tokens(text), "|").alias("skills"))


@query("jsn_01_payload_fields", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'k' AS keys, '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS compact FROM events""")
def _(spark, folder):
    parsed = F.from_json("props", "k bigint")
    return table(spark, folder, "events").select(
        "event_id", parsed["k"].alias("k"), F.array_join(F.json_object_keys("props"), ",").alias("keys"), F.to_json(parsed).alias("compact")
    )
