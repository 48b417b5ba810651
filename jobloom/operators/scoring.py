"""Résumé against requirements: matching at term grain, scores per distinct profile, top rows per résumé.

Scoring every résumé against every job would be a cross join.  Four facts keep it small: the score depends only on which
terms a résumé covers and on which terms a job asks for; jobs that ask for the same terms with the same confidence score
alike, so only the first ``k`` of each such *profile* can be in a top ``k``; a job that shares no term with a résumé scores
zero, so those are taken from one short ordered list; and a profile whose bound is below a résumé's ``k``-th score need not be
met at all, which postings ordered by that bound tell before any pair is formed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom import fixed_values as fx
from jobloom.functions import text as tx
from jobloom.functions.numbers import clamp, round_half_up
from jobloom.operators.ordering import places, top_per_group
from jobloom.operators.requirements import Vocabulary
from jobloom.session import materialize

#: Pieces that the résumé side of a key is cut into.
SPREAD = 16


# ---------------------------------------------------------------- which terms a résumé covers


def covering_aliases(vocabulary: Vocabulary, supersets: Mapping[str, Sequence[str]] = fx.LEVEL_SUPERSETS) -> dict[str, list[str]]:
    """Folded aliases that satisfy each taxonomy label, including those of higher levels."""
    by_id = {e.id: e for e in vocabulary.entries}
    out: dict[str, list[str]] = {}
    for entry in vocabulary.entries:
        family = [entry, *(by_id[i] for i in supersets.get(entry.id, ()) if i in by_id)]
        words = [tx.py_fold_caseless(w) for e in family for w in (e.label, *e.aliases)]
        out.setdefault(tx.py_fold_caseless(entry.label), []).extend(w for w in words if w)
    return {label: sorted(set(words)) for label, words in out.items()}


def covered_labels(folded_resume: Column, vocabulary: Vocabulary) -> Column:
    """Folded taxonomy labels the résumé satisfies."""
    tests = []
    for label, words in covering_aliases(vocabulary).items():
        found = F.lit(False)
        for word in words:
            found = found | tx.has_alias(folded_resume, word, tx.resume_alias_regex)
        tests.append(F.when(found, label))
    return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")


def recognized_skills(folded_resume: Column, vocabulary: Vocabulary) -> Column:
    """Distinct taxonomy labels named in the résumé itself (no level supersets), in taxonomy order."""
    tests = []
    for entry in vocabulary.entries:
        found = F.lit(False)
        for word in sorted({tx.py_fold_caseless(w) for w in (entry.label, *entry.aliases)} - {""}):
            found = found | tx.has_alias(folded_resume, word, tx.resume_alias_regex)
        tests.append(F.when(found, entry.label))
    return F.array_distinct(F.array_compact(F.array(*tests)))


#: Length of the pieces that the index holds; a phrase is covered by pieces at steps of this length.
GRAM = 5
_WORD_KEY = lambda w: F.concat(F.lit("w"), w)
_BEYOND_BMP = r"[\x{10000}-\x{10FFFF}]"


def phrase_needs(labels: DataFrame) -> DataFrame:
    """What finds a label in a text: ``label, total, item, t, weight, way, keys, key, shift``.

    Item 0 is the whole phrase, the others are its distinct words.  A ``gram`` item is found where all its pieces stand at
    their distances, a ``word`` item where the word is one; both need no text.  A ``text`` item only names a word that has to
    be there, and is decided on the text.
    """
    tokens = F.filter(
        F.split("label", r"[^a-z0-9+#./-]+"), lambda t: (F.length(t) > 1) & ~t.isin(*fx.PHRASE_STOP_WORDS)
    )
    way = lambda t: F.when(t == "sql", "word").when(t.rlike(r"[.+#/-]"), "text").when(F.length(t) <= 4, "word").otherwise("gram")
    whole = F.struct(
        F.lit(0).alias("item"), F.col("label").alias("t"), F.lit(0).alias("weight"),
        F.when(F.col("label").rlike(_BEYOND_BMP), "text").otherwise("gram").alias("way"),
    )
    word = lambda t, i: F.struct(
        (i + 1).alias("item"), t.alias("t"), F.size(F.filter("_tokens", lambda x: x == t)).alias("weight"), way(t).alias("way")
    )
    items = F.concat(F.array(whole), F.transform(F.array_distinct("_tokens"), word))
    rows = labels.filter(F.length("label") > 0).withColumn("_tokens", tokens)
    rows = rows.select("label", F.size("_tokens").alias("total"), F.inline(items))

    none = F.lit(None).cast("int")
    key = lambda k, shift: F.struct(k.alias("key"), shift.alias("shift"))
    last = F.length("t") - GRAM
    steps = F.when(last <= 0, F.array(F.lit(0))).otherwise(F.array_distinct(F.concat(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(GRAM)), F.array(last))))
    keys = (
        F.when(F.col("way") == "gram", F.transform(steps, lambda s: key(F.concat(F.lit("g"), F.substring(F.col("t"), s + 1, F.lit(GRAM))), s)))
        .when(F.col("t") == "sql", F.array(key(F.lit("wsql"), none), key(F.lit("wplsql"), none)))
        .when(F.col("way") == "word", F.array(key(_WORD_KEY(F.col("t")), none)))
        # a whole phrase may begin inside a word: every text is asked
        .when(F.col("item") == 0, F.array(key(F.lit("w"), none)))
        .otherwise(F.array(key(_WORD_KEY(F.regexp_extract("t", "([a-z0-9]+)", 1)), none)))
    )
    rows = rows.withColumn("_keys", keys)
    return rows.withColumn("keys", F.when(F.col("way") == "gram", F.size("_keys")).otherwise(1)).select("*", F.inline("_keys")).drop("_keys")


def text_index(texts: DataFrame, text_id: str, text: str, lengths: Sequence[int] = (GRAM,)) -> DataFrame:
    """Positional inverted index ``text_id, key, at``: every word once (no place), every piece of ``lengths`` with its place."""
    words = F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit("([a-z0-9]+)"), F.lit(1))))
    entry = lambda k, at: F.struct(k.alias("key"), at.alias("at"))
    # a lookahead gives overlapping pieces in one pass over the text
    pieces = [
        F.transform(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)), lambda g, i: entry(F.concat(F.lit("g"), g), i))
        for n in lengths
    ]
    found = F.concat(F.transform(words, lambda w: entry(_WORD_KEY(w), F.lit(None).cast("int"))), *pieces)
    return texts.select(text_id, F.inline(found))


def phrase_coverage(resumes: DataFrame, labels: DataFrame, resume_id: str, folded: str, keep=materialize) -> DataFrame:
    """``resume_id, label`` for labels outside the taxonomy: the whole phrase, or at least 72 % of its words.

    ``labels`` has one folded ``label`` per row.  Labels meet a positional index of the résumés, which holds ids and places, no
    text; every key is spread over ``SPREAD`` pieces by résumé.  Only pairs that hinge on words with signs (``c++``, ``ci/cd``)
    fetch the text, once per résumé and label.
    """
    needs = keep(phrase_needs(labels.distinct()))
    gram = F.col("way") == "gram"
    # phrases shorter than a piece need pieces of their own length; there are at most four such lengths
    short = [r[0] for r in needs.filter(gram & (F.length("t") < GRAM)).select(F.length("t")).distinct().collect()]
    index = text_index(resumes, resume_id, folded, [GRAM, *sorted(short)])
    index = index.withColumn("_s", F.pmod(F.xxhash64(resume_id), F.lit(SPREAD)).cast("int"))
    spread = needs.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    met = index.join(spread, ["key", "_s"])
    place = F.when(gram, F.col("at") - F.col("shift")).alias("_place")
    group = [resume_id, "label", "item", "total", "t", "weight", "way", "keys"]
    found = met.groupBy(*group, place).agg(F.count(F.lit(1)).alias("_n")).filter(~gram | (F.col("_n") == F.col("keys")))
    found = found.select(*group).distinct()

    sure, open_ = F.col("way") != "text", F.col("way") == "text"
    pairs = found.groupBy(resume_id, "label", "total").agg(
        F.max(sure & (F.col("item") == 0)).alias("_whole"),
        F.sum(F.when(sure, F.col("weight")).otherwise(0)).alias("_found"),
        # at most one entry per word of the label
        F.collect_list(F.when(open_, F.struct("item", "t", "weight"))).alias("_open"),
    )
    enough = lambda n: (F.col("total") > 0) & (n / F.greatest(F.col("total"), F.lit(1)) >= fx.PHRASE_SHARE)
    most = F.aggregate("_open", F.col("_found"), lambda n, x: n + x["weight"])
    decided = F.col("_whole") | enough(F.col("_found"))
    can = enough(most) | F.exists("_open", lambda x: x["item"] == 0)
    pairs = keep(pairs.withColumn("_decided", decided).filter(F.col("_decided") | can))
    asked = pairs.filter(~F.col("_decided")).join(resumes.select(resume_id, F.col(folded).alias("_text")), resume_id)
    quoted = lambda t: F.regexp_replace(t, r"([.+#/-])", r"\\$1")
    bounded = lambda t: F.rlike("_text", F.concat(F.lit("(?<![a-z0-9])"), quoted(t), F.lit("(?![a-z0-9])")))
    there = F.filter("_open", lambda x: F.when(x["item"] == 0, F.contains("_text", x["t"])).otherwise(bounded(x["t"])))
    asked = asked.withColumn("_there", there)
    all_found = F.aggregate("_there", F.col("_found"), lambda n, x: n + x["weight"])
    fits = asked.filter(F.exists("_there", lambda x: x["item"] == 0) | enough(all_found))
    return pairs.filter("_decided").select(resume_id, "label").unionByName(fits.select(resume_id, "label"))


# ---------------------------------------------------------------- scores


def resume_quality(length: Column) -> Column:
    return F.when(length >= 900, 100).when(length >= 450, 80).when(length >= 220, 55).otherwise(30)


def score(m_hit: Column, m_all: Column, p_hit: Column, p_all: Column, c_hit: Column, c_all: Column, confidence: Column) -> Column:
    """0 to 100 from matched and total counts per group.

    Groups weigh 80, 15 and 5, renormalised over the groups present; missing mandatory requirements cap the score.
    """
    zero = F.lit(0.0)
    part = lambda hit, total, w: F.when(total > 0, hit / total * w).otherwise(zero)
    gained = part(m_hit, m_all, 80) + part(p_hit, p_all, 15) + part(c_hit, c_all, 5)
    weight = F.when(m_all > 0, 80).otherwise(0) + F.when(p_all > 0, 15).otherwise(0) + F.when(c_all > 0, 5).otherwise(0)
    raw = F.when(weight > 0, gained * (F.lit(100.0) / weight)).otherwise(gained)
    ratio, missing = F.when(m_all > 0, m_hit / m_all), m_all - m_hit
    capped = (
        F.when((m_all >= 4) & (ratio < 0.5), F.least(raw, F.lit(55.0)))
        .when((missing >= 2) & (ratio < 0.75), F.least(raw, F.lit(69.0)))
        .when((missing >= 1) & (m_all <= 3), F.least(raw, F.lit(79.0)))
        .otherwise(raw)
    )
    capped = F.when((m_all == 0) & (F.coalesce(confidence, F.lit(0)) < 60), F.least(capped, F.lit(75.0))).otherwise(capped)
    return clamp(round_half_up(capped))


def coverage(confidence: Column, quality: Column) -> Column:
    return round_half_up(clamp(F.coalesce(confidence, F.lit(0))) * quality / 100)


def fit_label(value: Column) -> Column:
    out = F.when(value.isNull(), fx.FIT_LABEL_UNSCORED)
    for limit, label in fx.FIT_LABELS:
        out = out.when(value >= limit, label)
    return out


def evaluate(pairs: DataFrame, covered: str, length: str, keep: Sequence[str]) -> DataFrame:
    """Full result for given (résumé, job) pairs: ``covered`` is the résumé's folded labels, groups are label lists."""
    groups = ("mandatory", "preferred", "context")
    # every label is folded once, every group is matched once; the score refers to the counts many times
    pairs = pairs.withColumns({f"_folded_{g}": F.transform(g, tx.fold_caseless) for g in groups})
    has = lambda g, i: F.array_contains(covered, F.get(F.col(f"_folded_{g}"), i))

    def kept(g: str, wanted: bool) -> Column:
        return F.filter(g, lambda v, i: has(g, i) if wanted else ~has(g, i))

    pairs = pairs.withColumns({f"_has_{g}": kept(g, True) for g in groups} | {f"_lacks_{g}": kept(g, False) for g in groups[:2]})
    matched, missing = {g: F.col(f"_has_{g}") for g in groups}, {g: F.col(f"_lacks_{g}") for g in groups[:2]}
    counts = [c for g in ("mandatory", "preferred", "context") for c in (F.size(matched[g]), F.size(g))]
    usable = F.col("scoreable")
    value = F.when(usable, score(*counts, F.col("confidence")))
    none = F.array().cast("array<string>")
    return pairs.select(
        *keep,
        value.alias("score"),
        F.when(usable, coverage(F.col("confidence"), resume_quality(F.col(length)))).alias("coverage"),
        F.array_distinct(F.concat(*matched.values())).alias("matched"),
        F.when(usable, F.array_distinct(missing["mandatory"])).otherwise(none).alias("gaps"),
        F.when(usable, F.array_distinct(missing["preferred"])).otherwise(none).alias("optional_missing"),
        F.col("manual"),
        F.when(usable, "scored").otherwise("insufficient").alias("status"),
        fit_label(value).alias("label"),
    )


# ---------------------------------------------------------------- ranking

#: Most frequent terms that are put last in every profile, and cells of postings that are cut; both are fixed numbers of rows.
FREQUENT_TERMS = 200
HOT_CELLS = 1000
#: Postings per term that a first round reads, as a multiple of ``k``.
SEEDS = 4

_GROUPS = ("m", "p", "c")


def profiles(jobs: DataFrame, k: int, order: Sequence[str], keep=materialize) -> tuple[DataFrame, DataFrame]:
    """Distinct requirement profiles, and the first ``k`` jobs of each.

    ``jobs``: ``url``, ``order`` columns, ``m``, ``p``, ``c`` (arrays of terms) and ``q``.  Returns (profile, m, p, c, q, jobs,
    lead), where ``lead`` numbers the profiles by their first job, and (profile, url, …order).
    """
    shape = F.struct(*[F.array_sort(g).alias(g) for g in _GROUPS], F.coalesce("q", F.lit(0)).alias("q"))
    keyed = jobs.select("url", *[c for c in order if c != "url"], shape.alias("_shape"))
    # read twice from here on: deriving the terms from text is the expensive part
    keyed = keep(keyed.withColumn("profile", F.sha2(F.to_json("_shape"), 256)))
    members = top_per_group(keyed.drop("_shape"), ["profile"], [F.asc(c) for c in order], k)
    first = F.min(F.struct(*order)).alias("_first")
    distinct = keep(keyed.groupBy("profile").agg(F.first("_shape").alias("_shape"), F.count(F.lit(1)).alias("jobs"), first))
    distinct = distinct.select("profile", "_shape.*", "jobs", "_first")
    return places(distinct, [F.col("_first"), F.col("profile")], "lead", columns=["profile", *_GROUPS, "q", "jobs"], keep=keep), members


def postings(distinct: DataFrame) -> DataFrame:
    """``term, bound, at, terms`` and the profile's columns, one row per profile and term it asks for.

    The terms of a profile are ordered, frequent ones last.  ``bound`` is the score if the term and all after it are covered
    and none before it is, so it is what the profile can reach at most where this term is the first one that is covered.
    Scores grow with every covered term, caps and rounding included, which makes the bound exact.
    """
    used = distinct.select(F.explode(F.array_distinct(F.concat(*_GROUPS))).alias("term")).groupBy("term").count()
    frequent = [r["term"] for r in used.orderBy(F.desc("count"), "term").limit(FREQUENT_TERMS).collect()]
    ranks = F.create_map(*[F.lit(x) for i, t in enumerate(frequent) for x in (t, FREQUENT_TERMS - i)]) if frequent else None
    rank_of = (lambda t: F.coalesce(ranks[t], F.lit(0))) if frequent else (lambda t: F.lit(0))
    times = lambda g, t: F.size(F.filter(g, lambda x: x == t)).alias(g)
    entry = lambda t: F.struct(rank_of(t).alias("rank"), t.alias("term"), *[times(g, t) for g in _GROUPS])
    ordered = distinct.withColumn("_ordered", F.array_sort(F.transform(F.array_distinct(F.concat(*_GROUPS)), entry)))

    def total(entries: Column, g: str) -> Column:
        return F.aggregate(entries, F.lit(0), lambda n, y: n + y[g]).alias(g)

    def posting(x: Column, i: Column) -> Column:
        left = [total(F.slice("_ordered", i + 1, F.size("_ordered")), g) for g in _GROUPS]
        return F.struct(x["term"].alias("term"), i.alias("at"), F.struct(*left).alias("left"))

    rows = ordered.withColumn("terms", F.transform("_ordered", lambda x: x["term"])).withColumn("_all", F.transform("_ordered", posting))
    rows = rows.select("profile", *_GROUPS, "q", "lead", "terms", F.inline("_all"))
    counts = [c for g in _GROUPS for c in (F.col(f"left.{g}"), F.size(g))]
    return rows.withColumn("bound", score(*counts, F.col("q"))).drop("left")


def _scored(met: DataFrame) -> DataFrame:
    """``person, profile, lead, score, coverage`` of (résumé group, posting) rows, each pair once: at its first covered term."""
    covers = lambda x: F.array_contains("have", x)
    first = met.filter(~F.exists(F.slice("terms", F.lit(1), F.col("at")), covers))
    counts = [c for g in _GROUPS for c in (F.size(F.filter(g, covers)), F.size(g))]
    value = first.withColumn("score", score(*counts, F.col("q"))).withColumn("coverage", coverage(F.col("q"), F.col("quality")))
    return value.filter(F.col("score") > 0)


_BEST_FIRST = [("score", "desc"), ("coverage", "desc"), ("lead", "asc")]


def _best_first() -> list[Column]:
    return [getattr(F, way)(name) for name, way in _BEST_FIRST]


def floors(people: DataFrame, listed: DataFrame, k: int) -> DataFrame:
    """``person, floor_score, floor_coverage, floor_lead``: the ``k``-th best of a first look at the head of each term's postings.

    Any ``k`` profiles give a valid floor.  The heads are at most ``SEEDS`` times ``k`` rows per term.
    """
    head = top_per_group(listed, ["term"], [F.desc("bound"), F.desc("q"), F.asc("lead")], SEEDS * k)
    seen = _scored(people.join(head, "term"))
    place = F.row_number().over(Window.partitionBy("person").orderBy(*_best_first()))
    kth = seen.select("person", "score", "coverage", "lead").withColumn("_place", place).filter(F.col("_place") == k)
    return kth.select("person", *[F.col(c).alias(f"floor_{c}") for c, _ in _BEST_FIRST])


def reachable_pairs(people: DataFrame, listed: DataFrame, floor: DataFrame) -> DataFrame:
    """Scored (résumé group, profile) pairs that can be among the best ``k``: the rest of the postings is never met.

    Postings of a term fall into cells of equal bound and confidence, so a cell's bound tells whether a résumé group has to read
    it.  Needed cells are looked up in the small table of cells, and only those are joined.  A cell with more than a thousandth of
    all postings (there are at most ``HOT_CELLS``) is cut into pieces by a hash of the profile.
    """
    cell = ["term", "bound", "q"]
    cells = listed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    total = listed.count()
    pieces = F.greatest(F.lit(1), F.ceil(F.col("_n") * HOT_CELLS / max(total, 1))).cast("int").alias("pieces")
    hot = F.broadcast(cells.filter(F.col("_n") * HOT_CELLS > total).select(*cell, pieces))
    known = people.join(floor, "person", "left")
    reach = coverage(F.col("q"), F.col("quality"))
    better = F.col("floor_score").isNull() | (F.col("bound") > F.col("floor_score"))
    level = (F.col("bound") == F.col("floor_score")) & (reach >= F.col("floor_coverage"))
    needed = known.join(cells, "term").filter((F.col("bound") > 0) & (better | level)).join(hot, cell, "left")
    needed = needed.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))).drop("_n", "pieces")
    cut = listed.join(hot, cell, "left").withColumn("_piece", F.pmod(F.xxhash64("profile"), F.coalesce("pieces", F.lit(1))).cast("int")).drop("pieces")
    met = needed.join(cut, [*cell, "_piece"])
    # at the floor itself only profiles that come earlier can still get in
    met = met.filter(better | (reach > F.col("floor_coverage")) | (F.col("lead") <= F.col("floor_lead")))
    return _scored(met).select("person", "profile", "lead", "score", "coverage")


def rank(
    resumes: DataFrame, jobs: DataFrame, k: int = 30, resume_id: str = "resume_id", order: Sequence[str] = ("title", "url"), keep=materialize,
) -> DataFrame:
    """Best ``k`` jobs per résumé by score, coverage, then ``order`` columns.  Exact.

    ``resumes``: ``resume_id``, ``terms`` (array), ``length``.  ``jobs``: see ``profiles``; every row is scoreable.
    ``keep`` materialises the relations that several branches read.
    """
    if "title" in order:  # titles compare without case and accents first
        jobs = jobs.withColumn("title_order", tx.fold_search("title"))
        order = [x for c in order for x in (("title_order", c) if c == "title" else (c,))]
    distinct, members = profiles(jobs, k, order, keep)
    distinct, members = keep(distinct), keep(members)
    # résumés with the same terms and quality share their scores as well
    people = resumes.select(
        resume_id, F.array_sort(F.array_distinct("terms")).alias("have"), resume_quality(F.col("length")).alias("quality")
    ).withColumn("person", F.sha2(F.concat_ws("\x1f", F.col("quality").cast("string"), F.to_json("have")), 256))
    people = keep(people)
    groups = people.groupBy("person", "quality").agg(F.first("have").alias("have"))
    asking = keep(groups.withColumn("term", F.explode("have")))
    listed = keep(postings(distinct))
    scored = reachable_pairs(asking, listed, floors(asking, listed, k))
    # a row among the best k belongs to a profile whose first job is among the best k first jobs
    near = keep(top_per_group(scored, ["person"], _best_first(), k))
    columns = ["person", "url", *[c for c in order if c != "url"], "score", "coverage"]
    overlapping = near.join(members, "profile").select(*columns)
    both = overlapping.unionByName(_zero_scores(groups, near, distinct, members, k, columns))
    final = [F.desc("score"), F.desc("coverage"), *[F.asc(c) for c in order]]
    place = F.row_number().over(Window.partitionBy("person").orderBy(*final))
    best = both.withColumn("place", place).filter(F.col("place") <= k)
    return people.select(resume_id, "person").join(best, "person").drop("person")


def _zero_scores(groups: DataFrame, near: DataFrame, distinct: DataFrame, members: DataFrame, k: int, columns: Sequence[str]) -> DataFrame:
    """Rows with score zero for persons whose scoring profiles do not fill ``k`` places; nobody else needs them.

    Among those rows only coverage and order count.  Such a person has fewer than ``k`` scoring profiles, so the best
    ``2k`` profiles per résumé quality always contain the ``k`` free ones that matter.
    """
    reached = near.join(distinct.select("profile", "jobs"), "profile").groupBy("person").agg(F.sum("jobs").alias("_have"))
    short = groups.join(reached, "person", "left").filter(F.coalesce("_have", F.lit(0)) < k).select("person", "quality")
    tiers = distinct.select("profile", "q", "lead", F.explode(F.lit([100, 80, 55, 30])).alias("quality"))
    tiers = tiers.select(
        "profile", "lead", "quality", F.lit(0).alias("score"), coverage(F.col("q"), F.col("quality")).alias("coverage")
    )
    best = top_per_group(tiers, ["quality"], [F.desc("coverage"), F.asc("lead")], 2 * k)
    # broadcast: 2k rows for each of four qualities
    free = short.join(F.broadcast(best), "quality").join(near.select("person", "profile"), ["person", "profile"], "left_anti")
    return free.join(members, "profile").select(*columns)


__all__ = [name for name in globals() if not name.startswith("_")]
