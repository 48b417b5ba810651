"""Requirement extraction: which taxonomy entries an advertisement demands, prefers or mentions.

Row-local from start to end.  One position search per row covers the text, the listed skills and the candidate
fragments; all decisions are native expressions over the offsets, so no row is multiplied and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fx
from jobloom.functions import text as tx
from jobloom.functions.positions import phrase_positions

_SEP = "\x1e"  # folded text never contains it
GROUPS = ("mandatory", "preferred", "context", "manual")


@dataclass(frozen=True)
class Entry:
    id: str
    label: str
    aliases: tuple[str, ...]
    kind: str


@dataclass(frozen=True)
class Cues:
    """Section markers and cue phrases, folded."""

    mandatory: Sequence[str] = fx.MANDATORY_MARKERS
    preferred: Sequence[str] = fx.PREFERRED_MARKERS
    stop: Sequence[str] = fx.STOP_MARKERS
    mandatory_cues: Sequence[str] = fx.MANDATORY_CUES
    preferred_cues: Sequence[str] = fx.PREFERRED_CUES


class Vocabulary:
    """A taxonomy as task-side constants.  Taxonomies are reference data of a bounded size."""

    def __init__(self, entries: Sequence[Entry], cues: Cues = Cues()):
        self.entries, self.cues = list(entries), cues
        phrases: list[tuple[str, bool, str, int]] = []
        for i, entry in enumerate(self.entries):
            for alias in entry.aliases:
                folded = tx.py_fold_caseless(alias)
                phrases.append((folded, tx.needs_boundary(folded), "alias", i))
        for role, words in (
            ("M", cues.mandatory), ("P", cues.preferred), ("S", cues.stop),
        ):
            for i, word in enumerate(words):
                phrases.append((word, tx.needs_boundary(word), role, i))
        self.phrases = phrases

    @classmethod
    def from_frame(cls, taxonomy: DataFrame, cues: Cues = Cues()) -> "Vocabulary":
        """From a small taxonomy frame in file order (see ``sources.reference``)."""
        rows = taxonomy.select("entry_ord", "id", "label", "aliases", "kind").orderBy("entry_ord").collect()
        return cls([Entry(r["id"], r["label"] or r["id"], tuple(r["aliases"] or ()), r["kind"] or "") for r in rows], cues)

    def hits(self, text: Column) -> Column:
        """Positions of aliases and section markers, with the context each is in (see ``_decide``)."""
        c = self.cues
        contexts = (c.preferred, c.mandatory, c.preferred_cues, c.mandatory_cues)
        return phrase_positions(text, [p[0] for p in self.phrases], [p[1] for p in self.phrases], contexts, fx.CONTEXT_CHARS)

    def ids(self, role: str) -> tuple[int, int]:
        """Phrase numbers of one role are contiguous: first and one past last."""
        numbers = [n for n, p in enumerate(self.phrases) if p[2] == role]
        return (numbers[0], numbers[-1] + 1) if numbers else (0, 0)


def _of_role(hits: Column, span: tuple[int, int], upto: Column) -> Column:
    return F.filter(hits, lambda h: (h["phrase"] >= span[0]) & (h["phrase"] < span[1]) & (h["end"] <= upto))


def _earliest(hits: Column) -> Column:
    """Earliest hit; the marker listed first wins a tie."""
    return F.array_min(F.transform(hits, lambda h: F.struct(h["start"], h["phrase"], h["end"])))


def _after(starts: Column, position: Column) -> Column:
    return F.array_min(F.filter(starts, lambda s: s > position))


def sections(hits: Column, length: Column, vocabulary: Vocabulary) -> Column:
    """Struct with the mandatory and preferred ranges of folded text; ranges are NULL when there is no marker."""
    first, last = vocabulary.ids("S")
    # only the first occurrence of each stop marker ends a section
    first_stops = F.array_compact(
        F.array(*[F.array_min(F.transform(_of_role(hits, (i, i + 1), length), lambda h: h["start"])) for i in range(first, last)])
    ) if last > first else F.array().cast("array<int>")
    found = F.struct(
        _earliest(_of_role(hits, vocabulary.ids("M"), length)).alias("m"),
        _earliest(_of_role(hits, vocabulary.ids("P"), length)).alias("p"),
        first_stops.alias("stops"),
        length.alias("n"),
    )

    def ranges(e: Column) -> Column:
        mandatory, preferred, stops, n = e["m"], e["p"], e["stops"], e["n"]
        m_end = F.least(
            _after(stops, mandatory["end"]), F.when(preferred["start"] > mandatory["end"], preferred["start"])
        )
        return F.struct(
            mandatory["end"].alias("mandatory_start"),
            F.when(mandatory.isNotNull(), F.coalesce(m_end, n)).alias("mandatory_end"),
            preferred["end"].alias("preferred_start"),
            F.when(preferred.isNotNull(), F.coalesce(_after(stops, preferred["end"]), n)).alias("preferred_end"),
            preferred["start"].alias("preferred_marker"),
        )

    return tx.once(found, ranges)


def _decide(preferred: Column, mandatory: Column, preferred_cue: Column, mandatory_cue: Column) -> Column:
    return (
        F.when(preferred > mandatory, "preferred")
        .when(mandatory >= 0, "mandatory")
        .when(preferred_cue > mandatory_cue, "preferred")
        .when(mandatory_cue >= 0, "mandatory")
        .otherwise("context")
    )


def _last_in(window: Column, words: Sequence[str]) -> Column:
    """Start of the last occurrence of any word in a short text, -1 if none."""
    backwards = F.reverse(window)
    found = [
        F.when(F.instr(backwards, w[::-1]) > 0, F.length(window) - F.instr(backwards, w[::-1]) + 1 - len(w)).otherwise(-1)
        for w in words
    ]
    return F.array_max(F.array(*found)) if found else F.lit(-1)


def context_kind(window: Column, cues: Cues = Cues()) -> Column:
    """``preferred`` / ``mandatory`` / ``context`` from the folded text before a position.

    The last section marker decides; without one, the last cue phrase.
    """
    return _decide(
        _last_in(window, cues.preferred), _last_in(window, cues.mandatory),
        _last_in(window, cues.preferred_cues), _last_in(window, cues.mandatory_cues),
    )


def mention_kinds(hits: Column, vocabulary: Vocabulary) -> Column:
    """``array<struct<phrase, start, kind>>``: every mention of an alias with the kind that the text before it gives.

    The same decision as ``context_kind``, taken at all mentions from the one pass that located them.
    """
    first, last = vocabulary.ids("alias")
    aliases = F.filter(hits, lambda h: (h["phrase"] >= first) & (h["phrase"] < last))
    kind = lambda h: _decide(*[h["before"][i] for i in range(4)])
    return F.transform(aliases, lambda h: F.struct((h["phrase"] - first).alias("phrase"), h["start"].alias("start"), kind(h).alias("kind")))


# ---------------------------------------------------------------- fragments outside the taxonomy


def _strip_marks(c: Column) -> Column:
    return F.regexp_replace(c, r"^[ \-:/()]+|[ \-:/()]+$", "")


def is_meaningful(fragment: Column) -> Column:
    """Short, informative and either brief or technical-looking."""
    clean = _strip_marks(tx.fold_caseless(fragment))
    words = F.regexp_extract_all(clean, F.lit(r"([a-z0-9+#./-]+)"), 1)
    informative = F.exists(words, lambda w: ~w.isin(*fx.UNKNOWN_GENERIC) & (F.length(w) > 1))
    technical = F.exists(words, lambda w: w.rlike(r"[+#./0-9]"))
    return F.length(clean).between(2, 72) & informative & (F.size(words) <= 7) & ((F.size(words) < 5) | technical)


def cue_matches(description: Column, cues: Cues = Cues(), pattern: str = fx.UNKNOWN_CUE) -> Column:
    """``array<struct<kind, parts>>``: every cue phrase with its kind and the fragments it introduces."""
    text = tx.text_or_blank(description)
    pieces = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), 0).alias("whole"), F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), 1).alias("tails"),
    )
    return tx.once(pieces, lambda e: _introduced(e["whole"], e["gaps"], e["tails"], cues))


def _introduced(whole: Column, gaps: Column, tails: Column, cues: Cues) -> Column:
    start = F.struct(F.lit("").alias("before"), F.lit(0).alias("i"), F.array().cast("array<string>").alias("windows"))

    def step(acc: Column, match: Column) -> Column:
        before = F.concat(acc["before"], F.get(gaps, acc["i"]))
        window = F.right(before, F.lit(fx.CONTEXT_CHARS))
        return F.struct(
            F.right(F.concat(window, match), F.lit(fx.CONTEXT_CHARS)).alias("before"),
            (acc["i"] + 1).alias("i"),
            F.concat(acc["windows"], F.array(window)).alias("windows"),
        )

    windows = F.aggregate(whole, start, step, lambda acc: acc["windows"])

    def fragment(window: Column, tail: Column) -> Column:
        kind = tx.once(tx.fold_caseless(window), lambda w: context_kind(w, cues))
        parts = F.transform(
            F.split(tail, fx.UNKNOWN_SPLIT),
            lambda p: _strip_marks(tx.strip(F.regexp_replace(tx.strip(p), fx.UNKNOWN_ADJECTIVE, ""))),
        )
        return F.struct(
            tx.once(kind, lambda k: F.when(k == "context", "mandatory").otherwise(k)).alias("kind"),
            F.filter(parts, is_meaningful).alias("parts"),
        )

    return F.zip_with(windows, tails, fragment)


def unknown_requirements(matches: Column, covered: Column, enough: int = 10) -> Column:
    """``array<struct<label, folded, kind>>`` of fragments no alias covers, first spelling kept.

    ``covered`` holds folded fragments that an alias matches.  Collection stops after the cue phrase that reaches
    ``enough``, so the result can be a little longer.
    """
    return tx.once(F.struct(matches.alias("m"), covered.alias("c")), lambda e: _uncovered(e["m"], e["c"], enough))


def _uncovered(matches: Column, covered: Column, enough: int) -> Column:
    empty = F.from_json(F.lit("[]"), "array<struct<label:string,folded:string,kind:string>>")

    def step(acc: Column, match: Column) -> Column:
        fresh = F.transform(
            match["parts"],
            lambda p: F.struct(
                F.substring(p, 1, 72).alias("label"), tx.fold_caseless(p).alias("folded"), match["kind"].alias("kind")
            ),
        )
        fresh = F.filter(fresh, lambda f: ~F.array_contains(covered, f["folded"]))
        added = F.aggregate(
            fresh, acc,
            lambda a, f: F.when(F.exists(a, lambda e: tx.fold_caseless(e["label"]) == f["folded"]), a).otherwise(F.concat(a, F.array(f))),
        )
        return F.when(F.size(acc) >= enough, acc).otherwise(added)

    return F.aggregate(matches, empty, step)


# ---------------------------------------------------------------- the extraction plan


def reconcile(mandatory: Column, preferred: Column, context: Column, manual: Column, sql_stands_alone: Column) -> dict[str, Column]:
    """A requirement belongs to its strongest group; ``SQL`` goes when only ``PL/SQL`` is asked for; groups are cut."""
    def without(values: Column, known: Column) -> Column:
        pair = F.struct(values.alias("v"), F.transform(known, tx.fold_caseless).alias("k"))
        return tx.once(pair, lambda e: F.filter(e["v"], lambda v: ~F.array_contains(e["k"], tx.fold_caseless(v))))

    kept_preferred = without(preferred, mandatory)
    kept_context = without(context, F.concat(mandatory, preferred))
    drop_sql = F.array_contains(mandatory, "PL/SQL") & F.array_contains(mandatory, "SQL") & ~sql_stands_alone
    kept_mandatory = F.when(drop_sql, F.array_remove(mandatory, "SQL")).otherwise(mandatory)
    values = dict(zip(GROUPS, (kept_mandatory, kept_preferred, kept_context, manual)))
    return {name: F.slice(values[name], 1, fx.GROUP_LIMITS[name]) for name in GROUPS}


def confidence(has_section: Column, has_skills: Column, mandatory: Column, preferred: Column, context: Column) -> Column:
    """How much the extraction can be trusted, from 20 to 95 (sizes of the groups, not the groups)."""
    extracted = mandatory + preferred + context
    return (
        F.when(has_section & (mandatory >= 3), 95)
        .when(has_section & (extracted >= 2), 85)
        .when(has_skills & (extracted >= 2), 75)
        .when(extracted >= 3, 65)
        .when(extracted > 0, 45)
        .otherwise(20)
    )


def with_hits(jobs: DataFrame, vocabulary: Vocabulary, pattern: str = fx.UNKNOWN_CUE) -> DataFrame:
    """Add folded text, segment limits, cue matches (of ``pattern``) and all phrase positions."""
    folded = jobs.withColumns(
        {
            "_text": tx.fold_caseless("description"),
            "_skills": tx.fold_caseless(F.array_join(F.coalesce(F.col("skills"), F.array().cast("array<string>")), " ")),
            "_cues": cue_matches(F.col("description"), vocabulary.cues, pattern),
        }
    )
    folded = folded.withColumn(
        "_parts", F.array_distinct(F.transform(F.flatten(F.transform("_cues", lambda m: m["parts"])), tx.fold_caseless))
    )
    segments = F.concat_ws(_SEP, F.col("_text"), F.col("_skills"), F.array_join("_parts", _SEP))
    return folded.withColumns({"_n": F.length("_text"), "_hits": vocabulary.hits(segments)})


def covered_fragments(vocabulary: Vocabulary) -> Column:
    """Folded fragments in which some alias was found, by locating each hit's segment."""
    first, last = vocabulary.ids("alias")
    offset = F.col("_n") + F.length("_skills") + 2
    late = F.filter(
        F.col("_hits"), lambda h: (h["phrase"] >= first) & (h["phrase"] < last) & (h["start"] >= offset)
    )
    known = F.struct(late.alias("late"), F.col("_parts").alias("parts"), offset.alias("offset"))

    def walk(e: Column) -> Column:
        start = F.struct(e["offset"].alias("at"), F.array().cast("array<string>").alias("covered"))

        def step(acc: Column, part: Column) -> Column:
            end = acc["at"] + F.length(part)
            found = F.exists(e["late"], lambda h: (h["start"] >= acc["at"]) & (h["end"] <= end))
            return F.struct(
                (end + 1).alias("at"),
                F.when(found, F.concat(acc["covered"], F.array(part))).otherwise(acc["covered"]).alias("covered"),
            )

        return F.aggregate(e["parts"], start, step, lambda acc: acc["covered"])

    return tx.once(known, walk)


def _hit_rank(hit: Column, s: Column, text: Column) -> Column:
    """1 mandatory, 2 preferred, 3 context for one alias occurrence."""
    at, marker = hit["start"], s["preferred_marker"]
    in_preferred = F.coalesce((at >= s["preferred_start"]) & (at < s["preferred_end"]), F.lit(False))
    in_mandatory = F.coalesce((at >= s["mandatory_start"]) & (at < s["mandatory_end"]), F.lit(False))
    close = F.coalesce((marker > 0) & (at < marker) & (marker - hit["end"]).between(1, fx.TAIL_CHARS), F.lit(False))
    leads_to_preferred = close & ~F.substring(text, hit["end"] + 1, marker - hit["end"]).rlike(r"[.!?]")
    kind = _decide(*[hit["before"][i] for i in range(4)])
    return (
        F.when(in_preferred, 2)
        .when(in_mandatory, F.when(leads_to_preferred, 2).otherwise(1))
        .otherwise(tx.once(kind, lambda k: F.when(k == "mandatory", 1).when(k == "preferred", 2).otherwise(3)))
    )


_LISTED, _MANUAL = 9, 4


def with_entry_ranks(located: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Add sections (``_s``) and ``_ranked``: ``array<struct<entry, rank>>`` in taxonomy order (4 = manual)."""
    staged = located.withColumn("_s", sections(F.col("_hits"), F.col("_n"), vocabulary))
    owner = F.lit([p[3] for p in vocabulary.phrases if p[2] == "alias"] or [0])
    manual = F.lit([e.kind == "manual" for e in vocabulary.entries] or [False])
    upto = F.col("_n") + F.length("_skills") + 1
    env = F.struct(
        _of_role(F.col("_hits"), vocabulary.ids("alias"), upto).alias("hits"), F.col("_s").alias("s"), F.col("_text").alias("text"), F.col("_n").alias("n")
    )

    def code(hit: Column, e: Column) -> Column:
        """Entry and rank of an occurrence in one number, so that repeats collapse cheaply."""
        entry = F.get(owner, hit["phrase"])
        rank = (
            F.when(hit["start"] > e["n"], _LISTED)  # among the listed skills
            .when(F.get(manual, entry), _MANUAL)
            .otherwise(_hit_rank(hit, e["s"], e["text"]))
        )
        return entry * 10 + rank

    codes = tx.once(env, lambda e: F.array_distinct(F.transform(e["hits"], lambda h: code(h, e))))

    def settle(entry: Column, every: Column) -> Column:
        ranks = F.transform(F.filter(every, lambda c: F.floor(c / 10) == entry), lambda c: (c % 10).cast("int"))

        def decide(r: Column) -> Column:
            best = F.array_min(r)
            return (
                F.when(F.get(manual, entry), F.when(best == _MANUAL, _MANUAL))
                .when(best <= 2, best)
                .when(F.array_contains(r, _LISTED), 1)
                .otherwise(best)
            )

        return F.struct(entry.alias("entry"), tx.once(ranks, decide).alias("rank"))

    def ranked(every: Column) -> Column:
        entries = F.array_sort(F.array_distinct(F.transform(every, lambda c: F.floor(c / 10).cast("int"))))
        return F.filter(F.transform(entries, lambda entry: settle(entry, every)), lambda e: e["rank"].isNotNull())

    return staged.withColumn("_ranked", tx.once(codes, ranked))


def extract(jobs: DataFrame, vocabulary: Vocabulary, keep: Sequence[str] = ("url",)) -> DataFrame:
    """``keep`` columns plus mandatory, preferred, context, manual and confidence for every job."""
    ranked = with_entry_ranks(with_hits(jobs, vocabulary), vocabulary)
    ranked = ranked.withColumn("_unknown", unknown_requirements(F.col("_cues"), covered_fragments(vocabulary)))
    labels = F.lit([e.label for e in vocabulary.entries] or [""])

    def group(rank: int, name: str) -> Column:
        known = F.transform(F.filter("_ranked", lambda e: e["rank"] == rank), lambda e: F.get(labels, e["entry"]))
        mined = F.transform(F.filter("_unknown", lambda u: u["kind"] == name), lambda u: u["label"])
        return F.array_distinct(F.concat(known, mined))

    grouped = ranked.withColumns({f"_g_{name}": group(i + 1, name) for i, name in enumerate(GROUPS)})
    without_plsql = tx.fold_caseless(F.replace(tx.text_or_blank("description"), F.lit("PL/SQL"), F.lit("")))
    final = reconcile(*[F.col(f"_g_{n}") for n in GROUPS], tx.has_alias(without_plsql, "sql"))
    settled = grouped.withColumns(final)
    return settled.select(
        *keep,
        *GROUPS,
        confidence(
            F.col("_s.mandatory_start").isNotNull(), F.col("_skills") != "",
            F.size("mandatory"), F.size("preferred"), F.size("context"),
        ).alias("confidence"),
    )


def build_index(jobs: DataFrame, vocabulary: Vocabulary, order: str, minimum: int = fx.MIN_DESCRIPTION_CHARS) -> DataFrame:
    """``url, ord, mandatory … confidence`` for jobs with enough text and at least one requirement.

    The last job per link wins.  The winner is chosen among qualifying rows on extracted (small) columns, so
    descriptions are never shuffled.
    """
    linked = jobs.withColumns({"url": tx.https_url(tx.strip("url")), "ord": F.col(order)})
    usable = linked.filter((F.col("url") != "") & (F.length(tx.fold_caseless("description")) >= minimum))
    found = extract(usable, vocabulary, keep=("url", "ord"))
    return best_per_link(found, F.col("ord"))


def best_per_link(found: DataFrame, order: Column) -> DataFrame:
    """Last row per link among those with a requirement."""
    # the others have no rank (a filter here would be evaluated twice)
    rank = F.when(F.size(F.concat(*GROUPS)) > 0, order)
    best = found.groupBy(F.col("url").alias("_url")).agg(F.max_by(F.struct(*found.columns), rank).alias("_row"))
    return best.filter(F.col("_row").isNotNull()).select("_row.*")


def _placed(columns: Sequence[str], value, name: str) -> Column:
    """Elements of several lists in one list of (group number, place, value)."""

    def of(number: int, column: str) -> Column:
        return F.transform(F.col(column), lambda v, i: F.struct(F.lit(number).alias("g"), i.alias("i"), value(v).alias(name)))

    return F.flatten(F.array(*[of(n, c) for n, c in enumerate(columns)]))


def index_terms(index: DataFrame) -> DataFrame:
    """``code, label``: one code per folded label, by first appearance over jobs in order, groups in order."""
    pieces = _placed(GROUPS, lambda v: v, "label")
    long = index.select("ord", F.inline(pieces))
    place = F.struct("ord", "g", "i")
    first = long.groupBy(tx.fold_caseless("label").alias("folded")).agg(
        F.min_by("label", place).alias("label"), F.min(place).alias("p")
    )
    flat = first.select("folded", "label", F.col("p.ord").alias("ord"), F.col("p.g").alias("g"), F.col("p.i").alias("i"))
    from jobloom.operators.ordering import codes_in_ranges

    return codes_in_ranges(flat, "ord", ["g", "i"]).select("code", "label", "folded")


def packed(index: DataFrame, terms: DataFrame) -> DataFrame:
    """``url, m, p, c, x, q`` with term codes instead of labels."""
    pieces = _placed(GROUPS, tx.fold_caseless, "folded")
    coded = index.select("url", F.inline(pieces)).join(terms.select("folded", "code"), "folded")
    lists = coded.groupBy(F.col("url").alias("_url")).agg(
        F.array_sort(F.collect_list(F.struct("g", "i", "code"))).alias("_codes")
    )
    codes = lambda n: F.transform(F.filter("_codes", lambda e: e["g"] == n), lambda e: e["code"])
    return index.join(lists, F.col("url") == F.col("_url")).select(
        "url", *[codes(n).alias(k) for n, k in enumerate("mpcx")], F.col("confidence").alias("q")
    )


def unpacked(entries: DataFrame, terms: DataFrame) -> DataFrame:
    """Packed entries back to labels through the term table; unknown codes are dropped."""
    pieces = _placed("mpcx", lambda v: v, "code")
    named = entries.select("url", F.inline(pieces)).join(terms.select("code", "label"), "code")
    lists = named.groupBy(F.col("url").alias("_url")).agg(
        F.array_sort(F.collect_list(F.struct("g", "i", "label"))).alias("_labels")
    )
    none = F.array().cast("array<string>")
    labels = lambda n: F.coalesce(F.transform(F.filter("_labels", lambda e: e["g"] == n), lambda e: e["label"]), none)
    return entries.join(lists, F.col("url") == F.col("_url"), "left").select(
        "url", *[labels(n).alias(g) for n, g in enumerate(GROUPS)], F.coalesce("q", F.lit(0)).alias("confidence"),
        F.lit(True).alias("scoreable"),
    )


def fallback(jobs: DataFrame, key: str = "url") -> DataFrame:
    """Requirements of jobs without indexed text: summary skills as context, never scored."""
    from jobloom.functions.arrays import skill_tokens

    none = F.array().cast("array<string>")
    return jobs.select(
        key, none.alias("mandatory"), none.alias("preferred"), skill_tokens(F.col("skills")).alias("context"),
        none.alias("manual"), F.lit(0).alias("confidence"), F.lit(False).alias("scoreable"),
    )
