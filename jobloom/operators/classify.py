"""Area, seniority and staging classification: ordered or scored patterns over folded text, all row-local."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fx
from jobloom.functions import text as tx

_PLAIN = re.compile(r"[a-z0-9 &-]+")
_ONE_WORD = re.compile(r"\\b([a-z0-9]+)\\b")
_SPACED = re.compile(r"([a-z0-9 -]*[a-z0-9]) \?([a-z0-9 -]+)")


def _hit(text: Column, pattern: str) -> Column:
    """Pattern test; literal patterns become substring tests and word patterns are guarded by one."""
    if _PLAIN.fullmatch(pattern):
        return text.contains(pattern)
    word = _ONE_WORD.fullmatch(pattern)
    if word:
        return text.contains(word.group(1)) & text.rlike(pattern)
    spaced = _SPACED.fullmatch(pattern)
    if spaced:
        left, right = spaced.groups()
        return text.contains(left + right) | text.contains(f"{left} {right}")
    return text.rlike(pattern)


def _first_mapped(values: Column, table: Mapping[str, str]) -> Column:
    mapped = F.transform(values, lambda v: tx.lookup(dict(table), F.trim(tx.fold_ascii(v))))
    return F.get(F.array_compact(mapped), F.lit(0))


def seniority(
    folded_title: Column,
    levels: Column,
    patterns: Sequence[tuple[str, str]] = fx.SENIORITY_PATTERNS,
    structured: Mapping[str, str] = fx.STRUCTURED_LEVELS,
) -> Column:
    """First structured level that is known, else the highest level named in the title."""
    padded = F.concat(F.lit(" "), folded_title, F.lit(" "))
    by_title = tx.first_label(padded, tuple(reversed(patterns)), fx.STAGING_SENIORITY_OTHER)
    return F.coalesce(_first_mapped(levels, structured), by_title)


def area(
    folded_title: Column,
    folded_lead: Column,
    categories: Column,
    patterns: Mapping[str, Sequence[str]] = fx.AREA_PATTERNS,
    structured: Mapping[str, str] = fx.STRUCTURED_CATEGORIES,
) -> Column:
    """First known category, else the best scoring area: 3 per pattern in the title, 1 per pattern in the lead.

    Below 3 points the area is ``Outros``; the earlier area wins a tie.
    """
    padded = F.concat(F.lit(" "), folded_title, F.lit(" "))
    scored = []
    for rank, (name, area_patterns) in enumerate(patterns.items()):
        points = F.lit(0)
        for pattern in area_patterns:
            points = points + F.when(_hit(padded, pattern), 3).otherwise(0) + F.when(_hit(folded_lead, pattern), 1).otherwise(0)
        scored.append(F.struct(points.alias("points"), F.lit(-rank).alias("rank"), F.lit(name).alias("name")))
    best = F.array_max(F.array(*scored))
    by_score = F.when(best["points"] >= 3, best["name"]).otherwise(fx.AREA_OTHER)
    return F.coalesce(_first_mapped(categories, structured), by_score)


def folded_lead(description: Column, chars: int = 600) -> Column:
    """The first characters of the folded text; folds only a head of it when that is already long enough."""
    head = tx.fold_ascii(F.substring(tx.text_or_blank(description), 1, 2 * chars))
    return F.when(F.length(head) >= chars, F.substring(head, 1, chars)).otherwise(
        F.substring(tx.fold_ascii(description), 1, chars)
    )


def with_classes(df: DataFrame, **vocabulary) -> DataFrame:
    """Add ``area`` and ``seniority`` to canonical rows."""
    seniority_args = {k: v for k, v in vocabulary.items() if k in ("levels", "level_map")}
    folded = df.withColumns(
        {"_title": tx.fold_ascii("title"), "_lead": folded_lead(F.col("description"))}
    )
    return folded.withColumns(
        {
            "area": area(
                F.col("_title"), F.col("_lead"), F.col("categories"),
                vocabulary.get("areas", fx.AREA_PATTERNS), vocabulary.get("category_map", fx.STRUCTURED_CATEGORIES),
            ),
            "seniority": seniority(
                F.col("_title"), F.col("levels"),
                seniority_args.get("levels", fx.SENIORITY_PATTERNS),
                seniority_args.get("level_map", fx.STRUCTURED_LEVELS),
            ),
        }
    ).drop("_title", "_lead")


# ---------------------------------------------------------------- staging rules


def _words(title: Column) -> Column:
    return F.concat(F.lit(" "), F.regexp_replace(tx.fold_search(title), "[^a-z0-9]+", " "), F.lit(" "))


def staging_category(title: Column, rules=fx.STAGING_CATEGORIES) -> Column:
    return tx.first_label(_words(title), rules, fx.AREA_OTHER)


def staging_seniority(title: Column, rules=fx.STAGING_SENIORITY) -> Column:
    """Other priorities than ``seniority``: internships first, leadership before senior."""
    return tx.first_label(_words(title), rules, fx.STAGING_SENIORITY_OTHER)


def _ascii_words(pattern: str) -> str:
    """Word limits between ASCII word characters only; Java's own also treat accented letters and ß as part of a word."""
    word = "[A-Za-z0-9_]"
    return pattern.replace(r"\b", f"(?:(?<={word})(?!{word})|(?<!{word})(?={word}))")


def language_level(description: Column, mention: str = fx.LANGUAGE_MENTION, levels=fx.LANGUAGE_LEVELS) -> Column:
    """Level named within a short distance after the language."""
    text = tx.fold_search(description)
    rules = [(label, _ascii_words(rf"{mention}.{{0,{reach}}}\b({words})\b")) for label, reach, words in levels]
    return F.when(~text.rlike(_ascii_words(mention)), fx.LANGUAGE_ABSENT).otherwise(tx.first_label(text, rules, fx.LANGUAGE_PLAIN))


def staging_workplace(raw: Column, rules=fx.STAGING_WORKPLACE) -> Column:
    rules = [(label, _ascii_words(pattern)) for label, pattern in rules]
    return tx.first_label(tx.fold_search(raw), rules, fx.STAGING_WORKPLACE_OTHER)


def _search_head(text: Column, chars: int) -> Column:
    """The first characters of the folded text; folds only a head of it when that is already long enough."""

    def cut(t: Column) -> Column:
        # a fold goes character by character: a head that stays longer than what is read gives the same as the whole
        head = tx.fold_search(F.substring(t, 1, 2 * chars))
        folded = tx.once(head, lambda h: F.when((F.length(t) <= 2 * chars) | (F.length(h) > chars + 100), h).otherwise(tx.fold_search(t)))
        return F.substring(folded, 1, chars)

    return tx.once(tx.text_or_blank(text), cut)


def stated_modality(text: Column, cues: str = fx.MODALITY_CUES, rules=fx.MODALITY_IN_TEXT, chars: int | None = None) -> Column:
    """Modality named at most 55 characters after a cue word, or blank; looked for in the whole text, or in its first ``chars`` folded characters."""
    # the words are looked for before the word limits, which take longer to test
    patterns = [(label, _ascii_words(rf"(?={cues})\b({cues})\b.{{0,55}}(?={words})\b({words})\b")) for label, words in rules]
    folded = tx.fold_search(text) if chars is None else _search_head(text, chars)
    return tx.once(folded, lambda f: tx.first_label(f, patterns, ""))


def contradiction_alerts(
    title: Column, location: Column, description: Column, workplace: Column, detail_loaded: Column,
    title_chars: int | None = fx.MODALITY_TEXT_CHARS, **vocabulary,
) -> Column:
    """Messages about what the reader should double-check; descriptions are read whole, titles to ``title_chars``, whole if that is None."""
    found = F.struct(
        stated_modality(F.concat(F.lit("modalidade "), tx.text_or_blank(title)), chars=title_chars, **vocabulary).alias("title"),
        stated_modality(description, **vocabulary).alias("text"), tx.fold_search(location).alias("place"),
        workplace.alias("workplace"), location.alias("location"), detail_loaded.alias("loaded"),
    )
    return tx.once(found, _alerts)


def _alerts(e: Column) -> Column:
    in_title, in_text, place, workplace = e["title"], e["text"], e["place"], e["workplace"]
    known = workplace != fx.STAGING_WORKPLACE_OTHER
    return F.array_distinct(
        F.array_compact(
            F.array(
                F.when(~known, fx.ALERT_NO_MODALITY),
                F.when(
                    (in_title != "") & known & (in_title != workplace),
                    F.format_string(fx.ALERT_TITLE, F.lower(in_title), F.lower(workplace)),
                ),
                F.when((in_text != "") & known & (in_text != workplace), F.format_string(fx.ALERT_TEXT, F.lower(in_text))),
                F.when(
                    (workplace == "Remoto") & (place != "") & ~place.rlike(fx.REMOTE_ELIGIBLE_ANYWHERE),
                    F.format_string(fx.ALERT_PLACE, tx.clean_text(e["location"], 100)),
                ),
                F.when(~F.coalesce(e["loaded"], F.lit(False)), fx.ALERT_NO_DETAIL),
            )
        )
    )


def market_of_place(place: Column, brazil=fx.MARKET_BRAZIL_WORDS, remote=fx.MARKET_REMOTE_WORDS) -> Column:
    """``country, market`` struct from location text."""
    text = F.lower(tx.text_or_blank(place))
    home, away = tx._has_any(text, tuple(brazil)), tx._has_any(text, tuple(remote))
    return F.struct(
        F.when(home, "BR").otherwise(tx.text_or_blank(place)).alias("country"),
        F.when(home, "BR").when(away, "Global remote").otherwise("Global").alias("market"),
    )


def multiplicity_work_model(locations: Column) -> Column:
    """Many places mean remote, one named place means on site, only the country means remote."""
    named = F.filter(locations, lambda v: ~F.lower(v).isin(*fx.BRAZIL_CODES))
    many = (F.size(named) > 1) | F.exists(named, lambda v: F.lower(v).isin(*fx.MULTIPLE_LOCATION_LABELS))
    return F.when(many, "remote").when(F.size(named) > 0, "on-site").otherwise("remote")


def multiplicity_place(locations: Column, work_model: Column) -> Column:
    named = F.filter(locations, lambda v: ~F.lower(v).isin(*fx.BRAZIL_CODES, *fx.MULTIPLE_LOCATION_LABELS))
    first = F.coalesce(F.get(named, F.lit(0)), F.lit("Brasil"))
    return F.when(work_model == "remote", "Brasil").otherwise(first)
