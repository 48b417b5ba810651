"""Expectations: each gate is one pass that counts violations per rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fx
from jobloom.functions.dates import publication_cutoff
from jobloom.functions.text import strip, text_or_blank


class QualityError(RuntimeError):
    """At least one expectation failed."""


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``rule, violations`` from aggregate expressions or boolean row tests wrapped in ``count_if``."""
    wide = rows.agg(*[expr.cast("bigint").alias(name) for name, expr in rules.items()])
    pairs = [F.struct(F.lit(name).alias("rule"), F.coalesce(F.col(name), F.lit(0)).alias("violations")) for name in rules]
    return wide.select(F.inline(F.array(*pairs)))


def require(report: DataFrame) -> None:
    """Raise when a rule is violated.  The report has one row per rule."""
    failed = report.filter(F.col("violations") > 0).collect()
    if failed:
        raise QualityError("; ".join(f"{r['rule']}: {r['violations']}" for r in failed))


def _bad(test: Column) -> Column:
    return F.count_if(F.coalesce(test, F.lit(False)))


def snapshot_rules(today: Column, months: int = 2, minimum: int = 1) -> dict[str, Column]:
    """Rules over labelled snapshot rows."""
    cutoff = publication_cutoff(today, months)
    reopened = (F.col("source") == "gupy") & (text_or_blank("exp") != "") & (F.col("exp") >= today.cast("string"))
    return {
        "minimum_rows": F.greatest(F.lit(minimum) - F.count(F.lit(1)), F.lit(0)),
        "https_link": _bad(~text_or_blank("url").startswith("https://")),
        "older_than_cutoff": _bad((text_or_blank("pub") != "") & (F.col("pub") < cutoff) & ~reopened),
        "autozone_abroad": _bad((F.col("source") == "autozone") & (F.col("country") != "BR")),
        "script_in_title": _bad(F.lower(text_or_blank("title")).contains("<script")),
    }


#: Values whose dictionary codes the snapshot rules ask for.
RULED_VALUES = (("source", "gupy"), ("source", "autozone"), ("country", "BR"))
ENTRY_GROUPS = ("m", "p", "c", "x")


def coded_rules(codes: dict[tuple[str, str], int], today: Column, months: int = 2, minimum: int = 1) -> dict[str, Column]:
    """``snapshot_rules`` over rows that carry dictionary codes; ``codes`` has those of ``RULED_VALUES`` that occur."""
    gupy, autozone, brazil = (F.lit(codes.get(v)).cast("int") for v in RULED_VALUES)
    cutoff = publication_cutoff(today, months)
    reopened = F.coalesce((F.col("src") == gupy) & (text_or_blank("exp") != "") & (F.col("exp") >= today.cast("string")), F.lit(False))
    return {
        "minimum_rows": F.greatest(F.lit(minimum) - F.count(F.lit(1)), F.lit(0)),
        "https_link": _bad(~text_or_blank("url").startswith("https://")),
        "older_than_cutoff": _bad((text_or_blank("pub") != "") & (F.col("pub") < cutoff) & ~reopened),
        "autozone_abroad": _bad((F.col("src") == autozone) & ~F.col("co").eqNullSafe(brazil)),
        "script_in_title": _bad(F.lower(text_or_blank("title")).contains("<script")),
    }


def code_range(sizes: dict[str, int]) -> Column:
    """Rows with a code that its dictionary does not have."""
    known = [F.coalesce(F.col(c).between(0, sizes.get(d, 0) - 1), F.lit(False)) for d, c in fx.SNAPSHOT_DICTIONARIES.items()]
    fine = known[0]
    for test in known[1:]:
        fine = fine & test
    return _bad(~fine)


def header_rules() -> dict[str, Column]:
    """The cutoff that a snapshot names is the one its day and its age limit give."""
    expected = F.add_months(F.expr("try_cast(generated_date AS date)"), -F.col("max_age_months")).cast("string")
    return {"header_cutoff": _bad(~F.col("publication_cutoff").eqNullSafe(expected))}


def snapshot_shape(columns: list[str], dictionaries: list[str]) -> dict[str, int]:
    """Schema rules: nothing private, nothing missing."""
    return {
        "private_columns": len(set(fx.SNAPSHOT_FORBIDDEN) & set(columns)),
        "missing_columns": len(set(fx.SNAPSHOT_COLUMNS) - set(columns)),
        "missing_dictionaries": len(set(fx.SNAPSHOT_DICTIONARIES) - set(dictionaries)),
    }


def words(c: Column) -> Column:
    """Number of white-space separated words."""
    trimmed = strip(text_or_blank(c))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"\s+")))


def many_digits(text: Column, least: int = 9) -> Column:
    return F.length(text) - F.length(F.translate(text, "0123456789", "")) >= least


def term_rules(label: Column) -> dict[str, Column]:
    """Rules over index terms: short, and nothing that looks like personal data."""
    text = text_or_blank(label)
    return {
        "term_too_long": _bad(F.length(text) > 80),
        # a number of nine digits needs nine digits, which is cheaper to see than the pattern
        "term_personal_data": _bad((text.contains("@") & text.rlike(fx.EMAIL)) | (many_digits(text) & text.rlike(fx.PHONE))),
        "term_many_words": _bad(words(text) > 12),
    }


def entry_rules(terms: int, metadata: dict[str, int] | None = None) -> dict[str, Column]:
    """Rules over packed index entries."""
    rules = {
        "entry_link": _bad(~text_or_blank("url").startswith("https://")),
        "confidence_range": _bad(~F.coalesce(F.col("q"), F.lit(0)).between(0, 100)),
        "code_range": _bad(F.exists(F.concat(*ENTRY_GROUPS), lambda i: (i < 0) | (i >= terms))),
    }
    for name, limit in (metadata or {}).items():
        value = text_or_blank(name)
        rules[f"metadata_{name}"] = _bad(
            (F.length(value) > limit) | F.lower(value).contains("description") | (words(value) > 28)
        )
    return rules


def staging_rules(link: str = fx.STAGING_URL, unique: bool = True) -> dict[str, Column]:
    """Rules over staging rows; uniqueness is rows minus distinct identifiers (leave it out where the writer checks keys)."""
    allowed = [label for label, _ in fx.STAGING_WORKPLACE] + [fx.STAGING_WORKPLACE_OTHER]
    blank = F.lit(False)
    for name in fx.STAGING_REQUIRED:
        blank = blank | (strip(text_or_blank(name)) == "")
    return {
        "blank_required": _bad(blank),
        **({"repeated_id": F.count("id") - F.countDistinct("id")} if unique else {}),
        "workplace_domain": _bad(~F.col("workplaceType").isin(*allowed)),
        "demo_tenant": _bad(F.lower(strip(text_or_blank("company"))) == "demo"),
        "link_pattern": _bad(~text_or_blank("url").rlike(link)),
        "missing_lists": _bad(F.col("contractTypes").isNull() | F.col("alerts").isNull()),
    }


def forbidden_columns(columns: list[str], forbidden=fx.STAGING_FORBIDDEN) -> int:
    return len(set(forbidden) & set(columns))


def complete_catalogs(counts: DataFrame) -> DataFrame:
    """Accept or reject each source's catalog.

    ``counts`` has ``source, got, minimum, reported, pages_got, pages_total``; NULL expectations do not apply.
    """
    enough = F.coalesce(F.col("got") >= F.col("minimum"), F.lit(True))
    whole = F.coalesce((F.col("reported") == 0) | (F.col("got") >= F.col("reported")), F.lit(True))
    pages = F.coalesce(
        (F.col("pages_got") >= F.col("pages_total"))
        | (F.col("pages_got") >= F.greatest(F.lit(2), F.floor(F.col("pages_total") / 2))),
        F.lit(True),
    )
    return counts.withColumn("accepted", enough & whole & pages)


def accepted_rows(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of accepted catalogs (verdicts: one row per source)."""
    return rows.join(verdicts.filter("accepted").select("source"), "source", "left_semi")


def private_text_leaks(rows: DataFrame, columns: list[str], private: str) -> DataFrame:
    """How many rows repeat their private text in a public column."""
    inside = F.lit(False)
    for name in columns:
        inside = inside | F.col(name).contains(F.col(private))
    return rows.agg(_bad((F.length(private) > 0) & inside).alias("leaks"))


__all__ = [name for name in globals() if not name.startswith("_")]
