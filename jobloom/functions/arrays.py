"""List functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobloom.functions.text import strip, text_or_blank

SEPARATOR = " · "


def trimmed_distinct(values: Column) -> Column:
    """Trimmed, blanks dropped, first occurrence of each kept in order."""
    kept = F.filter(F.transform(values, lambda v: strip(text_or_blank(v))), lambda v: v != "")
    return F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))


def trimmed(values: Column) -> Column:
    """Trimmed and blanks dropped, repeats kept."""
    kept = F.filter(F.transform(values, lambda v: strip(text_or_blank(v))), lambda v: v != "")
    return F.coalesce(kept, F.array().cast("array<string>"))


def first_n(values: Column, n: int) -> Column:
    return F.slice(values, 1, n)


def singleton(value: Column) -> Column:
    """One-element list, or an empty list for blank."""
    return F.filter(F.array(text_or_blank(value)), lambda v: v != "")


def joined(values: Column, limit: int) -> Column:
    """Distinct values joined with a middle dot and cut."""
    return F.substring(F.array_join(F.array_distinct(F.coalesce(values, F.array().cast("array<string>"))), SEPARATOR), 1, limit)


def unjoined(text: Column) -> Column:
    return F.filter(F.split(text_or_blank(text), SEPARATOR), lambda v: v != "")


def skill_tokens(text: Column, limit: int = 12) -> Column:
    """Skills of a summary text, 2 to 72 characters each, distinct, first ``limit``."""
    parts = F.transform(F.split(text_or_blank(text), r"(?U)\s*[·|;,]\s*"), strip)
    return F.slice(F.array_distinct(F.filter(parts, lambda v: F.length(v).between(2, 72))), 1, limit)


def ordered_union(*lists: Column) -> Column:
    return F.array_distinct(F.concat(*lists))
