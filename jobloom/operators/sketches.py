"""Distinct counts over any set of days and sources from stored sketches, beside the exact count.

A sketch per source and day is written once, when the day is complete; a question about any days and sources merges a few
hundred bytes for each instead of reading rows.  ``LG_K`` fixes the size of a sketch and with it the error: one standard deviation
is 1.04 / sqrt(2 ** LG_K) of the count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

LG_K = 12


def relative_error(deviations: float = 3, lg_k: int = LG_K) -> float:
    """Bound of the relative error at so many standard deviations."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def daily_sketches(rows: DataFrame, keys: Sequence[str], counted: Mapping[str, Column], lg_k: int = LG_K) -> DataFrame:
    """``keys`` and a sketch per name in ``counted``; a blank or missing value is not counted."""
    kept = {name: F.nullif(value.cast("string"), F.lit("")) for name, value in counted.items()}
    return rows.groupBy(*keys).agg(*[F.hll_sketch_agg(value, lg_k).alias(name) for name, value in kept.items()])


def merged_counts(sketches: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``keys`` and the estimated number of distinct values per name, over all sketches of a key."""
    merged = [F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in names]
    return sketches.groupBy(*keys).agg(*merged) if keys else sketches.agg(*merged)


__all__ = ["LG_K", "daily_sketches", "merged_counts", "relative_error"]
