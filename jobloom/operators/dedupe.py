"""Repeats inside a portal and the same advertisement across portals.

Nothing here gathers a whole group in one task: winners are chosen by aggregates that combine before the shuffle, and
per-key results go back to the rows through ``attach_by_key``, which takes hot keys out of the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions.text import equivalence_text

#: Keys handled by broadcast before the shuffle join; any other key holds at most ``rows / HOT_KEYS`` rows.
HOT_KEYS = 1000


def _pick(df: DataFrame, key: Sequence[Column | str], order: Sequence[str], last: bool, position: str | None) -> DataFrame:
    keys = [F.col(k) if isinstance(k, str) else k for k in key]
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    rank = F.struct(*order)
    row = F.struct(*df.columns)
    chosen = F.max_by(row, rank) if last else F.min_by(row, rank)
    picked = df.groupBy(*named).agg(chosen.alias("_row"), F.min(rank).alias("_first"))
    extra = [F.col(f"_first.{order[0]}").alias(position)] if position else []
    return picked.select("_row.*", *extra)


def keep_last(df: DataFrame, key: Sequence[Column | str], order: Sequence[str], position: str | None = None) -> DataFrame:
    """Last row per key; ``position`` names a column with the key's first place, which is its output position."""
    return _pick(df, key, order, True, position)


def keep_first(df: DataFrame, key: Sequence[Column | str], order: Sequence[str], position: str | None = None) -> DataFrame:
    return _pick(df, key, order, False, position)


def native_key() -> Column:
    from jobloom.schema import job_uid

    return job_uid(F.col("source"), F.col("native_id"), F.col("url"))


def equivalence_key(title: Column | str, company: Column | str) -> Column:
    """Key shared by the same advertisement on different portals."""
    return F.concat_ws("|", equivalence_text(title), equivalence_text(company))


def attach_by_key(rows: DataFrame, values: DataFrame, key: str, weight: str, spread: Column) -> DataFrame:
    """Left join of one-row-per-key ``values`` onto ``rows``, safe for hot keys.

    The heaviest ``HOT_KEYS`` keys (a fixed number of rows) are broadcast and resolved in place.  Their rows then
    carry a spread-out join key that matches nothing, so the shuffle join only sees keys of bounded weight.
    """
    payload = [c for c in values.columns if c != key]
    hot = values.orderBy(F.desc(weight), key).limit(HOT_KEYS)
    hot = hot.select(F.col(key).alias("_hk"), F.struct(*payload).alias("_hot"))
    cold = values.select(F.col(key).alias("_ck"), F.struct(*payload).alias("_cold"))
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left").drop("_hk")
    marked = marked.withColumn(
        "_jk",
        F.when(F.col("_hot").isNotNull(), F.concat(F.lit("\x00"), F.xxhash64(spread).cast("string"))).otherwise(F.col(key)),
    )
    joined = marked.join(cold, F.col("_jk") == F.col("_ck"), "left")
    resolved = F.coalesce(F.col("_hot"), F.col("_cold"))
    return joined.select(*[F.col(c) for c in rows.columns], *[resolved[c].alias(c) for c in payload])


def portals_per_key(rows: DataFrame, key: str = "dedupe_key", source: str = "source") -> DataFrame:
    """``key, portals, n``: distinct sources and rows per key, combined map-side before each shuffle."""
    pairs = rows.groupBy(key, source).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias("portals"), F.sum("n").alias("n"))


def with_portals(rows: DataFrame, key: str = "dedupe_key", source: str = "source", spread: str = "job_uid") -> DataFrame:
    """Add ``portals``: on how many sources the key appears within these rows."""
    counted = attach_by_key(rows, portals_per_key(rows, key, source), key, "n", F.col(spread))
    return counted.drop("n")
