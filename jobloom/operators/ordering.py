"""Explicit order: dictionary codes, pages, top rows.  Nothing relies on partition order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.session import materialize


def top_rows(rows: DataFrame, order: Sequence[Column], limit: int, coarse: Column) -> DataFrame:
    """First ``limit`` rows by ``order``, whose leading key is ``coarse`` descending (for instance the day).

    A histogram of the coarse key finds the value below which nothing can be in the result, so that each task passes
    on only rows near the top instead of ``limit`` rows each.  The limit itself is the feature being computed.
    """
    counted = rows.groupBy(coarse.alias("_coarse")).agg(F.count(F.lit(1)).alias("_n"))
    above = Window.orderBy(F.desc("_coarse")).rowsBetween(Window.unboundedPreceding, -1)
    reached = counted.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0)))
    floor = reached.filter(F.col("_above") < limit).agg(F.min("_coarse"))
    return rows.filter(coarse >= floor.scalar()).orderBy(*order).limit(limit)


def first_appearance_codes(rows: DataFrame, names: dict[str, str], position: str) -> DataFrame:
    """``dictionary, value, code`` for several columns at once: codes follow first appearance by ``position``.

    ``names`` maps dictionary name to column.  One pass over the rows, combined map-side, then one window over the
    distinct values of each dictionary.
    """
    pairs = [F.struct(F.lit(d).alias("dictionary"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for d, c in names.items()]
    long = rows.select(F.col(position).alias("_p"), F.inline(F.array(*pairs)))
    first = long.groupBy("dictionary", "value").agg(F.min("_p").alias("_first"))
    window = Window.partitionBy("dictionary").orderBy("_first", "value")
    return first.select("dictionary", "value", (F.row_number().over(window) - 1).alias("code"))


def encode(rows: DataFrame, codes: DataFrame, names: dict[str, str], outputs: dict[str, str], position: str) -> DataFrame:
    """Replace several columns by their codes with one join: long form, join on (dictionary, value), back to wide."""
    pairs = [F.struct(F.lit(d).alias("dictionary"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for d, c in names.items()]
    long = rows.select(F.col(position).alias("_p"), F.inline(F.array(*pairs)))
    coded = long.join(codes, ["dictionary", "value"])
    wide = coded.groupBy("_p").agg(
        *[F.max(F.when(F.col("dictionary") == d, F.col("code"))).alias(outputs[d]) for d in names]
    )
    plain = rows.drop(*[c for c in names.values() if c in rows.columns])
    # the labelled rows hold whole texts and stay off the driver
    return plain.join(wide.hint("merge"), F.col(position) == F.col("_p")).drop("_p")


def codes_in_ranges(values: DataFrame, order: str, ties: Sequence[str], ranges: int = 200) -> DataFrame:
    """Add ``code`` 0, 1, 2, … by ``order`` then ``ties`` without sorting everything in one task.

    Range limits of the numeric order column are fixed first (a constant number of values), so every row knows its
    range; codes are the rank inside the range plus the size of the ranges before it.
    """
    shares = [i / ranges for i in range(1, ranges)]
    limits = values.agg(F.percentile_approx(order, shares, 10_000).alias("p")).first()["p"] or []
    limits = sorted(set(limits))
    bucket = F.lit(0)
    if limits:
        bucket = F.size(F.filter(F.lit(limits), lambda limit: limit <= F.col(order)))
    placed = values.withColumn("_range", bucket)
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(order, *ties)
    return (
        placed.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(offsets), F.col("_range") == F.col("_r"))
        .withColumn("code", (F.col("_offset") + F.col("_rank") - 1).cast("int"))
        .drop("_range", "_r", "_rank", "_offset")
    )


def places(rows: DataFrame, order: Sequence[Column], out: str, group: str | None = None, columns: Sequence[str] | None = None, keep=materialize) -> DataFrame:
    """Add ``out`` 0, 1, 2, … by ``order`` (within each ``group``), for keys of any type and without one task that sorts everything.

    Rows are dealt by sampled ranges of the order and sorted there; only one count per range and group meets in a running
    sum.  ``columns`` go on with the place, so that wide sort keys are not written.  The rows are read twice, once for the
    limits of the ranges: give a relation that is cheap to read.  Rows that agree in the whole order get any of their places.
    """
    keys = [*([F.col(group)] if group else []), *order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    dealt = keep(dealt.select(*(columns or rows.columns), "_at"))
    whole = F.col(group) if group else F.lit(0)
    sums = dealt.groupBy(whole.alias("_g"), F.shiftright("_at", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select("_g", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    joined = dealt.join(shifts, whole.eqNullSafe(F.col("_g")) & (F.shiftright("_at", 33) == F.col("_part")))
    return joined.withColumn(out, F.col("_at") + F.col("_shift")).drop("_at", "_g", "_part", "_shift")


def page(
    rows: DataFrame, order: Sequence[Column], number: int, size: int = 24, total: int | None = None, coarse: Column | None = None
) -> DataFrame:
    """One page of ordered rows; the number is clamped into the existing pages.

    ``coarse`` is a value with few distinct results (a day) by which ``order`` descends first.  Its counts give the total
    and the values that the page can hold, so that only their rows are ordered, also for the last page.
    """
    if coarse is not None:
        counted = rows.groupBy(coarse.alias("_coarse")).agg(F.count(F.lit(1)).alias("_n"))
        above = Window.orderBy(F.desc("_coarse")).rowsBetween(Window.unboundedPreceding, -1)
        reached = counted.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0)))
        total = reached.agg(F.sum("_n")).first()[0] or 0 if total is None else total
    total = rows.count() if total is None else total
    pages = max(1, -(-total // size))
    start = (min(max(1, number), pages) - 1) * size
    if coarse is None or not total:
        return rows.orderBy(*order).offset(start).limit(size)
    held = reached.filter((F.col("_above") < start + size) & (F.col("_above") + F.col("_n") > start))
    low, high, skipped = held.agg(F.min("_coarse"), F.max("_coarse"), F.min("_above")).first()
    inside = rows.filter(coarse.between(low, high))
    return inside.orderBy(*order).offset(start - skipped).limit(size)


def top_per_group(rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per group.  Spark limits each group inside every task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def latest_per_group(rows: DataFrame, group: Column, order: Column, tie: Column, values: Sequence[str]) -> DataFrame:
    """Newest row per group as an aggregate that combines before the shuffle."""
    best = F.max_by(F.struct(*values), F.struct(order.alias("o"), tie.alias("t")))
    return rows.groupBy(group.alias("group_key")).agg(best.alias("_row")).select("group_key", "_row.*")


def in_registry_order(frames: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """Union of per-source frames with explicit ``registry_ord``; columns a source lacks become NULL."""
    out = None
    for i, (name, frame) in enumerate(zip(names, frames)):
        tagged = frame.withColumns({"registry_ord": F.lit(i), "registry_name": F.lit(name)})
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


__all__ = [name for name in globals() if not name.startswith("_")]
