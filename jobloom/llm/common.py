"""What several operators share: table access, written intermediate tables, words, numbering without one big window."""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from jobloom.session import ensure_checkpoint_dir

#: Words of every contract: runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` and this Java pattern cut at the same six characters.
WORD_GAP = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would change other alphabets)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def block_count(rows: int, groups: int = 1, per_block: int = 50_000, least: int = 64) -> int:
    """Blocks per group so that a block holds about ``per_block`` rows if the groups are even."""
    return max(least, math.ceil(rows / max(1, groups) / per_block))


def number_rows(df: DataFrame, group: list[str], order: list[str], out: str, rows: int, groups: int) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... within each ``group``, without gaps, and without sorting a group in one task.

    Rows of a group are cut into blocks by a hash of ``order``; only the block counts (groups x blocks rows) meet in a
    running sum.  Each block is then numbered on its own from its offset.  Rows that agree in ``order`` wholly share
    a block; they are interchangeable unless other columns differ, so name enough columns.
    """
    blocks = block_count(rows, groups)
    df = df.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    key = [*group, "_block"]
    sums = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*key, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    sums = sums.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], "_before")
    local = df.withColumn("_at", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)]
    on = same[0]
    for s in same[1:]:
        on = on & s
    joined = local.join(sums, on, "inner")
    keep = [c for c in df.columns if c != "_block"]
    return joined.select(*keep, (F.col("_before") + F.col("_at") - 1).cast("long").alias(out))


def number_in_order(df: DataFrame, group: str, order: list[str], out: str, size: str) -> DataFrame:
    """Add ``out`` (0, 1, 2, ... by ``order`` within each ``group``) and ``size`` (rows of the group); a hot group is split.

    Rows are dealt by ranges of (group, order) and sorted there; only one count per range and group meets in a running sum.
    The input is read twice (bounds of the ranges, then the rows), so give a written table.  Rows that agree in all of
    ``order`` share a range: let it end in something that tells repeated rows apart.
    """
    dealt = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    dealt = stage_table(dealt.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_place", 33)
    sums = dealt.groupBy(F.col(group).alias("_g"), part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    whole = Window.partitionBy("_g")
    before = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_g", "_p", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("_size"))
    joined = dealt.join(sums, F.col(group).eqNullSafe(F.col("_g")) & (part == F.col("_p")))
    return joined.select(*df.columns, (F.col("_place") + F.col("_shift")).alias(out), F.col("_size").alias(size))


def stream_groups(df: DataFrame, keys: list[str], order: list[str], fn: Callable[[Iterator[tuple]], Iterable[tuple]], schema: T.StructType) -> DataFrame:
    """``fn`` sees the rows of one key in ``order``, one at a time, as tuples of ``df``'s columns, and gives tuples of ``schema``.

    Nothing of a key is held but what ``fn`` holds, and many small keys share a task and its batches.
    """
    at = [df.columns.index(k) for k in keys]
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
        out = (made for _, group in groupby(rows, key=lambda row: [row[i] for i in at]) for made in fn(group))
        while block := list(islice(out, 2048)):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*block), arrow)], schema=arrow)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
