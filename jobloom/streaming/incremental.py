"""Incremental upsert of landed batches into the history table with Structured Streaming.

The history is Parquet in ``source`` / ``bucket`` folders.  A micro-batch reads and rewrites only the folders its keys
fall into, so its cost follows the batch, not the history.  The merge is idempotent: replaying a batch after a failure
gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from jobloom.operators.dedupe import keep_last
from jobloom.operators.history import merge
from jobloom.session import materialize

BUCKETS = 16


def bucket_of(key: str = "job_uid", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_bucketed(rows: DataFrame, path: str, key: str = "job_uid", buckets: int = BUCKETS, spread: int = 8) -> None:
    """Overwrite the folders present in ``rows``; folders not present stay as they are.

    Each folder is written by several tasks, so a portal with a third of all rows does not wait for one.
    """
    placed = rows.withColumn("bucket", bucket_of(key, buckets))
    spread_over = placed.repartition("source", "bucket", F.pmod(F.xxhash64(F.lit(1), key), F.lit(spread)))
    spread_over.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "bucket").parquet(path)


def read_bucketed(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema.add("bucket", "int")) if schema else spark.read
    return reader.parquet(path)


def upsert(spark: SparkSession, path: str, batch: DataFrame, today: Column, key: str = "job_uid", buckets: int = BUCKETS, **options) -> None:
    """Merge a batch that is unique on ``key`` into the table.  A key always belongs to one source."""
    batch = materialize(batch)
    touched = batch.select("source", bucket_of(key, buckets).alias("bucket")).distinct()
    # the number of folders is bounded by sources times buckets
    folders = [(r["source"], r["bucket"]) for r in touched.collect()]
    if not folders:
        return
    by_source: dict[str, list[int]] = {}
    for source, bucket in folders:
        by_source.setdefault(source, []).append(bucket)
    wanted = F.lit(False)
    for source, numbers in by_source.items():
        wanted = wanted | ((F.col("source") == source) & F.col("bucket").isin(*numbers))
    stored = read_bucketed(spark, path).filter(wanted).drop("bucket")
    # materialised first: a folder must not be overwritten while it is being read
    merged = materialize(merge(stored, batch.select(*[c for c in stored.columns if c in batch.columns]), today, key, **options))
    write_bucketed(merged, path, key, buckets)


def incremental_upsert(
    spark: SparkSession, landing: str, schema: StructType, path: str, checkpoint: str, today: Column, order: Sequence[str],
    key: str = "job_uid", prepare: Callable[[DataFrame], DataFrame] = lambda df: df, files_per_batch: int = 1000, **options,
) -> None:
    """Process everything that landed since the last run, then stop.

    A key delivered several times in one batch keeps its last delivery by ``order``.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        upsert(spark, path, keep_last(prepare(batch), [key], order), today, key, **options)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
