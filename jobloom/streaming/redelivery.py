"""Last delivery per key across micro-batches, as a keyed table with a timeout.

Portals deliver the same advertisement again, sometimes an older version after a newer one.  Within one batch the last delivery wins
by its order; across batches a table remembers, per key, the order of the delivery that was passed on, so that a late one is dropped.
A timeout forgets keys that nothing was delivered for in ``keep_days``, so the table follows the open advertisements, not the history.

The table meets a batch in one join: no key costs a call of its own and no key's state has to be held.  It lies in the stream's
checkpoint folder twice, as left by the last batch and by the one before: a batch reads the one and overwrites the other, so a batch
that is repeated after a failure meets the same table, and a restart goes on where the stream stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from jobloom.session import materialize
from jobloom.streaming.incremental import upsert


def _rank(rows: DataFrame, order: Sequence[str]) -> Column:
    """Comparable order of a delivery; a missing or undefined one comes first."""

    def plain(name: str) -> Column:
        kind = rows.schema[name].dataType
        return F.nanvl(F.col(name), F.lit(None).cast(kind)) if isinstance(kind, (FloatType, DoubleType)) else F.col(name)

    return F.struct(*[plain(c).alias(f"o{i}") for i, c in enumerate(order)])


def latest_deliveries(
    batch: DataFrame, known: DataFrame | None, key: str, order: Sequence[str], keep_days: float = 120
) -> tuple[DataFrame, DataFrame]:
    """The deliveries of a batch that are newer than all before them, one per key, and what is now known of every key.

    ``known`` (``_key, _order, _seen``) is what the batch before left, None for the first.  Any delivery is a sign of life, also a late one.
    """
    ranked = batch.select(F.struct(*batch.columns).alias("_row"), F.col(key).alias("_key"), _rank(batch, order).alias("_rank"))
    best = ranked.groupBy("_key").agg(F.max("_rank").alias("_order"), F.max_by("_row", "_rank").alias("_row"))
    now = F.current_timestamp()
    if known is None:
        met = best.select("*", F.lit(True).alias("_newer"), now.alias("_seen"))
    else:
        old = known.filter(F.col("_seen") >= now - F.lit(timedelta(days=keep_days)))
        old = old.select(F.col("_key").alias("_k"), F.col("_order").alias("_old"), F.col("_seen").alias("_before"))
        joined = best.join(old, F.col("_key").eqNullSafe(F.col("_k")), "full_outer")
        came = F.col("_row").isNotNull()
        newer = came & (F.col("_before").isNull() | (F.col("_order") > F.col("_old")))
        met = joined.select(
            F.when(came, F.col("_key")).otherwise(F.col("_k")).alias("_key"), F.when(newer, F.col("_order")).otherwise(F.col("_old")).alias("_order"),
            F.when(newer, F.col("_row")).alias("_row"), F.coalesce(newer, F.lit(False)).alias("_newer"), F.when(came, now).otherwise(F.col("_before")).alias("_seen"),
        )
    met = materialize(met)
    return met.filter("_newer").select("_row.*"), met.select("_key", "_order", "_seen")


def redelivered_upsert(
    spark: SparkSession, landing: str, schema: StructType, path: str, checkpoint: str, today: Column, order: Sequence[str], key: str = "job_uid",
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df, files_per_batch: int = 1000, keep_days: float = 120, **options,
) -> None:
    """Like ``incremental_upsert``, but a delivery also has to be newer than those of earlier batches and runs."""

    def apply(batch: DataFrame, epoch: int) -> None:
        left = lambda number: f"{checkpoint}/deliveries/{number % 2}"
        known = spark.read.parquet(left(epoch - 1)) if epoch else None
        newest, state = latest_deliveries(batch, known, key, order, keep_days)
        upsert(spark, path, newest, today, key, **options)
        state.write.mode("overwrite").parquet(left(epoch))

    stream = prepare(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing))
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


__all__ = ["latest_deliveries", "redelivered_upsert"]
