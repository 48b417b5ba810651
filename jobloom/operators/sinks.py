"""Writers and the guards that run before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fx
from jobloom.functions.text import csv_cell, first_non_blank, https_url, text_or_blank
from jobloom.operators.snapshot import Snapshot, header

MEGABYTE = 1_048_576


class SizeGuardError(RuntimeError):
    """An output is above its size cap."""


def json_bytes(df: DataFrame) -> DataFrame:
    """One row: rows and bytes of the frame as compact JSON."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("bigint")), F.lit(0)).alias("bytes"),
    )


def guard_size(df: DataFrame, cap_mb: float, what: str) -> float:
    """Size in MB; raises above the cap, before anything is written."""
    size = json_bytes(df).first()["bytes"] / MEGABYTE
    if size > cap_mb:
        raise SizeGuardError(f"{what} is {size:.1f} MB, above the {cap_mb} MB cap")
    return size


def without_private(df: DataFrame) -> DataFrame:
    """Drop every column that must not leave the job."""
    return df.drop(*[c for c in df.columns if c in fx.SNAPSHOT_FORBIDDEN or c == "descriptionSummary"])


def write_snapshot(snapshot: Snapshot, history: DataFrame, path: str, cap_mb: float = 18) -> float:
    """Rows, dictionaries and header as three Parquet tables."""
    rows = without_private(snapshot.encoded())
    size = guard_size(rows, cap_mb, "snapshot")
    rows.write.mode("overwrite").parquet(f"{path}/jobs")
    snapshot.codes.write.mode("overwrite").parquet(f"{path}/dictionaries")
    header(snapshot.rows, history).write.mode("overwrite").parquet(f"{path}/header")
    return size


def write_csv(cells: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """Escaped cells as ``;``-separated text with CRLF.

    The header (with a byte order mark) sorts first, so the part files read in name order are the document.
    """
    spark = cells.sparkSession
    names = cells.columns
    head = spark.range(1).select(
        F.lit(0).alias("_part"),
        F.concat(F.lit("\ufeff"), F.concat_ws(";", *[csv_cell(F.lit(n)) for n in names])).alias("value"),
    )
    body = cells.select(F.lit(1).alias("_part"), F.concat_ws(";", *[F.col(f"`{n}`") for n in names]).alias("value"), *(
        [c.alias(f"_o{i}") for i, c in enumerate(order)] if order else []
    ))
    keys = [f"_o{i}" for i in range(len(order or []))]
    document = head.unionByName(body, allowMissingColumns=True).orderBy("_part", *keys)
    document.select("value").write.mode("overwrite").option("lineSep", "\r\n").text(path)


def attach_metadata(index: DataFrame, jobs: DataFrame) -> DataFrame:
    """Short public metadata for indexed links; rows without a job keep NULL metadata."""
    limits = fx.META_LIMITS
    meta = jobs.select(
        https_url(F.trim("url")).alias("_url"),
        F.substring(text_or_blank("title"), 1, limits["t"]).alias("t"),
        F.substring(text_or_blank("company"), 1, limits["e"]).alias("e"),
        F.substring(F.trim(first_non_blank("city", "state", "country")), 1, limits["l"]).alias("l"),
        F.substring(text_or_blank("work_model"), 1, limits["w"]).alias("w"),
        F.substring(text_or_blank("published_date"), 1, limits["d"]).alias("d"),
    )
    return index.join(meta, F.col("url") == F.col("_url"), "left").drop("_url")


def run_summary(health: DataFrame, seconds: DataFrame) -> DataFrame:
    """Per-source status, rows and seconds, slowest first."""
    return health.join(seconds, "name", "left").select("name", "status", "jobs", "seconds").orderBy(F.desc("seconds"), "name")


def board_catalog(boards: DataFrame) -> DataFrame:
    """Companies in catalog order."""
    return boards.orderBy(F.lower("company"), "board")


def write_history(df: DataFrame, path: str) -> None:
    """History by source, so that one portal's scan prunes to its folder; big sources get many files.

    Always to a new path: Spark must not overwrite what it is reading.
    """
    df.repartition(F.col("source"), F.pmod(F.xxhash64("job_uid"), F.lit(32))).write.mode("overwrite").partitionBy(
        "source"
    ).parquet(path)


__all__ = [name for name in globals() if not name.startswith("_")]
