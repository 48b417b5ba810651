"""The public snapshot: eligible rows, newest first, capped, with dictionary codes and header figures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.functions.numbers import published_amount
from jobloom.functions.text import first_non_blank, https_url, text_or_blank
from jobloom.operators.dedupe import portals_per_key
from jobloom.operators.filters import is_eligible
from jobloom.operators.ordering import encode, first_appearance_codes, top_rows

DICTIONARIES = {
    "source": "source", "company": "company", "area": "area", "seniority": "seniority", "work_model": "work_model",
    "market": "market", "country": "country", "currency": "salary_currency",
}
CODE_COLUMNS = {
    "source": "src", "company": "cmp", "area": "area", "seniority": "sen", "work_model": "wm", "market": "mk",
    "country": "co", "currency": "cur",
}


def recency() -> Column:
    """Later of publication and first sighting, compared as text."""
    return F.greatest(text_or_blank("published_date"), F.col("first_seen_date"))


def newest(history: DataFrame, limit: int) -> DataFrame:
    """The newest rows with their ``position``; ties end with the key, so codes are reproducible."""
    keyed = history.withColumn("_recency", recency())
    order = [F.desc("_recency"), F.desc("last_seen_date"), F.asc("job_uid")]
    top = top_rows(keyed, order, limit, F.substring("_recency", 1, 10))
    # at most ``limit`` rows from here on
    numbered = top.withColumn("position", F.row_number().over(Window.orderBy(*order)))
    return numbered.drop("_recency")


def public_columns(rows: DataFrame, extra: tuple[Column, ...] = ()) -> DataFrame:
    """Public projection of stored rows (labels, not codes)."""
    return rows.select(
        *extra,
        "position",
        "job_uid",
        text_or_blank("title").alias("title"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in DICTIONARIES.values()],
        first_non_blank("city", "state").alias("city"),
        first_non_blank("published_date", "first_seen_date").alias("pub"),
        F.substring(first_non_blank("last_seen_date", "first_seen_date"), 1, 10).alias("seen"),
        F.substring(text_or_blank("expires_date"), 1, 10).alias("exp"),
        https_url("url").alias("url"),
        text_or_blank("skills").alias("sk"),
        published_amount(F.col("salary_min")).alias("smin"),
        published_amount(F.col("salary_max")).alias("smax"),
        F.coalesce(F.col("pcd").cast("int"), F.lit(0)).alias("pcd"),
        F.coalesce(F.col("blind_selection").cast("int"), F.lit(0)).alias("blind"),
        text_or_blank("contract_types").alias("ct"),
        "dedupe_key",
    )


@dataclass(frozen=True)
class Snapshot:
    rows: DataFrame  # labelled rows with ``position`` and ``np``
    codes: DataFrame  # dictionary, value, code

    def encoded(self) -> DataFrame:
        """Rows with dictionary codes instead of labels."""
        return encode(self.rows, self.codes, DICTIONARIES, CODE_COLUMNS, "position")


def build(
    history: DataFrame, today: Column, fresh_days: int = 3, months: int = 2, max_jobs: int = 50_000, keep=lambda df: df
) -> Snapshot:
    """``keep`` may materialise the capped rows (they feed several plans); by default they stay lazy."""
    eligible = history.filter(is_eligible(today, fresh_days, months))
    rows = keep(newest(eligible, max_jobs))
    portals = portals_per_key(rows).select(F.col("dedupe_key").alias("_dk"), F.col("portals").alias("np"))
    # keys hold whole titles: by its estimate of their width Spark would send them through the driver
    counted = public_columns(rows).join(portals.hint("merge"), F.col("dedupe_key") == F.col("_dk")).drop("_dk", "dedupe_key")
    return Snapshot(counted, first_appearance_codes(rows, DICTIONARIES, "position"))


def header(rows: DataFrame, total_base: DataFrame | None = None) -> DataFrame:
    """One row: counts over the exported rows, per-source map, and the size of the history."""
    company = F.nullif(F.col("company"), F.lit(""))
    per_source = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    by_source = per_source.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("source_counts")
    )
    figures = rows.agg(
        F.count(F.lit(1)).alias("count"),
        F.countDistinct(company).alias("companies"),
        F.count_if(F.col("pcd") == 1).alias("pcd_count"),
    )
    figures = figures.withColumn("source_counts", by_source.scalar())
    if total_base is not None:
        figures = figures.withColumn("total_base", total_base.agg(F.count(F.lit(1))).scalar())
    return figures
