"""The flagship query: collected advertisements to a faceted search result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.functions.text import fold_search
from jobloom.operators.dedupe import equivalence_key, keep_last, portals_per_key
from jobloom.plans.registry import ads
from jobloom.schema import job_uid


def unique_ads(spark: SparkSession, folder: str) -> DataFrame:
    """Last row per portal and identifier, with the cross-portal key."""
    rows = ads(spark, folder).withColumn("job_uid", job_uid(F.col("source"), F.col("native_id"), F.col("url")))
    rows = rows.withColumns(
        {
            "dedupe_key": equivalence_key("title", "company"),
            # the text test is evaluated before the shuffle, so descriptions stay behind
            "is_match": fold_search(F.concat_ws(" ", "title", "company", "description")).contains("the"),
        }
    )
    return keep_last(rows.select("job_uid", "source", "dedupe_key", "is_match", "doc_id"), ["job_uid"], ["doc_id"])


def portal_facet(spark: SparkSession, folder: str) -> DataFrame:
    """Per portal: matching advertisements, and how many of them are also on other portals."""
    rows = unique_ads(spark, folder)
    shared = portals_per_key(rows).filter("portals > 1").select("dedupe_key", F.lit(1).alias("_shared"))
    marked = rows.filter("is_match").groupBy("source", "dedupe_key").agg(F.count(F.lit(1)).alias("n"))
    counted = marked.join(shared, "dedupe_key", "left")
    return (
        counted.groupBy("source")
        .agg(F.sum("n").alias("jobs"), F.sum(F.when(F.col("_shared").isNotNull(), F.col("n")).otherwise(0)).alias("on_other_portals"))
        .orderBy(F.desc("jobs"), "source")
    )
