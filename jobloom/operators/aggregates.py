"""Counts, facets and rollups.  Every aggregate combines map-side, so a hot value costs one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fx
from jobloom.functions.text import blank_to_null, fold_search, text_or_blank


def count_by(rows: DataFrame, column: str, count: str = "jobs") -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias(count)).orderBy(column)


def source_health(registry: DataFrame, rows: DataFrame, is_valid: Column) -> DataFrame:
    """``name, status, jobs, dropped`` for every registered source, also those that gave nothing or failed.

    ``registry`` has ``name`` and ``failed``.
    """
    counted = rows.groupBy(F.col("source").alias("name")).agg(
        F.count_if(is_valid).alias("_jobs"), F.count_if(~is_valid).alias("_dropped")
    )
    joined = registry.join(counted, "name", "left")
    jobs = F.when(F.col("failed"), F.lit(0)).otherwise(F.coalesce("_jobs", F.lit(0)))
    return joined.select(
        "name",
        F.when(F.col("failed"), "falha").when(jobs > 0, "ok").otherwise("vazio").alias("status"),
        jobs.alias("jobs"),
        F.coalesce("_dropped", F.lit(0)).alias("dropped"),
    )


def facets(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``facet, value, jobs`` for several columns in one pass; blanks are not counted."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])
    long = rows.select(F.inline(pairs)).filter(text_or_blank("value") != "")
    return long.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("jobs"))


def facet_order(label: str = "value") -> list[Column]:
    return [F.col("facet"), F.desc("jobs"), F.collate(F.col(label), "UNICODE_CI_AI"), F.col(label)]


def city_facet(rows: DataFrame, cities: str, order: str) -> DataFrame:
    """Advertisements per folded city name; the spelling shown is the first one seen."""
    pairs = F.transform(F.col(cities), lambda c: F.struct(fold_search(c).alias("key"), c.alias("label")))
    keyed = rows.select(F.col(order).alias("_ord"), F.posexplode(pairs).alias("_pos", "_city"))
    keyed = keyed.filter(F.col("_city.key") != "")
    # one count per advertisement, even if it repeats a city
    once = keyed.groupBy("_ord", F.col("_city.key").alias("key")).agg(
        F.min(F.struct("_pos", F.col("_city.label").alias("label"))).alias("_first")
    )
    return once.groupBy("key").agg(
        F.min_by(F.col("_first.label"), F.struct("_ord", "_first._pos")).alias("label"),
        F.count(F.lit(1)).alias("jobs"),
    )


def contract_facet(rows: DataFrame, contracts: str, models=fx.CONTRACT_FACET) -> DataFrame:
    """Advertisements per fixed contract model; models nobody offers stay with zero."""
    folded = F.transform(F.col(contracts), fold_search)
    counts = [
        F.count_if(F.array_contains(folded, source.lower())).alias(f"_{i}") for i, (_, source) in enumerate(models)
    ]
    wide = rows.agg(*counts)
    pairs = [
        F.struct(F.lit(i).alias("ord"), F.lit(name).alias("contract"), F.col(f"_{i}").alias("jobs"))
        for i, (name, _) in enumerate(models)
    ]
    return wide.select(F.inline(F.array(*pairs)))


def staging_rollups(rows: DataFrame) -> DataFrame:
    """``rollup, value, jobs`` by category, workplace and contract (missing contracts counted as such)."""
    contracts = F.when(F.size("contractTypes") > 0, F.col("contractTypes")).otherwise(F.array(F.lit(fx.UNKNOWN_MARKET)))
    pairs = F.concat(
        F.array(
            F.struct(F.lit("category").alias("rollup"), F.col("category").alias("value")),
            F.struct(F.lit("workplace").alias("rollup"), F.col("workplaceType").alias("value")),
        ),
        F.transform(contracts, lambda c: F.struct(F.lit("contract").alias("rollup"), c.alias("value"))),
    )
    return rows.select(F.inline(pairs)).groupBy("rollup", "value").agg(F.count(F.lit(1)).alias("jobs"))


def staging_totals(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.countDistinct("company").alias("companies"),
        F.count_if(F.size("alerts") > 0).alias("jobs_with_alerts"),
        F.count_if(F.col("detailFetchedAt") != "").alias("details_loaded"),
    )


def board_discovery(jobs: DataFrame, board: str, company: str, order: str, qualifies: Column) -> DataFrame:
    """Boards with at least one qualifying job, how many, and the first company name given (else the board)."""
    named = F.when(text_or_blank(company) != "", F.col(company))
    return (
        jobs.filter(qualifies)
        .groupBy(F.col(board).alias("board"))
        .agg(
            F.min_by(blank_to_null(named), F.when(named.isNotNull(), F.col(order))).alias("_company"),
            F.count(F.lit(1)).alias("brazil_jobs"),
        )
        .select("board", F.coalesce("_company", "board").alias("company"), "brazil_jobs")
    )


def distinct_counts(rows: DataFrame, columns: dict[str, str], approximate: bool = False) -> DataFrame:
    """Distinct non-blank values per column; exact, or sketch-based on request."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return rows.agg(*[count(F.nullif(F.col(c), F.lit(""))).alias(name) for name, c in columns.items()])


__all__ = [name for name in globals() if not name.startswith("_")]
