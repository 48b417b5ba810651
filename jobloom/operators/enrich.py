"""Joins that complete one relation from another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fx
from jobloom.functions.text import clean_text, fold_search, once, text_or_blank
from jobloom.operators.classify import staging_workplace


def reusable_details(listing: DataFrame, cache: DataFrame, now: Column, ttl_hours: int = 24) -> DataFrame:
    """Listing rows with ``reuse``: a cached detail younger than the limit that does not contradict the listing.

    Both sides are unique on ``id``.  Blank listing fields do not veto; the company must always agree.
    """
    ttl = min(168, max(1, ttl_hours)) * 3600
    cached = cache.select(F.col("id").alias("_id"), F.struct("*").alias("cached"))
    joined = listing.join(cached, F.col("id") == F.col("_id"), "left").drop("_id")

    def agrees(mine: Column, name: str) -> Column:
        return (mine == "") | (fold_search(F.col("cached")[name]) == fold_search(mine))

    age = F.unix_seconds(now) - F.unix_seconds(F.col("cached.detailFetchedAt").try_cast("timestamp"))
    workplace = staging_workplace(F.col("workplaceType"))
    reuse = (
        (age < ttl)
        & agrees(clean_text("title", 260), "title")
        & agrees(clean_text("location", 140), "location")
        & ((workplace == fx.STAGING_WORKPLACE_OTHER) | (F.col("cached.workplaceType") == workplace))
        & (fold_search(F.col("cached.company")) == fold_search("company"))
    )
    return joined.withColumn("reuse", F.coalesce(reuse, F.lit(False)))


def overlay_non_blank(cards: DataFrame, details: DataFrame, key: str, fields: Sequence[Sequence[str]]) -> DataFrame:
    """Detail values replace card values where present.

    ``fields`` lists groups that move together; the first of a group decides (city brings its state along).
    """
    detail = details.select(F.col(key).alias("_key"), F.struct("*").alias("_detail"))
    joined = cards.join(detail, F.col(key) == F.col("_key"), "left")
    changed: dict[str, Column] = {}
    for group in fields:
        lead = F.col("_detail")[group[0]]
        array = dict(cards.dtypes)[group[0]].startswith("array")
        present = F.coalesce(F.size(lead) > 0 if array else lead != "", F.lit(False))
        for name in group:
            changed[name] = F.when(present, F.col("_detail")[name]).otherwise(F.col(name))
    return joined.withColumns(changed).drop("_key", "_detail")


def append_missing(base: DataFrame, monitored: DataFrame, exact: DataFrame, key: str) -> DataFrame:
    """Monitored rows whose key is not in ``base`` are appended, replaced by their exact match where there is one."""
    absent = monitored.join(base.select(key), key, "left_anti")
    replacement = exact.select(F.col(key).alias("_key"), F.struct(*base.columns).alias("_exact"))
    chosen = absent.join(replacement, F.col(key) == F.col("_key"), "left")
    rows = chosen.select(
        *[F.when(F.col("_exact").isNotNull(), F.col("_exact")[c]).otherwise(F.col(c)).alias(c) for c in base.columns]
    )
    return base.unionByName(rows)


def overlay_defaults(existing: DataFrame, required: DataFrame, key: str) -> DataFrame:
    """Required entries are added when missing; fields already given are kept."""
    fields = [c for c in required.columns if c != key]
    wanted = required.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in fields])
    joined = existing.join(wanted, F.col(key) == F.col("_key"), "full_outer")
    merged = {c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in fields if c in existing.columns}
    added = {c: F.col(f"_{c}") for c in fields if c not in existing.columns}
    return joined.select(
        F.coalesce(F.col(key), F.col("_key")).alias(key),
        *[merged.get(c, F.col(c)).alias(c) for c in existing.columns if c != key],
        *[column.alias(c) for c, column in added.items()],
    )


def resolve_references(documents: DataFrame, doc: str, references: str, included: str) -> DataFrame:
    """Names of referenced parts of the same document, in reference order, distinct.

    ``references`` is ``array<struct<type,id>>`` and ``included`` ``array<struct<type,id,name>>``.  Both live in the
    same row, so the join is a row-local map lookup and needs no shuffle.
    """
    entry = F.transform(
        F.col(included), lambda i: F.struct(F.concat_ws("\x00", i["type"], i["id"]).alias("k"), i["name"].alias("v"))
    )
    # a later entry with the same identity wins
    table = F.aggregate(
        entry,
        F.from_json(F.lit("{}"), "map<string,string>"),
        lambda acc, e: F.map_concat(F.map_filter(acc, lambda k, v: k != e["k"]), F.create_map(e["k"], e["v"])),
    )
    names = once(
        table, lambda t: F.transform(F.col(references), lambda r: F.try_element_at(t, F.concat_ws("\x00", r["type"], r["id"])))
    )
    kept = F.filter(names, lambda n: text_or_blank(n) != "")
    return documents.select(F.col(doc), F.array_distinct(kept).alias("names"))


def members_only(rows: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the index."""
    return rows.join(index.select(key), key, "left_semi")


def seed_fallback(live: DataFrame, seed: DataFrame) -> DataFrame:
    """The live rows, or the versioned seed when there are none.  The seed is a small file shipped with the job."""
    return live.unionByName(seed.filter(~live.exists()))


def unseen(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``rows`` that ``known`` lacks."""
    return rows.select(key).distinct().join(known.select(key), key, "left_anti")


__all__ = [name for name in globals() if not name.startswith("_")]
