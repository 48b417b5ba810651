"""The accumulated table: set-based upsert, purges, retention, link rewriting and change counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fx
from jobloom.functions.arrays import joined
from jobloom.functions.text import blank_to_null, percent_encode, strip, text_or_blank, title_slug
from jobloom.operators.dedupe import equivalence_key, native_key
from jobloom.operators.filters import inferred_work_model, is_retained, names_brazil
from jobloom.schema import HISTORY

_SEEN = ("first_seen_date", "last_seen_date")


def as_history_rows(batch: DataFrame) -> DataFrame:
    """Classified canonical rows in stored form: key, flattened lists, equivalence key, no description."""
    return batch.select(
        native_key().alias("job_uid"),
        "source", "title", "company", "area", "seniority", "work_model", "city", "state", "country", "market",
        "salary_min", "salary_max", "salary_currency", "published_date", "expires_date", "url",
        joined(F.col("skills"), 500).alias("skills"),
        joined(F.col("contract_types"), 240).alias("contract_types"),
        "pcd", "blind_selection",
        equivalence_key("title", "company").alias("dedupe_key"),
    )


def merge(
    history: DataFrame,
    batch: DataFrame,
    today: Column,
    key: str = "job_uid",
    sticky: tuple[str, ...] = ("work_model",),
    change: str | None = None,
) -> DataFrame:
    """Upsert ``batch`` (unique on ``key``) into ``history``.

    New keys are first and last seen today.  Known keys take every batch value, except that the first sighting stays
    and a blank in a ``sticky`` column does not erase what is known.  ``change`` names a column telling
    ``inserted`` / ``updated`` / ``kept``.  One full outer join on a unique key: one shuffle, no skew.
    """
    values = [c for c in history.columns if c != key and c not in _SEEN]
    new = batch.select(F.col(key).alias("_key"), F.struct(*values).alias("_new"))
    merged = history.withColumn("_old", F.lit(True)).join(new, F.col(key) == F.col("_key"), "full_outer")
    arrived, known = F.col("_new").isNotNull(), F.col("_old").isNotNull()

    def value(name: str) -> Column:
        fresh = F.col("_new")[name]
        if name in sticky:
            fresh = F.when(known, F.coalesce(F.nullif(fresh, F.lit("")), F.col(name))).otherwise(fresh)
        return F.when(arrived, fresh).otherwise(F.col(name))

    day = today.cast("string")
    computed = {
        key: F.coalesce(F.col(key), F.col("_key")),
        "first_seen_date": F.when(known, F.col("first_seen_date")).otherwise(day),
        "last_seen_date": F.when(arrived, day).otherwise(F.col("last_seen_date")),
    }
    out = [computed.get(c, None) if c in computed else value(c) for c in history.columns]
    state = F.when(arrived & known, "updated").when(arrived, "inserted").otherwise("kept")
    return merged.select(
        *[column.alias(name) for column, name in zip(out, history.columns)], *([state.alias(change)] if change else [])
    )


def change_counts(merged: DataFrame, change: str) -> DataFrame:
    """One row: inserted, updated, kept."""
    return merged.agg(
        *[F.count_if(F.col(change) == state).alias(state) for state in ("inserted", "updated", "kept")]
    )


def _split_source(history: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Rows of one source, and the rest, which a purge neither shuffles nor compares."""
    return history.filter(F.col("source") == source), history.filter(~F.col("source").eqNullSafe(source))


def purge_absent(history: DataFrame, source: str, current: DataFrame, key: str = "job_uid") -> DataFrame:
    """Drop rows of a source whose key is not in its complete catalog; an empty catalog drops nothing."""
    listed = current.select(F.col(key).alias("_listed")).filter(text_or_blank("_listed") != "").distinct()
    own, other = _split_source(history, source)
    kept = own.join(listed, F.col(key) == F.col("_listed"), "left").filter(F.col("_listed").isNotNull() | ~listed.exists()).drop("_listed")
    return other.unionByName(kept)


def purge_foreign(
    history: DataFrame, source: str, current: DataFrame, place: str = "city", key: str = "job_uid",
    pattern: str = fx.BRAZIL_PLACES,
) -> DataFrame:
    """Drop rows of a source that are neither in its current catalog nor in a recognised place."""
    listed = current.select(F.col(key).alias("_listed")).distinct()
    own, other = _split_source(history, source)
    placed = names_brazil(F.col(place), pattern)
    unplaced = own.filter(~F.coalesce(placed, F.lit(False))).join(listed, F.col(key) == F.col("_listed"), "left_semi")
    return other.unionByName(own.filter(placed)).unionByName(unplaced)


def repair_work_models(history: DataFrame) -> DataFrame:
    filled = inferred_work_model(F.col("work_model"), F.col("city"), F.col("country"), F.col("market"))
    return history.withColumn("work_model", filled)


def rewrite_links(history: DataFrame, source: str, build, changed: str | None = None) -> DataFrame:
    """Rebuild the link of a source's rows from ``build(native_id, title)``; blank results change nothing."""
    prefix = f"{source}:"
    native = F.substring(F.col("job_uid"), F.lit(len(prefix) + 1), F.length("job_uid"))
    link = strip(text_or_blank(build(native, F.col("title"))))
    applies = (
        (F.col("source") == source) & F.col("job_uid").startswith(prefix) & (native != "") & (link != "")
        & (link != strip(text_or_blank("url")))
    )
    out = history.withColumn("_applies", F.coalesce(applies, F.lit(False)))
    out = out.withColumn("url", F.when(F.col("_applies"), link).otherwise(F.col("url")))
    return out.withColumnRenamed("_applies", changed) if changed else out.drop("_applies")


def portal_link(base: str):
    """Link builder ``base/<encoded id>/<title slug>``."""
    return lambda native, title: F.concat(F.lit(base + "/"), percent_encode(strip(native)), F.lit("/"), title_slug(title))


def prune(history: DataFrame, today: Column, keep_days: int = 120, months: int = 2) -> DataFrame:
    return history.filter(is_retained(today, keep_days, months))


def conform(stored: DataFrame) -> DataFrame:
    """Additive schema evolution: columns an older table lacks become NULL (blank for text flags)."""
    columns = []
    for field in HISTORY.fields:
        if field.name in stored.columns:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            default = F.lit(False) if field.dataType.simpleString() == "boolean" else F.lit(None)
            columns.append(default.cast(field.dataType).alias(field.name))
    return stored.select(*columns)


__all__ = [name for name in globals() if not name.startswith("_")]
