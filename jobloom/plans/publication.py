"""What a refresh publishes and what must hold for it: the snapshot, the requirement index and the staging files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom import fixed_values as fx
from jobloom.functions.dates import publication_cutoff
from jobloom.operators import quality as qa, requirements as rq, snapshot as sn
from jobloom.operators.aggregates import staging_rollups, staging_totals
from jobloom.operators.ordering import places
from jobloom.operators.publish import Audit, Part, current, publish, read_current, write_version
from jobloom.operators.sinks import attach_metadata
from jobloom.plans.refresh import ORDER, Refresh, refresh, requirement_index
from jobloom.schema import HISTORY
from jobloom.session import materialize

SNAPSHOT_SCHEMA, INDEX_SCHEMA, STAGING_SCHEMA = 3, 1, 2


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def write_snapshot(
    spark: SparkSession, path: str, snapshot: sn.Snapshot, history: DataFrame, today: Column, fresh_days: int = 3, months: int = 2,
    minimum: int = 1, cap_mb: float = 18, collected: DataFrame | None = None, failed: Sequence[str] = (),
) -> Audit:
    """Jobs, dictionaries and header of a snapshot as an audited version.

    ``collected`` has ``source, jobs`` as they were before unknown markets left.  The dictionaries are small and are looked at
    first: the rules over coded rows need the codes of two sources and a country, and the size of each dictionary.
    """
    codes = materialize(snapshot.codes)
    sizes = {r["dictionary"]: r["n"] for r in codes.groupBy("dictionary").agg(F.count(F.lit(1)).alias("n")).collect()}
    named = codes.filter(F.struct("dictionary", "value").isin(*[F.struct(F.lit(d), F.lit(v)) for d, v in qa.RULED_VALUES]))
    ruled = {(r["dictionary"], r["value"]): r["code"] for r in named.collect()}
    header = sn.header(snapshot.rows, history).withColumns({
        "schema_version": F.lit(SNAPSHOT_SCHEMA), "generated_date": today.cast("string"), "fresh_days": F.lit(fresh_days),
        "max_age_months": F.lit(months), "publication_cutoff": publication_cutoff(today, months), "failed_sources": _strings(failed),
    })
    if collected is not None:
        counts = collected.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "jobs")))))
        header = header.withColumn("collected_source_counts", counts.scalar())
    audit = write_version(spark, path, [
        Part(
            "jobs", snapshot.encoded(), {**qa.coded_rules(ruled, today, months, minimum), "code_range": qa.code_range(sizes)},
            cap_mb=cap_mb, required=fx.SNAPSHOT_COLUMNS, forbidden=fx.SNAPSHOT_FORBIDDEN,
        ),
        Part("dictionaries", codes),
        Part("header", header, qa.header_rules(), forbidden=fx.SNAPSHOT_FORBIDDEN),
    ])
    written = audit.read("header").first()
    audit.expect("header_count", written["count"] == audit.figures["jobs"]["rows"])
    audit.violations["missing_dictionaries"] = len(set(fx.SNAPSHOT_DICTIONARIES) - set(sizes)) if written["count"] else 0
    return audit


def write_index(spark: SparkSession, path: str, index: DataFrame, jobs: DataFrame | None = None, cap_mb: float = 8) -> Audit:
    """Terms, packed entries and header of a requirement index as an audited version; ``jobs`` brings public metadata."""
    terms = materialize(rq.index_terms(index))
    return write_packed(spark, path, terms.select("code", "label"), rq.packed(index, terms), jobs, cap_mb)


def write_packed(
    spark: SparkSession, path: str, terms: DataFrame, entries: DataFrame, jobs: DataFrame | None = None, cap_mb: float = 8, header: DataFrame | None = None
) -> Audit:
    """``terms``: ``code, label``; ``entries``: ``url, m, p, c, x, q`` and perhaps metadata already."""
    if jobs is not None:
        entries = attach_metadata(entries, jobs)
    limits = {name: limit for name, limit in fx.META_LIMITS.items() if name in entries.columns}
    audit = write_version(spark, path, [
        Part("terms", terms, qa.term_rules(F.col("label"))),
        Part(
            "entries", entries, qa.entry_rules(terms.count(), limits), key="url", cap_mb=cap_mb,
            required=("url", *qa.ENTRY_GROUPS, "q"), allowed=("url", *qa.ENTRY_GROUPS, "q", *fx.META_LIMITS),
        ),
    ])
    if header is None:
        header = spark.range(1).select(F.lit(INDEX_SCHEMA).alias("schema_version"), F.lit(audit.figures["entries"]["rows"]).cast("long").alias("count"))
    header.write.parquet(f"{audit.path}/{audit.version}/header")
    found = header.first()
    audit.expect("index_schema", found["schema_version"] == INDEX_SCHEMA)
    audit.expect("index_count", found["count"] == audit.figures["entries"]["rows"])
    return audit


def staging_header(rows: DataFrame, collected_at: Column) -> DataFrame:
    """One row: totals and the number of jobs per workplace."""
    workplaces = staging_rollups(rows).filter("rollup = 'workplace'")
    per_value = workplaces.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "jobs")))))
    return staging_totals(rows).select(
        "*", F.lit(STAGING_SCHEMA).alias("schema_version"), collected_at.cast("string").alias("collected_at"), per_value.scalar().alias("by_workplace")
    )


def write_staging(spark: SparkSession, path: str, rows: DataFrame, header: DataFrame, cap_mb: float = 15, rules: Mapping[str, Column] | None = None) -> Audit:
    """Rows and header of the staging base as an audited version."""
    audit = write_version(spark, path, [
        Part("jobs", rows, qa.staging_rules(unique=False) if rules is None else rules, key="id", cap_mb=cap_mb, required=fx.STAGING_REQUIRED, forbidden=fx.STAGING_FORBIDDEN),
        Part("header", header),
    ])
    total, found = audit.figures["jobs"]["rows"], audit.read("header").withColumn("_at", F.expr("try_cast(collected_at AS timestamp)")).first()
    companies = audit.read("jobs").agg(F.countDistinct("company")).first()[0]
    audit.expect("no_jobs", total > 0)
    audit.expect("staging_schema", found["schema_version"] == STAGING_SCHEMA)
    audit.expect("total_jobs", found["total_jobs"] == total)
    audit.expect("collected_at", found["_at"] is not None)
    audit.expect("companies", found["companies"] == companies)
    audit.expect("workplace_sum", sum((found["by_workplace"] or {}).values()) == total)
    return audit


def publish_refresh(
    spark: SparkSession, out: Refresh, path: str, today: Column, vocabulary: rq.Vocabulary | None = None, fresh_days: int = 3, months: int = 2,
    minimum: int = 1, cap_mb: float = 18, failed: Sequence[str] = (),
) -> Mapping[str, str]:
    """Write and audit the history, the snapshot and (with a vocabulary) the requirement index, then publish them.

    All are audited before any becomes current, so a violated rule leaves what is published as it is.
    """
    audits = {"history": write_version(spark, f"{path}/history", [Part("jobs", out.history, key="job_uid")])}
    audits |= {"snapshot": write_snapshot(spark, f"{path}/snapshot", out.snapshot, out.history, today, fresh_days, months, minimum, cap_mb, out.counts, failed)}
    if vocabulary is not None:
        index = materialize(requirement_index(out.collected, out.batch, vocabulary))
        index = places(index, [F.col(c) for c in (*ORDER, "url")], "ord")
        audits["index"] = write_index(spark, f"{path}/index", index, out.batch)
    problems = [f"{name} {rule}: {n}" for name, audit in audits.items() for rule, n in sorted(audit.violations.items()) if n]
    if problems:
        raise qa.QualityError("; ".join(problems))
    return {name: publish(audit) for name, audit in audits.items()}


def refresh_and_publish(spark: SparkSession, landed: DataFrame, path: str, today: Column, sources: str = "", failed: Sequence[str] = (),
                        vocabulary: rq.Vocabulary | None = None, fresh_days: int = 3, months: int = 2, minimum: int = 1, cap_mb: float = 18, **config) -> Mapping[str, str]:
    """One refresh on top of the published history; what it gives becomes current only as a whole and only if every rule holds."""
    known = current(spark, f"{path}/history") is not None
    history = read_current(spark, f"{path}/history", "jobs") if known else spark.createDataFrame([], HISTORY)
    out = refresh(spark, landed, history, today, sources, failed, fresh_days, months, **config)
    return publish_refresh(spark, out, path, today, vocabulary, fresh_days, months, minimum, cap_mb, [*failed, *out.rejected])
