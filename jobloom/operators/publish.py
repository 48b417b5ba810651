"""Write, audit, publish: tables are written once to a version of their own and become current only if their rules hold.

While a part is written, ``DataFrame.observe`` counts rows, bytes and violations of every row rule, so the audit costs no pass of its
own (only a key that must be unique is read back, as one column).  The rules stand directly before the writer, where each
finished task is counted once.  A version becomes current by one row appended to the list of publications; readers look it up
there.  A refused or broken run leaves its folder unlisted and the version before it in place.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from jobloom.operators.quality import QualityError

MEGABYTE = 1_048_576
#: List of published versions, beside the versions' folders.
PUBLISHED = "published"


@dataclass(frozen=True)
class Part:
    """A table of a publication with what must hold for it.

    ``rules`` are aggregates that count violations; ``key`` must differ between rows; no column may be one of ``forbidden``,
    none of ``required`` may be missing, and with ``allowed`` there may be no others.
    """

    name: str
    rows: DataFrame
    rules: Mapping[str, Column] = field(default_factory=dict)
    key: str | None = None
    cap_mb: float | None = None
    required: Sequence[str] = ()
    forbidden: Sequence[str] = ()
    allowed: Sequence[str] | None = None


@dataclass
class Audit:
    """A written version and what was found while it was written."""

    spark: SparkSession
    path: str
    version: str
    violations: dict[str, int] = field(default_factory=dict)
    figures: dict[str, dict[str, int]] = field(default_factory=dict)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self.version}/{name}")

    def expect(self, rule: str, holds: bool) -> None:
        """A rule that compares parts with each other."""
        self.violations[rule] = int(not holds)

    def report(self) -> DataFrame:
        """``rule, violations``: one row per rule."""
        return self.spark.createDataFrame(sorted(self.violations.items()), "rule string, violations long")


def _write(audit: Audit, part: Part) -> None:
    columns = set(part.rows.columns)
    if part.required:
        audit.violations[f"{part.name}_missing_columns"] = len(set(part.required) - columns)
    if part.forbidden:
        audit.violations[f"{part.name}_private_columns"] = len(set(part.forbidden) & columns)
    if part.allowed is not None:
        audit.violations[f"{part.name}_unknown_columns"] = len(columns - set(part.allowed))
    found = Observation(f"{part.name}-{uuid.uuid4().hex}")
    counted = {
        "_rows": F.count(F.lit(1)),
        "_bytes": F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("bigint")), F.lit(0)),
        **{name: rule.cast("bigint") for name, rule in part.rules.items()},
    }
    rows = part.rows.observe(found, *[value.alias(name) for name, value in counted.items()])
    rows.write.parquet(f"{audit.path}/{audit.version}/{part.name}")
    metrics = found.get
    audit.figures[part.name] = {"rows": metrics["_rows"], "bytes": metrics["_bytes"]}
    audit.violations.update({name: metrics[name] or 0 for name in part.rules})
    if part.cap_mb is not None:
        audit.violations[f"{part.name}_too_large"] = int(metrics["_bytes"] > part.cap_mb * MEGABYTE)
    if part.key is not None:
        keys = audit.read(part.name).groupBy(part.key).agg(F.count(F.lit(1)).alias("n"))
        audit.violations[f"{part.name}_repeated_{part.key}"] = keys.agg(F.sum(F.col("n") - 1)).first()[0] or 0


def write_version(spark: SparkSession, path: str, parts: Iterable[Part]) -> Audit:
    """Write all parts to a new version and audit them; nothing is published yet."""
    audit = Audit(spark, path.rstrip("/"), f"version-{uuid.uuid4().hex}")
    for part in parts:
        _write(audit, part)
    return audit


def publish(audit: Audit) -> str:
    """Make a version current, or raise with the rules that are violated and leave the current one."""
    failed = {rule: n for rule, n in sorted(audit.violations.items()) if n}
    if failed:
        raise QualityError("; ".join(f"{rule}: {n}" for rule, n in failed.items()))
    now = datetime.datetime.now(datetime.timezone.utc)
    rows = [(audit.version, now, name, f["rows"], f["bytes"]) for name, f in sorted(audit.figures.items())]
    listed = audit.spark.createDataFrame(rows, "version string, published_at timestamp, part string, rows long, bytes long")
    listed.coalesce(1).write.mode("append").parquet(f"{audit.path}/{PUBLISHED}")
    return audit.version


def publications(spark: SparkSession, path: str) -> DataFrame | None:
    """Every published version with the size of its parts, or None before the first."""
    try:
        return spark.read.parquet(f"{path.rstrip('/')}/{PUBLISHED}")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current(spark: SparkSession, path: str) -> str | None:
    """The version that readers see."""
    listed = publications(spark, path)
    if listed is None:
        return None
    return listed.agg(F.max_by("version", F.struct("published_at", "version"))).first()[0]


def read_current(spark: SparkSession, path: str, part: str) -> DataFrame:
    version = current(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing has been published in {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{version}/{part}")


__all__ = ["Audit", "Part", "current", "publications", "publish", "read_current", "write_version"]
