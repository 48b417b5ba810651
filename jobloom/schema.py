"""Relations shared by every stage, and the constructor for the canonical job row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

_S, _D, _B = T.StringType(), T.DoubleType(), T.BooleanType()
_A = T.ArrayType(T.StringType())

#: One advertisement as collected from a portal.
JOB = T.StructType(
    [
        T.StructField("source", _S),
        T.StructField("native_id", _S),
        T.StructField("title", _S),
        T.StructField("company", _S),
        T.StructField("url", _S),
        T.StructField("work_model", _S),
        T.StructField("city", _S),
        T.StructField("state", _S),
        T.StructField("country", _S),
        T.StructField("market", _S),
        T.StructField("salary_min", _D),
        T.StructField("salary_max", _D),
        T.StructField("salary_currency", _S),
        T.StructField("published_date", _S),
        T.StructField("expires_date", _S),
        T.StructField("skills", _A),
        T.StructField("description", _S),
        T.StructField("levels", _A),
        T.StructField("categories", _A),
        T.StructField("contract_types", _A),
        T.StructField("pcd", _B),
        T.StructField("blind_selection", _B),
    ]
)

#: Columns that are absent (NULL) rather than blank when a portal does not give them.
NULLABLE = ("salary_min", "salary_max", "salary_currency")

#: The accumulated table: one row per ``job_uid``; descriptions are never stored.
HISTORY = T.StructType(
    [
        T.StructField("job_uid", _S),
        T.StructField("source", _S),
        T.StructField("title", _S),
        T.StructField("company", _S),
        T.StructField("area", _S),
        T.StructField("seniority", _S),
        T.StructField("work_model", _S),
        T.StructField("city", _S),
        T.StructField("state", _S),
        T.StructField("country", _S),
        T.StructField("market", _S),
        T.StructField("salary_min", _D),
        T.StructField("salary_max", _D),
        T.StructField("salary_currency", _S),
        T.StructField("published_date", _S),
        T.StructField("expires_date", _S),
        T.StructField("first_seen_date", _S),
        T.StructField("last_seen_date", _S),
        T.StructField("url", _S),
        T.StructField("skills", _S),
        T.StructField("contract_types", _S),
        T.StructField("pcd", _B),
        T.StructField("blind_selection", _B),
        T.StructField("dedupe_key", _S),
    ]
)

#: Requirement taxonomy file (``entries`` array).
TAXONOMY_ENTRY = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("label", _S),
        T.StructField("aliases", _A),
        T.StructField("kind", _S),
    ]
)


def _default(field: T.StructField) -> Column:
    if field.name in NULLABLE:
        return F.lit(None).cast(field.dataType)
    if isinstance(field.dataType, T.ArrayType):
        return F.array().cast(field.dataType)
    if isinstance(field.dataType, T.BooleanType):
        return F.lit(False)
    return F.lit("")


def canonical(values: dict[str, Column]) -> list[Column]:
    """Canonical columns from a partial mapping; anything missing or NULL gets the field's default.

    Title and company are trimmed, so a title of blanks counts as missing later on.
    """
    from jobloom.functions.text import strip

    unknown = set(values) - set(JOB.fieldNames())
    if unknown:
        raise ValueError(f"not canonical fields: {sorted(unknown)}")
    out = []
    for field in JOB.fields:
        column = values.get(field.name)
        if column is None:
            value = _default(field)
        else:
            value = column.cast(field.dataType)
            if field.name in ("title", "company"):
                value = strip(value)
            value = F.coalesce(value, _default(field))
        out.append(value.alias(field.name))
    return out


def as_canonical(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project any frame with a subset of the canonical columns to the full canonical relation."""
    have = {name: F.col(name) for name in JOB.fieldNames() if name in df.columns}
    return df.select(*canonical(have), *[F.col(name) for name in keep])


def job_uid(source: Column, native_id: Column, url: Column) -> Column:
    """``source:native_id``, or ``source:url`` when the portal gives no identifier."""
    from jobloom.functions.text import blank_to_null

    return F.concat(source, F.lit(":"), F.coalesce(blank_to_null(native_id), url, F.lit("")))
