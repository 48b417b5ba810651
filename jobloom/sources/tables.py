"""Readers: staging documents, taxonomy, history, landed pages, and host candidates from crawl dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from jobloom import fixed_values as fx
from jobloom.functions.text import strip, text_or_blank
from jobloom.operators.history import conform
from jobloom.schema import TAXONOMY_ENTRY
from jobloom.sources.json_specs import LANDED


class SourceShapeError(ValueError):
    """A file does not have the promised shape."""


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses, stored as Parquet by source."""
    return spark.read.schema(LANDED).parquet(path)


def staging_payload(spark: SparkSession, path: str, source: str = "inhire") -> DataFrame:
    """Staging documents (one JSON list per file, byte order mark allowed) as landed rows; anything else is an error.

    A file whose root is not a list is reported by name.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("url"), F.regexp_replace("value", "^\ufeff", "").alias("body")
    )
    kind = F.schema_of_variant(F.try_parse_json("body"))
    wrong = files.filter(~F.coalesce(kind.startswith("ARRAY"), F.lit(False))).select("url").limit(1).collect()
    if wrong:
        raise SourceShapeError(f"staging file must contain a JSON list: {wrong[0]['url']}")
    return files.select(F.lit(source).alias("source"), F.lit(None).cast("string").alias("board"), F.lit(1).cast("bigint").alias("page"), "url", "body")


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """``entry_ord, id, label, aliases, kind`` in file order.  The file is ``{schema_version: 1, entries: […]}``."""
    document = T.StructType([T.StructField("schema_version", T.IntegerType()), T.StructField("entries", T.ArrayType(TAXONOMY_ENTRY))])
    files = spark.read.schema(document).json(path, multiLine=True)
    shape = files.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.coalesce(F.col("schema_version"), F.lit(0))).alias("v"), F.count_if(F.col("entries").isNull()).alias("bad")
    ).first()
    if shape["n"] != 1 or shape["v"] != 1 or shape["bad"]:
        raise SourceShapeError("taxonomy must be one document with schema_version 1 and a list of entries")
    return files.select(F.posexplode("entries").alias("entry_ord", "e")).select("entry_ord", "e.*")


def taxonomy_aliases(taxonomy: DataFrame) -> DataFrame:
    """One row per alias, folded."""
    from jobloom.functions.text import fold_caseless

    return taxonomy.select("entry_ord", "id", "label", "kind", F.explode("aliases").alias("alias")).withColumn("alias_folded", fold_caseless("alias"))


def read_history(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """History table; a source filter prunes to that source's folder.  Older tables may lack later columns."""
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    return conform(stored.filter(F.col("source") == source) if source else stored)


def host_candidates(texts: DataFrame, column: str, domain: str, excluded: tuple[str, ...] = fx.INFRA_HOSTS, field: bool = False) -> DataFrame:
    """Distinct sub-domain names found in text (or in a host field), without infrastructure names, sorted."""
    quoted = domain.replace(".", r"\.")
    if field:
        found = F.array(F.regexp_extract(text_or_blank(column), rf"(?i)^([a-z0-9-]+)\.{quoted}$", 1))
    else:
        found = F.regexp_extract_all(text_or_blank(column), F.lit(rf"(?i)https?://([a-z0-9-]+)\.{quoted}"), 1)
    slug = F.lower(strip(F.col("slug")))
    named = texts.select(F.explode(found).alias("slug")).select(slug.alias("slug")).distinct()
    return named.filter(F.col("slug").rlike("^[a-z0-9-]{2,}$") & ~F.col("slug").isin(*excluded)).orderBy("slug")


def board_tokens(catalog: DataFrame, column: str, excluded: tuple[str, ...] = fx.EXCLUDED_BOARDS) -> DataFrame:
    """Distinct lower-case board names of a discovery catalog, without those collected elsewhere."""
    name = F.lower(strip(text_or_blank(column)))
    return catalog.select(name.alias("board")).filter((F.col("board") != "") & ~F.col("board").isin(*excluded)).distinct()


def required_boards(spark: SparkSession) -> DataFrame:
    """Boards that are always collected (a fixed list)."""
    return spark.createDataFrame([tuple(r) for r in fx.REQUIRED_BOARDS], "board string, company string, brazil_only boolean")
