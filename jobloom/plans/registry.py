"""Registered queries and the relations they share.

Every query runs over whole tables.  ``ads`` reads ``documents`` as advertisements; ``ads_history`` is the same in
stored form.  The SQL twins of both are used by the comparison queries, so each side derives them on its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom.operators.dedupe import equivalence_key
from jobloom.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

TODAY = "2024-04-30"
NOW = "2024-04-30 12:00:00"


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL twin where SQL can express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def today() -> Column:
    return F.lit(TODAY).cast("date")


def now() -> Column:
    return F.to_timestamp(F.lit(NOW))


# ---------------------------------------------------------------- SQL fragments

_FROM, _TO = "éèêóñüäöçíãõáúÉÈÊÓÑÜÄÖÇÍÃÕÁÚ", "eeeonuaociaoauEEEONUAOCIAOAU"


def sql_search(x: str) -> str:
    return f"trim(lower(translate({x}, '{_FROM}', '{_TO}')), ' \n\t\r')"


def sql_collation(x: str) -> str:
    number = "lpad(CAST(length(ltrim(run, '0')) AS VARCHAR), 5, '0') || ltrim(run, '0')"
    return f"array_to_string([CASE WHEN regexp_matches(run, '^[0-9]') THEN {number} ELSE run END FOR run IN regexp_extract_all({sql_search(x)}, '[0-9]+|[^0-9]+')], '')"


def sql_ascii(x: str) -> str:
    return f"regexp_replace(lower(translate({x}, '{_FROM}', '{_TO}')), '[^\\x00-\\x7F]', '', 'g')"


def sql_squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def sql_caseless(x: str) -> str:
    return sql_squeeze(f"replace(lower(translate({x}, '{_FROM}', '{_TO}')), 'ß', 'ss')")


def sql_resume(x: str) -> str:
    return sql_squeeze(f"lower(translate({x}, '{_FROM}', '{_TO}'))")


def sql_equivalence(x: str) -> str:
    stop = (
        r"\b(pleno|senior|junior|especialista|analista|estagi\w*|trainee|aprendiz|remoto|remote|hibrido|presencial|"
        r"home\s*office|jr|sr|pl|i{1,3}|\d+)\b"
    )
    return f"trim(regexp_replace(regexp_replace({sql_ascii(x)}, '{stop}', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


# ---------------------------------------------------------------- advertisements


def pick(key: Column, *choices) -> Column:
    """Choice number ``key mod n``."""
    out = None
    for i, choice in enumerate(choices):
        test = key % len(choices) == i
        out = F.when(test, choice) if out is None else out.when(test, choice)
    return out


def ads(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("doc_id")
    published = F.date_add(F.lit("2024-01-01").cast("date"), (i % 120).cast("int")).cast("string")
    return table(spark, folder, "documents").select(
        i,
        F.when(F.col("source") == "src0", "gupy").when(F.col("source") == "src1", "greenhouse")
        .when(F.col("source") == "src2", "autozone").otherwise(F.col("source")).alias("source"),
        i.cast("string").alias("native_id"),
        F.col("text").alias("title"),
        F.concat_ws(" ", F.lit("Firma"), "lang", F.translate(F.col("n_chars").cast("string"), "0123456789", "abcdefghij"), F.col("n_chars").cast("string")).alias("company"),
        F.concat(F.when(i % 4 == 0, "http").otherwise("https"), F.lit("://jobs.example.com/"), i.cast("string")).alias("url"),
        pick(i, "", "remote", "hybrid", "on-site").alias("work_model"),
        pick(i, "Brasil", "Recife, PE", "", "remote", "São Paulo · Recife").alias("city"),
        pick(i, "BR", "Brasil", "").alias("country"),
        F.when(F.col("lang") == "en", "Global").when(F.col("lang") == "es", "BR")
        .when(F.col("lang") == "de", "Global remote").otherwise("").alias("market"),
        F.when(i % 11 == 0, "").otherwise(published).alias("published_date"),
        F.when(i % 3 == 0, "").otherwise(F.date_add(F.lit("2024-04-01").cast("date"), (i % 60).cast("int")).cast("string")).alias("expires_date"),
        F.when(i % 7 != 0, (i % 50) * 100.0).alias("salary_min"),
        F.col("text").alias("description"),
        pick(i, F.array(F.lit("CLT")), F.array(F.lit("PJ"), F.lit("CLT")), F.array().cast("array<string>"),
             F.array(F.lit("Cooperado")), F.array(F.lit("pj"))).alias("contract_types"),
        (i % 10 == 0).alias("pcd"),
    )


ADS = """ads AS (
  SELECT doc_id,
    CASE source WHEN 'src0' THEN 'gupy' WHEN 'src1' THEN 'greenhouse' WHEN 'src2' THEN 'autozone' ELSE source END AS source,
    CAST(doc_id AS VARCHAR) AS native_id, text AS title, concat_ws(' ', 'Firma', lang, translate(CAST(n_chars AS VARCHAR), '0123456789', 'abcdefghij'), CAST(n_chars AS VARCHAR)) AS company,
    (CASE WHEN doc_id % 4 = 0 THEN 'http' ELSE 'https' END) || '://jobs.example.com/' || CAST(doc_id AS VARCHAR) AS url,
    CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'remote' WHEN 2 THEN 'hybrid' ELSE 'on-site' END AS work_model,
    CASE doc_id % 5 WHEN 0 THEN 'Brasil' WHEN 1 THEN 'Recife, PE' WHEN 2 THEN '' WHEN 3 THEN 'remote' ELSE 'São Paulo · Recife' END AS city,
    CASE doc_id % 3 WHEN 0 THEN 'BR' WHEN 1 THEN 'Brasil' ELSE '' END AS country,
    CASE lang WHEN 'en' THEN 'Global' WHEN 'es' THEN 'BR' WHEN 'de' THEN 'Global remote' ELSE '' END AS market,
    CASE WHEN doc_id % 11 = 0 THEN '' ELSE CAST(DATE '2024-01-01' + CAST(doc_id % 120 AS INTEGER) AS VARCHAR) END AS published_date,
    CASE WHEN doc_id % 3 = 0 THEN '' ELSE CAST(DATE '2024-04-01' + CAST(doc_id % 60 AS INTEGER) AS VARCHAR) END AS expires_date,
    CASE WHEN doc_id % 7 <> 0 THEN (doc_id % 50) * 100.0::DOUBLE END AS salary_min,
    text AS description,
    CASE doc_id % 5 WHEN 0 THEN ['CLT'] WHEN 1 THEN ['PJ', 'CLT'] WHEN 2 THEN []::VARCHAR[] WHEN 3 THEN ['Cooperado'] ELSE ['pj'] END AS contract_types,
    doc_id % 10 = 0 AS pcd
  FROM documents)"""


def ads_history(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("doc_id")
    first = F.date_add(F.lit("2024-02-01").cast("date"), (i % 88).cast("int")).cast("string")
    return ads(spark, folder).select(
        F.concat_ws(":", "source", "native_id").alias("job_uid"),
        "doc_id", "source", "title", "company",
        pick(i, "Dados", "TI", "Design", "").alias("area"),
        pick(i, "Pleno", "Sênior", "").alias("seniority"),
        "work_model", "city",
        F.lit("").alias("state"),
        "country", "market", "salary_min",
        F.when(i % 7 == 1, (i % 50) * 150.25).alias("salary_max"),
        pick(i, "BRL", "USD", "").alias("salary_currency"),
        "published_date", "expires_date",
        first.alias("first_seen_date"),
        F.date_sub(F.lit(TODAY).cast("date"), (i % 6).cast("int")).cast("string").alias("last_seen_date"),
        "url",
        F.array_join(F.array(F.lit("sql"), F.col("source")), " · ").alias("skills"),
        F.array_join("contract_types", " · ").alias("contract_types"),
        "pcd", (i % 20 == 1).alias("blind_selection"),
        equivalence_key("title", "company").alias("dedupe_key"),
    )


HISTORY = f"""{ADS}, hist AS (
  SELECT source || ':' || native_id AS job_uid, doc_id, source, title, company,
    CASE doc_id % 4 WHEN 0 THEN 'Dados' WHEN 1 THEN 'TI' WHEN 2 THEN 'Design' ELSE '' END AS area,
    CASE doc_id % 3 WHEN 0 THEN 'Pleno' WHEN 1 THEN 'Sênior' ELSE '' END AS seniority,
    work_model, city, '' AS state, country, market, salary_min,
    CASE WHEN doc_id % 7 = 1 THEN (doc_id % 50) * 150.25::DOUBLE END AS salary_max,
    CASE doc_id % 3 WHEN 0 THEN 'BRL' WHEN 1 THEN 'USD' ELSE '' END AS salary_currency,
    published_date, expires_date,
    CAST(DATE '2024-02-01' + CAST(doc_id % 88 AS INTEGER) AS VARCHAR) AS first_seen_date,
    CAST(DATE '{TODAY}' - CAST(doc_id % 6 AS INTEGER) AS VARCHAR) AS last_seen_date,
    url, 'sql · ' || source AS skills, array_to_string(contract_types, ' · ') AS contract_types, pcd,
    doc_id % 20 = 1 AS blind_selection,
    {sql_equivalence('title')} || '|' || {sql_equivalence('company')} AS dedupe_key
  FROM ads), eligible AS (
  SELECT * FROM hist
  WHERE last_seen_date >= '2024-04-28' AND (expires_date = '' OR expires_date >= '{TODAY}')
    AND market NOT IN ('', 'Não informado') AND (source <> 'greenhouse' OR market = 'BR')
    AND (coalesce(nullif(published_date, ''), first_seen_date) >= '2024-02-29' OR (source = 'gupy' AND expires_date >= '{TODAY}')))"""

#: Snapshot rows with position and portal count; a snapshot holds the newest 50,000.
SNAPSHOT_CAP = 50_000
SNAPSHOT = f"""{HISTORY}, newest AS (
  SELECT *, row_number() OVER (ORDER BY greatest(published_date, first_seen_date) DESC, last_seen_date DESC, job_uid) AS position
  FROM eligible QUALIFY position <= {SNAPSHOT_CAP}), snap AS (
  SELECT n.*, p.np FROM newest n JOIN (SELECT dedupe_key, count(DISTINCT source) AS np FROM newest GROUP BY 1) p USING (dedupe_key))"""


def served_sql(source: str = "shown") -> str:
    """Displayed rows from the whole history (position is the document number)."""
    folded = sql_search(
        "concat_ws(' ', title, company, sourceLabel, category, seniority, workplaceType, market, location, skills, "
        "array_to_string(contractTypes, ' '), array_to_string([CASE WHEN lower(c) = 'pj' THEN 'CNPJ' ELSE c END FOR c IN contractTypes], ' '))"
    )
    return f"""{HISTORY}, ported AS (
  SELECT h.*, p.np FROM hist h JOIN (SELECT dedupe_key, count(DISTINCT source) AS np FROM hist GROUP BY 1) p USING (dedupe_key)
), labelled AS (
  SELECT job_uid, title, source,
    CASE source WHEN 'gupy' THEN 'Gupy' WHEN 'greenhouse' THEN 'Greenhouse' WHEN 'autozone' THEN 'AutoZone' ELSE source END AS sourceLabel,
    company, coalesce(nullif(area, ''), 'Outros') AS category, coalesce(nullif(seniority, ''), 'Não informado') AS seniority,
    CASE work_model WHEN 'remote' THEN 'Remoto' WHEN 'hybrid' THEN 'Híbrido' WHEN 'on-site' THEN 'Presencial' ELSE 'Não informada' END AS workplaceType,
    CASE market WHEN 'BR' THEN 'Brasil' WHEN 'Global remote' THEN 'Global remoto' WHEN '' THEN 'Não informado' ELSE market END AS market,
    coalesce(nullif(city, ''), nullif(country, ''), 'Local não informado') AS location,
    CASE doc_id % 5 WHEN 1 THEN ['Recife'] WHEN 4 THEN ['São Paulo', 'Recife'] ELSE []::VARCHAR[] END AS cities,
    {sql_search('city')} AS _location,
    coalesce(nullif(published_date, ''), first_seen_date) AS publishedAt, last_seen_date AS lastSeenAt,
    np AS portals, skills, pcd, doc_id,
    CASE WHEN contract_types = '' THEN []::VARCHAR[] ELSE string_split(contract_types, ' · ') END AS contractTypes,
    CAST(least(epoch(CAST(coalesce(nullif(published_date, ''), first_seen_date) AS TIMESTAMP) + INTERVAL 12 HOUR), epoch(TIMESTAMP '{NOW}')) AS BIGINT) AS activity
  FROM ported
), {source} AS (SELECT *, {folded} AS _search FROM labelled)"""
