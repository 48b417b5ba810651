"""Filters, projections and joins over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.functions import text as tx
from jobloom.operators import aggregates as ag
from jobloom.operators import enrich, filters as fl, history as hi, search as se, sinks, snapshot as sn
from jobloom.operators.dedupe import with_portals
from jobloom.operators.quality import private_text_leaks
from jobloom.operators.text_search import build, indexed_search, vocabulary_hits
from jobloom.plans.registry import (
    ADS, HISTORY, NOW, SNAPSHOT, SNAPSHOT_CAP, TODAY, ads, ads_history, now, pick, query, served_sql, sql_ascii,
    sql_caseless, today,
)
from jobloom.schema import as_canonical
from jobloom.session import ensure_checkpoint_dir, table

# ---------------------------------------------------------------- filters


@query("flt_01_row_validity", f"""WITH {ADS}, x AS (
  SELECT source, CASE WHEN doc_id % 9 = 0 THEN '' ELSE title END AS title, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE url END AS url FROM ads)
SELECT source, count(*) FILTER (WHERE coalesce(title, '') <> '' AND coalesce(url, '') <> '') AS kept,
  count(*) FILTER (WHERE NOT (coalesce(title, '') <> '' AND coalesce(url, '') <> '')) AS dropped FROM x GROUP BY source""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = ads(spark, folder).withColumns(
        {"title": F.when(F.col("doc_id") % 9 == 0, "").otherwise(F.col("title")), "url": F.when(F.col("doc_id") % 13 != 0, F.col("url"))}
    )
    ok = fl.is_valid_row()
    return rows.groupBy("source").agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"))


@query("flt_02_source_selection", f"WITH {ADS} SELECT source, native_id FROM ads WHERE source IN ('gupy', 'src3')")
def _(spark, folder):
    known = ["gupy", "greenhouse", "autozone", *[f"src{i}" for i in range(3, 20)]]
    return fl.selected_sources(ads(spark, folder), "gupy, SRC3", known).select("source", "native_id")


@query("flt_03_market_from_city", f"""WITH {ADS} SELECT doc_id, CASE WHEN lower(trim(city)) IN ('brazil', 'brasil') THEN 'BR' ELSE market END AS market FROM ads""")
def _(spark, folder):
    return ads(spark, folder).select("doc_id", fl.market_from_city(F.col("city"), F.col("market")).alias("market"))


_INFER = """CASE WHEN trim(work_model) <> '' OR NOT (lower(country) IN ('br', 'brasil', 'brazil') OR lower(market) = 'br') THEN work_model
    WHEN lower(city) IN ('br', 'brasil', 'brazil', 'remoto', 'remote', 'home office') OR (city = '' AND lower(country) IN ('brasil', 'brazil')) THEN 'remote'
    WHEN city <> '' THEN 'on-site' ELSE work_model END"""


@query("flt_04_work_model_inference", f"""WITH {ADS}, x AS (SELECT doc_id, work_model AS old, {_INFER} AS work_model FROM ads)
SELECT doc_id, work_model, old = '' AND work_model <> '' AS filled FROM x""")
def _(spark, folder):
    return fl.with_inferred_work_model(ads(spark, folder), "filled").select("doc_id", "work_model", "filled")


@query("flt_05_unknown_market", f"WITH {ADS} SELECT doc_id, market FROM ads WHERE market NOT IN ('', 'Não informado')")
def _(spark, folder):
    return ads(spark, folder).filter(fl.market_is_known(F.col("market"))).select("doc_id", "market")


@query("flt_06_old_publications", f"""WITH {ADS} SELECT doc_id, published_date FROM ads WHERE published_date = '' OR published_date >= '2024-02-29'
  OR (source = 'gupy' AND expires_date <> '' AND expires_date >= '{TODAY}')""")
def _(spark, folder):
    keep = fl.is_recent_publication(F.col("published_date"), F.col("expires_date"), F.col("source"), today())
    return ads(spark, folder).filter(keep).select("doc_id", "published_date")


@query("flt_07_retention_prune", f"""WITH {HISTORY} SELECT job_uid FROM hist WHERE NOT (last_seen_date < '2024-04-27'
  OR (coalesce(nullif(published_date, ''), first_seen_date) < '2024-02-29' AND NOT (source = 'gupy' AND expires_date >= '{TODAY}'))
  OR (source = 'greenhouse' AND market <> 'BR'))""")
def _(spark, folder):
    return hi.prune(ads_history(spark, folder), today(), keep_days=3).select("job_uid")


@query("flt_08_snapshot_eligibility", f"WITH {HISTORY} SELECT job_uid, source FROM eligible")
def _(spark, folder):
    return ads_history(spark, folder).filter(fl.is_eligible(today())).select("job_uid", "source")


@query("flt_09_faceted_search", f"""WITH {served_sql()}
SELECT job_uid, title, company, market, portals FROM shown
WHERE contains(_search, 'the') AND list_contains([lower(c) FOR c IN contractTypes], 'pj') AND market = 'Global'
  AND (len([c FOR c IN cities IF contains(lower(c), 'recife')]) > 0 OR contains(_location, 'recife'))
  AND activity <> 0 AND epoch(TIMESTAMP '{NOW}') - activity <= 90 * 86400""")
def _(spark, folder):
    spec = se.SearchSpec(text="The ", contract="CNPJ", market="Global", city="Récife", days=90)
    return se.search(shown(spark, folder), spec, now()).select("job_uid", "title", "company", "market", "portals")


#: Searches of the stored index: rare, frequent, shorter than a trigram, absent, with blanks.
_SEARCHES = ("shorerer", "the", "th", "zzzyx", "of the", "eau enauxoi", "firma de")


@query("flt_09_indexed_search", f"WITH {served_sql()}, w AS (SELECT unnest({list(_SEARCHES)}) AS wanted) SELECT wanted, job_uid FROM shown JOIN w ON contains(_search, wanted) WHERE market IN ('Global', 'Brasil')")
def _(spark, folder):
    path = f"{ensure_checkpoint_dir(spark)}/search-{uuid.uuid4().hex}"
    build(shown(spark, folder).select("position", "job_uid", "market", "_search"), path)
    out = None
    for wanted in _SEARCHES:
        found = indexed_search(spark, path, wanted, F.col("market").isin("Global", "Brasil"))
        part = found.select(F.lit(wanted).alias("wanted"), "job_uid")
        out = part if out is None else out.unionByName(part)
    return out


def shown(spark, folder) -> DataFrame:
    rows = with_portals(ads_history(spark, folder)).withColumn("position", F.col("doc_id"))
    return se.served(sn.public_columns(rows, extra=(F.col("portals").alias("np"),)), now())


_PLACE = "regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[./?=&]', ' ', 'g')"


def _places(spark, folder) -> DataFrame:
    place = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[./?=&]", " ")
    return table(spark, folder, "pages").select("page_id", place.alias("place"), "url")


@query("flt_10_place_names", f"SELECT page_id, regexp_matches({_PLACE}, '(?i)\\b(?:blog|net|fr)\\b') AS home FROM pages")
def _(spark, folder):
    return _places(spark, folder).select("page_id", fl.names_brazil(F.col("place"), r"(?iu)\b(?:blog|net|fr)\b").alias("home"))


@query("flt_11_place_codes", f"""SELECT page_id, {_PLACE} AS place FROM pages
WHERE regexp_matches({_PLACE}, '(?i)\\bblog\\b') OR regexp_matches(upper({_PLACE}), '(?:^|[,/()\\s-])(?:FR|ES)(?:$|[,/()\\s-])')""")
def _(spark, folder):
    rows = _places(spark, folder)
    upper = F.upper("place")
    keep = fl.names_brazil(F.col("place"), r"(?iu)\bblog\b") | fl.names_brazil_or_state(upper, r"(?u)\bblog\b", ("FR", "ES"))
    return rows.filter(keep).select("page_id", "place")


@query("flt_12_override_filter", f"""WITH board AS (SELECT n_nationkey AS b, n_nationkey % 5 = 0 AS brazil_only FROM nation)
SELECT page_id FROM pages LEFT JOIN board ON page_id % 40 = b WHERE coalesce(brazil_only, false) OR regexp_matches({_PLACE}, '(?i)\\b(?:org|es)\\b')""")
def _(spark, folder):
    board = table(spark, folder, "nation").select(F.col("n_nationkey").alias("b"), (F.col("n_nationkey") % 5 == 0).alias("brazil_only"))
    rows = _places(spark, folder).join(board, F.col("page_id") % 40 == F.col("b"), "left")
    return rows.filter(fl.accepted_place(F.col("brazil_only"), F.col("place"), r"(?iu)\b(?:org|es)\b")).select("page_id")


@query("flt_13_published_without_demo", """WITH x AS (SELECT o_orderpriority AS tenant_group,
  CASE o_orderstatus WHEN 'O' THEN 'Published' WHEN 'F' THEN 'published' ELSE 'draft' END AS status,
  CASE WHEN o_custkey % 50 = 0 THEN 'demo' ELSE 't' || o_custkey END AS slug FROM orders)
SELECT tenant_group, count(*) FILTER (WHERE slug <> 'demo') AS published, count(*) FILTER (WHERE slug = 'demo') AS excluded_demo
FROM x WHERE lower(status) = 'published' GROUP BY 1""")
def _(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("tenant_group"),
        F.when(F.col("o_orderstatus") == "O", "Published").when(F.col("o_orderstatus") == "F", "published").otherwise("draft").alias("status"),
        F.when(F.col("o_custkey") % 50 == 0, "demo").otherwise(F.concat(F.lit("t"), F.col("o_custkey").cast("string"))).alias("slug"),
    )
    demo = fl.is_demo_tenant(F.col("slug"), F.col("slug"))
    return rows.filter(fl.is_published(F.col("status"))).groupBy("tenant_group").agg(
        F.count_if(~demo).alias("published"), F.count_if(demo).alias("excluded_demo")
    )


@query("flt_14_recency_stop_flag", """WITH x AS (SELECT o_custkey AS page,
  CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)
SELECT page, bool_and(d <> '') AND bool_or(d <> '' AND d < '1998-12-01') AS stop, count(*) FILTER (WHERE d = '' OR d >= '1998-12-01') AS kept
FROM x GROUP BY page""")
def _(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("page"),
        F.when(F.col("o_orderkey") % 97 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"),
    )
    return fl.page_crosses_cutoff(rows, "page", "d", F.lit("1998-12-01"))


@query("flt_15_usable_descriptions", f"SELECT doc_id FROM documents WHERE length({sql_caseless('text')}) >= 120")
def _(spark, folder):
    return table(spark, folder, "documents").filter(fl.has_usable_description(F.col("text"))).select("doc_id")


# ---------------------------------------------------------------- projections


@query("prj_01_snapshot_projection", f"""WITH {HISTORY}
SELECT job_uid, title, company, coalesce(nullif(city, ''), state) AS city, coalesce(nullif(published_date, ''), first_seen_date) AS pub,
  substr(last_seen_date, 1, 10) AS seen, substr(expires_date, 1, 10) AS exp, regexp_replace(url, 'http://', 'https://') AS url,
  CASE WHEN salary_min <> 0 THEN round_even(salary_min, 2) END AS smin, CASE WHEN salary_max <> 0 THEN round_even(salary_max, 2) END AS smax,
  CAST(pcd AS INTEGER) AS pcd, CAST(blind_selection AS INTEGER) AS blind, skills AS sk, contract_types AS ct FROM hist""")
def _(spark, folder):
    rows = sn.public_columns(ads_history(spark, folder).withColumn("position", F.col("doc_id")))
    return rows.select("job_uid", "title", "company", "city", "pub", "seen", "exp", "url", "smin", "smax", "pcd", "blind", "sk", "ct")


@query("prj_02_serve_projection", f"""WITH {served_sql()}
SELECT job_uid, title, sourceLabel, company, category, seniority, workplaceType, market, location, array_to_string(cities, '|') AS cities,
  publishedAt, lastSeenAt, portals, array_to_string(contractTypes, '|') AS contracts, activity, _search AS search_text FROM shown""")
def _(spark, folder):
    return shown(spark, folder).select(
        "job_uid", "title", "sourceLabel", "company", "category", "seniority", "workplaceType", "market", "location",
        F.array_join("cities", "|").alias("cities"), "publishedAt", "lastSeenAt", "portals",
        F.array_join("contractTypes", "|").alias("contracts"), "activity", F.col("_search").alias("search_text"),
    )


@query("prj_03_canonical_defaults", f"""WITH {ADS}
SELECT source, native_id, trim(title, ' \n\t\r') AS title, company, url, work_model, city, '' AS state, country, market, salary_min, CAST(NULL AS DOUBLE) AS salary_max,
  CAST(NULL AS VARCHAR) AS salary_currency, published_date, expires_date, '' AS skills, '' AS levels, array_to_string(contract_types, '|') AS contract_types,
  pcd, false AS blind_selection FROM ads""")
def _(spark, folder):
    rows = as_canonical(ads(spark, folder).drop("description"))
    lists = {c: F.array_join(c, "|") for c in ("skills", "levels", "contract_types")}
    return rows.withColumns(lists).drop("description", "categories")


@query("prj_04_link_rewrite", f"""WITH {HISTORY}, s AS (
  SELECT *, regexp_replace(regexp_replace({sql_ascii('title')}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM hist), t AS (
  SELECT *, 'https://vagas.example.com/vaga/' || native || '/' || coalesce(nullif(regexp_replace(substr(slug, 1, 120), '-+$', ''), ''), 'vaga') AS link
  FROM (SELECT *, CAST(doc_id AS VARCHAR) AS native FROM s))
SELECT job_uid, CASE WHEN source = 'src5' THEN link ELSE url END AS url, source = 'src5' AND link <> url AS changed FROM t""")
def _(spark, folder):
    build = hi.portal_link("https://vagas.example.com/vaga")
    return hi.rewrite_links(ads_history(spark, folder), "src5", build, "changed").select("job_uid", "url", "changed")


@query("prj_05_private_text", f"""WITH {ADS} SELECT source,
  count(*) FILTER (WHERE length(description) > 0 AND (contains(title, description) OR contains(company, description))) AS leaks FROM ads GROUP BY source""")
def _(spark, folder):
    rows = ads(spark, folder)
    leaks = F.count_if((F.length("description") > 0) & (F.col("title").contains(F.col("description")) | F.col("company").contains(F.col("description"))))
    assert "description" not in sinks.without_private(rows).columns
    return rows.groupBy("source").agg(leaks.alias("leaks"))


# ---------------------------------------------------------------- joins


def _stored(spark, folder) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, folder, "orders").filter(k % 10 < 8).select(
        F.concat(F.lit("orders:"), k.cast("string")).alias("job_uid"),
        F.when(F.col("o_orderstatus") == "O", "totvs").when(F.col("o_orderstatus") == "F", "greenhouse").otherwise("gupy").alias("source"),
        F.when(k % 7 == 0, "").otherwise(F.col("o_orderpriority")).alias("work_model"),
        F.col("o_totalprice").alias("salary_min"),
        pick(k, "Recife", "Lisboa", "São Paulo").alias("city"),
        F.lit("1998-01-01").alias("first_seen_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_seen_date"),
    )


def _batch(spark, folder) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, folder, "orders").filter(k % 10 >= 5).select(
        F.concat(F.lit("orders:"), k.cast("string")).alias("job_uid"),
        F.when(F.col("o_orderstatus") == "O", "totvs").when(F.col("o_orderstatus") == "F", "greenhouse").otherwise("gupy").alias("source"),
        F.when(k % 3 == 0, "").otherwise(F.lit("hybrid")).alias("work_model"),
        (F.col("o_totalprice") + 1.0).alias("salary_min"),
        pick(k, "Recife", "Lisboa", "São Paulo").alias("city"),
    )


ORDERS_HISTORY = """src AS (SELECT *, 'orders:' || o_orderkey AS job_uid,
    CASE o_orderstatus WHEN 'O' THEN 'totvs' WHEN 'F' THEN 'greenhouse' ELSE 'gupy' END AS source,
    CASE o_orderkey % 3 WHEN 0 THEN 'Recife' WHEN 1 THEN 'Lisboa' ELSE 'São Paulo' END AS city FROM orders),
stored AS (SELECT job_uid, source, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS work_model, o_totalprice AS salary_min, city,
    '1998-01-01' AS first_seen_date, strftime(o_orderdate, '%Y-%m-%d') AS last_seen_date FROM src WHERE o_orderkey % 10 < 8),
batch AS (SELECT job_uid, source, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'hybrid' END AS work_model, o_totalprice + 1.0 AS salary_min, city FROM src WHERE o_orderkey % 10 >= 5),
merged AS (SELECT coalesce(s.job_uid, b.job_uid) AS job_uid, coalesce(b.source, s.source) AS source,
    CASE WHEN b.job_uid IS NULL THEN s.work_model WHEN s.job_uid IS NULL THEN b.work_model ELSE coalesce(nullif(b.work_model, ''), s.work_model) END AS work_model,
    CASE WHEN b.job_uid IS NULL THEN s.salary_min ELSE b.salary_min END AS salary_min, coalesce(b.city, s.city) AS city,
    coalesce(s.first_seen_date, '1998-12-01') AS first_seen_date,
    CASE WHEN b.job_uid IS NULL THEN s.last_seen_date ELSE '1998-12-01' END AS last_seen_date,
    CASE WHEN b.job_uid IS NULL THEN 'kept' WHEN s.job_uid IS NULL THEN 'inserted' ELSE 'updated' END AS change
  FROM stored s FULL OUTER JOIN batch b ON s.job_uid = b.job_uid)"""
_DAY = "1998-12-01"


def _merged(spark, folder, change=None) -> DataFrame:
    return hi.merge(_stored(spark, folder), _batch(spark, folder), F.lit(_DAY), change=change)


@query("jon_01_upsert", f"WITH {ORDERS_HISTORY} SELECT * FROM merged")
def _(spark, folder):
    return _merged(spark, folder, "change")


@query("agg_10_change_counts", f"""WITH {ORDERS_HISTORY} SELECT count(*) FILTER (WHERE change = 'inserted') AS inserted,
  count(*) FILTER (WHERE change = 'updated') AS updated, count(*) FILTER (WHERE change = 'kept') AS kept FROM merged""")
def _(spark, folder):
    return hi.change_counts(_merged(spark, folder, "change"), "change")


@query("jon_02_purge_absent", f"""WITH {ORDERS_HISTORY} SELECT job_uid, source FROM merged
WHERE source <> 'totvs' OR job_uid IN (SELECT job_uid FROM batch WHERE source = 'totvs')""")
def _(spark, folder):
    current = _batch(spark, folder).filter(F.col("source") == "totvs")
    return hi.purge_absent(_merged(spark, folder), "totvs", current).select("job_uid", "source")


@query("jon_03_purge_foreign", f"""WITH {ORDERS_HISTORY} SELECT job_uid, source, city FROM merged
WHERE source <> 'greenhouse' OR job_uid IN (SELECT job_uid FROM batch) OR city IN ('Recife', 'São Paulo')""")
def _(spark, folder):
    current = _batch(spark, folder).filter(F.col("source") == "greenhouse")
    return hi.purge_foreign(_merged(spark, folder), "greenhouse", current).select("job_uid", "source", "city")


@query("jon_04_detail_reuse", """WITH listing AS (SELECT o_orderkey AS k, 'o' || o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderpriority END AS title,
    o_orderstatus AS location, 'c' || o_custkey AS company FROM orders),
cache AS (SELECT 'o' || o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'changed' ELSE lower(o_orderpriority) END AS title, o_orderstatus AS location,
    CASE WHEN o_orderkey % 9 = 0 THEN 'other' ELSE 'C' || o_custkey END AS company, o_orderkey % 48 AS age FROM orders WHERE o_orderkey % 6 <> 0)
SELECT l.id, coalesce(c.age < 24 AND (l.title = '' OR lower(l.title) = lower(c.title)) AND lower(l.company) = lower(c.company), false) AS reuse
FROM listing l LEFT JOIN cache c USING (id)""")
def _(spark, folder):
    k = F.col("o_orderkey")
    orders = table(spark, folder, "orders")
    ident = F.concat(F.lit("o"), k.cast("string")).alias("id")
    listing = orders.select(
        ident, F.when(k % 4 == 0, "").otherwise(F.col("o_orderpriority")).alias("title"), F.col("o_orderstatus").alias("location"),
        F.lit("remote").alias("workplaceType"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("company"),
    )
    fetched = F.timestamp_seconds(F.unix_seconds(now()) - (k % 48) * 3600)
    cache = orders.filter(k % 6 != 0).select(
        ident, F.when(k % 5 == 0, "changed").otherwise(F.lower("o_orderpriority")).alias("title"), F.col("o_orderstatus").alias("location"),
        F.lit("Remoto").alias("workplaceType"),
        F.when(k % 9 == 0, "other").otherwise(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("company"),
        fetched.cast("string").alias("detailFetchedAt"),
    )
    return enrich.reusable_details(listing, cache, now()).select("id", "reuse")


@query("jon_05_overlay_details", """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 0 THEN p_type ELSE p_brand END AS city,
  CASE WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 0 THEN 'D' ELSE 'C' END AS state,
  CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS work_model FROM part""")
def _(spark, folder):
    part, k = table(spark, folder, "part"), F.col("p_partkey")
    cards = part.select(k, F.col("p_brand").alias("city"), F.lit("C").alias("state"), F.col("p_name").alias("work_model"))
    details = part.filter(k % 3 == 0).select(
        k, F.when(k % 2 == 0, F.col("p_type")).otherwise("").alias("city"), F.lit("D").alias("state"), F.upper("p_name").alias("work_model")
    )
    return enrich.overlay_non_blank(cards, details, "p_partkey", [("city", "state"), ("work_model",)])


@query("jon_06_append_monitored", """WITH base AS (SELECT s_suppkey AS id, s_name AS title FROM supplier WHERE s_suppkey % 3 <> 0),
exact AS (SELECT s_suppkey AS id, 'exact ' || s_name AS title FROM supplier WHERE s_suppkey % 2 = 0)
SELECT * FROM base UNION ALL
SELECT m.s_suppkey, coalesce(e.title, 'card ' || m.s_name) FROM supplier m LEFT JOIN exact e ON e.id = m.s_suppkey WHERE m.s_suppkey NOT IN (SELECT id FROM base)""")
def _(spark, folder):
    s = table(spark, folder, "supplier")
    row = lambda prefix: s.select(F.col("s_suppkey").alias("id"), F.concat(F.lit(prefix), "s_name").alias("title"))
    return enrich.append_missing(row("").filter("id % 3 <> 0"), row("card "), row("exact ").filter("id % 2 = 0"), "id")


@query("jon_07_config_overlay", """WITH e AS (SELECT s_suppkey AS board, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS company FROM supplier),
r AS (SELECT c_custkey AS board, c_name AS company, c_custkey % 10 = 0 AS brazil_only FROM customer)
SELECT coalesce(e.board, r.board) AS board, coalesce(e.company, r.company) AS company, r.brazil_only FROM e FULL OUTER JOIN r ON e.board = r.board""")
def _(spark, folder):
    existing = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("board"), F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")).alias("company")
    )
    required = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("board"), F.col("c_name").alias("company"), (F.col("c_custkey") % 10 == 0).alias("brazil_only")
    )
    return enrich.overlay_defaults(existing, required, "board")


@query("jon_08_document_references", """SELECT p_partkey, p_name || '|' || CASE WHEN p_partkey % 2 = 0 THEN upper(p_brand) ELSE p_brand END AS names FROM part""")
def _(spark, folder):
    part = lambda kind, number, name: F.struct(F.lit(kind).alias("type"), F.lit(number).alias("id"), name.alias("name"))
    # a later part with the same identity wins; unknown references give nothing
    again = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_brand")).otherwise(F.col("p_brand"))
    included = F.array(
        part("level", "1", F.col("p_brand")), part("area", "2", F.col("p_type")), part("level", "2", F.col("p_name")), part("level", "1", again)
    )
    reference = lambda number: F.struct(F.lit("level").alias("type"), F.lit(number).alias("id"))
    refs = F.array(reference("2"), reference("1"), reference("9"), reference("2"))
    documents = table(spark, folder, "part").select("p_partkey", included.alias("included"), refs.alias("refs"))
    out = enrich.resolve_references(documents, "p_partkey", "refs", "included")
    return out.select("p_partkey", F.array_join("names", "|").alias("names"))


#: Every word of the benchmark items and every word pair of two-letter beginnings, as a vocabulary table.
_TERMS_SQL = f"SELECT DISTINCT unnest(regexp_extract_all({sql_caseless('text')}, '[a-z0-9]+')) AS term FROM benchmark UNION SELECT DISTINCT lang || ' the' FROM documents UNION SELECT DISTINCT p_name FROM part"


@query("jon_09_text_theta_join", f"WITH v AS ({_TERMS_SQL}), d AS (SELECT doc_id, " + sql_caseless("text") + """ AS t FROM documents)
SELECT doc_id, term FROM d JOIN v ON contains(t, term) AND CASE WHEN length(term) <= 4 THEN regexp_matches(t, '(^|[^a-z0-9])' || term || '($|[^a-z0-9])') ELSE true END""")
def _(spark, folder):
    words = F.regexp_extract_all(tx.fold_caseless("text"), F.lit("([a-z0-9]+)"), F.lit(1))
    terms = table(spark, folder, "benchmark").select(F.explode(words).alias("term"))
    terms = terms.unionByName(table(spark, folder, "documents").select(F.concat("lang", F.lit(" the")).alias("term")).distinct())
    terms = terms.unionByName(table(spark, folder, "part").select(F.col("p_name").alias("term")).distinct())
    folded = table(spark, folder, "documents").select("doc_id", tx.fold_caseless("text").alias("t"))
    return vocabulary_hits(folded, terms, "t")


@query("jon_11_label_lookup", """SELECT o_orderkey, coalesce(CASE lower(o_orderpriority) WHEN '1-urgent' THEN 'Liderança' WHEN '2-high' THEN 'Sênior' WHEN '3-medium' THEN 'Pleno' END, 'Não informado') AS level FROM orders""")
def _(spark, folder):
    levels = {"1-urgent": "Liderança", "2-high": "Sênior", "3-medium": "Pleno"}
    label = F.coalesce(tx.lookup(levels, tx.fold_ascii("o_orderpriority")), F.lit("Não informado"))
    return table(spark, folder, "orders").select("o_orderkey", label.alias("level"))


@query("jon_12_membership_guard", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def _(spark, folder):
    index = table(spark, folder, "labels").filter("quality = 1")
    return enrich.members_only(table(spark, folder, "documents").select("doc_id", "source"), index, "doc_id").select("doc_id", "source")


# ---------------------------------------------------------------- set operations


@query("set_01_registry_union", """SELECT 0 AS registry_ord, 'suppliers' AS registry_name, s_suppkey AS id, s_name AS title, CAST(NULL AS VARCHAR) AS segment FROM supplier
UNION ALL SELECT 2, 'customers', c_custkey, c_name, c_mktsegment FROM customer""")
def _(spark, folder):
    from jobloom.operators.ordering import in_registry_order

    s = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"))
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("segment"))
    failed = s.limit(0)
    return in_registry_order([s, failed, c], ["suppliers", "broken", "customers"]).select("registry_ord", "registry_name", "id", "title", "segment")


@query("set_02_difference", "SELECT c_custkey AS id FROM customer EXCEPT SELECT s_suppkey FROM supplier")
def _(spark, folder):
    known = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"))
    return enrich.unseen(table(spark, folder, "customer").select(F.col("c_custkey").alias("id")), known, "id")


@query("set_03_union_distinct", "SELECT lower(n) AS slug FROM (SELECT p_type AS n FROM part UNION SELECT c_mktsegment FROM customer UNION SELECT event_type FROM events)")
def _(spark, folder):
    slugs = table(spark, folder, "part").select(F.lower("p_type").alias("slug"))
    for name, column in (("customer", "c_mktsegment"), ("events", "event_type")):
        slugs = slugs.union(table(spark, folder, name).select(F.lower(column)))
    return slugs.distinct()


@query("set_04_forbidden_overlap", "SELECT DISTINCT event_type AS key FROM events WHERE event_type IN ('error', 'signup', 'email')")
def _(spark, folder):
    forbidden = F.array(*[F.lit(k) for k in ("error", "signup", "email")])
    return table(spark, folder, "events").filter(F.arrays_overlap(F.array("event_type"), forbidden)).select(F.col("event_type").alias("key")).distinct()


@query("set_05_ordered_union", """SELECT p_partkey, concat_ws('|', p_brand, CASE WHEN p_type <> p_brand THEN p_type END, CASE WHEN p_name NOT IN (p_brand, p_type) THEN p_name END) AS labels FROM part""")
def _(spark, folder):
    from jobloom.functions.arrays import ordered_union

    labels = ordered_union(F.array("p_brand"), F.array("p_type", "p_brand"), F.array("p_name", "p_type"))
    return table(spark, folder, "part").select("p_partkey", F.array_join(labels, "|").alias("labels"))


# ---------------------------------------------------------------- source health and history scans


@query("src_07_seed_fallback", "SELECT s_suppkey AS id, s_name AS title FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer")
def _(spark, folder):
    live = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"))
    seed = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    # one portal answers and keeps its rows; another is silent and falls back to its seed
    return enrich.seed_fallback(live, seed).unionByName(enrich.seed_fallback(live.filter("id < 0"), seed))
