"""De-duplication, aggregates, dictionary codes, orders and pages over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom import fixed_values as fx
from jobloom.functions.text import fold_search, squeeze
from jobloom.operators import aggregates as ag, dedupe as dd, ordering as od, search as se, sinks, snapshot as sn
from jobloom.operators.quality import accepted_rows, complete_catalogs
from jobloom.plans.registry import (
    ADS, HISTORY, NOW, SNAPSHOT, SNAPSHOT_CAP, TODAY, ads, ads_history, now, query, served_sql, sql_collation, sql_search, today,
)
from jobloom.plans.publication import write_snapshot
from jobloom.plans.queries_rows import shown
from jobloom.session import ensure_checkpoint_dir, materialize, table

# ---------------------------------------------------------------- repeats


@query("ded_01_keep_last_native", """SELECT arg_max(event_id, event_id) AS event_id, user_id, event_type, arg_max(value, event_id) AS value, min(event_id) AS first_id
FROM events GROUP BY user_id, event_type""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    key = F.concat_ws(":", F.col("event_type"), F.col("user_id").cast("string"))
    return dd.keep_last(rows, [key], ["event_id"], position="first_id")


@query("ded_02_keep_first", "SELECT event_id, user_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1")
def _(spark, folder):
    return dd.keep_first(table(spark, folder, "events").select("event_id", "user_id", "value"), ["user_id"], ["event_id"])


@query("ded_03_keep_last_pages", """SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1""")
def _(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    return dd.keep_last(rows, ["l_partkey"], ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query("ded_04_equivalence_key", f"WITH {HISTORY} SELECT job_uid, dedupe_key FROM hist")
def _(spark, folder):
    return ads_history(spark, folder).select("job_uid", "dedupe_key")


@query("ded_05_portal_multiplicity", f"""WITH {HISTORY} SELECT dedupe_key, count(DISTINCT source) AS portals, count(*) AS n FROM hist GROUP BY dedupe_key""")
def _(spark, folder):
    return dd.portals_per_key(ads_history(spark, folder))


@query("win_02_portals_per_row", f"""WITH {HISTORY} SELECT h.job_uid, p.portals FROM hist h
JOIN (SELECT dedupe_key, count(DISTINCT source) AS portals FROM hist GROUP BY 1) p USING (dedupe_key)""")
def _(spark, folder):
    return dd.with_portals(ads_history(spark, folder)).select("job_uid", "portals")


@query("ded_06_ordered_distinct", """WITH w AS (SELECT o_orderkey, string_split(o_orderpriority || '-' || o_orderstatus || '-' || o_orderpriority || '-O', '-') AS p FROM orders),
u AS (SELECT o_orderkey, unnest(p) AS v, generate_subscripts(p, 1) AS i FROM w), f AS (SELECT o_orderkey, v, min(i) AS i FROM u GROUP BY 1, 2)
SELECT o_orderkey, string_agg(v, '|' ORDER BY i) AS parts FROM f GROUP BY 1""")
def _(spark, folder):
    parts = F.split(F.concat_ws("-", "o_orderpriority", "o_orderstatus", "o_orderpriority", F.lit("O")), "-")
    return table(spark, folder, "orders").select("o_orderkey", F.array_join(F.array_distinct(parts), "|").alias("parts"))


# ---------------------------------------------------------------- aggregates


@query("agg_01_count_by_source", f"WITH {ADS} SELECT source, count(*) AS jobs FROM ads GROUP BY source ORDER BY source")
def _(spark, folder):
    return ag.count_by(ads(spark, folder), "source")


@query("agg_02_source_health", f"""WITH {ADS}, r AS (SELECT 'src' || n_nationkey AS name, n_nationkey = 4 AS failed FROM nation),
c AS (SELECT source, count(*) FILTER (WHERE doc_id % 9 <> 0) AS j, count(*) FILTER (WHERE doc_id % 9 = 0) AS d FROM ads GROUP BY 1)
SELECT name, CASE WHEN failed THEN 'falha' WHEN coalesce(j, 0) > 0 THEN 'ok' ELSE 'vazio' END AS status, CASE WHEN failed THEN 0 ELSE coalesce(j, 0) END AS jobs, coalesce(d, 0) AS dropped
FROM r LEFT JOIN c ON r.name = c.source""")
def _(spark, folder):
    registry = table(spark, folder, "nation").select(
        F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("name"), (F.col("n_nationkey") == 4).alias("failed")
    )
    return ag.source_health(registry, ads(spark, folder), F.col("doc_id") % 9 != 0)


@query("snk_07_run_summary", """WITH h AS (SELECT event_type AS name, count(*) AS jobs FROM events WHERE event_type <> 'error' GROUP BY 1),
s AS (SELECT event_type AS name, round(sum(value), 2) AS seconds FROM events GROUP BY 1)
SELECT s.name, CASE WHEN s.name = 'error' THEN 'falha' ELSE 'ok' END AS status, coalesce(jobs, 0) AS jobs, seconds FROM s LEFT JOIN h USING (name) ORDER BY seconds DESC""")
def _(spark, folder):
    events = table(spark, folder, "events").withColumn("source", F.col("event_type"))
    registry = events.select(F.col("event_type").alias("name"), (F.col("event_type") == "error").alias("failed")).distinct()
    health = ag.source_health(registry, events, F.lit(True))
    seconds = events.groupBy(F.col("event_type").alias("name")).agg(F.round(F.sum("value"), 2).alias("seconds"))
    return sinks.run_summary(health, seconds)


@query("agg_03_snapshot_header", f"""WITH {SNAPSHOT}
SELECT count(*) AS count, count(DISTINCT nullif(company, '')) AS companies, count(*) FILTER (WHERE pcd) AS pcd_count, (SELECT count(*) FROM hist) AS total_base,
  (SELECT string_agg(source || '=' || n, ',' ORDER BY source) FROM (SELECT source, count(*) AS n FROM snap GROUP BY 1)) AS source_counts FROM snap""")
def _(spark, folder):
    history = ads_history(spark, folder)
    shot = sn.build(history, today(), max_jobs=SNAPSHOT_CAP)
    entry = F.transform(F.map_entries("source_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return sn.header(shot.rows, history).withColumn("source_counts", F.array_join(entry, ","))


@query("agg_04_facet_counts", f"""WITH {served_sql()}
SELECT 'source' AS facet, source AS value, count(*) AS jobs FROM shown GROUP BY ALL UNION ALL SELECT 'workplaceType', workplaceType, count(*) FROM shown GROUP BY ALL
UNION ALL SELECT 'market', market, count(*) FROM shown GROUP BY ALL UNION ALL SELECT 'category', category, count(*) FROM shown GROUP BY ALL
UNION ALL SELECT 'seniority', seniority, count(*) FROM shown GROUP BY ALL""")
def _(spark, folder):
    return ag.facets(shown(spark, folder), ["source", "workplaceType", "market", "category", "seniority"]).orderBy(*ag.facet_order())


@query("agg_05_city_facet", f"""WITH {served_sql()}, c AS (SELECT doc_id, unnest(cities) AS city FROM shown), k AS (SELECT doc_id, {sql_search('city')} AS key, min(city) AS label FROM c GROUP BY 1, 2)
SELECT key, arg_min(label, doc_id) AS label, count(*) AS jobs FROM k GROUP BY key""")
def _(spark, folder):
    rows = shown(spark, folder)
    return ag.city_facet(rows, "cities", "position").orderBy(F.collate("label", "UNICODE_CI_AI"))


@query("agg_06_contract_facet", f"""WITH {served_sql()}, c AS (SELECT doc_id, lower(unnest(contractTypes)) AS c FROM shown)
SELECT v.ord, v.contract, count(DISTINCT doc_id) AS jobs FROM (VALUES (0, 'CLT', 'clt'), (1, 'CNPJ', 'pj'), (2, 'Cooperado', 'cooperado')) v(ord, contract, key) LEFT JOIN c ON c.c = v.key GROUP BY 1, 2""")
def _(spark, folder):
    return ag.contract_facet(shown(spark, folder), "contractTypes")


def _staging(spark, folder) -> DataFrame:
    i = F.col("doc_id")
    return ads(spark, folder).select(
        i.cast("string").alias("id"), F.col("market").alias("category"), F.col("work_model").alias("workplaceType"),
        F.col("contract_types").alias("contractTypes"), "company",
        F.when(i % 6 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("alerts"),
        F.when(i % 4 == 0, "").otherwise("2024-01-01").alias("detailFetchedAt"),
    )


@query("agg_07_staging_rollups", f"""WITH {ADS}, c AS (SELECT unnest(CASE WHEN len(contract_types) = 0 THEN ['Não informado'] ELSE contract_types END) AS value FROM ads)
SELECT 'category' AS rollup, market AS value, count(*) AS jobs FROM ads GROUP BY ALL UNION ALL SELECT 'workplace', work_model, count(*) FROM ads GROUP BY ALL
UNION ALL SELECT 'contract', value, count(*) FROM c GROUP BY ALL
UNION ALL SELECT 'total', 'jobs', count(*) FROM ads UNION ALL SELECT 'total', 'companies', count(DISTINCT company) FROM ads
UNION ALL SELECT 'total', 'alerts', count(*) FILTER (WHERE doc_id % 6 = 0) FROM ads UNION ALL SELECT 'total', 'details', count(*) FILTER (WHERE doc_id % 4 <> 0) FROM ads""")
def _(spark, folder):
    rows = _staging(spark, folder)
    t = ag.staging_totals(rows)
    pairs = [("jobs", "total_jobs"), ("companies", "companies"), ("alerts", "jobs_with_alerts"), ("details", "details_loaded")]
    totals = t.select(F.inline(F.array(*[
        F.struct(F.lit("total").alias("rollup"), F.lit(n).alias("value"), F.col(c).alias("jobs")) for n, c in pairs
    ])))
    return ag.staging_rollups(rows).unionByName(totals)


_BOARDS = """WITH j AS (SELECT s_suppkey AS o, 'board' || s_nationkey AS board, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END AS company, s_acctbal > 3000 AS ok FROM supplier),
b AS (SELECT board, arg_min(nullif(company, ''), CASE WHEN company <> '' THEN o END) AS company, count(*) AS brazil_jobs FROM j WHERE ok GROUP BY 1)
SELECT board, coalesce(company, board) AS company, brazil_jobs FROM b"""


def _boards(spark, folder) -> DataFrame:
    jobs = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("o"), F.concat(F.lit("board"), F.col("s_nationkey").cast("string")).alias("board"),
        F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(F.col("s_name")).alias("company"), (F.col("s_acctbal") > 3000).alias("ok"),
    )
    return ag.board_discovery(jobs, "board", "company", "o", F.col("ok"))


@query("agg_08_board_discovery", _BOARDS)
def _(spark, folder):
    return _boards(spark, folder)


@query("snk_08_board_catalog", _BOARDS + " ORDER BY lower(company), board")
def _(spark, folder):
    return sinks.board_catalog(_boards(spark, folder))


@query("agg_09_array_ranges", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, least(l_extendedprice, l_quantity * 100) AS low, greatest(l_extendedprice, l_quantity * 100) AS high,
  l_returnflag || '|' || l_linestatus AS contracts FROM lineitem""")
def _(spark, folder):
    pay = lambda amount, contract: F.struct(amount.cast("double").alias("amount"), F.col(contract).alias("contract"))
    salaries = F.array(pay(F.col("l_extendedprice"), "l_returnflag"), pay(F.col("l_quantity") * 100, "l_linestatus"), pay(F.lit(None), "l_returnflag"))
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", salaries.alias("salaries"))
    amounts = F.transform("salaries", lambda s: s["amount"])
    contracts = F.array_distinct(F.transform("salaries", lambda s: s["contract"]))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array_min(amounts).alias("low"), F.array_max(amounts).alias("high"),
        F.array_join(contracts, "|").alias("contracts"),
    )


@query("agg_11_distinct_counts", f"WITH {ADS} SELECT count(DISTINCT company) AS companies, count(DISTINCT source) AS sources, count(DISTINCT nullif(market, '')) AS markets FROM ads")
def _(spark, folder):
    return ag.distinct_counts(ads(spark, folder), {"companies": "company", "sources": "source", "markets": "market"})


@query("agg_11_sketched_counts", f"""WITH {HISTORY} SELECT source, count(DISTINCT nullif(company, '')) AS companies, true AS companies_within, count(DISTINCT nullif(dedupe_key, '')) AS keys, true AS keys_within FROM hist GROUP BY source
UNION ALL SELECT '*', count(DISTINCT nullif(company, '')), true, count(DISTINCT nullif(dedupe_key, '')), true FROM hist""")
def _(spark, folder):
    """Exact counts, and whether the merged daily sketches, written and read back, are within five deviations of them."""
    from jobloom.operators import sketches as sk

    rows = materialize(ads_history(spark, folder).select("source", F.col("last_seen_date").alias("day"), "company", "dedupe_key"))
    path = f"{ensure_checkpoint_dir(spark)}/sketches-{uuid.uuid4().hex}"
    sk.daily_sketches(rows, ["source", "day"], {"companies": F.col("company"), "keys": F.col("dedupe_key")}).write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    named = lambda df: df.withColumn("source", F.lit("*")) if "source" not in df.columns else df
    guess = sk.merged_counts(stored, ["source"], ["companies", "keys"]).unionByName(named(sk.merged_counts(stored, [], ["companies", "keys"])))
    distinct = [F.countDistinct(F.nullif(F.col(c), F.lit(""))).alias(n) for c, n in (("company", "companies"), ("dedupe_key", "keys"))]
    exact = rows.groupBy("source").agg(*distinct).unionByName(named(rows.agg(*distinct)))
    guess = guess.select("source", F.col("companies").alias("g_companies"), F.col("keys").alias("g_keys"))
    within = lambda n: (F.abs(F.col(f"g_{n}") - F.col(n)) <= F.greatest(F.lit(1.0), F.col(n) * sk.relative_error(5))).alias(f"{n}_within")
    return exact.join(guess, "source").select("source", "companies", within("companies"), "keys", within("keys"))


@query("val_04_complete_catalogs", """WITH c AS (SELECT s_nationkey, count(*) AS got, CAST(round(sum(s_acctbal)) AS BIGINT) % 7 AS reported, count(*) FILTER (WHERE s_acctbal > 0) AS pages_got FROM supplier GROUP BY 1),
v AS (SELECT *, got >= 2 AND (reported = 0 OR got >= reported) AND (pages_got >= got OR pages_got >= greatest(2, got // 2)) AS accepted FROM c)
SELECT s_suppkey, s_nationkey AS source FROM supplier WHERE s_nationkey IN (SELECT s_nationkey FROM v WHERE accepted)""")
def _(spark, folder):
    rows = table(spark, folder, "supplier").withColumnRenamed("s_nationkey", "source")
    counts = rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("got"), F.lit(2).alias("minimum"),
        (F.round(F.sum("s_acctbal")).cast("bigint") % 7).alias("reported"),
        F.count_if(F.col("s_acctbal") > 0).alias("pages_got"), F.count(F.lit(1)).alias("pages_total"),
    )
    return accepted_rows(rows, complete_catalogs(counts)).select("s_suppkey", "source")


# ---------------------------------------------------------------- codes, windows, orders


_CODED = (("source", "src"), ("company", "cmp"), ("area", "area"), ("seniority", "sen"), ("work_model", "wm"), ("market", "mk"), ("country", "co"), ("salary_currency", "cur"))
_FIRSTS = ", ".join(f"c{o} AS (SELECT v, row_number() OVER (ORDER BY f) - 1 AS code FROM (SELECT {c} AS v, min(position) AS f FROM snap GROUP BY 1))" for c, o in _CODED)


@query("snk_01_snapshot_rows", f"""WITH {SNAPSHOT}, {_FIRSTS}
SELECT s.position, s.job_uid, s.title, coalesce(nullif(s.published_date, ''), s.first_seen_date) AS pub, s.last_seen_date AS seen, s.np,
  CASE WHEN s.salary_min <> 0 THEN s.salary_min END AS smin, {", ".join(f"c{o}.code AS {o}" for _, o in _CODED)}
FROM snap s {" ".join(f"JOIN c{o} ON c{o}.v = s.{c}" for c, o in _CODED)}""")
def _(spark, folder):
    """The snapshot as it is written, audited and read back."""
    history = materialize(ads_history(spark, folder))
    shot = sn.build(history, today(), max_jobs=SNAPSHOT_CAP, keep=materialize)
    audit = write_snapshot(spark, f"{ensure_checkpoint_dir(spark)}/snapshot-{uuid.uuid4().hex}", shot, history, today())
    return audit.read("jobs").select("position", "job_uid", "title", "pub", "seen", "np", "smin", *[o for _, o in _CODED])


@query("win_01_dictionary_codes", f"""WITH {SNAPSHOT}, v AS (SELECT 'source' AS dictionary, source AS value, position FROM snap UNION ALL SELECT 'company', company, position FROM snap
  UNION ALL SELECT 'area', area, position FROM snap UNION ALL SELECT 'seniority', seniority, position FROM snap UNION ALL SELECT 'work_model', work_model, position FROM snap
  UNION ALL SELECT 'market', market, position FROM snap UNION ALL SELECT 'country', country, position FROM snap UNION ALL SELECT 'currency', salary_currency, position FROM snap),
f AS (SELECT dictionary, value, min(position) AS p FROM v GROUP BY 1, 2)
SELECT dictionary, value, row_number() OVER (PARTITION BY dictionary ORDER BY p) - 1 AS code FROM f""")
def _(spark, folder):
    return sn.build(ads_history(spark, folder), today(), max_jobs=SNAPSHOT_CAP).codes


@query("win_03_latest_per_company", f"""WITH {served_sql()} SELECT {sql_search('company')} AS group_key, company, activity FROM shown
QUALIFY row_number() OVER (PARTITION BY {sql_search('company')} ORDER BY activity DESC, job_uid DESC) = 1""")
def _(spark, folder):
    return od.latest_per_group(shown(spark, folder), fold_search("company"), F.col("activity"), F.col("job_uid"), ["company", "activity"])


@query("win_04_top_per_group", "SELECT p_brand, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) <= 12")
def _(spark, folder):
    return od.top_per_group(table(spark, folder, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")], 12).select("p_brand", "p_partkey")


@query("win_05_page", f"""WITH {served_sql()}, f AS (SELECT * FROM shown WHERE market = 'Global')
SELECT job_uid, activity FROM f ORDER BY activity DESC, {sql_collation('title')}, job_uid LIMIT 24 OFFSET (SELECT (least(9999, greatest(1, CAST(ceil(count(*) / 24.0) AS BIGINT))) - 1) * 24 FROM f)""")
def _(spark, folder):
    spec = se.SearchSpec(market="Global", page=9999, days=100_000)
    return se.result_page(shown(spark, folder), spec, now()).select("job_uid", "activity")


@query("win_06_explicit_order", """SELECT 0 AS registry_ord, s_suppkey AS item_ord, s_name AS title FROM supplier UNION ALL SELECT 1, c_custkey, c_name FROM customer ORDER BY registry_ord, item_ord""")
def _(spark, folder):
    s = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("item_ord"), F.col("s_name").alias("title"))
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("item_ord"), F.col("c_name").alias("title"))
    return od.in_registry_order([s, c], ["suppliers", "customers"]).select("registry_ord", "item_ord", "title").orderBy("registry_ord", "item_ord")


@query("srt_01_snapshot_order", f"WITH {SNAPSHOT} SELECT position, job_uid FROM newest")
def _(spark, folder):
    from jobloom.operators.filters import is_eligible

    return sn.newest(ads_history(spark, folder).filter(is_eligible(today())), SNAPSHOT_CAP).select("position", "job_uid")


def _sorted_sql(sort: str) -> str:
    title, company = (sql_collation(c) for c in ("title", "company"))
    keys = {"recent": f"activity DESC, {title}", "company": f"{company}, activity DESC", "title": f"{title}, activity DESC", "portals": "portals DESC, activity DESC"}
    return f"SELECT '{sort}' AS sort, job_uid, row_number() OVER (ORDER BY {keys[sort]}, job_uid) AS place FROM shown"


@query("srt_02_served_orders", f"WITH {served_sql()} " + " UNION ALL ".join(_sorted_sql(s) for s in ("recent", "company", "title", "portals")))
def _(spark, folder):
    return se.served_orders(shown(spark, folder), ("recent", "company", "title", "portals"))


@query("srt_04_staging_order", f"""WITH {ADS} SELECT doc_id FROM ads ORDER BY coalesce(nullif(expires_date, ''), published_date) DESC, {sql_search('company')}, {sql_search('title')}, doc_id""")
def _(spark, folder):
    latest = F.coalesce(F.nullif(F.col("expires_date"), F.lit("")), F.col("published_date"))
    return ads(spark, folder).orderBy(latest.desc(), fold_search("company"), fold_search("title"), "doc_id").select("doc_id")


@query("srt_05_metric_order", "SELECT l_suppkey, round(sum(l_quantity), 2) AS seconds FROM lineitem GROUP BY 1 ORDER BY seconds DESC, l_suppkey")
def _(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_suppkey").agg(F.round(F.sum("l_quantity"), 2).alias("seconds")).orderBy(F.desc("seconds"), "l_suppkey")


@query("srt_06_array_slices", """SELECT doc_id, array_to_string(list_slice(string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' '), 1, 8), ' ') AS skills FROM documents""")
def _(spark, folder):
    from jobloom.functions.arrays import first_n

    return table(spark, folder, "documents").select("doc_id", F.array_join(first_n(F.split(F.regexp_replace("text", r"\s+", " "), " "), 8), " ").alias("skills"))


@query("snk_05_size_guard", """SELECT count(*) AS rows, CAST(sum(strlen('{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}')) AS BIGINT) AS bytes FROM orders""")
def _(spark, folder):
    return sinks.json_bytes(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"))


@query("flagship_portal_facet", f"""WITH {HISTORY}, u AS (SELECT source, dedupe_key, contains({sql_search("title || ' ' || company || ' ' || description")}, 'the') AS is_match FROM ads JOIN hist USING (doc_id, source)),
p AS (SELECT dedupe_key, count(DISTINCT source) AS portals FROM u GROUP BY 1)
SELECT source, count(*) AS jobs, count(*) FILTER (WHERE portals > 1) AS on_other_portals FROM u JOIN p USING (dedupe_key) WHERE is_match GROUP BY source""".replace("FROM ads JOIN hist USING (doc_id, source)", "FROM (SELECT a.source, a.title, a.company, a.description, h.dedupe_key FROM ads a JOIN hist h ON a.doc_id = h.doc_id)"))
def _(spark, folder):
    from jobloom.plans.flagship import portal_facet

    return portal_facet(spark, folder)
