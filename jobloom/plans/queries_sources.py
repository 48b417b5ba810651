"""Source mappings, readers, sinks and incremental runs over payloads that Spark derives from whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from jobloom.functions import text as tx
from jobloom.operators import filters as fl, history as hi, requirements as rq, sinks
from jobloom.plans.registry import ADS, HISTORY, TODAY, ads, ads_history, pick, query, sql_caseless, today
from jobloom.plans.queries_rows import ORDERS_HISTORY, _stored
from jobloom.session import ensure_checkpoint_dir, table
from jobloom.sources import embedded, feeds, json_specs, markup, tables
from jobloom.streaming import incremental, redelivery


def scratch(spark: SparkSession) -> str:
    """A new folder next to the checkpoints (shared storage on a cluster)."""
    return f"{ensure_checkpoint_dir(spark)}/jobloom-{uuid.uuid4().hex}"


def _landed(rows: DataFrame, source: str, body, page="page_no") -> DataFrame:
    return rows.select(
        F.lit(source).alias("source"), F.lit(None).cast("string").alias("board"), F.col(page).cast("bigint").alias("page"),
        F.lit("https://portal.example.com/").alias("url"), body.alias("body"),
    )


def _job_payloads(spark, folder) -> DataFrame:
    """One catalog response per document: the advertisement twice, the second time corrected."""
    d = table(spark, folder, "documents")
    item = lambda title: F.struct(
        F.col("doc_id").alias("id"), title.alias("name"), F.col("source").alias("careerPageName"),
        F.concat(F.lit("https://x.example/"), F.col("doc_id").cast("string")).alias("jobUrl"),
        (F.col("doc_id") % 3 == 0).alias("isRemoteWork"), pick(F.col("doc_id"), "hybrid", "on-site", F.lit(None)).alias("workplaceType"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit("T10:00:00.123Z")).alias("publishedDate"),
        F.array(F.struct(F.col("lang").alias("name")), F.struct(F.lit("").alias("name"))).alias("skills"),
        F.col("text").alias("description"),
    )
    body = F.to_json(F.struct(F.array(item(F.lit("old")), item(F.concat(F.lit("Vaga "), F.col("doc_id").cast("string")))).alias("data")))
    return _landed(d.withColumn("page_no", F.col("doc_id")), "gupy", body)


@query("src_01_json_mapping", """SELECT 'gupy' AS source, CAST(doc_id AS VARCHAR) AS native_id, 'Vaga ' || doc_id AS title, source AS company, 'https://x.example/' || doc_id AS url,
  CASE WHEN doc_id % 3 = 0 THEN 'remote' WHEN doc_id % 3 = 1 THEN 'on-site' ELSE '' END AS work_model, 'BR' AS market,
  '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T10:00:00+00:00' AS published_date, lang AS skills FROM documents""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = json_specs.rows(_job_payloads(spark, folder), "gupy")
    return rows.select("source", "native_id", "title", "company", "url", "work_model", "market", "published_date", F.array_join("skills", "|").alias("skills"))


@query("src_02_html_cards", """WITH d AS (SELECT doc_id, array_to_string([w FOR w IN string_split(regexp_replace(text, '[^A-Za-z]+', ' ', 'g'), ' ') IF w <> ''], ' ') AS t FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS native_id, trim(substr('Dev & ' || t, 1, 6000)) AS title, 'Firma ' || doc_id AS company, 'Recife • PE' AS city, 'PE' AS state,
  CASE doc_id % 3 WHEN 0 THEN 'remote' WHEN 1 THEN 'hybrid' ELSE 'on-site' END AS work_model, 'CLT' AS contracts, 1000.0 + doc_id AS salary_min, 'suporte|' || 'n' || doc_id % 4 AS skills FROM d""")
def _(spark, folder):
    words = F.filter(F.split(F.regexp_replace("text", "[^A-Za-z]+", " "), " "), lambda w: w != "")
    i = F.col("doc_id").cast("string")
    model = pick(F.col("doc_id"), "Remoto", "Híbrido", "Presencial")
    card = F.concat(
        F.lit("<div class=\"vaga-card\" data-href=\"vaga_emprego/vaga-"), i, F.lit(".php\">\n <h3 class='vaga-titulo x'>Dev &amp; <b>"), F.array_join(words, " "),
        F.lit("</b> <span class='vaga-nova-badge'>Nova</span></h3><span class=\"vaga-empresa-nome\">Firma "), i,
        F.lit("</span><div class=\"vaga-local-linha\">Recife • PE</div><p class=\"vaga-resumo-linha\">CLT • Pleno • "), model,
        F.lit("</p><p>R$ "), F.translate(F.format_number((F.col("doc_id") + 1000).cast("double"), 2), ",.", ".,"), F.lit("</p><a class=\"hashtag\">#suporte</a><a class='hashtag'>#n"),
        (F.col("doc_id") % 4).cast("string"), F.lit("</a></div>"),
    )
    # every page carries its card twice
    page = _landed(table(spark, folder, "documents").withColumn("page_no", F.col("doc_id")), "nerdin", F.concat(F.lit("<html>"), card, card, F.lit("Página 1 de 1</html>")))
    rows = markup.rows(page, "nerdin", today())
    return rows.select(
        "native_id", "title", "company", "city", "state", "work_model", F.array_join("contract_types", "|").alias("contracts"), "salary_min",
        F.array_join("skills", "|").alias("skills"),
    )


def _portal_pages(spark, folder, portal: str) -> DataFrame:
    """One page of a card portal per part, as landed."""
    k, name = F.col("p_partkey").cast("string"), F.concat(F.lit("Dev "), F.col("p_name"))
    page = lambda *pieces: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])
    two = lambda more, label: page('<a class="t" href="/job/dev-jid-', k, '"><b>Dev</b> ', F.col("p_name"), f'</a><a href="/job/dev-jid-', k, f'">{label}</a>', more)
    card = lambda board: page(f'<a href="/{board}/vacancy/', k, '-dev"><h3>', name, "</h3><span>CLT ou PJ</span><p>Remoto</p></a>")
    start = '<div class="x index__job-opportunities__grid__item" data-title="'
    catalog = page(
        # a card with elements of its name inside, one in a comment, one around an inner card, one that never ends
        start, name, '" data-city-name="Recife" data-state-small-name="pe"><div><div>novo</div><div/></div><a data-cy="job-opportunity-link" href="/vidya/', k, '/dev">x</a></div>',
        "<!-- ", start, 'no"><a data-cy="job-opportunity-link" href="/vidya/1/no">x</a></div> -->',
        start, 'Outer"><div class="index__job-opportunities__grid__item"></div><p><a data-cy="job-opportunity-link" href="/vidya/', k, '00/dev">x</a></p></div>',
        start, 'Open"><a data-cy="job-opportunity-link" href="/vidya/2/no">x</a><div></div>',
    )
    bodies = {
        "experian": two("", "More info"), "wise": two("", "Read more"), "recrutei": card("acme"), "digisystem": card("digisystem"), "totvs": catalog,
        "metalfrio": page('<a class="card card-vacancy z" href="/Detail/', k, '"><h3 title="', name, '"></h3><div class="icon-location-pin-1"></div> Recife - PE <i class="vacancy-date">5 set</i></a>'),
        "nestle": page('<tr class="data-row"><td><a href="/job/x/', k, '/" class="jobTitle-link">', name, '</a></td><td class="colLocation">Recife, BR</td><td class="colDate">Mar 5, 2024</td></tr>'),
        "docusign": page('<a href="/jobs/dev-', k, '">', name, "</a>"), "dbccompany": page('<a href="/vagas/dev-', k, '?x=1">', name, "</a>"),
        "cloudwalk": page('<div class="jobs-list-cms-position"><div class="is-open-position">', name, '</div><div fs-list-field="location-type">Remote</div><div fs-list-field="location">Recife</div><a href="/jobs-positions/dev-', k, '">go</a>'),
    }
    boards = {"recrutei": "acme", "totvs": "vidya"}
    # each portal lands on its own: a filter on the source would build the pages of all portals for every portal
    return _landed(table(spark, folder, "part"), portal, bodies[portal], "p_partkey").withColumn("board", F.lit(boards.get(portal)).cast("string"))


_PORTALS_SQL = {
    "experian": ("k", "n", "'Experian'", "'https://jobs.experian.com/job/dev-jid-' || k", "''"), "wise": ("k", "n", "'Wise'", "'https://wise.jobs/job/dev-jid-' || k", "'São Paulo'"),
    "recrutei": ("'acme:' || k", "n", "'acme'", "'https://jobs.recrutei.com.br/acme/vacancy/' || k || '-dev'", "'Remoto'"),
    "digisystem": ("k", "n", "'Digisystem'", "'https://jobs.recrutei.com.br/digisystem/vacancy/' || k || '-dev'", "'Remoto'"),
    "totvs": ("'vidya:' || k", "n", "'Vidya'", "'https://atracaodetalentos.totvs.app/vidya/' || k || '/dev'", "'Recife'"),
    "metalfrio": ("k", "n", "'Metalfrio Solutions'", "'https://metalfriosolutions.pandape.infojobs.com.br/Detail/' || k", "'Recife'"),
    "nestle": ("k", "n", "'Nestlé'", "'https://jobdetails.nestle.com/job/x/' || k || '/'", "'Recife'"),
    "docusign": ("'dev-' || k", "n", "'DocuSign'", "'https://careers.docusign.com/jobs/dev-' || k", "'Brasil'"),
    "dbccompany": ("'dev-' || k", "n", "'DBC Company'", "'https://vagas.dbccompany.com.br/vagas/dev-' || k || '?x=1'", "'Brasil'"),
    "cloudwalk": ("'dev-' || k", "n", "'CloudWalk'", "'https://www.cloudwalk.io/jobs-positions/dev-' || k", "'Recife'"),
}


@query("src_02_card_portals", "WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS k, 'Dev ' || p_name AS n FROM part) " + " UNION ALL ".join(
    f"SELECT '{s}' AS source, {i} AS native_id, {t} AS title, {c} AS company, {u} AS url, {w} AS city FROM p" for s, (i, t, c, u, w) in _PORTALS_SQL.items())
    + " UNION ALL SELECT 'totvs', 'vidya:' || k || '00', 'Outer', 'Vidya', 'https://atracaodetalentos.totvs.app/vidya/' || k || '00/dev', '' FROM p")
def _(spark, folder):
    out = None
    for source in _PORTALS_SQL:
        part = markup.rows(_portal_pages(spark, folder, source), source, today()).select("source", "native_id", "title", "company", "url", "city")
        out = part if out is None else out.unionByName(part)
    return out


@query("src_03_embedded_json", """SELECT page_id, page_id * 2 AS from_script, page_id + 1 AS from_marker, 'v' || page_id AS from_list, page_id AS from_stream FROM pages""")
def _(spark, folder):
    i = F.col("page_id").cast("string")
    chunk = lambda text: F.concat(F.lit("<script>self.__next_f.push("), F.to_json(F.array(F.lit("1"), text)), F.lit(")</script>"))
    head, tail = F.lit('0:{"meta":{"x":0},"data":[{"__typen'), F.concat(F.lit('ame":"PublicJob","id":'), i, F.lit('}],"meta":{"lastPage":3}}'))
    page = F.concat(
        F.col("html"), F.lit('<script id="__NEXT_DATA__" type="application/json">{"props":{"n":'), (F.col("page_id") * 2).cast("string"), F.lit("}}</script>"),
        F.lit("<script>phApp.ddo = {\"n\":"), (F.col("page_id") + 1).cast("string"), F.lit("}; phApp.more = 1;</script>"),
        F.lit('"vagas\\":[{\\"id\\":\\"v'), i, F.lit('\\"}],\\"empresaNome\\":1'), chunk(head), chunk(tail),
    )
    rows = table(spark, folder, "pages").select("page_id", page.alias("body"))
    value = lambda c, path, kind: F.try_variant_get(F.try_parse_json(c), path, kind)
    return rows.select(
        "page_id", value(embedded.script_data("body"), "$.props.n", "bigint").alias("from_script"),
        value(embedded.after_marker("body", "phApp.ddo = "), "$.n", "bigint").alias("from_marker"),
        value(embedded.escaped_list("body", "vagas", "empresaNome"), "$[0].id", "string").alias("from_list"),
        value(embedded.stream_list(embedded.stream("body")), "$[0].id", "bigint").alias("from_stream"),
    )


@query("src_04_rss_items", """SELECT DISTINCT 'https://x.example/' || p_partkey AS url, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS company, p_name AS title, p_type AS category,
  '2024-03-05T10:11:12+00:00' AS published_date, 'Anywhere & ' || p_size AS country FROM part""")
def _(spark, folder):
    item = F.concat(
        F.lit("<item><title><![CDATA["), F.when(F.col("p_partkey") % 3 != 0, F.concat("p_brand", F.lit(": "))).otherwise(""), F.col("p_name"),
        F.lit("]]></title><link>https://x.example/"), F.col("p_partkey").cast("string"), F.lit("</link><region>Anywhere &amp; "), F.col("p_size").cast("string"),
        F.lit("</region><category>"), F.col("p_type"), F.lit("</category><category>other</category><pubDate>Tue, 05 Mar 2024 10:11:12 +0000</pubDate></item>"),
    )
    feed = F.concat(F.lit("<rss><channel><title>x</title>"), item, item, F.lit("</channel></rss>"))
    rows = feeds.rows(_landed(table(spark, folder, "part").withColumn("page_no", F.col("p_partkey")), "weworkremotely", feed))
    return rows.select("url", "company", "title", F.get("categories", F.lit(0)).alias("category"), "published_date", "country")


@query("src_05_anchor_links", """WITH a AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS root, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref=["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)) AS href,
  unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref=["'']([^"'']*)["''][^>]*>(.*?)</a>', 2)) AS label FROM pages)
SELECT page_id, root || href AS url, min(trim(label)) AS label FROM a WHERE trim(href) <> '' AND trim(label) <> '' GROUP BY 1, 2""")
def _(spark, folder):
    pages = table(spark, folder, "pages").select(F.col("page_id").alias("page"), "url", F.col("html").alias("body"))
    return markup.links(pages).select(F.col("page").alias("page_id"), "url", "label")


@query("src_05_sitemap_links", "SELECT DISTINCT regexp_replace(url, '^http:', 'https:') AS url FROM pages WHERE contains(regexp_replace(url, '^http:', 'https:'), 'https://blog.')")
def _(spark, folder):
    secure = F.regexp_replace(F.col("url"), "^http:", "https:")
    body = F.concat(F.lit("<urlset><url><loc>"), F.replace(secure, F.lit("&"), F.lit("&amp;")), F.lit("</loc></url><url><loc>https://other.example/</loc></url></urlset>"))
    return markup.sitemap_links(table(spark, folder, "pages").select(body.alias("body")), "https://blog.")


@query("src_06_staging_reader", """SELECT CAST(doc_id AS VARCHAR) AS native_id, source AS company, 'Recife, PE, BR' AS city, 'PE' AS state, 'BR' AS country, 'hybrid' AS work_model,
  CASE WHEN doc_id % 2 = 0 THEN '2024-02-01' ELSE '2024-01-01' END AS published_date FROM documents""")
def _(spark, folder):
    path = scratch(spark)
    i = F.col("doc_id")
    item = F.struct(
        i.cast("string").alias("id"), F.lit("T").alias("title"), F.col("source").alias("company"), F.lit("Recife, PE, BR").alias("location"), F.lit("Híbrido").alias("workplaceType"),
        F.when(i % 2 == 0, "2024-02-01").alias("lastPublishedAt"), F.lit("2024-01-01").alias("publishedAt"),
    )
    # one staging file per hundred rows
    lists = table(spark, folder, "documents").groupBy(F.floor(i / 100)).agg(F.to_json(F.collect_list(item)).alias("j"))
    lists.select(F.concat(F.lit("\ufeff"), "j").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    rows = json_specs.rows(tables.staging_payload(spark, path), "inhire")
    return rows.select("native_id", "company", "city", "state", "country", "work_model", "published_date")


@query("src_08_reference_table", "SELECT DISTINCT p_brand AS id, lower(p_brand) AS alias_folded, 'skill' AS kind FROM part")
def _(spark, folder):
    path = scratch(spark)
    brands = table(spark, folder, "part").select("p_brand").distinct()
    entry = F.struct(F.col("p_brand").alias("id"), F.col("p_brand").alias("label"), F.array("p_brand").alias("aliases"), F.lit("skill").alias("kind"))
    document = brands.agg(F.sort_array(F.collect_list(entry)).alias("entries")).withColumn("schema_version", F.lit(1))
    document.coalesce(1).write.json(path)
    return tables.taxonomy_aliases(tables.read_taxonomy(spark, path)).select("id", "alias_folded", "kind")


@query("src_09_host_candidates", """WITH h AS (SELECT DISTINCT lower(unnest(regexp_extract_all(url, '(?i)https?://([a-z0-9-]+)\\.example\\.com', 1))) AS slug FROM pages)
SELECT slug FROM h WHERE regexp_matches(slug, '^[a-z0-9-]{2,}$') AND slug NOT IN ('therha', 'www')""")
def _(spark, folder):
    return tables.host_candidates(table(spark, folder, "pages"), "url", "example.com", ("therha", "www"))


@query("src_10_history_scan", f"WITH {HISTORY} SELECT job_uid, title, last_seen_date FROM hist WHERE source = 'gupy'")
def _(spark, folder):
    path = scratch(spark)
    sinks.write_history(ads_history(spark, folder), path)
    return tables.read_history(spark, path, "gupy").select("job_uid", "title", "last_seen_date")


# ---------------------------------------------------------------- index sinks


@query("snk_06_index_metadata", f"""WITH {ADS}, i AS (SELECT doc_id, 'https://jobs.example.com/' || doc_id AS url FROM documents WHERE length({sql_caseless('text')}) >= 120)
SELECT i.url, substr(a.title, 1, 180) AS t, substr(a.company, 1, 140) AS e, coalesce(nullif(a.city, ''), a.country) AS l, a.work_model AS w, a.published_date AS d FROM i JOIN ads a ON a.doc_id = i.doc_id""")
def _(spark, folder):
    rows = ads(spark, folder)
    index = rows.filter(fl.has_usable_description(F.col("description"))).select(tx.https_url("url").alias("url"))
    return sinks.attach_metadata(index, rows.withColumn("state", F.lit(""))).select("url", "t", "e", "l", "w", "d")


# ---------------------------------------------------------------- incremental runs


_ROW = T.StructType([
    T.StructField("job_uid", T.StringType()), T.StructField("source", T.StringType()), T.StructField("work_model", T.StringType()),
    T.StructField("salary_min", T.DoubleType()), T.StructField("city", T.StringType()), T.StructField("delivery", T.LongType()),
])


def _deliveries(spark, folder, first: int, add: float) -> DataFrame:
    """Deliveries of one day; every third key is delivered twice, the second time 10 dearer."""
    k = F.col("o_orderkey")
    rows = table(spark, folder, "orders").filter(k % 10 >= first).select(
        F.concat(F.lit("orders:"), k.cast("string")).alias("job_uid"),
        F.when(F.col("o_orderstatus") == "O", "totvs").when(F.col("o_orderstatus") == "F", "greenhouse").otherwise("gupy").alias("source"),
        F.when(k % 3 == 0, "").otherwise("hybrid").alias("work_model"), (F.col("o_totalprice") + add).alias("salary_min"),
        pick(k, "Recife", "Lisboa", "São Paulo").alias("city"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.when(k % 3 == 0, 2).otherwise(1).cast("bigint"))).alias("delivery"),
    )
    return rows.withColumn("salary_min", F.col("salary_min") + (F.col("delivery") - 1) * 10)


def _run_increments(spark, folder) -> DataFrame:
    root = scratch(spark)
    store, landing, state = f"{root}/history", f"{root}/landing", f"{root}/stream"
    incremental.write_bucketed(_stored(spark, folder), store, buckets=4)
    for day, first, add in (("1998-12-01", 5, 1.0), ("1998-12-02", 7, 2.0)):
        _deliveries(spark, folder, first, add).write.mode("append").parquet(landing)
        incremental.incremental_upsert(spark, landing, _ROW, store, state, F.lit(day), ["delivery"], buckets=4)
    return incremental.read_bucketed(spark, store).drop("bucket")


_INCREMENTS = f"""{ORDERS_HISTORY}, days AS (
  SELECT src.job_uid, source, o_orderkey % 10 AS r, o_orderkey AS k, o_totalprice + (CASE WHEN o_orderkey % 3 = 0 THEN 10 ELSE 0 END) AS p,
    CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'hybrid' END AS m, city FROM src),
final AS (SELECT d.job_uid, d.source, CASE WHEN r < 5 THEN s.work_model ELSE coalesce(nullif(m, ''), s.work_model, '') END AS work_model,
    CASE WHEN r < 5 THEN s.salary_min WHEN r < 7 THEN p + 1.0 ELSE p + 2.0 END AS salary_min, d.city,
    CASE WHEN r < 8 THEN '1998-01-01' ELSE '1998-12-01' END AS first_seen_date,
    CASE WHEN r < 5 THEN s.last_seen_date WHEN r < 7 THEN '1998-12-01' ELSE '1998-12-02' END AS last_seen_date
  FROM days d LEFT JOIN stored s ON s.job_uid = d.job_uid)"""


@query("stm_01_incremental_upsert", f"WITH {_INCREMENTS} SELECT * FROM final")
def _(spark, folder):
    return _run_increments(spark, folder)


@query("stm_02_outage_tolerance", f"WITH {_INCREMENTS} SELECT job_uid, last_seen_date FROM final WHERE last_seen_date >= '1998-12-01'")
def _(spark, folder):
    rows = _run_increments(spark, folder).withColumns(
        {"market": F.lit("BR"), "published_date": F.lit(""), "expires_date": F.lit(""), "first_seen_date": F.lit("1998-12-01")}
    )
    return rows.filter(fl.is_eligible(F.lit("1998-12-03").cast("date"))).select("job_uid", "last_seen_date")


@query("stm_03_redelivery", f"WITH {_INCREMENTS} SELECT source, count(*) AS jobs, round(sum(salary_min), 2) AS total FROM final GROUP BY source")
def _(spark, folder):
    return _run_increments(spark, folder).groupBy("source").agg(F.count(F.lit(1)).alias("jobs"), F.round(F.sum("salary_min"), 2).alias("total"))


@query("stm_03_late_redelivery", """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 10 AS r, CASE o_orderstatus WHEN 'O' THEN 'totvs' WHEN 'F' THEN 'greenhouse' ELSE 'gupy' END AS source, o_totalprice AS p, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)
SELECT 'orders:' || k AS job_uid, source, CASE WHEN r < 2 THEN p WHEN r < 5 THEN p + 20 WHEN k % 4 = 0 THEN p + 40 ELSE p + 30 END AS salary_min,
  CASE WHEN r < 2 THEN d WHEN r >= 5 AND k % 4 = 0 THEN '1998-12-03' ELSE '1998-12-01' END AS last_seen_date FROM o""")
def _(spark, folder):
    """Three runs from one checkpoint: second and third deliveries first, then first ones that are late, then a few newer ones."""
    root = scratch(spark)
    store, landing, state = f"{root}/history", f"{root}/landing", f"{root}/stream"
    orders = table(spark, folder, "orders").withColumn("k", F.col("o_orderkey"))
    k = F.col("k")

    def delivered(rows: DataFrame, number: int) -> DataFrame:
        return rows.select(
            F.concat(F.lit("orders:"), k.cast("string")).alias("job_uid"),
            F.when(F.col("o_orderstatus") == "O", "totvs").when(F.col("o_orderstatus") == "F", "greenhouse").otherwise("gupy").alias("source"),
            F.lit("hybrid").alias("work_model"), (F.col("o_totalprice") + 10 * number).alias("salary_min"), F.lit("Recife").alias("city"),
            F.lit(number).cast("long").alias("delivery"),
        )

    untouched = F.regexp_extract("job_uid", r"(\d)$", 1).cast("int") < 2
    incremental.write_bucketed(_stored(spark, folder).filter(untouched), store, buckets=4)
    seen = orders.filter(k % 10 >= 2)
    days = (
        ("1998-12-01", delivered(seen, 2).unionByName(delivered(orders.filter(k % 10 >= 5), 3))),
        ("1998-12-02", delivered(seen, 1)),
        ("1998-12-03", delivered(orders.filter((k % 10 >= 5) & (k % 4 == 0)), 4).unionByName(delivered(seen, 2))),
    )
    for day, rows in days:
        rows.write.mode("append").parquet(landing)
        redelivery.redelivered_upsert(spark, landing, _ROW, store, state, F.lit(day), ["delivery"], buckets=4)
    return incremental.read_bucketed(spark, store).select("job_uid", "source", "salary_min", "last_seen_date")
