"""The refresh flow: landed payloads to history and public snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom import fixed_values as fx
from jobloom.functions import text as tx
from jobloom.functions.dates import local_today
from jobloom.operators import filters as fl, history as hi, snapshot as sn
from jobloom.operators.classify import with_classes
from jobloom.operators.dedupe import keep_last, native_key
from jobloom.operators.enrich import append_missing, overlay_defaults, overlay_non_blank, seed_fallback
from jobloom.operators.ordering import in_registry_order
from jobloom.operators.quality import complete_catalogs
from jobloom.operators.requirements import Vocabulary, best_per_link, extract
from jobloom.schema import JOB
from jobloom.session import materialize
from jobloom.sources import cards, embedded, feeds, json_specs, markup


def prepared(landed: DataFrame, source: str) -> DataFrame:
    """Landed responses of one source with ``body`` reduced to the JSON its mapping expects."""
    own = landed.filter(F.col("source") == source)
    if source == "geekhunter":
        return embedded.as_payload(own, embedded.stream_list(embedded.stream("body")), "data")
    if source in ("providerit", "revolut"):
        return embedded.as_payload(own, embedded.script_data("body", escaped=True))
    if source == "fiserv":
        return embedded.as_payload(own, embedded.after_marker("body", "phApp.ddo = "))
    if source == "inlog":
        return embedded.as_payload(own, embedded.escaped_list("body", "vagas", "empresaNome"))
    return own


def source_rows(
    landed: DataFrame, source: str, today: Column, boards: DataFrame | None = None, details: DataFrame | None = None,
    seed: DataFrame | None = None,
) -> DataFrame:
    """Canonical rows of one registered source, with ``page`` and ``item_ord``.

    ``boards`` configures career boards (``board, company, brazil_only``), ``details`` are landed detail pages of the
    card catalog, ``seed`` a landed payload used when the live one carries nothing.
    """
    if source == "infojobs":
        listed = landed.filter(F.col("source") == source)
        card = F.from_json("body", "href string, title string, text string")
        opened = listed.select("page", F.monotonically_increasing_id().alias("item_ord"), card.alias("c")).select("page", "item_ord", "c.*")
        from jobloom.operators.dedupe import keep_first

        return keep_first(cards.normalize_cards(opened, today, keep=("page", "item_ord")), ["native_id"], ["page", "item_ord"])
    if source == "weworkremotely":
        return feeds.rows(landed, source)
    if source in markup.CARD_SPECS:
        found = markup.rows(landed, source, today)
        if source == "totvs" and details is not None:
            extra = markup.catalog_details(details)
            found = overlay_non_blank(found, extra, "url", [("work_model",), ("city", "state"), ("contract_types",)])
        return found
    live = prepared(landed, source)
    if source == "greenhouse" and boards is not None:
        config = boards.select("board", F.col("company").alias("board_company"), "brazil_only")
        live = live.join(config, "board", "left")
    rows = json_specs.rows(live, source)
    if source == "gupy":
        rows = with_monitored_pages(rows, landed)
    return seed_fallback(rows, json_specs.rows(seed, source)) if seed is not None else rows


def with_monitored_pages(rows: DataFrame, landed: DataFrame) -> DataFrame:
    """Add openings of monitored career pages that the catalog lacks, in their exact form where it was landed."""
    pages = landed.filter(F.col("source") == "gupy_page")
    body = embedded.script_data("body")
    company = F.try_variant_get(F.try_parse_json(body), "$.props.pageProps.careerPage.name", "string")
    opened = embedded.as_payload(pages.withColumn("page_company", F.trim(F.coalesce(company, F.lit("")))), body)
    monitored = json_specs.rows(opened.withColumn("source", F.lit("gupy")), "gupy", json_specs.GUPY_CAREER_PAGE)
    exact = json_specs.rows(landed.filter(F.col("source") == "gupy_exact").withColumn("source", F.lit("gupy")), "gupy")
    unique = keep_last(monitored, ["native_id"], ["page", "item_ord"])
    return append_missing(rows, unique, exact, "native_id")


def collected(landed: DataFrame, sources: Sequence[str], today: Column, **config) -> DataFrame:
    """Valid rows of all chosen sources in registry order."""
    frames = [source_rows(landed, s, today, **config).select(*JOB.fieldNames(), "page", "item_ord") for s in sources]
    return fl.valid_rows(in_registry_order(frames, sources))


ORDER = ["registry_ord", "page", "item_ord"]


def classified(rows: DataFrame) -> DataFrame:
    """Market, work model, area and seniority: all row-local, so they run before any shuffle."""
    rows = rows.withColumn("market", fl.market_from_city(F.col("city"), F.col("market")))
    return with_classes(fl.with_inferred_work_model(rows))


def unique_recent(rows: DataFrame, today: Column, months: int = 2) -> DataFrame:
    """Last delivery per identifier, then the age filter.  Descriptions must be gone by now: this is the shuffle."""
    rows = keep_last(rows.drop("description"), [native_key()], ORDER)
    return rows.filter(fl.is_recent_publication(F.col("published_date"), F.col("expires_date"), F.col("source"), today, months))


def requirement_index(rows: DataFrame, batch: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Requirement index of a batch, from the collected rows that still carry descriptions.

    Extraction is row-local and comes first; only its small result is joined with the batch's winning deliveries.
    """
    linked = rows.withColumns({"job_uid": native_key(), "url": tx.https_url(tx.strip("url"))})
    usable = linked.filter((F.col("url") != "") & fl.has_usable_description(F.col("description")))
    found = extract(usable, vocabulary, keep=("job_uid", "url", *ORDER))
    winners = batch.select(native_key().alias("job_uid"), *ORDER)
    return best_per_link(found.join(winners, ["job_uid", *ORDER], "left_semi"), F.struct(*ORDER))


@dataclass(frozen=True)
class Refresh:
    counts: DataFrame  # rows per source after the age filter, before unknown markets leave
    batch: DataFrame  # classified canonical rows, without descriptions, with their order columns
    collected: DataFrame  # every valid delivery with its description, for the requirement index
    history: DataFrame
    snapshot: sn.Snapshot
    changes: DataFrame
    rejected: tuple[str, ...] = ()  # sources whose catalog was incomplete


class NothingCollectedError(RuntimeError):
    """An empty collection must not replace the public snapshot."""


def incomplete_sources(deliveries: DataFrame, expectations: DataFrame) -> list[str]:
    """Sources that do not bring what is expected of them; at most as many as there are sources."""
    got = deliveries.groupBy("source").agg(F.count(F.lit(1)).alias("got"))
    counts = expectations.join(got, "source", "left").fillna(0, ["got"])
    return sorted(r["source"] for r in complete_catalogs(counts).filter(~F.col("accepted")).select("source").collect())


def refresh(
    spark: SparkSession, landed: DataFrame, history: DataFrame, today: Column | None = None, sources: str = "", failed: Sequence[str] = (),
    fresh_days: int = 3, months: int = 2, keep_days: int = 120, max_jobs: int = 50_000, expectations: DataFrame | None = None, **config,
) -> Refresh:
    """One refresh.  Nothing is written; ``plans.publication`` writes, audits and publishes the parts.

    ``expectations`` (``source, minimum, reported, pages_got, pages_total``) says what a whole catalog is.  A source that brings less
    counts as failed: its rows are left out and its stored rows stay, so that half a catalog does not replace a whole one.

    The normalised batch and the merged history feed several plans and are materialised in the checkpoint folder.
    """
    today = local_today() if today is None else today
    chosen = [s for s in fx.SOURCES if not sources or s in {p.strip().lower() for p in sources.split(",")}]
    unknown = {p.strip().lower() for p in sources.split(",") if p.strip()} - set(fx.SOURCES)
    if unknown:
        raise ValueError(f"unknown source(s): {', '.join(sorted(unknown))}")
    usable = [s for s in chosen if s not in failed]
    deliveries = collected(landed, usable, today, **config)
    rejected: list[str] = []
    if expectations is not None:
        deliveries = materialize(deliveries)
        rejected = incomplete_sources(deliveries, expectations)
        deliveries = deliveries.filter(~F.col("source").isin(*rejected)) if rejected else deliveries
        usable = [s for s in usable if s not in rejected]
    rows = materialize(unique_recent(classified(deliveries), today, months))
    if rows.isEmpty():
        raise NothingCollectedError("no advertisements were collected")
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("jobs")).orderBy("source")
    batch = rows.filter(fl.market_is_known(F.col("market")))
    stored = hi.as_history_rows(batch)
    merged = materialize(hi.merge(history, stored, today, change="_change"))
    changes = hi.change_counts(merged, "_change")
    current = merged.drop("_change")
    current = hi.rewrite_links(current, "solides", hi.portal_link("https://vagas.solides.com.br/vaga"))
    keys = stored.select("job_uid", "source")
    if "totvs" in usable:
        current = hi.purge_absent(current, "totvs", keys.filter("source = 'totvs'"))
    current = hi.repair_work_models(current)
    if "greenhouse" in usable:
        current = hi.purge_foreign(current, "greenhouse", keys.filter("source = 'greenhouse'"))
    current = materialize(hi.prune(current, today, keep_days, months))
    shot = sn.build(current, today, fresh_days, months, max_jobs, keep=materialize)
    return Refresh(counts, batch, deliveries, current, shot, changes, tuple(rejected))


def board_configuration(catalog: DataFrame, required: DataFrame) -> DataFrame:
    """Board catalog with the boards that must always be there."""
    return overlay_defaults(catalog, required, "board")
