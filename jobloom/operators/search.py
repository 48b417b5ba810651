"""Faceted search over the snapshot: served projection, criteria, orders, pages, export."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fx
from jobloom.functions import text as tx
from jobloom.functions.arrays import unjoined
from jobloom.functions.dates import activity_seconds
from jobloom.functions.numbers import salary_text
from jobloom.operators.ordering import page as one_page, places
from jobloom.session import materialize


def decode(encoded: DataFrame, codes: DataFrame) -> DataFrame:
    """Encoded snapshot rows back to labels.  The dictionaries are as small as the capped snapshot."""
    from jobloom.operators.snapshot import CODE_COLUMNS, DICTIONARIES

    pairs = [F.struct(F.lit(d).alias("dictionary"), F.col(CODE_COLUMNS[d]).alias("code")) for d in DICTIONARIES]
    long = encoded.select("position", F.inline(F.array(*pairs))).join(codes, ["dictionary", "code"])
    labels = long.groupBy(F.col("position").alias("_p")).agg(
        *[F.max(F.when(F.col("dictionary") == d, F.col("value"))).alias(c) for d, c in DICTIONARIES.items()]
    )
    plain = encoded.drop(*CODE_COLUMNS.values())
    return plain.join(labels, F.col("position") == F.col("_p")).drop("_p")


def served(rows: DataFrame, now: Column) -> DataFrame:
    """Labelled snapshot rows in displayed form, with the folded search text and the activity time."""
    contracts = unjoined(F.col("ct"))
    place = tx.text_or_blank("city")
    out = rows.select(
        *[c for c in ("position", "job_uid") if c in rows.columns],
        tx.text_or_blank("title").alias("title"),
        F.col("source"),
        tx.source_label("source").alias("sourceLabel"),
        tx.first_non_blank("company", F.lit(fx.COMPANY_BLANK)).alias("company"),
        tx.first_non_blank("area", F.lit(fx.AREA_OTHER)).alias("category"),
        tx.first_non_blank("seniority", F.lit(fx.STAGING_SENIORITY_OTHER)).alias("seniority"),
        tx.workplace_label("work_model").alias("workplaceType"),
        tx.market_label("market").alias("market"),
        tx.text_or_blank("country").alias("country"),
        tx.first_non_blank(place, F.col("country"), F.lit(fx.PLACE_BLANK)).alias("location"),
        tx.city_names(place).alias("cities"),
        tx.fold_search(place).alias("_location"),
        F.col("pub").alias("publishedAt"),
        F.col("seen").alias("lastSeenAt"),
        F.col("exp").alias("expiresAt"),
        F.col("url"),
        F.coalesce(F.col("np"), F.lit(1)).alias("portals"),
        tx.text_or_blank("sk").alias("skills"),
        F.col("smin").alias("salaryMin"),
        F.col("smax").alias("salaryMax"),
        F.col("salary_currency").alias("currency"),
        (F.col("pcd") == 1).alias("pcd"),
        (F.col("blind") == 1).alias("blindSelection"),
        contracts.alias("contractTypes"),
        activity_seconds(F.col("pub"), F.col("seen"), now).alias("activity"),
    )
    return out.withColumn("_search", search_text())


def search_text() -> Column:
    parts = ["title", "company", "sourceLabel", "category", "seniority", "workplaceType", "market", "location", "skills"]
    contracts = F.col("contractTypes")
    labels = F.transform(contracts, tx.contract_label)
    # an empty list still contributes nothing, like the nine fields joined alone
    return tx.fold_search(F.concat_ws(" ", *parts, contracts, labels))


@dataclass(frozen=True)
class SearchSpec:
    """Search criteria; blank means no restriction."""

    text: str = ""
    source: str = ""
    workplace: str = ""
    contract: str = ""
    city: str = ""
    market: str = ""
    category: str = ""
    seniority: str = ""
    days: int = 60
    pcd_only: bool = False
    several_portals: bool = False
    sort: str = "recent"
    page: int = 1
    page_size: int = 24
    extra: dict = field(default_factory=dict)


def _folded(value: str) -> str:
    import unicodedata

    text = unicodedata.normalize("NFD", value or "")
    return "".join(ch for ch in text if not "\u0300" <= ch <= "\u036f").lower().strip()


def criteria(spec: SearchSpec, now: Column) -> Column:
    """One conjunction over the served columns, evaluated in this order: plain comparisons, lists, then folded text."""
    text, city = _folded(spec.text), _folded(spec.city)
    tests = [
        F.col(column) == wanted
        for column, wanted in (
            ("source", spec.source), ("workplaceType", spec.workplace), ("market", spec.market),
            ("category", spec.category), ("seniority", spec.seniority),
        )
        if wanted
    ]
    if spec.pcd_only:
        tests.append(F.col("pcd"))
    days = spec.days or 60
    tests.append((F.col("activity") != 0) & (F.unix_seconds(now) - F.col("activity") <= days * 86400))
    if spec.several_portals:
        tests.append(F.col("portals") > 1)
    if spec.contract:
        target = _folded("PJ" if spec.contract == "CNPJ" else spec.contract)
        tests.append(F.exists("contractTypes", lambda c: tx.fold_search(c) == target))
    if city:
        named = F.exists("cities", lambda c: tx.fold_search(c).contains(city))
        tests.append(F.col("_location").contains(city) | named)
    if text:
        tests.append(F.col("_search").contains(text))
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def order(sort: str, unique: str = "job_uid", label=tx.collation_key) -> list[Column]:
    """The four served orders.  Text is compared without case and accents and with numbers by value; the key breaks remaining ties."""
    recent, compared = F.desc("activity"), label
    label = lambda name: F.asc(compared(name))
    orders = {
        "recent": [recent, label("title")],
        "company": [label("company"), recent],
        "title": [label("title"), recent],
        "portals": [F.desc("portals"), recent],
    }
    return [*orders.get(sort, orders["recent"]), F.asc(unique)]


def numbered(rows: DataFrame, sort: str, unique: str = "job_uid") -> DataFrame:
    """``unique, place``: every row of an order, numbered from 1 without one task that sorts everything."""
    keys = order(sort, unique)
    placed = places(rows, keys, "place", columns=[unique])
    return placed.select(unique, (F.col("place") + 1).cast("int").alias("place"))


def served_orders(rows: DataFrame, sorts: Sequence[str], unique: str = "job_uid") -> DataFrame:
    """``sort, unique, place`` of several orders.  What texts compare by is made and stored once, not for each order and each look at the rows."""
    key = lambda name: f"_by_{name}"
    kept = materialize(rows.select(unique, "portals", "activity", *[tx.collation_key(c).alias(key(c)) for c in ("title", "company")]))
    out = None
    for sort in sorts:
        placed = places(kept, order(sort, unique, lambda name: F.col(key(name))), "place", columns=[unique])
        part = placed.select(F.lit(sort).alias("sort"), unique, (F.col("place") + 1).cast("int").alias("place"))
        out = part if out is None else out.unionByName(part)
    return out


def search(rows: DataFrame, spec: SearchSpec, now: Column) -> DataFrame:
    return rows.filter(criteria(spec, now))


def result_page(rows: DataFrame, spec: SearchSpec, now: Column, total: int | None = None) -> DataFrame:
    day = F.floor(F.col("activity") / 86400) if spec.sort not in ("company", "title", "portals") else None
    return one_page(search(rows, spec, now), order(spec.sort), spec.page, spec.page_size, total, day)


def recent_companies(rows: DataFrame, n: int = 6) -> DataFrame:
    """Companies by their newest advertisement."""
    from jobloom.operators.ordering import latest_per_group

    named = rows.filter(tx.fold_search("company") != "")
    latest = latest_per_group(
        named, tx.fold_search("company"), F.col("activity"), F.lit("") if "job_uid" not in rows.columns else F.col("job_uid"),
        ["company", "activity"],
    )
    return latest.orderBy(F.desc("activity"), "group_key").limit(n)


def csv_rows(rows: DataFrame) -> DataFrame:
    """The fifteen exported columns, every cell escaped."""
    yes_no = lambda c: F.when(F.col(c), "Sim").otherwise("Não")
    values = [
        F.col("title"), F.col("company"), F.col("sourceLabel"), F.col("category"), F.col("seniority"),
        F.col("workplaceType"), F.col("market"), F.col("location"), F.array_join("contractTypes", " | "),
        yes_no("pcd"), yes_no("blindSelection"), salary_text(F.col("salaryMin"), F.col("salaryMax"), F.col("currency")),
        F.col("publishedAt"), F.col("lastSeenAt"), F.col("url"),
    ]
    return rows.select(*[tx.csv_cell(v).alias(h) for v, h in zip(values, fx.CSV_HEADERS)])
