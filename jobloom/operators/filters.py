"""Row filters and rule-based fills on the canonical relation.  All are narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fx
from jobloom.functions.dates import day, iso_date, publication_cutoff
from jobloom.functions.text import blank_to_null, fold_caseless, fold_search, strip, text_or_blank


def is_valid_row(title: str = "title", url: str = "url") -> Column:
    """A row needs a title and a link."""
    return (text_or_blank(title) != "") & (text_or_blank(url) != "")


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(is_valid_row())


def selected_sources(df: DataFrame, names: str, known: Sequence[str]) -> DataFrame:
    """Rows of a comma-separated list of sources; unknown names are an error, a blank list means all."""
    wanted = sorted({part.strip().lower() for part in (names or "").split(",") if part.strip()})
    missing = [name for name in wanted if name not in set(known)]
    if missing:
        raise ValueError(f"unknown source(s): {', '.join(missing)}")
    return df.filter(F.col("source").isin(*wanted)) if wanted else df


def market_from_city(city: Column, market: Column) -> Column:
    """An advertisement located in Brazil as a whole belongs to the Brazilian market."""
    return F.when(F.lower(strip(text_or_blank(city))).isin(*fx.BRAZIL_NAMES), "BR").otherwise(market)


def inferred_work_model(work_model: Column, city: Column, country: Column, market: Column) -> Column:
    """Fill a blank work model of a Brazilian row: nationwide means remote, a named place means on site."""
    place, nation, reach = (F.lower(strip(text_or_blank(c))) for c in (city, country, market))
    brazilian = nation.isin(*fx.BRAZIL_CODES) | (reach == "br")
    nationwide = place.isin(*fx.REMOTE_CITY_NAMES) | ((place == "") & nation.isin(*fx.BRAZIL_NAMES))
    return (
        F.when((strip(text_or_blank(work_model)) != "") | ~brazilian, work_model)
        .when(nationwide, "remote")
        .when(place != "", "on-site")
        .otherwise(work_model)
    )


def with_inferred_work_model(df: DataFrame, flag: str | None = None) -> DataFrame:
    """Apply the rule; ``flag`` names a boolean column telling which rows were filled."""
    filled = inferred_work_model(F.col("work_model"), F.col("city"), F.col("country"), F.col("market"))
    if flag:
        was_blank = strip(text_or_blank("work_model")) == ""
        df = df.withColumn(flag, was_blank & (strip(text_or_blank(filled)) != ""))
    return df.withColumn("work_model", filled)


def market_is_known(market: Column) -> Column:
    return ~strip(text_or_blank(market)).isin("", fx.UNKNOWN_MARKET)


def is_recent_publication(published: Column, expires: Column, source: Column, today: Column, months: int = 2) -> Column:
    """Undated, published since the cutoff, or an open application on the portal that keeps old dates when reopening."""
    reopened = (source == "gupy") & (day(expires) != "") & (day(expires) >= today.cast("string"))
    date = day(published)
    return F.coalesce((date == "") | (date >= publication_cutoff(today, months)) | reopened, F.lit(True))


def is_retained(today: Column, keep_days: int = 120, months: int = 2) -> Column:
    """History rows that survive pruning; NULL market of the world-wide board counts as unknown, so it goes."""
    seen_cutoff = F.date_sub(today.cast("date"), keep_days).cast("string")
    published = F.coalesce(F.nullif(F.col("published_date"), F.lit("")), F.col("first_seen_date"))
    reopened = (F.col("source") == "gupy") & (text_or_blank("expires_date") >= today.cast("string"))
    gone = (
        (F.col("last_seen_date") < seen_cutoff)
        | ((published < publication_cutoff(today, months)) & ~reopened)
        | ((F.col("source") == "greenhouse") & (text_or_blank("market") != "BR"))
    )
    return ~F.coalesce(gone, F.lit(False))


def is_eligible(today: Column, fresh_days: int = 3, months: int = 2) -> Column:
    """History rows shown to the public: seen lately, not expired, known market, recent or reopened.

    The ``fresh_days`` tolerance is what keeps a portal's rows visible through a short outage.
    """
    today_text = today.cast("string")
    seen_cutoff = F.date_sub(today.cast("date"), max(0, fresh_days - 1)).cast("string")
    published = F.coalesce(F.nullif(F.col("published_date"), F.lit("")), F.col("first_seen_date"))
    expires = text_or_blank("expires_date")
    reopened = (F.col("source") == "gupy") & (expires >= today_text)
    return (
        (F.col("last_seen_date") >= seen_cutoff)
        & ((expires == "") | (expires >= today_text))
        & (F.coalesce(F.nullif(F.col("market"), F.lit("")), F.lit(fx.UNKNOWN_MARKET)) != fx.UNKNOWN_MARKET)
        & ((F.col("source") != "greenhouse") | (F.col("market") == "BR"))
        & ((published >= publication_cutoff(today, months)) | reopened)
    )


def names_brazil(place: Column, pattern: str = fx.BRAZIL_PLACES) -> Column:
    """An explicit country name or a listed city, as a whole word."""
    return text_or_blank(place).rlike(pattern)


def names_brazil_or_state(place: Column, pattern: str = fx.BRAZIL_PLACES, codes: Sequence[str] = fx.BRAZIL_STATE_CODES) -> Column:
    """Also accepts a delimited upper-case state code."""
    state = rf"(?:^|[,/()\s-])(?:{'|'.join(codes)})(?:$|[,/()\s-])"
    return names_brazil(place, pattern) | text_or_blank(place).rlike(state)


def accepted_place(override: Column, place: Column, pattern: str = fx.BRAZIL_PLACES) -> Column:
    """A board known to be Brazilian passes without a place check."""
    return F.coalesce(override, F.lit(False)) | names_brazil(place, pattern)


def is_published(status: Column) -> Column:
    return F.lower(text_or_blank(status)) == "published"


def is_demo_tenant(slug: Column, name: Column) -> Column:
    return text_or_blank(slug).isin(*fx.DEMO_TENANTS) | (fold_search(name) == "demo")


def recent_or_undated(published: Column, cutoff: Column) -> Column:
    date = iso_date(published)
    return (date == "") | (date >= cutoff)


def page_crosses_cutoff(df: DataFrame, page: str, published: str, cutoff: Column) -> DataFrame:
    """Per page: fully dated and at least one row older than the cutoff, so later pages can be skipped."""
    date = iso_date(F.col(published))
    return df.groupBy(page).agg(
        (F.bool_and(date != "") & F.bool_or((date != "") & (date < cutoff))).alias("stop"),
        F.count_if((date == "") | (date >= cutoff)).alias("kept"),
    )


def has_usable_description(description: Column, minimum: int = fx.MIN_DESCRIPTION_CHARS) -> Column:
    return F.length(fold_caseless(description)) >= minimum


__all__ = [name for name in globals() if not name.startswith("_")]
