"""Landed listing cards (link, title, text lines): which line is the date, the company, the place, the title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fx
from jobloom.functions import text as tx
from jobloom.functions.dates import relative_date
from jobloom.schema import canonical

CARD_ID = r"__(\d+)\.aspx(?:$|[?#])"


def text_lines(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(tx.text_or_blank(c), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\u0085  ]"), tx.squeeze), lambda v: v != "")


def _is_date(line: Column) -> Column:
    return F.lower(line).rlike(fx.CARD_DATE_LINE)


def _is_place(line: Column) -> Column:
    return line.rlike(fx.CARD_DISTANCE_LINE) | line.rlike(fx.CARD_PLACE_LINE)


def _first(lines: Column, test) -> Column:
    return F.get(F.filter(lines, test), F.lit(0))


def card_identifier(href: Column | str) -> Column:
    return F.regexp_extract(tx.text_or_blank(href), CARD_ID, 1)


def normalize_cards(cards: DataFrame, today: Column, source: str = "infojobs", keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical rows of cards with an identifier and a title.  Row-local: list functions over the lines."""
    staged = cards.withColumns(
        {"_lines": text_lines("text"), "_heads": text_lines("title"), "_link": tx.canonical_url("href")}
    )
    lines = F.col("_lines")
    dated = F.transform(F.slice(lines, 1, 16), lambda v, i: F.when(_is_date(v), i))
    staged = staged.withColumn("_at", F.coalesce(F.array_min(F.array_compact(dated)), F.lit(-1)))
    # everything after the date line; the whole card when there is none
    rest = F.slice(lines, F.col("_at") + 2, F.greatest(F.size(lines), F.lit(1)))
    staged = staged.withColumn("_rest", rest)

    def names_company(v: Column) -> Column:
        folded = F.lower(v)
        # the length first: it is known without a look at a long line
        return (F.length(v) <= 140) & ~(
            folded.isin(*fx.CARD_NOT_COMPANY) | folded.isin(*fx.CARD_COUNTRY_LINES) | v.rlike(fx.CARD_RATING_LINE)
            | v.rlike(fx.CARD_SALARY_LINE) | _is_place(v) | _is_date(v)
        )

    def city_of(v: Column) -> Column:
        far, near = F.regexp_extract(v, fx.CARD_DISTANCE_LINE, 1), F.regexp_extract(v, fx.CARD_PLACE_LINE, 1)
        return F.regexp_replace(F.coalesce(F.nullif(far, F.lit("")), near), r"^[ ,.\-]+|[ ,.\-]+$", "")

    def settles_place(v: Column) -> Column:
        city = city_of(v)
        return F.lower(v).isin(*fx.CARD_COUNTRY_LINES) | (_is_place(v) & (city != "") & ~F.lower(city).isin(*fx.CARD_NOT_CITY))

    def is_title(v: Column) -> Column:
        folded = F.lower(v)
        return ~(
            folded.isin(*fx.CARD_NOT_TITLE) | _is_date(v) | v.rlike(fx.CARD_RATING_LINE) | v.rlike(fx.CARD_SALARY_LINE)
            | v.rlike(fx.CARD_DISTANCE_LINE)
        )

    place = F.coalesce(_first(F.col("_rest"), settles_place), F.lit(""))
    found = F.col("_place")  # the lines are searched once
    national = F.lower(found).isin(*fx.CARD_COUNTRY_LINES)
    state = F.upper(F.coalesce(
        F.nullif(F.regexp_extract(found, fx.CARD_DISTANCE_LINE, 2), F.lit("")), F.regexp_extract(found, fx.CARD_PLACE_LINE, 2)))
    everything = F.array_join(lines, " ")
    company = F.coalesce(_first(F.slice("_rest", 1, 8), names_company), F.lit(fx.COMPANY_CONFIDENTIAL))
    staged = staged.withColumns(
        {
            "_id": card_identifier("_link"), "_company": company, "_place": place, "_all": everything,
            "_title": F.coalesce(_first(F.concat("_heads", F.slice(lines, 1, 12)), is_title), F.lit("")),
            "_date": F.coalesce(F.get(lines, F.when(F.col("_at") >= 0, F.col("_at"))), F.lit("")),
        }
    )
    return staged.filter((F.col("_id") != "") & (F.col("_title") != "")).select(
        *canonical(
            {
                "source": F.lit(source), "native_id": F.col("_id"), "title": F.col("_title"), "company": F.col("_company"),
                "url": F.col("_link"),
                "work_model": F.when(F.col("_all").rlike(fx.CARD_REMOTE), "remote").when(F.col("_all").rlike(fx.CARD_HYBRID), "hybrid")
                .when(F.col("_all").rlike(fx.CARD_ON_SITE), "on-site").otherwise(""),
                "city": F.when(national, "").otherwise(city_of(found)), "state": F.when(national, "").otherwise(state),
                "country": F.lit("BR"), "market": F.lit("BR"), "published_date": relative_date("_date", today),
                "description": F.substring(F.array_join(F.filter("_lines", lambda v: ~F.lower(v).isin(*fx.CARD_NOT_TEXT)), " "), 1, 3000),
                "contract_types": tx.labels_in_text(F.lower("_all"), fx.CARD_CONTRACTS),
                "blind_selection": F.lower("_company").contains("confidencial"),
            }
        ),
        *keep,
    )
