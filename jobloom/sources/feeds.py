"""RSS feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions import arrays as ar, dates as dt, text as tx
from jobloom.operators.dedupe import keep_first
from jobloom.schema import canonical

_ITEM = "title array<string>, link array<string>, region array<string>, category array<string>, country array<string>, pubDate array<string>, description array<string>"


def items(feeds: DataFrame) -> DataFrame:
    """One row per ``<item>`` of landed feeds (``page, body``)."""
    found = F.regexp_extract_all("body", F.lit(r"(?s)(<item\b[^>]*>.*?</item>)"), 1)
    one = feeds.select("page", F.posexplode(found).alias("item_ord", "_xml"))
    parsed = one.withColumn("_i", F.from_xml("_xml", _ITEM, {"rowTag": "item", "mode": "PERMISSIVE"}))
    first = lambda n: tx.strip(tx.text_or_blank(F.get(F.col("_i")[n], F.lit(0)))).alias(n)
    return parsed.select("page", "item_ord", *[first(n) for n in ("title", "link", "region", "category", "country", "pubDate", "description")])


def split_title(title: Column) -> Column:
    """``Company: Job`` as a struct; without the separator everything is the title."""
    at = F.instr(title, ": ")
    rest = F.substring(title, at + 2, F.length(title))
    whole = (at == 0) | (rest == "")
    return F.struct(
        F.when(whole, "").otherwise(F.substring(title, F.lit(1), at - 1)).alias("company"), F.when(whole, title).otherwise(rest).alias("title")
    )


def rows(feeds: DataFrame, source: str = "weworkremotely") -> DataFrame:
    """Canonical rows, first occurrence of each link over all feeds."""
    found = items(feeds.filter(F.col("source") == source)).filter(F.col("link") != "")
    named = split_title(F.col("title"))
    mapped = found.select(
        *canonical(
            {
                "source": F.lit(source), "native_id": F.col("link"), "title": named["title"], "company": named["company"], "url": F.col("link"),
                "work_model": F.lit("remote"), "country": tx.first_non_blank("region", "country"), "market": F.lit("Global remote"),
                "published_date": dt.mail_date("pubDate"), "description": tx.strip_html("description"), "categories": ar.singleton(F.col("category")),
            }
        ),
        "page", "item_ord",
    )
    return keep_first(mapped, ["native_id"], ["page", "item_ord"])
