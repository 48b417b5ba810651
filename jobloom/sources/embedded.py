"""JSON that sits inside pages: script elements, assignments, escaped strings and streamed chunks.

Each function turns ``body`` into the JSON text it carries; blank when there is none.  Parsing stops after the first
complete value, so whatever follows it does no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions.text import regex_quote, strip, text_or_blank, unescape

_NEXT = r"""(?is)<script[^>]+id=["']__NEXT_DATA__["'][^>]*>(.*?)</script>"""


def script_data(body: Column | str, escaped: bool = False) -> Column:
    """Content of the page's data script."""
    found = F.regexp_extract(text_or_blank(body), _NEXT, 1)
    return unescape(found) if escaped else found


def after_marker(body: Column | str, marker: str) -> Column:
    """Everything after the first occurrence of a marker."""
    text = text_or_blank(body)
    at = F.instr(text, marker)
    return F.when(at > 0, F.substring(text, at + len(marker), F.length(text))).otherwise("")


def escaped_list(body: Column | str, name: str, next_name: str) -> Column:
    """A list inside an escaped string: ``name\\":[…],\\"next``."""
    found = F.regexp_extract(text_or_blank(body), rf'(?s){name}\\":(\[.*?\]),\\"{next_name}', 1)
    return F.replace(found, F.lit('\\"'), F.lit('"'))


def stream(body: Column | str) -> Column:
    """Text chunks a page pushes to its runtime, joined."""
    calls = F.regexp_extract_all(text_or_blank(body), F.lit(r"(?s)self\.__next_f\.push\((.*?)\)</script>"), 1)
    chunk = lambda c: F.try_variant_get(F.try_parse_json(c), "$[1]", "variant")
    texts = F.transform(calls, lambda c: F.when(F.schema_of_variant(chunk(c)) == "STRING", F.try_variant_get(chunk(c), "$", "string")))
    return F.array_join(F.array_compact(texts), "")


def stream_list(joined: Column, marker: str = '"__typename":"PublicJob"', label: str = '"data":') -> Column:
    """The list whose label is the last one before a marker."""
    at = F.instr(joined, marker)
    head = F.substring(joined, F.lit(1), at - 1)
    back = F.instr(F.reverse(head), label[::-1])
    start = F.length(head) - back + 2
    return F.when((at > 0) & (back > 0), F.substring(joined, start, F.length(joined))).otherwise("")


def as_payload(pages: DataFrame, payload: Column, wrapper: str = "") -> DataFrame:
    """Landed pages with ``body`` replaced by the JSON they carry, wrapped as ``{"wrapper": …}`` if asked; pages
    without any are dropped."""
    value = F.try_parse_json(F.nullif(strip(payload), F.lit("")))
    text = value.cast("string")
    body = F.concat(F.lit(f'{{"{wrapper}":'), text, F.lit("}")) if wrapper else text
    return pages.withColumn("body", body).filter(F.col("body").isNotNull())


__all__ = ["after_marker", "as_payload", "escaped_list", "regex_quote", "script_data", "stream", "stream_list"]
