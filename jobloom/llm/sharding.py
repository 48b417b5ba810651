"""Weighted rendezvous hashing: every record goes to the shard with the best score for its key.

The score of key k on shard s with weight w is -ln(u) / w, u in (0, 1) drawn from md5("k:s"); the smallest wins, ties go to
the smaller shard.  A further shard can only win rows for itself; with equal weights it takes about 1 / (n + 1) of them.
Everything is a native expression over the key, so assigning shards is row-local.

Nulls, repeats: a null key is a key of its own (the string "null"); repeated keys share a shard; an empty table gives an
empty result.  Input columns other than the key and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import number_rows

#: Digits of md5 that make the draw; 13 hexadecimal digits are exact in a double.
DRAW_DIGITS = 13


def scores(key: Column, weights: Sequence[float]) -> Column:
    """Array of (score, shard), one per shard of positive weight; a null key counts as the string "null"."""
    usable = [F.struct(F.lit(s).alias("shard"), F.lit(float(w)).alias("weight")) for s, w in enumerate(weights) if w > 0]
    if not usable:
        raise ValueError("no shard has a positive weight")
    key = F.coalesce(key.cast("string"), F.lit("null"))

    def score(shard: Column) -> Column:
        digest = F.md5(F.concat_ws(":", key, shard["shard"].cast("string")).cast("binary"))
        draw = (F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16**DRAW_DIGITS))
        return F.struct((-F.log(draw) / shard["weight"]).alias("score"), shard["shard"].alias("shard"))

    return F.transform(F.array(*usable), score)


def best_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard (position in ``weights``) that wins ``key``; shards of weight 0 or less take nothing."""
    return F.array_min(scores(key, weights)).getField("shard")


def shard_table(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size (UTF-8 bytes of the text plus 8; null text: 8), text_crc32, shard, slot and, if ``grown`` is given, grown_shard.

    ``slot`` numbers the rows of a shard from 0 without gaps.  The text is reduced to size and checksum before any row
    moves.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
        best_shard(F.col(key), weights).alias("shard"),
        *([best_shard(F.col(key), grown).alias("grown_shard")] if grown is not None else []),
    )
    return number_rows(rows, ["shard"], [key, "text_crc32", "size"], "slot", docs.count(), len(weights))
