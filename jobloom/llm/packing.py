"""Packing documents into sequences of a fixed number of tokens by cutting-stock column generation.

1. Each document becomes token ids and a closing id, cut into pieces of ``capacity`` ids; the last piece may be shorter.
2. Piece lengths are rounded up to bins of ``width`` tokens.  The histogram over bins (capacity / width counts, whatever the
   size of the corpus) is all that reaches the driver.
3. A linear program over patterns (how many pieces of each bin share one sequence) is solved by column generation: the
   simplex method keeps a basis of patterns, and a knapsack dynamic programme over the dual prices finds the next pattern.
4. Multiplicities are rounded down; the few pieces left over are placed by decreasing length.
5. Pieces are ranked within their bin, distributed; ranges of ranks belong to patterns, so a piece finds its sequence by
   arithmetic.  A last window within each sequence gives offsets.

Nulls, ties: a null text is an empty one (a single closing id).  Repeated rows are packed as often as they occur; which of
two equal rows gets which place does not matter.  An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import number_rows, stage_table

#: Tokens of a sequence.
CAPACITY = 2048
#: Tokens by which piece lengths are rounded up before patterns are sought: at most ``width - 1`` tokens lost per piece.
WIDTH = 16
#: The linear program ends when its sequences are within this share of the least conceivable number.
GAP = 5e-4
#: Sizes that the knapsack tries first.
PROMISING = 20
#: Entries of each of the two generations of the memo of one Python worker.
MEMO = 400_000
#: Bytes of the longest word that the memo keeps.
LONGEST = 64
#: Bytes of ids that are held before they go back to Spark, so that those of a whole batch never are.
HELD = 2_000_000

#: White space, and letters and digits that neither lower case nor normalisation takes apart.
_PLAIN = " \\t\\n\\rA-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
#: A full stop or comma beside anything else, with which it might share a token.
_SIGNS_MEET = re.compile(rf"[.,](?=[^{_PLAIN}])|(?<=[^{_PLAIN}])[.,]").search

PIECES = T.ArrayType(T.BinaryType())


class WordIds(dict):
    """Ids of whole texts.  The tokenizer neither sees nor keeps ASCII white space, so words are encoded once and memoised.

    A lower-case ASCII word reaches the merges of the tokenizer directly; any other word takes its whole way.  When the memo
    is full, it starts anew and keeps the previous generation for look-up.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if word.isalpha() and word.islower():
                ids = b"".join([t.id.to_bytes(4, "little") for t in self.merges(word.decode())])
            else:
                found = self.tokenizer.encode(word.decode(), add_special_tokens=False)
                ids = np.array(found.ids, dtype="<u4").tobytes()
        if len(word) <= LONGEST:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if "<|" in text:  # may hold a special token, whose case counts
            data = text.encode()
        else:
            # the tokenizer lowers all letters, and cuts between a word and a full stop or comma; so fewer words are new
            data = (text if _SIGNS_MEET(text) else text.replace(".", " . ").replace(",", " , ")).encode().lower()
        return b"".join(map(self.__getitem__, data.split()))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut_texts(batches: Iterator[pa.Array], path: str, closing: int = 1, capacity: int = CAPACITY) -> Iterator[pa.Array]:
    """Pieces of every text, in arrays of about HELD bytes of ids."""
    encoder, end, step = word_ids(path), np.array([closing], dtype="<u4").tobytes(), 4 * capacity
    for batch in batches:
        rows, held = [], 0
        for value in batch:
            ids = encoder.encode(value.as_py() or "") + end
            rows.append([ids[i : i + step] for i in range(0, len(ids), step)])
            held += len(ids)
            if held >= HELD:
                yield pa.array(rows, pa.list_(pa.binary()))
                rows, held = [], 0
        yield pa.array(rows, pa.list_(pa.binary()))


def pieces_column(text: Column, path: str, closing: int = 1, capacity: int = CAPACITY) -> Column:
    """Array of pieces; a piece is its ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf(PIECES)
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return cut_texts(batches, path, closing, capacity)

    return cut.asNondeterministic()(text)


def tokenize(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", closing: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens and the ids themselves."""
    cut = docs.select(F.col(id_col), pieces_column(F.col(text_col), path, closing, capacity).alias("_pieces"))
    rows = cut.select(id_col, F.size("_pieces").alias("_count"), F.octet_length(F.element_at("_pieces", -1)).alias("_rest"), F.posexplode("_pieces").alias("_at", "ids"))
    return rows.select(
        id_col,
        (F.col("_at").cast("long") * capacity).alias("start"),
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        ((F.col("_count") - 1).cast("long") * capacity + (F.col("_rest") / 4).cast("long")).alias("doc_tokens"),
        "ids",
    )


def knapsack(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Best value of sizes that fit into ``room`` (each as often as it fits), and how often each is taken."""
    best, chosen = np.zeros(room + 1), []
    for price, size in zip(prices.tolist(), sizes.tolist(), strict=True):
        copies, before = np.zeros(room + 1, dtype=np.int64), best
        if price > 0:
            best = before.copy()
            for n in range(1, room // size + 1):
                value = before[: room + 1 - n * size] + n * price
                better = value > best[n * size :] + 1e-12
                best[n * size :][better] = value[better]
                copies[n * size :][better] = n
        chosen.append(copies)
    counts, space = np.zeros(len(sizes)), room
    for i in range(len(sizes) - 1, -1, -1):
        counts[i] = chosen[i][space]
        space -= int(counts[i]) * int(sizes[i])
    return float(best[room]), counts


def price_column(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The next pattern: first from the sizes of best price per token, from all only if these give no gain."""
    if len(sizes) > PROMISING:
        top = np.argsort(-prices / sizes, kind="stable")[:PROMISING]
        value, some = knapsack(prices[top], sizes[top], room)
        if value > 1 + 1e-9:
            counts = np.zeros(len(sizes))
            counts[top] = some
            return value, counts
    return knapsack(prices, sizes, room)


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and fractional multiplicities of a sequence count that is least, or within GAP of the tokens over the room.

    The first basis holds one size per pattern.  Any basis on the way is feasible, so the bound on rounds can only cost
    a little padding; so can rounding errors, as whole multiplicities are checked against what is left.
    """
    patterns = np.diag(room // sizes).astype(float)
    inverse, times = np.diag(1.0 / np.diag(patterns)), demand / np.diag(patterns)
    least = float(sizes @ demand) / room
    for _ in range(20 * len(sizes)):
        value, column = price_column(inverse.sum(axis=0), sizes, room)
        if value <= 1 + 1e-9 or times.sum() <= least * (1 + GAP):
            break
        step = inverse @ column
        rising = step > 1e-9
        ratio = np.full(len(sizes), np.inf)
        ratio[rising] = times[rising] / step[rising]
        out = int(ratio.argmin())
        times -= ratio[out] * step
        times[out] = ratio[out]
        np.maximum(times, 0, out=times)
        patterns[:, out] = column
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
    return patterns, times


def plan_patterns(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns ({size: count}, multiplicity) that use up the histogram exactly."""
    plan: list[tuple[dict[int, int], int]] = [({room: 1}, histogram[room])] if histogram.get(room) else []
    sizes = np.array(sorted(s for s, n in histogram.items() if n and s < room), dtype=np.int64)
    if not len(sizes):
        return plan
    left = {int(s): histogram[int(s)] for s in sizes}
    patterns, times = column_generation(sizes, np.array([float(left[int(s)]) for s in sizes]), room)
    for column, often in sorted(zip(patterns.T, times, strict=True), key=lambda x: -x[1]):
        pattern = {int(s): round(c) for s, c in zip(sizes, column, strict=True) if c > 0.5}
        whole = min([int(often + 1e-6), *(left[s] // c for s, c in pattern.items())])
        if whole > 0:
            plan.append((pattern, whole))
            for s, c in pattern.items():
                left[s] -= whole * c
    while any(left.values()):  # at most a few pieces for each pattern
        pattern, space = {}, room
        for s in sorted(left, reverse=True):
            if fit := min(left[s], space // s):
                pattern[s], space = fit, space - fit * s
        whole = min(left[s] // c for s, c in pattern.items())
        plan.append((pattern, whole))
        for s, c in pattern.items():
            left[s] -= whole * c
    return plan


def rank_ranges(spark: SparkSession, plan: list[tuple[dict[int, int], int]]) -> DataFrame:
    """For each bin and pattern: the ranks that belong to it, how many go to one sequence, and the first sequence."""
    rows, used, first = [], {}, 0
    for pattern, whole in plan:
        for size, count in pattern.items():
            start = used.get(size, 0)
            used[size] = start + count * whole
            rows.append((size, start, used[size], count, first))
        first += whole
    return spark.createDataFrame(rows, "_size int, _from long, _to long, _each long, _first long")


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY, width: int = WIDTH) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length`` of 1 to ``capacity``.

    ``order`` names columns that rank the pieces of a bin; other columns pass through.  ``pieces`` is read three times, so
    hand over a written table.
    """
    rows = pieces.withColumn("_bin", F.ceil(F.col("length") / width).cast("int"))
    histogram = {r["_bin"]: r["n"] for r in rows.groupBy("_bin").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(histogram.values())
    ranges = rank_ranges(pieces.sparkSession, plan_patterns(histogram, capacity // width))
    ranked = number_rows(rows, ["_bin"], order, "_rank", total, 16)
    # broadcast: at most (bins + leftovers) patterns of at most as many bins, independent of the corpus
    placed = ranked.join(F.broadcast(ranges), (F.col("_bin") == F.col("_size")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    placed = placed.withColumn("sequence_id", F.col("_first") + F.floor((F.col("_rank") - F.col("_from")) / F.col("_each")))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *order, "_rank")
    placed = placed.withColumn("offset", F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
    return placed.select(*pieces.columns, F.col("sequence_id").cast("long"), "offset")


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ids are reduced to a checksum before rows move."""
    pieces = tokenize(docs, path).select("doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens")
    return pack(stage_table(pieces, "pieces"), ["doc_id", "start", "ids_crc32"])
