"""Exact top-k search by inner product: a ball tree per shard, searched by branch and bound.

Vectors are scaled to whole numbers, so scores are exact.  They are dealt into shards by a hash of their id; a task builds the
ball tree of one shard and searches it for a block of queries, nodes in the order of their upper bound q.centre + |q| radius.
A search stops where the bound falls below the current k-th score.  That score is shared in two ways: inside a search by
the bounded list of the best so far, and across shards by a first round, in which every query is searched in its home
shard only; the k-th score found there travels with the query to all other shards.

Vectors that are null or hold null or non-finite components take no part; neither do vectors of another length than most
(``dimension``).  Ties go to the smaller id.  Fewer than k candidates: all of them.  Rows of a repeated id are separate candidates, but a
query never finds rows of its own id; query rows that agree in id and vector are one query, those that share only the id are ranked
on their own.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import stage_table

#: Vectors of one tree, and queries of one block: what a task holds.
SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
LEAF = 64

HITS = "query_id long, tag int, vec_id long, score long"


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))


def scaled(vector: Column, factor: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(factor))).cast("long"))


class BallTree:
    """Rows in leaf order; node i covers rows start[i]..end[i], its children are 2i+1 and 2i+2."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.start, self.end, self.centre, self.radius, self.least, self.child = [], [], [], [], [], []
        order = np.arange(len(ids))
        self._grow(ids, rows, order, 0, len(ids))
        self.ids, self.rows = ids[order], rows[order]
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)

    def _grow(self, ids: np.ndarray, rows: np.ndarray, order: np.ndarray, start: int, end: int) -> None:
        """Split at the median of the direction between two far points; equal points are split by position."""
        work = [(start, end, -1, 0)]
        while work:
            start, end, parent, side = work.pop()
            node = len(self.start)
            if parent >= 0:
                self.child[parent][side] = node
            part = rows[order[start:end]]
            centre = part.mean(axis=0)
            away = np.sqrt(((part - centre) ** 2).sum(axis=1))
            self.start.append(start)
            self.end.append(end)
            self.centre.append(centre)
            self.radius.append(float(away.max()))
            self.least.append(int(ids[order[start:end]].min()))
            self.child.append([-1, -1])
            if end - start > LEAF:
                one = part[away.argmax()]
                other = part[((part - one) ** 2).sum(axis=1).argmax()]
                middle = (end - start) // 2
                order[start:end] = order[start:end][np.argsort(part @ (other - one), kind="stable")]
                work += [(start, start + middle, node, 0), (start + middle, end, node, 1)]

    def search(self, query_id: int, query: np.ndarray, k: int, floor: float) -> list[tuple[int, int]]:
        """The best (score, id) of this tree that can matter: at most k, none with a score below ``floor``."""
        best: list[tuple[int, int]] = []  # a heap of (score, -id), its least first
        length = math.sqrt(float(query @ query))
        bounds = self.centre @ query + self.radius * length
        bounds += np.abs(bounds) * 1e-9 + 1.0  # rounding may not prune
        todo = [(-bounds[0], 0)]
        while todo:
            bound, node = heapq.heappop(todo)
            worst = best[0] if len(best) == k else (floor, -math.inf)
            if -bound < worst[0]:
                break
            left, right = self.child[node]
            if left >= 0:
                for child in (left, right):
                    if bounds[child] >= worst[0]:
                        heapq.heappush(todo, (-bounds[child], child))
                continue
            start, end = self.start[node], self.end[node]
            scores = self.rows[start:end] @ query
            for at in np.flatnonzero(scores >= worst[0]):
                hit = (int(scores[at]), -int(self.ids[start + at]))
                if -hit[1] == query_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, hit)
                elif hit > best[0]:
                    heapq.heapreplace(best, hit)
        return [(score, -negative) for score, negative in best]


def _rows(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def search_blocks(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Hits of every query (to_shard, of_block, query_id, tag, query, floor) in the tree of its shard.

    Both sides meet on (shard, block), so a task holds one shard and one block, whatever the size of the tables.
    """

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            tree = BallTree(left["vec_id"].to_numpy(), _rows(left["vector"]))
            asked = zip(right["query_id"].to_numpy(), right["tag"].to_numpy(), _rows(right["query"]), right["floor"].to_numpy(), strict=True)
            for query_id, tag, query, floor in asked:
                found += [(int(query_id), int(tag), i, s) for s, i in tree.search(int(query_id), query, k, float(floor))]
        return pd.DataFrame(found, columns=["query_id", "tag", "vec_id", "score"], dtype="int64")

    return vectors.groupBy("shard", "block").cogroup(queries.groupBy("to_shard", "of_block")).applyInPandas(search, HITS)


def top_hits(hits: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each query (row_number below a limit is cut in each task first)."""
    order = Window.partitionBy("query_id", "tag").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Top k of every query row in all vector rows; both with vec_id and a vector of whole numbers (array<long>)."""
    dimension = vectors.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if dimension is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    largest = vectors.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0] or 0
    if dimension["n"] * int(largest) ** 2 >= 2**53:
        raise ValueError("scores beyond 2^53 are not exact in double precision; use a smaller factor")
    vectors, queries = (x.filter(F.size("vector") == dimension["n"]) for x in (vectors, queries))
    shards, blocks = (max(1, math.ceil(x.count() / n)) for x, n in ((vectors, SHARD_ROWS), (queries, BLOCK_QUERIES)))
    home = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks)).cast("int")
    dealt = vectors.select("vec_id", "vector", home.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    tag = F.row_number().over(Window.partitionBy("vec_id").orderBy("vector")) - 1
    queries = queries.select("vec_id", "vector").distinct().withColumn("tag", tag)
    asked = queries.select(F.col("vec_id").alias("query_id"), "tag", F.col("vector").alias("query"), home.alias("home"), block.alias("of_block"))
    asked = asked.select("*", F.col("home").alias("to_shard"), F.lit(-math.inf).alias("floor"))
    first = stage_table(search_blocks(dealt, asked, k), "topk-home")
    floors = first.groupBy(F.col("query_id").alias("known"), F.col("tag").alias("known_tag")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).filter(F.col("n") == k)
    asked = asked.join(floors, (F.col("query_id") == F.col("known")) & (F.col("tag") == F.col("known_tag")), "left").withColumn("floor", F.coalesce(F.col("kth").cast("double"), F.lit(-math.inf)))
    others = asked.withColumn("to_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter(F.col("to_shard") != F.col("home"))
    hits = first.unionByName(search_blocks(dealt, others.select("to_shard", "of_block", "query_id", "tag", "query", "floor"), k))
    return top_hits(hits, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def prepared(table: DataFrame, id_col: str, vector_col: str, factor: int) -> DataFrame:
    """Rows that take part, as vec_id and vector of whole numbers."""
    return table.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(F.col(id_col).alias("vec_id"), scaled(F.col(vector_col), factor).alias("vector"))
