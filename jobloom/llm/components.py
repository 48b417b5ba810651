"""Connected components of an edge table, by hooking to the smallest neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import stage_table

ROUNDS = 64
#: Rows that one task of a round handles at least, and pointers (two ids each) up to which a round broadcasts them.
TASK_ROWS, BROADCAST_ROWS = 50_000, 200_000


def _dealt(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of at most ``rows`` rows in no more tasks than these need: late rounds are short, whatever a shuffle is dealt to."""
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node that can be reached.

    Each round maps a node to its smallest neighbour (or itself), follows these pointers to their ends, doubling the way, and contracts
    the edges, so the nodes at least halve with every round and long chains take logarithmically many steps.  Tables are written in between;
    the edges that are left bound the pointers, and few pointers are broadcast instead of shuffled.
    """
    edges = stage_table(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "edges")
    mapping, most = None, 0
    for _ in range(ROUNDS):
        left = edges.count()
        if not left:
            break
        nodes = 2 * left
        most = max(most, nodes)
        near = F.broadcast if nodes <= BROADCAST_ROWS else lambda df: df
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("up"))
        parent = stage_table(_dealt(parent, nodes), "parents")
        moved = True
        while moved:
            for _ in range(2):
                above = parent.select(F.col("node").alias("n2"), F.col("up").alias("u2"))
                parent = parent.join(near(above), F.col("up") == F.col("n2"), "left").select("node", F.coalesce("u2", "up").alias("up"), (F.col("u2") != F.col("up")).alias("moved"))
            parent = stage_table(_dealt(parent, nodes), "parents")
            moved = not parent.filter("moved").isEmpty()
        a = parent.select(F.col("node").alias("a"), F.col("up").alias("pa"))
        b = parent.select(F.col("node").alias("b"), F.col("up").alias("pb"))
        edges = edges.join(near(a), "a").join(near(b), "b").filter(F.col("pa") != F.col("pb"))
        edges = edges.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        edges = stage_table(_dealt(edges, left), "edges")
        if mapping is None:
            mapping = parent.select("node", F.col("up").alias("component"))
        else:
            step = parent.select(F.col("node").alias("n2"), F.col("up").alias("u2"))
            mapping = mapping.join(near(step), F.col("component") == F.col("n2"), "left").select("node", F.coalesce("u2", "component").alias("component"))
            mapping = stage_table(_dealt(mapping, most), "mapping")
    else:
        raise RuntimeError("components did not converge")
    if mapping is None:
        kind = edges.schema["a"].dataType.simpleString()
        return edges.sparkSession.createDataFrame([], f"node {kind}, component {kind}")
    return mapping
