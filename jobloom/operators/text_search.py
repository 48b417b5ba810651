"""Substring search over stored rows through trigram postings, and texts met by a vocabulary table.

**Index.**  ``build`` stores, per trigram of the folded search text, the sorted keys of the rows that hold it, in lists of one chunk of
keys each; rows lie in one folder per chunk.  Postings are sorted by trigram, so a lookup reads the few row groups whose range
holds it.  A search reads the lists of the query's rarest trigrams only, intersects them chunk by chunk, and asks the exact question of
the rows that are left, in the folders that hold them.  A query shorter than a trigram reads all rows.

**Vocabulary.**  ``vocabulary_hits`` takes terms from a table of any size: they are dealt to automata of a bounded number of terms,
and every automaton passes over the texts in place, which never move.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom.functions.positions import MAX_PHRASES, phrases_present
from jobloom.operators.ordering import places
from jobloom.session import materialize

#: Keys per posting list and folder.
CHUNK = 65_536
GRAM = 3
#: Rarest trigrams of a query whose lists are read.
READ = 4
#: Candidates that may be broadcast; the smallest posting list bounds their number before anything is read.
BROADCAST_KEYS = 100_000


def _grams(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)))


def build(rows: DataFrame, path: str, key: str = "position", text: str = "_search") -> None:
    """Store ``rows`` and their index under ``path``; ``key`` is a unique whole number, best without large gaps."""
    chunk = F.floor(F.col(key) / CHUNK).cast("int").alias("chunk")
    rows.withColumn("chunk", chunk).repartition("chunk").sortWithinPartitions("chunk", key).write.partitionBy("chunk").parquet(f"{path}/rows")
    # the stored rows are read back, so that deriving the text is paid once
    stored = rows.sparkSession.read.parquet(f"{path}/rows").select("chunk", F.col(key).alias("key"), F.explode(_grams(F.col(text))).alias("gram"))
    # at most CHUNK keys in a list
    lists = stored.groupBy("gram", "chunk").agg(F.array_sort(F.collect_list("key")).alias("keys")).withColumn("n", F.size("keys"))
    lists.repartitionByRange("gram", "chunk").sortWithinPartitions("gram", "chunk").write.parquet(f"{path}/postings")


def _rarest(spark: SparkSession, path: str, grams: Sequence[str]) -> list[tuple[str, int]]:
    """(trigram, rows) of the rarest trigrams of a query; empty if one of them is nowhere."""
    sizes = spark.read.parquet(f"{path}/postings").filter(F.col("gram").isin(*grams)).groupBy("gram").agg(F.sum("n").alias("n"))
    found = sorted(((r["n"], r["gram"]) for r in sizes.collect()))  # at most one row per trigram of the query
    return [(gram, n) for n, gram in found[:READ]] if len(found) == len(grams) else []


def candidates(spark: SparkSession, path: str, wanted: str) -> tuple[DataFrame | None, int]:
    """``chunk, key`` of the rows that hold the query's rarest trigrams, and a bound of their number; None if all rows have to be read."""
    grams = sorted({wanted[i : i + GRAM] for i in range(len(wanted) - GRAM + 1)})
    if not grams:
        return None, -1
    chosen = _rarest(spark, path, grams)
    lists = spark.read.parquet(f"{path}/postings").filter(F.col("gram").isin(*[g for g, _ in chosen]) if chosen else F.lit(False))
    per_chunk = lists.groupBy("chunk").agg(F.collect_list("keys").alias("lists")).filter(F.size("lists") == len(chosen))
    both = F.aggregate("lists", F.get("lists", F.lit(0)), lambda kept, keys: F.array_intersect(kept, keys))
    return per_chunk.select("chunk", F.explode(both).alias("key")), chosen[0][1] if chosen else 0


def indexed_search(spark: SparkSession, path: str, wanted: str, also: Column | None = None, key: str = "position", text: str = "_search") -> DataFrame:
    """Stored rows whose text holds the folded ``wanted``; ``also`` is a further condition on the rows."""
    rows = spark.read.parquet(f"{path}/rows")
    if also is not None:
        rows = rows.filter(also)
    found, most = candidates(spark, path, wanted)
    if found is not None:
        found = found.withColumnRenamed("key", key)
        # joined on the folder column as well, so that other folders are not read
        rows = rows.join(F.broadcast(found) if most <= BROADCAST_KEYS else found, ["chunk", key], "left_semi")
    return rows.filter(F.col(text).contains(wanted)).drop("chunk")


def vocabulary_hits(texts: DataFrame, terms: DataFrame, folded: str, term: str = "term", shard: int = MAX_PHRASES) -> DataFrame:
    """``texts`` without ``folded``, with ``term``: each text once per term that it holds by the alias rules.

    ``terms`` has one folded term per row, in any number.  They are numbered and dealt to automata of ``shard`` terms; an
    automaton's terms are a constant of its pass over the texts.
    """
    known = materialize(terms.select(term).filter(F.length(term) > 0).distinct())
    numbered = materialize(places(known, [F.col(term)], "place"))
    kept, out = [c for c in texts.columns if c != folded], None
    for s in range(max(1, -(-numbered.count() // shard))):
        # ``shard`` rows at most
        words = [r[0] for r in numbered.filter(F.floor(F.col("place") / shard) == s).select(term).collect()]
        hits = texts.select(*kept, phrases_present(F.col(folded), words).alias("_hits"))
        named = F.from_json(F.lit(json.dumps(words)), "array<string>")
        part = hits.select(*kept, F.explode(F.transform("_hits", lambda i: F.get(named, i))).alias(term))
        out = part if out is None else out.unionByName(part)
    return out


__all__ = ["build", "candidates", "indexed_search", "vocabulary_hits"]
