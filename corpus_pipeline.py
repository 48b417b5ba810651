"""Corpus pipeline: quality rules, near duplicates, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's
documents.  All but the last return the columns of their input.  Nulls: a document without text is rejected by the first
stage; a null id is kept by the second, as it cannot be in a group.  Rows that share an id are one document there and one of
them stays (the longest text, then the smallest digest).  Names that begin with ``_stage_`` are reserved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobloom.llm import ngram_join, packing, quality_votes, secrets
from jobloom.llm.common import read_table, stage_table
from jobloom.llm.queries import tokenizer_path

#: Near duplicates: shingles of five words, Jaccard similarity of 0.8 or more.
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the posterior of the voting rules reject go."""
    marked = docs.withColumn("_stage_signals", quality_votes.signals_column(F.col("text")))
    s = F.col("_stage_signals")
    # one pass for the counts of vote patterns, one to filter: the texts are read twice and never shuffled
    model = quality_votes.fit(marked.select(quality_votes.votes(s).alias("votes")))
    kept = ~quality_votes.base_failed(s) & (model.posterior_column(quality_votes.votes(s)) >= quality_votes.KEEP)
    return marked.filter(kept).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    groups = ngram_join.jaccard_components(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)
    stays = groups.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    same_id = Window.partitionBy("doc_id").orderBy(F.desc(F.length("text")), F.md5("text"))
    known = docs.join(stays, "doc_id", "left_semi").withColumn("_stage_at", F.row_number().over(same_id)).filter(F.col("_stage_at") == 1)
    return known.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind in brackets; n_chars follows the text."""
    clean = docs.withColumn("text", secrets.redacted_column(F.col("text")))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their sequence and offset."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", pack_sequences),
]

#: Expectation-maximisation, shingle components and packing have no SQL form; tests/llm checks them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage_table(docs, f"stage-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
