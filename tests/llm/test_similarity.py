"""Jaccard join, components, top-k search and the pipeline against brute force."""

import itertools
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from jobloom.llm import ngram_join, topk
from jobloom.llm.common import number_rows
from jobloom.llm.components import components

from .helpers import AWKWARD, documents


def smallest(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_components(texts, width, percent):
    sets = {i: shingles(t, width) for i, t in texts.items()}
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    found = smallest(sets, linked)
    return {i: (len(sets[i]), found[i]) for i in sets}


def near_copies(seed, groups, copies, length, edits):
    rng = np.random.default_rng(seed)
    shared = [f"s{i}" for i in range(30)]
    texts = []
    for g in range(groups):
        base = [f"w{x}" for x in rng.integers(0, 4000, length)]
        for _ in range(copies):
            words = [*(shared if g % 2 else []), *base]
            for at in rng.integers(0, len(words), rng.integers(0, edits + 1)):
                words[at] = f"n{rng.integers(0, 10**6)}"
            texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize(("width", "percent", "chunk", "frequent"), [(3, 90, 512, 48), (3, 90, 6, 4), (2, 60, 10, 10)])
def test_jaccard_components(spark, monkeypatch, width, percent, chunk, frequent):
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    texts = [*AWKWARD, *near_copies(1, 6, 12, 90, 5), *near_copies(2, 1, 40, 60, 3), "A b C", "a B c", "a b c d"]
    docs = documents(spark, texts)
    docs = docs.unionByName(docs.filter(F.col("doc_id") == 12))
    got = ngram_join.jaccard_components(docs, width, percent).collect()
    assert len(got) == len(texts) + 1
    assert {r[0]: (r[1], r[2]) for r in got} == plain_components(dict(enumerate(texts)), width, percent)


def test_jaccard_odd_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (7, "a b c d"), (3, "a b c d"), (3, "x y z u v"), (9, "x y z u v")], "doc_id long, text string")
    got = sorted(ngram_join.jaccard_components(docs, 3, 90).collect(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["component_id"] for r in got[2:]] == [3, 3, 3, 3]  # the repeated id 3 joins both groups
    assert ngram_join.jaccard_components(docs.limit(0), 3, 90).count() == 0


def test_components_of_a_long_chain(spark, monkeypatch):
    """A chain in order of ids got shorter by four nodes a round and did not converge."""
    from jobloom.llm import components as module

    chain = spark.createDataFrame([(i, i + 1) for i in range(600)], "a long, b long")
    expected = [(i, 0) for i in range(601)]
    assert sorted(map(tuple, components(chain).collect())) == expected
    monkeypatch.setattr(module, "TASK_ROWS", 100)
    monkeypatch.setattr(module, "BROADCAST_ROWS", 0)  # pointers are shuffled
    assert sorted(map(tuple, components(chain).collect())) == expected


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (200, 101), (300, 300)]
    table = spark.createDataFrame(edges, "a long, b long")
    got = {r[0]: r[1] for r in components(table).collect()}
    want = smallest(set(itertools.chain(*edges)) - {300}, edges[:-1])
    assert got == want
    assert components(table.limit(0)).count() == 0


def test_number_rows(spark):
    table = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    rows = number_rows(table, ["g"], ["id"], "at", 1000, 3).collect()
    for g in range(3):
        assert sorted(r["at"] for r in rows if r["g"] == g) == list(range(len([r for r in rows if r["g"] == g])))


def test_topk(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 5)
    monkeypatch.setattr(topk, "LEAF", 4)
    rng = np.random.default_rng(3)
    vectors = {i: [float(x) for x in rng.normal(size=8).round(1)] for i in range(150)}
    vectors |= {i: vectors[0] for i in range(150, 190)}  # ties
    rows = [(i, v, "clash") for i, v in vectors.items()] + [(500, None, ""), (501, [1.0, None] * 4, ""), (502, [float("nan")] * 8, ""), (503, [float("inf")] * 8, ""), (None, [1.0] * 8, ""), (504, [1.0], "")]
    table = topk.prepared(spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard string"), "vec_id", "embedding", 1024)
    got = topk.search(table, table.filter(F.col("vec_id") % 10 == 0), 7).collect()
    whole = {i: np.floor(1024 * np.array(v, dtype=np.float32).astype(float)).astype(int) for i, v in vectors.items()}
    for q in range(0, 190, 10):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:7]
        assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    few = table.filter(F.col("vec_id") < 3)
    assert topk.search(few, few, 7).count() == 6
    assert topk.search(few.limit(0), few, 7).count() == 0


def test_topk_of_repeated_queries(spark):
    rows = [(0, [3, 0]), (0, [3, 0]), (0, [0, 2]), (1, [5, 1]), (2, [4, 0]), (3, [0, 7])]
    table = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = topk.search(table, table.filter(F.col("vec_id") == 0), 2).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == [(1, 1, 15), (1, 3, 14), (2, 1, 2), (2, 2, 12)]


def test_pipeline_stages(spark):
    words = [" ".join(f"term{(i * 37 + k * (i + 3)) % 900} and" for k in range(60)) + "." for i in range(12)]
    docs = documents(spark, [*words, words[3], words[4].replace("term5 ", "term6 ", 1), words[0] + " password=abcdefgh12 end", "spam " * 300, *AWKWARD])
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, "")
        if i < 3:
            assert docs.columns == before.columns, name
    pieces = docs.collect()
    kept = {r["doc_id"] for r in pieces}
    assert kept == set(range(12)) or kept == set(range(12)) | {14}
    assert corpus_pipeline.STAGES[2][1](spark, before.limit(0), "").count() == 0


def test_pipeline_decisions(spark):
    long = [" ".join(f"w{i}x{k}" for k in range(80)) for i in range(3)]
    docs = documents(spark, [long[0], long[0], long[1], long[2] + " token=abcdefgh1234"]).withColumn("n_chars", F.length("text").cast("long"))
    one = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r["doc_id"] for r in one.collect()) == [0, 2, 3]
    clean = {r["doc_id"]: r for r in corpus_pipeline.secret_scan(spark, one, "").collect()}
    assert clean[3]["text"] == long[2] + " [assign]" and clean[3]["n_chars"] == len(clean[3]["text"])


def test_pipeline_runs_on_a_table(spark):
    folder = "/root/testdata/sf0.001"
    if os.path.isdir(folder):
        assert corpus_pipeline.run(spark, folder).count() > 0
