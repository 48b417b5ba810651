"""Byte-level BPE, packing and sharding against the libraries and plain Python."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobloom.llm import byte_bpe, packing, sharding
from jobloom.llm.queries import tokenizer_path

from .helpers import AWKWARD, documents

RANKS = tokenizer_path("byte_bpe_50k.tiktoken")
WORDS = tokenizer_path("word_bpe_49k.json")
ODD = st.lists(st.sampled_from([*" \n\t'abstAB1é%日́\x1c\xa0\x85İΣﬁ.,_<|>", "'s", "<|endoftext|>", "the"]), max_size=40).map("".join)


@pytest.fixture(scope="module")
def bpe():
    codec = byte_bpe.load(RANKS, P.PATTERN)
    return codec, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(text=ODD)
def test_byte_bpe_equals_the_library_and_round_trips(bpe, text):
    codec, library = bpe
    ids = codec.encode(text)
    assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_byte_bpe_memo_generations(bpe, monkeypatch):
    codec, library = bpe
    monkeypatch.setattr(byte_bpe, "MEMO", 3)
    text = "many different words fill a small memo, and many words come back again"
    assert np.frombuffer(codec.encode(text), dtype="<u4").tolist() == library.encode_ordinary(text)
    assert len(codec.spaced) <= 3


def test_byte_bpe_columns(spark, bpe):
    docs = documents(spark, AWKWARD).withColumn("ids", byte_bpe.encode_column(F.col("text"), RANKS, P.PATTERN))
    rows = docs.withColumn("decoded", byte_bpe.decode_column(F.col("ids"), RANKS, P.PATTERN)).orderBy("doc_id").collect()
    for row in rows:
        assert np.frombuffer(row["ids"], dtype="<u4").tolist() == bpe[1].encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()


@settings(max_examples=400, deadline=None)
@given(text=ODD)
def test_word_ids_equal_the_tokenizer(text):
    encoder = packing.word_ids(WORDS)
    assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_word_memo_and_held_ids_are_bounded(monkeypatch):
    """Within one text too the memo keeps its size, long words are not kept, and ids go back in small arrays."""
    monkeypatch.setattr(packing, "MEMO", 3)
    monkeypatch.setattr(packing, "HELD", 100)
    encoder = packing.WordIds(WORDS)
    text = " ".join(["the", "x" * 500, *(f"word{i} the" for i in range(50))])
    assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder) <= 3 and len(encoder.old) <= 3 and not any(len(w) > packing.LONGEST for w in (*encoder, *encoder.old))
    texts = [text, None, "a", "", *["one two three"] * 40]
    arrays = list(packing.cut_texts(iter([pa.array(texts, pa.string()), pa.array([], pa.string())]), WORDS))
    assert len(arrays) > 5 and sum(map(len, arrays)) == len(texts)
    whole = [b"".join(pieces.as_py()) for a in arrays for pieces in a]
    assert whole == [packing.word_ids(WORDS).encode(t or "") + b"\x01\x00\x00\x00" for t in texts]


@settings(max_examples=60, deadline=None)
@given(histogram=st.dictionaries(st.integers(1, 32), st.integers(0, 500), max_size=32))
def test_patterns_use_up_the_histogram(histogram):
    plan = packing.plan_patterns(histogram, 32)
    used = defaultdict(int)
    for pattern, whole in plan:
        assert whole > 0 and sum(s * c for s, c in pattern.items()) <= 32
        for s, c in pattern.items():
            used[s] += c * whole
    assert dict(used) == {s: n for s, n in histogram.items() if n}
    least = sum(s * n for s, n in histogram.items()) / 32
    assert sum(w for _, w in plan) <= 2 * least + 1  # no two sequences at most half full


def test_knapsack_against_brute_force():
    prices, sizes = np.array([0.3, 0.45, 0.9, -0.2]), np.array([2, 3, 5, 1])
    best = max(a * 0.3 + b * 0.45 + c * 0.9 for a in range(6) for b in range(4) for c in range(3) if 2 * a + 3 * b + 5 * c <= 11)
    value, counts = packing.knapsack(prices, sizes, 11)
    assert abs(value - best) < 1e-9 and counts @ sizes <= 11 and abs(counts @ prices - best) < 1e-9


def test_packing_whole(spark):
    docs = documents(spark, [*AWKWARD, *("word " * n for n in range(1, 400, 7))])
    docs = docs.unionByName(docs.filter(F.col("doc_id") == 5))
    rows = packing.pack_documents(docs, WORDS).collect()
    encoder = packing.word_ids(WORDS)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == list(np.cumsum([0, *(p[1] for p in parts[:-1])])) and sum(p[1] for p in parts) <= 2048
    for i, text in {r["doc_id"]: r["text"] for r in docs.collect()}.items():
        ids = encoder.encode(text or "") + b"\x01\x00\x00\x00"
        copies = 2 if i == 5 else 1
        assert sum(p["length"] for p in pieces[i]) == copies * len(ids) // 4
        for p in pieces[i]:
            assert p["doc_tokens"] == len(ids) // 4
            assert p["ids_crc32"] == zlib.crc32(ids[4 * p["start"] : 4 * (p["start"] + p["length"])])
    assert sum(r["length"] for r in rows) / 2048 / len(sequences) > 0.9


def test_packing_nothing(spark):
    assert packing.pack_documents(documents(spark, []), WORDS).count() == 0


def plain_shard(key, weights):
    def score(s):
        draw = (int(hashlib.md5(f"{key}:{s}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        return -np.log(draw) / weights[s]

    return min((s for s in range(len(weights)) if weights[s] > 0), key=lambda s: (score(s), s))


def test_sharding(spark):
    docs = spark.createDataFrame([(i if i % 50 else None, "é" * (i % 5) if i % 7 else None, "clash") for i in range(600)], "doc_id long, text string, slot string")
    docs = docs.unionByName(docs.limit(20))
    weights, grown = [1.0, 2.0, 0.0, 1.0], [1.0, 2.0, 0.0, 1.0, 1.5]
    rows = sharding.shard_table(docs, weights, grown).collect()
    assert len(rows) == 620
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        key = "null" if r["doc_id"] is None else r["doc_id"]
        assert r["shard"] == plain_shard(key, weights) and r["grown_shard"] == plain_shard(key, grown)
        assert r["grown_shard"] in (r["shard"], 4)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and 2 not in slots
    sizes = {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows}
    assert (1, 2 + 8, zlib.crc32("é".encode())) in sizes
    assert sharding.shard_table(docs.limit(0), weights, grown).count() == 0


@pytest.mark.parametrize("text", ["word, and word. word\nword! 2² ½; x", "a.\x1cb ,\0 c", " \0, x", "a_, b.\r\n c.\u2028d:\n\ne\n", "\nan end.\n", "a" * 3000, "ab" * 1500 + " " * 700, "=-" * 2000 + "é日" * 300])
def test_byte_bpe_cuts_and_long_pieces(bpe, text):
    assert np.frombuffer(bpe[0].encode(text), dtype="<u4").tolist() == bpe[1].encode_ordinary(text)


def test_byte_bpe_words_are_known_without_closing_signs(bpe):
    """Each form of a word with its sign or its next line was walked and remembered on its own: 1011 CPU seconds a GB."""
    codec = byte_bpe.ByteBpe(bpe[0].ranks, P.PATTERN)
    codec.encode("a quizzle, quizzle. quizzle\nquizzle; quizzle")
    assert set(codec.spaced) == {"quizzle", "\0,", "\0.", "\0;"}


def test_byte_bpe_without_a_byte(bpe):
    codec = byte_bpe.ByteBpe({b"a": 0, b"b": 1, b"ab": 2}, P.PATTERN)
    assert codec.walk(b"aabb") == [0, 2, 1]
    for piece in (b"ac", b"ca", b"abca"):
        with pytest.raises(ValueError):
            codec.walk(piece)


def test_byte_bpe_rows_go_back_in_parts():
    import pyarrow as pa

    parts = list(byte_bpe._parts(iter([pa.array(["x"] * (byte_bpe.ROWS + 1)), pa.array([], pa.string())])))
    assert [len(p) for p in parts] == [byte_bpe.ROWS, 1, 0]
