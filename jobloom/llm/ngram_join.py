"""Exact Jaccard join on sets of word n-grams, with signature trees.

A signature is a bitmap in which each member of a set sets one bit.  A signature tree holds, in every node, the OR of the bitmaps
below, the range of set sizes and the largest number of members that share bits.  Two trees (or one with itself) are traversed
together: a pair of nodes is dropped as soon as the members that could be common, counted on the AND of the two bitmaps, are too
few for the sizes, or when everything below is already known to be connected.

How sets get into the same tree:

* Equal sets are one class, found by a digest; only classes take part from here on.
* Members are ordered by (frequent or not, hash).  Two sets that link share one of their first ``n - ceil(t n) + 1`` members in
  any common order (prefix principle); frequent members, counted over all documents, come last, so that passages shared by
  unrelated documents hardly ever bring them together.
* First pass: classes go to the tree of their very first member, in chunks of at most CHUNK; the roots of what a chunk has
  connected go on to the next level until a group fits into one chunk.  Every link found is checked on the whole sets.  This
  connects groups of copies of any size in linear work.
* Second pass, complete: classes go to the trees of all their first members where these hold more than one known component,
  split by size bands and, above CHUNK, by pairs of chunks.  Signatures travel, texts do not, and a task gives a spanning forest of the
  pairs that signatures allow, so at most one row less than it has sets.  What these forests connect is a cluster; every link that is
  still unknown lies inside one.  The texts of each cluster meet once (a large cluster in pairs of chunks), are hashed there, and a
  second tree over the whole sets gives a spanning forest of the true links.  No pair ever leaves a task.

Links within one component that is known already add nothing to components and are not looked for.

Nulls and ties: a null, empty or blank text has an empty set and links with nothing; its component is its own id.  A null id takes
part in no link and keeps a null component.  Rows with the same id count as one document: their links are shared.  An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import stage_table
from jobloom.llm.components import components

#: Sets that one tree of the first pass holds, and that one chunk of the second pass holds.
CHUNK, PASS_CHUNK = 512, 2048
#: Bytes of hashes that one chunk of a cluster holds, and bits of a signature over whole sets at most.
CHUNK_BYTES, WIDEST = 32 << 20, 1 << 16
#: Ids (8 bytes each) up to which a selection of texts is broadcast instead of moving the texts.
BROADCAST_IDS = 400_000
#: Rows that are handed to one call of a task's function, over many small trees.
BUCKET_ROWS = 4096
#: A member is frequent from this count on; of these the most frequent FREQUENT_LIMIT are put last (a bound on what is
#: broadcast: 8 bytes each).  Any choice gives the same links.
FREQUENT = 48
FREQUENT_LIMIT = 250_000
#: Members are counted if their hash lies in this lowest share of all hashes; the first members of a set mostly do.
COUNTED_SHARE = 8

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    x = (x ^ (x >> np.uint64(29))) * _ODD[4]
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text; fewer words than ``width`` count as one n-gram."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    ids = pd.util.hash_array(np.array(words, dtype=object), categorize=False).astype(np.uint64)
    size = min(width, len(words))
    total = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total = _mix(total * _ODD[0] + ids[i : len(ids) - size + 1 + i] + _ODD[1])
    return np.unique(total)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def bitmaps(sets: list[np.ndarray], width: int) -> np.ndarray:
    """One row of packed bits per set; bit = hash modulo ``width`` (a power of two)."""
    out = np.zeros((len(sets), width // 64), dtype=np.uint64)
    for row, members in zip(out, sets, strict=True):
        bit = (members >> np.uint64(20)) & np.uint64(width - 1)
        np.bitwise_or.at(row, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out


def width_for(n: int) -> int:
    """Bits for sets of n members: a power of two, at least n."""
    return max(64, 1 << max(0, n - 1).bit_length())


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps narrowed to ``words`` words: the halves are OR-combined, which is the modulus of half the width."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


class SignatureTree:
    """Levels from single sets (level 0, in order of size) up to one root; a node has up to FAN children."""

    FAN = 8

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, percent: int):
        self.percent = percent
        self.order = np.argsort(sizes, kind="stable")
        n, b = sizes[self.order].astype(np.int64), bits[self.order]
        slack = n - np.bitwise_count(b).sum(axis=1, dtype=np.int64)
        self.levels = [(b, n, n, slack)]
        while len(self.levels[-1][1]) > 1:
            b, low, high, slack = self.levels[-1]
            cuts = np.arange(0, len(low), self.FAN)
            self.levels.append((np.bitwise_or.reduceat(b, cuts, axis=0), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts), np.maximum.reduceat(slack, cuts)))

    def span(self, level: int, node: int) -> tuple[int, int]:
        """The sets below a node."""
        width = self.FAN**level
        return node * width, min((node + 1) * width, len(self.order))

    def possible(self, level: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For arrays of nodes of one level: may sets below link?"""
        b, low, high, slack = self.levels[level]
        common = np.bitwise_count(b[left] & b[right]).sum(axis=1, dtype=np.int64)
        most = np.minimum(np.minimum(common + slack[left], common + slack[right]), np.minimum(high[left], high[right]))
        p = self.percent
        return ((100 + p) * most >= p * (low[left] + low[right])) & (100 * most >= p * np.maximum(low[left], low[right]))

    def below(self, level: int, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of children of two nodes that may hold linked sets."""
        size = len(self.levels[level - 1][1])
        left = np.arange(i * self.FAN, min((i + 1) * self.FAN, size))
        right = np.arange(j * self.FAN, min((j + 1) * self.FAN, size))
        left, right = np.repeat(left, len(right)), np.tile(right, len(left))
        if i == j:
            keep = left < right if level == 1 else left <= right
            left, right = left[keep], right[keep]
        keep = self.possible(level - 1, left, right)
        return left[keep], right[keep]

    def blocks(self, settled) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of sets that may link, leaf by leaf; ``settled(span, span)`` drops pairs of nodes."""
        work = [(len(self.levels) - 1, 0, 0)]
        while work:
            level, i, j = work.pop()
            if level and not settled(self.span(level, i), self.span(level, j)):
                left, right = self.below(level, i, j)
                if level == 1:
                    yield left, right
                else:
                    work += [(level - 1, x, y) for x, y in zip(left.tolist(), right.tolist(), strict=True)]

    def pairs(self, settled) -> Iterator[tuple[int, int]]:
        """The same one by one, for callers that settle more pairs on the way."""
        top = len(self.levels) - 1
        work = [(top, 0, 0)]
        while work:
            level, i, j = work.pop()
            (a, b), (c, d) = self.span(level, i), self.span(level, j)
            if settled((a, b), (c, d)):
                continue
            if level == 0:
                yield i, j
                continue
            left, right = self.below(level, i, j)
            # equal nodes last on the list, so first in work: what is close is connected before the rest is looked at
            found = sorted(zip(left.tolist(), right.tolist(), strict=True), key=lambda x: x[0] - x[1])
            work += [(level - 1, x, y) for x, y in found]


def links(sizes: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """A spanning forest of the links among whole sets (positions), and the forest's component of each set."""
    label = np.arange(len(sets))
    if len(sets) < 2:
        return [], label
    tree = SignatureTree(sizes, bitmaps(sets, width_for(int(sizes.max()))), percent)
    place = tree.order
    at = label.copy()  # by place in the tree

    def settled(left: tuple[int, int], right: tuple[int, int]) -> bool:
        one = at[left[0]]
        if left[1] - left[0] == 1 and left == right:
            return True
        return bool((at[left[0] : left[1]] == one).all() and (at[right[0] : right[1]] == one).all())

    found = []
    for i, j in tree.pairs(settled):
        x, y = sets[place[i]], sets[place[j]]
        if linked(x, y, percent):
            found.append((int(place[i]), int(place[j])))
            at[at == at[j]] = at[i]
    label[place] = at
    return found, label


def _sets_udf(width: int, percent: int, frequent):
    """Struct of size, digest, low members (to be counted) or first members (once the frequent ones are known)."""
    kind = T.StructType([T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("members", T.ArrayType(T.LongType()))])
    arrow = pa.struct([("n", pa.int64()), ("digest", pa.binary()), ("members", pa.list_(pa.int64()))])
    low = np.uint64(2**64 // COUNTED_SHARE)

    @F.arrow_udf(kind)
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        last = None if frequent is None else frequent.value
        for batch in batches:
            rows = []
            for value in batch:
                hashes = shingle_hashes(value.as_py() or "", width)
                if last is None:
                    rows.append((len(hashes), None, hashes[: np.searchsorted(hashes, low)].view(np.int64)))
                    continue
                first = prefix_length(len(hashes), percent) if len(hashes) else 0
                often = np.zeros(len(hashes), dtype=bool)
                if len(last):
                    spot = np.minimum(np.searchsorted(last, hashes), len(last) - 1)
                    often = last[spot] == hashes
                members = np.concatenate([hashes[~often], hashes[often]])[:first]
                rows.append((len(hashes), hashlib.md5(hashes.tobytes()).digest(), members.view(np.int64)))
            sizes = pa.array([r[0] for r in rows], pa.int64())
            digests = pa.array([r[1] for r in rows], pa.binary())
            offsets = np.cumsum([0, *(len(r[2]) for r in rows)]).astype(np.int32)
            flat = np.concatenate([r[2] for r in rows]) if rows else np.empty(0, dtype=np.int64)
            yield pa.StructArray.from_arrays([sizes, digests, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))], fields=list(arrow))

    return sets.asNondeterministic()


def _bits_udf(width: int):
    @F.arrow_udf(T.BinaryType())
    def bits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sets = (shingle_hashes(v.as_py() or "", width) for v in batch)
            yield pa.array((bitmaps([s], width_for(len(s)))[0].tobytes() for s in sets), pa.binary(), size=len(batch))

    return bits.asNondeterministic()


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Do two sets of sorted hashes link?"""
    if len(x) > len(y):
        x, y = y, x
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def forest(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """(smallest, other) edges that connect what the pairs connect."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [(top(x), x) for x in list(up) if top(x) != x]


def cluster_links(known: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (positions) that connect what is not connected yet: a spanning forest over the known components.

    ``side`` tells chunks apart; where there are two, only pairs of different chunks are looked at.
    """
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    width = min(WIDEST, 4 * width_for(int(sizes.max())))
    tree = SignatureTree(sizes, bitmaps(sets, width), percent)
    place, two = tree.order, bool((side != side[0]).any())
    at, far = np.unique(known, return_inverse=True)[1][place], side[place]

    def settled(left: tuple[int, int], right: tuple[int, int]) -> bool:
        (a, b), (c, d) = left, right
        if two and (far[a:b] == far[a]).all() and (far[c:d] == far[a]).all():
            return True
        return bool((at[a:b] == at[a]).all() and (at[c:d] == at[a]).all())

    found = []
    for i, j in tree.blocks(settled):
        open_ = at[i] != at[j]
        if two:
            open_ &= far[i] != far[j]
        for x, y in zip(i[open_].tolist(), j[open_].tolist(), strict=True):
            if at[x] != at[y] and linked(sets[place[x]], sets[place[y]], percent):
                found.append((int(place[x]), int(place[y])))
                at[at == at[y]] = at[x]
    return found


def _groups(table: pa.Table, key: list[str]) -> Iterator[pa.Table]:
    """The groups of a bucket, one after another."""
    table = table.sort_by([(c, "ascending") for c in key])
    columns = [table[c].to_numpy() for c in key]
    new = np.zeros(max(0, table.num_rows - 1), dtype=bool)
    for column in columns:
        new |= column[1:] != column[:-1]
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), table.num_rows]
    for start, end in zip(cuts, cuts[1:], strict=False):
        if end - start > 1:
            yield table.slice(start, end - start)


def _chunk_links(width: int, percent: int):
    """For the chunks of a bucket: links as (a, b), and every component's root as (root, null)."""

    def run(table: pa.Table) -> pa.Table:
        route, a, b = [], [], []
        for group in _groups(table, ["route", "chunk"]):
            ids, sets = group["rep"].to_numpy(), [shingle_hashes(t, width) for t in group["text"].to_pylist()]
            found, label = links(np.array([len(s) for s in sets]), sets, percent)
            roots = ids[np.unique(label, return_index=True)[1]].tolist()
            a += [int(ids[i]) for i, _ in found] + roots
            b += [int(ids[j]) for _, j in found] + [None] * len(roots)
            route += [group["route"][0].as_py()] * (len(found) + len(roots))
        return pa.table({"route": pa.array(route, pa.int64()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _cluster_run(width: int, percent: int):
    """For the chunk pairs of a bucket: links between different known components."""

    def run(table: pa.Table) -> pa.Table:
        a, b = [], []
        for group in _groups(table, ["cluster", "i", "j"]):
            ids, known, side = (group[c].to_numpy() for c in ("rep", "known", "own"))
            i, j = group["i"][0].as_py(), group["j"][0].as_py()
            if (known == known[0]).all() or (i != j and (side == side[0]).all()):
                continue
            sets = [shingle_hashes(t, width) for t in group["text"].to_pylist()]
            for x, y in cluster_links(known, side, sets, percent):
                a.append(int(ids[x]))
                b.append(int(ids[y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _leaf_pairs(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of positions in groups of one size that start at ``first``."""
    i, j = np.triu_indices(size, 1)
    return (first[:, None] + i).ravel(), (first[:, None] + j).ravel()


def _candidates(percent: int):
    """For the trees of a bucket: a spanning forest of the pairs of sets of different components that may link.

    Groups that fit into one leaf are compared leaf by leaf, all leaves of the bucket at once; larger ones get their tree.
    """

    def grown(known: np.ndarray, n: np.ndarray, guest: np.ndarray, bits: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        words = min(len(b) for b in bits)
        tree = SignatureTree(n, np.stack([folded(b, words) for b in bits]), percent)
        at, far = known[tree.order], guest[tree.order]

        def settled(left: tuple[int, int], right: tuple[int, int]) -> bool:
            a, b, c, d = *left, *right
            if far[a:b].all() and far[c:d].all():
                return True  # they meet as hosts in their own band
            return bool((at[a:b] == at[a]).all() and (at[c:d] == at[a]).all())

        for i, j in tree.blocks(settled):
            keep = (at[i] != at[j]) & ~(far[i] & far[j])
            yield tree.order[i[keep]], tree.order[j[keep]]

    def leaves(i: np.ndarray, j: np.ndarray, n: np.ndarray, bits: list[np.ndarray]) -> np.ndarray:
        """Of pairs of rows, those whose signatures allow a link."""
        words = np.array([len(b) for b in bits])
        width = np.minimum(words[i], words[j])
        keep = np.zeros(len(i), dtype=bool)
        for w in np.unique(width):
            some = np.flatnonzero(width == w)
            rows, back = np.unique(np.concatenate([i[some], j[some]]), return_inverse=True)
            table = np.stack([folded(bits[r], w) for r in rows])
            slack = n[rows] - np.bitwise_count(table).sum(axis=1, dtype=np.int64)
            x, y = back[: len(some)], back[len(some) :]
            common = np.bitwise_count(table[x] & table[y]).sum(axis=1, dtype=np.int64)
            keep[some] = (100 + percent) * (common + np.minimum(slack[x], slack[y])) >= percent * (n[i[some]] + n[j[some]])
        return keep

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table[c].to_numpy() for c in ("member", "band", "i", "j", "lead", "rep", "known", "n")}
        order = np.lexsort((columns["j"], columns["i"], columns["band"], columns["member"]))
        member, band, ti, tj, lead, ids, known, n = (columns[c][order] for c in columns)
        guest = table["guest"].to_numpy().astype(bool)[order]
        packed = table["bits"].to_pylist()
        bits = [np.frombuffer(packed[k], dtype=np.uint64) for k in order]
        new = (member[1:] != member[:-1]) | (band[1:] != band[:-1]) | (ti[1:] != ti[:-1]) | (tj[1:] != tj[:-1])
        start = np.concatenate([[0], np.flatnonzero(new) + 1])
        size = np.diff(np.append(start, len(ids)))
        left, right = [], []
        for k in range(2, SignatureTree.FAN + 1):
            x, y = _leaf_pairs(start[size == k], k)
            left.append(x)
            right.append(y)
        i, j = np.concatenate(left), np.concatenate(right)
        keep = (known[i] != known[j]) & ~(guest[i] & guest[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        i, j = i[keep], j[keep]
        keep = leaves(i, j, n, bits)
        found = set(zip(np.minimum(ids[i], ids[j])[keep].tolist(), np.maximum(ids[i], ids[j])[keep].tolist(), strict=True))
        wide = np.flatnonzero(size > SignatureTree.FAN)
        seen: dict[tuple[int, int], list[set[int]]] = {}
        for g in wide[np.argsort(-size[wide], kind="stable")]:
            a = start[g]
            part = slice(a, a + size[g])
            if (known[part] == known[a]).all() or guest[part].all():
                continue
            sets, larger = set(ids[part].tolist()), seen.setdefault((int(lead[a]), int(band[a])), [])
            if any(sets <= other for other in larger):
                continue  # a tree that holds all of them has been traversed
            larger.append(sets)
            for x, y in grown(known[part], n[part], guest[part], bits[part]):
                x, y = ids[a + x], ids[a + y]
                found.update(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), strict=True))
        edges = forest(iter(found))
        return pa.table({"a": pa.array([x for x, _ in edges], pa.int64()), "b": pa.array([y for _, y in edges], pa.int64())})

    return run


def bucket(key: list[str], rows: int, per_bucket: int = BUCKET_ROWS) -> Column:
    """Many groups share a bucket, so that a task call handles about ``per_bucket`` rows; a group stays whole."""
    return F.pmod(F.xxhash64(*key), F.lit(max(1, -(-rows // per_bucket))))


def chunk_tasks(own: Column, chunks: Column) -> Column:
    """The pairs of chunks (i <= j) that a row of chunk ``own`` takes part in."""
    return F.transform(F.sequence(F.lit(0), chunks - 1), lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")))


def frequent_members(docs: DataFrame, text: Column, width: int, percent: int):
    """Broadcast array of the most frequent members among those with a low hash; at most FREQUENT_LIMIT."""
    spark = docs.sparkSession
    counted = docs.select(F.explode(_sets_udf(width, percent, None)(text)["members"]).alias("member"))
    often = counted.groupBy("member").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= FREQUENT)
    top = often.orderBy(F.desc("n"), "member").limit(FREQUENT_LIMIT)
    values = np.array([r["member"] for r in top.select("member").collect()], dtype=np.int64).view(np.uint64)
    return spark.sparkContext.broadcast(np.sort(values))


def with_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of some ``rep``.  Up to BROADCAST_IDS ids are broadcast, so that texts stay where they are; beyond, both move."""
    ids = ids.select("rep").distinct()
    return rows.join(F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids, "rep", "left_semi")


def in_chunks(level: DataFrame) -> DataFrame:
    """Routes that hold more than one class, cut into chunks: route, rep, chunk, _n."""
    counts = level.groupBy("route").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    chunk = F.pmod(F.xxhash64("rep"), F.ceil(F.col("_n") / CHUNK).cast("long"))
    return stage_table(level.join(counts, "route").select("route", "rep", chunk.alias("chunk"), "_n"), "chunks")


def chunk_pass(routes: DataFrame, active: DataFrame, width: int, percent: int) -> DataFrame:
    """Links found in the trees of first members, level after level."""
    run, found, level = _chunk_links(width, percent), [], routes
    while True:
        dealt = in_chunks(level)
        whole = dealt.join(with_ids(active, dealt), "rep").select("route", "chunk", "rep", "text")
        whole = whole.withColumn("_bucket", bucket(["route", "chunk"], dealt.count()))
        out = stage_table(whole.groupBy("_bucket").applyInArrow(run, "route long, a long, b long"), "chunk-links")
        found.append(out.filter(F.col("b").isNotNull()).select("a", "b"))
        wide = dealt.filter(F.col("_n") > CHUNK)
        roots = out.filter(F.col("b").isNull()).join(wide.select("route").distinct(), "route", "left_semi")
        level = stage_table(roots.select("route", F.col("a").alias("rep")).distinct(), "roots")
        before, after = wide.count(), level.count()
        if not after or after > before / 2:
            break  # nothing is left, or hardly anything was connected and the second pass finds the rest
    edges = found[0]
    for f in found[1:]:
        edges = edges.unionByName(f)
    return edges


def complete_pass(postings: DataFrame, active: DataFrame, known: DataFrame, width: int, percent: int) -> DataFrame:
    """All links between different known components: (a, b)."""
    postings = postings.join(known, postings["rep"] == known["node"], "left").select("rep", F.coalesce("component", "rep").alias("known"), "n", "member")
    mixed = postings.groupBy("member").agg(F.min("known").alias("_low"), F.max("known").alias("_high")).filter(F.col("_low") != F.col("_high")).select("member")
    postings = postings.join(mixed, "member", "left_semi")
    # a band is a little wider than the largest ratio of linked sizes, so a linked pair is at most one band apart
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent) * (1 + 1e-9))).cast("int")
    hosts = F.array(*[F.struct((band - k).alias("band"), F.lit(k > 0).alias("guest")) for k in range(2)])
    placed = postings.select("member", "rep", "known", "n", F.explode(hosts).alias("_p")).select("member", "rep", "known", "n", "_p.band", "_p.guest")
    key = ["member", "band"]
    sizes = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("rep").alias("lead"), F.min("known").alias("_low"), F.max("known").alias("_high"), F.min("guest").alias("_all_guests"))
    sizes = sizes.filter((F.col("_low") != F.col("_high")) & ~F.col("_all_guests"))
    # a power of two, so that groups of nearly the same sets are cut alike
    chunks = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("_n") / PASS_CHUNK))).cast("int")
    sizes = sizes.select(*key, "lead", F.greatest(F.lit(1), chunks).alias("_chunks"))
    placed = placed.join(sizes, key)
    own = F.pmod(F.xxhash64("rep"), F.col("_chunks")).cast("int")
    placed = placed.withColumn("_t", F.explode(chunk_tasks(own, F.col("_chunks"))))
    placed = stage_table(placed.select(*key, "_t.i", "_t.j", "lead", "rep", "known", "n", "guest"), "placed")
    signed = placed.join(active.select("rep", "bits"), "rep").withColumn("_bucket", bucket(["lead", "band", "i", "j"], placed.count()))
    near = signed.groupBy("_bucket").applyInArrow(_candidates(percent), "a long, b long")
    return cluster_pass(components(near), active, known, width, percent)


def cluster_pass(clusters: DataFrame, active: DataFrame, known: DataFrame, width: int, percent: int) -> DataFrame:
    """All links between different known components inside clusters (node, component): (a, b)."""
    near = clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    texts = with_ids(active, near).select("rep", "text").join(near, "rep")
    texts = texts.join(known.select("node", F.col("component").alias("_known")), F.col("rep") == F.col("node"), "left")
    texts = stage_table(texts.select("cluster", "rep", F.coalesce("_known", "rep").alias("known"), "text"), "cluster-texts")
    # a word takes two bytes at least and gives one hash of eight
    hashes = F.sum(F.octet_length("text").cast("long")) * 4
    sizes = texts.groupBy("cluster").agg(F.greatest(F.ceil(F.count(F.lit(1)) / PASS_CHUNK), F.ceil(hashes / CHUNK_BYTES)).cast("int").alias("_chunks"))
    dealt = texts.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("_chunks")).cast("int"))
    dealt = dealt.withColumn("_t", F.explode(chunk_tasks(F.col("own"), F.col("_chunks"))))
    dealt = dealt.select("cluster", "_t.i", "_t.j", "own", "rep", "known", "text")
    dealt = dealt.withColumn("_bucket", bucket(["cluster", "i", "j"], texts.count(), 1024))
    return dealt.groupBy("_bucket").applyInArrow(_cluster_run(width, percent), "a long, b long")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles and component_id (smallest id reachable by links, itself included) for every row of ``docs``."""
    text = F.col(text_col)
    frequent = frequent_members(docs, text, width, percent)
    made = docs.select(F.col(id_col).alias("id"), _sets_udf(width, percent, frequent)(text).alias("s"))
    rows = stage_table(made.select("id", "s.n", "s.digest", "s.members"), "sets")
    # classes of equal sets, named by their smallest id
    classes = rows.filter((F.col("n") > 0) & F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("rep"))
    classes = stage_table(classes, "classes")
    member_of = rows.select("id", "n", "digest").join(classes, "digest", "left").select("id", "n", F.coalesce("rep", "id").alias("rep"))
    member_of = stage_table(member_of, "member-of")
    first = rows.filter(F.col("n") > 0).join(classes.select(F.col("digest").alias("_d"), "rep"), (F.col("digest") == F.col("_d")) & (F.col("id") == F.col("rep")))
    first = first.select("rep", "n", "members")
    repeated = member_of.groupBy(F.col("id").alias("rep")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("rep")
    repeated = stage_table(repeated, "repeated")
    some_repeated = not repeated.isEmpty()
    first = stage_table(first.dropDuplicates() if some_repeated else first, "first-members")
    # classes that share a first member with another; only their texts are looked at again
    posted = first.select("rep", F.explode("members").alias("member"))
    shared = posted.groupBy("member").agg(F.min("rep").alias("_low"), F.max("rep").alias("_high")).filter(F.col("_low") != F.col("_high")).select("member")
    postings = posted.join(shared, "member", "left_semi").join(first.select("rep", "n"), "rep")
    postings = stage_table(postings, "postings")
    partners = stage_table(postings.select("rep").distinct(), "partners")
    routes = first.join(partners, "rep", "left_semi").select("rep", F.element_at("members", 1).alias("route"))
    texts = with_ids(docs.select(F.col(id_col).alias("rep"), text.alias("text")), partners)
    if some_repeated:  # only texts of repeated ids have to meet to be made distinct
        again = with_ids(texts, repeated).withColumn("_same", F.md5(F.col("text").cast("binary"))).dropDuplicates(["rep", "_same"]).drop("_same")
        texts = texts.join(repeated, "rep", "left_anti").unionByName(again)
    active = stage_table(texts.select("rep", "text", _bits_udf(width)(F.col("text")).alias("bits")), "active")
    edges = stage_table(chunk_pass(routes, active, width, percent), "links")
    known = components(edges)
    more = stage_table(complete_pass(postings, active, known, width, percent), "more-links")
    # a repeated id whose rows have different sets joins their classes
    same = member_of.filter(F.col("id") != F.col("rep")).select(F.col("id").alias("a"), F.col("rep").alias("b"))
    twice = same.join(member_of.groupBy("id").agg(F.min("rep").alias("_l"), F.max("rep").alias("_h")).filter(F.col("_l") != F.col("_h")), F.col("a") == F.col("id"), "left_semi")
    final = components(edges.unionByName(more).unionByName(twice))
    out = member_of.join(final, F.col("rep") == F.col("node"), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
