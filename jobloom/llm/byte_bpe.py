"""Byte-level BPE that reproduces the exact merges in linear time, and its inverse.

A piece of text (one match of the splitting pattern) is mapped byte by byte to Latin-1, and an Aho-Corasick automaton over
the vocabulary gives the longest token at every step.  Where that does not fit, the encoder goes on from there: it takes the
next shorter token (its longest prefix that is a token) or backtracks; a step is allowed if the two adjacent tokens are
compatible, i.e. if merging their joined bytes gives exactly these two tokens.  Every merge result is made of compatible
neighbours and only one such sequence exists for a prefix, so a position that failed once never needs another try: the walk
is linear.  Compatibility is memoised.

Texts are cut at single spaces and line feeds and before signs that close a word first, where the pattern always cuts too, and
the ids of these bits are memoised; the memos keep two generations of a fixed number of entries, so memory is bounded for any
vocabulary of words.

Null text: no ids, decoded to the empty string.  Empty and very long texts, repeats and empty tables need no special care.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Entries of each generation of a memo.
MEMO = 100_000
#: Rows that go back to Spark at once, so that the ids of a whole batch are never held.
ROWS = 1000

#: A single space with white space on both sides: there, runs of white space are not cut at the space.
_WIDE_GAP = re.compile(r"\s\x20\s")
#: A sign between a letter or digit and white space or the end: the pattern cuts before it.
_CLOSING = re.compile(r"([!,.:;?])(?<=[^\W_][!,.:;?])(?!\S)")
#: Line feeds beside other white space: runs of white space are not cut at each line feed.
_LOOSE_LINES = re.compile(r"\n(?<=\s\n)|\n\s")


class Memo(dict):
    """Remembers what ``make`` gives.  When it is full, it starts anew and keeps the previous generation for look-up."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class ByteBpe:
    """One vocabulary: ``{bytes: id}`` and the pattern that splits text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.find = regex.compile(pattern).findall
        self.longest_token = max(map(len, ranks))
        self.compatible = Memo(self.fits)
        self.halves: dict[int, tuple[int, int]] = {}
        self.pieces = Memo(lambda piece: packed(self.walk(piece.encode())))
        self.spaced = Memo(self._spaced)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Made when the first text is encoded: workers that only decode never hold it."""
        made = ahocorasick.Automaton()
        for token, i in self.ranks.items():
            made.add_word(token.decode("latin-1"), (len(token), i))
        made.make_automaton()
        return made

    def _spaced(self, word: str) -> bytes:
        """Ids of a word after a single space."""
        if word.isalpha():
            return packed(self.walk(b" " + word.encode()))
        if word[:1] == "\0":
            return b"".join(map(self.pieces.__getitem__, self.find(word[1:])))
        head, *rest = self.find(" " + word)
        stem = head[1:]
        ids = self.spaced[stem] if head[0] == " " and stem and stem != word else packed(self.walk(head.encode()))
        return ids + b"".join(map(self.pieces.__getitem__, rest))

    def last_merge(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes ``token``: its bytes are merged by rank, leftmost first, until two parts are left."""
        known = self.halves.get(token)
        if known is None:
            ranks, data = self.ranks, self.bytes_of[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                found = [(ranks[p + q], i) for i, (p, q) in enumerate(zip(parts, parts[1:], strict=False)) if p + q in ranks]
                if not found:
                    break
                at = min(found)[1]
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self.halves[token] = (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else (-1, -1)
        return known

    @cached_property
    def prefix(self) -> list[int]:
        """For each token the longest token that it begins with, itself left out, or -1."""
        ranks = self.ranks
        return [next((ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in ranks), -1) for t in self.bytes_of]

    def fits(self, pair: int) -> bool:
        """Would merging the joined bytes give these two tokens?  The pair is ``left << 32 | right``.

        The merges that made the two are undone from the latest to the earliest.  They are wrong as soon as the two tokens
        at the border could have merged with each other before the merge that was undone last; at the same rank, the pair
        further left goes first.
        """
        left, right = pair >> 32, pair & 0xFFFFFFFF
        limit, known = 1 << 60, True
        while known:
            joined = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and joined < limit:
                return False
            one_left, one_right = len(self.bytes_of[left]) == 1, len(self.bytes_of[right]) == 1
            if one_left and one_right:
                break
            if one_right or (not one_left and left > right):
                limit, left = left, self.last_merge(left)[1]
            else:
                limit, right = right + 1, self.last_merge(right)[0]
            known = left >= 0 and right >= 0  # a token that merges never make fits nowhere
        return known

    def walk(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        latin, size = data.decode("latin-1"), len(data)
        compatible, prefix, bytes_of = self.compatible, self.prefix, self.bytes_of
        longest_from, reach = self.automaton.iter_long, 4 * self.longest_token
        ids: list[int] = []
        alive = None
        pos = base = last = 0
        # from ``safe`` on, a longest token might reach beyond the window
        safe, window = size, longest_from(latin)
        while True:
            # the longest match is right most of the time
            token = -1
            for end, (length, token) in window:
                if base + end - length + 1 != pos or pos >= safe:
                    token = -1
                    break
                if (alive is not None and not alive[pos + length]) or (pos and not compatible[last << 32 | token]):
                    break
                ids.append(token)
                pos, last = pos + length, token
            else:
                token = -1
            if pos == size:
                return ids
            if pos < safe:
                if alive is None:
                    alive = bytearray(b"\x01") * (size + 1)
                while True:
                    while token >= 0:
                        end = pos + len(bytes_of[token])
                        if alive[end] and (not pos or compatible[last << 32 | token]):
                            break
                        token = prefix[token]
                    if token >= 0:
                        break
                    if not ids:
                        raise ValueError("the vocabulary has no token for some byte")
                    alive[pos] = 0
                    token = ids.pop()
                    pos -= len(bytes_of[token])
                    last = ids[-1] if ids else 0
                    token = prefix[token]
                ids.append(token)
                pos, last = end, token
                if pos == size:
                    return ids
            base, safe = pos, size if size - pos <= reach else pos + reach - self.longest_token
            window = longest_from(latin[pos : pos + reach])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if _WIDE_GAP.search(text) or "\0" in text:
            return b"".join(map(self.pieces.__getitem__, self.find(text)))
        # signs that close a word become words of their own, marked by a zero, so that the word is known without them
        text = _CLOSING.sub(" \0\\1", text)
        if "\n" not in text or _LOOSE_LINES.search(text):
            return self._line(text)
        return self.pieces["\n"].join(map(self._line, text.split("\n")))

    def _line(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        head = [first] if first.isalpha() else self.find(first)
        return b"".join([*map(self.pieces.__getitem__, head), *map(self.spaced.__getitem__, rest)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteBpe:
    """The vocabulary in a file of lines ``base64 rank``, once per Python worker."""
    with open(path, "rb") as lines:
        return ByteBpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)


def _parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for start in range(0, max(1, len(batch)), ROWS):
            yield batch.slice(start, ROWS)


def encode_column(text: Column, path: str, pattern: str) -> Column:
    """Binary column of ids, four bytes each.  ``path`` must be readable on every executor."""

    @F.arrow_udf(T.BinaryType())
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = load(path, pattern)
        for part in _parts(batches):
            yield pa.array((codec.encode(x.as_py() or "") for x in part), pa.binary(), size=len(part))

    return encode.asNondeterministic()(text)  # else the optimizer would run it again for each use


def decode_column(ids: Column, path: str, pattern: str) -> Column:
    """Binary column: the bytes that the ids stand for."""

    @F.arrow_udf(T.BinaryType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = load(path, pattern)
        for part in _parts(batches):
            yield pa.array((codec.decode(x.as_py() or b"") for x in part), pa.binary(), size=len(part))

    return decode(ids)
