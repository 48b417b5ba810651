"""URL filters by a bit-parallel wildcard automaton (Shift-And with self-loops, many words wide).

Every rule is a glob over a canonical URL, ``"." + host + path``: the host is what follows the first ``://`` up to ``/``, ``?``,
``#`` or the end, with A-Z lower-cased; the path follows up to ``?``, ``#`` or the end.  All globs lie side by side in one bit
vector: one start bit and one bit per symbol.  Reading a character is ``D = ((D << 1) & B[c]) | (D & L[c])`` for all globs at once,
where ``B`` says which symbols take the character and ``L`` where a star stays.  A batch of URLs is read in step, the longest
first, so that URLs that ended drop out; memory is bounded by ``STATE_BYTES`` however many globs or URLs there are.

Globs: ``*`` is a run without ``/``, ``**`` any run, ``?`` one character but ``/``, ``[a-z]`` and ``[!a-z]`` one character of (not of) a
set, a backslash takes the next character as it is.  A host rule (host, path) is the glob ``*.host path **`` with literal parts: it
fits the host and all subdomains if the path starts with its path, and as a star never crosses ``/`` it fits nothing else.

Defined results.  A null URL or one without ``://`` has an empty host and path; host rules do not fit it, globs are asked about ``"."``.
Of several host rules that fit, the one with the longest text wins (then the longer host, then block).  Without one, an allow glob
beats a block glob, and ``default`` holds where none fits.  URLs of any length are read to their end; repeated rows are judged
alike; an empty table gives an empty result.  Only the URL column is read, so other columns' names cannot clash, except with the five
that are added.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import lower_ascii

#: Bytes of automaton state that are advanced together.
STATE_BYTES = 4 << 20
_LAST = 0x10FFFF
_SLASH = ord("/")


@dataclass(frozen=True)
class HostRule:
    """``verdict`` for a host with its subdomains and the paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


class Glob:
    """Symbols (each a list of code-point ranges) and, after each number of symbols, what a star there takes."""

    def __init__(self) -> None:
        self.symbols: list[list[tuple[int, int]]] = []
        self.stars: dict[int, list[tuple[int, int]]] = {}

    def star(self, any_character: bool) -> Glob:
        known = self.stars.get(len(self.symbols))
        if known is None or any_character:
            self.stars[len(self.symbols)] = [(0, _LAST)] if any_character else _without([(_SLASH, _SLASH)])
        return self

    def one(self, ranges: list[tuple[int, int]]) -> Glob:
        self.symbols.append(ranges)
        return self

    def literal(self, text: str) -> Glob:
        for c in text:
            self.one([(ord(c), ord(c))])
        return self


def _without(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    left, out = 0, []
    for low, high in sorted(ranges):
        if low > left:
            out.append((left, low - 1))
        left = max(left, high + 1)
    return out + ([(left, _LAST)] if left <= _LAST else [])


def parse_glob(text: str) -> Glob:
    glob, i = Glob(), 0
    while i < len(text):
        c = text[i]
        if c == "*":
            run = len(text) - i - len(text[i:].lstrip("*"))
            glob.star(run > 1)
            i += run
        elif c == "?":
            glob.one(_without([(_SLASH, _SLASH)]))
            i += 1
        elif c == "[":
            found = re.match(r"\[(!?)(\]?[^\]]*)\]", text[i:], re.S)
            if not found or not found[2]:
                raise ValueError(f"{text!r}: a set is not closed or empty")
            ranges = [(ord(a[0]), ord(a[-1])) for a in re.findall(r".-.|.", found[2], re.S)]
            glob.one(_without(ranges) if found[1] else ranges)
            i += len(found[0])
        else:
            if c == "\\":
                i += 1
                if i == len(text):
                    raise ValueError(f"{text!r} ends in a backslash")
            glob.literal(text[i])
            i += 1
    return glob


def host_glob(rule: HostRule) -> Glob:
    return Glob().star(False).literal("." + rule.host + rule.path).star(True)


class Automaton:
    """Masks of many globs.  Characters that no glob tells apart share a class, so the masks are classes x words."""

    def __init__(self, globs: Sequence[Glob]) -> None:
        ranges = [r for g in globs for part in (*g.symbols, *g.stars.values()) for r in part]
        self.bounds = np.array(sorted({0} | {low for low, _ in ranges} | {high + 1 for _, high in ranges}), dtype=np.uint32)
        places = np.cumsum([0] + [len(g.symbols) + 1 for g in globs])
        classes, self.words = len(self.bounds), max(1, -(-int(places[-1]) // 64))
        self.take = np.zeros((classes, self.words), dtype=np.uint64)
        self.stay = np.zeros((classes, self.words), dtype=np.uint64)
        self.start = np.zeros(self.words, dtype=np.uint64)
        bounds = self.bounds.tolist()

        def mark(mask: np.ndarray, ranges: list[tuple[int, int]], bit: int) -> None:
            for low, high in ranges:
                mask[bisect_left(bounds, low) : bisect_left(bounds, high + 1), bit // 64] |= np.uint64(1 << bit % 64)

        for g, at in zip(globs, places.tolist()):
            self.start[at // 64] |= np.uint64(1 << at % 64)
            for i, symbol in enumerate(g.symbols):
                mark(self.take, symbol, at + i + 1)
            for i, star in g.stars.items():
                mark(self.stay, star, at + i)
        ends = places[1:] - 1
        self.end_word, self.end_bit = ends // 64, (ends % 64).astype(np.uint64)

    def accepted(self, texts: Sequence[str]) -> np.ndarray:
        """Boolean texts x globs."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        points = np.frombuffer("".join([texts[i] for i in order]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kinds = np.searchsorted(self.bounds, points, side="right") - 1
        sizes = sizes[order]
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(texts) else sizes
        state = np.tile(self.start, (len(texts), 1))
        one, carry = np.uint64(1), np.uint64(63)
        alive = len(texts)
        for t in range(int(sizes[0]) if len(texts) else 0):
            while sizes[alive - 1] <= t:
                alive -= 1
            seen = kinds[first[:alive] + t]
            now = state[:alive]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> carry
            state[:alive] = (moved & self.take[seen]) | (now & self.stay[seen])
        ended = (state[:, self.end_word] >> self.end_bit) & one
        out = np.empty(ended.shape, dtype=bool)
        out[order] = ended.astype(bool)
        return out

    def hits(self, texts: Sequence[str]) -> pa.ListArray:
        """Per text the numbers of the globs that accept it, ascending."""
        step = max(1, STATE_BYTES // (8 * self.words))
        counts, found = [np.zeros(1, dtype=np.int64)], []
        for i in range(0, len(texts), step):
            ok = self.accepted(texts[i : i + step])
            counts.append(ok.sum(axis=1))
            found.append(np.nonzero(ok)[1])
        offsets = np.cumsum(np.concatenate(counts)).astype(np.int32)
        values = np.concatenate(found).astype(np.int32) if found else np.zeros(0, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def hits_column(subject: Column, globs: Sequence[Glob]) -> Column:
    """Array of the numbers of all globs that accept the subject; a null subject counts as empty."""
    automaton = Automaton(globs)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(texts: pa.Array) -> pa.Array:
        return automaton.hits([t or "" for t in texts.to_pylist()])

    return run(subject)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)


def ranked(rules: Sequence[HostRule]) -> list[HostRule]:
    """The first that fits wins."""
    return sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != "block"))


def judge(pages: DataFrame, rules: Sequence[HostRule], allow: Sequence[str] = (), block: Sequence[str] = (), default: str = "allow", url: str = "url") -> DataFrame:
    """Add host, path, rule (text of the host rule that decides, else null), globs (texts of the globs that fit) and verdict."""
    rules = ranked(rules)
    globs = [*allow, *block]
    host, path = host_and_path(F.col(url))
    out = pages.withColumn("host", host).withColumn("path", path)
    subject = F.concat(F.lit("."), F.col("host"), F.col("path"))
    out = out.withColumn("_hits", hits_column(subject, [*map(host_glob, rules), *map(parse_glob, globs)]))
    n, between = len(rules), len(rules) + len(allow)
    won = F.array_min(F.filter("_hits", lambda h: h < n))

    def pick(texts: Sequence[str], at: Column) -> Column:
        return F.get(F.array(*[F.lit(t) for t in texts]), at) if texts else F.lit(None).cast("string")

    fits = F.filter("_hits", lambda h: h >= n)
    by_glob = F.when(F.exists(fits, lambda h: h < between), "allow").when(F.size(fits) > 0, "block").otherwise(default)
    out = out.withColumn("rule", pick([r.text for r in rules], won))
    out = out.withColumn("globs", F.transform(fits, lambda h: pick(globs, h - n)))
    return out.withColumn("verdict", F.coalesce(pick([r.verdict for r in rules], won), by_glob)).drop("_hits")


def _glob_pattern(text: str) -> str:
    """The glob as a regular expression, for the SQL twin."""
    out, i = "", 0
    while i < len(text):
        if text[i] == "*":
            run = len(text) - i - len(text[i:].lstrip("*"))
            out, i = out + (".*" if run > 1 else "[^/]*"), i + run
        else:
            out, i = out + ("[^/]" if text[i] == "?" else re.escape(text[i]).replace("\\-", "-")), i + 1
    return f"(?s)^{out}$"


def oracle(rules: Sequence[HostRule], allow: Sequence[str], block: Sequence[str]) -> str:
    """DuckDB SQL for ``judge`` over ``pages`` (globs of literals, ``*``, ``**`` and ``?``)."""
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    fits = [(r, f"(host = {quote(r.host)} or ends_with(host, {quote('.' + r.host)})) and starts_with(path, {quote(r.path)})") for r in ranked(rules)]
    rule = " ".join(f"when {when} then {quote(r.text)}" for r, when in fits)
    own = " ".join(f"when {when} then {quote(r.verdict)}" for r, when in fits)
    hit = lambda globs: " or ".join(f"regexp_matches(subject, {quote(_glob_pattern(g))})" for g in globs) or "false"
    return f"""
with r as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), h as (
  select page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) as path
  from r
), s as (select *, '.' || host || path as subject from h)
select page_id, host, path, case {rule} end as rule,
       case {own} when {hit(allow)} then 'allow' when {hit(block)} then 'block' else 'allow' end as verdict
from s"""
