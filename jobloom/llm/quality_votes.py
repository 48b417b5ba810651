"""Weak supervision for text quality.

Rules look at one document and vote good (1), bad (-1) or abstain (0).  How often each rule is right about good and about bad
documents is not assumed but estimated: expectation-maximisation over the histogram of vote patterns, which has at most
3 ** rules rows for any corpus.  A document is kept if the posterior probability of being good is at least KEEP and the base
rules do not reject it.

Null text: no words, so it is rejected by the base rules.  Ties: a posterior equal to KEEP keeps.  With an empty table the
model keeps its starting values.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Least posterior probability of a good document.
KEEP = 0.5
SYMBOLS = "#*$%&|<>"
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+").findall
_ENDS = [mark + gap for mark in ".!?" for gap in " \n"]
_MARKS = frozenset(b"#*$%&|<>=+^~_/\\@{}[]")
_GAPS = " \t\n\v\f\r"
_INTEGERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_letters", "n_ends", "n_marked")
SIGNALS = T.StructType([T.StructField(name, T.LongType()) for name in _INTEGERS])


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which occurs at least twice."""
    if len(words) < 4:
        return 0
    ids = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    windows = ids[:-2] * np.uint64(0x9E3779B97F4A7C15) + (ids[1:-1] ^ np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xD6E8FEB86659FD93) + (ids[2:] + np.uint64(0x165667B19E3779F9)) * np.uint64(0xFF51AFD7ED558CCD)
    order = np.sort(windows)
    again = order[1:][order[1:] == order[:-1]]
    if not len(again):
        return 0
    hit = np.isin(windows, again)
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : len(words) - 2 + shift] |= hit
    return int(covered.sum())


def signals(text: str) -> tuple[int, ...]:
    words = text.encode().split()
    lines = text.split("\n")
    seen: set[str] = set()
    repeats = filled = 0
    for line in lines:
        if line.strip(_GAPS):
            filled += 1
            repeats += line in seen
            seen.add(line)
    spaces = sum(map(text.count, _GAPS))
    upper = sum(map(len, _UPPER(text)))
    letters = len(text) - spaces - sum(map(text.count, "0123456789.,!?|%$&#*<>"))
    ends = sum(map(text.count, _ENDS)) + text.endswith((".", "!", "?"))
    marked = sum(1 for w in words if w[-1] in _MARKS)
    return len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), repeats, repeated_words(words), filled, len(set(words)), upper, letters, ends, marked


@F.arrow_udf(SIGNALS)
def _signals(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        table = np.array([signals(v.as_py() or "") for v in batch], dtype=np.int64).reshape(len(batch), len(_INTEGERS))
        yield pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(_INTEGERS))], list(_INTEGERS))


def signals_column(text: Column) -> Column:
    return _signals.asNondeterministic()(text)


def _rule(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def rules(s: Column) -> dict[str, Column]:
    """The votes of every rule on a struct of signals; divisions are written as products."""
    words, chars = s["n_words"], s["word_chars"]
    some = words > 0
    return {
        "length": _rule(words < 50, words >= 100),
        "word_length": _rule(some & ((chars < 3 * words) | (chars > 10 * words)), some & (chars >= 4 * words) & (chars <= 7 * words)),
        "symbols": _rule(10 * s["n_symbols"] > words, some & (50 * s["n_symbols"] < words)),
        "lines": _rule(10 * s["n_dup_lines"] > 3 * s["n_lines"], (s["n_lines"] >= 3) & (s["n_dup_lines"] == 0)),
        "repeats": _rule(2 * s["n_repeat_words"] > words, some & (5 * s["n_repeat_words"] < words)),
        "variety": _rule((words >= 50) & (5 * s["n_distinct"] < words), (words >= 20) & (5 * s["n_distinct"] > 2 * words)),
        "capitals": _rule(2 * s["n_upper"] > s["n_letters"], (s["n_letters"] > 0) & (20 * s["n_upper"] < 3 * s["n_letters"])),
        "letters": _rule(some & (10 * s["n_letters"] < 8 * chars), some & (10 * s["n_letters"] > 9 * chars)),
        "marks": _rule(10 * s["n_marked"] > words, some & (50 * s["n_marked"] < words)),
        "sentences": _rule(some & (2 * s["n_ends"] > words), (s["n_ends"] > 0) & (10 * s["n_ends"] < 3 * words)),
    }


def votes(s: Column) -> Column:
    """The votes of all rules as an array."""
    return F.array(*rules(s).values())


N_RULES = 10


class VoteModel:
    """Share of good documents, and for each rule how often it votes good, given that it votes, on good and on bad ones."""

    #: Votes worth of prior belief, so that a rule that never voted keeps its starting value.
    PRIOR = 20.0

    def __init__(self):
        self.share = 0.8
        self.good = np.full(N_RULES, 0.95)
        self.bad = np.full(N_RULES, 0.5)

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        up, down = pattern == 1, pattern == -1
        score = np.log(self.share / (1 - self.share))
        score = score + up @ np.log(self.good / self.bad) + down @ np.log((1 - self.good) / (1 - self.bad))
        return 1 / (1 + np.exp(-score))

    def fit(self, histogram: Mapping[tuple[int, ...], int], rounds: int = 200) -> VoteModel:
        """Expectation-maximisation.  A rule may be useless but not misleading: it says bad of a good document in at most a
        twentieth of its votes, and of a bad one at least as often as of a good one."""
        if not histogram:
            return self
        patterns = sorted(histogram)
        pattern, weight = np.array(patterns), np.array([float(histogram[p]) for p in patterns])
        up, voted = (pattern == 1).astype(float), (pattern != 0).astype(float)
        for _ in range(rounds):
            before = np.concatenate([[self.share], self.good, self.bad])
            good = self.posterior(pattern)
            for name, part, start in (("good", weight * good, 0.95), ("bad", weight * (1 - good), 0.5)):
                setattr(self, name, (part @ up + self.PRIOR * start) / (part @ voted + self.PRIOR))
            self.share = float(np.clip((weight @ good) / weight.sum(), 0.02, 0.98))
            self.good = np.clip(self.good, 0.95, 0.9999)
            self.bad = np.clip(self.bad, 0.0001, self.good)
            if np.abs(np.concatenate([[self.share], self.good, self.bad]) - before).max() < 1e-9:
                break
        return self

    def posterior_column(self, votes: Column) -> Column:
        """The same probability as an expression over the array of votes."""
        gains = F.array(*[F.struct(F.lit(float(u)).alias("up"), F.lit(float(d)).alias("down")) for u, d in zip(np.log(self.good / self.bad), np.log((1 - self.good) / (1 - self.bad)), strict=True)])
        each = F.zip_with(votes, gains, lambda v, g: F.when(v == 1, g["up"]).when(v == -1, g["down"]).otherwise(F.lit(0.0)))
        score = F.aggregate(each, F.lit(float(np.log(self.share / (1 - self.share)))), lambda total, gain: total + gain)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def fit(patterns: DataFrame, column: str = "votes") -> VoteModel:
    """Estimate from a table with a column of votes; at most 3 ** N_RULES counts reach the driver."""
    counts = patterns.groupBy(column).agg(F.count(F.lit(1)).alias("n")).collect()
    return VoteModel().fit({tuple(r[column]): r["n"] for r in counts})


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
