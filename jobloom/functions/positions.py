"""All positions of many phrases in one pass: the only Python that runs inside tasks.

Spark has no expression that returns every match offset, so one Arrow-batched function walks each text once with a
multi-pattern automaton.  It returns offsets only; every decision based on them stays a native expression.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from jobloom.functions.text import needs_boundary

HITS = T.ArrayType(
    T.StructType(
        [
            T.StructField("phrase", T.IntegerType(), False),
            T.StructField("start", T.IntegerType(), False),
            T.StructField("end", T.IntegerType(), False),
            # per context group: start of its last phrase in the reach before this one, -1 if none
            T.StructField("before", T.ArrayType(T.IntegerType(), False), False),
        ]
    )
)

#: Vocabulary size accepted as a task-side constant; it is reference data, not something that grows with the tables.
MAX_PHRASES = 20_000

_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def phrase_positions(
    text: Column,
    phrases: Sequence[str],
    whole_words: Sequence[bool] | None = None,
    contexts: Sequence[Sequence[str]] = (),
    reach: int = 0,
) -> Column:
    """``array<struct<phrase, start, end, before>>``: non-overlapping occurrences per phrase, ordered by end.

    ``phrases`` must be folded like the text.  Whole-word phrases follow the alias rules (``sql`` after a slash does
    not count).  ``contexts`` are groups of plain substrings; ``before`` tells where the last one of each group starts
    within ``reach`` characters before the occurrence.  NULL text gives NULL.
    """
    if len(phrases) > MAX_PHRASES:
        raise ValueError(f"{len(phrases)} phrases exceed the vocabulary bound of {MAX_PHRASES}")
    bounded = list(whole_words) if whole_words is not None else [needs_boundary(p) for p in phrases]
    vocabulary = [(i, p, b) for i, (p, b) in enumerate(zip(phrases, bounded)) if p]
    groups = [list(g) for g in contexts]

    # plain numbers side by side: an object per hit takes over ten times the memory, and a batch of long texts has millions of hits
    @F.arrow_udf(HITS)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick

        by_text: dict[str, tuple[list, list]] = {}
        for i, phrase, whole in vocabulary:
            by_text.setdefault(phrase, ([], []))[0].append((i, whole))
        for g, words in enumerate(groups):
            for word in words:
                by_text.setdefault(word, ([], []))[1].append(g)
        automaton = ahocorasick.Automaton()
        for phrase, owners in by_text.items():
            automaton.add_word(phrase, (len(phrase), phrase == "sql", *owners))
        if by_text:
            automaton.make_automaton()

        def collect(value, numbers, starts, ends, before):
            """Append the hits of a text, and per hit the start of the nearest phrase of each group."""
            if not by_text:
                return
            first, last_end, size = len(numbers), {}, len(value)
            seen = [(array("i"), array("i")) for _ in groups]  # ends (ascending) and starts
            for last, (length, is_sql, owners, members) in automaton.iter(value):
                start, end = last - length + 1, last + 1
                for g in members:
                    seen[g][0].append(end)
                    seen[g][1].append(start)
                if not owners:
                    continue
                left = value[start - 1] if start else " "
                clear = left not in _WORD and not (is_sql and left == "/")
                clear = clear and (end == size or value[end] not in _WORD)
                for i, whole in owners:
                    if (clear or not whole) and start >= last_end.get(i, 0):
                        last_end[i] = end
                        numbers.append(i)
                        starts.append(start)
                        ends.append(end)
            for at in range(first, len(starts)):
                for g in range(len(groups)):
                    before.append(nearest(*seen[g], starts[at]))

        def nearest(ends, starts, position):
            at, best = bisect_right(ends, position) - 1, -1
            while at >= 0 and ends[at] > position - reach:
                if starts[at] >= position - reach:
                    best = max(best, starts[at])
                at -= 1
            return best

        fields = [pa.field(f.name, t, False) for f, t in zip(HITS.elementType.fields, (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.field("element", pa.int32(), False))))]
        for batch in batches:
            numbers, starts, ends, before, offsets = array("i"), array("i"), array("i"), array("i"), array("i", [0])
            for value in batch:
                if value.is_valid:
                    collect(value.as_py(), numbers, starts, ends, before)
                offsets.append(len(numbers))
            plain = lambda values: pa.Array.from_buffers(pa.int32(), len(values), [None, pa.py_buffer(values)])
            each = array("i", range(0, len(numbers) * len(groups) + 1, len(groups))) if groups else array("i", bytes(4 * len(numbers) + 4))
            lists = pa.ListArray.from_arrays(plain(each), plain(before), type=fields[3].type)
            hits = pa.StructArray.from_arrays([plain(numbers), plain(starts), plain(ends), lists], fields=fields)
            yield pa.ListArray.from_arrays(plain(offsets), hits, mask=batch.is_null() if batch.null_count else None)

    # not repeatable as far as the optimizer is concerned: it must run once per row, not once per use
    return find.asNondeterministic()(text)


def phrases_present(text: Column, phrases: Sequence[str]) -> Column:
    """``array<int>``: numbers of the phrases that a text holds by the alias rules, ascending; NULL for NULL text."""
    if len(phrases) > MAX_PHRASES:
        raise ValueError(f"{len(phrases)} phrases exceed the vocabulary bound of {MAX_PHRASES}")
    vocabulary = [(p, i, needs_boundary(p)) for i, p in enumerate(phrases) if p]

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for phrase, i, whole in vocabulary:
            automaton.add_word(phrase, (i, len(phrase) if whole else 0, phrase == "sql"))
        if vocabulary:
            automaton.make_automaton()

        def present(value):
            if value is None or not vocabulary:
                return None if value is None else []
            found, size = set(), len(value)
            for last, (i, length, is_sql) in automaton.iter(value):
                if i in found:
                    continue
                if length:  # a whole word
                    left = value[last - length] if last >= length else " "
                    if left in _WORD or (is_sql and left == "/") or (last + 1 < size and value[last + 1] in _WORD):
                        continue
                found.add(i)
            return sorted(found)

        for batch in batches:
            yield pd.Series([present(v) for v in batch], dtype=object)

    return find.asNondeterministic()(text)
