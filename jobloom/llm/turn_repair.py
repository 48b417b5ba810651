"""Conversation structure repair by Knuth's lightest-derivation agenda.

A repair reads the turns of a conversation in order and gives roles that fit ``(s?(ua)+)?`` (system, user, assistant).  Items say
"the first i turns are repaired and the roles given so far end in state q"; the deductions keep (0), re-role (1) or delete (2) the
next turn, or insert an empty one (5), each appending its letter to the audit.  The weight of an item is (cost, audit), and a deduction
never makes it smaller: the cost does not fall, and an audit is smaller than what extends it.  Two derivations of one item at equal
cost never extend each other, as the audit fixes the cost, so appending keeps their order.  Under such superior functions an item that
is popped from the agenda is final, and the search ends when the goal item is popped.

Long conversations are cut into runs of ``RUN`` turns, so that none is gathered: each run derives, from every state it can start in,
its lightest repairs to every state it can end in, and a second agenda per conversation appends whole runs.  What both ways agree on is
set aside, so that this second agenda holds little besides the audit itself.  The digest of the repaired conversation is
sequential by nature; its turns are streamed in order, never held.

Defined results.  Null texts and roles count as one space, in the damage key null identifiers too; null conversation ids form a
conversation of their own.  Turns go by turn (nulls first), then role, then digest of role and text, so that repeated rows
are adjacent and all but the first are duplicates.  Texts of any length are read whole.  Only the four columns are read, so other
columns' names cannot clash.  An empty table gives an empty result; a conversation without turns has zeros, an empty audit and the
digest of the empty text.
"""

from __future__ import annotations

import hashlib
import heapq
import os.path
from collections.abc import Callable, Hashable, Iterable, Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import number_in_order, stage_table, stream_groups

#: Turns of a run that one agenda repairs.
RUN = 512
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States by the roles given so far: none, only system, last user, last assistant.  A repair may end in none or assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: What a role leads to.
NEXT = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
#: (state, other): the other state can take any way on that the state can, for at most this much more.
SLACK = {(START, ASSISTANT): 2, (SYSTEM, ASSISTANT): 0, (SYSTEM, START): 0, (USER, ASSISTANT): 5, (ASSISTANT, USER): 5, (START, USER): 7}
SPACE = " \t\n\x0b\x0c\r"

Weight = tuple[int, str]


def agenda(axioms: Iterable[tuple[Weight, Hashable]], deduce: Callable[[Hashable], Iterable[tuple[int, str, Hashable]]], is_goal: Callable[[Hashable], bool], goals: int) -> dict:
    """Weights of the first ``goals`` goal items that are popped, lightest first; fewer if there are no more."""
    waiting = [(weight, item) for weight, item in axioms]
    heapq.heapify(waiting)
    final, found = set(), {}
    while waiting and len(found) < goals:
        weight, item = heapq.heappop(waiting)
        if item in final:
            continue
        final.add(item)
        if is_goal(item):
            found[item] = weight
        cost, audit = weight
        for more, letters, reached in deduce(item):
            if reached not in final:
                heapq.heappush(waiting, ((cost + more, audit + letters), reached))
    return found


def turn_deductions(turns: str) -> Callable[[tuple[int, int]], Iterator[tuple[int, str, tuple[int, int]]]]:
    """Deductions over items (turns repaired, state).  A turn is its role's initial (o: another), upper case if truncated, x if it must go."""

    def deduce(item: tuple[int, int]) -> Iterator[tuple[int, str, tuple[int, int]]]:
        at, state = item
        for role in "ua":
            if state in NEXT[role]:
                yield INSERT, "I", (at, NEXT[role][state])
        if at == len(turns):
            return
        turn = turns[at]
        yield DELETE, "D", (at + 1, state)
        if turn == "x":
            return
        extra, role = (TRUNCATED if turn.isupper() else 0), turn.lower()
        if state in NEXT.get(role, ()):
            yield KEEP + extra, "K", (at + 1, NEXT[role][state])
        for other in "ua":
            if state in NEXT[other]:
                yield REROLE + extra, "R", (at + 1, NEXT[other][state])

    return deduce


@lru_cache(maxsize=50_000)
def _short_repair(turns: str) -> Weight:
    return _repair(turns)


def _repair(turns: str) -> Weight:
    goal = agenda([((0, ""), (0, START))], turn_deductions(turns), lambda item: item[0] == len(turns) and item[1] in ENDS, 1)
    return next(iter(goal.values()))


def repair(turns: str) -> Weight:
    """(cost, audit) of the lightest repair of a whole conversation."""
    return _short_repair(turns) if len(turns) <= 32 else _repair(turns)


def run_repairs(turns: str, first: bool) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, audit): the lightest repair of a run between any two states; the first run starts in ``START``."""
    deduce, out = turn_deductions(turns), []
    for begin in (START,) if first else range(4):
        found = agenda([((0, ""), (0, begin))], deduce, lambda item: item[0] == len(turns), 4)
        out += [(begin, state, *weight) for (_, state), weight in found.items()]
    return out


def append_runs(runs: Iterable[list[tuple[int, int, int, str]]]) -> Weight:
    """(cost, audit) of the lightest way through the repairs of consecutive runs."""
    settled: list[str] = []
    live: dict[int, Weight] = {START: (0, "")}
    for ways in runs:
        axioms = [(weight, (0, state)) for state, weight in live.items()]

        def deduce(item: tuple[int, int]) -> Iterator[tuple[int, str, tuple[int, int]]]:
            if item[0] == 0:
                for begin, state, cost, audit in ways:
                    if begin == item[1]:
                        yield cost, audit, (1, state)

        found = {state: weight for (_, state), weight in agenda(axioms, deduce, lambda item: item[0] == 1, 4).items()}
        live = {s: w for s, w in found.items() if not any(a == s and b in found and w[0] > found[b][0] + more for (a, b), more in SLACK.items())}
        common = os.path.commonprefix([audit for _, audit in live.values()])
        settled.append(common)
        live = {state: (cost, audit[len(common) :]) for state, (cost, audit) in live.items()}
    cost, audit = min(live[state] for state in ENDS if state in live)
    return cost, "".join(settled) + audit


def _or_space(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: each row as the damage leaves it; a dropped row stays as a mark of its conversation."""
    key = F.concat(_or_space(F.col("conv_id")), F.lit(":"), _or_space(F.col("turn")))
    text, role, kind = _or_space(F.col("text")), _or_space(F.col("role")), F.col("kind")
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _digest() -> Column:
    """Tells (role, text) apart."""
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_WAYS = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("state", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]))


def _long(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def _is_illegal(before: str | None, now: str) -> bool:
    return before is not None and before + now not in ("su", "ua", "au")


def _run_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One row per run: counts, ends, distinct turn values, and the repairs."""
    seen: set[bytes] = set()
    counts = dict.fromkeys(_COUNTS, 0)
    codes, initials, values = [], [], []
    conv = run = whole = None
    for conv, run, seq, is_whole, turn, digest, initial, last, gone in rows:
        if seq < 0:  # known from an earlier run
            seen.add(digest)
            continue
        whole = is_whole
        if gone:
            continue
        code = initial
        if not last:
            counts["blank"] += 1
            code = "x"
        elif digest in seen:
            counts["duplicate"] += 1
            code = "x"
        elif last not in ".!?":
            counts["truncated"] += 1
            code = initial.upper()
        seen.add(digest)
        counts["illegal"] += _is_illegal(initials[-1] if initials else None, initial)
        codes.append(code)
        initials = [initials[0] if initials else initial, initial]
        if turn is not None and (not values or values[-1] != turn):
            values = [values[0] if values else turn, (values[1] if values else 0) + 1, turn]
    turns = "".join(codes)
    ways = [(START, ASSISTANT, *repair(turns))] if whole else run_repairs(turns, run == 0)
    ways = [dict(zip(("begin", "state", "cost", "audit"), way)) for way in ways]
    yield conv, run, *counts.values(), *(initials or (None, None)), *(values or (None, 0, None)), ways


def _conversation_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    counts = [0] * len(_COUNTS)
    conv = low = high = initial = None
    distinct = 0

    def ways() -> Iterator[list[tuple[int, int, int, str]]]:
        nonlocal conv, low, high, distinct, initial
        for conv, _, *found, first, last, lowest, values, highest, made in rows:
            for i, n in enumerate(found):
                counts[i] += n
            if first is not None:
                counts[-1] += _is_illegal(initial, first)
                initial = last
            if values:
                distinct += values - (high == lowest)
                low, high = lowest if low is None else low, highest
            yield [(w["begin"], w["state"], w["cost"], w["audit"]) for w in made]

    cost, audit = append_runs(ways())
    yield conv, 0 if low is None else high - low + 1 - distinct, *counts, cost, audit


def _repaired_digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The result row comes first, then the turns in order; the repaired lines are hashed as they pass."""
    conv, _, _, _, _, result, _, _ = next(rows)
    hashed, state, lines = hashlib.sha256(), START, 0

    def line(role: str, text: str) -> None:
        nonlocal lines
        hashed.update((("\n" if lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        lines += 1

    for edit in result["audit"]:
        if edit == "D":
            next(rows)
            continue
        given = "a" if state == USER else "u"
        if edit == "I":
            line({"u": "user", "a": "assistant"}[given], "")
        else:
            _, _, _, _, _, _, role, text = next(rows)
            if edit == "K":
                given = role[0]
                line(role, text)
            else:
                line({"u": "user", "a": "assistant"}[given], text)
        state = NEXT[given][state]
    yield conv, *[result[c] for c in ("gaps", *_COUNTS, "cost", "audit")], hashed.hexdigest()


def repair_conversations(turns: DataFrame) -> DataFrame:
    """Damage the rows of ``turns`` (conv_id, turn, role, text), then repair every conversation.

    Per conversation: gaps, faults (blank, duplicate, truncated), illegal neighbours, cost and audit of the lightest repair, digest of
    the repaired conversation.
    """
    kinds = turns.schema
    rows = damaged(turns)
    initial, last = F.left("role", F.lit(1)), F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        _digest().alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        last.alias("last"),
        "gone",
        F.monotonically_increasing_id().alias("row"),
    )
    narrow = number_in_order(stage_table(narrow, "turns"), "conv_id", ["turn", "role", "digest", "row"], "seq", "size")
    narrow = narrow.select("conv_id", F.expr(f"seq div {RUN}").alias("run"), "seq", (F.col("size") <= RUN).alias("whole"), "turn", "digest", "initial", "last", "gone")
    narrow = stage_table(narrow, "numbered-turns")

    # only conversations of several runs need to know what earlier runs held
    held = narrow.filter(~F.col("whole") & ~F.col("gone")).select("conv_id", "run", "digest").distinct()
    firsts = held.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min("run").alias("first"), F.count(F.lit(1)).alias("runs")).filter("runs > 1")
    later = held.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")) & (F.col("run") > F.col("first")))
    later = later.select("conv_id", "run", F.lit(-1).cast("long").alias("seq"), "digest")

    conv = kinds["conv_id"]
    turn = kinds["turn"].dataType
    made = T.StructType(
        [conv, *_long("run", *_COUNTS), T.StructField("first", T.StringType()), T.StructField("last", T.StringType())]
        + [T.StructField("lowest", turn), *_long("distinct"), T.StructField("highest", turn), T.StructField("ways", _WAYS)]
    )
    runs = stream_groups(narrow.unionByName(later, allowMissingColumns=True), ["conv_id", "run"], ["seq"], _run_rows, made)
    digests = [*_long("gaps", *_COUNTS, "cost"), T.StructField("audit", T.StringType())]
    results = stream_groups(runs, ["conv_id"], ["run"], _conversation_rows, T.StructType([conv, *digests]))

    result = F.struct(*[f.name for f in digests]).alias("result")
    texts = rows.filter(~F.col("gone")).select("conv_id", F.lit(1).alias("after"), "turn", F.col("role").alias("by"), _digest().alias("digest"), "role", "text")
    both = texts.unionByName(results.select("conv_id", F.lit(0).alias("after"), result), allowMissingColumns=True)
    both = both.select("conv_id", "after", "turn", "by", "digest", "result", "role", "text")
    out = T.StructType([conv, *digests, T.StructField("repaired_sha256", T.StringType())])
    return stream_groups(both, ["conv_id"], ["after", "turn", "by", "digest"], _repaired_digests, out)
