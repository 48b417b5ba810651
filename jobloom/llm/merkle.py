"""Merkle manifest of a table: a tree per group, a tree over the groups, and a witness for every row.

Nodes are H, the lowercase hexadecimal sha256 of their children's digests as text; 16 consecutive nodes make one.  Witnesses are
built while nodes are appended: a node is appended to the open run of its level, and what lies below it carries a partial
witness.  When the run's last sibling arrives (or the input ends) every partial witness below the run is extended by the
siblings to its left and right, and the run's digest is appended one level up.

Appends are aligned, so they can be dealt out.  A block of ``BLOCK`` consecutive leaves is a whole subtree; its root is one further
append to the level above, whose blocks are dealt out likewise, up to the root of the group, and then once more over the groups.
Only block roots (one row for 256) go up, only their witnesses come down; a leaf holds a running digest of its siblings and the
digest folded from itself, never the list.  A group with a third of all rows is as many blocks as it needs.

Defined results.  Leaves of a group ascend by key, a null key first; rows of equal key by leaf digest; repeated rows are interchangeable
leaves of their own.  A null group is a group of its own and comes first, the others in the order of their UTF-8 bytes.  Null fields
are hashed as ``-``.  A lone leaf is its group's root, a lone group's root is the root; a witness without siblings has the digest of
the empty text.  Texts of any length are hashed whole, before anything moves.  An empty table gives an empty manifest.  Only the named
columns are read, so names of others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import lower_ascii, number_in_order, stage_table, stream_groups

ARITY = 16
#: Levels of a block, and its leaves.
HEIGHT = 2
BLOCK = ARITY**HEIGHT

_STEPS = T.ArrayType(T.StructType([T.StructField("left", T.BinaryType()), T.StructField("right", T.BinaryType())]))


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """H of the fields, each as its byte count, a colon and its value; ``-`` if null."""
    return F.sha2(F.concat(*map(field, fields)), 256)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Steps:
    """A witness that is kept: the siblings left and right of the path, level by level."""

    def __init__(self, *data) -> None:
        self.data, self.steps = data, []

    def extend(self, left: str, right: str) -> None:
        self.steps.append({"left": bytes.fromhex(left), "right": bytes.fromhex(right)})


class Proof:
    """A witness that is only digested, and what a leaf folds to along it."""

    def __init__(self, folded: str, *data) -> None:
        self.data, self.folded, self.siblings = data, folded, hashlib.sha256()

    def extend(self, left: str, right: str) -> None:
        self.siblings.update((left + right).encode())
        self.folded = _digest(left + self.folded + right)


class OpenSubtrees:
    """Aligned appends: per level the run that is still open, each node with the witnesses below it."""

    def __init__(self) -> None:
        self.runs: list[list[tuple[str, list]]] = [[]]

    def append(self, digest: str, witnesses: list, level: int = 0) -> None:
        if level == len(self.runs):
            self.runs.append([])
        self.runs[level].append((digest, witnesses))
        if len(self.runs[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        whole = "".join([digest for digest, _ in run])
        size = len(run[0][0])
        for i, (_, witnesses) in enumerate(run):
            left, right = whole[: size * i], whole[size * (i + 1) :]
            for witness in witnesses:
                witness.extend(left, right)
        self.append(_digest(whole), [w for _, witnesses in run for w in witnesses], level + 1)

    def close(self, height: int | None) -> str:
        """Complete what is open: up to ``height``, or (None) until one node is left.  Gives that node's digest."""
        level = 0
        while level != height if height is not None else (level + 1 < len(self.runs) or len(self.runs[level]) > 1):
            if self.runs[level]:
                self._complete(level)
            level += 1
        return self.runs[level][0][0]


def _append_block(rows: Iterable[tuple], witness: Callable[..., Steps | Proof] | None) -> tuple[str, list, tuple | None]:
    """(root, witnesses, row from above) of one block; rows are (rank, members, digest, data), the row from above has rank -1."""
    tree, below, above, height = OpenSubtrees(), [], None, None
    for rank, members, digest, data in rows:
        if rank < 0:
            above = data
            continue
        height = None if members <= BLOCK else HEIGHT
        digest = digest.hex()
        made = [witness(rank, digest, data)] if witness else []
        below += made
        tree.append(digest, made)
    return tree.close(height), below, above


def _roots(entries: DataFrame, group: T.StructField) -> DataFrame:
    """One entry per block: its root, at the block's place, of so many members of the group."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        first = next(rows)
        members = -(-first[3] // BLOCK)

        def all_rows():
            yield first[2:] + (None,)
            for row in rows:
                yield row[2:] + (None,)

        yield first[0], first[1], members, bytes.fromhex(_append_block(all_rows(), None)[0])

    cut = entries.select("g", F.expr(f"rank div {BLOCK}").alias("block"), "rank", "members", "digest")
    schema = T.StructType([group, T.StructField("rank", T.LongType()), T.StructField("members", T.LongType()), T.StructField("digest", T.BinaryType())])
    return stream_groups(cut, ["g", "block"], ["rank"], run, schema)


def _levels(entries: DataFrame) -> list[DataFrame]:
    """The entries, their blocks' roots, the roots of blocks of those, up to one entry per group."""
    group, largest = entries.schema["g"], entries.agg(F.max("members")).first()[0] or 0
    levels = [entries]
    while largest > 1:
        levels.append(stage_table(_roots(levels[-1].select("g", "rank", "members", "digest"), group), "block-roots"))
        largest = -(-largest // BLOCK)
    return levels


#: Siblings from a node on upwards, and the root of its group.
_ABOVE = T.StructType([T.StructField("steps", _STEPS), T.StructField("top", T.BinaryType())])
_PLACED = [T.StructField("rank", T.LongType()), T.StructField("above", _ABOVE)]


def _with_above(entries: DataFrame, above: DataFrame) -> DataFrame:
    """g, block, rank, members, digest, above, data: the rows of each block, the witness of the block itself first (rank -1)."""
    data = entries.columns[-1] if "data" in entries.columns else F.lit(None).cast("string").alias("data")
    rows = entries.select("g", F.expr(f"rank div {BLOCK}").alias("block"), "rank", "members", "digest", F.lit(None).cast(_ABOVE).alias("above"), data)
    blocks = above.select("g", F.col("rank").alias("block"), F.lit(-1).cast("long").alias("rank"), "above")
    return rows.unionByName(blocks, allowMissingColumns=True)


def _along(entries: DataFrame, above: DataFrame, witness: Callable, finish: Callable[..., tuple], schema: T.StructType) -> DataFrame:
    """Append each block again, now with witnesses: ``finish(group, witness, above)`` gives a row per entry."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        group = None

        def fed() -> Iterator[tuple]:
            nonlocal group
            for group, _, rank, members, digest, rest, data in rows:
                yield rank, members, digest, rest if rank < 0 else data

        _, below, rest = _append_block(fed(), witness)
        for made in below:
            yield finish(group, made, rest)

    return stream_groups(_with_above(entries, above), ["g", "block"], ["rank"], run, schema)


def _descend(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """(g, rank, above) of the blocks of the lowest level, from those of the groups' whole trees."""

    def finish(group, witness: Steps, rest: dict) -> tuple:
        return group, witness.data[0], {"steps": witness.steps + rest["steps"], "top": rest["top"]}

    for entries in reversed(levels[1:-1]):
        above = _along(entries, above, Steps, finish, T.StructType([entries.schema["g"], *_PLACED]))
    return above


def manifest(docs: DataFrame, fields: Sequence[str], group: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, group, place and members (of the group's tree), leaf, subroot, proof_sha256, folded_root, tampered, root, verified.

    ``folded_root`` is folded from the leaf as it is found now (where the checksum of the key is divisible by five, the text's A-Z
    are lower-cased) along the siblings of the manifest; ``verified`` says whether that is the root.
    """
    hit = F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0
    found = leaf_digest([lower_ascii(F.col(c)) if c == text else F.col(c) for c in fields])
    leaves = docs.select(
        F.col(group).alias("g"),
        F.col(key).alias("key"),
        F.unhex(leaf_digest([F.col(c) for c in fields])).alias("digest"),
        F.when(hit, F.unhex(found)).alias("found"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = number_in_order(stage_table(leaves, "leaves"), "g", ["key", "digest", "row"], "rank", "members")
    leaves = stage_table(leaves.select("g", "rank", "members", "digest", F.struct("key", "found", "members").alias("data")), "numbered-leaves")
    levels = _levels(leaves)

    trees = levels[-1].select(F.lit(0).alias("all"), F.col("g").alias("group"), "digest")
    trees = number_in_order(stage_table(trees, "subroots"), "all", ["group"], "rank", "members")
    trees = stage_table(trees.select(F.col("all").alias("g"), "rank", "members", "digest", F.struct("group").alias("data")), "numbered-subroots")
    forest = _levels(trees)
    root = forest[-1].select(F.lower(F.hex("digest"))).first()

    def tree(_, witness: Steps, rest: dict) -> tuple:
        _, digest, data = witness.data
        return data["group"], 0, {"steps": witness.steps + rest["steps"], "top": bytes.fromhex(digest)}

    start = F.struct(F.array().cast(_STEPS).alias("steps"), F.col("digest").alias("top")).alias("above")
    above = _along(trees, _descend(forest, forest[-1].select("g", "rank", start)), Steps, tree, T.StructType([leaves.schema["g"], *_PLACED]))

    def proof(rank: int, digest: str, data: dict) -> Proof:
        return Proof(digest if data["found"] is None else data["found"].hex(), rank, digest, data)

    def finish(group, witness: Proof, rest: dict) -> tuple:
        for step in rest["steps"]:
            witness.extend(step["left"].hex(), step["right"].hex())
        rank, digest, data = witness.data
        return data["key"], group, rank, data["members"], digest, rest["top"].hex(), witness.siblings.hexdigest(), witness.folded, data["found"] is not None

    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), T.StructField(group, docs.schema[group].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("place", "members")]
        + [T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "proof_sha256", "folded_root")]
        + [T.StructField("tampered", T.BooleanType())]
    )
    rows = _along(leaves, _descend(levels, above), proof, finish, schema)
    return rows.withColumn("root", F.lit(root[0] if root else None).cast("string")).withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(fields: Sequence[str]) -> str:
    """DuckDB SQL for ``manifest`` over ``documents``: levels and folds by recursion, the checksum bit by bit."""

    def digest(changed: bool) -> str:
        lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        parts = [f"cast({lower if changed and c == 'text' else c} as varchar)" for c in fields]
        return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"

    step = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda d: cast(ord(d) as bigint))), lambda c, b: {step}), 4294967295)"
    whole = "sha256(string_agg(d, '' order by i))"

    def tree(name: str, leaves: str) -> str:
        return f"""{name} as (
  select g, 0 as l, i, n, d from {leaves}
  union all
  select g, l + 1, i // {ARITY}, (n + {ARITY - 1}) // {ARITY}, {whole} from {name} where n > 1 group by g, l, i // {ARITY}, n
)"""

    def siblings(tree: str, at: str, side: str) -> str:
        return f"coalesce((select string_agg(x.d, '' order by x.i) from {tree} x where x.g = w.g and x.l = w.l and x.i // {ARITY} = w.i // {ARITY} and x.i {side} w.i), '')"

    def walk(name: str, tree: str, start: str) -> str:
        left, right = siblings(tree, "w", "<"), siblings(tree, "w", ">")
        return f"""{name} as (
  {start}
  union all
  select k, g, l + 1, i // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(a || f || b), p || a || b
  from (select w.*, {left} as a, {right} as b from {name} w where w.n > 1)
)"""

    return f"""
with recursive leaves as (
  select row_number() over (order by source nulls first, doc_id nulls first) as k, doc_id, source, dense_rank() over (order by source nulls first) - 1 as g,
         row_number() over (partition by source order by doc_id nulls first) - 1 as i, count(*) over (partition by source) as n,
         {digest(False)} as d, case when {crc} % 5 = 0 then {digest(True)} end as t
  from documents
), {tree("low", "leaves")}, subroots as (select g as i, d from low where n = 1),
forest as (select 0 as g, i, (select count(*) from subroots) as n, d from subroots), {tree("high", "forest")},
{walk("up", "low", "select k, g, cast(0 as bigint) as l, i, n, coalesce(t, d) as f, '' as p from leaves")},
{walk("top", "high", "select k, 0 as g, cast(0 as bigint) as l, g as i, (select count(*) from subroots) as n, f, p from up where n = 1")},
found as (select k, f, p from top where n = 1), whole as (select d as root from high where n = 1)
select leaves.doc_id, leaves.d as leaf, subroots.d as subroot, root, sha256(p) as proof_sha256, f as folded_root, f = root as verified
from leaves join subroots on subroots.i = leaves.g join found using (k) cross join whole"""
