"""Merkle manifest of a dataset by time-forward processing.

A node's digest is the SHA-256 of its children's digests as hex text. Nodes are
labelled (last leaf below, level), so a parent's label comes right after its last
child's. Digests are messages to labels: Spark's range and hash exchanges with
their spilling sorts bring the leaves in label order, and a priority queue takes
what a node sends to its parent until the parent's label is reached. It never holds
more than a run of each level. The reversed sweep goes from the top label down and
delivers to every child the proof of its parent, led by the child's own siblings.

A sweep handles pieces of ``FAN ** LEVELS`` neighbouring leaves, each a whole
subtree; the pieces' tops are the leaves of the next round. So rounds grow with
the logarithm of the largest group, a group with a third of all rows is many
pieces, and no task or driver holds more than a piece and one batch of rows.

Leaves ascend by the order column, null first, ties by digest; rows alike in all
fields are interchangeable. A null group is a group, the first. A table without
rows has no manifest. Other columns than the stated fields are not read, so their
names cannot clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratescape.llm.common import stored

FAN = 8
#: Levels of a piece: 4,096 leaves, a few MB of proofs.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<position: int, siblings: string>>"
_ARROW_PROOF = pa.list_(pa.struct([("position", pa.int32()), ("siblings", pa.string())]))
#: Rows of one batch that a sweep hands back, about.
OUT_ROWS = 4096


# ---------------------------------------------------------------- leaves


def digest(fields: dict[str, Column] | tuple[str, ...] = FIELDS) -> Column:
    """SHA-256, in hex, of the fields: each ``-`` if null, else its length in UTF-8 bytes, ``:`` and the value."""
    columns = fields.values() if isinstance(fields, dict) else [F.col(f"`{c}`") for c in fields]
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id", carry: dict[str, Column] | None = None) -> DataFrame:
    """A row per document with its place: _group, _at (place in the group), _digest, _n (leaves of the group), _order and the carried columns.

    Texts are read once; what is stored and sorted has no text. Groups compare as
    UTF-8 bytes.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-"))
    rows = docs.select(named.alias("_group"), F.col(f"`{order}`").alias("_order"), digest(fields).alias("_digest"), *[c.alias(n) for n, c in (carry or {}).items()])
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    return numbered(stored(tied, "merkle-leaves"), ["_order", "_digest", "_tie"]).drop("_tie")


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with _at, the place in their _group by the keys, and _n, the size of the group.

    A global range sort numbers the rows of each range; a group's offset in a
    range is the sum of its counts in the ranges before: one row per group and range.
    """
    by = [F.col(c).asc_nulls_first() for c in ("_group", *keys)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id())
    ranged = stored(ranged, "merkle-sorted").withColumn("_range", F.shiftright("_place", 33))
    counts = ranged.groupBy("_group", "_range").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_group", "_range", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("_n"))
    placed = ranged.join(offsets, ["_group", "_range"])
    return placed.withColumn("_at", F.col("_place") + F.col("_shift")).drop("_place", "_range", "_shift")


# ---------------------------------------------------------------- sweeps in a piece


def height(n: int, levels: int) -> int:
    """Levels above the nodes of a piece, in a group that has ``n`` nodes on the piece's level."""
    up = 0
    while up < levels and n > 1:
        n, up = -(-n // FAN), up + 1
    return up


def sweep_up(digests: list[str], up: int) -> list[list[str]]:
    """Digests of all nodes of a piece, level by level, in the order of labels."""
    last = len(digests) - 1
    made: list[list[str]] = [[] for _ in range(up + 1)]
    queue: list[tuple[int, int, int, str]] = []  # (label of the parent: last leaf and level, place of the child, digest)

    def send(level: int, place: int, value: str) -> None:
        made[level].append(value)
        if level < up:
            end = min((place // FAN + 1) * FAN ** (level + 1) - 1, last)
            heapq.heappush(queue, (end, level + 1, place, value))

    for leaf, value in enumerate(digests):
        send(0, leaf, value)
        while queue and queue[0][0] == leaf:
            _, level, place, first = heapq.heappop(queue)
            run = [first]
            while queue and queue[0][:2] == (leaf, level):
                run.append(heapq.heappop(queue)[3])
            send(level, place // FAN, sha256("".join(run).encode()).hexdigest())
    return made


Steps = list[tuple[int, str]]


def sweep_down(made: list[list[str]], proof: Steps) -> list[Steps]:
    """The proof of every leaf of a piece, from the piece's digests and the proof of its top."""
    up, last = len(made) - 1, len(made[0]) - 1
    out: list[Steps] = [[]] * len(made[0])
    queue: list[tuple[int, int, int, Steps]] = [(-last, -up, 0, proof)]  # labels from the top down
    while queue:
        _, level, place, steps = heapq.heappop(queue)
        level = -level
        if level == 0:
            out[place] = steps
            continue
        first = place * FAN
        run = made[level - 1][first : first + FAN]
        for k in range(len(run)):
            end = min((first + k + 1) * FAN ** (level - 1) - 1, last)
            step = (k, "".join(run[:k] + run[k + 1 :]))
            heapq.heappush(queue, (-end, 1 - level, first + k, [step, *steps]))
    return out


# ---------------------------------------------------------------- sweeps over sorted rows


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one piece after the other, from rows sorted by _group and _piece."""
    held: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        if not batch.num_rows:
            continue
        groups, pieces = batch.column("_group").to_pylist(), batch.column("_piece").to_pylist()
        first = 0
        for i in range(len(groups) + 1):
            if i < len(groups) and (groups[i], pieces[i]) == name:
                continue
            if i > first:
                held.append(batch.slice(first, i - first))
            if i == len(groups):
                break
            if held:
                yield pa.Table.from_batches(held)
            held, name, first = [], (groups[i], pieces[i]), i
    if held:
        yield pa.Table.from_batches(held)


def _packed(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
    """Small tables put together to batches of about OUT_ROWS rows."""
    held: list[pa.Table] = []
    rows = 0
    for table in tables:
        held.append(table)
        rows += table.num_rows
        if rows >= OUT_ROWS:
            yield from pa.concat_tables(held).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def _top(levels: int):
    def run(batches):
        def tops():
            for piece in _pieces(batches):
                n = piece.column("_n")[0].as_py()
                made = sweep_up(piece.column("_digest").to_pylist(), height(n, levels))
                head = piece.slice(0, 1)
                yield pa.table({"_group": head.column("_group"), "_at": head.column("_piece"), "_digest": [made[-1][0]], "_n": pa.array([-(-n // FAN**levels)], pa.int64())})

        yield from _packed(tops())

    return run


def _proof_array(proofs: list[Steps]) -> pa.ListArray:
    offsets = [0]
    for steps in proofs:
        offsets.append(offsets[-1] + len(steps))
    flat = [step for steps in proofs for step in steps]
    inner = pa.StructArray.from_arrays([pa.array([p for p, _ in flat], pa.int32()), pa.array([s for _, s in flat], pa.string())], ["position", "siblings"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), inner)


def _delivered(levels: int, names: list[str]):
    def run(batches):
        def rows():
            for piece in _pieces(batches):
                seed, nodes = piece.slice(0, 1), piece.slice(1)
                n = nodes.column("_n")[0].as_py()
                made = sweep_up(nodes.column("_digest").to_pylist(), height(n, levels))
                steps = [(s["position"], s["siblings"]) for s in seed.column("proof")[0].as_py()]
                proofs = sweep_down(made, steps)
                same = {c: pa.repeat(seed.column(c)[0], nodes.num_rows) for c in ("subroot", "root")}
                kept = {c: nodes.column(c) for c in names}
                yield pa.table({**kept, "proof": _proof_array(proofs), **same})

        yield from _packed(rows())

    return run


# ---------------------------------------------------------------- rounds

NODE = "_group string, _at bigint, _digest string, _n bigint"


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes and, round by round, the tops of their pieces, down to one per group."""
    found = [nodes]
    largest = nodes.agg(F.max("_n")).first()[0] or 1
    size = FAN**levels
    while largest > 1:
        rows = found[-1].select("_group", F.floor(F.col("_at") / size).cast("long").alias("_piece"), "_at", "_digest", "_n")
        swept = rows.repartition("_group", "_piece").sortWithinPartitions("_group", "_piece", "_at").mapInArrow(_top(levels), NODE)
        found.append(stored(swept, "merkle-tops"))
        largest = -(-largest // size)
    return found


def _proofs(nodes: DataFrame, seeds: DataFrame, levels: int) -> DataFrame:
    """The nodes with proof, subroot and root, which the seeds (one per piece: _group, _at) hand down."""
    size = FAN**levels
    names = [c for c in nodes.columns if c != "_n"]
    rows = nodes.select(F.floor(F.col("_at") / size).cast("long").alias("_piece"), F.lit(1).alias("_kind"), *nodes.columns)
    head = seeds.select(F.col("_at").alias("_piece"), F.lit(0).alias("_kind"), "_group", "proof", "subroot", "root")
    both = rows.unionByName(head, allowMissingColumns=True)
    ordered = both.repartition("_group", "_piece").sortWithinPartitions("_group", "_piece", "_kind", "_at")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema if f.name != "_n")
    return ordered.mapInArrow(_delivered(levels, names), f"{kept}, proof {PROOF}, subroot string, root string")


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Leaves, from ``leaves``, with subroot, root and proof.

    A proof is a list of (position, siblings) from the leaf's run up to the root:
    the node's place in its run and the digests of the others, joined left to right.
    """
    trees = _rounds(stored(rows, "merkle-placed"), levels)
    subroots = trees[-1].select(F.lit("").alias("_group"), F.col("_group").alias("_key"), "_digest")
    above = numbered(subroots, ["_key"])
    heads = _rounds(stored(above, "merkle-subroots"), levels)
    top = heads[-1].select("_group", "_at", F.expr(f"cast(array() as {PROOF})").alias("proof"), F.col("_digest").alias("subroot"), F.col("_digest").alias("root"))
    named = reduce(lambda seeds, nodes: stored(_proofs(nodes, seeds, levels), "merkle-proofs"), heads[:-1][::-1] or heads, top)
    seeds = named.select(F.col("_key").alias("_group"), F.lit(0).cast("long").alias("_at"), "proof", F.col("_digest").alias("subroot"), "root")
    for nodes in trees[-2:0:-1]:
        seeds = stored(_proofs(nodes, seeds, levels).select("_group", "_at", "proof", "subroot", "root"), "merkle-seeds")
    return _proofs(trees[0], seeds, levels)


def siblings(proof: str = "proof") -> Column:
    """All sibling digests of a proof, level by level, joined."""
    return F.array_join(F.transform(proof, lambda s: s["siblings"]), "")


def folded(leaf: str, proof: str = "proof") -> Column:
    """The root that a leaf digest gives together with a proof."""
    step = "sha2(concat(substr(s.siblings, 1, 64 * s.position), d, substr(s.siblings, 64 * s.position + 1)), 256)"
    return F.expr(f"aggregate(`{proof}`, `{leaf}`, (d, s) -> {step})")
