"""N-gram Jaccard join by size-banded tiles with hashed bitmap signatures.

Two documents link when ``100 * shared >= percent * all`` of their distinct
word shingles. The join is exact:

1. Documents with equal shingle sets are one: their smallest id stands for all.
2. A linked set shares at least ``percent`` of its own shingles, so a document
   with more shingles that nobody else has is out. They are counted over a fixed
   hash range of the shingles, packed per task: keys go to key ranges, where
   lone ones send their document back.
3. The sets of the others are stored in blocks. Each block asks how many blocks'
   sets have its shingles, and orders every set from rare to frequent. Linked
   sets share one of the first ``size - ceil(percent * size) + 1``; only these
   are compared. Blocks link their own documents first, so a very frequent
   shingle arrives once per block.
4. Candidate classes (components over shared rare shingles) come together in
   tiles of at most about ``TILE`` sets. For each pair of a tile, the bits that one
   bitmap has and the other lacks bound the overlap from above; only pairs that
   pass are intersected as sorted arrays, and only if no chain links them yet. A
   tile returns a forest of links, never its pairs.

A larger class is cut by size band and hash; pairs of pieces of the same or
neighbouring bands are tiles. Null texts and texts without words have no shingles and no
links. A null id takes part in no link: its row has a null component. Rows that
share an id share a component when any of them links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescape.llm.common import expand, expand_sorted, lookup, mix, part_bounds, parts_of, shingles, slices, squeeze, squeeze_sorted, stored, tidy, Words
from ratescape.llm.components import components

#: Sets of a piece of a tile; words of 64 bits of a bitmap.
TILE, BITMAP_WORDS = 1024, 32
#: The hash range in which shingles that nobody shares are counted: 5 of 16 parts of the whole.
NOBODY = np.iinfo(np.int64).min
RANGE_SHIFT, RANGE_END = np.uint64(1), np.uint64(5 << 60)
#: Shingles of a tile's block: classes of long documents get smaller blocks.
TILE_SHINGLES = 2_000_000
#: Candidate ids up to this number are broadcast to pick their texts; more are joined by shuffling.
BROADCAST_ROWS = 200_000


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer than n words are one shingle."""
    words = Words(column)
    out = []
    all_shingles = shingles(words.hash, n)
    for i in range(len(column)):
        a, b = int(words.at[i]), int(words.at[i + 1])
        if b - a >= n:
            out.append(np.unique(all_shingles[a : b - n + 1]))
        elif b > a:
            out.append(shingles(words.hash[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(s: np.ndarray) -> bytes | None:
    """128 bits that tell sets apart."""
    if not len(s):
        return None
    with np.errstate(over="ignore"):
        a, b = mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64)
    return np.array([a, b], np.uint64).tobytes()


def _describe(n: int):
    """doc_id, n_shingles and set key of each document."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column("text"), n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array(map(set_key, sets), pa.binary())],
                    names=["doc_id", "n_shingles", "set_key"],
                )

    return describe


def _stars(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the smallest id of each, and (id, smallest id) of the others' rows."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
    centre = ids[first]
    spoke = centre[np.cumsum(first) - 1]
    other = ids != spoke
    return keys[first], centre, ids[other], spoke[other]


def _packed_links(keys: np.ndarray, ids: np.ndarray, parts: int) -> pa.RecordBatch:
    """(part, linked, keys, ids): distinct keys with their smallest id, or with linked, links between ids."""
    k, centre, a, b = _stars(keys, ids)
    links = np.unique(np.stack([a, b], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    at = part_bounds(k, parts)
    rows = [(p, False, squeeze_sorted(k[at[p] : at[p + 1]]), squeeze(centre[at[p] : at[p + 1]])) for p in range(parts) if at[p + 1] > at[p]]
    if len(links):
        rows.append((int(links[0, 0]) % parts, True, squeeze(links[:, 0]), squeeze(links[:, 1])))
    kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary())
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["part", "linked", "keys", "ids"])


def _link_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between documents with an equal key, for the rows of one part."""
    keys, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for batch in batches:
        for linked, k, i in zip(*(batch.column(c).to_pylist() for c in ("linked", "keys", "ids")), strict=True):
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array(expand(k, np.int64)), pa.array(expand(i, np.int64))], names=["a", "b"])
            else:
                keys.append(expand_sorted(k))
                ids.append(expand(i, np.int64))
    *_, a, b = _stars(np.concatenate(keys), np.concatenate(ids))
    links = np.unique(np.stack([a, b], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])


def _block_rows(n: int, flush: int = 500_000):
    """Blocks (ids, sizes, shingles) of the picked documents' sets, for rows whose text still has the picked set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, held = [], [], 0

        def block() -> pa.RecordBatch:
            packed = [squeeze(np.array(ids, np.int64)), squeeze(np.array([len(x) for x in sets], np.int64)), b"".join(x.tobytes() for x in sets)]
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], names=["ids", "sizes", "shingles"])

        for batch in batches:
            for part in slices(batch):
                rows = zip(part.column("doc_id").to_pylist(), part.column("set_key").to_pylist(), shingle_sets(part.column("text"), n), strict=True)
                for doc, key, s in rows:
                    if set_key(s) == key:
                        ids.append(doc), sets.append(s)
                        held += len(s)
                if held >= flush:
                    yield block()
                    ids, sets, held = [], [], 0
        if ids:
            yield block()

    return run


def _sets_of(ids: bytes, sizes: bytes, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return expand(ids, np.int64), expand(sizes, np.int64), np.frombuffer(raw, np.uint64)


def _ask(parts: int):
    """(part, block, keys, counts): the distinct shingles of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
                keys, counts = np.unique(np.frombuffer(raw, np.uint64), return_counts=True)
                at = part_bounds(keys, parts)
                rows = [(p, block, squeeze_sorted(keys[a:b]), squeeze(counts[a:b].astype(np.uint32))) for p, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["part", "block", "keys", "counts"])

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, block, totals): for each asking block of a part, how many sets have each of its keys."""
    parts, blocks, keys, counts = [], [], [], []
    for batch in batches:
        for p, b, k, c in zip(*(batch.column(x).to_pylist() for x in ("part", "block", "keys", "counts")), strict=True):
            parts.append(p), blocks.append(b), keys.append(expand_sorted(k)), counts.append(expand(c, np.uint32))
    _, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, np.concatenate(counts)).astype(np.uint32)[which]
    ends = np.cumsum([len(k) for k in keys])
    answers = [squeeze(total[e - len(k) : e]) for e, k in zip(ends.tolist(), keys, strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blocks, pa.int64()), pa.array(answers, pa.binary())], names=["part", "block", "totals"])


def _rare_keys(percent: int, parts: int):
    """For one block and its answers: the first shingles of each set, from rare to frequent, that other sets have."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        answers = right.sort_by("part").column("totals").to_pylist()
        for row in left.to_pylist():
            ids, sizes, flat = _sets_of(row["ids"], row["sizes"], row["shingles"])
            keys, which = np.unique(flat, return_inverse=True)
            totals = np.concatenate([expand(x, np.uint32) for x in answers])[which]
            doc = np.repeat(np.arange(len(ids)), sizes)
            order = np.lexsort((flat, totals, doc))  # sets stay in place; rare shingles come first
            rank = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            first = rank < np.repeat(sizes - (sizes * percent + 99) // 100 + 1, sizes)
            take = order[first & (totals[order] > 1)]
            out.append(_packed_links(flat[take], ids[doc[take]], parts))
        return pa.Table.from_batches(out)

    return run


def _range_rows(n: int, parts: int, flush: int = 2_000_000):
    """Packed (part, keys, ids) of the distinct shingles of a fixed hash range; NOBODY where a task has two sets with the key."""

    def emit(keys: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
        k, d = np.concatenate(keys), np.concatenate(ids)
        order = np.argsort(k, kind="stable")
        k, d = k[order], d[order]
        first = np.append(True, k[1:] != k[:-1])
        alone = np.append(first[1:], True)[first]
        k, d = k[first], np.where(alone, d[first], NOBODY)
        at = part_bounds(k << RANGE_SHIFT, parts)
        rows = [(p, squeeze_sorted(k[at[p] : at[p + 1]]), squeeze(d[at[p] : at[p + 1]])) for p in range(parts) if at[p + 1] > at[p]]
        kinds = (pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "keys", "ids"])  # noqa: B905

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, held, seen = [], [], 0, set()
        for batch in batches:
            for part in slices(batch):
                for doc, s in zip(part.column("doc_id").to_pylist(), shingle_sets(part.column("text"), n), strict=True):
                    if doc is None or not len(s) or (key := set_key(s)) in seen:
                        continue
                    seen.add(key)
                    own = s[: np.searchsorted(s, RANGE_END)]
                    keys.append(own)
                    ids.append(np.full(len(own), doc, np.int64))
                    held += len(own)
                if held >= flush:
                    yield emit(keys, ids)
                    keys, ids, held, seen = [], [], 0, set()
        if held:
            yield emit(keys, ids)

    return run


def _lone_rows(parts: int):
    """For one part: how many of its keys each document has alone, packed by document as (part, ids, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = [], []
        for batch in batches:
            for k, i in zip(batch.column("keys").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                keys.append(expand_sorted(k))
                ids.append(expand(i, np.int64))
        k, d = np.concatenate(keys), np.concatenate(ids)
        order = np.argsort(k, kind="stable")
        k, d = k[order], d[order]
        new = np.append(True, k[1:] != k[:-1])
        lone = d[new & np.append(new[1:], True)]
        docs, counts = np.unique(lone[lone != NOBODY], return_counts=True)
        to = (mix(docs.astype(np.uint64)) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(to, kind="stable")
        docs, counts, to = docs[order], counts[order].astype(np.int32), to[order]
        ends = np.searchsorted(to, np.arange(parts + 1))
        rows = [(p, squeeze(docs[a:b]), squeeze(counts[a:b])) for p, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
        if rows:
            kinds = (pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "ids", "counts"])  # noqa: B905

    return run


def _sum_lone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, counts = [], []
    for batch in batches:
        for i, c in zip(batch.column("ids").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            ids.append(expand(i, np.int64))
            counts.append(expand(c, np.int32))
    docs, which = np.unique(np.concatenate(ids), return_inverse=True)
    total = np.bincount(which, np.concatenate(counts)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(total)], names=["id", "lone"])


def _candidates(docs: DataFrame, sets: DataFrame, n: int, percent: int, parts: int) -> DataFrame:
    """The sets (doc_id, set_key) that have enough shingles in common with anybody."""
    ranged = docs.select("doc_id", "text").mapInArrow(tidy(_range_rows(n, parts)), "part int, keys binary, ids binary")
    lone = ranged.groupBy("part").applyInArrow(_lone_rows(parts), "part int, ids binary, counts binary")
    lone = lone.groupBy("part").applyInArrow(_sum_lone, "id long, lone long")
    joined = sets.join(lone, sets["doc_id"] == lone["id"], "left")
    return joined.where(F.coalesce("lone", F.lit(0)) * 100 <= (100 - percent) * F.col("n_shingles")).select("doc_id", "set_key")


def _picked(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) joined with a stored table on doc_id; the table is broadcast while it is small."""
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    return docs.select("doc_id", "text").join(wanted, "doc_id")


def _bitmap(s: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITMAP_WORDS * 64, bool)
    bits[(mix(s) >> np.uint64(40)) % np.uint64(len(bits))] = True
    return np.packbits(bits).view(np.uint64)


def link_tile(ids: list[int], sets: list[np.ndarray], percent: int, across: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Forest of links of a tile. ``across``: block of each document; then only pairs of different blocks are compared."""
    order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    ids, sets = [ids[i] for i in order], [sets[i] for i in order]
    block = None if across is None else across[order]
    size = np.array([len(s) for s in sets])
    maps = np.stack([_bitmap(s) for s in sets])
    root = np.arange(len(ids))
    out = []
    for i in range(len(ids)):
        # sizes ascend: partners end where the ratio gets too large
        stop = int(np.searchsorted(size, size[i] * 100 // percent, side="right"))
        if stop <= i + 1:
            continue
        js = np.arange(i + 1, stop)
        js = js[root[js] != root[i]]
        if block is not None:
            js = js[block[js] != block[i]]
        if not len(js):
            continue
        # shared <= size - bits that the other lacks; needed: shared >= percent * (a + b) / (100 + percent)
        lacks = np.bitwise_count(maps[i] & ~maps[js]).sum(1, dtype=np.int64)
        misses = np.bitwise_count(maps[js] & ~maps[i]).sum(1, dtype=np.int64)
        bound = np.minimum(size[i] - lacks, size[js] - misses)
        for j in js[bound * (100 + percent) >= percent * (size[i] + size[js])].tolist():
            if root[i] == root[j]:
                continue
            both = np.concatenate([sets[i], sets[j]])
            both.sort(kind="stable")
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            if 100 * shared >= percent * (len(both) - shared):
                out.append((ids[i], ids[j]))
                root[root == root[j]] = root[i]
    return out


def _tiles(percent: int):
    def tiles(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, block = [], [], []
        seen: set[int] = set()
        for batch in batches:
            for doc, raw, b in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "shingles", "block")), strict=True):
                if doc not in seen:
                    seen.add(doc)
                    ids.append(doc), sets.append(expand_sorted(raw)), block.append(b)
        links = link_tile(ids, sets, percent, np.array(block) if key[1].as_py() != key[2].as_py() else None)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return tiles


def _single_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of blocks, one per row."""
    for batch in batches:
        for row in batch.to_pylist():
            ids, sizes, flat = _sets_of(row["ids"], row["sizes"], row["shingles"])
            ends = np.cumsum(sizes).tolist()
            packed = [squeeze_sorted(flat[e - n : e]) for e, n in zip(ends, sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(packed, pa.binary())], names=["doc_id", "shingles"])


def _tile_links(blocks: DataFrame, members: DataFrame, percent: int, tile: int) -> DataFrame:
    """Verified links (a, b) within candidate classes; members: (doc_id, n_shingles, class), one row per set."""
    # sets of linked documents are in the same or in neighbouring bands
    banded = members.withColumn("band", F.floor(F.log(F.col("n_shingles") + F.lit(0.0)) / F.log(F.lit(101.0 / percent))).cast("int"))
    pieces = F.greatest(F.ceil(F.count(F.lit(1)) / tile), F.ceil(F.sum("n_shingles") / TILE_SHINGLES)).cast("int")
    classes = banded.groupBy("class").agg(F.count(F.lit(1)).alias("sets"), pieces.alias("whole")).where("sets > 1").drop("sets")
    per_band = banded.groupBy("class", "band").agg(pieces.alias("pieces")).groupBy("class").agg(F.map_from_entries(F.collect_list(F.struct("band", "pieces"))).alias("cut"))
    placed = lookup(banded, classes.join(per_band, "class"), ["class"], "doc_id").where("whole IS NOT NULL")
    small = F.col("whole") == 1
    band = F.when(small, F.lit(0)).otherwise(F.col("band"))
    own = F.when(small, F.lit(1)).otherwise(F.col("cut")[F.col("band")])
    placed = placed.select("doc_id", "class", "cut", small.alias("small"), band.alias("band"), own.alias("own"))
    placed = placed.withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.col("own")).cast("int"))

    def tiles(other):  # with all pieces of another band
        n = F.coalesce(F.col("cut")[other], F.lit(0))
        return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda k: F.struct(other.alias("band"), k.alias("piece")))

    mine = F.struct("band", "piece")
    same = F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda k: F.struct(F.col("band").alias("band"), k.alias("piece")))
    others = F.when(F.col("small"), same).otherwise(F.concat(same, tiles(F.col("band") - 1), tiles(F.col("band") + 1)))
    dealt = placed.withColumn("other", F.explode(others)).select("doc_id", "class", mine.alias("mine"), "other")
    dealt = dealt.select("doc_id", "class", F.xxhash64("mine").alias("block"), F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"))
    single = blocks.select("ids", "sizes", "shingles").mapInArrow(tidy(_single_sets), "doc_id long, shingles binary")
    joined = dealt.join(single, "doc_id").select("class", "one", "two", "doc_id", "block", "shingles")
    return joined.groupBy("class", "one", "two").applyInArrow(_tiles(percent), "a long, b long")


def _described(docs: DataFrame, n: int) -> DataFrame:
    return stored(docs.select("doc_id", "text").mapInArrow(tidy(_describe(n)), "doc_id long, n_shingles long, set_key binary"), "jaccard-sets")


def _ids_unique(described: DataFrame) -> bool:
    """Whether all rows of an id have the same set."""
    key = F.xxhash64("set_key")
    per_id = described.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(key).alias("one"), F.max(key).alias("other"))
    return per_id.where("one != other").isEmpty()


def _linked(docs: DataFrame, described: DataFrame, n: int, percent: int, tile: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every described row; all rows of an id have the same set."""
    parts = parts_of(docs.sparkSession)
    named = described.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    sets = stored(named.groupBy("set_key", "n_shingles").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")), "jaccard-keys")

    candidates = stored(_candidates(docs, sets, n, percent, parts), "jaccard-candidates")
    blocks = _picked(docs, candidates).mapInArrow(tidy(_block_rows(n)), "ids binary, sizes binary, shingles binary")
    blocks = stored(blocks.withColumn("block", F.monotonically_increasing_id()), "jaccard-blocks")
    asked = blocks.select("block", "shingles").mapInArrow(tidy(_ask(parts)), "part int, block long, keys binary, counts binary")
    answers = asked.groupBy("part").applyInArrow(_answer, "part int, block long, totals binary")
    rare = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(tidy(_rare_keys(percent, parts)), "part int, linked boolean, keys binary, ids binary")
    classes = components(rare.groupBy("part").applyInArrow(_link_keys, "a long, b long"), "jaccard-classes")
    members = stored(sets.join(classes, sets["doc_id"] == classes["node"]).select("doc_id", "n_shingles", F.col("component").alias("class")), "jaccard-members")
    linked = components(_tile_links(blocks, members, percent, tile), "jaccard-links")

    of_set = sets.join(linked, sets["doc_id"] == linked["node"], "left")
    shared = of_set.where("copies > 1 OR component IS NOT NULL").select("set_key", F.coalesce("component", "doc_id").alias("component_id"))
    joined = lookup(described, shared, ["set_key"], "doc_id")
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows with a number each, stored, since the numbers must not change."""
    return stored(docs.select(F.monotonically_increasing_id().alias("node"), "doc_id", F.struct("*").alias("row")), "jaccard-rows")


def _linked_rows(rows: DataFrame, n: int, percent: int, tile: int) -> DataFrame:
    """(node, doc_id, n_shingles, text, linked) of numbered rows with an id; linked is the smallest node reachable by links of texts."""
    texts = rows.where("doc_id IS NOT NULL").select(F.col("node").alias("doc_id"), "row.text")
    links = _linked(texts, _described(texts, n), n, percent, tile).select(F.col("doc_id").alias("at"), "n_shingles", F.col("component_id").alias("linked"))
    return rows.join(links, rows["node"] == links["at"]).select("node", "doc_id", "n_shingles", "row.text", "linked")


def _by_row(docs: DataFrame, n: int, percent: int, tile: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) of rows with an id, where an id may have several texts: these share a component."""
    rows = stored(_linked_rows(_numbered(docs.select("doc_id", "text")), n, percent, tile).drop("text"), "jaccard-rows-linked")
    first = rows.groupBy("doc_id").agg(F.min("linked").alias("first"), F.max("linked").alias("last")).where("first < last").drop("last")
    shared = lookup(rows, first, ["doc_id"], "node").where("linked > first").select(F.col("linked").alias("a"), F.col("first").alias("b"))
    merged = components(shared, "jaccard-shared-ids").select(F.col("node").alias("linked"), "component")
    rows = lookup(rows, merged, ["linked"], "node").withColumn("component", F.coalesce("component", "linked"))
    smallest = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return lookup(rows, smallest, ["component"], "node").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90, tile: int = TILE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text); see the module.

    Where an id has several texts, rows are numbered and linked by number first, so no text hides another.
    """
    described = _described(docs, n)
    if _ids_unique(described):
        return _linked(docs, described, n, percent, tile)
    nameless = described.where("doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return _by_row(docs, n, percent, tile).union(nameless)


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of linked documents: the one with the smallest id.

    Rows without an id stay; of rows with the same id and text, one stays, any
    of them where their other columns differ. Where an id has several texts, each
    of its rows is judged by its own text.
    """
    described = _described(docs, n)
    if not _ids_unique(described):
        return _keep_rows(docs, n, percent)
    found = _linked(docs, described, n, percent, TILE)
    dropped = found.where("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    left = docs.join(dropped, docs["doc_id"] == dropped["_gone"], "left_anti")
    again = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_again"))
    again = stored(again, "jaccard-again")
    if again.isEmpty():
        return left
    once = left.join(again, F.col("doc_id") == again["_again"], "left_anti")
    return once.union(left.join(again, F.col("doc_id") == again["_again"], "left_semi").dropDuplicates(["doc_id", "text"]))


def _keep_rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    rows = _numbered(docs)
    linked = _linked_rows(rows, n, percent, TILE)
    # texts without words link with nothing; equal ones of an id are one
    words = F.col("n_shingles") > 0
    group = F.struct(F.when(words, F.col("linked")).alias("linked"), F.when(~words, F.col("doc_id")).alias("id"), F.when(~words, F.col("text")).alias("text"))
    first = linked.groupBy(group.alias("group")).agg(F.min(F.struct("doc_id", "node")).alias("first")).select(F.col("first.node").alias("kept"))
    stays = rows.join(first, rows["node"] == first["kept"], "left_semi").union(rows.where("doc_id IS NULL"))
    return stays.select("row.*")
