"""Suffix dedup: removes every byte covered by a string of ``size`` bytes that also starts earlier.

"Earlier" is a smaller document id or, in a document, a smaller start. A suffix
counts with its first ``size`` bytes only, here called a window, and windows are
handled in groups:

1. Texts are stored in compressed blocks. In each window the k-gram with the
   smallest hash is its anchor; equal windows have equal anchors at the same
   offset. Neighbouring windows with the same anchor are one record: all their
   bytes, the record's context.
2. Each block sends the hashes of its records (anchor and context) to key
   ranges. There the first record of each context is found. All windows of the
   others are repeats. A first record needs a closer look only if its anchor
   stands in other contexts, too.
3. Those records are range-partitioned by their suffix from the anchor on, with
   splitters sampled from all of them; an anchor with very many contexts is cut
   further by offset. A bucket sorts the windows of its records by multikey
   quicksort, eight bytes at a time and only where windows are still equal, and
   keeps the earliest of each run of equal ones. Cuts fall between different
   anchors or offsets only, so no equal windows lie across a boundary.
4. The repeated windows go back to their blocks, where bytes are removed.

Work and memory follow records, never pairs. Contexts are told apart by 64-bit
hashes; windows are compared byte by byte.

Null text is empty. Rows without id come last, in stored order, as do rows with
equal ids among themselves; each row is a document of its own.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescape.llm.common import SLICE_BYTES, expand, expand_sorted, mix, part_bounds, parts_of, runs, slices, squeeze, squeeze_sorted, stored, text_bytes, tidy, Spans

GRAM = 24
#: Contexts of an anchor from which on its windows are dealt by offset; offsets of a class; keys sampled for splitters.
MANY, OFFSETS, SAMPLE = 500, 8, 10_000
NO_ID = np.iinfo(np.int64).max
BLOCK = "ids binary, no_id binary, offsets binary, texts binary, n_bytes long"


def _store_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, limit=2 * SLICE_BYTES):
            data, at = text_bytes(part.column("text"))
            ids = part.column("doc_id").cast(pa.int64())
            none = ids.is_null().to_numpy(zero_copy_only=False)
            packed = [squeeze(ids.fill_null(NO_ID).to_numpy()), squeeze(none), squeeze(at), pa.compress(data.tobytes(), codec="zstd", asbytes=True) if len(data) else b""]
            yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.binary()) for x in packed), pa.array([len(data)], pa.int64())], names=[c.split()[0] for c in BLOCK.split(", ")])


class _Records:
    """The records of a block: first and last window start, anchor, hashes, and document."""

    def __init__(self, row: dict, size: int):
        self.ids, self.at = expand(row["ids"], np.int64), expand(row["offsets"], np.int64)
        self.no_id = expand(row["no_id"], bool)
        n = row["n_bytes"]
        self.data = np.frombuffer(pa.decompress(row["texts"], n, codec="zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
        spans = Spans(self.data)
        empty = np.zeros(0, np.int64)
        self.first = self.last = self.anchor = self.doc = empty
        if n >= size:
            grams = n - GRAM + 1
            place = np.arange(grams)
            bits = max(1, int(grams).bit_length())
            low = np.uint64((1 << bits) - 1)
            best = (spans.of(place, place + GRAM) & ~low) | place.astype(np.uint64)
            reach, width = 1, size - GRAM + 1
            while 2 * reach <= width:
                best = np.minimum(best[:-reach], best[reach:])
                reach *= 2
            if reach < width:
                step = width - reach
                best = np.minimum(best[: len(best) - step], best[step:])
            anchor = (best & low).astype(np.int64)  # of the window at each start
            whole = np.zeros(len(anchor), bool)
            for a, b in zip(self.at[:-1].tolist(), self.at[1:].tolist(), strict=True):
                if b - a >= size:
                    whole[a : b - size + 1] = True
            starts, ends = runs(whole, np.append(np.flatnonzero(np.diff(anchor)) + 1, self.at[1:-1]).astype(np.int64)) if len(anchor) else (empty, empty)
            self.first, self.last = starts, ends - 1
            self.anchor = anchor[starts]
            self.doc = np.searchsorted(self.at, starts, side="right") - 1
        self.gram = spans.of(self.anchor, self.anchor + GRAM)
        context = spans.of(self.first, self.last + size)
        self.context = mix(context ^ mix(((self.anchor - self.first) * 4096 + self.last - self.first).astype(np.uint64) + np.uint64(1)))
        # sorted by anchor, context, document, place; own: the first of a context in the block
        self.order = np.lexsort((self.first, self.ids[self.doc], self.context, self.gram)) if len(self.first) else empty
        g, c = self.gram[self.order], self.context[self.order]
        self.own = np.append(True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])) if len(g) else np.zeros(0, bool)


def _breaks_sorted(x: np.ndarray) -> np.ndarray:
    return np.append(True, x[1:] != x[:-1]) if len(x) else np.zeros(0, bool)


def _ask(size: int, parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                r = _Records(row, size)
                own = r.order[r.own]
                keys, contexts, docs = r.gram[own], r.context[own], r.ids[r.doc[own]]
                at = part_bounds(keys, parts)
                rows = [(p, row["block"], squeeze_sorted(keys[a:b]), squeeze(contexts[a:b]), squeeze(docs[a:b])) for p, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]
                if rows:
                    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["part", "block", "grams", "contexts", "docs"])

    return ask


#: Answers per record: nothing to do, compare windows, compare windows by offset, repeat of a context.
FREE, COMPARE, COMPARE_MANY, REPEAT = 0, 1, 2, 3


def _answer(many: int):
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, grams, contexts, docs = [], [], [], []
        for batch in batches:
            for p, b, g, c, d in zip(*(batch.column(x).to_pylist() for x in ("part", "block", "grams", "contexts", "docs")), strict=True):
                rows.append((p, b)), grams.append(expand_sorted(g)), contexts.append(expand(c, np.uint64)), docs.append(expand(d, np.int64))
        sizes = [len(g) for g in grams]
        g, c, d = np.concatenate(grams), np.concatenate(contexts), np.concatenate(docs)
        block = np.repeat([b for _, b in rows], sizes)
        order = np.lexsort((block, d, c, g))
        g, c = g[order], c[order]
        new_gram = _breaks_sorted(g)
        new_context = new_gram | _breaks_sorted(c)
        gram = np.cumsum(new_gram) - 1
        distinct = np.bincount(gram[new_context])[gram]
        code = np.where(~new_context, REPEAT, np.where(distinct == 1, FREE, np.where(distinct < many, COMPARE, COMPARE_MANY))).astype(np.uint8)
        back = np.empty_like(code)
        back[order] = code
        ends = np.cumsum(sizes).tolist()
        answers = [squeeze(back[e - n : e]) for e, n in zip(ends, sizes, strict=True)]
        columns = [*zip(*rows, strict=True), answers]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["part", "block", "codes"])

    return answer


def _codes(r: _Records, answers: list[tuple[int, bytes]]) -> np.ndarray:
    """A code for each record of the block, in the order of its sorted records."""
    own = [expand(raw, np.uint8) for _, raw in sorted(answers)]
    codes = np.full(len(r.order), REPEAT, np.uint8)
    codes[r.own] = np.concatenate(own) if own else np.zeros(0, np.uint8)
    return codes


CONTEXT = "lead binary, offsets int, doc long, block long, record int, first int, anchor int, windows int, bytes binary"


def _contexts(size: int):
    """The records to compare: suffix from the anchor on as the key, and all their bytes."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[dict] = []
        answers = list(zip(right.column("part").to_pylist(), right.column("codes").to_pylist(), strict=True))
        for row in left.to_pylist():
            r = _Records(row, size)
            codes = _codes(r, answers)
            raw = r.data.tobytes()
            for number in np.flatnonzero((codes == COMPARE) | (codes == COMPARE_MANY)).tolist():
                i = r.order[number]
                first, last, anchor = int(r.first[i]), int(r.last[i]), int(r.anchor[i])
                record = dict(lead=raw[anchor : anchor + GRAM], offsets=-1, doc=int(r.ids[r.doc[i]]), block=row["block"], record=number, first=first, anchor=anchor - first, windows=last - first + 1, bytes=raw[first : last + size])
                if codes[number] == COMPARE:
                    out.append(record)
                else:
                    out += [record | {"offsets": k} for k in range((anchor - last) // OFFSETS, (anchor - first) // OFFSETS + 1)]
        kinds = dict(binary=pa.binary(), int=pa.int32(), long=pa.int64())
        return pa.Table.from_pylist(out, schema=pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in CONTEXT.split(", ")]))

    return run


def multikey_sort(data: np.ndarray, starts: np.ndarray, size: int, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings of ``size`` bytes by group, then bytes, and which of them begin a new run of equal ones.

    Multikey quicksort, all partitions at a level together: strings are split by
    eight bytes, and only those that are still equal to others go on.
    """
    order = np.argsort(group, kind="stable")
    new = _breaks_sorted(group[order])
    padded = np.append(data, np.zeros(8, np.uint8))
    for depth in range(0, size, 8):
        run = np.cumsum(new) - 1
        alive = np.flatnonzero(np.bincount(run)[run] > 1)
        if not len(alive):
            break
        take = min(8, size - depth)
        at = starts[order[alive]] + depth
        token = np.zeros(len(alive), np.uint64)
        for k in range(take):
            token = (token << np.uint64(8)) | padded[at + k]
        inside = np.lexsort((token, run[alive]))
        order[alive] = order[alive][inside]
        token, own = token[inside], run[alive]
        new[alive] |= np.append(True, (token[1:] != token[:-1]) | (own[1:] != own[:-1]))
    return order, new


def _compare(size: int):
    """The windows of a bucket that an earlier one equals, as runs (block, records, from, to)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        columns = {c: table.column(c).to_numpy() for c in ("offsets", "doc", "block", "record", "first", "anchor", "windows")}
        data, at = text_bytes(table.column("bytes").combine_chunks())
        which = np.repeat(np.arange(len(table)), columns["windows"])
        k = np.arange(len(which)) - np.repeat(np.cumsum(columns["windows"]) - columns["windows"], columns["windows"])
        offset = columns["anchor"][which] - k
        mine = (columns["offsets"][which] < 0) | (offset // OFFSETS == columns["offsets"][which])
        which, k, offset = which[mine], k[mine], offset[mine]
        # earliest first: the sort is stable
        early = np.lexsort((columns["first"][which] + k, columns["block"][which], columns["doc"][which]))
        which, k, offset = which[early], k[early], offset[early]
        order, new = multikey_sort(data, at[which] + k, size, offset)
        repeat = order[~new]
        w, k = which[repeat], k[repeat]
        by = np.lexsort((k, w))
        w, k = w[by], k[by]
        if len(w):
            begin = np.append(True, (w[1:] != w[:-1]) | (k[1:] != k[:-1] + 1))
            end = np.append(begin[1:], True)
            blocks, records = columns["block"][w[begin]], columns["record"][w[begin]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(records, pa.int32()), pa.array(k[begin], pa.int32()), pa.array(k[end], pa.int32())], names=["block", "record", "low", "high"]
            )

    return run


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(size: int, with_text: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds, parts, codes = (right.column(c).to_pylist() for c in ("kind", "part", "codes"))
        answers = [(p, c) for kind, p, c in zip(kinds, parts, codes, strict=True) if kind == 0]
        found = right.filter(pa.array([k == 1 for k in kinds], pa.bool_()))
        out: list[dict] = []
        for row in left.to_pylist():
            r = _Records(row, size)
            again = r.order[_codes(r, answers) == REPEAT]
            hit = r.order[found.column("record").to_numpy()]
            low = np.concatenate([r.first[again], r.first[hit] + found.column("low").to_numpy()])
            high = np.concatenate([r.last[again], r.first[hit] + found.column("high").to_numpy()]) + size
            steps = np.zeros(len(r.data) + 1, np.int64)
            np.add.at(steps, low, 1)
            np.add.at(steps, high, -1)
            gone = np.cumsum(steps)[:-1] > 0
            starts, _ = runs(gone, r.at)
            spans = np.bincount(np.searchsorted(r.at, starts, side="right") - 1, minlength=len(r.ids)) if len(starts) else np.zeros(len(r.ids), np.int64)
            for i, (a, b) in enumerate(zip(r.at[:-1].tolist(), r.at[1:].tolist(), strict=True)):
                kept = r.data[a:b][~gone[a:b]].tobytes()
                out.append(
                    dict(doc_id=None if r.no_id[i] else int(r.ids[i]), n_bytes=b - a, n_removed=b - a - len(kept), n_spans=int(spans[i]), kept_sha256=hashlib.sha256(kept).hexdigest(), kept=kept if with_text else None)
                )
        types = dict(long=pa.int64(), string=pa.string(), binary=pa.binary())
        return pa.Table.from_pylist(out, schema=pa.schema([(c.split()[0], types[c.split()[1]]) for c in RESULT.split(", ")]))

    return run


def remove_repeats(docs: DataFrame, size: int = 100, with_text: bool = False, many: int = MANY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the remaining bytes) of each document.

    ``size`` is 2 * ``GRAM`` at least.
    """
    if not 2 * GRAM <= size < 4096:
        raise ValueError(f"size is from {2 * GRAM} to 4095")
    spark = docs.sparkSession
    parts = parts_of(spark)
    blocks = stored(docs.select("doc_id", "text").mapInArrow(tidy(_store_blocks), BLOCK).withColumn("block", F.monotonically_increasing_id()), "suffix-blocks")
    asked = blocks.mapInArrow(tidy(_ask(size, parts)), "part int, block long, grams binary, contexts binary, docs binary")
    codes = stored(asked.groupBy("part").applyInArrow(_answer(many), "part int, block long, codes binary"), "suffix-codes")
    contexts = blocks.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(tidy(_contexts(size)), CONTEXT)
    contexts = stored(contexts, "suffix-contexts")

    step = F.lit(contexts.count() // SAMPLE + 1)
    sample = contexts.where(F.pmod(F.xxhash64("block", "record", "offsets"), step) == 0).select("lead", "offsets")
    keys = sorted((bytes(x.lead), x.offsets) for x in sample.collect())  # about SAMPLE keys
    splitters = sorted({keys[i * len(keys) // (4 * parts)] for i in range(1, 4 * parts)}) if keys else []
    compared = _ranged(contexts, splitters).groupBy("bucket").applyInArrow(_compare(size), "block long, record int, low int, high int")

    none = F.lit(None)
    answers = codes.select("block", F.lit(0).alias("kind"), "part", "codes", *(none.cast("int").alias(c) for c in ("record", "low", "high")))
    repeats = compared.select("block", F.lit(1).alias("kind"), none.cast("int").alias("part"), none.cast("binary").alias("codes"), "record", "low", "high")
    result = blocks.groupBy("block").cogroup(answers.unionByName(repeats).groupBy("block")).applyInArrow(tidy(_remove(size, with_text)), RESULT)
    return result if with_text else result.drop("kept")


def _ranged(contexts: DataFrame, splitters: list[tuple[bytes, int]]) -> DataFrame:
    """``contexts`` with the number of their key range."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("lead").to_pylist(), batch.column("offsets").to_pylist(), strict=True)
            bucket = pa.array([bisect_right(splitters, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([bucket, *batch.columns], names=["bucket", *batch.schema.names])

    return contexts.mapInArrow(tidy(place), f"bucket int, {CONTEXT}")
