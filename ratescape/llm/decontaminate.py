"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of consecutive words of the test items. Document
words stream through it; at each word it knows the longest run ending there
that some item contains. Where that length reaches ``window`` (or a whole
shorter item), the words of the run are hit and the items are known. Runs of
hit words are the spans to remove.

Items come to the driver in blocks of a bounded, checked size; each block is an
automaton of its own, sent to the executors, and all documents stream through
it. The spans of several blocks are merged per document. Only runs of words
that occur in some item are streamed; all other words lead to the root.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower
case. A null or empty text has no words and no hits; items without words match
nothing; equal items all count. Rows with the same id stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratescape.llm.common import runs, shared_path, slices, tidy, Words

WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
#: Bytes of item texts in one automaton.
BLOCK_BYTES = 4 << 20


def item_words(text: str | None) -> list[int]:
    return Words(pa.array([text or ""]), WORD_BYTES).hash.tolist()


class Automaton:
    """All runs of words of some items; ``items`` is a list of (id, word hashes)."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ids = [name for name, _ in items]
        ends: list[set[int]] = [set()]  # items that have the state's runs
        self.whole: list[list[tuple[int, int]]] = [[]]  # (length, item) of short items that end in the state
        for k, (_, words) in enumerate(items):
            last = 0
            for w in words:
                last = self._extend(last, w, ends)
                ends[last].add(k)
            if 0 < len(words) < window:
                self.whole[last].append((len(words), k))
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True)
        for v in order:
            if self.link[v] > 0:
                ends[self.link[v]] |= ends[v]
        self.items = ends
        self.shortest = min([min(len(w), window) for _, w in items if w], default=0)
        self.words = np.unique(np.array([w for _, words in items for w in words], np.uint64))
        self.has_short = any(self.whole)

    def _new(self, length: int, ends: list[set[int]]) -> int:
        self.next.append({})
        self.link.append(-1)
        self.length.append(length)
        self.whole.append([])
        ends.append(set())
        return len(self.link) - 1

    def _split(self, p: int, w: int, q: int, ends: list[set[int]]) -> int:
        twin = self._new(self.length[p] + 1, ends)
        self.next[twin] = dict(self.next[q])
        self.link[twin] = self.link[q]
        # runs of a short whole item may move to the twin, which has the shorter ones
        self.whole[twin] = [x for x in self.whole[q] if x[0] <= self.length[twin]]
        self.whole[q] = [x for x in self.whole[q] if x[0] > self.length[twin]]
        self.link[q] = twin
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, w: int, ends: list[set[int]]) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q, ends)
        new = self._new(self.length[last] + 1, ends)
        p = last
        while p != -1 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p == -1:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q, ends)
        return new

    def matches(self, words: list[int]) -> Iterator[tuple[int, int, set[int]]]:
        """(first word, end, items) of every window or whole short item in a run of words."""
        state = length = 0
        nexts, link, lengths, window = self.next, self.link, self.length, self.window
        for i, w in enumerate(words):
            while state and w not in nexts[state]:
                state = link[state]
                length = lengths[state]
            if w in nexts[state]:
                state = nexts[state][w]
                length += 1
            else:
                length = 0
            if length >= window:
                at = state
                while lengths[link[at]] >= window:
                    at = link[at]
                yield i + 1 - window, i + 1, self.items[at]
            if self.has_short:
                at = state
                while at > 0:
                    for size, k in self.whole[at]:
                        if size <= length:
                            yield i + 1 - size, i + 1, {k}
                    at = link[at]


def find(automaton: Automaton, words: Words) -> Iterator[tuple[int, list[tuple[int, int]], set[int]]]:
    """(text, spans of words within the text, items) for each text of a slice with a match."""
    if not automaton.shortest or not len(words.hash):
        return
    known = automaton.words[np.minimum(np.searchsorted(automaton.words, words.hash), len(automaton.words) - 1)] == words.hash
    first, end = runs(known, words.at)
    long = end - first >= automaton.shortest
    first, end = first[long], end[long]
    text_of = np.searchsorted(words.at, first, side="right") - 1
    current, spans, items = -1, [], set()
    for text, a, b in zip(text_of.tolist(), first.tolist(), end.tolist(), strict=True):
        if text != current:
            if spans:
                yield current, _merged(spans), items
            current, spans, items = text, [], set()
        base = a - int(words.at[text])
        for s, e, ks in automaton.matches(words.hash[a:b].tolist()):
            spans.append((base + s, base + e))
            items |= ks
    if spans:
        yield current, _merged(spans), items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, overlapping and touching spans joined."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items with words, as (id, text), in blocks of about ``block_bytes`` of text."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // block_bytes) + 1
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect()  # bounded by the block
        if rows:
            yield [(str(r.item_id), r.text) for r in rows]


def _build(block: list[tuple[str, str]], window: int) -> Automaton:
    return Automaton([(name, w) for name, text in block if (w := item_words(text))], window)


ADDED = [
    T.StructField("_n_words", T.LongType()),
    T.StructField("_spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("_items", T.ArrayType(T.StringType())),
]


def _scan(sent, window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _build(sent.value, window)
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"), WORD_BYTES)
                spans: list[list] = [[] for _ in range(part.num_rows)]
                items: list[list[str]] = [[] for _ in range(part.num_rows)]
                for text, found, ks in find(automaton, words):
                    spans[text], items[text] = found, sorted({automaton.ids[k] for k in ks})
                arrays = {n: part.column(n) for n in part.schema.names}
                arrays |= {
                    "_n_words": pa.array(np.diff(words.at), pa.int64()),
                    "_spans": pa.array([[list(s) for s in x] for x in spans], pa.list_(pa.list_(pa.int64()))),
                    "_items": pa.array(items, pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    return scan


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with _n_words, _spans (merged [first word, end) pairs that are hit) and _items (ids as sorted strings)."""
    docs = docs.drop(*(f.name for f in ADDED))
    spark = docs.sparkSession
    blocks = list(_blocks(benchmark, block_bytes)) if block_bytes else []
    schema = T.StructType([*docs.schema.fields, *ADDED])
    if len(blocks) <= 1:
        return docs.mapInArrow(tidy(_scan(spark.sparkContext.broadcast(blocks[0] if blocks else []), window)), schema)
    numbered = docs.select(*docs.columns, F.monotonically_increasing_id().alias("_row"))
    path = shared_path(spark, "leak-docs")
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    found = None
    for block in blocks:
        hits = numbered.select("_row", "text").mapInArrow(tidy(_scan(spark.sparkContext.broadcast(block), window)), T.StructType([T.StructField("_row", T.LongType()), T.StructField("text", T.StringType()), *ADDED]))
        hits = hits.select("_row", "_n_words", "_spans", "_items")
        found = hits if found is None else found.union(hits)
    merged = found.groupBy("_row").agg(
        F.max("_n_words").alias("_n_words"), F.flatten(F.collect_list("_spans")).alias("_raw"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_items")
    )
    # join touching spans: fold over the sorted list
    start = F.expr("CAST(array() AS ARRAY<ARRAY<BIGINT>>)")

    def fold(out, s):
        last = F.element_at(out, -1)
        return F.when((F.size(out) > 0) & (s[0] <= last[1]), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.array(last[0], F.greatest(last[1], s[1]))))).otherwise(F.concat(out, F.array(s)))

    merged = merged.withColumn("_spans", F.aggregate(F.array_sort("_raw"), start, fold)).drop("_raw")
    return numbered.join(merged, "_row").select(*docs.columns, "_n_words", "_spans", "_items")


def digest(found: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 and contaminated, from ``contamination``."""
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def _cut(max_words: int, max_share: float, schema: T.StructType):
    names = schema.fieldNames()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                spans = part.column("_spans").to_pylist()
                hit = [sum(e - s for s, e in x) for x in spans]
                total = part.column("_n_words").to_pylist()
                texts = part.column("text").to_pylist()
                keep = [not h or (h <= max_words and h <= max_share * n) for h, n in zip(hit, total, strict=True)]
                words = Words(part.column("text"), WORD_BYTES)
                for i, found in enumerate(spans):
                    if found and keep[i]:
                        raw, base, at = texts[i].encode(), int(words.text_at[i]), int(words.at[i])
                        pieces, done = [], 0
                        for s, e in found:
                            pieces.append(raw[done : int(words.start[at + s]) - base])
                            done = int(words.end[at + e - 1]) - base
                        texts[i] = b"".join([*pieces, raw[done:]]).decode()
                arrays = [pa.array(texts, part.schema.field("text").type) if n == "text" else part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(arrays, names=names).filter(pa.array(keep))

    return cut


def remove_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_words: int = 2_000, max_share: float = 0.5) -> DataFrame:
    """``docs`` without the hit spans; a document with more than ``max_words`` hit words or ``max_share`` of its words hit goes."""
    found = contamination(docs, benchmark, window)
    schema = T.StructType([f for f in found.schema.fields if f.name in docs.columns])
    return found.mapInArrow(tidy(_cut(max_words, max_share, schema)), schema)
