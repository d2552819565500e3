"""Line dedup with two Bloom filters.

Every task adds the keys of its documents to two bitmaps: a bit of the second
is set when it was set in the first before. Bitmaps of tasks merge the same
way, segment by segment. A key that two documents share has all its bits in the
merged second bitmap, so only keys found there are suspected. They alone are
shuffled, as exact keys with one row per document, and counted. Lines whose key
is confirmed are dropped; ``keep="first"`` spares the first occurrence.

A line's key is the line without white space at both ends, A-Z in lower case.
A full filter only means more suspects, never another result. Confirmed keys
travel as a broadcast set while they are few (their number is counted first);
beyond that the suspected lines are joined with them.

Null text counts as one empty line, and an empty key is never dropped. Each
row is a document of its own, also where doc_id repeats or is null. All other
columns are kept as they are, but for columns named like the added ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratescape.llm.common import SPACES, expand, shared_path, squeeze, stored, tidy

#: Bits of a filter: 2**25 is 4 MiB. Segments are the unit in which filters are merged.
FILTER_BITS = 25
SEGMENTS = 512
#: Up to so many confirmed keys (16 bytes each) are broadcast.
BROADCAST_KEYS = 200_000


def line_key(line: bytes) -> bytes:
    return line.strip(SPACES).lower()


def _hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def _bits(hashes: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions per hash."""
    words = np.frombuffer(b"".join(hashes), np.uint64).reshape(-1, 2)
    shift = np.uint64(64 - bits)
    return (words[:, 0] >> shift).astype(np.int64), (words[:, 1] >> shift).astype(np.int64)


def _build(bits: int):
    per_segment = (1 << bits) // SEGMENTS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                keys = {_hash(k) for k in map(line_key, _lines(text)) if k}
                if not keys:
                    continue
                a, b = _bits(list(keys), bits)
                places, n = np.unique(np.concatenate([a, b]), return_counts=True)
                twice[places[once[places] | (n > 1)]] = True
                once[places] = True
        cut = lambda x: [squeeze(np.packbits(x[i * per_segment : (i + 1) * per_segment])) for i in range(SEGMENTS)]
        if once.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SEGMENTS), pa.int32()), pa.array(cut(once), pa.binary()), pa.array(cut(twice), pa.binary())],
                names=["segment", "once", "twice"],
            )

    return build


def _merge(bits: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for segment, *raw in zip(*(batch.column(c).to_pylist() for c in ("segment", "once", "twice")), strict=True):
                once, twice = (expand(x, np.uint8) for x in raw)
                if segment in found:
                    a, b = found[segment]
                    once, twice = a | once, b | twice | (a & once)
                found[segment] = once, twice
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int32()), pa.array([squeeze(x[1]) for x in found.values()], pa.binary())], names=["segment", "twice"]
            )

    return merge


def twice_seen(docs: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The merged second filter, one byte per eight bits: 2**bits / 8 bytes whatever the input."""
    spark = docs.sparkSession
    tasks = docs.select("text").mapInArrow(tidy(_build(bits)), "segment int, once binary, twice binary")
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = tasks.repartition(min(SEGMENTS, shuffle), "segment").mapInArrow(tidy(_merge(bits)), "segment int, twice binary")
    out = np.zeros((SEGMENTS, (1 << bits) // SEGMENTS // 8), np.uint8)
    for row in merged.collect():  # SEGMENTS rows of a fixed size
        out[row.segment] = expand(bytes(row.twice), np.uint8)
    return out.reshape(-1)


def _suspected(sent):
    """Marks the keys whose bits are all in the filter."""

    def suspected(keys: list[bytes]) -> np.ndarray:
        full = np.frombuffer(sent.value, np.uint8)
        a, b = _bits([_hash(k) for k in keys], (len(full) * 8).bit_length() - 1)
        is_set = lambda p: (full[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1
        return (is_set(a) & is_set(b)).astype(bool)

    return suspected


def _list_suspects(sent, every: bool):
    """(row, doc_id, line, key) of suspected keys: the first line of each in a document, or every line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suspected = _suspected(sent)
        for batch in batches:
            rows, ids, lines, keys = [], [], [], []
            for row, doc, text in zip(*(batch.column(c).to_pylist() for c in ("_row", "doc_id", "text")), strict=True):
                own = [(i, k) for i, k in enumerate(map(line_key, _lines(text))) if k]
                if not every:
                    own = [(i, k) for k, i in dict((k, i) for i, k in reversed(own)).items()]
                if own:
                    for at in np.flatnonzero(suspected([k for _, k in own])).tolist():
                        i, key = own[at]
                        rows.append(row), ids.append(doc), lines.append(i), keys.append(key)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((rows, ids, lines, keys), kinds, strict=True)], names=["_row", "doc_id", "line", "key"])

    return run


PLACES = "_row long, doc_id long, line long, key binary"


def repeated_keys(docs: DataFrame, min_docs: int, sent) -> DataFrame:
    """(key, n_docs, doc_id, line) of every non-empty key in at least ``min_docs`` documents, with its first place.

    ``sent`` is the broadcast second filter. Only suspected keys are shuffled,
    one row per document and key, and counts combine before the shuffle.
    """
    found = docs.select(F.lit(0).cast("long").alias("_row"), "doc_id", "text").mapInArrow(tidy(_list_suspects(sent, False)), PLACES)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line")).alias("first")
    counted = found.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), first).where(F.col("n_docs") >= min_docs)
    return counted.select("key", "n_docs", "first.doc_id", "first.line")


def _drop(text: str | None, dropped) -> tuple[int, list[bytes]]:
    lines = _lines(text)
    return len(lines), [x for i, x in enumerate(lines) if not dropped(i, x)]


def dedup_lines(
    docs: DataFrame, min_docs: int = 2, keep: str = "none", bits: int = FILTER_BITS, broadcast_keys: int = BROADCAST_KEYS, whole_from: float | None = None
) -> DataFrame:
    """``docs`` with shortened ``text`` and the added columns _n_lines and _n_dropped.

    ``keep="none"`` drops a repeated line everywhere; ``keep="first"`` keeps it
    in its first place by (doc_id, line number), with null ids last; rows that
    share an id share that place. A text without any dropped line stays as it is.

    ``whole_from`` goes with ``keep="first"``. A document that loses lines and is
    left without a word goes: each of its lines stays in its first place. One that
    keeps words but would lose this share of them or more stays whole, with
    _n_dropped 0, so that a later step can tell whether it is a near copy.
    """
    if whole_from is not None and (keep != "first" or not 0 < whole_from <= 1):
        raise ValueError(f"whole_from needs keep first and a share above 0, up to 1; not {keep}, {whole_from}")
    if keep not in ("none", "first") or min_docs < 2:
        raise ValueError(f"keep is none or first, min_docs 2 at least; not {keep}, {min_docs}")
    spark = docs.sparkSession
    docs = docs.drop("_n_lines", "_n_dropped", "_row", "_places")
    sent = spark.sparkContext.broadcast(twice_seen(docs, bits).tobytes())
    keys = stored(repeated_keys(docs, min_docs, sent), "line-keys")
    schema = T.StructType([*docs.schema.fields, T.StructField("_n_lines", T.LongType()), T.StructField("_n_dropped", T.LongType())])
    if keys.count() <= broadcast_keys:
        places = {_hash(bytes(r.key)): (r.doc_id, r.line) for r in keys.drop("n_docs").toLocalIterator()}
        known = spark.sparkContext.broadcast(places if keep == "first" else dict.fromkeys(places))
        return docs.mapInArrow(tidy(_apply(_by_key(known), whole_from)), schema)

    # Number the rows in a stored table, list the lines with a repeated key, and join their places back.
    numbered = docs.select(*docs.columns, F.monotonically_increasing_id().alias("_row"))
    path = shared_path(spark, "line-docs")
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    lines = numbered.select("_row", "doc_id", "text").mapInArrow(tidy(_list_suspects(sent, True)), PLACES)
    salted = keys.select("key", F.col("doc_id").alias("first_id"), F.col("line").alias("first_line"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    hits = lines.withColumn("salt", F.pmod("_row", F.lit(16)).cast("int")).join(salted, ["key", "salt"])
    if keep == "first":
        hits = hits.where(~(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("line") == F.col("first_line"))))
    by_row = hits.groupBy("_row").agg(F.collect_list("line").alias("_places"))
    return numbered.join(by_row, "_row", "left").mapInArrow(tidy(_apply(_by_place, whole_from)), schema)


def _by_key(known):
    """For a batch, a test (line number, line) per document: whether the line's key is known and this is not its first place."""

    def tests(batch: pa.RecordBatch):
        places = known.value

        def test(doc):
            def gone(i: int, line: bytes) -> bool:
                key = line_key(line)
                if not key or (h := _hash(key)) not in places:
                    return False
                return places[h] != (doc, i)

            return gone

        return map(test, batch.column("doc_id").to_pylist())

    return tests


def _by_place(batch: pa.RecordBatch):
    return ((lambda i, line, own=set(x or ()): i in own) for x in batch.column("_places").to_pylist())


def _apply(tests, whole_from: float | None):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped, stays = [], [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), tests(batch), strict=True):
                n, left = _drop(text, gone)
                words = 1
                if whole_from is not None and len(left) < n:
                    words, all_words = sum(len(x.split()) for x in left), sum(len(x.split()) for x in _lines(text))
                    if words and all_words - words >= whole_from * all_words:
                        left = _lines(text)
                stays.append(words > 0)
                texts.append(text if len(left) == n else b"\n".join(left).decode("utf-8", "surrogatepass"))
                n_lines.append(n)
                n_dropped.append(n - len(left))
            arrays = {n: batch.column(n) for n in batch.schema.names if n not in ("_row", "_places")}
            arrays["text"] = pa.array(texts, batch.schema.field("text").type)
            arrays |= {"_n_lines": pa.array(n_lines, pa.int64()), "_n_dropped": pa.array(n_dropped, pa.int64())}
            out = pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))
            yield out if all(stays) else out.filter(pa.array(stays, pa.bool_()))

    return apply
