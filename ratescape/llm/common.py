"""Text, hashing, packing and storage helpers of the corpus operators.

Texts reach Python as Arrow batches. The helpers work on the raw UTF-8 bytes of
many texts at once, so no per-character Python code runs.
"""

from __future__ import annotations

import ctypes
import inspect
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: space and 09 to 0D. A SQL pattern, a Python byte set and a table.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"
IS_WORD = np.ones(256, bool)
IS_WORD[list(SPACES)] = False
#: ASCII upper case to lower case, byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Texts are handled in slices of about so many bytes, which bounds the arrays of a task.
SLICE_BYTES = 1 << 20


# ---------------------------------------------------------------- storage


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names; all executors share it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="ratescape-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps start from its rows."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_of(spark: SparkSession) -> int:
    """Groups for packed rows: a few per shuffle partition, so that groups even out over tasks."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def lookup(rows: DataFrame, table: DataFrame, on: list[str], spread: str, salts: int = 16) -> DataFrame:
    """Left join with a table of one row per key, where one key may hold a third of the rows.

    The table is repeated once per salt and ``spread`` deals the rows of a key to
    the salts. Keep the table to keys that repeat, so that the copies stay few.
    """
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return dealt.join(salted, [*on, "_salt"], "left").drop("_salt")


# ---------------------------------------------------------------- memory of Python workers


def _give_back() -> None:
    """Hand freed memory back to the system: Spark reuses its Python workers from stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(function):
    """The function for mapInArrow or a cogroup, giving memory back when it is done."""
    if inspect.isgeneratorfunction(function):

        def run(batches):
            yield from function(batches)
            _give_back()
    else:

        def run(left, right):
            out = function(left, right)
            _give_back()
            return out

    return run


# ---------------------------------------------------------------- texts as bytes


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows, null as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text; a longer text is a run of its own."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(first, last - first)
        first = last


def runs(mask: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of True that crosses none of the sorted breaks."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = breaks[(breaks > 0) & (breaks < len(mask))]
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    first[inner] |= mask[inner]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    last[inner - 1] |= mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


# ---------------------------------------------------------------- hashing

_RANDOM = np.random.RandomState(20240607)
_BYTE = _RANDOM.randint(0, 1 << 62, 256).astype(np.uint64) * np.uint64(4) + np.uint64(1)
_BASE, _MASK = 0x9E3779B97F4A7C55, (1 << 64) - 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a fixed bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Spans:
    """64-bit hashes of any byte spans of an array, from one running sum."""

    def __init__(self, data: np.ndarray):
        up, self._down = _powers(len(data) + 1)
        self._sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self._sum[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sum[end] - self._sum[start]) * self._down[start] + (end - start).astype(np.uint64))


class Words:
    """The words of a slice of texts: hash, byte span and first word of each text."""

    def __init__(self, column: pa.Array, is_word: np.ndarray = IS_WORD, lower: bool = True):
        self.data, self.text_at = text_bytes(column)
        if lower:
            self.data = LOWER[self.data]
        self.start, self.end = runs(is_word[self.data], self.text_at)
        self.hash = Spans(self.data).of(self.start, self.end)
        self.at = np.searchsorted(self.start, self.text_at)  # words of text i: at[i] to at[i + 1]


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n neighbouring words in their order; the result is n - 1 shorter."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + size] + np.uint64(k + 1))
    return out


# ---------------------------------------------------------------- packed rows


def squeeze(values: np.ndarray) -> bytes:
    """A numeric array as bytes: equal bytes of all values side by side, compressed."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes() if len(values) else b""
    head = np.array([len(values), values.dtype.itemsize], np.int64).tobytes()
    return head + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def expand(raw: bytes, dtype) -> np.ndarray:
    n, width = np.frombuffer(raw, np.int64, 2)
    if not n:
        return np.zeros(0, dtype)
    planes = pa.decompress(memoryview(raw)[16:], decompressed_size=int(n * width), codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(width, n).T.copy().view(dtype).reshape(n)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as bytes: their differences, compressed."""
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def expand_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(expand(raw, np.uint64), dtype=np.uint64)


def part_bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of the 64-bit keys begins in sorted keys."""
    edges = np.array([(i << 64) // parts for i in range(parts)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))
