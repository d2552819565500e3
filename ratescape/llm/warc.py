"""Web archives with an index merged from sorted runs.

Every page becomes a WARC record. Records are valid UTF-8, so Spark's text
writer writes the archives, with the end of a record as its line separator;
they can be on any file system Spark knows. Reading cuts an archive by the
Content-Length headers and sorts its captures by URL key, date and page id: a
run. Every run is stored in chunks, and a sample of the chunks' first keys gives
the splitters. The pieces of a key range from all runs are merged by a
loser tree, so ranges together are one globally ordered history of captures.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, the one with
the smallest page id is the response, the others revisit it.

Null html is an empty payload. A null url gives a record without target and an
empty URL key; line breaks in a url are escaped. A null page id is kept and
never referred to (unless nothing else has the payload); rows that share the
smallest id are all responses. No pages give no records.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescape.llm.common import lookup, shared_path, stored, tidy

MIN_REVISIT = 100
#: Records of an archive file at most, captures of a chunk of a run, keys sampled for splitters.
ARCHIVE_RECORDS, CHUNK, SAMPLE = 2_000, 500, 10_000
END = "\r\n\r\n"
CAPTURE = "struct<url_key:string,date:string,page_id:long,payload_bytes:long,payload_digest:string,position:long>"


def write_archives(pages: DataFrame, path: str) -> None:
    """One response record per page. Dates count seconds from 2020 by page id, as pages carry none."""
    payload = F.coalesce("html", F.lit(""))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    date = F.date_format(F.timestamp_seconds(F.lit(1577836800) + F.coalesce(F.col("page_id"), F.lit(0)) % F.lit(1 << 31)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    header = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.lit("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), F.expr("uuid()"), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.sha2(F.encode(payload, "utf-8"), 256)),
        F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string")),
        F.concat(F.lit("Content-Length: "), F.octet_length(payload).cast("string")),
    )
    records = pages.select(F.concat(header, F.lit(END), payload).alias("value"))
    records.write.option("lineSep", END).option("maxRecordsPerFile", ARCHIVE_RECORDS).text(path)


def url_key(url: str | None) -> str:
    """Host labels from the top domain down, then the path; scheme, www and fragment do not count."""
    rest = (url or "").split("#")[0].split("://", 1)[-1]
    host, slash, path = rest.partition("/")
    labels = host.lower().split(".")
    if labels[0] == "www" and len(labels) > 1:
        labels = labels[1:]
    return ",".join(reversed(labels)) + ")" + slash + path if url else ""


def records(content: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """Headers, position and payload of every record of an archive."""
    at = 0
    while at < len(content):
        head = content.index(b"\r\n\r\n", at)
        lines = content[at:head].decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        end = head + 4 + int(headers["Content-Length"])
        if lines[0] != "WARC/1.1" or content[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"no WARC record at {at}")
        yield headers, at, content[head + 4 : end]
        at = end + 4


def _key(capture: dict) -> tuple:
    page = capture["page_id"]
    return capture["url_key"], capture["date"], page is None, page or 0


def _read_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each archive as a run: its captures in order, in chunks."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            run = []
            for headers, at, payload in records(content.as_buffer().to_pybytes()):
                digest = hashlib.sha256(payload).hexdigest()
                if headers["WARC-Payload-Digest"] != f"sha256:{digest}":
                    raise ValueError(f"payload of {path} at {at} is damaged")
                page = headers.get("X-Page-Id")
                key = url_key(headers.get("WARC-Target-URI"))
                run.append(dict(url_key=key, date=headers["WARC-Date"], page_id=int(page) if page else None, payload_bytes=len(payload), payload_digest=digest, position=at))
            run.sort(key=_key)
            chunks = [run[i : i + CHUNK] for i in range(0, len(run), CHUNK)]
            for chunk in chunks:
                yield pa.RecordBatch.from_pylist([{"archive": path, "captures": chunk}], schema=_CHUNK)


_CAPTURE = pa.struct([("url_key", pa.string()), ("date", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("position", pa.int64())])
_CHUNK = pa.schema([("archive", pa.string()), ("captures", pa.list_(_CAPTURE))])


class LoserTree:
    """Merges k sorted lists. Inner nodes keep the losers of their matches, the winner moves up."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key = runs, key
        self.k = max(1, len(runs))
        self.at = [0] * self.k
        self.heads = [self._head(i) for i in range(self.k)]
        self.losers = [-1] * self.k
        winner = [*[-1] * self.k, *range(self.k)]
        for node in range(self.k - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            winner[node], self.losers[node] = (a, b) if self.heads[a] <= self.heads[b] else (b, a)
        self.losers[0] = winner[1] if self.k > 1 else 0

    def _head(self, i: int) -> tuple:
        done = i >= len(self.runs) or self.at[i] >= len(self.runs[i])
        return (True,) if done else (False, self.key(self.runs[i][self.at[i]]), i)

    def __iter__(self):
        while not self.heads[self.losers[0]][0]:
            i = self.losers[0]
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.heads[i] = self._head(i)
            node = (i + self.k) // 2
            while node:
                if self.heads[self.losers[node]] < self.heads[i]:
                    i, self.losers[node] = self.losers[node], i
                node //= 2
            self.losers[0] = i


def _cut(splitters: list[tuple]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("range", pa.int32()), *_CHUNK])
        for batch in batches:
            for row in batch.to_pylist():
                pieces: dict[int, list] = {}
                for capture in row["captures"]:
                    pieces.setdefault(bisect_right(splitters, _key(capture)), []).append(capture)
                yield pa.RecordBatch.from_pylist([{"range": r, "archive": row["archive"], "captures": c} for r, c in pieces.items()], schema=schema)

    return cut


MERGED = "range int, place long, archive string, url_key string, date string, page_id long, payload_bytes long, payload_digest string, position long"


def _merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = []
    for batch in batches:
        for row in batch.to_pylist():
            runs.append([{"archive": row["archive"], **c} for c in row["captures"]])
    schema = pa.schema([("range", pa.int32()), ("place", pa.int64()), ("archive", pa.string()), *_CAPTURE])
    out: list[dict] = []
    for place, capture in enumerate(LoserTree(runs, _key)):
        out.append({"range": key[0].as_py(), "place": place, **capture})
        if len(out) == 5_000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def merged_index(spark: SparkSession, path: str, ranges: int | None = None) -> DataFrame:
    """All captures of the archives below ``path``; by (range, place) they are in global order."""
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    archives = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    runs = stored(archives.mapInArrow(tidy(_read_runs), f"archive string, captures array<{CAPTURE}>"), "warc-runs")
    chunks = runs.count()
    step = F.lit(chunks // SAMPLE + 1)
    first = runs.select(F.col("captures")[0].alias("c")).where(F.pmod(F.xxhash64("c.url_key", "c.page_id"), step) == 0)
    sampled = sorted(_key(r.c.asDict()) for r in first.collect())  # about SAMPLE keys
    splitters = [sampled[i * len(sampled) // ranges] for i in range(1, ranges)] if sampled else []
    pieces = runs.mapInArrow(tidy(_cut(splitters)), f"range int, archive string, captures array<{CAPTURE}>")
    return pieces.groupBy("range").applyInArrow(_merge, MERGED)


def capture_histories(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Writes the pages to archives, reads them back and returns the index with record_type and refers_to."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_archives(pages, path)
    index = stored(merged_index(spark, path), "warc-index")
    repeated = index.where(F.col("payload_bytes") >= min_revisit).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = lookup(index, repeated, ["payload_digest"], "position")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        *index.columns, F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to")
    )
