"""Elements of large JSON documents as a Spark data source, ``json_elements``.

A document is cut into the elements of its named arrays, one row each, and a header
row with its other fields; a document that cannot be read to its end has an error row
besides. So no row is larger than one element, and a broken file never fails its
neighbours. Files are partitions (several small ones may share one); filters on ``kind``
and ``code`` are taken by the source, which then does not even cut out the rates of
other codes. Fields are parsed by ``from_json`` on the JVM side.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull

from ratescape.schemas import HEADER, INDEX_ENTRY, ITEM_HEAD, NEGOTIATED_RATE, PROVIDER_GROUP, PROVIDER_REFERENCE, TOC_STRUCTURE, VENDOR_FILE
from ratescape.session import list_in_few_tasks, materialize, scratch_path
from ratescape.sources.json_walk import walk, walk_rate_file

PIECE_SCHEMA = "source_file_url string, kind string, item_ord long, ord long, code string, body string"
COUNTED = T.StructType([*HEADER.fields, T.StructField("element_count", T.LongType())])


class Layout(NamedTuple):
    """What a kind of document is cut into: the array of a flat document (None: a rate file) and the schema of each kind of row."""

    array: str | None
    kinds: dict[str, T.StructType]


LAYOUTS = {
    "rates": Layout(None, {"header": HEADER, "item": ITEM_HEAD, "rate": NEGOTIATED_RATE, "reference": PROVIDER_REFERENCE}),
    "groups": Layout("provider_groups", {"header": COUNTED, "element": PROVIDER_GROUP}),
    "toc": Layout("reporting_structure", {"header": COUNTED, "element": TOC_STRUCTURE}),
    "index": Layout("in_network_files", {"header": COUNTED, "element": INDEX_ENTRY}),
    "vendor": Layout("files", {"header": COUNTED, "element": VENDOR_FILE}),
}
#: Files of one partition where there are many more files than cores.
FILES_PER_TASK = 16
BATCH_ROWS, BATCH_BYTES = 2_000, 8_000_000


# --- the data source ------------------------------------------------------


class _Files(InputPartition):
    def __init__(self, files: tuple[tuple[str, str], ...]):
        self.files = files


def _flat_pieces(path: str, array: str) -> Iterator[tuple]:
    count = 0
    for event, _, ord_, _, payload in walk(path, {array: None}, 3):
        if event == "leaf":
            yield "element", -1, ord_, None, payload.decode("utf-8")
        elif event == "close":
            count += ord_
        elif event == "document":
            yield "header", -1, -1, None, json.dumps({**payload, "element_count": count})


class ElementReader(DataSourceReader):
    """``listing`` is a Parquet table of paths and the names that rows have them by, ``layout`` a name of LAYOUTS, ``codes`` a pattern of the codes whose rates are wanted."""

    def __init__(self, options: dict):
        self.layout = LAYOUTS[options["layout"]]
        self.listing = options["listing"]
        self.codes: str | frozenset[str] = frozenset(json.loads(options["codeset"])) if "codeset" in options else options.get("codes", ".*")
        self.files_per_task = int(options.get("filesPerTask", "1"))
        self.kinds: frozenset[str] | None = None
        self.only: frozenset[str] | None = None

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute if isinstance(f, EqualTo | In | IsNotNull) else ()
            if column in (("kind",), ("code",)) and not isinstance(f, IsNotNull):
                values = frozenset(f.value if isinstance(f, In) else [f.value])
                name = "kinds" if column == ("kind",) else "only"
                known = getattr(self, name)
                setattr(self, name, values if known is None else known & values)
            elif column != ("kind",):
                yield f

    def partitions(self):
        import pyarrow.parquet as pq
        from pyarrow import fs

        place = self.listing if "://" in self.listing or self.listing.startswith("file:") else f"file://{self.listing}"
        filesystem, inner = fs.FileSystem.from_uri(place)
        rows = pq.read_table(inner, columns=["path", "name"], filesystem=filesystem).to_pylist()
        files, n = [(r["path"], r["name"]) for r in rows], self.files_per_task
        return [_Files(tuple(files[i : i + n])) for i in range(0, len(files), n)] or [_Files(())]

    def _pieces(self, path: str) -> Iterator[tuple]:
        wanted = self.only if self.only is not None and self.codes == ".*" else self.codes
        try:
            yield from walk_rate_file(path, wanted) if self.layout.array is None else _flat_pieces(path, self.layout.array)
        except (OSError, ValueError) as error:
            yield "error", -1, -1, type(error).__name__, str(error)

    def read(self, partition: _Files):
        import pyarrow as pa

        names = ["source_file_url", "kind", "item_ord", "ord", "code", "body"]
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

        def pack(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names)

        for path, name in partition.files:
            rows, size = [], 0
            for row in self._pieces(path):
                if self.kinds is not None and row[0] not in self.kinds or self.only is not None and row[3] not in self.only:
                    continue
                rows.append((name, *row))
                size += len(row[-1])
                if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield pack(rows)
                    rows, size = [], 0
            if rows:
                yield pack(rows)


class ElementSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_elements"

    def schema(self) -> str:
        return PIECE_SCHEMA

    def reader(self, schema) -> ElementReader:
        return ElementReader(self.options)


# --- reading --------------------------------------------------------------


def file_paths(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One ``path`` per file in folders, globs or lists of files; contents are not read."""
    list_in_few_tasks(spark)
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path")


def read_tasks(paths: DataFrame) -> int:
    """Tasks for reading files front to back: all cores busy, a few files each when there are many."""
    files = paths.count()
    cores = paths.sparkSession.sparkContext.defaultParallelism
    return max(1, min(files, max(4 * cores, files // FILES_PER_TASK)))


def read_elements(paths: DataFrame, layout: str, codes: str | frozenset[str] | None = None, tasks: int | None = None) -> DataFrame:
    """Rows of the documents at ``paths`` (one ``path`` per row), unparsed.

    With a column ``name``, that is the rows' ``source_file_url``, else the path is.
    A path listed twice is read twice. ``codes`` is a pattern or a set; rates whose
    code comes first in their item and is not in it are left out.
    """
    spark = paths.sparkSession
    spark.dataSource.register(ElementSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    listing = scratch_path(spark, "listing")
    name = F.col("name") if "name" in paths.columns else F.col("path")
    paths.select("path", name.alias("name")).write.parquet(listing)
    listed = spark.read.schema("path string").parquet(listing)
    files = listed.count()
    reader = spark.read.format("json_elements").option("listing", listing).option("layout", layout)
    if codes is not None:
        reader = reader.option("codes", codes) if isinstance(codes, str) else reader.option("codeSet", json.dumps(sorted(codes)))
    return reader.option("filesPerTask", max(1, -(-files // (tasks or read_tasks(listed))))).load()


def _checked(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])


def landed_schema(layout: str) -> T.StructType:
    """Columns of a landing: a typed column per kind of row."""
    plain = [("source_file_url", T.StringType()), ("item_ord", T.LongType()), ("ord", T.LongType()), ("code", T.StringType()), ("error", T.StringType())]
    kinds = [(kind, _checked(schema)) for kind, schema in LAYOUTS[layout].kinds.items()]
    return T.StructType([T.StructField(n, t) for n, t in [*plain, *kinds, ("kind", T.StringType())]])


def land_elements(paths: DataFrame, layout: str, landing: str, codes: str | frozenset[str] | None = None, tasks: int | None = None) -> None:
    """Read every file once and write its elements, parsed once, as a Parquet table by kind."""
    kind = F.col("kind")
    kinds = LAYOUTS[layout].kinds
    (
        read_elements(paths, layout, codes, tasks)
        .withColumn("error", F.when(kind == "error", F.col("body")))
        .withColumns({k: F.when(kind == k, F.from_json("body", _checked(schema))) for k, schema in kinds.items()})
        .select(*landed_schema(layout).fieldNames())
        .write.mode("overwrite")
        .partitionBy("kind")
        .option("compression", "zstd")
        .parquet(landing)
    )


def landed_elements(spark: SparkSession, landing: str, layout: str) -> DataFrame:
    return spark.read.schema(landed_schema(layout)).parquet(landing)


def kind_of(pieces: DataFrame, layout: str, kind: str, *more: str | Column) -> DataFrame:
    """Rows of one kind with their fields."""
    fields = [F.col(f"{kind}.{name}") for name in LAYOUTS[layout].kinds[kind].fieldNames()]
    return pieces.filter(F.col("kind") == kind).select("source_file_url", *more, *fields)


def landing_errors(pieces: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """(source_file_url, error_type, error) of files that could not be read or have a row of ``kinds`` that breaks its schema.

    Found once and stored: every table of a landing leaves these files out.
    """
    unread = pieces.filter(F.col("kind") == "error").select("source_file_url", F.col("code").alias("error_type"), "error")
    for kind in kinds:
        broken = pieces.filter((F.col("kind") == kind) & F.col(f"{kind}._corrupt_record").isNotNull())
        unread = unread.union(broken.select("source_file_url", F.lit("ValueError"), F.lit(f"a {kind} breaks the schema")))
    first = F.min(F.struct("error_type", "error")).alias("first")
    return materialize(unread.groupBy("source_file_url").agg(first).select("source_file_url", "first.*"), "errors")


class Documents(NamedTuple):
    """Tables of flat documents: headers with ``element_count``, elements with ``ord``, and errors of files that have neither."""

    headers: DataFrame
    elements: DataFrame
    errors: DataFrame


def read_documents(spark: SparkSession, paths: str | list[str] | DataFrame, layout: str, source: Column | None = None) -> Documents:
    """The documents of a layout; ``source`` renames them, from ``source_file_url``."""
    listed = paths if isinstance(paths, DataFrame) else file_paths(spark, paths)
    landing = scratch_path(spark, f"landing-{layout}")
    land_elements(listed, layout, landing)
    pieces = landed_elements(spark, landing, layout)
    errors = landing_errors(pieces, ("element",))
    sound = pieces.join(errors.select("source_file_url"), "source_file_url", "left_anti")
    found = Documents(kind_of(sound, layout, "header"), kind_of(sound, layout, "element", "ord"), errors)
    return found if source is None else Documents(*[t.withColumn("source_file_url", source) for t in found])
