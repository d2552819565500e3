"""Quick look at rate files: which ones hold codes of a profile?"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescape.functions.profiles import CodeProfile
from ratescape.sources.json_walk import walk_codes
from ratescape.sources.elements import read_tasks


def probe_paths(
    paths: DataFrame,
    profile: CodeProfile,
    limit_items: int | None = None,
    stop_on_match: bool = True,
    tasks: int | None = None,
) -> DataFrame:
    """One row per file of ``paths`` (one ``path`` per row), of any size.

    Looks at the first ``limit_items`` items only, if given, and at none past the
    first match unless ``stop_on_match`` is off.

    Python only lists the codes of a file with their positions, up to
    ``limit_items``; matching and summing up is Spark's. A file that cannot be
    read becomes an ``error`` row, unless its first match lies before the fault
    and the first match is all that is asked for.
    """

    def listed(batches):
        import pyarrow as pa

        def rows(path, positions, codes, error=None):
            n = len(positions)
            return pa.RecordBatch.from_pydict(
                {"source": [path] * n, "position": positions, "code": codes, "error": [error] * n},
                schema=pa.schema([("source", pa.string()), ("position", pa.int64()), ("code", pa.string()), ("error", pa.string())]),
            )

        for batch in batches:
            for path in batch.column(0).to_pylist():
                codes: list[str] = []
                done, error = 0, None
                try:
                    for code in itertools.islice(walk_codes(path), limit_items and max(1, limit_items)):
                        codes.append(code)
                        if len(codes) == 10_000:
                            yield rows(path, list(range(done + 1, done + 10_001)), codes)
                            done, codes = done + 10_000, []
                except (OSError, ValueError) as fault:
                    error = str(fault)
                yield rows(path, list(range(done + 1, done + len(codes) + 1)), codes)
                yield rows(path, [0], [None], error)  # a file without items has this row alone

    hit = profile.contains(F.col("code"))
    files = (
        paths.select("path")
        .repartition(tasks or read_tasks(paths))
        .mapInArrow(listed, "source string, position long, code string, error string")
        .groupBy("source")
        .agg(
            F.max("position").alias("items"),
            F.min(F.when(hit, F.struct("position", "code"))).alias("first"),
            F.array_sort(F.collect_set(F.when(hit, F.col("code")))).alias("codes"),
            F.max("error").alias("error"),
        )
    )
    found = F.col("first").isNotNull()
    fine = F.col("error").isNull() | (found if stop_on_match else F.lit(False))
    codes = F.array("first.code") if stop_on_match else F.col("codes")
    scanned = F.when(found, F.col("first.position")).otherwise(F.col("items")) if stop_on_match else F.col("items")
    return files.select(
        "source",
        F.when(fine, "ok").otherwise("error").alias("status"),
        scanned.alias("items_scanned"),
        (fine & found).alias("has_match"),
        F.when(fine & found, codes).otherwise(F.array().cast("array<string>")).alias("matched_codes"),
        F.when(~fine, F.col("error")).alias("error"),
    )


PROBE_SCHEMA = "source string, status string, items_scanned long, has_match boolean, matched_codes array<string>, error string"


def write_probe(results: DataFrame, path: str) -> None:
    """Append probe results as JSON lines, so that a probe can go on where one stopped."""
    results.select("error", "has_match", "items_scanned", "matched_codes", "source", "status").write.mode("append").option("ignoreNullFields", False).json(path)


def read_probe(spark: SparkSession, path: str) -> DataFrame:
    """Written results, one row per source: a hit before a miss, a miss before an error."""
    best = F.max(F.struct("has_match", (F.col("status") == "ok").alias("ok"), "items_scanned", "matched_codes", "error")).alias("best")
    rows = spark.read.schema(PROBE_SCHEMA).json(path).groupBy("source").agg(best)
    return rows.select("source", F.when(F.col("best.ok"), "ok").otherwise("error").alias("status"), *[f"best.{c}" for c in ("items_scanned", "has_match", "matched_codes", "error")])


def probed_files(files: DataFrame, results: DataFrame) -> DataFrame:
    """Index files whose location a probe found to hold codes of the profile."""
    hits = results.filter("has_match").select(F.col("source").alias("location"))
    return files.join(hits, "location", "left_semi")


def probe_summary(results: DataFrame) -> DataFrame:
    """Files, hits, errors and misses of a probe."""
    return results.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if("has_match").alias("with_match"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.count_if(~F.col("has_match") & (F.col("status") != "error")).alias("without_match"),
    )
