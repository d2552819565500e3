"""In-network rate files: nested JSON to rate entries and provider references.

Every file is read once, front to back, by the ``json_elements`` source and lands as
a typed table of its elements: no task holds a whole document, and a file that
cannot be read becomes an error row.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescape.functions.profiles import CodeProfile
from ratescape.schemas import HEADER_FIELDS, ITEM_FIELDS
from ratescape.session import scratch_path
from ratescape.sources.elements import file_paths, kind_of, land_elements, landed_elements, landing_errors

RATE_FIELDS = ("provider_groups", "provider_references", "negotiated_prices")
ENTRY_COLUMNS = ("source_file_url", *HEADER_FIELDS, "item_ord", *ITEM_FIELDS, "rate_ord", *RATE_FIELDS)


@dataclass(frozen=True)
class RateFiles:
    """Tables of a set of rate files, keyed by ``source_file_url``.

    * headers: the four header fields, one row per file;
    * items: (item_ord, billing_code) of every in-network item;
    * entries: one row per negotiated rate of a profile code, with header and
      item fields; groups, reference ids and prices stay nested;
    * references: one row per ref_id with its provider groups, or with the
      location of the file that has them (see ``remote_references``);
    * errors: (error_type, error) of files that could not be read.
    """

    headers: DataFrame
    items: DataFrame
    entries: DataFrame
    references: DataFrame
    errors: DataFrame


def last_reference(references: DataFrame) -> DataFrame:
    """One row per (file, id): the last definition wins, null ids are skipped.

    ``location`` is that of a definition without groups of its own; an empty one is none.
    """
    named = F.when(F.col("provider_groups").isNull() & (F.col("location") != ""), F.col("location"))
    last = F.max_by(F.struct(F.col("provider_groups").alias("ref_groups"), named.alias("location")), "ord")
    return (
        references.filter(F.col("provider_group_id").isNotNull())
        .groupBy("source_file_url", F.col("provider_group_id").alias("ref_id"))
        .agg(last.alias("last"))
        .select("source_file_url", "ref_id", "last.*")
    )


def read_rate_files(spark: SparkSession, paths: str | list[str] | DataFrame, profile: CodeProfile | None, source: Column | None = None) -> RateFiles:
    """Tables of the files in folders, globs or lists, or of a table with one ``path`` per row.

    ``source`` renames the files, from ``source_file_url``.
    """
    landing = scratch_path(spark, "landing")
    land_rate_files(paths if isinstance(paths, DataFrame) else file_paths(spark, paths), landing, profile)
    files = landed_rate_files(spark, landing, profile)
    if source is None:
        return files
    return replace(files, **{f.name: getattr(files, f.name).withColumn("source_file_url", source) for f in fields(files)})


def land_rate_files(
    paths: DataFrame, landing: str, profile: CodeProfile | None = None, tasks: int | None = None
) -> None:
    """Walk every file once and write its pieces as a Parquet table.

    ``paths`` has one ``path`` per row. A file is read front to back by one
    task, since a gzip stream cannot be split; the written pieces can, so one
    huge file feeds all later tasks. With a profile, rates of codes known to
    be outside it are dropped at once; without one, other profiles can use the
    same landing. Each kept piece is parsed here, once, into typed columns.
    """
    land_elements(paths, "rates", landing, profile.wanted if profile else None, tasks)


def landed_rate_files(spark: SparkSession, landing: str, profile: CodeProfile | None) -> RateFiles:
    """Tables of the pieces written by ``land_rate_files``; without a profile, of all codes.

    A file with a rate or reference that breaks the schema is in ``errors`` and
    in no other table. Rates left out at landing are not checked.
    """
    pieces = landed_elements(spark, landing, "rates")
    errors = landing_errors(pieces, ("rate", "reference"))
    broken = errors.select("source_file_url")
    headers = kind_of(pieces, "rates", "header").join(broken, "source_file_url", "left_anti")
    items = kind_of(pieces, "rates", "item", "item_ord")
    kept = pieces.filter(F.col("code").isNull() | _inside(profile, F.col("code")))
    rates = kind_of(kept, "rates", "rate", F.col("item_ord").alias("of_item"), F.col("ord").alias("rate_ord")).withColumnRenamed("source_file_url", "of_file")
    heads = items.filter(_inside(profile, F.col("billing_code"))).join(headers, "source_file_url")
    of_head = (F.col("of_file") == F.col("source_file_url")) & (F.col("of_item") == F.col("item_ord"))
    references = kind_of(pieces, "rates", "reference", "ord").join(broken, "source_file_url", "left_anti")
    return RateFiles(
        headers=headers,
        items=items.join(broken, "source_file_url", "left_anti").select("source_file_url", "item_ord", "billing_code"),
        # Header and item meet first, one row per item, so that the rates are shuffled once. The file's name is the
        # head's: who leaves files out of the entries by it leaves out heads, before the rates meet them.
        entries=rates.join(heads, of_head).select(*ENTRY_COLUMNS),
        references=last_reference(references),
        errors=errors,
    )


def _inside(profile: CodeProfile | None, code: Column) -> Column:
    return F.lit(True) if profile is None else profile.contains(code)
