"""Payer indexes: tables of contents, native indexes, hosted-vendor metadata."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratescape import reference_values as ref
from ratescape.functions.columns import absolute_url
from ratescape.schemas import HEADER_FIELDS, PLAN
from ratescape.session import release_shuffles
from ratescape.sources.elements import Documents, read_documents

PLAN_FIELDS = PLAN.fieldNames()
_PLANS = f"array<{PLAN.simpleString()}>"
LISTING_FIELDS = ("description", "content_length_bytes", "location", "reporting_plan_count", "reporting_plans")
INDEX_COLUMNS = ("location", "description", "content_length_bytes", "reporting_plan_count")


# --- table of contents ----------------------------------------------------


def read_toc(spark: SparkSession, paths: str | list[str] | DataFrame, source: Column | None = None) -> Documents:
    """Tables of contents of any size: headers, reporting structures and errors of documents that give neither."""
    return read_documents(spark, paths, "toc", source)


def toc_structures(toc: Documents) -> DataFrame:
    """One row per reporting structure, with its place in the document; null entries go."""
    return toc.elements.withColumnRenamed("ord", "structure_ord")


def toc_files(structures: DataFrame) -> DataFrame:
    """One row per listed file with a usable location.

    ``plan_count`` is the number of plans of the file's structure. Entries
    without a location, or with an empty one, are skipped.
    """
    return _listed_files(structures)


def _listed_files(structures: DataFrame, *more: Column) -> DataFrame:
    """``toc_files`` with named columns of the structures besides."""
    names = structures.select(*more).columns
    return (
        structures.select(
            "source_file_url",
            "structure_ord",
            plan_count(F.col("reporting_plans")).alias("reporting_plan_count"),
            *more,
            F.posexplode("in_network_files").alias("file_ord", "f"),
        )
        .filter(F.col("f.location") != "")
        .select(
            "source_file_url",
            "structure_ord",
            "file_ord",
            F.col("f.location").alias("location"),
            F.col("f.description").alias("description"),
            F.lit(None).cast("long").alias("content_length_bytes"),
            "reporting_plan_count",
            *names,
        )
    )


def plan_count(plans: Column) -> Column:
    """Number of plan objects in a list; null entries do not count."""
    return F.coalesce(F.size(F.filter(plans, lambda p: p.isNotNull())), F.lit(0)).cast("long")


def toc_file_plans(structures: DataFrame) -> DataFrame:
    """One row per (file, plan), in document order.

    A file shared by many plans may list them without bound, so plans stay
    rows and are never gathered into one list.
    """
    return (
        structures.select(
            "source_file_url",
            "structure_ord",
            "reporting_plans",
            F.posexplode("in_network_files").alias("file_ord", "f"),
        )
        .filter(F.col("f.location") != "")
        .select(
            "source_file_url",
            "structure_ord",
            "file_ord",
            F.col("f.location").alias("location"),
            F.posexplode("reporting_plans").alias("plan_ord", "plan"),
        )
        .filter(F.col("plan").isNotNull())
        .select("source_file_url", "structure_ord", "file_ord", "plan_ord", "location", "plan.*")
    )


class PlanClasses(NamedTuple):
    """Plan lists told apart by content.

    * listings: (location, plan_class, listings), how often a file is listed with that list of plans;
    * members: (plan_class, plan_ord) with the fields of a plan, each distinct list once.
    """

    listings: DataFrame
    members: DataFrame


def plan_classes(structures: DataFrame) -> PlanClasses:
    """Files and plans without their product: many files and structures share few plan lists.

    A class is the SHA-256 of the list, in its order, without null entries. Empty
    lists have no class. Counting combines on the map side, so a list that a third of all
    structures share is no hot group; files x plans exist only after ``expand_plans``.
    """
    listed = structures.select(F.filter("reporting_plans", lambda p: p.isNotNull()).alias("plans"), "in_network_files").filter(F.size("plans") > 0)
    coded = listed.withColumn("plan_class", F.sha2(F.to_json("plans"), 256))
    listings = (
        coded.select(F.explode("in_network_files.location").alias("location"), "plan_class")
        .filter(F.col("location") != "")
        .groupBy("location", "plan_class")
        .agg(F.count(F.lit(1)).alias("listings"))
    )
    distinct = coded.groupBy("plan_class").agg(F.any_value("plans").alias("plans"))
    members = distinct.select("plan_class", F.posexplode("plans").alias("plan_ord", "plan")).select("plan_class", "plan_ord", "plan.*")
    return PlanClasses(listings, members)


def plan_class_sizes(classes: PlanClasses) -> DataFrame:
    """(plan_class, plans, files, listings): the links of a class without expanding it."""
    files = classes.listings.groupBy("plan_class").agg(F.count(F.lit(1)).alias("files"), F.sum("listings").alias("listings"))
    return classes.members.groupBy("plan_class").agg(F.count(F.lit(1)).alias("plans")).join(files, "plan_class", "left").fillna(0, ["files", "listings"])


def expand_plans(classes: PlanClasses) -> DataFrame:
    """(location, listings) with plan_ord and the fields of a plan: all files x plans, on request."""
    return classes.listings.join(classes.members, "plan_class").select("location", "listings", "plan_ord", *PLAN_FIELDS)


def dedupe_files(files: DataFrame, order: list[str]) -> DataFrame:
    """One row per location: first known description and length, plans added up.

    ``order`` names the columns that give the listing order. The result has
    ``first_seen``, the place of a location's first listing.
    """
    place = F.struct(*order)

    def first_known(column: str) -> Column:
        return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), place)).alias(column)

    return files.groupBy("location").agg(
        first_known("description"),
        first_known("content_length_bytes"),
        F.sum("reporting_plan_count").alias("reporting_plan_count"),
        F.min(place).alias("first_seen"),
    )


TOC_ORDER = ["source_file_url", "structure_ord", "file_ord"]


def index_headers(toc: Documents, files: DataFrame) -> DataFrame:
    """Header, structure count and listed files of every document."""
    counts = files.groupBy("source_file_url").agg(
        F.count_distinct("location").alias("in_network_file_count")
    )
    return (
        toc.headers.select("source_file_url", *HEADER_FIELDS, F.col("element_count").alias("reporting_structure_count"))
        .join(counts, "source_file_url", "left")
        .withColumn("in_network_file_count", F.coalesce("in_network_file_count", F.lit(0)))
    )


def write_index(files: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Index rows as JSON lines, one file listing per line."""
    files.write.mode(mode).option("ignoreNullFields", False).json(path)


#: Structures whose listings make up one written index document.
STRUCTURES_PER_PIECE = 10_000


def toc_listings(structures: DataFrame) -> DataFrame:
    """``toc_files`` with the plans of each listing; a row has no more plans than its structure."""
    return _listed_files(structures, F.filter("reporting_plans", lambda p: p.isNotNull()).alias("reporting_plans"))


def write_index_documents(headers: DataFrame, entries: DataFrame, path: str, structures_per_piece: int = STRUCTURES_PER_PIECE) -> None:
    """Index documents, as ``read_native_index`` reads them: header fields, then listings in their order.

    ``headers`` is from ``index_headers``. ``entries`` has source_file_url, structure_ord,
    file_ord, location, description, content_length_bytes, reporting_plan_count and, where
    plans are wanted, reporting_plans. The listings of every ``structures_per_piece`` structures
    make one document with the whole header, below ``document=<hash>/piece=<number>``: so
    documents are bounded whatever the index, paths sort in listing order, and each is
    valid JSON of its own. A source without listings has one document without any. A location
    listed more than once is written as often as ``entries`` has it; plans add up again by
    ``dedupe_files``. Written anew, a folder is replaced.
    """
    document = F.sha2("source_file_url", 256).alias("document")
    piece = F.floor(F.col("structure_ord") / F.lit(structures_per_piece)).cast("long")
    kept = [c for c in LISTING_FIELDS if c in entries.columns]
    body = F.to_json(F.struct(*kept), {"ignoreNullFields": "false"})
    listings = entries.select("source_file_url", document, piece.alias("number"), "structure_ord", "file_ord", body.alias("line"))
    pieces = listings.select("source_file_url", "number").union(headers.select("source_file_url", F.lit(0).cast("long"))).distinct()
    head = F.to_json(F.struct(F.col("source_file_url").alias("source"), *HEADER_FIELDS, "reporting_structure_count", "in_network_file_count"), {"ignoreNullFields": "false"})
    opening = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"in_network_files":['))
    opened = pieces.join(headers, "source_file_url").select("source_file_url", document, "number", opening.alias("opening"))
    none = F.lit(-1).cast("long")
    lines = listings.select("document", "number", F.lit(1).alias("section"), "structure_ord", "file_ord", "line")
    for section, line in ((0, F.col("opening")), (2, F.lit("]}"))):
        lines = lines.unionByName(opened.select("document", "number", F.lit(section).alias("section"), none.alias("structure_ord"), none.cast("int").alias("file_ord"), line.alias("line")))
    lines = lines.select("document", F.lpad(F.col("number").cast("string"), 12, "0").alias("piece"), "section", "structure_ord", "file_ord", "line")
    keys, order = ("document", "piece"), ("section", "structure_ord", "file_ord", "line")
    before = F.lag("section").over(Window.partitionBy(*keys).orderBy(*order))  # a piece is bounded
    comma = F.when((F.col("section") == 1) & (before == 1), ",").otherwise("")
    # Dealt and sorted once: the window, the order within a file and the files all need the same.
    spark = entries.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    (
        lines.repartition(tasks, *keys)
        .withColumn("text", F.concat(comma, "line"))
        .sortWithinPartitions(*keys, *order)
        .select(*keys, F.col("text").alias("line"))
        .write.mode("overwrite")
        .partitionBy(*keys)
        .option("compression", "gzip")
        .text(path)
    )
    release_shuffles(spark)


# --- native index ---------------------------------------------------------


def read_native_index(spark: SparkSession, paths: str | list[str] | DataFrame, source: Column | None = None) -> DataFrame:
    """Files of ``{"in_network_files": [...]}`` documents, in listing order.

    An entry needs a location; an empty one is kept.
    """
    return index_entries(read_documents(spark, paths, "index", source))


def index_entries(index: Documents) -> DataFrame:
    entries = index.elements.filter(F.col("location").isNotNull())
    return entries.select("source_file_url", F.col("ord").alias("file_ord"), "location", "description", "content_length_bytes")


def index_listings(index: Documents) -> DataFrame:
    """``index_entries`` with plan counts and plans, where a document has them."""
    entries = index.elements.filter(F.col("location").isNotNull())
    return entries.select("source_file_url", F.col("ord").alias("file_ord"), *LISTING_FIELDS)


# --- hosted-vendor metadata -----------------------------------------------


def read_vendor_metadata(spark: SparkSession, paths: str | list[str] | DataFrame, source: Column | None = None) -> DataFrame:
    """One row per file entry of vendor metadata, in listing order; null entries go."""
    return vendor_entries(read_documents(spark, paths, "vendor", source))


def vendor_entries(metadata: Documents) -> DataFrame:
    return metadata.elements.withColumnRenamed("ord", "file_ord")


def vendor_files(entries: DataFrame, base_url: str) -> DataFrame:
    """Rate files among vendor entries, with absolute locations."""
    return entries.filter(F.col("fileSchema") == ref.VENDOR_RATE_SCHEMA).select(
        "source_file_url",
        "file_ord",
        absolute_url(base_url, F.col("filePath")).alias("location"),
        F.col("fileName").alias("description"),
        F.lit(None).cast("long").alias("content_length_bytes"),
        F.coalesce(F.size("reportingPlans"), F.lit(0)).cast("long").alias("reporting_plan_count"),
        F.transform(
            "reportingPlans",
            lambda p: F.struct(
                p["planName"].alias("plan_name"),
                p["planIdType"].alias("plan_id_type"),
                p["planId"].alias("plan_id"),
                F.lit(None).cast("string").alias("issuer_name"),
                p["planMarketType"].alias("plan_market_type"),
                F.lit(None).cast("string").alias("plan_sponsor_name"),
            ),
        ).alias("reporting_plans"),
    )


def vendor_index(entries: DataFrame, base_url: str) -> DataFrame:
    """Vendor entries as index rows, one per location.

    The description is that of the first listing, even where it is null.
    """
    place = F.struct("source_file_url", "file_ord")
    return (
        vendor_files(entries, base_url)
        .groupBy("location")
        .agg(
            F.min_by(F.struct("description"), place).alias("first"),
            F.sum("reporting_plan_count").alias("reporting_plan_count"),
            F.min(place).alias("first_seen"),
        )
        .select(
            "location",
            "first.description",
            F.lit(None).cast("long").alias("content_length_bytes"),
            "reporting_plan_count",
            "first_seen",
        )
    )


def vendor_file_plans(entries: DataFrame, base_url: str) -> DataFrame:
    """One row per (location, plan) of vendor entries, in listing order."""
    return vendor_files(entries, base_url).select(
        "source_file_url",
        "file_ord",
        "location",
        F.posexplode("reporting_plans").alias("plan_ord", "plan"),
    ).select("source_file_url", "file_ord", "plan_ord", "location", "plan.*")


def vendor_header(entries: DataFrame, base_url: str) -> DataFrame:
    """Index header per metadata document, taken from its first entry; files count by location."""
    return entries.groupBy("source_file_url").agg(
        F.min_by("reportingEntityName", "file_ord").alias("reporting_entity_name"),
        F.lit(None).cast("string").alias("reporting_entity_type"),
        F.min_by("lastUpdatedOn", "file_ord").alias("last_updated_on"),
        F.lit(None).cast("string").alias("version"),
        F.count(F.lit(1)).alias("reporting_structure_count"),
        F.count_distinct(
            F.when(F.col("fileSchema") == ref.VENDOR_RATE_SCHEMA, absolute_url(base_url, F.col("filePath")))
        ).alias("in_network_file_count"),
    )
