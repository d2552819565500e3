"""Rate entries to rate-table rows: reference resolution and flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescape.functions.columns import component_flags, empty_if_null, rate_and_percentage
from ratescape.functions.profiles import CodeProfile
from ratescape.schemas import ITEM_FIELDS, PROVIDER_GROUP, RATE_COLUMNS
from ratescape.sources.rate_files import RateFiles

MISSING_MODES = ("error", "quarantine", "skip")


_GROUPS = f"array<{PROVIDER_GROUP.simpleString()}>"


def resolve_references(entries: DataFrame, references: DataFrame) -> DataFrame:
    """One row per entry and origin of its provider groups, with ``groups``; null groups mark a reference that is missing.

    Inline groups are one origin with a null ``ref_id``, each reference id is another;
    duplicates stay. Only entries with references are shuffled to meet them, without their inline groups.
    Groups stay nested through the join. A reference defined in its file matches
    one row, so a frequent id never multiplies rows; one from a file of its own
    matches a row per group. Adaptive execution splits the partition of a frequent id.
    """
    known = references.select("source_file_url", "ref_id", empty_groups("ref_groups").alias("groups"))
    inline = (
        entries.filter(F.size("provider_groups") > 0)
        .withColumn("ref_id", F.lit(None).cast("string"))
        .withColumnRenamed("provider_groups", "groups")
        .drop("provider_references")
    )
    used = (
        entries.withColumn("ref_id", F.explode("provider_references"))
        .filter(F.col("ref_id").isNotNull())
        .drop("provider_groups", "provider_references")
    )
    return inline.unionByName(used.join(known, ["source_file_url", "ref_id"], "left"))


def empty_groups(column: str):
    return F.coalesce(F.col(column), F.array().cast(_GROUPS))


def missing_references(files: RateFiles) -> DataFrame:
    """Distinct (source_file_url, ref_id) that are used but not defined."""
    used = files.entries.select("source_file_url", F.explode("provider_references").alias("ref_id"))
    return used.distinct().join(files.references, ["source_file_url", "ref_id"], "left_anti")


def file_failures(files: RateFiles) -> DataFrame:
    """(source_file_url, error_type, error) of files that cannot be read or use an undefined reference."""
    undefined = missing_references(files).groupBy("source_file_url").agg(F.min("ref_id").alias("ref_id"))
    message = F.concat(F.lit("undefined provider reference "), "ref_id").alias("error")
    return files.errors.unionByName(undefined.select("source_file_url", F.lit("ValueError").alias("error_type"), message))


def flatten_rates(
    files: RateFiles,
    profile: CodeProfile,
    *,
    index_payer: str | None = None,
    on_missing: str = "error",
) -> DataFrame:
    """Rate-table rows: entry x provider group x price.

    ``on_missing`` says what an undefined provider reference does: ``error``
    fails the job, ``quarantine`` leaves out every row of its file, ``skip``
    leaves out that reference only.
    """
    if on_missing not in MISSING_MODES:
        raise ValueError(f"on_missing must be one of: {', '.join(MISSING_MODES)}")
    entries = files.entries
    if on_missing == "quarantine":
        broken = missing_references(files).select("source_file_url").distinct()
        entries = entries.join(broken, "source_file_url", "left_anti")
    resolved = resolve_references(entries, files.references)
    groups = F.col("groups")
    if on_missing == "error":
        message = F.concat(F.lit("undefined provider reference "), F.col("ref_id"))
        groups = F.when(groups.isNull(), F.raise_error(message).cast(_GROUPS)).otherwise(groups)
    rows = (
        resolved.withColumn("group", F.explode(groups))
        .drop("groups")
        .withColumn("price", F.explode("negotiated_prices"))
    )
    modifiers = empty_if_null(F.col("price.billing_code_modifier"))
    amount = F.expr("try_cast(price.negotiated_rate AS double)")
    price = rate_and_percentage(F.col("price.negotiated_type"), amount)
    values = {
        **{name: F.col(name) for name in ITEM_FIELDS},
        "index_payer": F.lit(index_payer).cast("string"),
        "payer_name": F.col("reporting_entity_name"),
        "reporting_entity_type": F.col("reporting_entity_type"),
        "source_file_url": F.col("source_file_url"),
        "last_updated_on": F.col("last_updated_on"),
        "schema_version": F.col("version"),
        **profile.classify(F.col("billing_code")),
        **{
            name: F.col(f"price.{name}")
            for name in (
                "billing_class",
                "setting",
                "negotiated_type",
                "expiration_date",
                "additional_information",
            )
        },
        **price,
        "service_codes": empty_if_null(F.col("price.service_code")),
        "billing_code_modifiers": modifiers,
        **component_flags(modifiers),
        "is_benchmark_eligible": profile.policy.eligible(
            F.col("price.negotiated_type"), price["negotiated_rate"], F.col("price.billing_class")
        ),
        "provider_npi_list": empty_if_null(F.col("group.npi")),
        "provider_tin_type": F.col("group.tin.type"),
        "provider_tin_value": F.col("group.tin.value"),
    }
    return rows.select(*[values[name].alias(name) for name in RATE_COLUMNS])


def parse_counters(files: RateFiles, rates: DataFrame, profile: CodeProfile) -> DataFrame:
    """Items scanned, items matched and rows written per source file."""
    items = files.items.groupBy("source_file_url").agg(
        F.count(F.lit(1)).alias("scanned_items"),
        F.count_if(profile.contains(F.col("billing_code"))).alias("matched_items"),
    )
    written = rates.groupBy("source_file_url").agg(F.count(F.lit(1)).alias("rows_written"))
    return (
        files.headers.select("source_file_url")
        .join(items, "source_file_url", "left")
        .join(written, "source_file_url", "left")
        .select(
            "source_file_url",
            *[
                F.coalesce(name, F.lit(0)).alias(name)
                for name in ("scanned_items", "matched_items", "rows_written")
            ],
        )
    )
