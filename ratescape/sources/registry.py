"""Provider registry: wide CSV to one narrow row per provider."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescape import reference_values as ref
from ratescape.functions.columns import primary_taxonomy


def taxonomy_columns(slots: int) -> tuple[list[str], list[str]]:
    numbers = range(1, slots + 1)
    return (
        [ref.TAXONOMY_CODE_COLUMN.format(i) for i in numbers],
        [ref.TAXONOMY_SWITCH_COLUMN.format(i) for i in numbers],
    )


def registry_columns(slots: int = ref.TAXONOMY_SLOTS) -> list[str]:
    codes, switches = taxonomy_columns(slots)
    return [*ref.REGISTRY_COLUMNS, *codes, *switches]


def read_registry_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Registry lines as text, named by the file's header.

    Only the columns that later steps name are parsed out of the few hundred
    in the public file. Lines hold no line breaks, so large files split.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(path)
    )


def npi_registry(
    lines: DataFrame,
    slots: int = ref.TAXONOMY_SLOTS,
    null_tokens: Sequence[str] = ref.REGISTRY_NULLS,
) -> DataFrame:
    """npi, entity type, names and primary taxonomy; rows without NPI go."""
    code_names, switch_names = taxonomy_columns(slots)
    clean = {name: F.when(~F.col(name).isin(*null_tokens), F.col(name)) for name in registry_columns(slots)}
    taxonomy = primary_taxonomy(
        [clean[name] for name in code_names], [clean[name] for name in switch_names]
    )
    columns = [clean[name].alias(alias) for name, alias in ref.REGISTRY_COLUMNS.items()]
    return lines.select(*columns, taxonomy.alias("primary_taxonomy")).filter(
        F.col("npi").isNotNull()
    )


def write_registry(registry: DataFrame, path: str, mode: str = "overwrite") -> None:
    registry.write.mode(mode).option("compression", "snappy").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
