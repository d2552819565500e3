"""Contract schedule: read and clean a customer's own rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescape import reference_values as ref
from ratescape.functions.columns import first_credential
from ratescape.schemas import CONTRACT_COLUMNS


def read_contracts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw schedule lines as text, named by the header; absent columns are null.

    ``line_order`` tells the place of a line: file, block of the file, line in
    the block. A byte-order mark before the header is skipped by the line reader.
    """
    lines = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(path)
    )
    absent = {name: F.lit(None).cast("string") for name in CONTRACT_COLUMNS if name not in lines.columns}
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return lines.select("*", place.alias("line_order")).withColumns(absent)


def contract_rates(
    lines: DataFrame,
    order: Column | None = None,
    codes: Sequence[str] = ref.ABA_CODES,
    credentials: Sequence[str] = ref.CREDENTIAL_MODIFIERS,
) -> DataFrame:
    """First rate per (customer, code, credential) in line order.

    Lines with another code or without a numeric rate are dropped. ``order`` is
    the place that ``read_contracts`` adds, unless another column is given. That
    place is not deterministic to Spark: store the result before a scalar
    subquery, such as ``mark_contract_bin``, uses it.
    """
    rate = F.expr("try_cast(trim(ContractRatePerUnit) AS double)")
    modifier = first_credential([F.col("Modifier1500_1"), F.col("Modifier1500_2")], credentials)
    return (
        lines.filter(F.col("CPTCode").isin(*codes))
        .select(
            F.col("CustomerName").alias("customer_name"),
            F.col("CPTCode").alias("cpt"),
            modifier.alias("modifier"),
            rate.alias("rate"),
            (F.col("line_order") if order is None else order).alias("line"),
        )
        .filter(F.col("rate").isNotNull())
        .groupBy("customer_name", "cpt", "modifier")
        .agg(F.min_by("rate", "line").alias("rate"))
    )
