"""Comparison with one's own contract rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescape import reference_values as ref
from ratescape.functions.columns import lookup


def contract_lookup(
    requests: DataFrame,
    contracts: DataFrame,
    customers: Mapping[str, str] = ref.CONTRACT_CUSTOMERS,
    credentials: Sequence[str] = ref.CREDENTIAL_MODIFIERS,
) -> DataFrame:
    """Own rate for (payer_name, billing_code, modifier) request rows.

    The rate of the exact credential is used, else the base rate, else null.
    The schedule is first folded to one row per customer and code, so a single
    join serves the exact match and the fallback.
    """
    folded = contracts.groupBy("customer_name", F.col("cpt").alias("billing_code")).agg(
        *[
            F.max(F.when(F.col("modifier") == m, F.col("rate"))).alias(f"rate_{m}")
            for m in ("", *credentials)
        ]
    )
    exact = F.lit(None).cast("double")
    for m in credentials:
        exact = F.when(F.col("modifier") == m, F.col(f"rate_{m}")).otherwise(exact)
    return (
        requests.withColumn("customer_name", lookup(customers, F.col("payer_name")))
        .join(folded, ["customer_name", "billing_code"], "left")
        .select(*requests.columns, F.coalesce(exact, F.col("rate_")).alias("contract_rate"))
    )


def payer_contracts(
    contracts: DataFrame, customers: Mapping[str, str] = ref.CONTRACT_CUSTOMERS
) -> DataFrame:
    """The schedule under the payer names of the rate files."""
    payers: dict[str, list[str]] = {}
    for payer, customer in customers.items():
        payers.setdefault(customer, []).append(payer)
    names = F.create_map(
        *[
            part
            for customer, listed in payers.items()
            for part in (F.lit(customer), F.array(*[F.lit(p) for p in listed]))
        ]
    )
    return contracts.select(
        F.explode(F.try_element_at(names, F.col("customer_name"))).alias("payer_name"),
        "cpt",
        "modifier",
        "rate",
    )
