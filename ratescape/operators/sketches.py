"""Approximate summaries from sketches that are stored per group and merged, off unless asked for.

The exact summaries (``rate_query``) keep a count per distinct value. Where even that
is too much, a group keeps one KLL sketch of its rates, and a payer one theta sketch of
the rates it publishes for a code. Sketches of parts, runs or months merge without
reading rates again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescape.functions.columns import without_status_modifiers

#: KLL size. A quantile is at most RANK_ERROR off in rank, as a share of the group's rows (the sketch promises about half of that for 99 % of answers).
KLL_SIZE, RANK_ERROR = 2_000, 0.005
#: Theta size: up to 2**16 different rates per payer and code are counted exactly, beyond that within about 1 % of the union of both payers.
THETA_BITS = 16
QUARTILES = {"p25_rate": 0.25, "median_rate": 0.5, "p75_rate": 0.75}
RATE_GRAIN = ("billing_code_modifiers", "billing_class", "negotiated_type", "negotiated_rate", "provider_tin_value")


def rate_sketches(rates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group: row_count (all rows), min_rate, max_rate and the ``sketch`` of its known rates.

    Rates that carry a status modifier are left out, as in the exact summaries. A group
    without a known rate has a null minimum.
    """
    rate = F.col("negotiated_rate")
    kept = rates.filter(without_status_modifiers(F.col("billing_code_modifiers")))
    return kept.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(rate).alias("min_rate"), F.max(rate).alias("max_rate"), F.kll_sketch_agg_double(rate, KLL_SIZE).alias("sketch")
    )


def merge_rate_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of parts, put together with ``union``, as sketches of ``keys``."""
    return sketches.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"), F.min("min_rate").alias("min_rate"), F.max("max_rate").alias("max_rate"), F.kll_merge_agg_double("sketch", KLL_SIZE).alias("sketch")
    )


def sketch_summary(sketches: DataFrame) -> DataFrame:
    """Quartiles in place of the sketch, each a rate of the group within RANK_ERROR of its rank; counts and bounds are exact."""
    known = F.col("min_rate").isNotNull()
    quartiles = {name: F.when(known, F.kll_sketch_get_quantile_double("sketch", F.lit(q))) for name, q in QUARTILES.items()}
    return sketches.withColumns(quartiles).drop("sketch")


def payer_sketches(rates: DataFrame) -> DataFrame:
    """(billing_code, payer_name, sketch): the different rates a payer has for a code; a rate is all of RATE_GRAIN."""
    return rates.groupBy("billing_code", "payer_name").agg(F.theta_sketch_agg(F.xxhash64(*RATE_GRAIN), THETA_BITS).alias("sketch"))


def merge_payer_sketches(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("billing_code", "payer_name").agg(F.theta_union_agg("sketch", THETA_BITS).alias("sketch"))


def payer_pairs(sketches: DataFrame) -> DataFrame:
    """(billing_code, payer, other_payer, rates, other_rates, shared_rates) of payers that share a rate of a code.

    One row per payer and code goes into the join, whatever the rates; the pairs of a
    code are those of its payers, which are few. Payers without a name are left out.
    """
    one = sketches.select("billing_code", F.col("payer_name").alias("payer"), F.col("sketch").alias("mine"))
    other = sketches.select("billing_code", F.col("payer_name").alias("other_payer"), F.col("sketch").alias("theirs"))
    pairs = one.join(other, "billing_code").filter(F.col("payer") < F.col("other_payer"))
    found = pairs.select(
        "billing_code",
        "payer",
        "other_payer",
        F.theta_sketch_estimate("mine").alias("rates"),
        F.theta_sketch_estimate("theirs").alias("other_rates"),
        F.theta_sketch_estimate(F.theta_intersection("mine", "theirs")).alias("shared_rates"),
    )
    return found.filter(F.col("shared_rates") > 0)
