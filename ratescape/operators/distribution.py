"""Outlier-trimmed distribution of per-provider median rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescape.functions.columns import round_cents
from ratescape.functions.ranks import quantile_statistics, rank_statistics
from ratescape.operators.providers import MEDIAN, benchmark_rates, by_provider, keep_providers
from ratescape.session import materialize

# Medians above this multiple of the middle one are left out,
# and the number of histogram bins is capped.
TRIM_FACTOR = 4
MAX_BINS = 50


def npi_median(
    rates: DataFrame,
    registry: DataFrame | None,
    cpt: str,
    modifier: str | None = None,
    payer: str | None = None,
    provider_filter: str | None = None,
) -> DataFrame:
    """Median of the distinct rates of each provider, rounded to cents."""
    rows = by_provider(benchmark_rates(rates, cpt, modifier, payer), "negotiated_rate")
    if registry is not None:
        rows = keep_providers(rows, registry, provider_filter)
    counts = rows.distinct().withColumn("n", F.lit(1))
    return quantile_statistics(counts, ["npi"], "negotiated_rate", MEDIAN).select(
        "npi", round_cents(F.col("median_value")).alias("median_rate")
    )


def median_counts(medians: DataFrame) -> DataFrame:
    """Stored (median_rate, n) of per-provider medians.

    All later steps of a distribution work on these distinct values, so the
    rate table is read once.
    """
    counts = medians.groupBy("median_rate").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts, "median-counts")


def trimmed_counts(counts: DataFrame) -> DataFrame:
    """The medians up to four times the upper median."""
    middle = rank_statistics(
        counts, [], "median_rate", {"middle": "value_count div 2"}
    ).select("middle")
    return counts.filter(F.col("median_rate") <= F.lit(float(TRIM_FACTOR)) * middle.scalar())


def distribution_stats(trimmed: DataFrame) -> DataFrame:
    """One row of rank-based statistics; no row when nothing is left."""
    stats = rank_statistics(
        trimmed,
        [],
        "median_rate",
        {
            "p25": "value_count div 4",
            "median": "value_count div 2",
            "p75": "3 * value_count div 4",
            "p90": "floor(value_count * 0.9D)",
        },
    )
    return stats.filter(F.col("value_count") > 0).select(
        F.col("min_value").alias("min"),
        "p25",
        "median",
        round_cents(F.col("sum_value") / F.col("value_count")).alias("mean"),
        "p75",
        "p90",
        F.col("max_value").alias("max"),
        F.col("value_count").alias("total"),
    )


def distribution_bins(trimmed: DataFrame) -> DataFrame:
    """Non-empty histogram bins as (rate, count); rate is the bin centre."""
    frame = trimmed.agg(
        F.struct(
            F.min("median_rate").alias("low"),
            F.max("median_rate").alias("high"),
            F.least(F.lit(MAX_BINS), F.count(F.lit(1))).alias("bins"),
        ).alias("frame")
    )
    low, high, bins = (F.col("frame")[name] for name in ("low", "high", "bins"))
    width = (high - low) / bins
    position = F.floor(F.try_divide(F.col("median_rate") - low, width))
    # One distinct value has no width: it is its own, only bin.
    index = F.when(high > low, F.least(position, bins - 1)).otherwise(F.lit(0))
    centre = F.when(
        high > low, round_cents(low + (F.col("bin") + F.lit(0.5)) * width)
    ).otherwise(low)
    return (
        trimmed.withColumn("frame", frame.scalar())
        .withColumn("bin", index)
        .groupBy("bin", "frame")
        .agg(F.sum("n").alias("count"))
        .select(centre.alias("rate"), "count")
        .orderBy("rate")
    )


def rate_distribution(
    rates: DataFrame,
    registry: DataFrame | None,
    cpt: str,
    modifier: str | None = None,
    payer: str | None = None,
    provider_filter: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(statistics, histogram bins) of one code's per-provider medians."""
    medians = npi_median(rates, registry, cpt, modifier, payer, provider_filter)
    trimmed = trimmed_counts(median_counts(medians))
    return distribution_stats(trimmed), distribution_bins(trimmed)


def mark_contract_bin(bins: DataFrame, contract: DataFrame) -> DataFrame:
    """Flag the bin nearest to one's own rate; the lower bin wins a tie.

    ``contract`` has at most one row with ``contract_rate``.
    """
    own = contract.select("contract_rate").scalar()
    nearest = bins.agg(F.min(F.struct(F.abs(F.col("rate") - own), F.col("rate"))).alias("best")).select(
        F.col("best.rate")
    )
    return bins.withColumn(
        "is_contract_bin",
        own.isNotNull() & F.coalesce(F.col("rate") == nearest.scalar(), F.lit(False)),
    )
