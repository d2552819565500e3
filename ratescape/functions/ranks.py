"""Exact order statistics that never gather a group in one task.

``percentile`` and ``median`` keep every distinct value of a group in one
aggregation buffer, so one hot code or provider ends up in one task. Here a
group is first reduced to (value, count) pairs, which spread over the cluster
by value. A second, tiny table counts values per coarse bucket; a running sum
over it tells which bucket holds each wanted rank, and only those buckets are
ordered. The work per task is bounded by one bucket of one group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS_PER_OCTAVE = 256
NO_VALUE = -(2**62)

# Monotone coarse bucket on a log scale; NO_VALUE for null. Never null, so no
# branch of a plan gets a null filter of its own and all branches keep sharing
# one shuffle of the counts.
_BUCKET = f"""coalesce(
    CASE WHEN isnan(_value) OR _value = double('Infinity') THEN {2**40}L
         WHEN _value = double('-Infinity') THEN -{2**40}L
         ELSE CAST(sign(_value) * floor(log2(1.0D + abs(_value)) * {BUCKETS_PER_OCTAVE}.0D) AS bigint) END,
    {NO_VALUE}L)"""


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per (keys, value) with its multiplicity ``n``; nulls included."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def rank_statistics(
    counts: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, str]
) -> DataFrame:
    """Order statistics per group from a ``value_counts`` table.

    ``ranks`` maps a column name to a SQL expression for a 0-based rank in
    terms of ``value_count``, the number of non-null values. The result has the
    keys, ``row_count`` (nulls included), ``value_count``, ``min_value``,
    ``max_value``, ``sum_value`` and one column per rank. Without keys there is
    always exactly one row.
    """
    group = f"struct({', '.join(f'`{k}`' for k in keys)})" if keys else "0"
    base = counts.selectExpr(
        f"{group} AS _group", f"CAST(`{value}` AS double) AS _value", "n AS _n"
    ).selectExpr("*", f"{_BUCKET} AS _bucket")

    # Which bucket of a group holds which rank: a running sum over bucket
    # totals, whose number per group is bounded by the log scale.
    filled = f"CASE WHEN _bucket <> {NO_VALUE}L THEN _rows ELSE 0L END"
    in_group = "OVER (PARTITION BY _group)"
    upto = "OVER (PARTITION BY _group ORDER BY _bucket ROWS UNBOUNDED PRECEDING)"
    placed = (
        base.groupBy("_group", "_bucket")
        .agg(
            F.expr("sum(_n) AS _rows"),
            F.expr("min(_value) AS _min"),
            F.expr("max(_value) AS _max"),
            F.expr("sum(_value * _n) AS _sum"),
        )
        .selectExpr(
            "_group",
            "_bucket",
            f"sum({filled}) {upto} AS _end",
            f"sum({filled}) {upto} - {filled} AS _start",
            f"sum(_rows) {in_group} AS row_count",
            f"sum({filled}) {in_group} AS value_count",
            f"min(_min) {in_group} AS min_value",
            f"max(_max) {in_group} AS max_value",
            f"sum(_sum) {in_group} AS sum_value",
        )
        .selectExpr("*", *[f"CAST({rank} AS bigint) AS `_at_{name}`" for name, rank in ranks.items()])
    )
    # A group without any value keeps one bucket, so that it stays in the result.
    wanted = ["value_count = 0", *[_holds(name) for name in ranks]]
    hits = placed.filter(" OR ".join(wanted)).drop("_end")

    picked = (
        base.join(hits, ["_group", "_bucket"])
        .selectExpr(
            "* EXCEPT (_start)",
            "_start + sum(_n) OVER (PARTITION BY _group, _bucket ORDER BY _value"
            " ROWS UNBOUNDED PRECEDING) AS _end",
        )
        .selectExpr("*", "_end - _n AS _start")
    )
    result = (picked.groupBy("_group") if keys else picked).agg(
        F.expr("coalesce(max(row_count), 0L) AS row_count"),
        F.expr("coalesce(max(value_count), 0L) AS value_count"),
        F.expr("max(min_value) AS min_value"),
        F.expr("max(max_value) AS max_value"),
        F.expr("max(sum_value) AS sum_value"),
        *[F.expr(f"max(CASE WHEN {_holds(name)} THEN _value END) AS `{name}`") for name in ranks],
    )
    unpacked = [f"_group.`{key}` AS `{key}`" for key in keys]
    return result.selectExpr(*unpacked, "* EXCEPT (_group)") if keys else result


def _holds(name: str) -> str:
    return f"(`_at_{name}` >= _start AND `_at_{name}` < _end)"


def quantile_statistics(
    counts: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float]
) -> DataFrame:
    """``rank_statistics`` with linearly interpolated quantiles and the mean."""
    ranks = {}
    interpolated = []
    for name, p in quantiles.items():
        position = f"(value_count - 1) * {p}D"
        ranks[f"{name}__low"] = f"floor({position})"
        ranks[f"{name}__high"] = f"ceil({position})"
        share = f"({position} - floor({position}))"
        interpolated.append(f"{name}__low * (1.0D - {share}) + {name}__high * {share} AS {name}")
    return rank_statistics(counts, keys, value, ranks).selectExpr(
        *[f"`{key}`" for key in keys],
        "row_count",
        "value_count",
        "min_value",
        "max_value",
        "sum_value",
        "try_divide(sum_value, value_count) AS mean_value",
        *interpolated,
    )
