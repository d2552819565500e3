"""Merged sketches against exact results."""

from pyspark.sql import functions as F

from ratescape.operators import sketches
from ratescape.operators.rate_query import summarize


def many(spark, n, salt):
    """Rates of two codes, one with most rows, over a wide range with ties."""
    rate = F.floor(F.exp((F.xxhash64("id", F.lit(salt)) % 1000) / 150.0) * 4) / 4
    code = F.when(F.col("id") % 10 == 0, "97151").otherwise("97153")
    empty = F.array().cast("array<string>")
    return spark.range(n).select(code.alias("billing_code"), rate.alias("negotiated_rate"), empty.alias("billing_code_modifiers"))


def test_quartiles_are_within_the_rank_error(spark):
    parts = [many(spark, 60_000, salt) for salt in range(3)]
    rates = parts[0].union(parts[1]).union(parts[2])
    built = [sketches.rate_sketches(p, ["billing_code"]) for p in parts]
    merged = sketches.merge_rate_sketches(built[0].union(built[1]).union(built[2]), ["billing_code"])
    exact = {r.billing_code: r for r in summarize(rates, ["billing_code"]).collect()}
    for row in sketches.sketch_summary(merged).collect():
        other = exact[row.billing_code]
        assert (row.row_count, row.min_rate, row.max_rate) == (other.row_count, other.min_rate, other.max_rate)
        own = rates.filter(F.col("billing_code") == row.billing_code)
        for name, q in sketches.QUARTILES.items():
            below, upto = own.agg(F.count_if(F.col("negotiated_rate") < row[name]), F.count_if(F.col("negotiated_rate") <= row[name])).first()
            assert below / row.row_count - sketches.RANK_ERROR <= q <= upto / row.row_count + sketches.RANK_ERROR


def test_groups_without_rates_and_status_modifiers(spark, rate_table):
    rows = rate_table({"negotiated_rate": None}, {"billing_code": "97155", "negotiated_rate": 5.0}, {"billing_code": "97155", "negotiated_rate": 9.0, "billing_code_modifiers": ["53"]})
    found = {r.billing_code: tuple(r)[1:] for r in sketches.sketch_summary(sketches.rate_sketches(rows, ["billing_code"])).collect()}
    assert found == {"97153": (1, None, None, None, None, None), "97155": (1, 5.0, 5.0, 5.0, 5.0, 5.0)}


def test_payer_pairs(spark, rate_table):
    rows = rate_table(
        *[{"payer_name": p, "negotiated_rate": float(n), "provider_tin_value": t} for p, rates in (("A", (1, 2, 2, 3)), ("B", (2, 3, 4)), ("C", (9,)), (None, (1, 2))) for n in rates for t in ("t", "u")],
        {"payer_name": "C", "billing_code": "97155", "negotiated_rate": 1.0, "provider_tin_value": "t"},
    )
    parts = [sketches.payer_sketches(rows.filter(F.col("provider_tin_value") == t)) for t in ("t", "u")]
    pairs = sketches.payer_pairs(sketches.merge_payer_sketches(parts[0].union(parts[1])))
    assert [tuple(r) for r in pairs.collect()] == [("97153", "A", "B", 6, 6, 4)]
