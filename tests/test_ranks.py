import math
import random

import pytest

from ratescape.functions.ranks import quantile_statistics, rank_statistics, value_counts

QUANTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def interpolated(values, p):
    position = (len(values) - 1) * p
    low, high = math.floor(position), math.ceil(position)
    share = position - low
    return values[low] * (1 - share) + values[high] * share


def brute_force(rows):
    groups = {}
    for key, value in rows:
        groups.setdefault(key, []).append(value)
    expected = {}
    for key, values in groups.items():
        known = sorted(v for v in values if v is not None)
        stats = [len(values), len(known)]
        if known:
            stats += [known[0], known[-1], *[interpolated(known, p) for p in QUANTILES.values()]]
        else:
            stats += [None] * 5
        expected[key] = tuple(stats)
    return expected


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quantiles_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    draw = {
        "hot": lambda: rng.choice([1.0, 2.5, 2.5, 1000.25]),
        "wide": lambda: rng.uniform(-1e6, 1e6),
        "dense": lambda: 100 + rng.random() / 1000,
        "nulls": lambda: rng.choice([None, None, 0.5, -0.5]),
        "void": lambda: None,
        None: lambda: rng.randint(-3, 3) / 4,
    }
    rows = [(key, make()) for key, make in draw.items() for _ in range(rng.randint(1, 300))]
    rows.append(("single", 7.0))
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    stats = quantile_statistics(value_counts(df, ["k"], "v"), ["k"], "v", QUANTILES)
    actual = {
        r.k: (r.row_count, r.value_count, r.min_value, r.max_value, r.q25, r.q50, r.q75)
        for r in stats.collect()
    }
    expected = brute_force(rows)
    assert actual.keys() == expected.keys()
    for key, values in expected.items():
        assert actual[key] == pytest.approx(values), key


def test_infinities_and_one_bucket(spark):
    values = [float("-inf"), -1.0, 0.0, 1.0, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    stats = rank_statistics(
        value_counts(df, [], "v"), [], "v", {f"r{i}": str(i) for i in range(5)}
    ).first()
    assert [stats[f"r{i}"] for i in range(5)] == values


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, v double")
    total = quantile_statistics(value_counts(df, [], "v"), [], "v", QUANTILES).collect()
    assert [(r.row_count, r.value_count, r.q50, r.mean_value) for r in total] == [(0, 0, None, None)]
    assert quantile_statistics(value_counts(df, ["k"], "v"), ["k"], "v", QUANTILES).count() == 0


def test_keys_may_be_lists(spark):
    df = spark.createDataFrame([(["a"], 1.0), (["a"], 3.0), ([], 5.0), (None, 9.0)], "k array<string>, v double")
    stats = quantile_statistics(value_counts(df, ["k"], "v"), ["k"], "v", {"m": 0.5}).collect()
    assert sorted((str(r.k), r.m) for r in stats) == [("None", 9.0), ("['a']", 2.0), ("[]", 5.0)]


def test_the_input_is_read_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 5 AS k", "double(id) AS v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    stats = quantile_statistics(value_counts(df, ["k"], "v"), ["k"], "v", QUANTILES)
    stats.collect()
    plan = stats._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
    assert "ReusedExchange" in final
