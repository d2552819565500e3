import random
import statistics

import pytest
from pyspark.sql import functions as F

from ratescape.functions.columns import credential_filter, plan_name, taxonomy_label
from ratescape.operators import distribution as dist
from ratescape.operators import providers as prov

TEXAS = "Blue Cross and Blue Shield of Texas"
ANTHEM = "Anthem Blue Cross California"
URL = "https://x.test/2026-05-01_12-{}_Blue-Shield-of.json.gz"


@pytest.fixture
def registry(spark):
    return spark.createDataFrame(
        [
            ("1", "Org One", None, None, "103K00000X"),
            ("2", None, "Ann", "Lee", "207Q00000X"),
            ("3", None, None, None, None),
            ("3", "Second Entry", None, None, "103TC0700X"),
        ],
        "npi string, organization_name string, first_name string, last_name string, primary_taxonomy string",
    )


def test_provider_medians(rate_table, registry):
    rates = rate_table(
        {"negotiated_rate": 10.0, "provider_npi_list": ["1", "2", "9"]},
        {"negotiated_rate": 10.0, "provider_npi_list": ["1"]},
        {"negotiated_rate": 20.0, "provider_npi_list": ["1", "3"]},
        {"negotiated_rate": 30.0, "provider_npi_list": ["1"], "negotiated_type": "percentage"},
        {"negotiated_rate": 40.0, "provider_npi_list": ["1"], "billing_code_modifiers": ["53"]},
        {"negotiated_rate": 50.0, "provider_npi_list": ["1"], "billing_class": "institutional"},
        {"negotiated_rate": 60.0, "provider_npi_list": []},
    )
    rows = prov.provider_rates_median(rates, registry, "97153").collect()
    got = [(r.npi, r.provider_name, r.type, r.median_rate, r.min_rate, r.max_rate) for r in rows]
    assert got == [
        ("3", "", "", 20.0, 20.0, 20.0),
        ("3", "Second Entry", "Psychologist", 20.0, 20.0, 20.0),
        ("1", "Org One", "BCBA", 15.0, 10.0, 20.0),
        ("9", "", "", 10.0, 10.0, 10.0),
        ("2", "Ann Lee", "Physician", 10.0, 10.0, 10.0),
    ]
    only = lambda f: {
        (r.npi, r.provider_name)
        for r in prov.provider_rates_median(rates, registry, "97153", provider_filter=f).collect()
    }
    assert only("bcba") == {("1", "Org One")}
    assert only("excl_phys") == {("1", "Org One"), ("3", ""), ("9", "")}


def test_npi_summary_counts_distinct_rates(rate_table, registry):
    rates = rate_table(
        {"negotiated_rate": 10.0},
        {"negotiated_rate": 10.0},
        {"negotiated_rate": 10.0, "aba_provider_role": "technician"},
        {"negotiated_rate": 25.0, "billing_code": "97151"},
        {"negotiated_rate": 99.0, "negotiated_type": "negotiated"},
    )
    (row,) = prov.npi_summary(rates, registry).collect()
    assert (row.rate_rows, row.min_rate, row.max_rate, row.avg_rate, row.median_rate) == (3, 10.0, 25.0, 15.0, 10.0)
    assert prov.npi_summary(rates, registry, "97151").first().rate_rows == 1


def test_plan_tables(rate_table, registry):
    rates = rate_table(
        {"negotiated_rate": 10.0, "source_file_url": URL.format("Gold-80-PPO-Jan16")},
        {"negotiated_rate": 12.0, "source_file_url": URL.format("Gold-80-PPO-Jan16")},
        {"negotiated_rate": 30.0, "source_file_url": URL.format("Unlisted-Plan")},
        {"negotiated_rate": 77.0, "source_file_url": URL.format("123")},
        {"negotiated_rate": 88.0, "source_file_url": URL.format("Blue-Shield-of-California")},
        {"negotiated_rate": 5.0, "source_file_url": "no plan", "provider_npi_list": ["2"]},
    )
    (gold,) = prov.plan_rates(rates, registry, "97153").collect()
    assert gold["Gold PPO (Jan16)"] == 12.0 and gold["Gold PPO"] is None
    assert gold.npi == "1" and gold.modifiers == ""
    rows = {r.npi: (r.median_rate, r.plan_count) for r in prov.plan_rates_median(rates, registry, "97153").collect()}
    assert rows == {"1": (12.0, 2), "2": (5.0, 1)}
    assert prov.plan_rates_median(rates, registry, "97153", "HM").count() == 0


def test_plan_name(spark):
    df = spark.createDataFrame([(URL.format("A_Blue-Shield-B"),), ("x",)], "u string")
    assert [r[0] for r in df.select(plan_name(F.col("u"))).collect()] == ["A_Blue-Shield-B", ""]


@pytest.mark.parametrize(
    ("payer", "code", "modifier", "expected"),
    [
        (None, "97153", None, None),
        (ANTHEM, "97153", "HM", None),
        (TEXAS, "97153", "HM", [True, False, False, True]),
        (TEXAS, "97153", "HO", [False, False, True, False]),
        (TEXAS, "97151", "HO", [True, False, False, True]),
        ("Unknown", "97153", "HM", [False, True, False, False]),
        (None, "97153", "HM", [False, True, False, False]),
    ],
)
def test_credential_conventions(spark, payer, code, modifier, expected):
    test = credential_filter(payer, code, modifier, F.col("m"))
    if expected is None:
        assert test is None
        return
    df = spark.createDataFrame([([],), (["HM"],), (["HO", None],), (None,)], "m array<string>")
    assert [r[0] for r in df.select(F.coalesce(test, F.lit(False))).collect()] == expected


@pytest.mark.parametrize(
    ("code", "label"),
    [
        ("103K00000X", "BCBA"),
        ("103X", "Mental Health"),
        ("1041C0700X", "Clinical Social Worker"),
        ("104X", "Social Worker"),
        ("106H00000X", "MFT"),
        ("363LP0808X", "Nurse Practitioner"),
        ("363X", "NP/PA"),
        ("999ZZZZZZZZZZ", "999ZZZZZZZ"),
        ("", ""),
        (None, ""),
    ],
)
def test_taxonomy_labels(spark, code, label):
    df = spark.createDataFrame([(code,)], "t string")
    assert df.select(taxonomy_label("t")).first()[0] == label


def plain_distribution(medians):
    """Rank statistics and bins of a short list, the obvious way."""
    middle = sorted(medians)[len(medians) // 2]
    kept = sorted(m for m in medians if m <= 4 * middle)
    n = len(kept)
    stats = (kept[0], kept[n // 4], kept[n // 2], kept[3 * n // 4], kept[int(n * 0.9)], kept[-1], n)
    low, high = kept[0], kept[-1]
    if low == high:
        return stats, {low: n}
    bins = min(50, len(set(kept)))
    width = (high - low) / bins
    counts = {}
    for value in kept:
        index = min(int((value - low) / width), bins - 1)
        counts[index] = counts.get(index, 0) + 1
    return stats, counts


@pytest.mark.parametrize("size", [1, 2, 4, 5, 37, 400])
def test_distribution_equals_plain_python(spark, size):
    rng = random.Random(size)
    medians = [rng.randint(4, 4000) / 4 for _ in range(size)]
    df = spark.createDataFrame([(m,) for m in medians], "median_rate double")
    trimmed = dist.trimmed_counts(dist.median_counts(df))
    stats, counts = plain_distribution(medians)
    row = dist.distribution_stats(trimmed).first()
    assert (row.min, row.p25, row.median, row.p75, row.p90, row.max, row.total) == stats
    bins = dist.distribution_bins(trimmed).collect()
    assert [b["count"] for b in bins] == [counts[k] for k in sorted(counts)]


def test_empty_distribution(spark):
    df = spark.createDataFrame([], "median_rate double")
    trimmed = dist.trimmed_counts(dist.median_counts(df))
    assert dist.distribution_stats(trimmed).count() == 0
    assert dist.distribution_bins(trimmed).count() == 0


def test_npi_median_of_distinct_rates(rate_table, registry):
    amounts = [1.0, 1.0, 1.0, 8.0, 9.5]
    rates = rate_table(*[{"negotiated_rate": a} for a in amounts])
    row = dist.npi_median(rates, registry, "97153").first()
    assert row.median_rate == statistics.median(set(amounts))
    assert dist.npi_median(rates, None, "97153").count() == 1


def test_contract_bin(spark):
    bins = spark.createDataFrame([(10.0, 1), (20.0, 2), (30.0, 1)], "rate double, count long")
    own = lambda *v: spark.createDataFrame([(x,) for x in v], "contract_rate double")
    flagged = lambda c: [r.rate for r in dist.mark_contract_bin(bins, c).collect() if r.is_contract_bin]
    assert flagged(own(24.0)) == [20.0]
    assert flagged(own(25.0)) == [20.0]
    assert flagged(own()) == []


def test_payer_overlap(rate_table):
    rates = rate_table(
        {"payer_name": "B", "negotiated_rate": 1.0},
        {"payer_name": "A", "negotiated_rate": 1.0},
        {"payer_name": "A", "negotiated_rate": 2.0},
    )
    rows = {r.payers: (r.payer_count, r.shared_rates) for r in prov.payer_overlap(rates).collect()}
    assert rows == {"A | B": (2, 1), "A": (1, 1)}
