import pytest
from rate_docs import INLINE_DOC, REFERENCE_DOC, write_json
from pyspark.sql import functions as F

from ratescape.functions import columns as col
from ratescape.functions.profiles import ABA
from ratescape.operators.flatten import flatten_rates
from ratescape.operators.rate_query import (
    clamp_limit,
    facets,
    file_inventory,
    raw_and_benchmark,
    run_query,
    sort_rows,
)
from ratescape.plans.presets import PRESETS, run_preset
from ratescape.sources.rate_files import read_rate_files
from ratescape.sources.rate_tables import read_rates, write_rates


@pytest.fixture(scope="module")
def parsed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("parsed")
    for name, doc in {"a": INLINE_DOC, "b": REFERENCE_DOC}.items():
        files = read_rate_files(spark, write_json(folder / f"{name}.json.gz", doc), ABA)
        write_rates(flatten_rates(files, ABA), f"{folder}/out-{name}-aba", partition_by=())
    return read_rates(spark, f"{folder}/out-*-aba/*.parquet")


def test_grouped_summary(parsed):
    rows = run_query(parsed, service_line="aba", group_by="billing_code", summary=True).collect()
    assert [(r.billing_code, r.row_count, r.median_rate) for r in rows] == [
        ("97152", 1, 88.0),
        ("97155", 1, 61.25),
    ]


def test_filters(parsed):
    assert [r.billing_code for r in run_query(parsed, cpt="97155").collect()] == ["97155"]
    assert run_query(parsed, min_rate=60, max_rate=70).count() == 1
    assert run_query(parsed, min_rate=61.25, max_rate=61.25).count() == 1
    assert run_query(parsed, benchmark_eligible=True).count() == 2
    assert run_query(parsed, payer="Nobody").count() == 0
    empty = run_query(parsed, payer="Nobody", summary=True).collect()
    assert [(r.row_count, r.median_rate, r.avg_rate) for r in empty] == [(0, None, None)]


def test_columns_are_checked(parsed):
    with pytest.raises(ValueError, match=r"unsupported column\(s\) drop_table"):
        run_query(parsed, group_by="billing_code,drop_table", summary=True)
    assert run_query(parsed, group_by=" setting , billing_code,").columns == ["setting", "billing_code"]
    assert run_query(parsed).columns[0] == "payer_name" and len(run_query(parsed).columns) == 9
    with pytest.raises(TypeError):
        run_query(parsed, state="MN")


def test_limits(parsed):
    assert [clamp_limit(n) for n in (-5, 0, 7, 99_999)] == [1, 1, 7, 10_000]
    assert run_query(parsed, limit=0).count() == 1
    many = parsed.crossJoin(parsed.sparkSession.range(10_001).select())
    assert run_query(many).count() == run_query(many, limit=10**9).count() > 10_000


def test_status_modifiers(spark):
    df = spark.createDataFrame(
        [(["53"],), (["TC", "55"],), (["TC", None],), ([],), ([None],), (None,)], "m array<string>"
    )
    kept = df.filter(col.without_status_modifiers(F.col("m"))).collect()
    assert [r.m for r in kept] == [["TC", None], [], [None]]


def test_summary_has_null_groups_and_rates(rate_table):
    rates = rate_table(
        {"setting": None, "negotiated_rate": 1.0},
        {"setting": None, "negotiated_rate": None},
        {"setting": "office", "negotiated_rate": None},
    )
    rows = run_query(rates, group_by="setting", summary=True).collect()
    assert [(r.setting, r.row_count, r.min_rate, r.avg_rate) for r in rows] == [
        ("office", 1, None, None),
        (None, 2, 1.0, 1.0),
    ]


def test_raw_and_benchmark(rate_table):
    rates = rate_table(
        *[{"billing_code": f"{97151 + i % 3}", "is_benchmark_eligible": i % 3 == 0} for i in range(9)],
        {"billing_code": "97151", "billing_code_modifiers": ["53"]},
    )
    views = {r.view: (r.group_count, r.row_total) for r in raw_and_benchmark(rates).collect()}
    assert views == {"raw": (3, 9), "benchmark": (1, 3)}
    capped = {r.view: (r.group_count, r.row_total) for r in raw_and_benchmark(rates, limit=2).collect()}
    assert capped == {"raw": (2, 6), "benchmark": (1, 3)}


def test_facets(rate_table):
    rates = rate_table(
        {"payer_name": "B", "billing_code_modifiers": ["HM", "HO"]},
        {"payer_name": "A", "billing_code": "", "billing_code_modifiers": None},
        {"payer_name": None, "billing_code_modifiers": ["HM", None, ""]},
    )
    found = [(r.facet, r.value) for r in facets(rates).collect()]
    assert found == [
        ("cpt_codes", "97153"),
        ("modifiers", "HM"),
        ("modifiers", "HO"),
        ("payer_names", "A"),
        ("payer_names", "B"),
    ]
    assert facets(rates, payers=["A"]).filter("facet = 'payer_names'").count() == 1


def test_sort_puts_nulls_last_both_ways(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "x int")
    assert [r.x for r in sort_rows(df, "x").collect()] == [1, 2, None]
    assert [r.x for r in sort_rows(df, "x", descending=True).collect()] == [2, 1, None]


def test_presets(rate_table):
    rates = rate_table({"negotiated_rate": 5.0}, {"billing_class": "institutional", "negotiated_rate": 9.0})
    counts = {p.slug: run_preset(rates, p.slug).count() for p in PRESETS}
    assert counts == {
        "aba_benchmark_summary": 1,
        "aba_raw_summary": 2,
        "aba_97153_raw_rows": 2,
        "aba_97153_benchmark_rows": 1,
    }
    with pytest.raises(ValueError, match="aba_raw_summary"):
        run_preset(rates, "other")


def test_rate_table_roundtrip_and_pruning(spark, tmp_path, rate_table):
    path = str(tmp_path / "rates")
    rates = rate_table({"billing_code": "97153"}, {"billing_code": "70551", "service_line": "radiology"})
    write_rates(rates, path)
    back = read_rates(spark, path)
    assert back.columns == rates.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, rates.collect()))
    narrow = run_query(back, service_line="aba", cpt="97153", group_by="payer_name")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(service_line" in plan
    assert "EqualTo(billing_code,97153)" in plan
    assert "provider_npi_list" not in plan.split("ReadSchema")[1]
    empty = str(tmp_path / "empty")
    write_rates(rates.limit(0), empty)
    assert read_rates(spark, [empty, str(tmp_path / "nothing-*")]).count() == 0
    with pytest.raises(ValueError, match="no rate files"):
        read_rates(spark, str(tmp_path / "nothing-*"))
    assert file_inventory(back).first().row_count == 2
