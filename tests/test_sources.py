import json

import pytest
from rate_docs import INLINE_DOC, item, rate_doc, write_json
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ratescape import reference_values as ref
from ratescape.functions.columns import absolute_url, index_url, output_name, source_host
from ratescape.functions.profiles import ABA
from ratescape.operators.contracts import contract_lookup, payer_contracts
from ratescape.operators.probe import probe_paths, probe_summary
from ratescape.sources import indexes
from ratescape.sources.contracts import contract_rates, read_contracts
from ratescape.sources.registry import npi_registry, read_registry, read_registry_csv, registry_columns, write_registry


def values(spark, texts, make):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    return [r[0] for r in df.select(make(F.col("x"))).collect()]


# --- indexes --------------------------------------------------------------


def plan(name, **more):
    return {"plan_name": name, "plan_id_type": "ein", "plan_id": name[-1], "issuer_name": "I", "plan_market_type": "group", **more}


TOC = {
    "reporting_entity_name": "Example Payer",
    "reporting_entity_type": "Health Insurance Issuer",
    "last_updated_on": "2026-05-01",
    "version": "2.0.0",
    "reporting_structure": [
        {
            "reporting_plans": [plan("Plan A")],
            "in_network_files": [{"description": None, "location": "https://e.test/a.json.gz", "content_length_bytes": 123}],
        },
        None,
        {"reporting_plans": None, "in_network_files": None},
        {
            "reporting_plans": [plan("Plan B"), None],
            "in_network_files": [
                {"description": "National", "location": "https://e.test/a.json.gz"},
                {"description": "Regional", "location": "https://e.test/b.json.gz"},
                {"description": "empty", "location": ""},
                {"description": "none"},
            ],
        },
    ],
}


def test_table_of_contents(spark, tmp_path):
    path = write_json(tmp_path / "toc.json", TOC)
    toc = indexes.read_toc(spark, path)
    structures = indexes.toc_structures(toc)
    files = indexes.toc_files(structures)
    assert files.count() == 3
    merged = indexes.dedupe_files(files, indexes.TOC_ORDER).orderBy("first_seen").collect()
    assert [(r.location[-9], r.description, r.content_length_bytes, r.reporting_plan_count) for r in merged] == [
        ("a", "National", None, 2),
        ("b", "Regional", None, 1),
    ]
    plans = indexes.toc_file_plans(structures).orderBy("structure_ord", "file_ord", "plan_ord").collect()
    assert [(r.location[-9], r.plan_name, r.plan_sponsor_name) for r in plans] == [
        ("a", "Plan A", None),
        ("a", "Plan B", None),
        ("b", "Plan B", None),
    ]
    head = indexes.index_headers(toc, files).first()
    assert (head.version, head.reporting_structure_count, head.in_network_file_count) == ("2.0.0", 4, 2)
    paths = spark.createDataFrame([(path,)], "path string")
    large = indexes.toc_files(indexes.toc_structures(indexes.read_toc(spark, paths))).drop("source_file_url")
    assert sorted(map(str, large.collect())) == sorted(map(str, files.drop("source_file_url").collect()))
    out = str(tmp_path / "index")
    indexes.write_index(indexes.dedupe_files(files, indexes.TOC_ORDER).select(*indexes.INDEX_COLUMNS), out)
    (part,) = [p for p in (tmp_path / "index").iterdir() if p.name.endswith(".json")]
    first = json.loads(part.read_text().splitlines()[0])
    assert set(first) == set(indexes.INDEX_COLUMNS)


def test_native_index(spark, tmp_path):
    doc = {
        "in_network_files": [
            {"location": "x", "description": "d", "content_length_bytes": 5},
            {"description": "no location"},
            None,
            {"location": ""},
        ]
    }
    rows = indexes.read_native_index(spark, write_json(tmp_path / "i.json", doc)).collect()
    assert [(r.file_ord, r.location, r.content_length_bytes) for r in rows] == [(0, "x", 5), (3, "", None)]


def test_vendor_metadata(spark, tmp_path):
    entry = lambda path, name, plans=1, schema=ref.VENDOR_RATE_SCHEMA: {
        "reportingEntityName": "V",
        "lastUpdatedOn": "2026-05-01",
        "fileSchema": schema,
        "fileName": name,
        "filePath": path,
        "reportingPlans": [{"planName": f"P{i}", "planId": str(i)} for i in range(plans)],
    }
    doc = {"files": [entry("a/x.json", None, 2), entry("t.json", "toc", schema="TABLE_OF_CONTENTS"), entry("a/x.json", "second", 3), entry("/y.json", "y", 0)]}
    entries = indexes.read_vendor_metadata(spark, write_json(tmp_path / "m.json", doc))
    base = "https://h.test/p/q/"
    rows = indexes.vendor_index(entries, base).orderBy("first_seen").collect()
    assert [(r.location, r.description, r.reporting_plan_count) for r in rows] == [
        ("https://h.test/p/q/a/x.json", None, 5),
        ("https://h.test/y.json", "y", 0),
    ]
    assert indexes.vendor_file_plans(entries, base).count() == 5
    head = indexes.vendor_header(entries, base).first()
    assert (head.reporting_entity_name, head.reporting_structure_count, head.in_network_file_count) == ("V", 4, 2)


def test_url_columns(spark):
    sources = ["https://e.test/a/rates.json.gz?sig=1", "https://e.test/r.json", "/d/x.gz", "https://e.test/", "https://e.test", "plain", "https://e.test/a/b/", "x.json.gz.json"]
    assert values(spark, sources, lambda c: output_name(c, "aba")) == [
        "rates.aba.parquet",
        "r.aba.parquet",
        "x.aba.parquet",
        "in-network.aba.parquet",
        "in-network.aba.parquet",
        "plain.aba.parquet",
        "b.aba.parquet",
        "x.json.gz.aba.parquet",
    ]
    assert values(spark, ["https://a.test:80/x", "no"], source_host) == ["a.test", ""]
    assert values(spark, ["x/y", "./x", "/z", "//o.test/w", "http://o.test/v"], lambda c: absolute_url("https://h.test/p/", c)) == [
        "https://h.test/p/x/y",
        "https://h.test/p/x",
        "https://h.test/z",
        "https://o.test/w",
        "http://o.test/v",
    ]


def test_index_url(spark):
    good = spark.createDataFrame([(2026, 5)], "y int, m int").select(index_url(F.col("y"), F.col("m"))).first()[0]
    assert good.endswith("/2026/2026-05-01_Blue_Cross_and_Blue_Shield_of_Minnesota_index.json")
    bad = spark.createDataFrame([(2026, 13)], "y int, m int").select(index_url(F.col("y"), F.col("m")))
    with pytest.raises(PySparkException, match="between 1 and 12"):
        bad.collect()


# --- probe ----------------------------------------------------------------


@pytest.mark.parametrize(
    ("options", "expected"),
    [
        ({}, (3, ["97156"])),
        ({"stop_on_match": False}, (5, ["97151", "97156"])),
        ({"stop_on_match": False, "limit_items": 3}, (3, ["97156"])),
        ({"limit_items": 2}, (2, [])),
    ],
)
def test_probe(spark, tmp_path, options, expected):
    codes = ["99213", None, "97156", "97151", "97156"]
    path = write_json(tmp_path / "a.json.gz", rate_doc(*[item(c) for c in codes]))
    row = probe_paths(spark.createDataFrame([(path,)], "path string"), ABA, **options).first()
    assert (row.items_scanned, row.matched_codes) == expected
    assert (row.status, row.has_match) == ("ok", bool(expected[1]))


def test_probe_errors_and_summary(spark, tmp_path):
    paths = [
        write_json(tmp_path / "hit.json", INLINE_DOC),
        write_json(tmp_path / "miss.json", rate_doc(item("99213"))),
        write_json(tmp_path / "none.json", {"version": "1"}),
        write_json(tmp_path / "bad.json", '{"in_network": [{"billing_code'),
        str(tmp_path / "absent.json"),
    ]
    by_path = probe_paths(spark.createDataFrame([(p,) for p in paths], "path string"), ABA)
    assert probe_summary(by_path).first().asDict() == {"total_files": 5, "with_match": 1, "errors": 2, "without_match": 2}


# --- registry and contracts -----------------------------------------------


def test_registry(spark, tmp_path):
    names = registry_columns()
    assert len(names) == 35

    def line(**cells):
        return ",".join(f'"{cells.get(name, "")}"' for name in ["Extra", *names])

    code, switch = "Healthcare Provider Taxonomy Code_{}", "Healthcare Provider Primary Taxonomy Switch_{}"
    org = "Provider Organization Name (Legal Business Name)"
    lines = [
        ",".join(f'"{n}"' for n in ["Extra", *names]),
        line(NPI="1", **{org: "Say ""hi"", Inc", code.format(1): "A", switch.format(1): "N", code.format(15): "B", switch.format(15): "Y"}),
        line(NPI="2", **{org: "<UNAVAIL>", code.format(3): "C", switch.format(1): "Y"}),
        line(NPI="3", **{org: "NULL"}),
        line(NPI="", **{org: "no npi"}),
    ]
    path = tmp_path / "npi.csv"
    path.write_text("\n".join(lines) + "\n")
    registry = npi_registry(read_registry_csv(spark, str(path)))
    out = str(tmp_path / "npi")
    write_registry(registry, out)
    rows = sorted(map(tuple, read_registry(spark, out).select("npi", "organization_name", "primary_taxonomy").collect()))
    assert rows == [("1", 'Say hi, Inc', "B"), ("2", None, "C"), ("3", None, None)]


SCHEDULE = """CustomerName,CPTCode,ContractRatePerUnit,Modifier1500_1,Modifier1500_2,line
UMR,97153,10.5,HM,,1
UMR,97153,11.5, hm ,GT,2
UMR,97153,12.5,GT,ho,3
UMR,97153,13.5,GT,95,4
UMR,97151,n/a,,,5
UMR,99213,15.5,,,6
Blue Cross Blue Shield of Texas,97151,20,HO,,7
"""


def test_dot_segments_follow_the_url_rules(spark):
    from urllib.parse import urljoin

    paths = ["../x", "../../../x", "./a/./b", "a/../b", "/a/../b", "a/..", ".", "../x?s=a/../b", "x#../y"]
    base = "https://h.test/p/q/"
    assert values(spark, paths, lambda c: absolute_url(base, c)) == [urljoin(base, p) for p in paths]


def test_contracts(spark, tmp_path):
    path = tmp_path / "rates.csv"
    path.write_text("﻿" + SCHEDULE, encoding="utf-8")
    lines = read_contracts(spark, str(path))
    contracts = contract_rates(lines)
    rows = sorted((r.cpt, r.modifier, r.rate) for r in contracts.collect())
    assert rows == [("97151", "HO", 20.0), ("97153", "", 13.5), ("97153", "HM", 10.5), ("97153", "HO", 12.5)]
    united, texas = "United HealthCare Services, Inc.", "Blue Cross and Blue Shield of Texas"
    wanted = [
        (united, "97153", "HM", 10.5),
        (united, "97153", "HN", 13.5),
        (united, "97153", "", 13.5),
        (united, "97153", None, 13.5),
        (texas, "97151", "HO", 20.0),
        (texas, "97151", "HM", None),
        (united, "97151", "HM", None),
        ("Nobody", "97153", "HM", None),
    ]
    requests = spark.createDataFrame([w[:3] for w in wanted], "payer_name string, billing_code string, modifier string")
    found = contract_lookup(requests, contracts).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))
    assert {r.payer_name for r in payer_contracts(contracts).collect()} == {united, texas}


def test_contract_columns_may_be_absent(spark, tmp_path):
    path = tmp_path / "rates.csv"
    path.write_text("CPTCode,CustomerName,ContractRatePerUnit\n97153,UMR,3\n")
    rows = contract_rates(read_contracts(spark, str(path))).collect()
    assert [(r.modifier, r.rate) for r in rows] == [("", 3.0)]
