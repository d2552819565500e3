import json

import pytest
from rate_docs import INLINE_DOC, REFERENCE_DOC, group, item, price, rate_doc, write_json
from pyspark.errors import PySparkException

from ratescape.functions.profiles import ABA
from ratescape.operators.flatten import flatten_rates, missing_references, parse_counters, resolve_references
from ratescape.schemas import RATE_TABLE
from ratescape.session import scratch_path
from ratescape.sources.elements import file_paths
from ratescape.sources.rate_files import land_rate_files, landed_rate_files, read_rate_files


def by_docs(spark, paths):
    return read_rate_files(spark, paths, ABA)


def by_walk(spark, paths):
    landing = scratch_path(spark, "landing")
    land_rate_files(spark.createDataFrame([(p,) for p in paths], "path string"), landing, ABA)
    return landed_rate_files(spark, landing, ABA)


READERS = pytest.mark.parametrize("reader", [by_docs, by_walk])


@READERS
def test_inline_groups(spark, tmp_path, reader):
    files = reader(spark, [write_json(tmp_path / "a.json.gz", INLINE_DOC)])
    rates = flatten_rates(files, ABA, index_payer="idx")
    assert rates.schema.fieldNames() == RATE_TABLE.fieldNames()
    assert [f.dataType for f in rates.schema] == [f.dataType for f in RATE_TABLE]
    (row,) = rates.collect()
    assert row.index_payer == "idx"
    assert row.payer_name == "Prairie Mutual"
    assert row.schema_version == "1.3.1"
    assert row.service_category == "Supervision/Protocol Modification"
    assert row.negotiated_rate == 61.25
    assert row.percentage is None
    assert row.provider_npi_list == ["1043211118", "1870000025"]
    assert row.service_codes == ["02", "11"]
    assert row.is_global and row.is_benchmark_eligible
    counters = parse_counters(files, rates, ABA).first()
    assert (counters.scanned_items, counters.matched_items, counters.rows_written) == (2, 1, 1)


@READERS
def test_references(spark, tmp_path, reader):
    (row,) = flatten_rates(reader(spark, [write_json(tmp_path / "a.json", REFERENCE_DOC)]), ABA).collect()
    assert row.provider_npi_list == ["1629374650"]
    assert row.provider_tin_value == "470812345"
    assert row.billing_code_modifiers == []
    assert row.setting is None


@READERS
def test_cross_product_and_null_semantics(spark, tmp_path, reader):
    doc = rate_doc(
        item(
            "97153",
            {
                "provider_groups": [group(1), {"npi": [], "tin": None}],
                "provider_references": [7, "7", 8],
                "negotiated_prices": [
                    price(50, "percentage", billing_code_modifier=["TC", 26]),
                    price(None, billing_code_modifier=None, service_code=None),
                ],
            },
            {"provider_groups": None, "negotiated_prices": [price(1.0)]},
            {"provider_groups": [group(2)], "negotiated_prices": None},
        ),
        item("97151", negotiated_rates=None),
        item(97152, {"provider_groups": [group(3)], "negotiated_prices": [price("7.25")]}),
        references=[
            {"provider_group_id": 7, "provider_groups": [group(70)]},
            {"provider_group_id": None, "provider_groups": [group(99)]},
            {"provider_group_id": 8, "provider_groups": None},
            {"provider_group_id": 7, "provider_groups": [group(71), group(72)]},
        ],
    )
    rates = flatten_rates(reader(spark, [write_json(tmp_path / "a.json.gz", doc)]), ABA).collect()
    main = [r for r in rates if r.billing_code == "97153"]
    # (2 inline + 2 references x 2 groups of the last definition) x 2 prices
    npis = sorted(",".join(r.provider_npi_list) for r in main)
    assert npis == sorted(["1", "", "71", "72", "71", "72"] * 2)
    shares = [r for r in main if r.negotiated_type == "percentage"]
    assert {(r.negotiated_rate, r.percentage, r.is_technical_component, r.is_professional_component, r.is_global) for r in shares} == {
        (None, 50.0, True, True, False)
    }
    plain = [r for r in main if r.negotiated_type == "negotiated"]
    assert {(r.negotiated_rate, tuple(r.service_codes), r.is_benchmark_eligible) for r in plain} == {(None, (), False)}
    (numeric,) = [r for r in rates if r.billing_code == "97152"]
    assert numeric.negotiated_rate == 7.25
    assert len(rates) == 13


@READERS
def test_missing_reference_modes(spark, tmp_path, reader):
    rate = {"provider_references": [1, 2], "negotiated_prices": [price(5)]}
    broken = rate_doc(item("97153", rate), references=[{"provider_group_id": 1, "provider_groups": [group(1)]}])
    paths = [write_json(tmp_path / "bad.json", broken), write_json(tmp_path / "good.json", INLINE_DOC)]
    files = reader(spark, paths)
    assert [r.ref_id for r in missing_references(files).collect()] == ["2"]
    with pytest.raises(PySparkException, match="undefined provider reference 2"):
        flatten_rates(files, ABA).collect()
    kept = flatten_rates(files, ABA, on_missing="quarantine").collect()
    assert [r.source_file_url.endswith("good.json") for r in kept] == [True]
    assert flatten_rates(files, ABA, on_missing="skip").count() == 2
    with pytest.raises(ValueError, match="quarantine"):
        flatten_rates(files, ABA, on_missing="ignore")


@READERS
def test_same_reference_id_in_two_files(spark, tmp_path, reader):
    def doc(npi):
        rate = {"provider_references": [1], "negotiated_prices": [price(5)]}
        return rate_doc(item("97153", rate), references=[{"provider_group_id": 1, "provider_groups": [group(npi)]}])

    paths = [write_json(tmp_path / f"{n}.json", doc(n)) for n in (5, 6)]
    rates = flatten_rates(reader(spark, paths), ABA).collect()
    assert {(r.source_file_url[-6:], r.provider_npi_list[0]) for r in rates} == {("5.json", "5"), ("6.json", "6")}


@READERS
def test_unreadable_file_is_an_error_row(spark, tmp_path, reader):
    paths = [write_json(tmp_path / "bad.json", '{"in_network": [{"billing_code": "97153"'), write_json(tmp_path / "ok.json", INLINE_DOC)]
    files = reader(spark, paths)
    (error,) = files.errors.collect()
    assert error.source_file_url.endswith("bad.json")
    assert flatten_rates(files, ABA).count() == 1


@READERS
@pytest.mark.parametrize("field", ["provider_groups", "negotiated_prices"])
def test_an_element_that_breaks_the_schema_fails_its_file(spark, tmp_path, reader, field):
    sound = {"provider_groups": [group("1", ["1"])], "negotiated_prices": [price(1)]}
    bad = write_json(tmp_path / "bad.json", rate_doc(item("97153", sound, {**sound, field: "oops"})))
    good = write_json(tmp_path / "good.json", rate_doc(item("97153", sound)))
    files = reader(spark, [bad, good])
    assert [r.source_file_url.endswith("bad.json") for r in files.errors.collect()] == [True]
    assert [r.source_file_url.endswith("good.json") for r in files.entries.collect()] == [True]
    assert files.headers.count() == 1


def test_keys_in_any_order(spark, tmp_path):
    doc = json.loads(json.dumps(REFERENCE_DOC))
    moved = {"in_network": [dict(reversed(list(i.items()))) for i in doc["in_network"]], "extra": {"a": [1, {"b": None}]}}
    moved.update({k: v for k, v in doc.items() if k != "in_network"})
    path = write_json(tmp_path / "moved.json.gz", moved)
    walked = flatten_rates(by_walk(spark, [path]), ABA).collect()
    read = flatten_rates(by_docs(spark, [path]), ABA).collect()
    strip = lambda rows: [{**r.asDict(), "source_file_url": None} for r in rows]
    assert strip(walked) == strip(read)
    assert walked[0].payer_name == "Harbor Cooperative"


def test_rates_go_through_one_join(spark, tmp_path):
    write_json(tmp_path / "a.json", INLINE_DOC)
    entries = read_rate_files(spark, str(tmp_path / "a.json"), ABA).entries
    plan = entries._jdf.queryExecution().optimizedPlan().toString()
    assert plan[: plan.index("Relation [")].count("Join") == 1  # the rates come first and meet items that have their header


def test_files_left_out_go_before_rates_meet_their_items(spark, tmp_path):
    write_json(tmp_path / "a.json", INLINE_DOC)
    write_json(tmp_path / "b.json", REFERENCE_DOC)
    entries = read_rate_files(spark, str(tmp_path), ABA).entries
    out = entries.select("source_file_url").filter("source_file_url like '%/a.json'").distinct()
    kept = entries.join(out, "source_file_url", "left_anti")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftAnti" not in plan[: plan.index("Relation [")]  # the rates come first
    assert {r.source_file_url.rsplit("/", 1)[1] for r in kept.collect()} == {"b.json"}


def test_inline_groups_do_not_go_through_the_reference_join(spark):
    groups = "array<struct<npi:array<string>,tin:struct<type:string,value:string>>>"
    one, two = [(["1"], ("ein", "x"))], [(["2"], ("ein", "y"))]
    rows = [("f", 0, one, ["k", "k", None, "gone"]), ("f", 1, None, ["empty"]), ("f", 2, [], None), (None, 3, one, ["k"])]
    entries = spark.createDataFrame(rows, f"source_file_url string, rate_ord int, provider_groups {groups}, provider_references array<string>")
    references = spark.createDataFrame([("f", "k", two), ("f", "empty", None)], f"source_file_url string, ref_id string, ref_groups {groups}")
    resolved = resolve_references(entries, references)
    found = sorted((r.rate_ord, r.ref_id or "", None if r.groups is None else [g.npi for g in r.groups]) for r in resolved.collect())
    assert found == [(0, "", [["1"]]), (0, "gone", None), (0, "k", [["2"]]), (0, "k", [["2"]]), (1, "empty", []), (3, "", [["1"]]), (3, "k", None)]
    plan = resolved._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and plan.count("Join LeftOuter") == 1


def test_files_with_errors_are_found_once(spark, tmp_path):
    cut = tmp_path / "cut.json"
    cut.write_text('{"reporting_entity_name": "x", "in_network": [')
    files = by_docs(spark, [write_json(tmp_path / "a.json.gz", INLINE_DOC), str(cut)])
    assert {place.rsplit("/", 2)[1].split("-")[0] for place in files.errors.inputFiles()} == {"errors"}
    assert [r.source_file_url.rsplit("/", 1)[1] for r in files.errors.collect()] == ["cut.json"]
    assert files.headers.count() == 1


def test_folders_are_listed_in_few_tasks(spark, tmp_path):
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    spark.conf.set(setting, "10000")
    for n in range(40):
        (tmp_path / f"d{n}").mkdir()
        (tmp_path / f"d{n}" / "a.json").write_text("{}")
    assert file_paths(spark, str(tmp_path)).count() == 40
    assert int(spark.conf.get(setting)) <= 4 * spark.sparkContext.defaultParallelism
