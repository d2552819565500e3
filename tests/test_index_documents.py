"""Written index documents, plan classes and probe results, on small literals."""

import gzip
import json

from rate_docs import INLINE_DOC, REFERENCE_DOC, write_json

from ratescape.functions.profiles import ABA
from ratescape.operators.probe import probe_paths, probed_files, read_probe, write_probe
from ratescape.sources import indexes
from ratescape.sources.elements import read_documents

PLAN_A, PLAN_B = {"plan_id": "1", "plan_name": 'a "quoted"\nname'}, {"plan_id": "2"}
TOC = {
    "reporting_entity_name": "Lakeside, \\ \"Trust\"}",
    "version": "2",
    "reporting_structure": [
        {"reporting_plans": [PLAN_A, None, PLAN_B], "in_network_files": [{"location": "x", "description": None}, {"location": ""}, {"location": "y", "description": "why"}]},
        None,
        {"reporting_plans": [PLAN_B], "in_network_files": [{"location": "x", "description": "ex"}]},
        {"reporting_plans": [PLAN_A, PLAN_B], "in_network_files": [{"location": "z"}, None]},
        {"in_network_files": [{"location": "w"}]},
        {"reporting_plans": [PLAN_A], "in_network_files": None},
    ],
}


def written(spark, tmp_path, per_piece, dedupe=False):
    write_json(tmp_path / "toc.json", TOC)
    write_json(tmp_path / "none.json", {"version": "3", "reporting_structure": []})
    toc = indexes.read_toc(spark, [str(tmp_path / "toc.json"), str(tmp_path / "none.json")])
    structures = indexes.toc_structures(toc)
    files = indexes.toc_files(structures)
    entries = indexes.dedupe_files(files, indexes.TOC_ORDER).select(*indexes.INDEX_COLUMNS, "first_seen.*") if dedupe else indexes.toc_listings(structures)
    out = str(tmp_path / "out")
    indexes.write_index_documents(indexes.index_headers(toc, files), entries, out, per_piece)
    paths = sorted((tmp_path / "out").glob("document=*/piece=*/*.gz"))
    return out, [json.loads(gzip.open(p).read()) for p in paths], structures


def test_every_piece_is_a_document_with_the_whole_header(spark, tmp_path):
    out, docs, _ = written(spark, tmp_path, 2)
    mine = [d for d in docs if d["version"] == "2"]
    assert [[f["location"] for f in d["in_network_files"]] for d in mine] == [["x", "y"], ["x", "z"], ["w"]]
    assert {(d["reporting_entity_name"], d["reporting_structure_count"], d["in_network_file_count"]) for d in mine} == {(TOC["reporting_entity_name"], 6, 4)}
    (none,) = [d for d in docs if d["version"] == "3"]
    assert (none["in_network_files"], none["reporting_structure_count"], none["in_network_file_count"]) == ([], 0, 0)
    first = mine[0]["in_network_files"][0]
    assert first["description"] is None and first["reporting_plan_count"] == 2
    assert [(p["plan_id"], p["plan_name"]) for p in first["reporting_plans"]] == [("1", PLAN_A["plan_name"]), ("2", None)]


def test_what_is_written_is_read_back_in_order(spark, tmp_path):
    out, _, _ = written(spark, tmp_path, 1)
    listings = indexes.index_listings(read_documents(spark, out, "index")).orderBy("source_file_url", "file_ord")
    rows = [(r.location, r.description, r.reporting_plan_count, len(r.reporting_plans or [])) for r in listings.collect()]
    assert rows == [("x", None, 2, 2), ("y", "why", 2, 2), ("x", "ex", 1, 1), ("z", None, 2, 2), ("w", None, 0, 0)]
    merged = indexes.dedupe_files(listings, ["source_file_url", "file_ord"])
    assert {r.location: (r.description, r.reporting_plan_count) for r in merged.collect()} == {"x": ("ex", 3), "y": ("why", 2), "z": (None, 2), "w": (None, 0)}


def test_a_merged_index_without_plans_replaces_the_folder(spark, tmp_path):
    written(spark, tmp_path, 1)
    out, docs, _ = written(spark, tmp_path, 100, dedupe=True)
    (mine,) = [d for d in docs if d["version"] == "2"]
    assert [(f["location"], f["reporting_plan_count"]) for f in mine["in_network_files"]] == [("x", 3), ("y", 2), ("z", 2), ("w", 0)]
    assert indexes.read_native_index(spark, out).count() == 4


def test_plan_classes_keep_every_link(spark, tmp_path):
    _, _, structures = written(spark, tmp_path, 100)
    classes = indexes.plan_classes(structures)
    sizes = {(r.plans, r.files, r.listings) for r in indexes.plan_class_sizes(classes).collect()}
    assert sizes == {(2, 3, 3), (1, 1, 1), (1, 0, 0)}
    expanded = sorted((r.location, r.plan_ord, r.plan_id) for r in indexes.expand_plans(classes).collect())
    assert expanded == [("x", 0, "1"), ("x", 0, "2"), ("x", 1, "2"), ("y", 0, "1"), ("y", 1, "2"), ("z", 0, "1"), ("z", 1, "2")]
    none = indexes.plan_classes(structures.limit(0))
    assert [t.count() for t in none] == [0, 0]


def test_a_probe_goes_on_where_one_stopped(spark, tmp_path):
    good, other, cut = write_json(tmp_path / "a.json", INLINE_DOC), write_json(tmp_path / "b.json", REFERENCE_DOC), write_json(tmp_path / "c.json", '{"in_network": [')
    listed = lambda *paths: spark.createDataFrame([(p,) for p in paths], "path string")
    out = str(tmp_path / "probe")
    write_probe(probe_paths(listed(good, cut), ABA), out)
    write_json(cut, INLINE_DOC)
    write_probe(probe_paths(listed(other, cut), ABA), out)
    found = {r.source[-6:]: (r.status, r.has_match, r.matched_codes, r.error) for r in read_probe(spark, out).collect()}
    assert found == {"a.json": ("ok", True, ["97155"], None), "b.json": ("ok", True, ["97152"], None), "c.json": ("ok", True, ["97155"], None)}
    files = spark.createDataFrame([(good, 0), ("elsewhere", 1)], "location string, file_ord int")
    assert [r.file_ord for r in probed_files(files, read_probe(spark, out)).collect()] == [0]


def test_listings_take_their_plans_along_without_a_join(spark):
    plan = "struct<plan_name:string,plan_id:string>"
    rows = [("d", 0, [("P", "1"), None], [("x", None), ("", None)])] * 2  # a document that was read twice
    structures = spark.createDataFrame(rows, f"source_file_url string, structure_ord long, reporting_plans array<{plan}>, in_network_files array<struct<location:string,description:string>>")
    listings = indexes.toc_listings(structures)
    assert [(r["location"], r["reporting_plan_count"], len(r["reporting_plans"])) for r in listings.collect()] == [("x", 1, 1)] * 2
    assert "Join" not in listings._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_of_an_index_document_is_shuffled_once(spark, tmp_path, monkeypatch):
    dealt = []
    repartition = type(spark.range(0)).repartition
    monkeypatch.setattr(type(spark.range(0)), "repartition", lambda rows, *keys: (dealt.append(rows), repartition(rows, *keys))[1])
    written(spark, tmp_path, 2)
    last = dealt[-1]._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in last  # the window is behind the shuffle, not before it
