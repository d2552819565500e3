"""The json_elements source: pieces, filters that it takes, broken files, places of elements."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, IsNotNull, StringStartsWith
from rate_docs import INLINE_DOC, REFERENCE_DOC, item, price, rate_doc, write_json

from ratescape.functions.profiles import ABA
from ratescape.operators.flatten import flatten_rates
from ratescape.sources import elements, indexes
from ratescape.sources.rate_files import read_rate_files


def listed(spark, *paths):
    return spark.createDataFrame([(str(p),) for p in paths], "path string")


def test_filters_on_kind_and_code_are_taken_by_the_source(spark, tmp_path):
    doc = rate_doc(*[item(c, {"negotiated_prices": [price(n)]}) for c in ("97153", "97155", "90834") for n in range(3)])
    pieces = elements.read_elements(listed(spark, write_json(tmp_path / "a.json.gz", doc)), "rates")
    some = pieces.where((F.col("kind") == "rate") & F.col("code").isin("97153", "90834"))
    assert [(r.kind, r.code) for r in some.collect()] == [("rate", "97153")] * 3 + [("rate", "90834")] * 3
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "= rate)" not in plan and "IN (" not in plan  # Spark has no filter of its own left but for null codes
    assert pieces.where("kind = 'item'").count() == 9
    assert pieces.where("kind = 'rate' AND code = 'none'").count() == 0


def test_the_reader_gives_back_what_it_cannot_do():
    reader = elements.ElementReader({"layout": "rates", "listing": "x"})
    filters = [EqualTo(("kind",), "rate"), In(("code",), ("1", "2")), IsNotNull(("kind",)), IsNotNull(("code",)), StringStartsWith(("code",), "1"), EqualTo(("ord",), 3), EqualTo(("code",), "2")]
    assert list(reader.pushFilters(filters)) == [filters[3], filters[4], filters[5]]
    assert (reader.kinds, reader.only) == ({"rate"}, {"2"})


@pytest.mark.parametrize("window", [3, 1 << 20])
def test_elements_keep_their_places(spark, tmp_path, monkeypatch, window):
    from ratescape.sources import json_walk

    monkeypatch.setattr(json_walk, "BLOCK_BYTES", window)
    cases = {
        "[]": (0, []),
        "[null]": (1, []),
        '[{"a":1}]': (1, [0]),
        '[null , {"a":"]},["} ,"x,y",[{"b":2}],{},3]': (6, [1, 4]),
        '[{}, {} , null,{"c":[null,{}]},null]': (5, [0, 1, 3]),
    }
    for text, (count, places) in cases.items():
        path = write_json(tmp_path / "a.json", '{"files": %s, "version": "2"}' % text)
        *body, head = elements._flat_pieces(path, "files")
        assert [p[2] for p in body] == places
        assert [json.loads(p[4]) for p in body] == [e for e in json.loads(text) if isinstance(e, dict)]
        assert json.loads(head[4]) == {"version": "2", "element_count": count}


def test_broken_documents_have_errors_and_nothing_else(spark, tmp_path):
    good = {"version": "1", "reporting_structure": [{"in_network_files": [{"location": "x"}]}]}
    text = json.dumps(good)
    paths = [
        write_json(tmp_path / "good.json", good),
        write_json(tmp_path / "cut.json", text[:-3]),
        write_json(tmp_path / "type.json", {**good, "reporting_structure": [{"in_network_files": "oops"}, *good["reporting_structure"]]}),
        write_json(tmp_path / "list.json", "[1]"),
        str(tmp_path / "absent.json"),
    ]
    toc = indexes.read_toc(spark, listed(spark, *paths))
    assert [r.location for r in indexes.toc_files(indexes.toc_structures(toc)).collect()] == ["x"]
    assert [r.element_count for r in toc.headers.collect()] == [1]
    errors = {r.source_file_url.rsplit("/", 1)[1]: r.error_type for r in toc.errors.collect()}
    assert errors == {"cut.json": "ValueError", "type.json": "ValueError", "list.json": "ValueError", "absent.json": "FileNotFoundError"}
    none = elements.read_documents(spark, listed(spark), "toc")
    assert [t.count() for t in none] == [0, 0, 0]


def test_folders_globs_and_lists_of_files(spark, tmp_path):
    a, b = write_json(tmp_path / "a.json.gz", INLINE_DOC), write_json(tmp_path / "b.json", REFERENCE_DOC)
    for paths in (str(tmp_path), f"{tmp_path}/*.json*", [a, b]):
        files = read_rate_files(spark, paths, ABA)
        assert sorted(r.billing_code for r in flatten_rates(files, ABA).collect()) == ["97152", "97155"]
    every = read_rate_files(spark, a, None)
    assert (every.items.count(), every.entries.count()) == (2, 1)
