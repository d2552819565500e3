"""How the documents of the benchmark tables are made, on rows of its own."""

import datetime
import re

import pytest

from ratescape.functions.profiles import ABA
from ratescape.sources.rate_files import read_rate_files
from workload import fixtures as fx
from workload import queries


@pytest.fixture
def tables(spark, tmp_path):
    """Lines of two documents; one line comes twice, another has nulls."""
    day = datetime.datetime(2026, 1, 1)
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    lines = [(o, o % 40, 1 + o % 4, 1 + o % 7, 2.0, 8.0 * o, "ANR"[o % 3], "OF"[o % 2], day) for o in (*range(4080, 4110), 4090)]
    made = {
        "lineitem": spark.createDataFrame([*lines, (4081, 3, 1, None, None, None, None, None, None)], line),
        "part": spark.createDataFrame([(k, f"part {k}", "T") for k in range(40)], "p_partkey long, p_name string, p_type string"),
        "supplier": spark.createDataFrame([(k, f"s{k}", 0) for k in range(1, 5)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string"),
    }
    for name, rows in made.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("make", [fx.rate_docs, fx.broken_rate_docs, fx.rerun_rate_docs, fx.remote_rate_docs, fx.toc_docs, fx.broken_toc_docs])
def test_tables_are_joined_once_and_text_is_made_after_the_shuffle(spark, tables, monkeypatch, make):
    seen = []
    write = fx.write_documents
    monkeypatch.setattr(fx, "write_documents", lambda rows, *rest: (seen.append(rows), write(rows, *rest)))
    make(spark, tables)
    (rows,) = seen
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    lines = rows.filter("place.section = 3 and place.p1 = 1" if "toc" not in make.__name__ else "place.section = 1")
    assert lines.filter("line is not null").isEmpty()  # the bulk is not text yet


def test_documents_keep_every_line(spark, tables):
    files = read_rate_files(spark, fx.rate_docs(spark, tables), None, fx.doc_source())
    assert files.errors.isEmpty()
    rates = files.entries.filter("size(negotiated_prices) > 0")
    assert {r[0]: r[1] for r in rates.groupBy("source_file_url").count().collect()} == {"r0-b0": 18, "r0-b1": 14}
    prices = rates.selectExpr("source_file_url", "billing_code", "inline(negotiated_prices)")
    assert prices.filter("setting is null or billing_class is null").isEmpty()
    assert rates.filter("billing_code = '97153' and size(provider_references) = 1").count() == rates.filter("billing_code = '97153'").count() > 0


def test_plans_are_added_up_before_listings_meet_their_headers(spark, tables):
    read = queries.index_plans_roundtrip(spark, tables)
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("aggregate(")  # the sums are below the join
    assert read.filter("location = 'https://example.test/files/regional-1.json.gz'").selectExpr("sum(listings) = sum(plans) / 2").first()[0]


def test_shuffles_of_documents_go_once_they_are_written(spark, tables, monkeypatch):
    released = []
    monkeypatch.setattr(fx, "release_shuffles", released.append)
    fx.toc_docs(spark, tables)
    assert released == [spark]
