"""Pages of a sorted table on small literals."""

import random

import pytest
from pyspark.sql import functions as F

from ratescape.operators.pages import page_index, read_page, read_pages, rows_after, with_positions, write_pages

ORDER = [("code", False), ("rate", True), ("id", False)]
rng = random.Random(3)
# a hot code, ties, nulls and repeated rows
ROWS = [("c" if i % 3 else rng.choice(["a", "d", None]), rng.choice([1.0, 2.5, None, 7.0]), i, [str(i % 2)]) for i in range(60)]
SCHEMA = "code string, rate double, id int, tags array<string>"


def key(row):
    return (row[0] is None, row[0] or "", row[1] is None, -(row[1] or 0), row[2])


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "t")
    rows = spark.createDataFrame(ROWS, SCHEMA).withColumn("page", F.lit("replaced"))
    write_pages(rows, ORDER, path, 7, range_rows=11)
    return path


def test_all_pages_together_are_the_sorted_table(spark, pages):
    read = [tuple(r)[:4] for n in range(10) for r in read_page(spark, pages, n).collect()]
    assert read == sorted(ROWS, key=key)
    table = read_pages(spark, pages)
    assert [r.position for r in table.orderBy("position").collect()] == list(range(60))
    index = {r.page: (r.row_count, r.first_id, r.last_id) for r in page_index(table, ["id"]).collect()}
    assert index == {n: (len(part), part[0][2], part[-1][2]) for n in range(9) for part in [read[7 * n : 7 * n + 7]]}
    assert "EqualTo(page,3)" in table.filter("page = 3")._jdf.queryExecution().executedPlan().toString()


def test_a_page_follows_from_the_values_of_the_last_row(spark, pages):
    table, expected = read_pages(spark, pages).drop("position", "page"), sorted(ROWS, key=key)
    for at in (0, 20, 41, 52, 58, 59):
        cursor = dict(zip(["code", "rate", "id"], expected[at], strict=False))
        assert [tuple(r) for r in rows_after(table, ORDER, cursor, 5).collect()] == expected[at + 1 : at + 6]


def test_no_rows_and_equal_rows(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    write_pages(empty, ORDER, str(tmp_path / "e"), 5)
    assert read_pages(spark, str(tmp_path / "e")).count() == 0
    write_pages(spark.createDataFrame([("x", 1.0, 1, [])] * 5, SCHEMA), [("code", True)], str(tmp_path / "s"), 2, range_rows=1)
    assert sorted((r.position, r.page) for r in read_pages(spark, str(tmp_path / "s")).collect()) == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)]


def test_rows_are_not_shuffled_for_their_positions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.createDataFrame([(r << 33 | i, f"{r}{i}") for r in (0, 1, 2) for i in range(r + 2)], "_place long, name string")
        paged = with_positions(stored, 4)
        plan = paged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        found = {r.name: (r.position, r.page) for r in paged.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == {name: (n, n // 4) for n, name in enumerate(["00", "01", "10", "11", "12", "20", "21", "22", "23"])}
