"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from workload.compare import difference, duckdb_connection
from workload.queries import QUERIES
from workload.reference_sql import SQL

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def duck():
    return duckdb_connection(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, SQL[name]) is None


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:3] == ["billing_code", "service_category", "billing_class"]
