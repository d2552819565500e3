import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rate_table(spark):
    """Builds rate-table rows from partial dicts."""
    from ratescape.schemas import RATE_COLUMNS, RATE_TABLE

    def build(*rows):
        defaults = {
            "service_line": "aba",
            "billing_code": "97153",
            "billing_class": "professional",
            "negotiated_type": "fee schedule",
            "billing_code_modifiers": [],
            "provider_npi_list": ["1"],
            "is_benchmark_eligible": True,
            "payer_name": "P",
        }
        full = [{**dict.fromkeys(RATE_COLUMNS), **defaults, **row} for row in rows]
        return spark.createDataFrame([tuple(r[c] for c in RATE_COLUMNS) for r in full], RATE_TABLE)

    return build
