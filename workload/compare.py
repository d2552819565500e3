"""Run queries and their SQL side by side and compare all rows.

    python -m workload.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    """Rows as sorted tuples with columns in name order."""
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in place) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    result = con.execute(sql)
    expected_columns = [c[0] for c in result.description]
    expected = sorted_rows(expected_columns, result.fetchall())
    actual = sorted_rows(spark_df.columns, spark_df.collect())
    if sorted(spark_df.columns) != sorted(expected_columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(expected_columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected, strict=True) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(actual)} rows differ, first: {wrong[0][0]} != {wrong[0][1]}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    from workload.queries import QUERIES
    from workload.reference_sql import SQL

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_connection(sf_dir)
    failed = 0
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = difference(query(spark, sf_dir), con, SQL[name]) if name in SQL else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:30s} {time.time() - start:7.2f}s {problem or 'equal'}", flush=True)
    print(f"{failed} not equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
