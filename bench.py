"""Timings of the headline queries; prints one JSON line.

The rate table and the registry are written once, as in production, and every
query reads them. Each query runs once to warm up and is then timed. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from ratescape.functions.profiles import ABA
from ratescape.operators import distribution as dist
from ratescape.operators import providers as prov
from ratescape.operators import rate_query as rq
from ratescape.operators.flatten import flatten_rates
from ratescape.operators.probe import probe_paths
from ratescape.plans.presets import run_preset
from ratescape.session import scratch_path
from ratescape.sources.rate_files import land_rate_files, landed_rate_files, read_rate_files
from ratescape.sources.rate_tables import read_rates, write_rates
from ratescape.sources.registry import read_registry, write_registry
from workload import fixtures as fx
from workload.queries import CPT, QUERIES, _doc_paths

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Small data: let writes keep all cores busy instead of aiming at 64 MB files.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(times: dict[str, float], name: str, work):
    start = time.perf_counter()
    result = work()
    times[name] = round(time.perf_counter() - start, 3)
    print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    return result


def flatten_large(spark: SparkSession) -> DataFrame:
    landing = scratch_path(spark, "landing")
    land_rate_files(_doc_paths(spark, fx.rate_docs(spark, SF_DIR)), landing, ABA)
    return flatten_rates(landed_rate_files(spark, landing, ABA), ABA, on_missing="skip")


def main() -> None:
    spark = session()
    run(QUERIES["summary_by_code"](spark, SF_DIR))  # starts the JVM's compilers
    docs_path = fx.rate_docs(spark, SF_DIR)

    times: dict[str, float] = {}
    rates_path, registry_path = scratch_path(spark, "rates"), scratch_path(spark, "registry")
    plain_path = scratch_path(spark, "plain")
    fx.rates(spark, SF_DIR).write.parquet(plain_path)
    timed(times, "write_rates", lambda: write_rates(read_rates(spark, plain_path), rates_path))
    write_registry(fx.npi_names(spark, SF_DIR), registry_path)
    rates, registry = read_rates(spark, rates_path), read_registry(spark, registry_path)
    run(rq.run_query(rates, summary=True))

    ingest = {
        "flatten_rates": lambda: flatten_rates(
            read_rate_files(spark, docs_path, ABA, fx.doc_source()), ABA, on_missing="skip"
        ),
        "flatten_rates_large": lambda: flatten_large(spark),
        "probe_files": lambda: probe_paths(_doc_paths(spark, docs_path), ABA),
        "toc_files": lambda: QUERIES["toc_files"](spark, SF_DIR),
        "index_dedupe": lambda: QUERIES["index_dedupe"](spark, SF_DIR),
        "vendor_index": lambda: QUERIES["vendor_index"](spark, SF_DIR),
        "npi_registry": lambda: QUERIES["npi_registry"](spark, SF_DIR),
        "batch_plan": lambda: QUERIES["batch_plan"](spark, SF_DIR),
    }
    queries = {
        "query_rows": lambda: rq.run_query(rates, limit=100),
        "summary_global": lambda: rq.run_query(rates, summary=True),
        "summary_by_code": lambda: rq.run_query(
            rates, group_by="billing_code,service_category,billing_class", summary=True, limit=10_000
        ),
        "preset_aba_benchmark_summary": lambda: run_preset(rates, "aba_benchmark_summary"),
        "preset_aba_raw_summary": lambda: run_preset(rates, "aba_raw_summary"),
        "preset_97153_benchmark_rows": lambda: run_preset(rates, "aba_97153_benchmark_rows"),
        "raw_vs_benchmark": lambda: rq.raw_and_benchmark(rates, service_line="aba"),
        "facets": lambda: rq.facets(rates),
        "npi_summary": lambda: prov.npi_summary(rates, registry),
        "provider_rates_median": lambda: prov.provider_rates_median(rates, registry, CPT),
        "plan_rates_median": lambda: prov.plan_rates_median(rates, registry, CPT),
        "plan_rates": lambda: prov.plan_rates(rates, registry, CPT),
        "rate_distribution_stats": lambda: dist.rate_distribution(rates, registry, CPT)[0],
        "rate_distribution_bins": lambda: dist.rate_distribution(
            rates, registry, CPT, provider_filter="excl_phys"
        )[1],
    }
    # Fixture files of the index queries are written here, untimed.
    fx.toc_docs(spark, SF_DIR), fx.vendor_docs(spark, SF_DIR), fx.registry_csv(spark, SF_DIR)
    for name, build in {**ingest, **queries}.items():
        run(build())  # warm
        timed(times, name, lambda build=build: run(build()))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
