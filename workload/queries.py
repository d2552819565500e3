"""Every operator of the library as a query over the benchmark tables.

Lists are returned as comma text, so that results compare as plain values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescape.functions import columns as col
from ratescape.functions.profiles import ABA, RADIOLOGY, classify_codes, in_code_table, narrow_profile, profile_codes
from ratescape.operators import contracts as own
from ratescape.operators import distribution as dist
from ratescape.operators import providers as prov
from ratescape.operators import rate_query as rq
from ratescape.operators import sketches
from ratescape.operators.flatten import (
    flatten_rates,
    missing_references,
    parse_counters,
    resolve_references,
)
from ratescape.operators.pages import page_index, read_pages, write_pages
from ratescape.operators.probe import probe_paths, probe_summary, probed_files, read_probe, write_probe
from ratescape.plans.batch import batch_counters, plan_batch, read_manifest, run_batch, write_events
from ratescape.plans.presets import run_preset
from ratescape.plans.runs import commit_run, new_run, read_live_rates, read_live_values, read_run_events, write_run
from ratescape.schemas import RATE_COLUMNS
from ratescape.session import list_in_few_tasks, materialize, scratch_path
from ratescape.sources import indexes
from ratescape.sources.contracts import contract_rates, read_contracts
from ratescape.sources.elements import file_paths, kind_of, landed_elements, read_documents
from ratescape.sources.rate_files import land_rate_files, landed_rate_files, read_rate_files
from ratescape.sources.rate_tables import read_rates, write_rates
from ratescape.sources.remote_references import read_remote_references, unresolved_references
from ratescape.sources.registry import npi_registry, read_registry_csv
from ratescape.streaming.incremental import ingest_new_files, ingest_runs
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

CPT = "97153"
TEXAS = "Blue Cross and Blue Shield of Texas"
BASE_URL = "https://egress.example.test/payer/latest/"


def _rates(transform: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: transform(fx.rates(spark, sf_dir))


def _listed(rows: DataFrame, *names: str) -> DataFrame:
    """List columns as comma text."""
    return rows.withColumns({name: F.array_join(name, ",") for name in names})


# --- ingest ---------------------------------------------------------------


def _files(spark: SparkSession, sf_dir: str, profile=ABA):
    return read_rate_files(spark, fx.rate_docs(spark, sf_dir), profile, fx.doc_source())


def _flat(rows: DataFrame) -> DataFrame:
    return _listed(
        rows.select(*RATE_COLUMNS), "service_codes", "billing_code_modifiers", "provider_npi_list"
    )


def ingest_rate_docs(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    land_rate_files(file_paths(spark, fx.rate_docs(spark, sf_dir)), landing)
    pieces = landed_elements(spark, landing, "rates").withColumn("source", fx.doc_source())
    counts = pieces.groupBy("source").agg(*[F.count_if(F.col("kind") == k).alias(k + "s") for k in ("item", "rate", "reference")])
    headers = kind_of(pieces, "rates", "header", "source").drop("source_file_url")
    return headers.join(counts, "source").withColumnRenamed("references", "refs")


def provider_refs(spark, sf_dir):
    refs = _files(spark, sf_dir).references
    return refs.select(
        F.col("source_file_url").alias("source"),
        "ref_id",
        F.array_join(F.flatten(F.transform("ref_groups", lambda g: g["npi"])), ",").alias("npis"),
    )


def profile_filter(spark, sf_dir):
    entries = _files(spark, sf_dir).entries
    return entries.groupBy(F.col("source_file_url").alias("source"), "billing_code").agg(
        F.count(F.lit(1)).alias("entries")
    )


def flatten_aba(spark, sf_dir):
    files = _files(spark, sf_dir)
    return _flat(flatten_rates(files, ABA, index_payer="payer-index", on_missing="quarantine"))


def flatten_radiology(spark, sf_dir):
    files = _files(spark, sf_dir, RADIOLOGY)
    return _flat(flatten_rates(files, RADIOLOGY, index_payer="payer-index", on_missing="skip"))


def flatten_category(spark, sf_dir):
    """Only codes of one category are parsed further."""
    profile = narrow_profile(ABA, service_category="Direct Treatment")
    return _flat(flatten_rates(_files(spark, sf_dir, profile), profile, index_payer="payer-index", on_missing="skip"))


def _doc_paths(spark: SparkSession, folder: str) -> DataFrame:
    list_in_few_tasks(spark)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.gz")
        .load(folder)
        .select("path")
    )


def _stable_source(rows: DataFrame, column: str = "source_file_url") -> DataFrame:
    return rows.withColumn(column, F.regexp_extract(column, r"doc_id=([^/]+)", 1))


def flatten_large(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    land_rate_files(_doc_paths(spark, fx.rate_docs(spark, sf_dir)), landing, ABA)
    files = landed_rate_files(spark, landing, ABA)
    rates = flatten_rates(files, ABA, index_payer="payer-index", on_missing="quarantine")
    return _flat(_stable_source(rates))


def resolve_refs(spark, sf_dir):
    files = _files(spark, sf_dir)
    resolved = resolve_references(files.entries, files.references)
    return resolved.groupBy(F.col("source_file_url").alias("source"), "billing_code").agg(
        F.count_if(F.col("ref_id").isNull()).alias("inline_origins"),
        F.count_if(F.col("ref_id").isNotNull() & F.col("groups").isNotNull()).alias("resolved"),
        F.count_if(F.col("groups").isNull()).alias("missing"),
    )


def missing_refs(spark, sf_dir):
    return missing_references(_files(spark, sf_dir)).withColumnRenamed("source_file_url", "source")


def _remote(spark, sf_dir):
    files = read_rate_files(spark, fx.remote_rate_docs(spark, sf_dir), ABA, fx.doc_source())
    return files, read_remote_references(spark, files, fx.reference_docs(spark, sf_dir))


def remote_refs(spark, sf_dir):
    """Rates whose provider groups are partly in reference files."""
    return _flat(flatten_rates(_remote(spark, sf_dir)[1].files, ABA, index_payer="payer-index", on_missing="skip"))


def remote_refs_missing(spark, sf_dir):
    """References that stay undefined, and why."""
    return unresolved_references(*_remote(spark, sf_dir)).withColumnRenamed("source_file_url", "source")


def remote_refs_quarantine(spark, sf_dir):
    """Rates per file once those that use an undefined reference are left out."""
    rates = flatten_rates(_remote(spark, sf_dir)[1].files, ABA, on_missing="quarantine")
    return rates.groupBy(F.col("source_file_url").alias("source")).agg(F.count(F.lit(1)).alias("row_count"))


def counters(spark, sf_dir):
    files = _files(spark, sf_dir)
    rates = flatten_rates(files, ABA, on_missing="quarantine")
    return parse_counters(files, rates, ABA).withColumnRenamed("source_file_url", "source")


def _probe(spark, sf_dir, **options):
    return _stable_source(probe_paths(_doc_paths(spark, fx.rate_docs(spark, sf_dir)), ABA, **options), "source")


def probe_first(spark, sf_dir):
    return _listed(_probe(spark, sf_dir), "matched_codes")


def probe_full(spark, sf_dir):
    return _listed(_probe(spark, sf_dir, stop_on_match=False), "matched_codes")


def probe_large(spark, sf_dir):
    rows = probe_paths(_doc_paths(spark, fx.rate_docs(spark, sf_dir)), ABA)
    return _listed(_stable_source(rows, "source"), "matched_codes")


def _streamed(spark, sf_dir):
    out = scratch_path(spark, "stream-rates")
    query = ingest_new_files(
        spark,
        fx.rate_docs(spark, sf_dir),
        profile_name="aba",
        out_path=out,
        checkpoint_path=scratch_path(spark, "stream-state"),
        index_payer="payer-index",
    )
    query.awaitTermination()
    return out


def stream_ingest(spark, sf_dir):
    return _flat(_stable_source(read_rates(spark, f"{_streamed(spark, sf_dir)}/batch_id=*")))


def stream_events(spark, sf_dir):
    events = spark.read.parquet(f"{_streamed(spark, sf_dir)}-events/batch_id=*")
    return _stable_source(events).withColumnRenamed("source_file_url", "source")


def _streamed_runs(spark, sf_dir):
    """Three batches or so, each a committed run."""
    docs, out = fx.rate_docs(spark, sf_dir), scratch_path(spark, "stream-runs")
    batch = -(-_doc_paths(spark, docs).count() // 3)
    ingest_runs(
        spark,
        docs,
        profile_name="aba",
        out_path=out,
        checkpoint_path=scratch_path(spark, "stream-runs-state"),
        index_payer="payer-index",
        max_files=batch,
    ).awaitTermination()
    return out


def stream_large(spark, sf_dir):
    """The live table after a stream whose batches are runs."""
    return _flat(_stable_source(read_live_rates(spark, _streamed_runs(spark, sf_dir))))


def stream_run_events(spark, sf_dir):
    """What became of each streamed file."""
    events = read_run_events(spark, _streamed_runs(spark, sf_dir))
    return _stable_source(events, "source").select("source", "status", "error", "rows_written")


def written_rates(spark, sf_dir):
    path = scratch_path(spark, "rates")
    write_rates(fx.rates(spark, sf_dir), path)
    return _flat(read_rates(spark, path))


def scan_many(spark, sf_dir):
    path = scratch_path(spark, "many")
    rates = fx.rates(spark, sf_dir)
    local = F.col("payer_name").isin(*fx.PAYERS)
    write_rates(rates.filter(local), f"{path}/known-aba", partition_by=())
    # The second table lacks a column; the third glob matches nothing.
    rates.filter(~local).drop("additional_information", "setting").write.parquet(f"{path}/other-aba")
    globs = f"{path}/known-aba/*.parquet, {path}/other-aba/*.parquet,{path}/empty-aba/*.parquet"
    return read_rates(spark, globs).groupBy("payer_name", "setting").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def ingest_errors(spark, sf_dir):
    """Files that are cut short or break the schema, and what is read of the others."""
    files = read_rate_files(spark, fx.broken_rate_docs(spark, sf_dir), ABA, fx.doc_source())
    failed = files.errors.select(F.col("source_file_url").alias("source"), "error_type", "error", F.lit(None).cast("long").alias("entries"))
    read = files.entries.groupBy(F.col("source_file_url").alias("source")).agg(F.count(F.lit(1)).alias("entries"))
    return failed.unionByName(read, allowMissingColumns=True)


def toc_errors(spark, sf_dir):
    toc = indexes.read_toc(spark, fx.broken_toc_docs(spark, sf_dir), fx.doc_source())
    failed = toc.errors.select(F.col("source_file_url").alias("source"), "error_type", "error", F.lit(None).cast("long").alias("files"))
    read = indexes.toc_files(indexes.toc_structures(toc)).groupBy(F.col("source_file_url").alias("source")).agg(F.count(F.lit(1)).alias("files"))
    return failed.unionByName(read, allowMissingColumns=True)


# --- indexes and batch ----------------------------------------------------


def _structures(spark, sf_dir):
    toc = indexes.read_toc(spark, fx.toc_docs(spark, sf_dir), fx.doc_source())
    return indexes.toc_structures(toc)


def toc_files_large(spark, sf_dir):
    toc = indexes.read_toc(spark, _doc_paths(spark, fx.toc_docs(spark, sf_dir)))
    return _toc_listing(_stable_source(indexes.toc_files(indexes.toc_structures(toc))))


def toc_files(spark, sf_dir):
    return _toc_listing(indexes.toc_files(_structures(spark, sf_dir)))


def _toc_listing(files):
    return files.select(
        F.col("source_file_url").alias("source"),
        F.col("structure_ord").cast("long").alias("structure_ord"),
        F.col("file_ord").cast("long").alias("file_ord"),
        "location",
        "description",
        "reporting_plan_count",
    )


def toc_file_plans(spark, sf_dir):
    plans = indexes.toc_file_plans(_structures(spark, sf_dir))
    return plans.groupBy("location", "plan_name", "plan_id_type", "plan_id").agg(
        F.count(F.lit(1)).alias("listings")
    )


def plan_classes(spark, sf_dir):
    """Files x plans once more, from plan lists told apart by content."""
    plans = indexes.expand_plans(indexes.plan_classes(_structures(spark, sf_dir)))
    return plans.groupBy("location", "plan_name", "plan_id_type", "plan_id").agg(F.sum("listings").alias("listings"))


def plan_class_sizes(spark, sf_dir):
    """What the classes save: plans, files and listings of each list of plans, named by its first plan."""
    classes = indexes.plan_classes(_structures(spark, sf_dir))
    first = classes.members.filter("plan_ord = 0").select("plan_class", F.col("plan_id").alias("first_plan"))
    return indexes.plan_class_sizes(classes).join(first, "plan_class").drop("plan_class")


def index_dedupe(spark, sf_dir):
    files = indexes.toc_files(_structures(spark, sf_dir))
    return indexes.dedupe_files(files, indexes.TOC_ORDER).select(*indexes.INDEX_COLUMNS)


def index_headers(spark, sf_dir):
    toc = indexes.read_toc(spark, fx.toc_docs(spark, sf_dir), fx.doc_source())
    files = indexes.toc_files(indexes.toc_structures(toc))
    return (
        indexes.index_headers(toc, files)
        .withColumn("reporting_structure_count", F.col("reporting_structure_count").cast("long"))
        .withColumnRenamed("source_file_url", "source")
    )


def index_files(spark, sf_dir):
    files = indexes.read_native_index(spark, fx.index_docs(spark, sf_dir), fx.doc_source())
    return files.select(
        F.col("source_file_url").alias("source"), "location", "description", "content_length_bytes"
    )


def index_written(spark, sf_dir):
    path = scratch_path(spark, "index")
    files = indexes.toc_files(_structures(spark, sf_dir))
    merged = indexes.dedupe_files(files, indexes.TOC_ORDER).select(*indexes.INDEX_COLUMNS)
    indexes.write_index(merged, path)
    return spark.read.schema(merged.schema).json(path)


def _vendor(spark, sf_dir):
    return indexes.read_vendor_metadata(spark, fx.vendor_docs(spark, sf_dir), fx.doc_source())


def vendor_index(spark, sf_dir):
    return indexes.vendor_index(_vendor(spark, sf_dir), BASE_URL).select(*indexes.INDEX_COLUMNS)


def vendor_file_plans(spark, sf_dir):
    plans = indexes.vendor_file_plans(_vendor(spark, sf_dir), BASE_URL)
    return plans.groupBy("location", "plan_name", "plan_id").agg(F.count(F.lit(1)).alias("listings"))


def vendor_header(spark, sf_dir):
    return indexes.vendor_header(_vendor(spark, sf_dir), BASE_URL).withColumnRenamed("source_file_url", "source")


def batch_plan(spark, sf_dir):
    planned = plan_batch(
        fx.index_files(spark, sf_dir),
        fx.manifest_events(spark, sf_dir),
        "aba",
        out_dir="out/",
        max_size_mb=3.5,
    )
    return planned


def batch_manifest(spark, sf_dir):
    path = scratch_path(spark, "manifest")
    events = fx.manifest_events(spark, sf_dir)
    done = F.col("status") == "succeeded"
    write_events(events.filter(done), path)
    write_events(events.filter(~done), path)
    return read_manifest(spark, path)


def batch_run(spark, sf_dir):
    files = _doc_paths(spark, fx.rate_docs(spark, sf_dir)).select(
        F.col("path").alias("location"),
        F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("long").alias("content_length_bytes"),
        F.col("path").alias("file_ord"),
    )
    events = run_batch(
        spark,
        files,
        profile_name="aba",
        out_path=scratch_path(spark, "batch-rates"),
        manifest_path=scratch_path(spark, "batch-manifest"),
    )
    return _stable_source(events, "source").select(
        "source", "status", "profile", "scanned_items", "matched_items", "rows_written", "error"
    )


def index_roundtrip(spark, sf_dir):
    """The merged index written as bounded documents and read back, with the place of each listing."""
    toc = indexes.read_toc(spark, fx.toc_docs(spark, sf_dir), fx.doc_source())
    files = indexes.toc_files(indexes.toc_structures(toc))
    merged = indexes.dedupe_files(files, indexes.TOC_ORDER).select(*indexes.INDEX_COLUMNS, "first_seen.*")
    return _reread(spark, indexes.index_headers(toc, files), merged)[1].drop("reporting_plans", "source_file_url")


def index_plans_roundtrip(spark, sf_dir):
    """All listings with their plans written and read back, then merged; plans add up."""
    toc = indexes.read_toc(spark, fx.toc_docs(spark, sf_dir), fx.doc_source())
    structures = indexes.toc_structures(toc)
    headers = indexes.index_headers(toc, indexes.toc_files(structures))
    read, listings = _reread(spark, headers, indexes.toc_listings(structures))
    named = read.headers.select("source_file_url", F.col("reporting_entity_name").alias("entity"), "version")
    ids = F.aggregate("reporting_plans", F.lit(0).cast("long"), lambda total, p: total + p["plan_id"].cast("long"))
    # Plans are added up before the join, so that their lists are not shuffled.
    counted = listings.select("source_file_url", "location", "reporting_plan_count", ids.alias("plan_ids"), F.size("reporting_plans").alias("plans"))
    return counted.join(named, "source_file_url").groupBy("location", "entity", "version").agg(
        F.sum("reporting_plan_count").alias("reporting_plan_count"),
        F.count(F.lit(1)).alias("listings"),
        F.sum("plan_ids").alias("plan_ids"),
        F.sum("plans").alias("plans"),
    )


def _reread(spark, headers, entries):
    path = scratch_path(spark, "index-documents")
    indexes.write_index_documents(headers, entries, path, structures_per_piece=1_000)
    read = read_documents(spark, path, "index")
    piece = F.regexp_extract("source_file_url", r"piece=(\d+)", 1).cast("long")
    return read, indexes.index_listings(read).withColumn("piece", piece).withColumnRenamed("file_ord", "place")


def probe_written(spark, sf_dir):
    """A probe in two parts, kept as JSON lines; the files it found, planned for parsing."""
    files = _located(spark, fx.rate_docs(spark, sf_dir))
    path = scratch_path(spark, "probe")
    first = F.col("location").startswith("r0-") | F.col("location").startswith("r1-")
    for part in (files.filter(first), files.filter(~first)):
        write_probe(_stable_source(probe_paths(part, ABA), "source"), path)
    probe = read_probe(spark, path)
    planned = plan_batch(probed_files(files, probe), fx.manifest_events(spark, sf_dir), "aba", out_dir="out/")
    return _listed(probe, "matched_codes").join(planned.select("source", "out_path", F.col("status").alias("plan")), "source", "left")


def batch_remote(spark, sf_dir):
    """A batch whose files use reference files, some of which are missing or broken."""
    events = run_batch(
        spark,
        _located(spark, fx.remote_rate_docs(spark, sf_dir)),
        profile_name="aba",
        out_path=scratch_path(spark, "batch-rates"),
        manifest_path=scratch_path(spark, "batch-manifest"),
        reference_files=fx.reference_docs(spark, sf_dir),
    )
    return events.select("source", "status", "profile", "scanned_items", "matched_items", "rows_written", "error")


def _located(spark, folder):
    """Index rows of a folder's documents; a location is a document's name, wherever its file is."""
    name = F.regexp_extract("path", r"doc_id=([^/]+)", 1)
    null = F.lit(None).cast("string")
    return _doc_paths(spark, folder).select(
        name.alias("location"), null.alias("description"), null.cast("long").alias("content_length_bytes"), name.alias("file_ord"), "path"
    )


def batch_rerun(spark, sf_dir):
    """The live table after files were parsed again: with fewer rates, none, or a fault; and after a run that died before its commit."""
    first, later = _located(spark, fx.rate_docs(spark, sf_dir)), _located(spark, fx.rerun_rate_docs(spark, sf_dir))
    out, manifest = scratch_path(spark, "rerun-rates"), scratch_path(spark, "rerun-manifest")
    options = {"profile_name": "aba", "out_path": out, "manifest_path": manifest, "index_payer": "payer-index"}
    run_batch(spark, first, **options)
    dead = read_rate_files(spark, later.select("path", F.col("location").alias("name")), ABA)
    write_run(flatten_rates(dead, ABA, on_missing="skip"), out, new_run())
    again = later.filter(F.substring("location", 2, 1).isin("0", "1", "3"))
    run_batch(spark, again, manifest=read_manifest(spark, manifest), overwrite=True, **options)
    return _flat(read_live_rates(spark, out))


def summary_incremental(spark, sf_dir):
    """A summary from value counts kept up by three runs; the third replaces sources that the first had wrong."""
    rates = fx.rates(spark, sf_dir)
    part = F.crc32("source_file_url") % 3
    out = scratch_path(spark, "value-runs")
    wrong = F.when(part == 1, F.col("negotiated_rate") * 2 + 1).otherwise(F.col("negotiated_rate"))
    runs = [rates.filter(part != 2).withColumn("negotiated_rate", wrong), rates.filter(part == 2), rates.filter(part == 1)]
    for run in runs:
        run_id = new_run()
        write_run(run, out, run_id)
        commit_run(run.select(F.col("source_file_url").alias("source"), F.lit("all").alias("profile")), out, run_id)
    return rq.run_summary(read_live_values(spark, out), group_by="billing_code,service_category,billing_class")


def output_name(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", col.output_name(F.col("url"), "aba").alias("output_name"))


def source_hosts(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", col.source_host(F.col("url")).alias("host"))


def index_url_by_month(spark, sf_dir):
    day = F.col("o_orderdate")
    orders = fx.table(spark, sf_dir, "orders")
    return (
        orders.groupBy(F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .withColumn("index_url", col.index_url(F.col("year"), F.col("month")))
        .select(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), "orders", "index_url")
    )


# --- derived columns ------------------------------------------------------


def _line_rates(spark, sf_dir):
    return fx.raw_lines(spark, sf_dir)


def classify_aba(spark, sf_dir):
    codes = fx.raw_lines(spark, sf_dir).groupBy("billing_code").agg(F.count(F.lit(1)).alias("lines"))
    return classify_codes(codes, "aba")


def classify_radiology(spark, sf_dir):
    codes = fx.raw_lines(spark, sf_dir).groupBy("billing_code").agg(F.count(F.lit(1)).alias("lines"))
    listed = profile_codes(spark, "radiology")
    return codes.join(listed, "billing_code").select(*codes.columns, *listed.columns[1:])


def component_flags(spark, sf_dir):
    lines = _line_rates(spark, sf_dir)
    flags = col.component_flags(F.col("billing_code_modifiers"))
    return lines.select(*fx.LINE_KEYS, *[c.alias(n) for n, c in flags.items()])


def rate_percentage_split(spark, sf_dir):
    lines = _line_rates(spark, sf_dir)
    split = col.rate_and_percentage(F.col("negotiated_type"), F.col("raw_rate"))
    return lines.select(*fx.LINE_KEYS, "negotiated_type", *[c.alias(n) for n, c in split.items()])


def benchmark_flag(rates):
    return rates.groupBy("service_line", "billing_class", "negotiated_type", "is_benchmark_eligible").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("negotiated_rate").alias("max_rate")
    )


def status_modifier_filter(rates):
    kept = rates.filter(col.without_status_modifiers(F.col("billing_code_modifiers")))
    return (
        kept.withColumn("modifiers", col.modifiers_text(F.col("billing_code_modifiers")))
        .groupBy("billing_code", "modifiers")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def plan_names(rates):
    named = rates.withColumn("plan_name", col.plan_name(F.col("source_file_url")))
    return named.groupBy("plan_name", col.is_named_plan(F.col("plan_name")).alias("is_named")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def taxonomy_labels(spark, sf_dir):
    names = fx.npi_names(spark, sf_dir)
    return names.select(
        "npi", "primary_taxonomy", col.taxonomy_label("primary_taxonomy").alias("label")
    )


def npi_registry_query(spark, sf_dir):
    return npi_registry(read_registry_csv(spark, fx.registry_csv(spark, sf_dir)))


def npi_exploded(rates):
    exploded = prov.by_provider(rates, "billing_code", "negotiated_rate")
    return exploded.groupBy("npi", "billing_code").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("negotiated_rate").alias("max_rate")
    )


def modifier_convention(spark, sf_dir):
    """Rows that pass each payer's convention for each code and credential."""
    rates = fx.rates(spark, sf_dir)
    modifiers = F.col("billing_code_modifiers")
    payers = (*fx.PAYERS, None)
    passes = []
    for payer in payers:
        at = F.col("payer_name") == payer if payer else ~F.col("payer_name").isin(*fx.PAYERS)
        for code in ("97151", CPT):
            for modifier in ("HM", "HO"):
                test = col.credential_filter(payer, code, modifier, modifiers)
                test = F.lit(True) if test is None else test
                passes.append(
                    F.when(at & (F.col("billing_code") == code) & test, F.lit(modifier))
                )
    credential = F.filter(F.array(*passes), lambda m: m.isNotNull())
    return (
        rates.select("payer_name", "billing_code", F.explode(credential).alias("credential"))
        .groupBy("payer_name", "billing_code", "credential")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


# --- contracts ------------------------------------------------------------


def _contracts(spark, sf_dir):
    lines = read_contracts(spark, fx.contract_csv(spark, sf_dir))
    return contract_rates(lines)


def contract_lookup(spark, sf_dir):
    requests = (
        fx.rates(spark, sf_dir)
        .select(
            "payer_name",
            "billing_code",
            F.explode_outer("billing_code_modifiers").alias("modifier"),
        )
        .fillna("", "modifier")
        .distinct()
    )
    return own.contract_lookup(requests, _contracts(spark, sf_dir))


def payer_contracts(spark, sf_dir):
    return own.payer_contracts(_contracts(spark, sf_dir))


def contract_bin(spark, sf_dir):
    rates = fx.rates(spark, sf_dir)
    bins = dist.rate_distribution(rates, None, CPT, "HM", TEXAS)[1]
    # A scalar subquery takes no line order: it starts from the stored schedule.
    schedule = materialize(_contracts(spark, sf_dir), "contracts")
    mine = own.payer_contracts(schedule).filter(
        (F.col("payer_name") == TEXAS) & (F.col("cpt") == CPT) & (F.col("modifier") == "HM")
    )
    return dist.mark_contract_bin(bins, mine.withColumnRenamed("rate", "contract_rate"))


# --- providers and distribution -------------------------------------------


def _with_registry(transform) -> Query:
    return lambda spark, sf_dir: transform(fx.rates(spark, sf_dir), fx.npi_names(spark, sf_dir))


# Caps of the provider tables.
TOP_PROVIDERS, MAX_PROVIDERS = 500, 10_000


def _plan_rates(rates, registry, limit=MAX_PROVIDERS):
    table = prov.plan_rates(rates, registry, CPT, limit=limit)
    names = [c for c in table.columns if c not in ("npi", "provider_name", "modifiers")]
    renamed = [F.col(f"`{n}`").alias(f"plan_{i}") for i, n in enumerate(names)]
    return table.select("npi", "provider_name", "modifiers", *renamed)


def sorted_rows(rates):
    return rq.sort_rows(rq.summarize(rates, ["billing_code", "billing_class"]), "median_rate", descending=True)


def custom_code_set(spark, sf_dir):
    """Rates of a code list that comes as data: codes with a contract line."""
    codes = read_contracts(spark, fx.contract_csv(spark, sf_dir)).select(
        F.col("CPTCode").alias("billing_code")
    )
    return rq.summarize(in_code_table(fx.rates(spark, sf_dir), codes), ["billing_code"])


def rate_pages(spark, sf_dir):
    """The whole rate table in pages: rows, first and last keys of each."""
    path = scratch_path(spark, "pages")
    write_pages(fx.rates(spark, sf_dir), [("billing_code", False), ("negotiated_rate", True)], path, 1_000)
    return page_index(read_pages(spark, path), ["billing_code", "negotiated_rate"])


SKETCH_KEYS = ["billing_code", "billing_class"]


def summary_fast(rates):
    """Summaries from merged sketches of three parts, and whether each quartile is within the stated rank error."""
    parts = sketches.rate_sketches(rates.withColumn("part", F.crc32("source_file_url") % 3), ["part", *SKETCH_KEYS])
    summary = sketches.sketch_summary(sketches.merge_rate_sketches(parts, SKETCH_KEYS))
    known = rates.filter(col.without_status_modifiers(F.col("billing_code_modifiers"))).filter(F.col("negotiated_rate").isNotNull())
    rows = known.select(*SKETCH_KEYS, "negotiated_rate").join(summary, SKETCH_KEYS)
    rate, share = F.col("negotiated_rate"), F.count(F.lit(1))
    within = [
        ((F.count_if(rate < F.col(name)) / share <= q + sketches.RANK_ERROR) & (F.count_if(rate <= F.col(name)) / share >= q - sketches.RANK_ERROR)).alias(f"{name}_fits")
        for name, q in sketches.QUARTILES.items()
    ]
    return rows.groupBy(*SKETCH_KEYS, "row_count", "min_rate", "max_rate").agg(*within)


def payer_overlap_fast(rates):
    parts = [sketches.payer_sketches(rates.filter(F.crc32("source_file_url") % 2 == n)) for n in (0, 1)]
    pairs = sketches.payer_pairs(sketches.merge_payer_sketches(parts[0].union(parts[1])))
    return pairs.select("billing_code", "payer", "other_payer", *[F.col(c).cast("long").alias(c) for c in ("rates", "other_rates", "shared_rates")])


QUERIES: dict[str, Query] = {
    # sources and ingest
    "ingest_rate_docs": ingest_rate_docs,
    "ingest_errors": ingest_errors,
    "toc_errors": toc_errors,
    "provider_refs": provider_refs,
    "profile_filter": profile_filter,
    "flatten_rates": flatten_aba,
    "flatten_rates_radiology": flatten_radiology,
    "flatten_rates_category": flatten_category,
    "flatten_rates_large": flatten_large,
    "resolve_refs": resolve_refs,
    "missing_refs": missing_refs,
    "remote_refs": remote_refs,
    "remote_refs_missing": remote_refs_missing,
    "remote_refs_quarantine": remote_refs_quarantine,
    "parse_counters": counters,
    "probe_files": probe_first,
    "probe_files_full": probe_full,
    "probe_files_large": probe_large,
    "probe_summary": lambda s, d: probe_summary(_probe(s, d)),
    "stream_ingest": stream_ingest,
    "stream_events": stream_events,
    "stream_large": stream_large,
    "stream_run_events": stream_run_events,
    "write_rates": written_rates,
    "scan_many": scan_many,
    # indexes and batch
    "toc_files": toc_files,
    "toc_files_large": toc_files_large,
    "toc_file_plans": toc_file_plans,
    "plan_classes": plan_classes,
    "plan_class_sizes": plan_class_sizes,
    "index_dedupe": index_dedupe,
    "index_headers": index_headers,
    "index_files": index_files,
    "index_written": index_written,
    "index_roundtrip": index_roundtrip,
    "index_plans_roundtrip": index_plans_roundtrip,
    "vendor_index": vendor_index,
    "vendor_file_plans": vendor_file_plans,
    "vendor_header": vendor_header,
    "batch_plan": batch_plan,
    "batch_manifest": batch_manifest,
    "batch_counters": lambda s, d: batch_counters(fx.manifest_events(s, d)),
    "batch_run": batch_run,
    "batch_rerun": batch_rerun,
    "batch_remote": batch_remote,
    "probe_written": probe_written,
    "summary_incremental": summary_incremental,
    "output_name": output_name,
    "source_host": source_hosts,
    "index_url_by_month": index_url_by_month,
    # derived columns
    "classify_aba": classify_aba,
    "classify_radiology": classify_radiology,
    "component_flags": component_flags,
    "rate_percentage_split": rate_percentage_split,
    "benchmark_flag": _rates(benchmark_flag),
    "status_modifier_filter": _rates(status_modifier_filter),
    "plan_name": _rates(plan_names),
    "taxonomy_label": taxonomy_labels,
    "npi_registry": npi_registry_query,
    "npi_exploded": _rates(npi_exploded),
    "modifier_convention": modifier_convention,
    # rate queries
    "query_rows": _rates(lambda r: rq.run_query(r, limit=rq.clamp_limit(20_000), stable=True)),
    "query_rows_grouped_cols": _rates(
        lambda r: rq.run_query(r, group_by=" billing_code, setting ,aba_provider_role", limit=500, stable=True)
    ),
    "query_filters": _rates(
        lambda r: rq.run_query(
            r,
            service_line="aba",
            cpt=CPT,
            service_category="Direct Treatment",
            payer=TEXAS,
            billing_class="professional",
            negotiated_type="fee schedule",
            limit=10_000,
            stable=True,
        )
    ),
    "query_rate_bounds": _rates(
        lambda r: rq.run_query(r, min_rate=40, max_rate=400.25, group_by="billing_code", summary=True)
    ),
    "query_benchmark": _rates(
        lambda r: rq.run_query(r, benchmark_eligible=True, group_by="service_line,payer_name", summary=True)
    ),
    "summary_global": _rates(lambda r: rq.run_query(r, summary=True)),
    "summary_by_code": _rates(
        lambda r: rq.run_query(
            r, group_by="billing_code,service_category,billing_class", summary=True
        )
    ),
    "sorted_rows": _rates(sorted_rows),
    "rate_pages": rate_pages,
    "summary_fast": _rates(summary_fast),
    "raw_vs_benchmark": _rates(lambda r: rq.raw_and_benchmark(r, service_line="aba")),
    "facets": _rates(rq.facets),
    "facets_modifiers": _rates(
        lambda r: rq.facets(r).filter(F.col("facet") == "modifiers").select("value")
    ),
    "file_inventory": _rates(rq.file_inventory),
    "preset_aba_benchmark_summary": _rates(lambda r: run_preset(r, "aba_benchmark_summary")),
    "preset_aba_raw_summary": _rates(lambda r: run_preset(r, "aba_raw_summary")),
    "preset_97153_raw_rows": _rates(lambda r: run_preset(r, "aba_97153_raw_rows", stable=True)),
    "preset_97153_benchmark_rows": _rates(
        lambda r: run_preset(r, "aba_97153_benchmark_rows", stable=True)
    ),
    # providers and distribution
    "npi_summary": _with_registry(lambda r, n: prov.npi_summary(r, n, limit=TOP_PROVIDERS)),
    "npi_summary_all": _with_registry(lambda r, n: prov.npi_summary(r, n)),
    "npi_summary_code": _with_registry(lambda r, n: prov.npi_summary(r, n, CPT, TOP_PROVIDERS)),
    "npi_median": _with_registry(lambda r, n: dist.npi_median(r, n, CPT)),
    "provider_rates_median": _with_registry(lambda r, n: prov.provider_rates_median(r, n, CPT, limit=MAX_PROVIDERS)),
    "provider_filter_bcba": _with_registry(
        lambda r, n: prov.provider_rates_median(r, n, CPT, provider_filter="bcba", limit=MAX_PROVIDERS)
    ),
    "provider_filter_excl_phys": _with_registry(
        lambda r, n: prov.provider_rates_median(r, n, CPT, "HM", provider_filter="excl_phys", limit=MAX_PROVIDERS)
    ),
    "plan_rates_median": _with_registry(lambda r, n: prov.plan_rates_median(r, n, CPT, limit=MAX_PROVIDERS)),
    "plan_rates": _with_registry(_plan_rates),
    "npi_summary_code_all": _with_registry(lambda r, n: prov.npi_summary(r, n, CPT)),
    "provider_rates_median_all": _with_registry(lambda r, n: prov.provider_rates_median(r, n, CPT)),
    "provider_filter_bcba_all": _with_registry(lambda r, n: prov.provider_rates_median(r, n, CPT, provider_filter="bcba")),
    "plan_rates_median_all": _with_registry(lambda r, n: prov.plan_rates_median(r, n, CPT)),
    "plan_rates_all": _with_registry(lambda r, n: _plan_rates(r, n, None)),
    "rate_distribution": _with_registry(
        lambda r, n: dist.trimmed_counts(
            dist.median_counts(dist.npi_median(r, n, CPT, "HM", TEXAS, "excl_phys"))
        )
    ),
    "rate_distribution_stats": _with_registry(lambda r, n: dist.rate_distribution(r, n, CPT)[0]),
    "rate_distribution_bins": _with_registry(lambda r, n: dist.rate_distribution(r, n, CPT)[1]),
    # contracts
    "contract_rates": _contracts,
    "contract_lookup": contract_lookup,
    "payer_contracts": payer_contracts,
    "contract_bin": contract_bin,
    # optional
    "custom_code_set": custom_code_set,
    "payer_overlap": _rates(prov.payer_overlap),
    "payer_overlap_fast": _rates(payer_overlap_fast),
}
