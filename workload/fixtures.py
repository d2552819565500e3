"""Domain-shaped inputs derived from the benchmark tables.

Every fixture is a plain projection or join of whole tables, so the work of a
query grows with them. ``workload.reference_sql`` states the same in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescape import reference_values as ref
from ratescape.functions.columns import component_flags, quoted, rate_and_percentage
from ratescape.functions.profiles import PROFILES
from ratescape.schemas import CLASSIFICATION_COLUMNS, MANIFEST, RATE_COLUMNS
from ratescape.session import list_in_few_tasks, release_shuffles, scratch_path

# Payer name by region key; any other region keeps its own name.
PAYERS = (
    "Blue Shield of California",
    "Anthem Blue Cross California",
    "Blue Cross and Blue Shield of Texas",
    "United HealthCare Services, Inc.",
)
ORDERS_PER_DOC = 4096
PARTS_PER_DOC = 500
LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


_PLAN_LIST = "array(" + ", ".join(quoted(plan) for plan in ref.PLAN_LABELS) + ")"
_PAYER_CASES = " ".join(f"WHEN {key} THEN {quoted(payer)}" for key, payer in enumerate(PAYERS))
_NO_TEXT = "CAST(array() AS array<string>)"


#: Columns of a priced line as SQL; those of ``LINE_TEXT`` need no more than its keys.
LINE_TEXT = {
    "setting": "CASE WHEN l_linenumber % 2 = 1 THEN 'office' ELSE 'inpatient' END",
    "service_codes": "array(string(10 + l_linenumber))",
    "billing_code_modifiers": f"""CASE l_linenumber WHEN 1 THEN {_NO_TEXT} WHEN 2 THEN array('HM') WHEN 3 THEN array('HN', 'GT')
                WHEN 4 THEN array('HO') WHEN 5 THEN array('TC') WHEN 6 THEN array('26')
                WHEN 7 THEN array('53') END""",
    "provider_npi_list": f"""CASE WHEN l_orderkey % 17 = 0 THEN {_NO_TEXT}
                ELSE array(string(1000000000 + l_suppkey), string(1000000000 + l_partkey % 10)) END""",
    "provider_tin_value": "lpad(l_suppkey, 9, '0')",
}
LINE_COLUMNS = {
    "payer_name": f"CASE r_regionkey {_PAYER_CASES} ELSE r_name END",
    "source_file_url": f"""concat('https://example.test/2026-05-01_', n_nationkey, '-',
            CASE WHEN n_nationkey % 5 = 0 THEN '77'
                 WHEN n_nationkey % 5 = 1 THEN 'Blue-Shield-of-California'
                 WHEN l_partkey % 16 < {len(ref.PLAN_LABELS)} THEN get({_PLAN_LIST}, int(l_partkey % 16))
                 ELSE concat('Plan-', p_type) END,
            '_Blue-Shield-', n_name, '.json.gz')""",
    "billing_code": """CASE WHEN l_partkey % 10 <= 5 THEN string(97151 + l_partkey % 10)
                WHEN l_partkey % 10 = 6 THEN '97157'
                WHEN l_partkey % 10 = 7 THEN string(70000 + l_partkey % 10000)
                WHEN l_partkey % 10 = 8 THEN '99213' ELSE '70551' END""",
    "billing_class": "CASE WHEN l_linestatus = 'O' THEN 'professional' ELSE 'institutional' END",
    "negotiated_type": """CASE WHEN l_returnflag = 'A' THEN 'negotiated' WHEN l_returnflag = 'N' THEN 'fee schedule'
                WHEN l_linenumber % 2 = 0 THEN 'percentage' ELSE 'per diem' END""",
    # A multiple of 1/4, so that averages and interpolation are exact.
    "raw_rate": "floor(l_extendedprice / l_quantity) / 4.0D",
    **LINE_TEXT,
}


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One priced line per lineitem, before classification."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    return lines.selectExpr(*LINE_KEYS, "r_regionkey", *[f"{text} AS {name}" for name, text in LINE_COLUMNS.items()], "p_name")


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat rate table: one row per lineitem, both profiles classified."""
    lines = raw_lines(spark, sf_dir)
    price = rate_and_percentage(F.col("negotiated_type"), F.col("raw_rate"))
    code = F.col("billing_code")
    found = [profile.classify(code) for profile in PROFILES.values()]
    classes = {name: F.coalesce(*[columns[name] for columns in found]) for name in CLASSIFICATION_COLUMNS}
    eligible = F.lit(False)
    for profile in PROFILES.values():
        policy = profile.policy.eligible(
            F.col("negotiated_type"), price["negotiated_rate"], F.col("billing_class")
        )
        eligible = F.when(profile.contains(code), policy).otherwise(eligible)
    fixed = {
        "index_payer": F.concat(F.lit("index-"), _text(F.col("r_regionkey"))),
        "reporting_entity_type": F.lit("Health Insurance Issuer"),
        "last_updated_on": F.lit("2026-05-01"),
        "schema_version": F.lit("2.0.0"),
        "billing_code_type": F.lit("CPT"),
        "billing_code_type_version": F.lit("2026"),
        "name": F.col("p_name"),
        "description": F.concat("p_name", F.lit(" service")),
        "negotiation_arrangement": F.lit("ffs"),
        "expiration_date": F.lit("2026-12-31"),
        "provider_tin_type": F.lit("ein"),
        "additional_information": F.lit(None).cast("string"),
        "is_benchmark_eligible": eligible,
    }
    values = {**classes, **price, **component_flags(F.col("billing_code_modifiers")), **fixed}
    return lines.select(*[values.get(n, F.col(n)).alias(n) for n in RATE_COLUMNS])


def npi_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider registry; one in five suppliers is registered under another NPI."""
    key = F.col("s_suppkey")
    taxonomies = (
        "103K00000X",
        "103TC0700X",
        "207Q00000X",
        "1041C0700X",
        "363LP0808X",
        None,
        "106H00000X",
        "999ZZZZZZZZZZ",
    )
    listed = F.array(*[F.lit(t).cast("string") for t in taxonomies])
    name = F.col("s_name")
    return table(spark, sf_dir, "supplier").select(
        _text(F.when(key % 5 == 0, 2000000000 + key).otherwise(1000000000 + key)).alias("npi"),
        F.when(key % 2 == 0, name).alias("organization_name"),
        F.when(key % 2 == 1, F.lit("Pat")).alias("first_name"),
        F.when(key % 2 == 1, name).alias("last_name"),
        F.get(listed, (key % 8).cast("int")).alias("primary_taxonomy"),
    )


# --- files ----------------------------------------------------------------

_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Path of a fixture written at most once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = scratch_path(spark, name)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def write_documents(rows: DataFrame, path: str, text: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write rows with doc_id and place as one gzip text file per document, of the column ``line``.

    Lines stream into their file in order; no document is gathered in memory. ``text`` makes the
    lines; it is applied to the ordered rows, so that only what they are made of is shuffled.
    """
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    ordered = rows.repartition(tasks, "doc_id").sortWithinPartitions("doc_id", "place")
    (
        (text(ordered) if text else ordered)
        .select("doc_id", "line")
        .write.partitionBy("doc_id")
        .option("compression", "gzip")
        .text(path)
    )
    release_shuffles(spark)


def doc_source() -> Column:
    """Stable name of a written document."""
    return F.regexp_extract("source_file_url", r"doc_id=([^/]+)", 1)


def _place(section: int, *parts) -> Column:
    """Sortable position of a line: section, then up to six parts."""
    padded = [F.lit(section).alias("section")]
    for n in range(7):
        part = parts[n] if n < len(parts) else F.lit(0)
        padded.append((part if isinstance(part, Column) else F.col(part)).cast("long").alias(f"p{n}"))
    return F.struct(*padded).alias("place")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What documents are made of: the keys and payer of each line of ``raw_lines``, what its text needs besides, its document and its reference use.

    Joined once and stored: documents, their items, references and lines all start from it.
    """
    block = F.floor(F.col("l_orderkey") / F.lit(ORDERS_PER_DOC)).cast("long")
    odd = F.col("l_suppkey") % 2 == 1
    lines = (
        raw_lines(spark, sf_dir)
        .select(*LINE_KEYS, "r_regionkey", "payer_name", "billing_code", "billing_class", "negotiated_type", "raw_rate")
        .withColumn("block", block)
        .withColumn("doc_id", F.concat(F.lit("r"), _text(F.col("r_regionkey")), F.lit("-b"), _text(block)))
        .withColumn("has_ref", odd)
        .withColumn("has_inline", ~odd | (F.col("l_linenumber") == 3))
        .withColumn(
            "ref_is_missing",
            odd & (F.col("r_regionkey") == 4) & (block % 2 == 0) & (F.col("l_suppkey") % 10 == 9),
        )
    )
    path = _once(spark, sf_dir, "doc-lines", lambda path: lines.write.option("compression", "zstd").parquet(path))
    return spark.read.schema(lines.schema).parquet(path)


def rate_docs(spark: SparkSession, sf_dir: str) -> str:
    """Folder of in-network rate files; some use references that are missing."""
    return _once(spark, sf_dir, "rate-docs", lambda path: write_documents(_rate_doc_rows(spark, sf_dir), path, _rate_doc_text))


def broken_rate_docs(spark: SparkSession, sf_dir: str) -> str:
    """The rate files again; those of region 1 are cut short, those of region 2 have a rate of 97153 that breaks the schema."""

    def write(path: str) -> None:
        rows = _rate_doc_rows(spark, sf_dir)
        cut = F.col("doc_id").startswith("r1-") & (F.col("place.section") == 4)
        items = doc_lines(spark, sf_dir).filter(F.col("doc_id").startswith("r2-") & (F.col("billing_code") == "97153"))
        oops = F.lit('{"provider_groups":"oops","negotiated_prices":[]},').alias("line")
        faults = items.select("doc_id").distinct().select("doc_id", _place(3, F.lit(97153), F.lit(1)), oops)
        write_documents(rows.filter(~cut).unionByName(faults, allowMissingColumns=True), path, _rate_doc_text)

    return _once(spark, sf_dir, "broken-rate-docs", write)


def rerun_rate_docs(spark: SparkSession, sf_dir: str) -> str:
    """The rate files as they are found later: region 0 has line 1 of each order only, region 1 is cut short, region 3 has no rates, region 2 neither."""

    def write(path: str) -> None:
        rows, place = _rate_doc_rows(spark, sf_dir), F.col("place")
        region, rate = F.substring("doc_id", 2, 1), (place["section"] == 3) & (place["p1"] == 1)
        gone = (region == "0") & rate & (place["p3"] != 1) | (region == "1") & (place["section"] == 4) | region.isin("2", "3") & (place["section"] == 3)
        write_documents(rows.filter(~gone), path, _rate_doc_text)

    return _once(spark, sf_dir, "rerun-rate-docs", write)


REF_BLOCK = 20


def _reference_location(block: Column) -> Column:
    return F.concat(F.lit("https://example.test/refs/"), _text(block), F.lit(".json.gz"))


def remote_rate_docs(spark: SparkSession, sf_dir: str) -> str:
    """The rate files again; the last definition of every second reference names the reference file of its block of suppliers."""

    def text(rows: DataFrame) -> DataFrame:
        place = F.col("place")
        key = place["p1"]
        remote = (place["section"] == 1) & (place["p0"] == 1) & (key % 4 == 1)
        body = F.struct(key.alias("provider_group_id"), _reference_location(F.floor(key / F.lit(REF_BLOCK))).alias("location"))
        return _rate_doc_text(rows.withColumn("line", F.when(remote, F.concat(F.to_json(body), F.lit(","))).otherwise(F.col("line"))))

    def write(path: str) -> None:
        write_documents(_rate_doc_rows(spark, sf_dir), path, text)

    return _once(spark, sf_dir, "remote-rate-docs", write)


def reference_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(location, path) of reference files, one per block of suppliers with a group for every second odd one.

    Of seven blocks, one has no groups, one no file, and one a file that is cut short.
    """

    def write(path: str) -> None:
        key = F.col("s_suppkey")
        block = F.floor(key / F.lit(REF_BLOCK)).cast("long")
        groups = table(spark, sf_dir, "supplier").filter((key % 4 == 1) & (block % 7 != 3))
        groups = groups.withColumn("block", block).withColumn("doc_id", F.concat(F.lit("refs-"), _text(block)))
        docs = groups.select("doc_id", "block").distinct()
        group = _group(F.array(1000000000 + key), "npi", F.concat(F.lit("R"), _text(key)))
        parts = [
            docs.select("doc_id", _place(0), F.lit('{"version":"2.0.0","provider_groups":[').alias("line")),
            groups.filter(F.col("block") % 7 != 2).select("doc_id", _place(1, key), F.concat(F.to_json(group), F.lit(",")).alias("line")),
            docs.filter(F.col("block") % 7 != 5).select("doc_id", _place(2), F.lit("null]}").alias("line")),
        ]
        write_documents(parts[0].union(parts[1]).union(parts[2]), path)

    folder = _once(spark, sf_dir, "reference-docs", write)
    list_in_few_tasks(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(folder).select("path")
    return files.select(_reference_location(F.regexp_extract("path", "doc_id=refs-([0-9]+)", 1)).alias("location"), "path")


def _group(npis: Column, tin_type: str, tin_value: Column) -> Column:
    tin = F.struct(F.lit(tin_type).alias("type"), tin_value.alias("value"))
    return F.struct(F.transform(npis, lambda n: n.cast("long")).alias("npi"), tin.alias("tin"))


def _united(parts: list[DataFrame]) -> DataFrame:
    """All rows; columns that a part lacks are null."""
    return reduce(lambda some, more: some.unionByName(more, allowMissingColumns=True), parts)


def _rate_doc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the rate files before they are text: a place each and, where that does not tell it all, the text or what a rate needs."""
    lines = doc_lines(spark, sf_dir)
    code = F.col("billing_code").cast("long")

    docs = lines.groupBy("doc_id").agg(F.max("payer_name").alias("payer_name"))
    head = F.to_json(
        F.struct(
            F.col("payer_name").alias("reporting_entity_name"),
            F.lit("Health Insurance Issuer").alias("reporting_entity_type"),
            F.lit("2026-05-01").alias("last_updated_on"),
            F.lit("2.0.0").alias("version"),
        )
    )
    opening = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"provider_references":['))
    no_ref = '{"provider_group_id":null,"provider_groups":[]}],"in_network":['
    last_item = '{"billing_code":"99213","negotiated_rates":[]}]}'

    refs = lines.filter(F.col("has_ref") & ~F.col("ref_is_missing")).select("doc_id", "l_suppkey").distinct()
    key = F.col("l_suppkey")
    items = lines.select("doc_id", "billing_code").distinct()
    no_rate = '{"provider_groups":[],"negotiated_prices":[]}]},'
    return _united(
        [
            lines.select(
                "doc_id",
                _place(3, code, F.lit(1), *LINE_KEYS),
                F.lit(None).cast("string").alias("line"),
                F.struct("has_inline", "has_ref", "negotiated_type", "raw_rate", "billing_class").alias("rate"),
            ),
            docs.select("doc_id", _place(0), opening.alias("line")),
            refs.filter(key % 4 == 1).select("doc_id", _place(1, F.lit(0), key)),
            refs.select("doc_id", _place(1, F.lit(1), key)),
            docs.select("doc_id", _place(2), F.lit(no_ref).alias("line")),
            items.select("doc_id", _place(3, code)),
            items.select("doc_id", _place(3, code, F.lit(2)), F.lit(no_rate).alias("line")),
            docs.select("doc_id", _place(4), F.lit(last_item).alias("line")),
        ]
    )


def _rate_doc_text(rows: DataFrame) -> DataFrame:
    """The ``line`` of each row of ``_rate_doc_rows``."""
    place = F.col("place")

    def definition(key: Column, npi: Column) -> Column:
        group = _group(F.array(npi), "npi", F.concat(F.lit("R"), _text(key)))
        body = F.struct(key.alias("provider_group_id"), F.array(group).alias("provider_groups"))
        return F.concat(F.to_json(body), F.lit(","))

    billing_code = _text(place["p0"])
    item_head = F.to_json(
        F.struct(
            F.lit("ffs").alias("negotiation_arrangement"),
            F.concat(F.lit("Service "), billing_code).alias("name"),
            F.lit("CPT").alias("billing_code_type"),
            F.lit("2026").alias("billing_code_type_version"),
            billing_code.alias("billing_code"),
            F.concat(F.lit("Service "), billing_code).alias("description"),
        )
    )
    price = F.struct(
        "rate.negotiated_type",
        F.col("rate.raw_rate").alias("negotiated_rate"),
        F.lit("2026-12-31").alias("expiration_date"),
        F.col("service_codes").alias("service_code"),
        "rate.billing_class",
        "setting",
        F.when(F.size("billing_code_modifiers") > 0, F.col("billing_code_modifiers")).alias(
            "billing_code_modifier"
        ),
    )
    rate = F.struct(
        F.when(
            F.col("rate.has_inline"),
            F.array(_group(F.col("provider_npi_list"), "ein", F.col("provider_tin_value"))),
        ).alias("provider_groups"),
        F.when(F.col("rate.has_ref"), F.array("l_suppkey")).alias("provider_references"),
        F.array(price).alias("negotiated_prices"),
    )
    line = (
        F.when(F.col("line").isNotNull(), F.col("line"))
        .when(F.col("rate").isNotNull(), F.concat(F.to_json(rate), F.lit(",")))
        .when(place["section"] == 3, F.concat(F.regexp_replace(item_head, r"\}$", ""), F.lit(',"negotiated_rates":[')))
        .when(place["p0"] == 0, definition(place["p1"], F.lit("9999999999")))
        .otherwise(definition(place["p1"], _text(1000000000 + place["p1"])))
    )
    keyed = rows.withColumns({name: place[f"p{n}"] for n, name in enumerate(LINE_KEYS, 2)})
    return keyed.withColumns({name: F.expr(text) for name, text in LINE_TEXT.items()}).withColumn("line", line)


def _toc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the tables of contents before they are text: a place each and the text, or the name of a structure's part."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    block = F.floor(F.col("l_orderkey") / F.lit(ORDERS_PER_DOC)).cast("long")
    lines = lines.select(F.concat(F.lit("toc-"), _text(block)).alias("doc_id"), _place(1, *LINE_KEYS), "p_name")
    path = _once(spark, sf_dir, "toc-lines", lambda path: lines.write.option("compression", "zstd").parquet(path))
    lines = spark.read.schema(lines.schema).parquet(path)
    docs = lines.select("doc_id").distinct()
    opening = (
        '{"reporting_entity_name":"Example Payer","reporting_entity_type":"Health Insurance Issuer",'
        '"last_updated_on":"2026-05-01","version":"2.0.0","reporting_structure":['
    )
    return _united(
        [
            lines.select("doc_id", "place", F.lit(None).cast("string").alias("line"), "p_name"),
            docs.select("doc_id", _place(0), F.lit(opening).alias("line")),
            docs.select("doc_id", _place(2), F.lit("null]}").alias("line")),
        ]
    )


def _toc_text(rows: DataFrame) -> DataFrame:
    """The ``line`` of each row of ``_toc_rows``."""
    _, number, part, supplier = (F.col(f"place.p{n}") for n in range(4))
    plan = lambda n: F.struct(
        F.concat(F.lit("Plan "), _text(supplier + n)).alias("plan_name"),
        F.lit("ein").alias("plan_id_type"),
        _text(supplier + n).alias("plan_id"),
    )
    plans = F.transform(F.sequence(F.lit(0), (supplier % 3).cast("int")), plan)
    first = F.struct(
        F.when(number % 3 != 0, F.col("p_name")).alias("description"),
        F.concat(F.lit("https://example.test/files/in-network-"), _text(part), F.lit(".json.gz")).alias("location"),
    )
    second = F.struct(
        F.lit("regional").alias("description"),
        F.when(number == 6, "")
        .when(
            number != 7,
            F.concat(F.lit("https://example.test/files/regional-"), _text(supplier), F.lit(".json.gz")),
        )
        .alias("location"),
    )
    structure = F.struct(plans.alias("reporting_plans"), F.array(first, second).alias("in_network_files"))
    return rows.withColumn("line", F.when(F.col("line").isNotNull(), F.col("line")).otherwise(F.concat(F.to_json(structure), F.lit(","))))


def toc_docs(spark: SparkSession, sf_dir: str) -> str:
    """Folder of tables of contents: one structure per lineitem, two files each."""
    return _once(spark, sf_dir, "toc-docs", lambda path: write_documents(_toc_rows(spark, sf_dir), path, _toc_text))


def broken_toc_docs(spark: SparkSession, sf_dir: str) -> str:
    """The tables of contents again; those of even number are cut short."""

    def write(path: str) -> None:
        even = F.regexp_extract("doc_id", "([0-9]+)", 1).cast("long") % 2 == 0
        write_documents(_toc_rows(spark, sf_dir).filter(~(even & (F.col("place.section") == 2))), path, _toc_text)

    return _once(spark, sf_dir, "broken-toc-docs", write)


def index_docs(spark: SparkSession, sf_dir: str) -> str:
    """Folder of native indexes: one listed file per part."""

    def write(path: str) -> None:
        parts = table(spark, sf_dir, "part")
        key = F.col("p_partkey")
        block = F.floor(key / F.lit(PARTS_PER_DOC)).cast("long")
        parts = parts.withColumn("doc_id", F.concat(F.lit("index-"), _text(block)))
        entry = F.struct(
            F.when(
                key % 9 != 0,
                F.concat(F.lit("https://example.test/files/p"), _text(key), F.lit(".json.gz?sig=x")),
            ).alias("location"),
            F.col("p_name").alias("description"),
            F.when(key % 7 != 0, F.col("p_size").cast("long") * 100000).alias("content_length_bytes"),
        )
        docs = parts.select("doc_id").distinct()
        write_documents(
            docs.select("doc_id", _place(0), F.lit('{"in_network_files":[').alias("line"))
            .union(parts.select("doc_id", _place(1, key), F.concat(F.to_json(entry), F.lit(",")).alias("line")))
            .union(docs.select("doc_id", _place(2), F.lit("null]}").alias("line"))),
            path,
        )

    return _once(spark, sf_dir, "index-docs", write)


def vendor_docs(spark: SparkSession, sf_dir: str) -> str:
    """Folder of hosted-vendor metadata: one file entry per order."""

    def write(path: str) -> None:
        orders = table(spark, sf_dir, "orders")
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        block = F.floor(key / F.lit(ORDERS_PER_DOC)).cast("long")
        orders = orders.withColumn("doc_id", F.concat(F.lit("vendor-"), _text(block)))
        plan = lambda n: F.struct(
            F.concat(F.lit("Plan "), _text(n)).alias("planName"),
            F.lit("hios").alias("planIdType"),
            _text(customer + n).alias("planId"),
            F.lit("group").alias("planMarketType"),
        )
        name = F.concat(F.lit("rates-"), _text(customer), F.lit(".json.gz"))
        path_text = (
            F.when(customer % 4 == 0, F.concat(F.lit("https://cdn.example.test/"), name))
            .when(customer % 4 == 1, F.concat(F.lit("/root/"), name))
            .otherwise(F.concat(F.lit("sub/"), name))
        )
        entry = F.struct(
            F.lit("Example Vendor Payer").alias("reportingEntityName"),
            F.lit("2026-05-01").alias("lastUpdatedOn"),
            F.when(F.col("o_orderstatus") == "P", "TABLE_OF_CONTENTS")
            .otherwise(ref.VENDOR_RATE_SCHEMA)
            .alias("fileSchema"),
            F.when(key % 3 != 0, F.concat(F.lit("file "), _text(key))).alias("fileName"),
            path_text.alias("filePath"),
            F.transform(F.sequence(F.lit(0), (key % 4).cast("int")), plan).alias("reportingPlans"),
        )
        docs = orders.select("doc_id").distinct()
        write_documents(
            docs.select("doc_id", _place(0), F.lit('{"files":[').alias("line"))
            .union(orders.select("doc_id", _place(1, key), F.concat(F.to_json(entry), F.lit(",")).alias("line")))
            .union(docs.select("doc_id", _place(2), F.lit("{}]}").alias("line"))),
            path,
        )

    return _once(spark, sf_dir, "vendor-docs", write)


def _write_csv(rows: DataFrame, path: str) -> None:
    (
        rows.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def registry_csv(spark: SparkSession, sf_dir: str) -> str:
    """Registry CSV with all taxonomy slots, one line per supplier."""

    def write(path: str) -> None:
        key = F.col("s_suppkey")
        blank = key % 11 == 0
        code = lambda text, empty: F.when(blank | empty, "").otherwise(text)
        lines = table(spark, sf_dir, "supplier").select(
            _text(F.when(key % 13 != 0, 1000000000 + key)).alias("NPI"),
            F.when(key % 2 == 0, "2").otherwise("1").alias("Entity Type Code"),
            F.when(key % 7 == 0, "<UNAVAIL>")
            .otherwise(F.col("s_name"))
            .alias("Provider Organization Name (Legal Business Name)"),
            F.when(key % 2 == 0, "NULL").otherwise(F.col("s_name")).alias("Provider Last Name (Legal Name)"),
            F.when(key % 2 == 0, "").otherwise("Pat").alias("Provider First Name"),
            code("101Y00000X", key % 3 == 0).alias("Healthcare Provider Taxonomy Code_1"),
            code("103K00000X", key % 5 == 0).alias("Healthcare Provider Taxonomy Code_2"),
            code("207Q00000X", F.lit(False)).alias("Healthcare Provider Taxonomy Code_3"),
            F.lit("N").alias("Healthcare Provider Primary Taxonomy Switch_1"),
            F.when(key % 4 == 0, "Y").otherwise("N").alias("Healthcare Provider Primary Taxonomy Switch_2"),
            F.when(key % 8 == 0, "Y").otherwise("").alias("Healthcare Provider Primary Taxonomy Switch_3"),
            *[F.lit("").alias(ref.TAXONOMY_CODE_COLUMN.format(i)) for i in range(4, ref.TAXONOMY_SLOTS)],
            *[F.lit("N").alias(ref.TAXONOMY_SWITCH_COLUMN.format(i)) for i in range(4, ref.TAXONOMY_SLOTS)],
            code("390200000X", F.lit(False)).alias(ref.TAXONOMY_CODE_COLUMN.format(ref.TAXONOMY_SLOTS)),
            F.when(key % 19 == 0, "Y").otherwise("N").alias(ref.TAXONOMY_SWITCH_COLUMN.format(ref.TAXONOMY_SLOTS)),
            F.lit("not read").alias("Provider Other Column"),
        )
        _write_csv(lines, path)

    return _once(spark, sf_dir, "registry-csv", write)


def contract_csv(spark: SparkSession, sf_dir: str) -> str:
    """Contract schedule, one line per customer, ordered over its files."""

    def write(path: str) -> None:
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        names = (
            "Blue Shield of California",
            "Anthem Blue Cross of California",
            "Blue Cross Blue Shield of Texas",
            "UMR",
            "Other Contract",
        )
        customer = F.get(F.array(*[F.lit(n) for n in names]), (nation % 5).cast("int"))
        firsts, seconds = ("HM", " hn ", "GT", "", "GT"), ("", "HO", "HO", "", "")
        pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), (key % 5).cast("int"))
        lines = table(spark, sf_dir, "customer").orderBy("c_custkey").select(
            customer.alias("CustomerName"),
            F.when(key % 9 == 0, "99213").otherwise(_text(97151 + key % 6)).alias("CPTCode"),
            F.when(key % 8 == 7, "n/a")
            .otherwise(_text(F.lit(10.5) + (key % 400)))
            .alias("ContractRatePerUnit"),
            pick(firsts).alias("Modifier1500_1"),
            pick(seconds).alias("Modifier1500_2"),
        )
        _write_csv(lines, path)

    return _once(spark, sf_dir, "contract-csv", write)


def index_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index files of a batch, one per part, in listing order."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("file_ord"),
        F.concat(F.lit("https://example.test/files/p"), _text(key), F.lit(".json.gz?sig=x")).alias("location"),
        F.when(key % 7 != 0, F.col("p_size").cast("long") * 100000).alias("content_length_bytes"),
    )


def manifest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One earlier event per part: succeeded, failed or skipped."""
    key = F.col("p_partkey")
    status = F.when(key % 4 == 0, "succeeded").when(key % 4 == 1, "failed").otherwise("skipped")
    values = {
        "status": status,
        "source": F.concat(F.lit("https://example.test/files/p"), _text(key), F.lit(".json.gz?sig=x")),
        "profile": F.lit("aba"),
        "reason": F.when(key % 4 > 1, "file_too_large"),
        "content_length_bytes": F.col("p_size").cast("long") * 100000,
        "scanned_items": F.when(key % 4 == 0, key + 2),
        "matched_items": F.when(key % 4 == 0, key % 3),
        "rows_written": F.when(key % 4 == 0, key % 50),
        "error_type": F.when(key % 4 == 1, "ValueError"),
    }
    return table(spark, sf_dir, "part").select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in MANIFEST.fields
        ]
    )
