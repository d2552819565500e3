"""A training-corpus pipeline: five stages, each written as Parquet and read back as the next one's input.

    run(spark, sf_dir) -> the mix of the cleaned documents
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescape.llm import decontaminate, fair_mix, fertility, jaccard_join, line_dedup
from ratescape.llm.common import shared_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fertility rules reject go."""
    return fertility.reject_by_fertility(docs)


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents have stay in their first place only; documents left without a word go.

    A document that would lose half of its words or more stays whole: the next
    stage sees by its whole text whether it is a copy.
    """
    shorter = line_dedup.dedup_lines(docs, min_docs=10, keep="first", whole_from=0.5)
    return _recounted(shorter.drop("_n_lines", "_n_dropped"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest id stays."""
    return jaccard_join.keep_one(docs, n=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of test items are cut out; documents that are mostly test items go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _recounted(decontaminate.remove_leaks(docs, benchmark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    rows = fair_mix.sized(docs)
    mixed = fair_mix.mix_totals(rows, fair_mix.cycled_weights(rows))
    return mixed.select(*(F.col(f"_{c}").alias({"id": "doc_id"}.get(c, c)) for c in ("id", "source", "size", "source_size", "target", "taken")))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_lines),
    ("jaccard_join", drop_copies),
    ("decontamination", drop_leaks),
    ("fair_mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``; every stage is stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        path = shared_path(spark, f"pipeline-{name}")
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs


#: Tokeniser fertility and the shuffled mix cannot be written in SQL; tests compare with plain Python.
ORACLE_SQL = None
