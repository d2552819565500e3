"""The fertility bands reject junk that passes the base rule and keep good text, in every language and both vocabularies."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratescape.llm import fertility

SF = "/root/testdata/sf0.01"
NATURAL = (
    "The committee met on Tuesday to discuss how the new library should be paid for, and most members agreed that the old building could be sold. "
    "The mayor then asked whether the school might move into the hall next spring, because its roof had been leaking since the storms of last winter."
)


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = fertility.quality_measures(docs).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    return rows.where("NOT base_failed").collect()


def test_labelled_junk_goes_and_good_text_stays(judged):
    bad = [r for r in judged if r.quality == 0]
    good = [r for r in judged if r.quality == 1]
    assert len(bad) == 27 and len(good) == 335
    assert sum(not r.kept for r in bad) == 26
    assert sum(not r.kept for r in good) <= 6
    for lang in ("en", "de", "fr", "es"):
        caught = [not r.kept for r in bad if r.lang == lang]
        assert sum(caught) >= 0.9 * len(caught) > 0


def test_known_junk_goes_in_the_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id").isin(37, 67, 101, 189, 212))
    assert docs.count() == 5 and corpus_pipeline.quality_rules(spark, docs, SF).count() == 0


def test_each_vocabulary_and_script_has_a_band(spark):
    assert all(set(band) == set(fertility.VOCABULARIES) for band in fertility.BANDS.values())
    russian = "Комитет собрался во вторник, чтобы обсудить, как следует оплатить новую библиотеку, и большинство членов согласилось, что старое здание можно продать."
    syllables = "ааа ббб аа бб абаб баба аабб ббаа аба баб абба баав вваа вава авав аава вавв бава вабб абав аавб ббва вбаб авба вабв ввбб бббв"
    rows = [(1, NATURAL, "en"), (2, NATURAL, None), (3, russian, None), (4, syllables, None), (5, syllables, "ru")]
    got = {r.doc_id: r for r in fertility.quality_measures(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {i for i, r in got.items() if r.kept} == {1, 2, 3}
