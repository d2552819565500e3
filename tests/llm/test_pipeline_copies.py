"""Large groups of exact and near copies leave one document, whichever stage meets them."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratescape.llm import line_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(11)
SF = "/root/testdata/sf0.001"


def lines(n, words):
    return [" ".join("".join(rng.choice("aeiounrstl") for _ in range(6)) for _ in range(words)) for _ in range(n)]


COPIED, OWN, LICENCE = lines(6, 15), lines(6, 15), "this licence line stands in a dozen documents"


def edited(k):
    changed = [x.split() for x in COPIED]
    changed[k % 6][7] = f"edit{k}"
    return "\n".join(map(" ".join, changed))


def table(spark, texts):
    rows = [(i, t, "en", "abc"[i % 3], len(t)) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("first", ["exact", "near"])
def test_one_of_many_copies_reaches_the_mix(spark, first):
    whole = "\n".join(COPIED)
    group = [(i, whole) for i in range(10, 24)] + [(i, edited(i)) for i in range(24, 36)]
    group += [(1, whole if first == "exact" else edited(0))]
    docs = table(spark, [*group, (50, "\n".join(OWN))])
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SF)
        if name == "jaccard_join":
            assert {r.doc_id: r.text for r in docs.collect()} == {1: dict(group)[1], 50: "\n".join(OWN)}
    assert {r.doc_id for r in docs.collect()} == {1, 50}


@pytest.mark.parametrize("broadcast_keys", [100, 0])
def test_who_loses_lines_who_stays_whole_and_who_goes(spark, broadcast_keys):
    body = {i: lines(1, 40)[0] for i in range(20)}
    texts = [(i, f"{LICENCE}\n{body[i]}") for i in range(12)] + [(12, LICENCE), (13, f"{LICENCE}\n \n"), (14, f"{LICENCE}\nfour words of mine"), (15, ""), (16, body[16])]
    out = line_dedup.dedup_lines(table(spark, texts), 10, "first", broadcast_keys=broadcast_keys, whole_from=0.5)
    got = {r.doc_id: (r.text, r._n_dropped) for r in out.collect()}
    want = {i: (body[i], 1) for i in range(1, 12)} | {0: (texts[0][1], 0), 14: (texts[14][1], 0), 15: ("", 0), 16: (body[16], 0)}
    assert got == want
    assert out.where(F.col("text").contains(LICENCE)).count() == 2
