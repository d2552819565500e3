"""Queries against their SQL, and the pipeline against plain Python, over the small tables."""

from collections import Counter

import brute
import pytest

import corpus_pipeline
from ratescape.llm import queries
from workload.compare import difference, duckdb_connection

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equal_to_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), duckdb_connection(SF), queries.SQL[name]) is None


def shortened(docs, min_docs=10, share=0.5):
    """Kept texts of the line stage: repeated lines stay in their first place; documents that lose ``share`` of their words stay whole."""
    keys, places = Counter(), {}
    for doc, text in docs:
        lines = [brute.lower(x.strip(brute.SPACE)) for x in (text or "").split("\n")]
        keys.update(set(lines))
        for i, k in enumerate(lines):
            places[k] = min(places.get(k, (doc, i)), (doc, i))
    out = {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        own = [brute.lower(x.strip(brute.SPACE)) for x in lines]
        kept = [x for i, (x, k) in enumerate(zip(lines, own, strict=True)) if not k or keys[k] < min_docs or places[k] == (doc, i)]
        words, left = (len(brute.WORD.findall("\n".join(x))) for x in (lines, kept))
        if len(kept) == len(lines) or left and words - left >= share * words:
            out[doc] = text
        elif left:
            out[doc] = "\n".join(kept)
    return out


def without_spans(text, items, window=10):
    """A text without the words of any occurrence of a window; None if half of its words or more than 2,000 go."""
    windows = set()
    for _, item in items:
        w = brute.LEAK_WORD.findall(brute.lower(item or ""))
        windows |= {tuple(w[i : i + window]) for i in range(max(1, len(w) - window + 1))} if w else set()
    words = list(brute.LEAK_WORD.finditer(brute.lower(text or "")))
    hit = set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if tuple(m[0] for m in words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
    if len(hit) > 2_000 or len(hit) > 0.5 * len(words):
        return None
    at = 0
    out = []
    for i, m in enumerate(words):
        if i in hit:
            out.append(text[at : m.start()] if i - 1 not in hit else "")
            at = m.end()
    return "".join(out) + (text or "")[at:] if hit else text


def test_pipeline_by_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        made = stage(spark, docs, SF)
        after = {r.doc_id: r for r in made.collect()}
        if name != "fair_mix":
            assert made.dtypes == docs.dtypes
            texts = {d: r.text for d, r in after.items()}
            assert all(r.n_chars == len(r.text) for r in after.values() if r.text != before[r.doc_id])
        if name == "quality_rules":
            failed = {r[0] for r in brute.quality(before.items()) if r[6]}
            measures = queries.fertility.quality_measures(docs).where("kept").collect()
            assert not failed & set(after) and set(after) == {r.doc_id for r in measures}
            assert texts == {d: before[d] for d in texts}
        elif name == "line_dedup":
            assert texts == shortened(list(before.items()))
        elif name == "jaccard_join":
            assert texts == {d: before[d] for d, _, c in brute.jaccard(list(before.items()), 5, 80) if c == d}
        elif name == "decontamination":
            clean = {d: without_spans(t, items) for d, t in before.items()}
            assert texts == {d: t for d, t in clean.items() if t is not None}
        else:
            assert sum(r.taken for r in after.values()) <= 1.5 * sum(r.size for r in after.values())
        docs = made
