"""The forest search against brute force: recall on a table, exact results where all leaves are visited."""

import math
from collections import defaultdict

import numpy as np
import pytest

from ratescape.llm import queries, rp_forest

SF = "/root/testdata/sf0.01"


def usable(v, n):
    return v is not None and len(v) == n and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, n, every=20, k=20):
    rows = [(i, np.float32(v).astype(float)) for i, v in rows if usable(v, n)]
    out = defaultdict(list)
    for at, (q, v) in enumerate(rows):
        if q is not None and q % every == 0:
            near = sorted((-float(v @ w), (i is None, i or 0)) for j, (i, w) in enumerate(rows) if j != at)[:k]
            out[q].append([(i, -s) for s, (_, i) in near])
    return out


def lists(df):
    """The result lists of each query id; rows with one id are told apart by score order alone."""
    out = defaultdict(list)
    for r in df.collect():
        out[r.query_id].append((r["rank"], r.vec_id, r.score))
    return {q: sorted(x) for q, x in out.items()}


def test_recall_on_a_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows, 64)
    got = lists(queries.op11_rp_forest(spark, SF))
    assert got.keys() == want.keys()
    hits = 0
    vectors = dict(rows)
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [s for *_, s in found] == sorted((s for *_, s in found), reverse=True)
        for _, i, s in found:
            assert s == pytest.approx(float(np.float64(vectors[q]) @ np.float64(vectors[i])), abs=1e-12)
        hits += len({i for _, i, _ in found} & {i for i, _ in want[q][0]})
    assert hits >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("blocks", [(16_384, 50_000), (7, 3)])
def test_edge_cases_with_all_leaves(spark, tmp_path, monkeypatch, blocks):
    """Half of all rows are one vector; ids and rows repeat; lengths of vectors differ."""
    monkeypatch.setattr(rp_forest, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(rp_forest, "TASK_QUERIES", blocks[1])
    monkeypatch.setattr(rp_forest, "COPIES", 40)
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, -1.0, 0.5]) for i in range(0, 400, 2)]
    rows += [(i, [float(x) for x in rng.normal(size=4) * 10.0 ** rng.integers(-3, 4)]) for i in range(1, 400, 2)]
    rows += [(20_000 + i, [float(x) for x in rng.integers(-1, 2, 4)]) for i in range(200)]
    rows += [(500, None), (520, [0.0] * 4), (540, [1.0, None, 2.0, 3.0]), (560, [float("nan")] * 4), (580, [float("inf"), 1.0, 1.0, 1.0]), (600, [1.0]), (620, [])]
    rows += [(20, [1.0, 2.0, -1.0, 0.5]), (None, [9.0, 9.0, 9.0, 9.0]), (700, [-0.0, 0.0, 0.0, 1.0])]
    docs = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, class int, v string")
    want = brute(rows, 4)
    got = lists(rp_forest.nearest(docs, recall=1.0))
    assert got.keys() == want.keys()
    plain = {q: [(i, round(s, 9)) for i, s in x] for q, (x, *more) in want.items() if not more}
    for q, near in plain.items():
        found = [(i, round(s, 9)) for _, i, s in got[q]]
        scores = [s for _, s in near]
        assert [s for _, s in found] == scores
        assert found == near or len(set(scores)) < len(scores)
    both = sorted((r, round(s, 9)) for x in want[20] for r, (_, s) in enumerate(x, 1))
    assert sorted((r, round(s, 9)) for r, _, s in got[20]) == both


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 0.0])], [(20, [1.0, 0.0])], [(20, [1.0, 0.0]), (21, [0.5, 0.5])]])
def test_few_rows(spark, rows):
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = [(q, r, i, s) for q, (x,) in brute(rows, 2).items() for r, (i, s) in enumerate(x, 1)]
    assert [tuple(r) for r in rp_forest.nearest(docs).collect()] == want


def test_queue_visits_leaves_by_what_a_query_misses():
    margins = np.array([[1.0, 3.0, -2.0], [-0.5, 4.0, 9.0]])
    assert rp_forest.visit(margins, 2, 4) == [(0, 2), (1, 1), (1, 3), (0, 1)]
