"""The Merkle manifest against a plain Python tree, over the small tables and over edge cases."""

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from ratescape.llm import merkle, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[c] for c in merkle.FIELDS)))


def tree(nodes):
    """Root and every leaf's list of (position, siblings), by the definition."""
    proofs = [[] for _ in nodes]
    below = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 8, len(nodes))) for i in range(0, len(nodes), 8)]
        for run in runs:
            for k, i in enumerate(run):
                for leaf in below[i]:
                    proofs[leaf].append((k, "".join(nodes[j] for j in run if j != i)))
        below = [[x for i in run for x in below[i]] for run in runs]
        nodes = [h("".join(nodes[i] for i in run)) for run in runs]
    return nodes[0], proofs


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, above = tree([trees[g][0] for g in names])
    out = []
    for g, up in zip(names, above, strict=True):
        subroot, proofs = trees[g]
        for (_, _, leaf, row), proof in zip(sorted(groups[g], key=lambda x: x[:3]), proofs, strict=True):
            proof = proof + up
            shown = dict(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None:
                shown["text"] = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row["text"])
            fold = leaf_of(shown)
            for k, siblings in proof:
                fold = h(siblings[: 64 * k] + fold + siblings[64 * k :])
            out.append((row["doc_id"], leaf, subroot, root, h("".join(s for _, s in proof)), fold, fold == root))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def found(spark, docs, tmp_path):
    docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(tuple, queries.op12_merkle_manifest(spark, str(tmp_path)).collect()), key=key)


def test_query_by_plain_python(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op12_merkle_manifest(spark, SF).collect()))
    assert got == sorted(expected(rows))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_pieces_of_any_height_give_the_same_tree(spark, levels):
    rows = [(i, "s", lang, 1, f"T{i}") for lang, n in (("a", 700), ("b", 64), ("c", 65), ("d", 1), ("é", 9), (None, 8)) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = {(r[0], r[1]): r for r in expected([dict(zip(merkle.FIELDS, r, strict=True)) for r in rows])}
    got = merkle.manifest(merkle.leaves(docs), levels).withColumn("fold", merkle.folded("_digest")).collect()
    assert len(got) == len(rows)
    for r in got:
        _, _, subroot, root, proof, *_ = want[(r._order, r._digest)]
        assert (r.subroot, r.root, r.fold, h("".join(s.siblings for s in r.proof))) == (subroot, root, root, proof)


def test_edge_cases(spark, tmp_path):
    long = "Ab ç" * 50_000
    rows = [(None, None, None, None, None), (1, "s", "en", 0, ""), (1, "s", "en", 0, ""), (1, "s", "en", 3, "ABC"), (2, None, "", 5, long), (3, "x", "en", None, "-"), (-4, "x", "EN", 1, "1:A")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS _at", "'x' AS _group", "2 AS proof", "3 AS root")
    want = sorted(expected([dict(zip(merkle.FIELDS, r, strict=True)) for r in rows]), key=key)
    assert found(spark, docs, tmp_path) == want


@pytest.mark.parametrize("n", [0, 1])
def test_no_rows_and_one(spark, tmp_path, n):
    docs = spark.createDataFrame([(7, "s", "en", 1, "Q")][:n], SCHEMA)
    want = expected([dict(zip(merkle.FIELDS, (7, "s", "en", 1, "Q"), strict=True))]) if n else []
    assert found(spark, docs, tmp_path) == want
