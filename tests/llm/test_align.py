"""Cross-tokenizer alignment against whole-text tokenizing in plain Python."""

from collections import Counter, defaultdict
from hashlib import sha256
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from ratescape.llm import align, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(align.BYTE_BPE)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=align.PIECE_BPE)


def groups_of(a, b, text):
    """Groups as (A ids, B ids) of the whole text, from decoded bytes alone; None without tokens."""
    if not text:
        return None
    byte = align.byte_of_char()
    ours = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    theirs = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
    raw = (" " + text).encode()
    if b"".join(x for _, x in ours) != raw or b"".join(x for _, x in theirs) != raw:
        return None

    def ends(tokens):
        at = 0
        for _, x in tokens:
            at += len(x)
            yield at

    a_ends, b_ends = list(ends(ours)), list(ends(theirs))
    cuts = sorted(set(a_ends) & set(b_ends))
    out, low = [], 0
    for cut in cuts:
        out.append(tuple([t[0] for t, e in zip(tokens, at, strict=True) if low < e <= cut] for tokens, at in ((ours, a_ends), (theirs, b_ends))) if len(raw) < 400 else (low, cut))
        low = cut
    if len(raw) >= 400:
        slots = [([], []) for _ in cuts]
        for side, (tokens, at) in enumerate(((ours, a_ends), (theirs, b_ends))):
            k = 0
            for (i, _), e in zip(tokens, at, strict=True):
                while e > cuts[k]:
                    k += 1
                slots[k][side].append(i)
        out = slots
    return out


def expected(tokenizers, docs):
    found = [(d, groups_of(*tokenizers, t)) for d, t in docs]
    held = Counter()
    links = []
    for _, groups in found:
        linked = Counter((x, y) for xs, ys in groups or [] for x in xs for y in ys)
        held.update(linked.keys())
        links.append(linked)
    highest = defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    rows = []
    for (doc, groups), linked in zip(found, links, strict=True):
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups or [])
        best = sum(n for (x, y), n in linked.items() if held[x, y] == highest[x])
        total = sum(n * held[p] for p, n in linked.items())
        sizes = [sum(len(g[k]) for g in groups or []) for k in (0, 1)]
        rows.append((doc, *sizes, len(groups or []), sum(linked.values()), best, total, sha256(text.encode()).hexdigest() if text else ""))
    return rows


def by_query(spark, tmp_path, rows, schema="doc_id long, text string"):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(tuple, queries.op13_cross_alignment(spark, str(tmp_path)).collect()), key=str)


def test_query_by_plain_python(spark, tokenizers):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op13_cross_alignment(spark, SF).collect())) == sorted(expected(tokenizers, docs))


@pytest.mark.parametrize("size", [1, 300, 1 << 16])
def test_rows_of_parts_give_the_tokens_of_the_whole_text(spark, tokenizers, size):
    """Documents of the next table, without Spark."""
    ours = align.Tokenizers(open(align.BYTE_BPE, "rb").read(), open(align.PIECE_BPE, "rb").read())
    assert ours.cuts
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(150).collect():
        whole = groups_of(*tokenizers, r.text) or []
        a, b, _, good = ours.encode_parts(ours.parts(r.text) if r.text else [], size)
        assert good.all()
        assert a.ids.tolist() == [x for xs, _ in whole for x in xs]
        assert b.ids.tolist() == [y for _, ys in whole for y in ys]


EDGES = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "  two  blanks \n\t and\r\ntabs   nbsp x"),
    (5, "日本語のテキスト 漢字 🙂👩‍👩‍👧 é é ñ"),
    (6, "a ▁ mark"),
    (7, "<|endoftext|> <s> </s> <unk> <0x41>"),
    (8, "it's we'll I'D 12 345 ...!?"),
    (9, "x\x00y � ﻿z"),
    (10, "a" * 5000 + " " * 5000 + "1" * 3000),
    (11, "ab cd " * 30_000),
    (11, "ab cd " * 30_000),
    (None, "no id"),
]


@pytest.mark.parametrize("limits", [(1 << 20, 16 << 20), (40, 1 << 10)])
def test_edge_cases(spark, tmp_path, tokenizers, monkeypatch, limits):
    monkeypatch.setattr(align, "PART_PAIRS", limits[0])
    monkeypatch.setattr(align, "CELL_BYTES", limits[1])
    monkeypatch.setattr(align, "ROW", limits[0] // 16)
    monkeypatch.setattr(align, "SLICE", limits[0])
    monkeypatch.setattr(align, "WIDE", limits[0] // 20)
    rows = [(d, t, 5, "x", b"q") for d, t in EDGES]
    schema = "doc_id long, text string, block int, at string, pairs binary"
    assert by_query(spark, tmp_path, rows, schema) == sorted(expected(tokenizers, EDGES), key=str)


def blocks_of(monkeypatch, texts):
    """What one task returns for texts, unpacked, and the parts it has tokenized."""
    tokenized = []
    encode_parts = align.Tokenizers.encode_parts
    monkeypatch.setattr(align.Tokenizers, "encode_parts", lambda self, parts, size: (tokenized.extend(parts), encode_parts(self, parts, size))[1])
    monkeypatch.setattr(align, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    files = SimpleNamespace(value=tuple(open(f, "rb").read() for f in (align.BYTE_BPE, align.PIECE_BPE)))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["id", "text"])
    blocks = [b.to_pylist() for b in align._aligned(files)(iter([batch]))]
    documents = [[r[c] for c in ("id", "n_a", "n_b", "n_groups", "n_links", "groups")] for rows in blocks for r in rows if r["at"] >= 0]
    held = []
    for rows in blocks:
        keys, sizes = align.expand_sorted(rows[-1]["pairs"]), align.expand(rows[-1]["docs_of"], np.int64)
        doc, links = align.expand(rows[-1]["doc"], np.int32), align.expand(rows[-1]["links"], np.int64)
        held += [(rows[d]["id"], k, n) for k, d, n in zip(np.repeat(keys, sizes).tolist(), doc.tolist(), links.tolist(), strict=True)]
    return len(blocks), documents, sorted(held), tokenized


WORDS = [None, "", *(f"the word{i % 5}, of 漢字{i % 3} and\n the  \U0001f642 {'x' * (i % 7)} Lied{i}" for i in range(40)), None]


def test_a_part_is_tokenized_once_in_all_slices_of_a_task(monkeypatch):
    with monkeypatch.context() as m:
        slices, documents, held, tokenized = blocks_of(m, WORDS)
    assert slices == 1
    monkeypatch.setattr(align, "SLICE", 200)
    found = blocks_of(monkeypatch, WORDS)
    assert found[0] > 5
    assert found[1:3] == (documents, held)
    assert sorted(found[3]) == sorted(set(tokenized))


@pytest.mark.parametrize("known", [0, 4000])
def test_forgotten_parts_are_tokenized_again_with_the_same_rows(monkeypatch, known):
    with monkeypatch.context() as m:
        _, documents, held, tokenized = blocks_of(m, WORDS)
    monkeypatch.setattr(align, "SLICE", 200)
    monkeypatch.setattr(align, "KNOWN", known)
    monkeypatch.setattr(align, "AT_ONCE", 20)
    found = blocks_of(monkeypatch, WORDS)
    assert found[1:3] == (documents, held)
    assert set(found[3]) == set(tokenized) and len(found[3]) > len(tokenized)


def test_no_rows(spark, tmp_path):
    assert by_query(spark, tmp_path, []) == []


def test_refine_uses_spans_and_falls_back_on_decoded_bytes():
    def ends(spans, lengths, size):
        start, end = np.array(spans).T
        return align.refine(start, end, np.array(lengths), np.append(start[1:], size)).tolist()

    assert ends([(0, 1), (1, 4)], [1, 3], 4) == [1, 4]
    assert ends([(0, 4), (1, 4), (1, 4)], [2, 1, 1], 4) == [2, 3, 4]
    assert ends([(0, 1), (1, 1), (1, 1), (1, 4)], [1, 1, 1, 1], 4) == [1, 2, 3, 4]
