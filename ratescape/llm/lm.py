"""Language-model scores by deleted interpolation.

A bigram, a unigram and a uniform estimate are mixed. The mixture weights depend
on how frequent the context is and are learned by expectation-maximisation on
deleted counts: each training token is predicted from the counts without itself.

Texts become blocks of word numbers with a vocabulary of their own, stored in
the shared folder. Each block asks for the corpus counts of its distinct words
and bigrams: the keys go to key ranges with the block's own training counts, are
summed there, and the sums go back to the block. So every count covers the whole
corpus, a frequent word travels once per block, and nothing is broadcast but the
mixture weights.

Tokens are words, A-Z in lower case, then one end. The context of the first
token is the end of the text before. Null and empty texts are one end. A null id
is not held out. Without training tokens all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescape.llm.common import expand, expand_sorted, mix, part_bounds, parts_of, slices, squeeze, squeeze_sorted, stored, tidy, Words

BLOCK_TOKENS = 1_000_000
END = np.uint64(0x5EED0FE4D0000001)
BUCKETS, HALF_OCTAVES, ROUNDS = 42, 100, 60
BLOCK = "ids binary, no_id binary, held binary, sizes binary, vocabulary binary, tokens binary"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, held, sizes, tokens, n = [], [], [], [], 0

    def block() -> pa.RecordBatch:
        vocabulary, numbers = np.unique(np.concatenate(tokens), return_inverse=True)
        doc = np.array([0 if i is None else i for i in ids], np.int64)
        none = np.array([i is None for i in ids])
        columns = [squeeze(doc), squeeze(none), squeeze(np.array(held)), squeeze(np.array(sizes, np.int64)), squeeze_sorted(vocabulary), squeeze(numbers.astype(np.uint32))]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=[c.split()[0] for c in BLOCK.split(", ")])

    for batch in batches:
        for part in slices(batch):
            words = Words(part.column("text"))
            rows = zip(part.column("doc_id").to_pylist(), part.column("held").to_pylist(), words.at[:-1].tolist(), words.at[1:].tolist(), strict=True)
            for doc, out, a, b in rows:
                ids.append(doc), held.append(out), sizes.append(b - a + 1)
                tokens.append(np.append(words.hash[a:b], END))
                n += b - a + 1
                if n >= BLOCK_TOKENS:
                    yield block()
                    ids, held, sizes, tokens, n = [], [], [], [], 0
    if ids:
        yield block()


class _Block:
    def __init__(self, row: dict):
        self.ids, self.no_id = expand(row["ids"], np.int64), expand(row["no_id"], bool)
        self.held, self.sizes = expand(row["held"], bool), expand(row["sizes"], np.int64)
        self.vocabulary, self.tokens = expand_sorted(row["vocabulary"]), expand(row["tokens"], np.uint32)
        self.context = np.empty_like(self.tokens)
        self.context[1:] = self.tokens[:-1]
        self.context[np.cumsum(self.sizes) - self.sizes] = np.searchsorted(self.vocabulary, END)
        self.train = np.repeat(~self.held, self.sizes)
        pairs = mix(self.vocabulary[self.context] * np.uint64(0xD6E8FEB86659FD93) + self.vocabulary[self.tokens])
        self.pairs, self.pair = np.unique(pairs, return_inverse=True)


def _ask(parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, out = _Block(row), []
                for kind, keys, numbers in ((1, block.vocabulary, block.tokens), (2, block.pairs, block.pair)):
                    counts = np.bincount(numbers[block.train], minlength=len(keys)).astype(np.uint32)
                    at = part_bounds(keys, parts)
                    out += [(kind, p, row["block"], squeeze_sorted(keys[a:b]), squeeze(counts[a:b])) for p, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["kind", "part", "block", "keys", "counts"])

    return ask


ANSWER = "kind int, part int, block long, totals binary, types long, total long"


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, keys, counts = [], [], []
    for batch in batches:
        for kind, part, block, k, c in zip(*(batch.column(x).to_pylist() for x in ("kind", "part", "block", "keys", "counts")), strict=True):
            rows.append((kind, part, block)), keys.append(expand_sorted(k)), counts.append(expand(c, np.uint32))
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    new = np.append(True, flat[order][1:] != flat[order][:-1])
    which = np.empty(len(flat), np.int64)
    which[order] = np.cumsum(new) - 1
    sums = np.bincount(which, np.concatenate(counts)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys]).tolist()
    # counts as 64-bit only where they need it: most are small
    answers = [squeeze(sums[which[e - len(k) : e]]) for e, k in zip(ends, keys, strict=True)]
    first = [i == 0 for i in range(len(rows))]  # what the part adds to the corpus, told once
    types, total = int((sums > 0).sum()), int(sums.sum())
    columns = [*zip(*rows, strict=True), answers, [types * f for f in first], [total * f for f in first]]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in ANSWER.split(", ")])


def _counts(answers: pa.Table, block: _Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Corpus counts of each token, its context and its bigram."""
    table = answers.sort_by([("kind", "ascending"), ("part", "ascending")])
    by_kind: dict[int, list[np.ndarray]] = {1: [], 2: []}
    for kind, raw in zip(table.column("kind").to_pylist(), table.column("totals").to_pylist(), strict=True):
        by_kind[kind].append(expand(raw, np.int64))
    words, pairs = (np.concatenate(by_kind[k]) for k in (1, 2))
    return words[block.tokens], words[block.context], pairs[block.pair]


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else by powers of two of its count."""
    return np.minimum(np.frexp(np.maximum(context, 0).astype(np.float64))[1], BUCKETS - 1)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=(a > 0) & (b > 0))


def _grid(p: np.ndarray) -> np.ndarray:
    """Half octaves of a probability; the last number is for 0."""
    out = np.full(len(p), HALF_OCTAVES, np.int64)
    out[p > 0] = np.minimum(np.round(-2 * np.log2(p[p > 0])), HALF_OCTAVES - 1)
    return out


def _deleted(n: int):
    """Training tokens of a block by (bucket, bigram estimate, unigram estimate), each without the token itself."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            block = _Block(row)
            word, context, pair = (c[block.train] - 1 for c in _counts(right, block))
            b = bucket(context)
            cell = (b * (HALF_OCTAVES + 1) + _grid(_ratio(pair, context))) * (HALF_OCTAVES + 1) + _grid(_ratio(word, np.full(len(word), max(n - 1, 1))))
            cells, counts = np.unique(cell, return_counts=True)
            out.append(pa.table({"cell": pa.array(cells, pa.int64()), "tokens": pa.array(counts, pa.int64())}))
        return pa.concat_tables(out) if out else pa.table({"cell": pa.array([], pa.int64()), "tokens": pa.array([], pa.int64())})

    return run


def mixture(cells: np.ndarray, tokens: np.ndarray, types: int) -> np.ndarray:
    """Weights of (bigram, unigram, uniform) for each bucket, by expectation-maximisation."""
    side = HALF_OCTAVES + 1
    b, two, one = cells // (side * side), cells // side % side, cells % side
    p = np.stack([np.where(x == HALF_OCTAVES, 0.0, 2.0 ** (-x / 2.0)) for x in (two, one)] + [np.full(len(cells), 1.0 / (types + 1))], 1)
    weights = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
    weights[0] = [0.0, 0.7, 0.3]
    for _ in range(ROUNDS if len(cells) else 0):
        share = weights[b] * p
        share *= (tokens / share.sum(1))[:, None]
        sums = np.stack([np.bincount(b, share[:, k], BUCKETS) for k in range(3)], 1)
        seen = sums.sum(1) > 0
        weights[seen] = (sums[seen] + [0.0, 1e-6, 1e-6]) / (sums[seen].sum(1, keepdims=True) + 2e-6)
    return weights


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(weights: np.ndarray, n: int, v: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            block = _Block(row)
            word, context, pair = _counts(right, block)
            mixed = weights[bucket(context)]
            p = mixed[:, 0] * _ratio(pair, context) + mixed[:, 1] * word / max(n, 1) + mixed[:, 2] / (v + 1)
            base = np.log10((word + 1) / (n + v + 1))
            starts = np.cumsum(block.sizes) - block.sizes
            add = lambda x, starts=starts: np.add.reduceat(x, starts)
            columns = [
                pa.array(block.ids, mask=block.no_id),
                pa.array(block.held),
                pa.array(block.sizes),
                pa.array(add((word > 0).astype(np.int64))),
                pa.array(np.full(len(block.ids), n, np.int64)),
                pa.array(add(base)),
                pa.array(add(np.log10(p))),
            ]
            out.append(pa.table(columns, names=[c.split()[0] for c in RESULT.split(", ")]))
        return pa.concat_tables(out)

    return run


def interpolated_scores(docs: DataFrame, folds: int = 7, held_fold: int = 2) -> DataFrame:
    """log10 probabilities of every text; trained on documents whose crc32(doc_id) mod ``folds`` is not ``held_fold``."""
    parts = parts_of(docs.sparkSession)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_fold, F.lit(False))
    rows = docs.select("doc_id", "text", held.alias("held"))
    blocks = stored(rows.mapInArrow(tidy(_encode), BLOCK).withColumn("block", F.monotonically_increasing_id()), "lm-blocks")
    asked = blocks.mapInArrow(tidy(_ask(parts)), "kind int, part int, block long, keys binary, counts binary")
    answers = stored(asked.groupBy("kind", "part").applyInArrow(_answer, ANSWER), "lm-counts")
    n, v = (int(x or 0) for x in answers.where("kind = 1").agg(F.sum("total"), F.sum("types")).first())

    def with_counts(function, schema: str) -> DataFrame:
        return blocks.groupBy("block").cogroup(answers.select("kind", "part", "block", "totals").groupBy("block")).applyInArrow(tidy(function), schema)

    # at most BUCKETS * (HALF_OCTAVES + 1) ** 2 rows, whatever the input
    grid = with_counts(_deleted(n), "cell long, tokens long").groupBy("cell").agg(F.sum("tokens").alias("tokens")).collect()
    weights = mixture(np.array([r.cell for r in grid], np.int64), np.array([r.tokens for r in grid], np.float64), v)
    return with_counts(_score(weights, n, v), RESULT)
