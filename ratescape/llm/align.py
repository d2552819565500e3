"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes.

Each tokenizer's spans are coarse cuts: character offsets of the byte-level
tokenizer, byte spans of the piece tokenizer's proto. Where a span is not that of
its token alone (bytes of one character in several tokens, byte fallback), the cut
is found from the decoded bytes. Places where tokens of both end cut a text into groups,
and every token pair of a group is a link.

Texts are cut before tokenizing at the blanks between two visible characters. No
token of either vocabulary spans such a place (``Tokenizers`` verifies that for the
piece vocabulary and, in every row of parts, for both; the byte-level one splits words there by its
pattern), so a text's tokens and groups are those of its parts in a row. The distinct parts of a
task's documents are put in rows, as texts of their own, and tokenized once; a task that has
met too many of them forgets them all and starts anew.

The number of documents that hold a pair linked is counted over all documents,
and each document is then scored with the counts of its pairs. Documents travel as
blocks of packed pairs, dealt with the pair table in cells of bounded size: a table
part of ``PART_PAIRS`` pairs times ``CELL_BYTES`` of blocks. A pair that all documents
have is one table row per cell and never a task of its own.

A row is a document, also if its id or text repeats. Null and empty texts, and those
whose tokens' bytes are not a space and the text, have no tokens: zeros and empty
groups. Other columns than id and text are not read. No rows give no rows.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from dataclasses import dataclass
from itertools import chain, islice
from operator import attrgetter
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratescape.llm.common import expand, expand_sorted, slices, squeeze, squeeze_sorted, stored, tidy

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
#: Pairs of one part of the pair table and packed bytes of blocks that meet it in one cell.
PART_PAIRS, CELL_BYTES = 1 << 20, 16 << 20
#: Bytes of text of a slice of documents, and characters of a row of parts and of rows that are tokenized at once, about.
SLICE, ROW, AT_ONCE = 4 << 20, 1 << 10, 1 << 18
#: A task forgets its distinct parts beyond so many bytes, about: their characters, so many more for each part and for each of its pairs.
KNOWN, PART_BYTES, PAIR_BYTES = 160 << 20, 200, 12
#: A group with more links than this is counted by distinct ids.
WIDE = 4096
#: A task adds up its pair counts beyond so many of them.
COUNT_ROWS = 1 << 21

_VISIBLE = "!-~¡-¬®-ɏͰ-ϿЀ-ԯ一-鿿"
CUT = re.compile(f" (?<=[{_VISIBLE}] )(?=[{_VISIBLE}])")
SOLID = re.compile(f"[{_VISIBLE}](?s:.*[{_VISIBLE}])?")
SPACE_MARK = "▁"


# ---------------------------------------------------------------- the two tokenizers


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible Latin-1 for itself, the others from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


def refine(start: np.ndarray, end: np.ndarray, lengths: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Byte ends of the tokens of a row of texts, from coarse spans and decoded lengths.

    ``after`` is the start of the next token's span, or the end of the text. A span
    that neither is empty nor shares bytes with its neighbours is a cut; from the last
    cut on, the decoded lengths are added up.
    """
    total = np.cumsum(lengths)
    before = np.concatenate(([0], end[:-1]))
    clean = (start >= before) & (start < end) & (after >= end)
    anchor = np.maximum.accumulate(np.where(clean, np.arange(len(total)), -1))
    held = anchor >= 0
    return np.where(held, end[anchor] + total - total[anchor], total)


def joined_at(sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... of all i, sizes[i] of each, in a row."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Tokens(NamedTuple):
    """Tokens of a row of texts: id, text and byte end, counted through all texts."""

    ids: np.ndarray
    text: np.ndarray
    end: np.ndarray


class _Vocabulary:
    """Decoded bytes of all tokens, as one array."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self._at = np.cumsum(self.size) - self.size
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.names = np.array([str(i) for i in range(len(tokens))], object)

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        return self._bytes[joined_at(self.size[ids], self._at[ids])]


class Tokenizers:
    """A byte-level and a piece tokenizer, made from the bytes of their files."""

    def __init__(self, byte_file: bytes, piece_file: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_str(byte_file.decode("utf-8"))
        self._a.encode_special_tokens = True
        self._b = SentencePieceProcessor(model_proto=piece_file)
        table = byte_of_char()
        entries = {i: bytes(table[c] for c in t) for t, i in self._a.get_vocab(with_added_tokens=False).items()}
        self.a = _Vocabulary([entries.get(i, b"") for i in range(max(entries) + 2)])
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.b = _Vocabulary([bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)])
        self.cuts = not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in pieces)

    def parts(self, text: str) -> list[str]:
        """The text in parts that can be tokenized apart, without the blanks between them."""
        return CUT.split(text) if self.cuts else [text]

    def encode_parts(self, parts: list[str], size: int) -> tuple[Tokens, Tokens, np.ndarray, np.ndarray]:
        """Tokens of parts, the byte end of each and whether its tokens' bytes are its own; ``text`` is the part's place.

        Parts that begin and end with a visible character go in rows of about ``size`` characters.
        """
        rows: list[list[int]] = []
        alone, held = [], 0
        for i, part in enumerate(parts):
            if not (self.cuts and SOLID.fullmatch(part)):
                alone.append([i])
                continue
            if not rows or held > size:
                rows.append([])
                held = 0
            rows[-1].append(i)
            held += len(part) + 1
        found = [self._rows(parts, rows), self._rows(parts, alone)]
        again = [[i] for i in np.flatnonzero(~found[0][3]).tolist()]
        if again:  # a part that cannot be tokenized spoils its row
            found.append(self._rows(parts, again))
        sizes = np.array([len(p.encode()) + 1 for p in parts], np.int64)
        ends = np.cumsum(sizes)
        good = np.zeros(len(parts), bool)
        sides = []
        for side in (0, 1):
            tokens = [f[side] for f in found]
            of = np.concatenate([t.text for t in tokens])
            order = np.argsort(of, kind="stable")
            end = np.concatenate([t.end for t in tokens])
            sides.append(Tokens(np.concatenate([t.ids for t in tokens])[order], of[order], (end + (ends - sizes)[of])[order]))
        good[np.concatenate([sides[0].text, sides[1].text])] = True
        return sides[0], sides[1], ends, good

    def _rows(self, parts: list[str], rows: list[list[int]]) -> tuple[Tokens, Tokens, None, np.ndarray]:
        """Tokens of rows of parts by part, with ends from the part's start; the mask is False for parts of rows that failed."""
        a, b, _, good = self.encode([" ".join([parts[i] for i in row]) for row in rows])
        if not rows:
            return a, b, None, np.ones(len(parts), bool)
        order = np.array([i for row in rows for i in row], np.int64)
        ends = np.cumsum([len(parts[i].encode()) + 1 for i in order.tolist()])
        starts = np.concatenate(([0], ends))[:-1].astype(np.int64)
        mask = np.ones(len(parts), bool)
        row_of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        mask[order[~good[row_of]]] = False
        out = []
        for t in (a, b):
            at = np.searchsorted(ends, t.end)
            if not np.isin(ends[good[row_of]], t.end).all():
                raise ValueError("a token spans two parts")
            out.append(Tokens(t.ids, order[at], t.end - starts[at]))
        return out[0], out[1], None, mask

    def encode(self, texts: list[str]) -> tuple[Tokens, Tokens, np.ndarray, np.ndarray]:
        """Tokens of texts, each preceded by a space, and the byte end of each text; a text whose tokens' bytes differ from it is not good and has none."""
        if not texts:
            none = Tokens(*[np.zeros(0, np.int64)] * 3)
            return none, none, np.zeros(0, np.int64), np.zeros(0, bool)
        raw = [(" " + t).encode() for t in texts]
        ends = np.cumsum([len(r) for r in raw])
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ours = self._a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        a_text = np.repeat(np.arange(len(texts)), [len(e) for e in ours])
        a_ids = np.fromiter(chain.from_iterable(e.ids for e in ours), np.int64, len(a_text))
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in ours)), np.int64, 2 * len(a_text)).reshape(-1, 2)
        # characters to bytes, through all texts
        place = np.append(np.flatnonzero((flat & 0xC0) != 0x80), len(flat))
        first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))[:-1]
        a_spans = place[spans + first[a_text][:, None]]
        del ours, spans, place

        theirs = [t.pieces for t in self._b.encode(texts, return_type="proto", num_threads=1)]
        b_text = np.repeat(np.arange(len(texts)), [len(p) for p in theirs])
        flat_b = chain.from_iterable(map(attrgetter("id", "begin", "end"), chain.from_iterable(theirs)))
        pieces = np.fromiter(flat_b, np.int64, 3 * len(b_text)).reshape(-1, 3)
        b_ids, b_spans = pieces[:, 0], pieces[:, 1:]
        del theirs, flat_b
        # the proto's spans are of the text; the space before it belongs to the first piece
        start = ends - np.array([len(r) for r in raw])
        leading = np.diff(b_text, prepend=-1) > 0
        b_spans = b_spans + (start[b_text] + 1)[:, None]
        b_spans[leading, 0] -= 1

        good = np.ones(len(texts), bool)
        for ids, text, vocabulary in ((a_ids, a_text, self.a), (b_ids, b_text, self.b)):
            sizes = np.bincount(text, vocabulary.size[ids], len(texts)).astype(np.int64)
            same = sizes == np.diff(ends, prepend=0)
            here = same[text]
            differ = vocabulary.decoded(ids[here]) != flat[np.repeat(same, np.diff(ends, prepend=0))]
            of = np.repeat(text[here], vocabulary.size[ids[here]])
            same[of[differ]] = False
            good &= same
        out = []
        for ids, text, spans, vocabulary in ((a_ids, a_text, a_spans, self.a), (b_ids, b_text, b_spans, self.b)):
            kept = good[text]
            ids, text, spans = ids[kept], text[kept], spans[kept]
            low = start[text]
            # left out texts leave gaps: count bytes from the text's own start
            last = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
            after = np.where(last, ends[text], np.append(spans[1:, 0], 0))
            lengths = vocabulary.size[ids]
            skipped = low - (np.cumsum(lengths) - lengths)[np.searchsorted(text, text)]
            out.append(Tokens(ids, text, refine(spans[:, 0] - skipped, spans[:, 1] - skipped, lengths, after - skipped) + skipped))
        return out[0], out[1], ends, good


# ---------------------------------------------------------------- documents of a task

_ROWS = pa.schema(
    [("block", pa.int64()), ("at", pa.int32()), ("id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups", pa.string())]
    + [(c, pa.binary()) for c in ("pairs", "docs_of", "doc", "links")]
)
_SQL_ROWS = "block bigint, at int, id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs binary, docs_of binary, doc binary, links binary"


def _names(tokenizers: Tokenizers, a: Tokens, b: Tokens, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All tokens as written in groups, each with its separator, and their texts: A ids, ``|``, B ids, ``;``."""
    a_last = np.append(a_group[1:] != a_group[:-1], True)
    b_last = np.append(b_group[1:] != b_group[:-1], True)
    end_of_text = np.append(b.text[1:] != b.text[:-1], True)
    left = tokenizers.a.names[a.ids] + np.where(a_last, "|", ",").astype(object)
    right = tokenizers.b.names[b.ids] + np.where(b_last, np.where(end_of_text, "", ";"), ",").astype(object)
    order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
    return np.concatenate([left, right])[order], np.concatenate([a.text, b.text])[order]


def _linked(a: Tokens, b: Tokens, a_group: np.ndarray, b_group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, text, links) of all groups; a pair may come in several rows."""
    a_size, b_size = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    b_first = np.cumsum(b_size) - b_size
    wide = a_size * b_size > WIDE
    near = ~wide[a_group]
    times = b_size[a_group[near]]
    left = np.repeat(a.ids[near], times)
    right = b.ids[joined_at(times, b_first[a_group[near]])]
    pairs, text, links = [left << 32 | right], [np.repeat(a.text[near], times)], [np.ones(len(left), np.int64)]
    for g in np.flatnonzero(wide).tolist():
        mine, m = np.unique(a.ids[a_group == g], return_counts=True)
        other, n = np.unique(b.ids[b_group == g], return_counts=True)
        pairs.append((mine[:, None] << 32 | other).ravel())
        links.append(np.outer(m, n).ravel())
        text.append(np.full(len(mine) * len(other), a.text[np.searchsorted(a_group, g)]))
    return np.concatenate(pairs), np.concatenate(text), np.concatenate(links)


class _Parts:
    """The distinct parts that the texts of a task have had so far, each tokenized once.

    A part has a number, its groups in writing, its counts (A ids, B ids, groups, links),
    and its pairs in a row: the place of each in the sorted ``keys``, and its links.
    All is forgotten between two slices where it takes more than about ``KNOWN`` bytes.
    """

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self._forget()

    def _forget(self) -> None:
        self._number: defaultdict[str, int] = defaultdict()
        self._number.default_factory = self._number.__len__
        self._bytes = 0
        self.names: list[str] = []
        self.good, self.sums = np.zeros(0, bool), np.zeros((4, 0), np.int64)
        self.keys, self.rank, self.links, self.pair_size = (np.zeros(0, t) for t in (np.int64, np.int32, np.int64, np.int64))

    def numbers(self, rows: list[list[str]], n: int) -> np.ndarray:
        """The numbers of the n parts of all rows; what is new among them is tokenized."""
        if self._bytes + PAIR_BYTES * len(self.rank) > KNOWN:
            self._forget()
        known = len(self._number)
        out = np.fromiter(map(self._number.__getitem__, chain.from_iterable(rows)), np.int64, n)
        new = list(islice(self._number, known, None))
        if new:
            sizes = np.fromiter(map(len, new), np.int64, len(new))
            self._bytes += int(sizes.sum()) + PART_BYTES * len(new)
            edges = np.flatnonzero(np.diff(np.cumsum(sizes) // AT_ONCE)) + 1
            self._add([self._found(new[i:j]) for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(new)], strict=True)])
        return out

    def _found(self, parts: list[str]) -> tuple[np.ndarray, ...]:
        """Of parts: whether they are good, counts, pairs with their links, by part, and the number of pairs."""
        size = len(parts)
        a, b, ends, good = self.tokenizers.encode_parts(parts, ROW)
        ends_here = np.zeros(int(ends[-1]) + 1, bool)
        ends_here[a.end] = True
        cuts = b.end[ends_here[b.end]]
        a_group, b_group = np.searchsorted(cuts, a.end), np.searchsorted(cuts, b.end)
        names, of = _names(self.tokenizers, a, b, a_group, b_group)
        at = np.searchsorted(of, np.arange(size + 1)).tolist()
        names = names.tolist()
        self.names += ["".join(names[at[i] : at[i + 1]]) for i in range(size)]
        last_of_group = np.append(a_group[1:] != a_group[:-1], True) if len(a_group) else np.zeros(0, bool)
        pair, part, links = _linked(a, b, a_group, b_group, len(cuts))
        sums = [np.bincount(x, minlength=size) for x in (a.text, b.text, a.text[last_of_group])]
        sums.append(np.bincount(part, links, size).astype(np.int64))
        order = np.argsort(part, kind="stable")
        return good, np.stack(sums), pair[order], links[order], np.bincount(part, minlength=size)

    def _add(self, found: list[tuple[np.ndarray, ...]]) -> None:
        good, sums, pairs, links, pair_size = zip(*found, strict=True)
        self.good = np.concatenate([self.good, *good])
        self.sums = np.concatenate([self.sums, *sums], axis=1)
        self.links = np.concatenate([self.links, *links])
        self.pair_size = np.concatenate([self.pair_size, *pair_size])
        new, rank = np.unique(np.concatenate(pairs), return_inverse=True)
        keys = np.union1d(self.keys, new)
        moved = [np.searchsorted(keys, x).astype(np.int32)[at] for x, at in ((self.keys, self.rank), (new, rank))]
        self.keys, self.rank = keys, np.concatenate(moved)


def _block(known: _Parts, batch: pa.RecordBatch, block: int) -> pa.RecordBatch:
    texts = batch.column("text").to_pylist()
    n = len(texts)
    rows = [known.tokenizers.parts(t) if t else [] for t in texts]
    counts = np.array([len(row) for row in rows], np.int64)
    seen = known.numbers(rows, int(counts.sum()))
    del texts, rows
    # documents: all parts, or nothing
    doc = np.repeat(np.arange(n), counts)
    whole = np.bincount(doc, ~known.good[seen], n) == 0
    seen, doc = seen[whole[doc]], doc[whole[doc]]
    at = np.searchsorted(doc, np.arange(n + 1)).tolist()
    written = list(map(known.names.__getitem__, seen.tolist()))
    groups = [";".join(written[at[i] : at[i + 1]]) for i in range(n)]
    del written
    totals = [np.bincount(doc, x[seen], n).astype(np.int64) for x in known.sums]
    # every (pair, document) of the block once, with its links
    each = known.pair_size[seen]
    place = joined_at(each, (np.cumsum(known.pair_size) - known.pair_size)[seen])
    held = known.rank[place].astype(np.int64)
    held *= n
    held += np.repeat(doc, each)
    both, where = np.unique(held, return_inverse=True)
    total = np.bincount(where, known.links[place], len(both)).astype(np.int64)
    del held, where
    place, doc = both // max(n, 1), both % max(n, 1)
    docs_of = np.bincount(place, minlength=len(known.keys)).astype(np.int64)
    packed = [squeeze_sorted(known.keys[docs_of > 0].astype(np.uint64)), squeeze(docs_of[docs_of > 0]), squeeze(doc.astype(np.int32)), squeeze(total)]
    columns = [[block] * (n + 1), [*range(n), -1], [*batch.column("id").to_pylist(), None]]
    columns += [[*x.tolist(), None] for x in totals] + [[*groups, None]] + [[*[None] * n, x] for x in packed]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS, strict=True)], schema=_ROWS)


def _aligned(files):
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks share the cores already
        known = _Parts(Tokenizers(*files.value))
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in slices(batch, limit=SLICE):
                yield _block(known, piece, block)
                block += 1

    return tidy(run)


# ---------------------------------------------------------------- counts over all documents


def _add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, where, np.concatenate(counts))
    return found, total


def _pair_counts(batches):
    """(a, b, n_docs) of the blocks of a task, added up while they are few."""
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []

    def out():
        found, total = _add_up(keys, counts)
        for i in range(0, len(found), 1 << 16):
            part = found[i : i + (1 << 16)]
            ids = [(part >> np.uint64(32)).astype(np.int32), (part & np.uint64(0xFFFFFFFF)).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[0]), pa.array(ids[1]), pa.array(total[i : i + (1 << 16)])], ["a", "b", "n_docs"])

    for batch in batches:
        for pairs, docs_of in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keys.append(expand_sorted(pairs))
            counts.append(expand(docs_of, np.int64))
            if sum(map(len, keys)) > COUNT_ROWS:
                found, total = _add_up(keys, counts)
                keys[:], counts[:] = [found], [total]
                if len(found) > COUNT_ROWS // 2:
                    yield from out()
                    keys.clear(), counts.clear()
    if keys:
        yield from out()


def _packed_part(table: pa.Table) -> pa.Table:
    """The pair table's part as one row of sorted keys, counts and marks."""
    a, b = (table.column(c).to_numpy().astype(np.uint64) for c in ("a", "b"))
    keys = a << np.uint64(32) | b
    order = np.argsort(keys)
    counts = table.column("n_docs").to_numpy()[order].astype(np.int64)
    best = table.column("best").to_numpy(zero_copy_only=False)[order].astype(np.uint8)
    return pa.table({"part": table.column("part")[:1], "keys": [squeeze_sorted(keys[order])], "counts": [squeeze(counts)], "marks": [squeeze(best)]})


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(31) + (keys & np.uint64(0xFFFFFFFF))) % np.uint64(parts)


def _asked(parts: int):
    """Blocks cut by the parts of the pair table."""

    def run(batches):
        for batch in batches:
            for block, pairs, docs_of, doc, links in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if parts == 1:
                    rows = [(0, pairs, docs_of, doc, links)]
                else:
                    keys, sizes = expand_sorted(pairs), expand(docs_of, np.int64)
                    of, n = expand(doc, np.int32), expand(links, np.int64)
                    part, rows = _part_of(keys, parts), []
                    for p in np.unique(part).tolist():
                        kept = part == p
                        wide = np.repeat(kept, sizes)
                        rows.append((p, squeeze_sorted(keys[kept]), squeeze(sizes[kept]), squeeze(of[wide]), squeeze(n[wide])))
                columns = [pa.array([block] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32())]
                columns += [pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 5)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "part", "pairs", "docs_of", "doc", "links"])

    return tidy(run)


_SCORES = "block bigint, at int, n_best bigint, count_sum bigint"


def _answered(asked: pa.Table, table: pa.Table) -> pa.Table:
    """Per document of the blocks: links whose pair is the best of its A id, and the sum of counts over links."""
    out: list[tuple] = []
    if table.num_rows:
        keys = expand_sorted(table.column("keys")[0].as_py())
        counts = expand(table.column("counts")[0].as_py(), np.int64)
        best = expand(table.column("marks")[0].as_py(), np.uint8).astype(bool)
    for row in asked.select(["block", "pairs", "docs_of", "doc", "links"]).to_pylist():
        sizes = expand(row["docs_of"], np.int64)
        place = np.repeat(np.searchsorted(keys, expand_sorted(row["pairs"])), sizes)
        doc, links = expand(row["doc"], np.int32), expand(row["links"], np.int64)
        n = int(doc.max()) + 1 if len(doc) else 0
        sums, marked, held = (np.zeros(n, np.int64) for _ in range(3))
        np.add.at(sums, doc, counts[place] * links)
        np.add.at(marked, doc, best[place] * links)
        np.add.at(held, doc, 1)
        at = np.flatnonzero(held)
        out.append((np.full(len(at), row["block"], np.int64), at.astype(np.int32), marked[at], sums[at]))
    joined = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, t) for t in (np.int64, np.int32, np.int64, np.int64)]
    return pa.table(joined, names=["block", "at", "n_best", "count_sum"])


@dataclass(frozen=True)
class Alignments:
    """Results over a set of documents; ``block`` and ``at`` name a document's row.

    * documents: block, at, id, n_a, n_b, n_groups, n_links and groups, "a1,a2|b1;a3|b2,b3" of token ids;
    * pairs: a, b, n_docs (documents that hold the pair linked) and best (no pair of this a has more);
    * scores: block, at, n_best and count_sum, for documents with links.
    """

    documents: DataFrame
    pairs: DataFrame
    scores: DataFrame


def align(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, doc_id: str = "doc_id", text: str = "text") -> Alignments:
    """Align the tokens of two tokenizers in every document; the vocabulary files are read where the driver runs."""
    spark: SparkSession = docs.sparkSession
    files = spark.sparkContext.broadcast((Path(byte_bpe).read_bytes(), Path(piece_bpe).read_bytes()))
    named = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = stored(named.mapInArrow(_aligned(files), _SQL_ROWS), "align-rows")
    documents = rows.where("at >= 0").select("block", "at", "id", "n_a", "n_b", "n_groups", "n_links", "groups")
    blocks = rows.where("at < 0").select("block", "pairs", "docs_of", "doc", "links")

    partial = blocks.select("pairs", "docs_of").mapInArrow(tidy(_pair_counts), "a int, b int, n_docs bigint")
    counted = partial.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"))
    best = F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a"))
    pairs = stored(counted.withColumn("best", best), "align-pairs")

    packed = F.expr("length(pairs) + length(docs_of) + length(doc) + length(links)")
    size = blocks.agg(F.sum(packed)).first()[0] or 0
    parts = pairs.count() // PART_PAIRS + 1
    salts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // CELL_BYTES + 1) // parts + 1
    asked = blocks.mapInArrow(_asked(parts), "block bigint, part int, pairs binary, docs_of binary, doc binary, links binary")
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    part = F.pmod(F.col("a").cast("long") * 31 + F.col("b"), F.lit(parts)).cast("int")
    tables = pairs.withColumn("part", part).groupBy("part").applyInArrow(_packed_part, "part int, keys binary, counts binary, marks binary")
    dealt = tables.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    answers = asked.groupBy("part", "salt").cogroup(dealt.groupBy("part", "salt")).applyInArrow(tidy(_answered), _SCORES)
    scores = answers.groupBy("block", "at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return Alignments(documents, pairs, scores)
