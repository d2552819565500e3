"""Quality rules by tokeniser fertility.

Public vocabularies split every word of a text into tokens. A text is measured
by characters per token, share of byte-fallback tokens and token entropy, and
rejected when a measure leaves the band of its language (or, for a language
without bands, of its main script) and vocabulary. Entropy grows with length, so
its limit does too. Plain counts come with it: words, their
characters, symbols, repeated lines and repeated five-word windows.

A vocabulary splits a word the same way wherever it stands, so each distinct
word of a task is split once and its tokens are counted as often as it occurs.
All counts are whole-text counts; a text never leaves its row, nothing shuffles.

Null and empty texts have no words: all counts 0, measures null, base_failed true.
Rows repeat as often as given; a null language means bands by script.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ratescape.llm.common import IS_WORD, mix, shingles, slices, tidy, Words

VOCABULARY_DIR = "/opt/tokenizers"
VOCABULARIES = ("piece_bpe_32k.model", "byte_bpe_50k.tiktoken")
#: Words split at a time, and distinct words whose tokens a task remembers.
SPLIT_AT_ONCE, REMEMBERED = 20_000, 80_000


#: Smallest token counts of the length classes in which entropy is judged; shorter texts cannot have much.
ENTROPY_TOKENS = (64, 128, 256, 512, 1024)


@dataclass(frozen=True)
class Band:
    """What one vocabulary accepts: characters per token, byte-fallback share, entropy in bits by length class.

    ``short`` takes the place of ``low`` in texts too short for entropy, where one card number moves the mean.
    """

    low: float = 1.0
    high: float = 8.0
    fallback: float = 0.5
    entropy: tuple[float, ...] = (3.0,) * len(ENTROPY_TOKENS)
    short: float | None = None


#: By language, else by script; one band, or one per vocabulary file. ``low`` and ``entropy`` are the 0.5 % quantiles
#: of the 3,330 documents of sf0.1 that are labelled good and pass the base rule, rounded down; the shortest length
#: class is pooled over languages, "latin" is all four together. ``high`` and ``fallback`` leave room for natural
#: prose, which has longer pieces than the tables' words. No table has another script: "other" has a margin below
#: passages in Russian, Greek, Chinese, Arabic and Hindi.
_PIECE, _BYTE = VOCABULARIES
BANDS: dict[str, Band | dict[str, Band]] = {
    "en": {
        _PIECE: Band(2.01, 5.5, 0.05, (4.95, 5.75, 6.09, 6.39, 6.65), 1.25),
        _BYTE: Band(2.12, 5.5, 0.05, (5.20, 5.70, 6.16, 6.45, 6.71), 1.25),
    },
    "de": {
        _PIECE: Band(2.06, 5.5, 0.05, (4.95, 5.76, 5.99, 6.28, 6.46), 1.25),
        _BYTE: Band(1.91, 5.5, 0.10, (5.20, 5.85, 6.02, 6.34, 6.48), 1.25),
    },
    "fr": {
        _PIECE: Band(1.73, 5.5, 0.05, (4.95, 5.58, 6.00, 6.17, 6.43), 1.25),
        _BYTE: Band(1.74, 5.5, 0.15, (5.20, 5.65, 5.95, 6.18, 6.37), 1.25),
    },
    "es": {
        _PIECE: Band(1.79, 5.5, 0.05, (4.95, 5.77, 5.96, 6.19, 6.52), 1.25),
        _BYTE: Band(1.66, 5.5, 0.15, (5.20, 5.66, 5.86, 6.15, 6.38), 1.25),
    },
    "latin": {
        _PIECE: Band(1.84, 6.0, 0.05, (4.95, 5.69, 6.01, 6.25, 6.46), 1.1),
        _BYTE: Band(1.71, 6.0, 0.15, (5.20, 5.66, 5.93, 6.19, 6.38), 1.1),
    },
    "other": {
        _PIECE: Band(0.45, 6.0, 0.25, (4.0,) * 5, 0.3),
        _BYTE: Band(0.3, 6.0, 0.8, (3.8,) * 5, 0.3),
    },
}

RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_tokens long, chars_per_token double, fallback_share double, token_entropy double"
)


class Vocabulary:
    """Tokens of distinct words; remembers them within a task."""

    def __init__(self, path: str):
        self.name = path.rsplit("/", 1)[-1]
        self.known: dict[bytes, np.ndarray] = {}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.is_byte = np.array([model.is_byte(i) or model.is_unknown(i) for i in range(model.get_piece_size())])
            self._split = lambda words: model.encode(words, num_threads=1)
        else:
            import base64

            import public_tokenizers
            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            coder = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            # a single byte that is not a character of its own is a fallback
            self.is_byte = np.zeros(max(ranks.values()) + 1, bool)
            self.is_byte[[i for token, i in ranks.items() if len(token) == 1 and token[0] >= 128]] = True
            self._split = lambda words: [coder.encode_ordinary(" " + w) for w in words]

    def tokens(self, words: list[bytes]) -> list[np.ndarray]:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = words
        for i in range(0, len(new), SPLIT_AT_ONCE):
            part = new[i : i + SPLIT_AT_ONCE]
            split = self._split([w.decode("utf-8", "replace") for w in part])
            self.known.update((w, np.array(ids, np.uint32)) for w, ids in zip(part, split, strict=True))
        return [self.known[w] for w in words]


def _covered(hashes: np.ndarray, text_of: np.ndarray, texts: int, window: int) -> np.ndarray:
    """Per text: words in windows that the text has twice or more."""
    out = np.zeros(texts, np.int64)
    keys = shingles(hashes, window)
    if not len(keys):
        return out
    inside = text_of[: len(keys)] == text_of[window - 1 :]
    at = np.flatnonzero(inside)
    keys = mix(keys[at] ^ mix(text_of[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    steps = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(steps, at[twice], 1)
    np.add.at(steps, at[twice] + window, -1)
    hit = np.cumsum(steps[:-1]) > 0
    return np.bincount(text_of[hit], minlength=texts)


def _repeated_lines(text: str | None) -> int:
    seen: set[str] = set()
    again = 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            if line in seen:
                again += 1
            seen.add(line)
    return again


def _script(data: np.ndarray) -> str:
    """latin or other, by the larger number of letters."""
    latin = np.count_nonzero(((data | 32) >= 97) & ((data | 32) <= 122)) + np.count_nonzero((data >= 0xC3) & (data <= 0xC9))
    return "latin" if latin >= np.count_nonzero(data >= 0xCA) else "other"


def _within(band: Band, chars: int, ids: np.ndarray, is_byte: np.ndarray) -> tuple[bool, float, float, float]:
    per_token, fallback = chars / len(ids), float(is_byte[ids].mean())
    counts = np.unique(ids, return_counts=True)[1] / len(ids)
    entropy = max(0.0, float(-(counts * np.log2(counts)).sum()))
    length = bisect_right(ENTROPY_TOKENS, len(ids)) - 1
    low = band.low if length >= 0 or band.short is None else band.short
    fine = low <= per_token <= band.high and fallback <= band.fallback
    return fine and (length < 0 or entropy >= band.entropy[length]), per_token, fallback, entropy


def _measure(batch: pa.RecordBatch, vocabularies: list[Vocabulary], bands: dict[str, Band | dict[str, Band]]) -> pa.RecordBatch:
    texts = batch.num_rows
    words = Words(batch.column("text"), lower=False)
    data, at = words.data, words.at
    count = np.diff(at)
    text_of = np.repeat(np.arange(texts), count)

    def per_text(mask):
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[words.text_at])

    chars = per_text(IS_WORD[data] & ((data & 0xC0) != 0x80))
    symbols = per_text(np.isin(data, np.frombuffer(b"#*$%&|<>", np.uint8)))
    repeated = _covered(words.hash, text_of, texts, 5)
    lines = [_repeated_lines(t) for t in batch.column("text").to_pylist()]
    failed = (count < 10) | (100 * repeated > 20 * count)

    distinct, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
    raw = data.tobytes()
    spelled = [raw[s:e] for s, e in zip(words.start[first].tolist(), words.end[first].tolist(), strict=True)]
    split = [v.tokens(spelled) for v in vocabularies]
    sizes = [np.array([len(x) for x in ids], np.int64) for ids in split]
    flat = [np.concatenate(ids) if ids else np.zeros(0, np.uint32) for ids in split]
    starts = [np.cumsum(n) - n for n in sizes]
    langs = batch.column("lang").to_pylist() if "lang" in batch.schema.names else [None] * texts
    kept, tokens, measures = [], [], []
    for i in range(texts):
        verdict, shown = not failed[i], None
        own = which[at[i] : at[i + 1]]
        if len(own):
            band = bands.get(langs[i]) or bands[_script(data[words.text_at[i] : words.text_at[i + 1]])]
            for k, vocabulary in enumerate(vocabularies):
                n = sizes[k][own]
                ids = flat[k][np.repeat(starts[k][own] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                if len(ids):
                    own_band = band.get(vocabulary.name, Band()) if isinstance(band, dict) else band
                    fine, *values = _within(own_band, int(chars[i]), ids, vocabulary.is_byte)
                    verdict &= fine
                    shown = shown or (len(ids), *values)
        kept.append(bool(verdict))
        tokens.append(shown[0] if shown else 0)
        measures.append(shown[1:] if shown else (None, None, None))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").cast(pa.int64()),
            *(pa.array(x, pa.int64()) for x in (count, chars, symbols, lines, repeated)),
            pa.array(failed, pa.bool_()),
            pa.array(kept, pa.bool_()),
            pa.array(tokens, pa.int64()),
            *(pa.array([m[k] for m in measures], pa.float64()) for k in range(3)),
        ],
        names=[c.split()[0] for c in RESULT.split(", ")],
    )


def _loader(vocabulary_dir: str, vocabularies: tuple[str, ...]):
    def load() -> list[Vocabulary]:
        return [Vocabulary(f"{vocabulary_dir}/{name}") for name in vocabularies]

    return load


def quality_measures(
    docs: DataFrame,
    vocabulary_dir: str = VOCABULARY_DIR,
    vocabularies: tuple[str, ...] = VOCABULARIES,
    bands: dict[str, Band | dict[str, Band]] | None = None,
) -> DataFrame:
    """One row per document with its counts, measures (of the first vocabulary) and verdict.

    ``docs`` has doc_id, text and, optionally, lang. The vocabulary files must
    be at ``vocabulary_dir`` on every executor.
    """
    load, limits = _loader(vocabulary_dir, vocabularies), bands or BANDS

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = load()
        for batch in batches:
            for part in slices(batch):
                yield _measure(part, loaded, limits)

    columns = ["doc_id", "text"] + ["lang"] * ("lang" in docs.columns)
    return docs.select(*columns).mapInArrow(tidy(measure), RESULT)


def reject_by_fertility(docs: DataFrame, **options) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    load = _loader(options.get("vocabulary_dir", VOCABULARY_DIR), options.get("vocabularies", VOCABULARIES))
    limits = options.get("bands") or BANDS

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = load()
        for batch in batches:
            for part in slices(batch):
                yield part.filter(_measure(part, loaded, limits).column("kept"))

    return docs.mapInArrow(tidy(keep), docs.schema)
