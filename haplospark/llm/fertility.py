"""Quality rules from how a public tokeniser copes with a text.

Three figures of a whole text, all taken over its words: characters per token; the share of
byte-fallback tokens; and token entropy, the order-2 kind -log2(sum p^2) estimated from
pairs of tokens, which does not depend on the length of the text. A text is rejected if one
leaves the band of its language, or, if there is none for the language, of its script.
Bands widen as 1/tokens, since short texts scatter.

Base figures come with it (see ``base_figures``). Words are parts between ASCII white space.
Each is tokenised alone and remembered, which gives the same pieces as the text: no piece of
the vocabulary goes on after a blank.

Defined cases: a null or empty text has no words and fails the base rule; one without tokens
has figures of zero; an unknown or null language takes the band of the script most letters
belong to; null or repeated doc_ids each give a row.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haplospark.llm.common import forgets, map_batches, short_batches

VOCABULARY = "piece_bpe_32k.model"
REMEMBERED, LONGEST = 400_000, 64
SYMBOLS = b"#*$%&|<>"
WINDOW = 5


class Band(NamedTuple):
    """Bounds for long texts; ``slack`` / tokens is the allowance in characters and bits."""

    least_chars: float
    most_chars: float
    most_fallback: float
    least_entropy: float
    slack_chars: float = 30.0
    slack_entropy: float = 60.0


#: Per language; measured on labelled documents of good quality.
LANGUAGE_BANDS = {
    "en": Band(1.80, 3.00, 0.05, 5.65),
    "de": Band(1.80, 3.00, 0.05, 5.60),
    "fr": Band(1.55, 2.90, 0.05, 5.60),
    "es": Band(1.55, 2.90, 0.05, 5.40),
}
#: Per script, for other languages. Scripts with few pieces of their own fall back to bytes.
SCRIPT_BANDS = {
    "LATIN": Band(1.20, 5.50, 0.10, 4.50),
    "CYRILLIC": Band(1.00, 5.00, 0.10, 4.50),
    "GREEK": Band(0.80, 4.00, 0.20, 4.00),
}
OTHER_BAND = Band(0.25, 6.00, 1.00, 3.00)


class Figures(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    kept: bool
    n_tokens: int
    chars_per_token: float
    fallback_share: float
    token_entropy: float
    rejected_by: str | None


SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, n_tokens bigint, chars_per_token double, "
    "fallback_share double, token_entropy double, rejected_by string"
)
_TYPES = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] + [pa.float64()] * 3 + [pa.string()]


class _Words(dict):
    """Piece ids of words, as 16-bit integers in bytes."""

    def __init__(self, path: str):
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        self.fallback = np.array([self.model.is_byte(k) for k in range(size)])

    def __missing__(self, word: bytes) -> bytes:
        written = np.array(self.model.encode(word.decode()), self.dtype).tobytes()
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = written
        return written


@lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


forgets(__name__, _words.cache_clear)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    windows = list(zip(*(words[k:] for k in range(window)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, reach = 0, 0
    for at, seen in enumerate(windows):
        if times[seen] > 1:
            covered += at + window - max(at, reach)
            reach = at + window
    return covered


def base_figures(raw: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated windows."""
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(b"".join(words).decode()),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def token_figures(words: list[bytes], chars: int, path: str) -> tuple[int, float, float, float]:
    """Tokens, characters per token, share of byte fallback, entropy in bits."""
    known = _words(path)
    ids = np.frombuffer(b"".join(map(known.__getitem__, words)), known.dtype)
    total = len(ids)
    if not total:
        return 0, 0.0, 0.0, 0.0
    counts = np.bincount(ids, minlength=len(known.fallback))
    counts = counts.astype(np.float64)
    same = float((counts * (counts - 1)).sum())
    pairs = total * (total - 1)
    entropy = math.log2(pairs / same) if same else math.log2(max(pairs, 1)) + 1
    return total, chars / total, float(counts[known.fallback].sum()) / total, entropy


def _script(words: list[bytes]) -> str:
    letters = Counter()
    for char, times in Counter(b"".join(words).decode()).items():
        if char.isalpha():
            letters[unicodedata.name(char, "OTHER").split(" ")[0]] += times
    return max(letters, key=lambda s: (letters[s], s), default="OTHER")


def band_of(lang: str | None, words: list[bytes]) -> Band:
    found = LANGUAGE_BANDS.get(lang)
    return found or SCRIPT_BANDS.get(_script(words), OTHER_BAND)


def rejection(band: Band, tokens: int, chars: float, fallback: float, entropy: float) -> str | None:
    """The figure that leaves its band, if one does."""
    if not tokens:
        return None
    if not band.least_chars - band.slack_chars / tokens <= chars <= band.most_chars + band.slack_chars / tokens:
        return "chars_per_token"
    if fallback > band.most_fallback + 2 / tokens:
        return "fallback_share"
    if entropy < band.least_entropy - band.slack_entropy / tokens:
        return "token_entropy"
    return None


def judge(raw: bytes, lang: str | None, path: str | None = None) -> Figures:
    """All figures of a text and the verdict."""
    words = raw.split()
    base = base_figures(raw, words)
    failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
    figures = token_figures(words, base[1], path or public_tokenizers.path(VOCABULARY))
    reason = rejection(band_of(lang, words), *figures)
    return Figures(*base, failed, not failed and reason is None, *figures, reason)


def _judged(texts: pa.Array, langs: pa.Array, path: str) -> list[Figures]:
    return [
        judge((text.as_py() or "").encode(), lang.as_py(), path)
        for text, lang in zip(texts, langs, strict=True)
    ]


def quality_figures(documents: DataFrame, *keep: Column | str, path: str | None = None) -> DataFrame:
    """The kept columns and all figures of every document."""
    path = path or public_tokenizers.path(VOCABULARY)
    narrow = documents.select(*keep, F.col("text").alias("_text"), F.col("lang").alias("_lang"))
    fields = narrow.schema.fields[:-2]
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _judged(*batch.columns[-2:], path)
        columns = list(zip(*found, strict=True)) or [()] * len(_TYPES)
        arrays = [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], *arrays], [*batch.schema.names[:-2], *Figures._fields]
        )

    return map_batches(narrow, run, kept + SCHEMA)


def keep_good(documents: DataFrame, path: str | None = None) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    short_batches(documents.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    names = [f"c{k}" for k in range(len(documents.columns))]
    text, lang = documents.columns.index("text"), documents.columns.index("lang")
    narrow = documents.toDF(*names)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _judged(batch.column(text), batch.column(lang), path)
        return batch.filter(pa.array([f.kept for f in found], pa.bool_()))

    return map_batches(narrow, run, narrow.schema).toDF(*documents.columns)
