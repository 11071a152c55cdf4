"""Byte-level BPE by backtracking over longest matches, in linear time.

The bytes of a piece are taken as Latin-1 characters. One pass of an Aho-Corasick automaton
finds the longest token that starts at every byte. A token may follow another if merging
the bytes of the two gives just the two again, which undoing their merges tells; that is remembered per pair. The encoding is
the one sequence in which each token may follow the one before, so the search goes forward
by longest tokens and back to shorter ones, and never visits a byte twice that led nowhere.

Texts are cut by the vocabulary's pattern. Where words stand between single blanks and
single line ends, cutting there gives the same pieces, so such words are remembered whole;
any other text is cut by the pattern itself.

Defined cases: a null text is empty and has no ids; ids of special tokens never occur; null
or repeated doc_ids each give a row.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haplospark.llm.common import Remembered, forgets, map_batches, short_batches

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Bytes that a worker remembers of words and of pieces, and most token pairs.
WORD_BYTES, PIECE_BYTES, PAIRS = 48 << 20, 128 << 20, 800_000
#: Two white spaces in a row, or one that is neither a blank nor a line end, or one outside.
_UNEVEN = re.compile(r"\s\s|[^\S \n]|\A\s|\s\Z")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class ByteBpe:
    """Encodes pieces of bytes by ranks, and decodes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        count = max(ranks.values()) + 1
        self.vocabulary, self.length, self.shorter = [b""] * count, [0] * count, [-1] * count
        self.matches = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.vocabulary[rank], self.length[rank] = token, len(token)
            self.matches.add_word(token.decode("latin-1"), rank)
            prefixes = (ranks.get(token[:k]) for k in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((r for r in prefixes if r is not None), -1)
        self.matches.make_automaton()
        self.may_follow: dict[tuple[int, int], bool] = {}
        self._find_halves()

    def _find_halves(self) -> None:
        """The two tokens that merging makes every token from, the lowest rank first.

        Single bytes are their own halves. Tokens that tokens of lower ranks do not make are
        ``unmade``; with a vocabulary that has any, pairs are told by merging.
        """
        self.halves = [(k, k) for k in range(len(self.vocabulary))]
        self.joined: dict[tuple[int, int], int] = {}
        self.unmade: set[int] = set()
        for rank in sorted(self.ranks.values()):
            token, left = self.vocabulary[rank], self.shorter[rank]
            while left >= 0:
                right = self.ranks.get(token[self.length[left] :], rank)
                if left < rank and right < rank and self._stay(left, right):
                    self.halves[rank], self.joined[left, right] = (left, right), rank
                    break
                left = self.shorter[left]
            else:
                if len(token) > 1:
                    self.unmade.add(rank)

    def merged(self, piece: bytes) -> list[int]:
        """Ids by plain merging, the lowest rank first; for short pieces."""
        parts = [piece[k : k + 1] for k in range(len(piece))]
        while len(parts) > 1:
            ranked = [self.ranks.get(a + b, 1 << 62) for a, b in zip(parts, parts[1:], strict=False)]
            least = min(ranked)
            if least == 1 << 62:
                break
            at = ranked.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _stay(self, a: int, b: int) -> bool:
        """Whether merging the bytes of two tokens gives just the two again.

        Merges are undone, the latest first. A pair on either side of the border that joins to a
        token of a lower rank than the merge undone last would have been merged before it.
        """
        halves, joined, least = self.halves, self.joined, 1 << 62
        while True:
            if joined.get((a, b), least) < least:
                return False
            right_first = b >= a  # of equal ranks, the left one was merged first
            if right_first and halves[b][0] == b or not right_first and halves[a][1] == a:
                right_first = not right_first  # a single byte: the other side's merge is undone
            if right_first:
                least, b, whole = b + 1, halves[b][0], b
                if b == whole:
                    return True
            else:
                least, a, whole = a, halves[a][1], a
                if a == whole:
                    return True

    def _follows(self, a: int, b: int) -> bool:
        known = self.may_follow.get((a, b))
        if known is None:
            if self.unmade:
                known = self.merged(self.vocabulary[a] + self.vocabulary[b]) == [a, b]
            else:
                known = self._stay(a, b)
            if len(self.may_follow) >= PAIRS:
                self.may_follow.clear()
            self.may_follow[a, b] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        size, length, shorter, may_follow = len(piece), self.length, self.shorter, self.may_follow
        longest = array("i", [-1]) * size
        for stop, rank in self.matches.iter(piece.decode("latin-1")):
            longest[stop + 1 - length[rank]] = rank  # later ends are longer
        lost = bytearray(size + 1)
        ids: list[int] = []
        at, token = 0, longest[0] if size else -1
        while at < size:
            while token >= 0:
                stop = at + length[token]
                if not lost[stop]:
                    if not ids:
                        break
                    follows = may_follow.get((ids[-1], token))
                    if self._follows(ids[-1], token) if follows is None else follows:
                        break
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                at = stop
                token = longest[at] if at < size else -1
            else:
                lost[at] = 1
                token = ids.pop()
                at -= length[token]
                token = shorter[token]
        return ids


PATTERN = regex.compile(public_tokenizers.PATTERN)


class TextCodec:
    """Encodes and decodes whole texts.

    Words are remembered with the blank before them, and the pieces of words by themselves: a new
    word is often made of known pieces.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.bpe = ByteBpe(ranks)
        self.pieces = Remembered(self._piece, PIECE_BYTES)
        self.first = Remembered(self._first_word, WORD_BYTES // 4)
        self.other = Remembered(self._other_word, WORD_BYTES)
        self.decimal = [b"%d" % k for k in range(len(self.bpe.vocabulary))]

    def _piece(self, piece: str) -> bytes:
        return array("I", self.bpe.encode_piece(piece.encode())).tobytes()

    def _first_word(self, word: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, PATTERN.findall(word)))

    def _other_word(self, word: str) -> bytes:
        return self._first_word(" " + word)

    def encode(self, text: str) -> np.ndarray:
        if _UNEVEN.search(text):
            return np.frombuffer(self._first_word(text), np.uint32)
        parts, between = [], self.first["\n"]
        for line in text.split("\n") if text else []:
            words = line.split(" ")
            parts.append(self.first[words[0]])
            parts.extend(map(self.other.__getitem__, words[1:]))
            parts.append(between)
        return np.frombuffer(b"".join(parts[:-1]), np.uint32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bpe.vocabulary.__getitem__, ids))

    def digests(self, text: str) -> tuple[int, str, str]:
        """The number of ids, the hash of them as text, the hash of what they decode to."""
        ids = self.encode(text).tolist()
        written = b" ".join(map(self.decimal.__getitem__, ids))
        return len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


@lru_cache(maxsize=2)
def codec(path: str) -> TextCodec:
    return TextCodec(read_ranks(path))


forgets(__name__, codec.cache_clear)


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    return (t.as_py() or "" for t in batch.column(batch.num_columns - 1))


def _numbered(table: DataFrame, keep: tuple[Column | str, ...], last: Column) -> tuple[DataFrame, list[str], str]:
    """The kept columns and one more with names by place, the kept ones' names, and their schema.

    Names by place cannot clash, whatever the columns are called and however often.
    """
    kept = table.select(*keep)
    fields = [(f"c{k}", f.name, f.dataType.simpleString()) for k, f in enumerate(kept.schema.fields)]
    narrow = table.select(*keep, last).toDF(*(n for n, _, _ in fields), "last")
    return narrow, [name for _, name, _ in fields], "".join(f"{n} {kind}, " for n, _, kind in fields)


def _with(batch: pa.RecordBatch, columns: list[pa.Array]) -> pa.RecordBatch:
    kept = batch.columns[:-1]
    return pa.RecordBatch.from_arrays([*kept, *columns], [*batch.schema.names[:-1], *(f"d{k}" for k in range(len(columns)))])


def encode_documents(
    documents: DataFrame, *keep: Column | str, path: str | None = None
) -> DataFrame:
    """The kept columns, ``n_tokens`` and the ``ids`` of every whole text.

    Kept columns may have any names, also these two.
    """
    short_batches(documents.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    narrow, names, schema = _numbered(documents, keep, documents["text"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [codec(path).encode(text) for text in _texts(batch)]
        sizes = [len(i) for i in ids]
        flat = pa.array(np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32))
        starts = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return _with(batch, [pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(starts, flat)])

    return map_batches(narrow, run, f"{schema}d0 bigint, d1 array<int>").toDF(*names, "n_tokens", "ids")


def decode_ids(tokens: DataFrame, *keep: Column | str, path: str | None = None) -> DataFrame:
    """The kept columns and the ``bytes`` that ``ids`` stand for (null: none)."""
    path = path or public_tokenizers.path(VOCABULARY)
    narrow, names, schema = _numbered(tokens, keep, tokens["ids"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [codec(path).decode(ids) for ids in _texts(batch)]
        return _with(batch, [pa.array(found, pa.binary())])

    return map_batches(narrow, run, f"{schema}d0 binary").toDF(*names, "bytes")


def bpe_digests(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: the number of ids, the hash of the ids, the hash of the text they decode to."""
    path = path or public_tokenizers.path(VOCABULARY)
    narrow, names, schema = _numbered(documents, ("doc_id",), documents["text"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [codec(path).digests(text) for text in _texts(batch)]
        counts, ids, decoded = zip(*found, strict=True) if found else ((), (), ())
        return _with(batch, [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())])

    return map_batches(narrow, run, f"{schema}d0 bigint, d1 string, d2 string").toDF(
        *names, "n_tokens", "ids_sha256", "decoded_sha256"
    )
