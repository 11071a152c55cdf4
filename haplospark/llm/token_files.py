"""Token ids in flat binary files, with 64-bit document offsets, read by memory mapping.

A folder holds parts in ascending doc_id order. Of each part, ``.ids`` is a flat array of
unsigned little-endian integers, as wide as the vocabulary needs; ``.off`` has 64-bit
offsets of its documents, one more than there are; ``.doc`` has their 64-bit ids. The
manifest names the parts and holds what lies before each: prefix sums over their counts.
A task writes files with names of its own and reports them when it is done, so files of an
attempt that was lost are never read.

Parts of texts are encoded by the tokenizers library and remembered: the vocabulary drops white
space, so no token reaches over a blank or a line end, and a text's ids are those of its
parts. The string of a special token in a text gives that token, as in the library.

Defined cases: a null text is empty and has the end id alone; null doc_ids come first;
documents of equal doc_id follow a hash of their texts; an empty table gives no part.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haplospark.llm.common import Remembered, forgets, map_partitions, new_shared_folder, shared_file_system

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: Bytes that a worker remembers of parts of texts.
PART_BYTES = 112 << 20
_READ = 2048


#: Letters and numbers, in lower case, of the texts below, as character classes; fixed values.
_LETTERS, _NUMBERS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
#: Texts of ASCII and Latin letters, which the vocabulary's normal form changes to lower case and
#: nothing else. Left out are controls and the one letter whose lower case is two characters.
_LATIN = re.compile("[\t-\r\x20-\x7e\u00a1-\u012f\u0131-\u017f]*")
#: The vocabulary's own pattern for such texts.
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+", re.ASCII)


def _byte_characters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if it can be seen,
    else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(others)) for b in range(256)]


class Words:
    """Ids of texts, as bytes, from those of their parts.

    Latin texts are cut by the vocabulary's pattern, whose parts are merged one by one. Others
    are cut at blanks, and the words encoded as texts of their own. Texts with the string of
    a special token are left to the library as a whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self.byte_characters = _byte_characters()
        self.parts = Remembered(self._merged, PART_BYTES)
        self.words = Remembered(self._encoded, PART_BYTES // 4)

    def _merged(self, part: str) -> bytes:
        written = "".join(map(self.byte_characters.__getitem__, part.encode()))
        return np.array([t.id for t in self.model.tokenize(written)], self.dtype).tobytes()

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        if "<" in text and any(s in text for s in self.special):
            return self._encoded(text)
        if _LATIN.fullmatch(text):
            return b"".join(map(self.parts.__getitem__, _PARTS.findall(text.lower())))
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


def id_type(vocabulary: int) -> str:
    """The narrowest unsigned type for ids below ``vocabulary``."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(path)


forgets(__name__, words_of.cache_clear)


def _writer(folder: str, path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, name, files = words_of(path), uuid.uuid4().hex, None
        end = np.array([end_id], words.dtype).tobytes()
        task, docs, nulls, total = None, 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if files is None:
                system, root = shared_file_system(folder)
                files = [system.open_output_stream(f"{root}/{name}.{x}") for x in ("ids", "off", "doc")]
                files[1].write(np.zeros(1, "<u8").tobytes())
            task = batch.column("_task")[0].as_py()
            sizes, ids = [], []
            for text in batch.column("_text"):
                written = words.encode(text.as_py()) + end
                files[0].write(written)
                sizes.append(len(written) // len(end))
            ids = batch.column("doc_id")
            offsets = np.cumsum(sizes, dtype="<u8") + np.uint64(total)
            files[1].write(offsets.tobytes())
            files[2].write(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            docs, nulls, total = docs + len(ids), nulls + ids.null_count, int(offsets[-1])
        if files is None:
            return
        for file in files:
            file.close()
        yield pa.RecordBatch.from_pydict(
            {"task": [task], "name": [name], "docs": [docs], "nulls": [nulls], "ids": [total]},
            pa.schema([("task", pa.int32()), ("name", pa.string())] + [(c, pa.int64()) for c in ("docs", "nulls", "ids")]),
        )

    return run


def write_token_files(
    documents: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID
) -> dict:
    """Encode whole texts and write them in ascending doc_id order; returns the manifest.

    The texts are cut into ranges of (doc_id, hash) and encoded where they are written. The
    driver gets one row per part.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    system, root = shared_file_system(folder)
    system.create_dir(root, recursive=True)
    text = F.coalesce("text", F.lit(""))
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash").asc()]
    ranged = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text"), F.xxhash64(text).alias("_hash"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "_text", F.spark_partition_id().alias("_task"))
    )
    schema = "task int, name string, docs bigint, nulls bigint, ids bigint"
    parts = sorted(map(tuple, map_partitions(ranged, _writer(folder, path, end_id), schema).collect()))
    manifest = {"type": id_type(Tokenizer.from_file(path).get_vocab_size()), "end_id": end_id, "parts": []}
    first_doc = first_id = 0
    for _, name, docs, nulls, ids in parts:
        manifest["parts"].append(
            {"name": name, "docs": docs, "nulls": nulls, "ids": ids, "first_doc": first_doc, "first_id": first_id}
        )
        first_doc, first_id = first_doc + docs, first_id + ids
    with system.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


class TokenPart:
    """One part: arrays mapped from local files, or read from files elsewhere."""

    def __init__(self, folder: str, part: dict, dtype: str):
        self.part, self.dtype = part, np.dtype(dtype)
        self.system, root = shared_file_system(folder)
        self.stem = f"{root}/{part['name']}"
        self.local = self.system.type_name == "local"
        self.offsets = self._array("off", np.dtype("<u8"))
        self.doc_ids = self._array("doc", np.dtype("<i8"))
        self.ids = self._array("ids", self.dtype) if self.local else self.system.open_input_file(f"{self.stem}.ids")

    def _array(self, kind: str, dtype: np.dtype) -> np.ndarray:
        if self.local:
            return np.memmap(f"{self.stem}.{kind}", dtype, "r")
        with self.system.open_input_file(f"{self.stem}.{kind}") as file:
            return np.frombuffer(file.read(), dtype)

    def document(self, number: int) -> np.ndarray:
        """Ids of one document of the part, its end id included."""
        start, stop = int(self.offsets[number]), int(self.offsets[number + 1])
        if self.local:
            return self.ids[start:stop]
        width = self.dtype.itemsize
        return np.frombuffer(self.ids.read_at((stop - start) * width, start * width), self.dtype)

    def doc_id(self, number: int) -> int | None:
        return None if number < self.part["nulls"] else int(self.doc_ids[number])


def read_manifest(folder: str) -> dict:
    system, root = shared_file_system(folder)
    with system.open_input_file(f"{root}/manifest.json") as file:
        return json.loads(file.read())


def _reader(folder: str, manifest: dict):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                part = manifest["parts"][number]
                held = TokenPart(folder, part, manifest["type"])
                for at in range(0, part["docs"], _READ):
                    rows = []
                    for k in range(at, min(at + _READ, part["docs"])):
                        ids = held.document(k)
                        start = part["first_id"] + int(held.offsets[k])
                        rows.append((held.doc_id(k), start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema
                    )

    return run


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, ids before it, ids of it, their crc32."""
    manifest = read_manifest(folder)
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    count = len(manifest["parts"])
    numbers = spark.range(0, count, 1, max(count, 1)) if count else spark.range(0)
    return map_partitions(numbers, _reader(folder, manifest), schema)


def token_file_digests(documents: DataFrame) -> DataFrame:
    """Writes all documents to a new shared folder and reads them back."""
    folder = new_shared_folder(documents.sparkSession, "tokens")
    write_token_files(documents, folder)
    return read_token_files(documents.sparkSession, folder)
