"""Language-model scores of whole documents, learnt from those not held out.

Tokens are words between ASCII white space, lower-cased in ASCII, and one end per text.

1. Words are counted over all training documents, per task first, then by shuffle.
2. The commonest words, ``HOT`` at most, go to every task. The rest of a document's words
   meet their counts in a join, so the vocabulary may be of any size.
3. Documents are encoded once: the ``CLASSES * WIDTH`` commonest words have ids of their
   own, the others share the id of their last byte. Within such a class a word's share is
   that of its count, (c + 1) / (N + V + 1) over the class.
4. A gated recurrent model (see ``recurrent``) learns the ids in ``ROUNDS`` rounds. In each,
   every task goes on from the common weights over a slice of its texts, and the weights
   are averaged by the number of tokens. All training texts are used, once.
5. Every text is scored from its first token to its last.

Defined cases: a null or empty text is its end token alone; a null doc_id counts as
training; a last byte that is rare has the class of all rare ones; without any training
document, counts are zero and scores come from the weights the model starts with; repeated
rows each give a row.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haplospark.llm.common import forgets, map_batches, map_partitions
from haplospark.llm.recurrent import WIDTH, Model, Trainer, score_texts
from haplospark.scratch import materialize

#: Most words whose counts are sent to every task.
HOT = 300_000
CLASSES = 8
ENDINGS = 23
ROUNDS = 4
#: Most models that are averaged at once.
FAN_IN = 32
END = b"\n"
_COUNTED = 250_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_LOWER).split()


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 7; null: no."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def told(counts: Counter) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update(words_of(text.as_py() or b""))
            if len(counts) >= _COUNTED:
                yield told(counts)
                counts = Counter()
        counts[END] += batch.num_rows
    if counts:
        yield told(counts)


def count_words(documents: DataFrame) -> DataFrame:
    """``word`` and ``n`` over the documents that are not held out."""
    training = documents.where(~held_out(F.col("doc_id"))).select(F.col("text").cast("binary"))
    counted = map_partitions(training, _counter, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """What tasks know of the words: counts and ids of the commonest, classes of the rest."""

    words: list[bytes]
    counts: np.ndarray
    ids: np.ndarray
    endings: np.ndarray  # last byte -> id
    rest: np.ndarray  # per ending class: log10(N + V + 1)
    totals: np.ndarray  # per id: tokens
    end: int
    tokens: int
    distinct: int

    def prepare(self) -> Lexicon:
        self.number = {w: k for k, w in enumerate(self.words)}
        self.known = np.log10(self.counts + 1.0)
        return self

    @property
    def of_own(self) -> int:
        return CLASSES * WIDTH


def _hot_words(counts: DataFrame, most: int) -> tuple[list[tuple[str, int]], Column]:
    """The words of the highest counts, as many whole bands of counts as fit, and the end
    token; and a condition for all others. The words with ids of their own are always among
    the first, also where a band that does not fit has them."""
    band = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    sizes = sorted(map(tuple, counts.groupBy(band.alias("b")).count().collect()), reverse=True)
    least, total = 1 << 20, 0
    for at, size in sizes:
        if total + size > most:
            break
        least, total = at, total + size
    others = (band < least) & (F.col("word") != END.decode())
    if total <= CLASSES * WIDTH:
        beyond = counts.where(others).orderBy(F.col("n").desc(), "word").limit(CLASSES * WIDTH)
        others &= ~F.col("word").isin([r["word"] for r in beyond.select("word").collect()])
    hot = counts.where(~others).select("word", "n").collect()
    return sorted(((r[0], r[1]) for r in hot), key=lambda r: (-r[1], r[0])), others


def make_lexicon(counts: DataFrame, most_hot: int = HOT) -> tuple[Lexicon, DataFrame]:
    """The lexicon, and the counts of all words that are not in it."""
    tokens, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    hot, others = _hot_words(counts, most_hot)
    last = F.expr("substring(cast(word as binary), -1, 1)")
    by_ending = {
        bytes(r[0])[0]: [r[1], r[2]]
        for r in counts.groupBy(last.alias("e")).agg(F.sum("n"), F.count(F.lit(1))).collect()
    }
    words, numbers = [w.encode() for w, _ in hot], np.array([n for _, n in hot], np.int64)
    own = CLASSES * WIDTH
    chosen = [k for k, w in enumerate(words) if w != END][: own - 1]
    ids = np.full(len(words), -1, np.int64)
    totals = np.zeros(own + ENDINGS + 1, np.float64)
    ids[chosen] = np.arange(1, len(chosen) + 1)
    for k, w in enumerate(words):
        if w == END:
            ids[k], totals[0] = 0, numbers[k]
            by_ending.pop(END[0], None)
        elif ids[k] > 0:
            totals[ids[k]] = numbers[k]
            left = by_ending[w[-1]]
            left[0], left[1] = left[0] - int(numbers[k]), left[1] - 1
    common = sorted(by_ending, key=lambda e: (-by_ending[e][0], e))[:ENDINGS]
    endings = np.full(256, own + ENDINGS, np.int64)
    endings[common] = own + np.arange(len(common))
    rest = np.zeros((ENDINGS + 1, 2))
    for ending, left in by_ending.items():
        rest[endings[ending] - own] += left
    totals[own:] = rest[:, 0]
    for k in np.flatnonzero(ids < 0):
        ids[k] = endings[words[k][-1]]
    lexicon = Lexicon(
        words, numbers, ids, endings, np.log10(rest.sum(1) + 1), totals, 0, int(tokens or 0), int(distinct)
    )
    return lexicon, counts.where(others)


_LEXICONS: dict[str, Lexicon] = {}
forgets(__name__, _LEXICONS.clear)


def _lexicon(name: str, sent) -> Lexicon:
    """The broadcast lexicon, prepared once per worker."""
    if name not in _LEXICONS:
        _LEXICONS.clear()
        _LEXICONS[name] = sent.value.prepare()
    return _LEXICONS[name]


_ENCODED = (
    "n_tokens bigint, n_known bigint, known double, shared double, ids binary, "
    "others array<struct<word: string, n: bigint>>"
)


def _encoder(name: str, sent):
    pair = pa.struct([("word", pa.string()), ("n", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lexicon = _lexicon(name, sent)
        find = lexicon.number.get
        end = find(END)
        rows = []
        for text in batch.column(batch.num_columns - 1):
            words = words_of(text.as_py() or b"")
            at = np.array([find(w, -1) for w in words], np.int64)
            missing = np.flatnonzero(at < 0)
            ids = lexicon.ids[at] if len(lexicon.words) else np.zeros(len(at), np.int64)
            others = [words[k] for k in missing.tolist()]
            ids[missing] = [lexicon.endings[w[-1]] for w in others]
            seen = at[at >= 0]
            known = float(lexicon.known[seen].sum()) if len(seen) else 0.0
            alone = ids >= lexicon.of_own
            shared = -float(lexicon.rest[ids[alone] - lexicon.of_own].sum())
            hot = at[alone & (at >= 0)]
            shared += float(lexicon.known[hot].sum()) if len(hot) else 0.0
            if end is not None:
                known += float(lexicon.known[end])
            rows.append(
                (
                    len(words) + 1,
                    len(seen) + (end is not None),
                    known,
                    shared,
                    np.append(ids, lexicon.end).astype("<u2").tobytes(),
                    [(w.decode(), n) for w, n in Counter(others).items()],
                )
            )
        columns = list(zip(*rows, strict=True)) or [()] * 6
        types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pair)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
            [*batch.schema.names[:-1], "n_tokens", "n_known", "known", "shared", "ids", "others"],
        )

    return run


def _decoded(batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    return [np.frombuffer(ids.as_py(), "<u2") for ids in batch.column(column)]


def _model(vector: np.ndarray) -> Model:
    return Model(CLASSES, ENDINGS + 1, vector)


def _learner(vector: np.ndarray, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(_model(vector.copy()), end)
        for batch in batches:
            for ids in _decoded(batch, 0):
                trainer.add(ids)
        trainer.flush()
        if trainer.tokens:
            weights = trainer.model.vector.astype("<f4").tobytes()
            yield pa.RecordBatch.from_pydict({"weights": [weights], "tokens": [trainer.tokens]})

    return run


def _weighted(rows: Iterator[tuple[bytes, int]]) -> tuple[np.ndarray | None, int]:
    total, tokens = None, 0
    for weights, n in rows:
        part = np.frombuffer(weights, "<f4").astype(np.float64) * n
        total, tokens = part if total is None else total + part, tokens + n
    return (None if total is None else total / tokens), tokens


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((w.as_py(), n.as_py()) for b in batches for w, n in zip(*b.columns, strict=True))
    mean, tokens = _weighted(rows)
    if mean is not None:
        yield pa.RecordBatch.from_pydict({"weights": [mean.astype("<f4").tobytes()], "tokens": [tokens]})


def train(encoded: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> np.ndarray:
    """Weights learnt from the ``ids`` of all rows that are not held out.

    Models are averaged in groups until few are left; only those reach the driver.
    """
    vector = Model.start(lexicon.totals, CLASSES).vector
    schema = "weights binary, tokens bigint"
    for k in range(rounds):
        texts = encoded.where(~F.col("held_out") & (F.pmod(F.xxhash64("_row"), F.lit(rounds)) == k))
        learnt = map_partitions(texts.select("ids"), _learner(vector, lexicon.end), schema)
        tasks = texts.rdd.getNumPartitions()
        while tasks > FAN_IN:
            tasks = -(-tasks // FAN_IN)
            learnt = map_partitions(learnt.repartition(tasks), _averaged, schema)
        mean, _ = _weighted((bytes(r[0]), r[1]) for r in learnt.collect())
        if mean is not None:
            vector = mean.astype(np.float32)
    return vector


def _scorer(vector: np.ndarray, end: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = score_texts(_model(vector), _decoded(batch, batch.num_columns - 1), end)
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(found / math.log(10))], [*batch.schema.names[:-1], "modelled"]
        )

    return run


def score_documents(documents: DataFrame, most_hot: int = HOT) -> DataFrame:
    """Per document: whether it is held out, its tokens, the base score and the model's."""
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = materialize(count_words(documents), "counts")
    lexicon, rest = make_lexicon(counts, most_hot)
    sent, name = spark.sparkContext.broadcast(lexicon), uuid.uuid4().hex
    rows = documents.select(
        F.monotonically_increasing_id().alias("_row"),
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("binary").alias("_bytes"),
    )
    schema = f"_row bigint, doc_id bigint, held_out boolean, {_ENCODED}"
    encoded = materialize(map_batches(rows, _encoder(name, sent), schema), "encoded")
    vector = train(encoded, lexicon)
    found = (
        encoded.select("_row", F.explode("others").alias("_other"))
        .select("_row", "_other.*")
        .join(rest.select("word", F.col("n").alias("_count")), "word")
        .groupBy("_row")
        .agg(
            F.sum("n").alias("_found"),
            F.sum(F.col("n") * F.log10(F.col("_count") + 1.0)).alias("_logs"),
        )
    )
    keep = ["_row", "doc_id", "held_out", "n_tokens", "n_known", "known", "shared"]
    scored = map_batches(
        encoded.select(*keep, "ids"),
        _scorer(vector, lexicon.end),
        "_row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
        "known double, shared double, modelled double",
    )
    logs = F.coalesce("_logs", F.lit(0.0))
    every = math.log10(lexicon.tokens + lexicon.distinct + 1)
    return scored.join(found, "_row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_found", F.lit(0))).alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("known") + logs - F.col("n_tokens") * every).alias("base_score"),
        (F.col("modelled") + F.col("shared") + logs).alias("score"),
    )
