"""Quality classifier with supervised subword embeddings.

A text is the mean of the vectors of its features: words, pairs of neighbouring words, character n-grams
(across words, so that spacing and punctuation count), and one end. Features are hashed into ``BUCKETS``
vectors of ``DIM`` numbers. A pair is hashed by the difference of its words' hashes, so all doubled
words share a vector and repetition can be learned. The mean goes through a softmax over the labels.

*Training.* Spark picks the ``SAMPLE`` labelled rows whose hashed keys are least, turns their whole texts
into bags of buckets and stores those. One task learns from them by stochastic gradient descent in NumPy, in
a seeded order, with a falling rate; a step is divided by the sum of the squared weights of the bag, so that
it moves the mean as far for a long text as for a short one. The sample is the only bound, and a documented
parameter; a bag has one entry per bucket at most, however long the text.

*Scoring.* The output is linear in the mean, so the vectors are multiplied with the output rows once, and
scoring a text adds up one number per label and feature: every row, whole texts, in blocks of bounded size.
Buckets that no training text used have no vector and are left out of the mean.

Defined results: null and empty texts consist of the end alone; texts without a label of theirs, or with a
null key, teach nothing; a key that is labelled several times counts with its least label; repeated rows are
several examples; with no labelled row every score is 0.5, and with one label only it is 0 or 1. Columns of
the input that are called like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.llm import words as W
from tunewright.llm.registry import query
from tunewright.session import store

BITS = 18
BUCKETS = 1 << BITS
DIM = 16
SIZES = (3, 4)
#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 4096
EPOCHS = 4
RATE = 0.5
_WIDE = 1 << 21
_BLOCK = 1 << 20
_END = 0

#: Texts, where each one's features begin, their buckets, and which of them count.
Features = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _bucket(h: np.ndarray) -> np.ndarray:
    return (W.mix(h) >> np.uint64(64 - BITS)).astype(np.int32)


def features(column: pa.Array) -> Iterator[Features]:
    """All features of all texts, kind by kind and block by block."""
    rows = len(column)
    data, offsets = W.texts(column)
    yield np.arange(rows), np.arange(rows), np.full(rows, _END, np.int32), np.ones(rows, bool)
    starts, ends, first = W.spans(data, offsets)
    if len(starts):
        h = W.hashes(data, starts, ends)
        some = np.flatnonzero(np.diff(first))
        yield some, first[some], _bucket(h), np.ones(len(h), bool)
        inner = np.ones(len(h), bool)
        inner[first[some + 1] - 1] = False
        # the difference of neighbours: doubled words are one feature
        yield some, first[some], _bucket(np.append(h[1:] - h[:-1], np.uint64(0)) + np.uint64(0x51ED)), inner
    # code points: bytes that do not continue a character begin one
    lead = (data & 0xC0) != 0x80
    n = np.concatenate([[0], np.cumsum(lead)])[offsets]
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    for size in SIZES:
        for i in range(0, len(codes), _BLOCK):
            stop = min(i + _BLOCK, len(codes))
            window = codes[i : stop + size - 1].astype(np.uint64)
            window = np.append(window, np.zeros(stop - i + size - 1 - len(window), np.uint64))
            h = np.full(stop - i, size, np.uint64)
            for k in range(size):
                h = h * np.uint64(0x9E3779B97F4A7C15) + window[k : k + stop - i]
            # texts with a character in the block
            a, b = np.searchsorted(n, i, "right") - 1, np.searchsorted(n, stop, "left")
            some = np.arange(a, b)
            some = some[n[some + 1] > n[some]]
            live = np.ones(stop - i, bool)
            for k in range(1, size):
                last = n[some + 1] - k
                last = last[(last >= np.maximum(n[some], i)) & (last < stop)]
                live[last - i] = False
            yield some, np.maximum(n[some], i) - i, _bucket(h), live


@dataclass
class Model:
    """Vectors and output rows; ``labels`` in order, ``seen``: which buckets have a vector."""

    labels: list
    vectors: np.ndarray
    output: np.ndarray
    seen: np.ndarray

    def folded(self) -> np.ndarray:
        """What a feature adds to the output of each label."""
        return (self.vectors @ self.output.T).astype(np.float32)


class Scorer:
    """The folded model; all that workers need."""

    def __init__(self, model: Model):
        self.labels = model.labels
        self.table = np.ascontiguousarray(model.folded().T)
        self.seen = model.seen

    def probabilities(self, column: pa.Array) -> np.ndarray:
        """Softmax over the labels for each text."""
        total = np.zeros((len(self.labels), len(column)))
        count = np.zeros(len(column))
        for some, at, bucket, live in features(column):
            if not len(some):
                continue
            live = live & self.seen[bucket]
            count[some] += np.add.reduceat(live, at, dtype=np.int64)
            for i, row in enumerate(self.table):
                total[i, some] += np.add.reduceat(np.where(live, row[bucket], 0), at, dtype=np.float64)
        x = (total / np.maximum(count, 1)).T
        x = np.exp(x - x.max(axis=1, keepdims=True)) if len(self.labels) else x
        return x / x.sum(axis=1, keepdims=True)


def bags(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their shares of each text's features."""
    found = []
    for some, at, bucket, live in features(column):
        owner = np.repeat(some, np.diff(np.append(at, len(bucket))))
        found.append(W.counted(((owner << BITS) | bucket)[live]))
    k, v = W.counted(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
    cut = np.searchsorted(k, np.arange(len(column) + 1) << BITS)
    out = []
    for i, j in zip(cut[:-1], cut[1:], strict=True):
        out.append(((k[i:j] & (BUCKETS - 1)).astype(np.int32), (v[i:j] / v[i:j].sum()).astype(np.float32)))
    return out


def fit(examples: list[tuple[int, np.ndarray, np.ndarray]], classes: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, output rows and seen buckets from (class, buckets, shares) by stochastic gradient descent."""
    rng = np.random.default_rng(7)
    vectors = np.zeros((BUCKETS, DIM), np.float32)
    output = rng.normal(size=(classes, DIM)).astype(np.float32) / np.float32(np.sqrt(DIM))
    seen = np.zeros(BUCKETS, bool)
    seen[_END] = True
    for _, bucket, _ in examples:
        seen[bucket] = True
    steps, total = 0, max(1, epochs * len(examples))
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            label, bucket, share = examples[i]
            rate = np.float32(RATE * (1 - steps / total))
            steps += 1
            own = vectors[bucket]
            mean = share @ own
            x = output @ mean
            p = np.exp(x - x.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ output
            output -= rate * np.outer(p, mean)
            vectors[bucket] = own - np.outer(share * (rate / (share @ share)), back)
    return vectors, output, seen


def _bag(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.pieces(batches, _WIDE):
            found = bags(b.column(text))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("_order"),
                    b.column("_label"),
                    pa.array([k.tobytes() for k, _ in found], pa.binary()),
                    pa.array([v.tobytes() for _, v in found], pa.binary()),
                ],
                names=["_order", "_label", "buckets", "shares"],
            )

    return run


def _train(labels: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            rows += zip(*(c.to_pylist() for c in b.columns), strict=True)
        # the order of files is not that of another run
        rows.sort()
        number = {y: i for i, y in enumerate(labels)}
        examples = [
            (number[y], np.frombuffer(k, np.int32), np.frombuffer(v, np.float32)) for _, y, k, v in rows
        ]
        vectors, output, seen = fit(examples, len(labels))
        parts = [vectors.tobytes(), output.tobytes(), np.packbits(seen).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in parts], names=["vectors", "output", "seen"])

    return run


def learn(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Model:
    """A model from the texts of ``df`` and the ``label`` that ``labels`` gives their keys."""
    texts = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    known = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label")).dropna()
    known = known.groupBy("_key").agg(F.min("_label").alias("_label"))
    known = known.join(texts.select("_key").distinct(), "_key", "left_semi")
    known = known.withColumn("_order", F.xxhash64("_key"))
    picked = store(known.orderBy("_order", "_key").limit(sample), "labelled-sample")
    names = sorted(r[0] for r in picked.select("_label").distinct().collect())
    if not names:
        return Model([], np.zeros((BUCKETS, DIM), np.float32), np.zeros((0, DIM), np.float32), np.zeros(BUCKETS, bool))
    kind = picked.schema["_label"].dataType.simpleString()
    rows = texts.join(F.broadcast(picked), "_key").select("_order", "_label", "_text")
    schema = f"_order bigint, _label {kind}, buckets binary, shares binary"
    found = store(rows.mapInArrow(_bag("_text"), schema), "labelled-bags")
    if found.count() > sample:
        # keys that repeat
        found = found.orderBy("_order", "buckets", "shares").limit(sample)
    fitted = found.coalesce(1).mapInArrow(_train(names), "vectors binary, output binary, seen binary").first()
    return Model(
        names,
        np.frombuffer(fitted["vectors"], np.float32).reshape(BUCKETS, DIM),
        np.frombuffer(fitted["output"], np.float32).reshape(len(names), DIM),
        np.unpackbits(np.frombuffer(fitted["seen"], np.uint8)).astype(bool),
    )


def _score(shared, text: str, carried: list[str], which: int | None, default: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer: Scorer = shared.value
        for b in W.pieces(batches, _WIDE):
            if which is None:
                p = np.full(b.num_rows, default)
            else:
                p = scorer.probabilities(b.column(text))[:, which]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in carried], pa.array(p.astype(np.float64))], names=[*carried, "score"]
            )

    return run


def score(df: DataFrame, model: Model, positive=1, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add score, the probability of the label ``positive``, to the columns ``keep`` (all)."""
    keep = [c for c in (keep or df.columns) if c in df.columns and c != "score"]
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*[f"`{c}` {kind[c]}" for c in keep], "score double"])
    which = model.labels.index(positive) if positive in model.labels else None
    default = 0.0 if model.labels else 0.5
    shared = df.sparkSession.sparkContext.broadcast(Scorer(model))
    rows = df.select(list(dict.fromkeys([*keep, text])))
    return rows.mapInArrow(_score(shared, text, keep, which, default), schema)


def held_out(key: str = "doc_id") -> Column:
    """Every fifth document or so is never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


@query("op11_subword_quality")
def op11_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    model = learn(docs.filter(~held_out()), labels)
    out = score(docs, model, keep=["doc_id"])
    return out.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
