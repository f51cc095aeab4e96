"""Interpolated modified Kneser-Ney scores of documents, from word bigrams counted over the corpus.

Counting runs in Spark as exchanges of packed counts. A task turns its texts into sorted distinct
keys with counts (differences, compressed), cut by ranges of the key, and the task that holds a range
adds them up. First the words: a range holds a run of 64-bit word hashes. A word's number is its
place in the order of all hashes. Then the bigrams ``first << 32 | second``: their ranges are cut
by the running total of word counts, so each holds about as many bigrams, and a word that is a
third of the corpus spreads over a third of the ranges. Last, the number of distinct words before
each word.

The model is a folder of sorted arrays, a few for each range, below the shared folder (which must be
a path that all machines mount). Workers map the arrays into memory: only the pages that a batch of
texts looks up are read, and all workers of a machine share them. Nothing of the model passes
through the driver but a few numbers per range.

For a word w after v:  p(w|v) = max(c(v,w) - D, 0) / c(v) + g(v) p1(w), with
g(v) = (D1 N1(v) + D2 N2(v) + D3 N3+(v)) / c(v), D by the count 1, 2, 3 or more, and p1 the same over
the numbers of distinct words before w, interpolated with 1 / (V + 1), so that an unknown word has a
probability too. After a word that training has not seen, p1 is used alone. The first word of
a text follows a start mark; every text closes with an end token that is counted and scored.

Defined results: null and empty texts have one token, the end; an empty training set gives every
token the probability 1 (V = 0); repeated rows count as often as they stand there; a null id counts
as training. Columns of the input that are called like an output column are replaced.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.llm import words as W
from tunewright.llm.registry import query
from tunewright.session import scratch_path, store

#: Hashes of the end token; no word of the texts has it but by chance (one in 2^64).
END = np.uint64(0x5BD1E9955BD1E995)
_FLUSH = 2_000_000
_LOW = np.uint64(0xFFFFFFFF)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that every worker can open as a file path."""
    path = scratch_path(spark, "kneser-ney")
    scheme, colon, rest = path.partition(":")
    if not colon:
        # without a scheme, the path belongs to the cluster's default file system
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        scheme, rest = default.partition(":")[0], path
    if scheme != "file":
        raise RuntimeError("workers map the model: spark.checkpoint.dir must be a mounted path")
    path = "/" + rest.lstrip("/")
    os.makedirs(path, exist_ok=True)
    return path


def _save(folder: str, name: str, values: np.ndarray) -> None:
    """Written under another name first: a repeated task replaces the file as a whole."""
    import uuid

    part = f"{folder}/.{name}-{uuid.uuid4().hex}.npy"
    np.save(part, values)
    os.replace(part, f"{folder}/{name}.npy")


def _load(folder: str, name: str) -> np.ndarray:
    path = f"{folder}/{name}.npy"
    a = np.load(path, mmap_mode="r")
    return a if a.size else np.array(a)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each closed by the end token, and where each text begins."""
    data, offsets = W.texts(column)
    data = W.LOWER[data]
    starts, ends, first = W.spans(data, offsets)
    h = np.insert(W.hashes(data, starts, ends), first[1:], END)
    return h, first + np.arange(len(first))


@dataclass
class Vocabulary:
    """Words in ranges of their hashes; the numbers of a range's words follow those before it."""

    folder: str
    ranges: int
    sizes: list[int]
    counts: list[int]
    _open: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def size(self) -> int:
        return sum(self.sizes)

    @property
    def total(self) -> int:
        return sum(self.counts)

    def array(self, name: str) -> np.ndarray:
        if name not in self._open:
            self._open[name] = _load(self.folder, name)
        return self._open[name]

    def __getstate__(self):
        return {**self.__dict__, "_open": {}}

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and counts of sorted hashes; unknown words have the number ``size`` + 1."""
        number = np.full(len(h), self.size + 1, np.int64)
        count = np.zeros(len(h), np.int64)
        base = np.cumsum([0, *self.sizes])
        for r, part in _by_range(_range_of(h, self.ranges), self.ranges):
            known = self.array(f"word-{r}")
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, h[part]), len(known) - 1)
            ok = known[at] == h[part]
            number[part] = np.where(ok, at + base[r], self.size + 1)
            count[part] = np.where(ok, self.array(f"count-{r}")[at], 0)
        return number, count

    def before(self, number: np.ndarray) -> np.ndarray:
        """How many tokens have a smaller word number (of sorted numbers)."""
        out = np.zeros(len(number), np.int64)
        base, total = np.cumsum([0, *self.sizes]), np.cumsum([0, *self.counts])
        where = np.searchsorted(base[1:], number, "right")
        for r, part in _by_range(where, self.ranges):
            out[part] = self.array(f"before-{r}")[number[part] - base[r]] + total[r]
        return out


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _by_range(of: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """The runs of an ascending array of range numbers."""
    cut = np.searchsorted(of, np.arange(ranges + 1))
    for r in np.flatnonzero(np.diff(cut)).tolist():
        yield r, slice(cut[r], cut[r + 1])


def _runs(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an ascending array and how often each stands there."""
    return W.counted(ascending) if len(ascending) else (ascending, np.zeros(0, np.int64))


_PACKED = "range int, keys binary, counts binary"


def _rows(of: np.ndarray, keys: np.ndarray, counts: np.ndarray, ranges: int) -> pa.RecordBatch:
    packed = [(r, *W.pack(keys[s], counts[s])) for r, s in _by_range(of, ranges)]
    columns = list(zip(*packed, strict=True)) or [(), (), ()]
    kinds = (pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["range", "keys", "counts"]
    )


def _collect(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of a few million words at a time."""
    held, at, waiting = [], [np.zeros(1, np.int64)], 0
    for b in W.pieces(batches, 4 << 20):
        h, first = tokens(b.column(text))
        held.append(h)
        at.append(first[1:] + waiting)
        waiting += len(h)
        if waiting >= _FLUSH:
            yield np.concatenate(held), np.concatenate(at)
            held, at, waiting = [], [np.zeros(1, np.int64)], 0
    if waiting:
        yield np.concatenate(held), np.concatenate(at)


def _reduce(rows: DataFrame, schema: str, finish) -> list:
    """Add up the counts of each range in one task; ``finish`` writes its arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for b in batches:
            for r, k, c in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                parts.setdefault(r, []).append((k, c))
        for r in sorted(parts):
            yield finish(r, *W.merged(parts.pop(r)))

    return rows.repartition("range").mapInArrow(run, schema)


def count_words(df: DataFrame, text: str, ranges: int, folder: str) -> Vocabulary:
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, _ in _collect(batches, text):
            keys, counts = W.counted(h)
            yield _rows(_range_of(keys, ranges), keys, counts, ranges)

    def finish(r: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        _save(folder, f"word-{r}", keys)
        _save(folder, f"count-{r}", counts)
        _save(folder, f"before-{r}", np.cumsum(counts) - counts)
        return pa.RecordBatch.from_pydict(
            {"range": pa.array([r], pa.int32()), "n": [len(keys)], "total": [int(counts.sum())]}
        )

    rows = df.select(text).mapInArrow(local, _PACKED)
    done = _reduce(rows, "range int, n bigint, total bigint", finish).collect()  # a row per range
    sizes, totals = [0] * ranges, [0] * ranges
    for d in done:
        sizes[d["range"]], totals[d["range"]] = d["n"], d["total"]
    for r in range(ranges):
        if not sizes[r]:
            for name in ("word", "count", "before"):
                _save(folder, f"{name}-{r}", np.zeros(0, np.uint64 if name == "word" else np.int64))
    return Vocabulary(folder, ranges, sizes, totals)


def _numbered(h: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes' numbers and counts, and which of them each token is."""
    unique, _ = W.counted(h)
    number, count = vocabulary.find(unique)
    return number, count, np.searchsorted(unique, h)


def _pairs(first: np.ndarray, which: np.ndarray, number: np.ndarray, start: int) -> tuple:
    """Number of the word before each token (``start`` for a text's first), and the token's own."""
    second = number[which]
    before = np.empty(len(second), np.int64)
    before[1:] = second[:-1]
    before[first[:-1]] = start
    return before, second


def discounts(n: np.ndarray) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of n-grams with counts 1 to 4 (Chen and Goodman, 1998).

    Where a count of counts is missing the plain discount 0.5 (1, 1.5) stands in.
    """
    n1, n2, n3, n4 = (float(x) for x in n)
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(x, 0.0), k + 1.0) for k, x in enumerate(d))


def _spread(counts: np.ndarray) -> list[int]:
    """How many of the counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


@dataclass
class Model:
    """What workers need to map the arrays; small but for the ranges' numbers."""

    vocabulary: Vocabulary
    documents: int
    cuts: list[int]  # first bigram key of each range that has any, and its range
    cut_ranges: list[int]
    split: dict[int, tuple[int, int, int]]  # N1, N2, N3+ of words in several ranges
    pair_discount: tuple[float, float, float]
    word_discount: tuple[float, float, float]
    kinds: int  # distinct bigrams
    spare: float  # weight of the uniform distribution

    def score(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Tokens, known tokens, unigram score and model score of each text."""
        v = self.vocabulary
        size, total = v.size, v.total
        number, count, which = _numbered(h, v)
        base = np.log10((count + 0.1) / (total + 0.1 * (size + 1)))
        order = np.argsort(number, kind="stable")
        one = np.empty(len(number))
        one[order] = self._word(number[order])
        before, second = _pairs(first, which, number, size)
        keys, times = W.counted((before.astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64))
        p = self._pair(keys, number, count, one)
        own = (before.astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        logs = np.log10(p)[np.searchsorted(keys, own)]
        cut = first[:-1]
        known = (count > 0)[which]
        return (
            np.diff(first),
            np.add.reduceat(known.astype(np.int64), cut),
            np.add.reduceat(base[which], cut),
            np.add.reduceat(logs, cut),
        )

    def _word(self, number: np.ndarray) -> np.ndarray:
        """p1 of ascending word numbers."""
        v = self.vocabulary
        if not self.kinds:
            return np.full(len(number), 1.0 / (v.size + 1))
        n = np.zeros(len(number), np.int64)
        base = np.cumsum([0, *v.sizes])
        where = np.searchsorted(base[1:], number, "right")
        for r, part in _by_range(where, v.ranges):
            n[part] = v.array(f"kinds-{r}")[number[part] - base[r]]
        d = np.array([0.0, *self.word_discount])[np.minimum(n, 3)]
        return (n - d) / self.kinds + self.spare / (v.size + 1)

    def _pair(self, keys, number, count, one) -> np.ndarray:
        """p(w|v) of ascending bigram keys; the other arrays are by the batch's distinct words."""
        v = self.vocabulary
        first, second = (keys >> np.uint64(32)).astype(np.int64), (keys & _LOW).astype(np.int64)
        order = np.argsort(number, kind="stable")
        names = number[order]
        p1 = one[order][np.searchsorted(names, second)]
        times = np.zeros(len(keys), np.int64)
        cuts = np.array(self.cuts, np.uint64)
        for i, part in _by_range(np.searchsorted(cuts, keys, "right") - 1, len(cuts)):
            known = v.array(f"pair-{self.cut_ranges[i]}")
            j = np.minimum(np.searchsorted(known, keys[part]), len(known) - 1)
            found = v.array(f"times-{self.cut_ranges[i]}")[j]
            times[part] = np.where(known[j] == keys[part], found, 0)
        # what is known of each distinct first word: from the range that holds its last bigram
        context, size = _runs(first)
        at = np.minimum(np.searchsorted(names, context), len(names) - 1)
        total = np.where(names[at] == context, count[order][at], 0)
        total[context == v.size] = self.documents
        back = np.zeros((len(context), 3), np.int64)
        last = (context.astype(np.uint64) << np.uint64(32)) | _LOW
        for i, part in _by_range(np.searchsorted(cuts, last, "right") - 1, len(cuts)):
            known = v.array(f"context-{self.cut_ranges[i]}")
            j = np.minimum(np.searchsorted(known, context[part]), len(known) - 1)
            found = v.array(f"back-{self.cut_ranges[i]}")[j]
            back[part] = np.where((known[j] == context[part])[:, None], found, 0)
        for word, n in self.split.items():
            back[context == word] = n
        total, back = np.repeat(total, size), np.repeat(back, size, axis=0)
        safe = np.maximum(total, 1)
        d = np.array([0.0, *self.pair_discount])[np.minimum(times, 3)]
        gamma = back @ np.array(self.pair_discount) / safe
        return np.where(total > 0, (times - d) / safe + gamma * p1, p1)


_KINDS = pa.list_(pa.struct([("range", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))


def train(df: DataFrame, text: str = "text", ranges: int | None = None) -> Model:
    """Count all rows' bigrams and write the model's arrays to the shared folder.

    ``ranges`` (the number of shuffle partitions if not given) should keep a range, a few tens of
    megabytes of counts, within a task's memory.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = shared_folder(spark)
    documents = df.count()
    vocabulary = count_words(df, text, ranges, folder)
    size, total = vocabulary.size, vocabulary.total
    if size >= 1 << 32:
        raise ValueError("more than 2^32 distinct words")
    if not documents:
        return Model(vocabulary, 0, [], [], {}, (0.0,) * 3, (0.0,) * 3, 0, 1.0)

    # the start mark follows all words in the order of keys
    everything = total + documents

    def pair_ranges(keys: np.ndarray) -> np.ndarray:
        first, second = (keys >> np.uint64(32)).astype(np.int64), (keys & _LOW).astype(np.int64)
        names, runs = _runs(first)
        words = names[names < size]
        before = np.full(len(names), total, np.int64)
        count = np.full(len(names), documents, np.int64)
        before[: len(words)] = vocabulary.before(words)
        base = np.cumsum([0, *vocabulary.sizes])
        where = np.searchsorted(base[1:], words, "right")
        for r, part in _by_range(where, ranges):
            count[part] = vocabulary.array(f"count-{r}")[words[part] - base[r]]
        place = np.repeat(before, runs) + np.repeat(count, runs) * (second / size)
        return np.minimum((place * (ranges / everything)).astype(np.int64), ranges - 1)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, first in _collect(batches, text):
            number, _, which = _numbered(h, vocabulary)
            before, second = _pairs(first, which, number, size)
            keys = (before.astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
            keys, counts = W.counted(keys)
            yield _rows(pair_ranges(keys), keys, counts, ranges)

    def finish(r: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        first, second = (keys >> np.uint64(32)).astype(np.int64), keys & _LOW
        edge = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        back = np.stack(
            [np.add.reduceat((np.minimum(counts, 3) == k).astype(np.int64), edge) for k in (1, 2, 3)],
            axis=1,
        )
        _save(folder, f"pair-{r}", keys)
        _save(folder, f"times-{r}", counts.astype(np.uint32) if counts.max() < 1 << 32 else counts)
        _save(folder, f"context-{r}", first[edge])
        _save(folder, f"back-{r}", back.astype(np.uint32))  # at most 2^32 words follow a word
        w, n = W.counted(second)
        packed = _rows(_word_range(w.astype(np.int64), vocabulary), w, n, ranges)
        ends = [[int(first[edge[i]]), *back[i].tolist()] for i in (0, -1)]
        kinds = [
            {"range": a, "keys": b, "counts": c}
            for a, b, c in zip(*(packed.column(i).to_pylist() for i in range(3)), strict=True)
        ]
        row = {
            "range": pa.array([r], pa.int32()),
            "n": [len(keys)],
            "low": pa.array([int(keys[0])], pa.uint64()).view(pa.int64()),
            "spread": [_spread(counts)],
            "ends": [ends[0] + ends[1]],
            "kinds": pa.array([kinds], _KINDS),
        }
        return pa.RecordBatch.from_pydict(row)

    schema = (
        "range int, n bigint, low bigint, spread array<bigint>, ends array<bigint>, "
        "kinds array<struct<range:int,keys:binary,counts:binary>>"
    )
    rows = df.select(text).mapInArrow(local, _PACKED)
    made = store(_reduce(rows, schema, finish), "bigram-ranges")
    done = made.drop("kinds").collect()  # a row per range

    def finish_kinds(r: int, words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        base = sum(vocabulary.sizes[:r])
        dense = np.zeros(vocabulary.sizes[r], np.int64)
        dense[words.astype(np.int64) - base] = counts
        _save(folder, f"kinds-{r}", dense)
        return pa.RecordBatch.from_pydict({"range": pa.array([r], pa.int32()), "spread": [_spread(counts)],
                                           "many": [int((counts >= 3).sum())]})

    each = _reduce(
        made.select(F.inline("kinds")), "range int, spread array<bigint>, many bigint", finish_kinds
    ).collect()
    pair_n = np.sum([d["spread"] for d in done], axis=0)
    word_n = np.sum([d["spread"] for d in each], axis=0)
    kinds = sum(d["n"] for d in done)
    word_d = discounts(word_n)
    held = word_d[0] * word_n[0] + word_d[1] * word_n[1] + word_d[2] * sum(d["many"] for d in each)
    done.sort(key=lambda d: np.int64(d["low"]).view(np.uint64))
    parts: dict[int, list] = {}
    for d in done:
        e = d["ends"]
        parts.setdefault(e[0], []).append(e[1:4])
        if e[4] != e[0]:
            parts.setdefault(e[4], []).append(e[5:8])
    split = {w: tuple(np.sum(p, axis=0).tolist()) for w, p in parts.items() if len(p) > 1}
    return Model(
        vocabulary, documents, [int(np.int64(d["low"]).view(np.uint64)) for d in done],
        [d["range"] for d in done], split, discounts(pair_n), word_d, kinds, held / kinds,
    )


def _word_range(number: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    return np.searchsorted(np.cumsum(vocabulary.sizes), number, "right")


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add n_tokens, n_known, train_tokens, base_score, score and perplexity to ``keep`` (all)."""
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    df = df.drop(*names, "perplexity")
    keep = [c for c in (keep or df.columns) if c in df.columns]
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    added = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    schema = ", ".join([*[f"`{c}` {kind[c]}" for c in keep], added])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for b in W.pieces(batches, 8 << 20):
            n, known, base, logs = m.score(*tokens(b.column(text)))
            total = np.full(len(n), m.vocabulary.total, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], *map(pa.array, (n, known, total, base, logs))],
                names=[*keep, *names],
            )

    used = list(dict.fromkeys([*keep, text]))
    out = df.select(used).mapInArrow(run, schema)
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 10 == 0, F.lit(False))


@query("op3_kneser_ney_score")
def op3_kneser_ney_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.filter(~held_out()))
    out = score(docs, model, keep=["doc_id"])
    return out.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
        "score", "perplexity",
    )
