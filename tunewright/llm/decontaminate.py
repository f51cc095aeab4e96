"""Benchmark passages in documents: a set join of word windows with a prefix filter.

A benchmark item is cut into windows of ``size`` consecutive words (an item with fewer words is one
window). A document contains a window only if it contains every word of it, so one word must be
looked for: the rarest one in the corpus (its prefix for containment 1). The join runs from these
prefix words to positions in documents; positional and length bounds drop starts outside the
document, a hash of the window's words drops most other candidates, and the rest is compared word
for word.

The windows are the stated query set: they go to the tasks in blocks of at most ``BLOCK_WORDS``
benchmark words, and every document is compared with every block. No document is shuffled, and the
memory of a task is bounded by a block and a batch of texts.

Defined results: null and empty texts have no words and no hits; items without words have no
windows; null item ids are left out of ``items``; repeated items or item ids count once; repeated
documents are judged each by itself. Columns of the input that are called like an output column are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.llm import words as W
from tunewright.llm.columns import plain, restored
from tunewright.llm.registry import query
from tunewright.session import store

#: Bytes that are no part of a word once A-Z is lower-cased: [\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F].
BETWEEN = np.zeros(256, bool)
BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

BLOCK_WORDS = 1_000_000
_CHUNK = 1000
_TIMES = W.mix(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)


def _words(text: str) -> list[bytes]:
    data, offsets = W.texts(pa.array([text], pa.string()))
    data = W.LOWER[data]
    starts, ends, _ = W.spans(data, offsets, BETWEEN)
    return [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]


def _cut(size: int):
    """Items as runs of at most ``_CHUNK`` windows; ``size`` - 1 words are shared by two runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = _words(text or "")
                last = max(1, len(w) - size + 1)
                runs = [w[i : i + _CHUNK + size - 1] for i in range(0, last, _CHUNK)] if w else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(runs), pa.string()),
                        pa.array([b" ".join(r).decode() for r in runs], pa.string()),
                        pa.array([len(r) for r in runs], pa.int64()),
                    ],
                    names=["item", "run", "n"],
                )

    return run


class Index:
    """The windows of one block of the benchmark."""

    def __init__(self, items: Sequence[str | None], runs: Sequence[str], size: int):
        self.windows: dict[bytes, set[str]] = {}
        for item, r in zip(items, runs, strict=True):
            w = r.encode().split(b" ")
            for i in range(max(1, len(w) - size + 1)):
                found = self.windows.setdefault(b" ".join(w[i : i + size]), set())
                if item is not None:
                    found.add(item)
        self.texts = sorted(self.windows)
        self.items = [sorted(self.windows[t]) for t in self.texts]
        del self.windows
        data, offsets = W.texts(pa.array(self.texts, pa.binary()).cast(pa.string()))
        starts, ends, first = W.spans(data, offsets, BETWEEN)
        h = W.hashes(data, starts, ends)
        self.vocabulary = np.unique(h)
        self.lengths = np.diff(first)
        self.hash = _window_hash(h, first[:-1], self.lengths)
        self._h, self._first = h, first

    def set_counts(self, counts: np.ndarray) -> None:
        """Choose each window's rarest word, given the corpus count of each vocabulary word."""
        n = counts[np.searchsorted(self.vocabulary, self._h)]
        at = np.repeat(np.arange(len(self.lengths)), self.lengths)
        place = np.arange(len(at)) - self._first[at]
        order = np.lexsort((place, self._h, n, at))
        best = order[self._first[:-1]] if len(at) else order
        tokens = self._h[best] if len(at) else np.zeros(0, np.uint64)
        probes = np.unique(
            np.array(
                list(zip(tokens.tolist(), place[best].tolist(), self.lengths.tolist(), strict=True)),
                dtype=[("t", "u8"), ("off", "i8"), ("n", "i8")],
            )
        )
        self.tokens, self.probe_first = np.unique(probes["t"], return_index=True)
        self.probe_count = np.diff(np.append(self.probe_first, len(probes)))
        self.probe_off, self.probe_len = probes["off"].copy(), probes["n"].copy()
        self.by_hash = np.argsort(self.hash, kind="stable")
        self.sorted_hash = self.hash[self.by_hash]
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.tokens >> np.uint64(48)).astype(np.int64)] = True
        del self._h, self._first, self.vocabulary

    def find(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Word positions where windows begin, and the windows' numbers."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(starts) or not len(self.tokens):
            return none
        h = W.hashes(data, starts, ends)
        at = np.flatnonzero(self.seen[(h >> np.uint64(48)).astype(np.int64)])
        t = np.minimum(np.searchsorted(self.tokens, h[at]), len(self.tokens) - 1)
        ok = self.tokens[t] == h[at]
        at, t = at[ok], t[ok]
        if not len(at):
            return none
        n = self.probe_count[t]
        total = np.cumsum(n)
        where, which = [], []
        i = 0
        while i < len(at):
            # at most about a million candidates at a time
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + 1_000_000)))
            reps = n[i:j]
            p = np.repeat(at[i:j], reps)
            k = np.arange(len(p)) - np.repeat(np.cumsum(reps) - reps, reps)
            k += np.repeat(self.probe_first[t[i:j]], reps)
            i = j
            length, begin = self.probe_len[k], p - self.probe_off[k]
            doc = np.searchsorted(first, p, "right") - 1
            fits = (begin >= first[doc]) & (begin + length <= first[doc + 1])
            begin, length = begin[fits], length[fits]
            key = _window_hash(h, begin, length)
            w = np.minimum(np.searchsorted(self.sorted_hash, key), len(self.sorted_hash) - 1)
            same = self.sorted_hash[w] == key
            for b, m, x in zip(
                begin[same].tolist(), length[same].tolist(), self.by_hash[w[same]].tolist(), strict=True
            ):
                own = [data[s:e].tobytes() for s, e in zip(starts[b : b + m], ends[b : b + m], strict=True)]
                if b" ".join(own) == self.texts[x]:
                    where.append(b)
                    which.append(x)
        return np.array(where, np.int64), np.array(which, np.int64)


def _window_hash(h: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    out = np.zeros(len(begin), np.uint64)
    for m in np.unique(length):
        at = np.flatnonzero(length == m)
        total = np.full(len(at), W.mix(np.array([m], np.uint64))[0])
        for j in range(int(m)):
            total += h[begin[at] + j] * _TIMES[j % len(_TIMES)]
        out[at] = W.mix(total)
    return out


def _corpus_counts(docs: DataFrame, text: str, vocabulary: np.ndarray) -> np.ndarray:
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        seen = np.zeros(1 << 16, bool)
        seen[(vocab >> np.uint64(48)).astype(np.int64)] = True
        total = np.zeros(len(vocab), np.int64)
        for b in W.pieces(batches):
            data, offsets = W.texts(b.column(0))
            data = W.LOWER[data]
            starts, ends, _ = W.spans(data, offsets, BETWEEN)
            h = W.hashes(data, starts, ends)
            h = h[seen[(h >> np.uint64(48)).astype(np.int64)]]
            if len(h) and len(vocab):
                at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
                total += np.bincount(at[vocab[at] == h], minlength=len(vocab))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["w", "n"])

    rows = docs.select(text).mapInArrow(run, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n"))
    out = np.zeros(len(vocabulary), np.int64)
    got = rows.toArrow()  # a row for each word of the block at most
    out[got["w"].to_numpy()] = got["n"].to_numpy()
    shared.unpersist()
    return out


def _union(spans: np.ndarray) -> list[list[int]]:
    """Overlapping or touching [start, end) spans joined."""
    out: list[list[int]] = []
    for a, b in spans[np.argsort(spans[:, 0], kind="stable")].tolist():
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _match(shared, text: str, carried: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for b in W.pieces(batches):
            data, offsets = W.texts(b.column(text))
            data = W.LOWER[data]
            starts, ends, first = W.spans(data, offsets, BETWEEN)
            where, which = index.find(data, starts, ends, first)
            hits, items = b.column("hits").to_pylist(), b.column("items").to_pylist()
            order = np.argsort(where, kind="stable")
            where, which = where[order], which[order]
            cuts = np.searchsorted(where, first)
            for d in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[d], cuts[d + 1])
                begin = where[part] - first[d]
                new = np.stack([begin, begin + index.lengths[which[part]]], axis=1)
                old = np.array([[h["start"], h["end"]] for h in hits[d]], np.int64).reshape(-1, 2)
                hits[d] = [{"start": x, "end": y} for x, y in _union(np.concatenate([old, new]))]
                found = {i for x in set(which[part].tolist()) for i in index.items[x]}
                items[d] = sorted(found.union(items[d]))
            yield pa.RecordBatch.from_arrays(
                [
                    *[b.column(c) for c in carried],
                    pa.array(np.diff(first)),
                    pa.array(hits, _HITS),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=[*carried, "n_words", "hits", "items"],
            )

    return run


_HITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ADDED = "n_words bigint, hits array<struct<start:bigint,end:bigint>>, items array<string>"


def annotate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = 10,
    keep: Sequence[str] | None = None,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Add n_words, hits (spans of word numbers, joined) and items to the columns ``keep`` (all)."""
    spark = docs.sparkSession
    docs = docs.drop("n_words", "hits", "items")
    keep = [c for c in (keep or docs.columns) if c in docs.columns]
    runs = store(
        benchmark.select(F.col(item).cast("string"), item_text).mapInArrow(
            _cut(size), "item string, run string, n bigint"
        ),
        "benchmark-runs",
    )
    total = runs.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("item", "run"), F.lit(blocks))
    out = docs.withColumns(
        {
            "n_words": F.lit(0).cast("bigint"),
            "hits": F.array().cast("array<struct<start:bigint,end:bigint>>"),
            "items": F.array().cast("array<string>"),
        }
    )
    for k in range(blocks):
        part = runs.filter(block == k).toArrow()  # a block of the benchmark, bounded
        index = Index(part["item"].to_pylist(), part["run"].to_pylist(), size)
        index.set_counts(_corpus_counts(docs, text, index.vocabulary))
        last = k == blocks - 1
        carried = keep if last else list(dict.fromkeys([*keep, text]))
        fields = {f.name: f.dataType.simpleString() for f in out.schema.fields}
        schema = ", ".join([*[f"`{c}` {fields[c]}" for c in carried], _ADDED])
        wanted = list(dict.fromkeys([*carried, text, "n_words", "hits", "items"]))
        out = out.select(*wanted).mapInArrow(
            _match(spark.sparkContext.broadcast(index), text, carried), schema
        )
        if not last:
            out = store(out, "decontaminate")
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without any benchmark window; their columns may have any names."""
    docs, names = plain(docs)
    return restored(annotate(docs, benchmark, names[text], **options).filter(F.size("hits") == 0), names)


_SQL = r"""
    WITH item_words AS (
        SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
    windows AS (
        SELECT item_id, least(10, len(w)) AS n, unnest(list_transform(
            range(greatest(1, len(w) - 9)), lambda i: array_to_string(w[i + 1:i + 10], ' '))) AS win
        FROM item_words WHERE len(w) > 0),
    doc_words AS (
        SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+'), []::VARCHAR[]) AS w
        FROM documents),
    spots AS (
        SELECT doc_id, n, unnest(range(len(w) - n + 1)) AS "at",
            unnest(list_transform(range(len(w) - n + 1),
                lambda i: array_to_string(w[i + 1:i + n], ' '))) AS win
        FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
    found AS (SELECT s.doc_id, s."at", s.n, x.item_id FROM spots s JOIN windows x USING (n, win)),
    hit AS (
        SELECT doc_id, count(*) AS n_hit FROM (
            SELECT DISTINCT doc_id, unnest(range("at", "at" + n)) FROM (
                SELECT DISTINCT doc_id, "at", n FROM found)) GROUP BY doc_id),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ','
            ORDER BY item_id::VARCHAR) AS names
        FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
    SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit,
        coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op5_prefix_filter_decontamination", _SQL)
def op5_prefix_filter_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = annotate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda a, h: a + h["end"] - h["start"])
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
