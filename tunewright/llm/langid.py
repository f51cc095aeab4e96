"""Language identification by n-gram filters that answer for all languages at once.

Learning counts the character n-grams of each language over all its documents. A language keeps an
n-gram that has at least the share ``FLOOR`` of its n-grams, and at least ``CLOSE`` of the share that
the n-gram has in the language where it is most common. At most 1 / ``FLOOR`` n-grams can have such a
share, so a language's filter has a proven bound whatever the corpus.

The languages' Bloom filters are laid side by side: each slot holds one bit per language. An n-gram is
hashed to ``HASHES`` slots, and the AND of the slots is the set of all languages that contain it.
For a text, the set bits are counted per language. By chance a filter with false-positive rate f
answers yes to f of the n-grams that it does not hold, so a count c of n becomes (c - f n) / (1 - f).
The language with the largest corrected share is predicted; the share is the score.

Defined results: a null text, or one without any letter, is ``und`` with score 0, as is every
text if nothing was learned; equal shares go to the language with more learned n-grams, then to the
name that sorts first; a text whose n-grams are in no filter goes to the most common language with
score 0. Repeated rows count as often as they stand there. Columns of the input that are called like
an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.llm import words as W
from tunewright.llm.columns import plain, restored
from tunewright.llm.registry import query
from tunewright.session import store

SIZE = 4
FLOOR = 1e-5
CLOSE = 0.2
SLOTS = 1 << 20
HASHES = 4
_WIDE = 1 << 21

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    if not _LETTERS:
        flags = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        _LETTERS.append(flags)
    return _LETTERS[0]


def grams(column: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, and where each text's begin (with the end of the last).

    Texts are lower-cased, every run of other characters than letters becomes one space, and one
    stands at either end; texts shorter than an n-gram are filled up with spaces.
    """
    parts = [(t or "").lower() for t in column.to_pylist()]
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = np.fromiter(map(len, parts), np.int64, len(parts))
    letter = _letters()[codes]
    # a space before and ``size`` - 1 spaces after each text keep texts apart
    owner = np.repeat(np.arange(len(n)), n)
    flat = np.full(len(codes) + len(n) * 2, 32, np.uint32)
    place = np.arange(len(codes)) + 2 * owner + 1
    flat[place] = np.where(letter, codes, 32)
    begin = np.cumsum(n + 2) - (n + 2)
    space = flat == 32
    keep = np.ones(len(flat), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[begin] = True
    kept = np.add.reduceat(keep, begin) if len(begin) else np.zeros(0, np.int64)
    flat = flat[keep].astype(np.uint64)
    some = kept > 1
    count = np.where(some, np.maximum(kept - size + 1, 1), 0)
    start = np.cumsum(kept) - kept
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
    flat = np.concatenate([flat, np.full(size, 32, np.uint64)])
    stop = np.repeat(start + kept, count)
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        c = flat[at + k]
        c = np.where(at + k < stop, c, np.uint64(32))
        h = h * np.uint64(0x9E3779B97F4A7C15) + c + np.uint64(1)
    return W.mix(h), np.concatenate([[0], np.cumsum(count)])


class Filters:
    """Bloom filters of several languages; slot i holds a bit for each language."""

    def __init__(self, kept: dict[str, np.ndarray], totals: dict[str, int]):
        # in the order of ties
        self.languages = sorted(totals, key=lambda x: (-totals[x], x))
        # the smallest number that has a bit for each, or rows of such
        n = len(self.languages)
        self.width = next((w for w in (8, 16, 32) if n <= w), 64)
        kind = np.dtype(f"uint{self.width}").type
        self.slots = np.zeros((SLOTS, max(1, -(-n // self.width))), kind)
        for i, name in enumerate(self.languages):
            bit = kind(1 << i % self.width)
            for s in self._places(kept.get(name, np.zeros(0, np.uint64))):
                self.slots[s, i // self.width] |= bit
        full = [self._bit(self.slots, i).mean() for i in range(len(self.languages))]
        self.false = np.array(full, float) ** HASHES

    @staticmethod
    def _places(h: np.ndarray) -> Iterator[np.ndarray]:
        step = W.mix(h) | np.uint64(1)
        for k in range(HASHES):
            yield ((h + np.uint64(k) * step) >> np.uint64(44)).astype(np.int64) & (SLOTS - 1)

    def _bit(self, masks: np.ndarray, i: int) -> np.ndarray:
        return (masks[:, i // self.width] >> masks.dtype.type(i % self.width)) & masks.dtype.type(1)

    def masks(self, h: np.ndarray) -> np.ndarray:
        """All languages that contain each n-gram."""
        out = np.full((len(h), self.slots.shape[1]), ~self.slots.dtype.type(0))
        for s in self._places(h):
            out &= self.slots[s]
        return out

    def shares(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Corrected share of each text's n-grams per language."""
        masks = self.masks(h)
        n = np.diff(first).astype(float)
        out = np.zeros((len(n), len(self.languages)))
        for i, false in enumerate(self.false):
            total = np.concatenate([[0], np.cumsum(self._bit(masks, i), dtype=np.int64)])
            found = total[first[1:]] - total[first[:-1]]
            out[:, i] = (found - false * n) / np.maximum((1 - false) * n, 1e-9)
        return np.clip(out, 0, 1)


def _count(text: str, lang: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        waiting = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name, found in held.items():
                k, v = W.counted(
                    np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(k), pa.string()), pa.array(k.view(np.int64)), pa.array(v)],
                    names=["lang", "gram", "n"],
                )
            held.clear()

        for b in W.pieces(batches, _WIDE):
            names = b.column(lang).dictionary_encode()
            codes = names.indices.to_numpy(zero_copy_only=False)
            h, first = grams(b.column(text), size)
            of = np.repeat(codes, np.diff(first))
            for i, name in enumerate(names.dictionary.to_pylist()):
                k, v = W.counted(h[of == i])
                if len(k):
                    held.setdefault(name, []).append((k, v))
                    waiting += len(k)
            if waiting > 1 << 22:
                yield from flush()
                waiting = 0
        yield from flush()

    return run


def learn(df: DataFrame, text: str = "text", lang: str = "lang", size: int = SIZE) -> Filters:
    """Filters from all rows with a text and a language. No n-grams of a text reach the driver: only
    each language's kept ones, at most 1 / ``FLOOR``.
    """
    known = df.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, lang)
    rows = known.mapInArrow(_count(text, lang, size), "lang string, gram bigint, n bigint")
    counts = store(rows.groupBy("gram", "lang").agg(F.sum("n").alias("n")), "gram-counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return Filters({}, {})
    total = F.create_map(*[x for k, v in totals.items() for x in (F.lit(k), F.lit(float(v)))])
    share = counts.withColumn("share", F.col("n") / total[F.col("lang")])
    top = share.groupBy("gram").agg(
        F.max("share").alias("top"), F.collect_list(F.struct("lang", "share")).alias("each")
    )
    kept = top.select("gram", "top", F.inline("each")).filter(
        (F.col("share") >= FLOOR) & (F.col("share") >= CLOSE * F.col("top"))
    )
    got = kept.select("lang", "gram").toArrow()
    names = np.array(got["lang"].to_pylist(), object)
    h = got["gram"].to_numpy().view(np.uint64)
    return Filters({k: h[names == k] for k in totals}, totals)


def _answer(shared, text: str, carried: list[str], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: Filters = shared.value
        names = np.array([*filters.languages, "und"], object)
        for b in W.pieces(batches, _WIDE):
            h, first = grams(b.column(text), size)
            shares = filters.shares(h, first)
            if shares.shape[1]:
                best = shares.argmax(axis=1)
                score = shares[np.arange(len(best)), best]
            else:
                best, score = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            none = np.diff(first) == 0
            best[none], score[none] = len(names) - 1, 0.0
            yield pa.RecordBatch.from_arrays(
                [
                    *[b.column(c) for c in carried],
                    pa.array(names[best].tolist(), pa.string()),
                    pa.array(score),
                    pa.array(np.diff(first)),
                ],
                names=[*carried, "lang_pred", "score", "n_grams"],
            )

    return run


def predict(
    df: DataFrame, filters: Filters, text: str = "text", size: int = SIZE, keep: list[str] | None = None
) -> DataFrame:
    """Add lang_pred, score (0 to 1) and n_grams to the columns ``keep`` (all)."""
    df = df.drop("lang_pred", "score", "n_grams")
    keep = [c for c in (keep or df.columns) if c in df.columns]
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*[f"`{c}` {kind[c]}" for c in keep], "lang_pred string, score double, n_grams bigint"])
    shared = df.sparkSession.sparkContext.broadcast(filters)
    used = list(dict.fromkeys([*keep, text]))
    return df.select(used).mapInArrow(_answer(shared, text, keep, size), schema)


def accepted(least: float = 0.2, enough: int = 20) -> Column:
    """Is a predicted row in a learned language? Rejected are texts without letters, and those whose
    score is below ``least`` although they have ``enough`` n-grams to tell.
    """
    return (F.col("lang_pred") != "und") & ((F.col("score") >= least) | (F.col("n_grams") < enough))


def known(df: DataFrame, filters: Filters, text: str = "text", **limits) -> DataFrame:
    """The rows of ``df`` in a learned language (see ``accepted``); their columns may have any names."""
    df, names = plain(df)
    return restored(predict(df, filters, names[text]).filter(accepted(**limits)), names)


def held_out(key: str = "doc_id") -> Column:
    """Every fourth document or so is never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


@query("op4_language_bitmask_filters")
def op4_language_bitmask_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    filters = learn(docs.filter(~held_out()))
    out = predict(docs, filters, keep=["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_grams")
