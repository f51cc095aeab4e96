"""Periodic runs in the words of texts, by string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are alike) that has at least 4 q and at
least 6 words, and that no neighbouring word extends. All runs of a text are found:

*Periods below* ``BASE`` come from comparing each word with the one q places on.

*Larger periods* are handled at scales t = 8, 16, 32 ...; scale t finds the periods from t to 2 t - 1. A
position belongs to the synchronising set S if the least hash of the t + 1 stretches of t words that begin
at it or after is that of the first or of the last. Whether it does depends on the 2 t words that follow,
so equal contexts are selected alike, and any t positions in a row hold one of S unless they are highly
periodic: stretches of t words with a period of t / 4 or less are left out of the minimum, else S would
be dense there. What is left out has been found before, as a run of a smaller scale, which supplies its
period. Within a run of period q, a position of S and the next one with an equal context are q apart, as
a smaller distance would be a smaller period. So neighbours with equal contexts propose periods;
proposals that overlap by a period are one, and each is extended word by word to its full length.

S has about 2 n / t of n positions, so a scale costs passes over the hashes and a sort of the selected
ones. A batch of texts is one sequence, longest text first, each after a mark of its own: the texts long
enough for a scale are a prefix of the arrays. Stretches are named by mixing the names of their halves.
Words are compared by 64-bit hashes; the words of every run are compared once more by their bytes, and a
batch where that fails is done again with numbers for words.

Defined results: null and empty texts have no words, no runs, and an empty collapsed text; repeated
rows get equal results; several runs may overlap; a word is dropped if any run holds it after that
run's first period. A text is held whole in one task, whatever its length. Columns of the input that are
called like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.llm import words as W
from tunewright.llm.registry import query

BASE = 8
LEAST = 6
TIMES = 4
_WIDE = 1 << 21
_BLOCK = 64
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
RUNS = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edge = np.flatnonzero(np.diff(same.astype(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def _names(half: np.ndarray, size: int) -> np.ndarray:
    """Names of the stretches of twice ``size``; those beyond the end get names of their own."""
    n = len(half)
    out = W.mix(np.arange(n, dtype=np.uint64) + np.uint64((1 << 62) + size))
    if n > size:
        out[:-size] = W.mix(half[:-size] * np.uint64(0x9E3779B97F4A7C15) + W.mix(half[size:] + np.uint64(1)))
    return out


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """Least of each value and the ``size`` after it; size is a power of two."""
    step, out = 1, x
    while step < size:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    return np.minimum(out[:-1], out[1:])


def _reach(seq: np.ndarray, at: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """How many places from ``at`` on, in steps of 1 or -1, hold the word that is a period apart
    (before the place for steps of 1, after it for -1). The marks at both ends stop it.
    """
    out = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    ahead = np.arange(_BLOCK) * step
    while len(live):
        i = np.clip((at[live] + out[live] * step)[:, None] + ahead, 0, len(seq) - 1)
        unlike = seq[i] != seq[np.clip(i - step * period[live][:, None], 0, len(seq) - 1)]
        unlike |= (i == 0) | (i == len(seq) - 1)
        stop = unlike.any(axis=1)
        out[live] += np.where(stop, unlike.argmax(axis=1), _BLOCK)
        live = live[~stop]
    return out


def _proposals(names: np.ndarray, twice: np.ndarray, t: int, skip: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Begin, end and period of the stretches that equal contexts of the synchronising set propose."""
    phi = names if skip is None else np.where(skip, _NONE, names)
    low = _least(phi, t)
    n = len(low)
    chosen = np.flatnonzero(((low == phi[:n]) | (low == phi[t : t + n])) & (low != _NONE))
    context = twice[chosen]
    order = np.argsort(context, kind="stable")
    a = chosen[order]
    apart = np.diff(a)
    near = (context[order][1:] == context[order][:-1]) & (apart >= t) & (apart < 2 * t)
    begin, q = a[:-1][near], apart[near]
    order = np.lexsort((begin, q))
    begin, q = begin[order], q[order]
    if not len(q):
        return begin, begin, q
    new = np.flatnonzero(np.concatenate([[True], (np.diff(q) > 0) | (np.diff(begin) > 2 * t)]))
    last = np.append(new[1:], len(q)) - 1
    return begin[new], begin[last] + q[new] + 2 * t, q[new]


def find(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of all runs, by text, start and period.

    ``codes``: 64-bit numbers, equal for equal words; those of text i begin at ``first[i]``.
    """
    n = np.diff(first)
    long = np.argsort(-n, kind="stable")
    n = n[long]
    begin = np.cumsum(n + 1) - n
    total = int((n + 1).sum()) + 1
    seq = W.mix(np.arange(total, dtype=np.uint64) + np.uint64(1 << 61))
    place = np.arange(n.sum()) + np.repeat(np.arange(len(n)), n) + 1
    source = np.arange(n.sum()) + np.repeat(first[:-1][long] - (np.cumsum(n) - n), n)
    seq[place] = codes[source]

    begins, ends, periods = [], [], []
    for q in range(1, BASE):
        s, e = _stretches(seq[q:] == seq[:-q])
        enough = e - s + q >= max(LEAST, TIMES * q)
        begins.append(s[enough])
        ends.append(e[enough] + q)
        periods.append(np.full(int(enough.sum()), q))
    names, size = seq, 1
    while True:
        while size < BASE:
            names, size = _names(names, size), 2 * size
        texts = int(np.searchsorted(-n, -TIMES * size, "right"))
        if not texts:
            break
        # the last position is the mark after the last of these texts
        seq = seq[: begin[texts - 1] + n[texts - 1] + 1]
        names = names[: len(seq)]
        twice = _names(names, size)
        s, e, q = (np.concatenate(x) for x in (begins, ends, periods))
        dense = (q <= size // TIMES) & (e - s >= size) & (e <= len(seq))
        skip = None
        if dense.any():
            cover = np.zeros(len(seq) + 1, np.int64)
            np.add.at(cover, s[dense], 1)
            np.add.at(cover, e[dense] - size + 1, -1)
            skip = np.cumsum(cover[:-1]) > 0
        if len(seq) > 2 * size:
            s, e, q = _proposals(names, twice, size, skip)
            s = s - _reach(seq, s - 1, q, -1)
            e = e + _reach(seq, e, q, 1)
            enough = e - s >= TIMES * q
            begins.append(s[enough])
            ends.append(e[enough])
            periods.append(q[enough])
        names, size = twice, 2 * size
    s, e, q = (np.concatenate(x).astype(np.int64) for x in (begins, ends, periods))
    # a stretch that a smaller period explains has come with that period too
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    own = np.ones(len(s), bool)
    own[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, q = s[own], e[own], q[own]
    of = np.searchsorted(begin, s, "right") - 1
    order = np.lexsort((q, s, long[of]))
    return tuple(x[order] for x in (long[of], s - begin[of], e - s, q))


def _alike(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> bool:
    """Are the words a and b the same bytes?"""
    size = ends[a] - starts[a]
    if not np.array_equal(size, ends[b] - starts[b]):
        return False
    for i in range(0, len(a), 1 << 17):
        n = size[i : i + (1 << 17)]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        left, right = (np.repeat(starts[x[i : i + (1 << 17)]], n) + at for x in (a, b))
        if not np.array_equal(data[left], data[right]):
            return False
    return True


def _members(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    n = np.maximum(stop - start, 0)
    return np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)


def runs_of(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of the words, checked byte by byte."""
    found = find(W.hashes(data, starts, ends), first)
    text, start, length, period = found
    at = first[text] + start
    a = _members(at, at + length - period)
    if _alike(data, starts, ends, a, a + np.repeat(period, length - period)):
        return found
    numbers: dict[bytes, int] = {}
    raw = data.tobytes()
    codes = [numbers.setdefault(raw[i:j], len(numbers)) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
    return find(W.mix(np.array(codes, np.uint64)), first)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text with a space between."""
    before = np.concatenate([[0], np.cumsum(kept)])[first]
    starts, ends = starts[kept], ends[kept]
    n = ends - starts
    # each word is followed by a space; that of a text's last word is left out
    out = np.full(int((n + 1).sum()), 32, np.uint8)
    place = np.cumsum(n + 1) - (n + 1)
    for i in range(0, len(n), 1 << 17):
        part = slice(i, i + (1 << 17))
        at = np.arange(n[part].sum()) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
        out[np.repeat(place[part], n[part]) + at] = data[np.repeat(starts[part], n[part]) + at]
    stops = np.concatenate([[0], np.cumsum(n + 1)])[before]
    raw = out.tobytes()
    return pa.array(
        [raw[i : max(i, j - 1)] for i, j in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)], pa.binary()
    ).cast(pa.string())


def _scan(text: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.pieces(batches, _WIDE):
            data, offsets = W.texts(b.column(text))
            starts, ends, first = W.spans(data, offsets)
            of, start, length, period = runs_of(data, starts, ends, first)
            at = first[of] + start
            drop = np.zeros(len(starts) + 1, np.int64)
            np.add.at(drop, at + period, 1)
            np.add.at(drop, at + length, -1)
            kept = np.cumsum(drop[:-1]) == 0
            each = pa.StructArray.from_arrays(
                [pa.array(x) for x in (start, length, period)], names=["start", "length", "period"]
            )
            bounds = np.searchsorted(of, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *[b.column(c) for c in keep],
                    pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(pa.array(bounds), each),
                    _joined(data, starts, ends, first, kept),
                ],
                names=[*keep, "n_words", "runs", "collapsed"],
            )

    return run


def detect(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add n_words, runs (start, length and period in words, by start, then period) and collapsed (the
    words left when each run shrinks to its first period, joined by one space) to the columns ``keep`` (all).
    """
    keep = [c for c in (keep or df.columns) if c in df.columns and c not in ("n_words", "runs", "collapsed")]
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*[f"`{c}` {kind[c]}" for c in keep], RUNS])
    return df.select(list(dict.fromkeys([*keep, text]))).mapInArrow(_scan(text, keep), schema)


def looped(text: str, h: Column) -> Column:
    """The text with its words from a = g % n on repeated with period 1 + (n - a) div (3 + g % 8), if
    h % 10 is 0 and it has words; g is h div 10. Other texts are left as they are.
    """
    g = F.floor(h / 10)
    split = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("int")
        order = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(order, lambda i: F.get(w, i)), " ")

    # one array of the words, used several times
    some = F.transform(F.array(split), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))
    return F.when(h % 10 == 0, F.get(some, F.lit(0))).otherwise(F.col(text))


@query("op12_synchronising_runs")
def op12_synchronising_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    h = F.crc32(F.col("doc_id").cast("string"))
    found = detect(docs.select("doc_id", looped("text", h).alias("text")), keep=["doc_id"])
    # the greatest exact length / period is that of no other run times the other's period; smallest start, then period
    better = lambda x, y: (
        F.when(x["length"] * y["period"] > y["length"] * x["period"], -1)
        .when(x["length"] * y["period"] < y["length"] * x["period"], 1)
        .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
        .when(x["period"] != y["period"], F.when(x["period"] < y["period"], -1).otherwise(1))
        .otherwise(0)
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = found.withColumn("top", F.get(F.array_sort("runs", better), F.lit(0)))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda s: F.concat(s, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
