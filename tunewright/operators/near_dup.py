"""Near-duplicate removal with the result of the sequential greedy rule.

The rule visits rows in the seeded order and keeps a row iff its cosine to every row kept so far is
below the threshold. The same rows come out of distributed steps:

1. copies of one vector shrink to the first of them;
2. prefixes of the order are decided one after another, each about twice as long as all before it, and
   whatever is too close to a row they keep is dropped from the rest. The first prefix is a matrix on the
   driver; longer ones are decided by executors: pairs within the prefix, rounds over them, and a join of
   the rest with the rows kept. The order is random with respect to the data, so a prefix as long as all
   before it has few pairs left inside (Blelloch, Fineman & Shun 2012): none of its steps is quadratic.
   A rest of a few times the first prefix is decided on the driver too;
3. before each prefix a pass counts the pairs of a bounded sample of the rows that are left. Once they
   say that the pairs left are linear in the rows, the rest is one last prefix.

The counts only choose when to stop doubling; the rows kept do not depend on them. Every step starts from
a table in the shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunewright.functions.vectors import to_matrix
from tunewright.operators.rank import HASH, first_by_hash, order_hash
from tunewright.operators.similarity_join import (
    BLOCK,
    DECIMALS,
    collapse_copies,
    cosines,
    edges,
    struck,
    unit_vectors,
)
from tunewright.session import cut_lineage, store

FIRST = 4096  # rows of the first prefix, decided on the driver
SMALL = 4  # a rest of so many times that goes there whole
PROBES = 512  # rows whose pairs are counted
LINEAR = 16  # pairs per row, on average, from which the rest is decided in one step
_DIGITS = 15


def greedy_batch(x: np.ndarray, threshold: float) -> np.ndarray:
    """Sequential rule on one matrix of unit rows; a mask of the rows kept."""
    kept = np.zeros(len(x), dtype=bool)
    dead = np.zeros(len(x), dtype=bool)
    sims = cosines(x, x)
    for i in range(len(x)):
        if not dead[i]:
            kept[i] = True
            dead |= sims[i] >= threshold
    return kept


def greedy_rows(x: np.ndarray, threshold: float, batch: int = 4096) -> np.ndarray:
    """The same for more rows than have a matrix of cosines; a batch at a time."""
    out, kept = [], x[:0]
    for i in range(0, len(x), batch):
        part = x[i : i + batch]
        free = np.ones(len(part), dtype=bool)
        for k in range(0, len(kept), batch):
            free &= cosines(part, kept[k : k + batch]).max(axis=1) < threshold
        mask = np.zeros(len(part), dtype=bool)
        mask[np.flatnonzero(free)[greedy_batch(part[free], threshold)]] = True
        kept = np.vstack([kept, part[mask]])
        out.append(mask)
    return np.concatenate(out)


def farther(x: np.ndarray, kept: np.ndarray, small: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows have no cosine to ``kept`` that reaches the threshold; ``small`` is ``kept`` in single precision.

    Single precision decides what its error leaves beyond doubt, double precision the rest.
    """
    slack = (x.shape[1] + 8) * 2.0**-23 + 10.0**-DECIMALS
    top = (x.astype(np.float32) @ small.T).max(axis=1)
    far = top < threshold - slack
    doubt = np.flatnonzero(~far & ~(top > threshold + slack))
    if len(doubt):
        far[doubt] = cosines(x[doubt], kept).max(axis=1) < threshold
    return far


def _apart(kept: np.ndarray, threshold: float):
    small = kept.astype(np.float32)

    @F.arrow_udf("boolean")
    def apart(v: pa.Array) -> pa.Array:
        if not len(v):
            return pa.array([], pa.bool_())
        x = to_matrix(v)
        # a strip at a time: the rows of a batch have many cosines
        far = [farther(x[i : i + 512], kept, small, threshold) for i in range(0, len(x), 512)]
        return pa.array(np.concatenate(far))

    return apart(F.col("_v"))


def drop_by_rounds(pairs: DataFrame) -> DataFrame:
    """Rows (hashes) that the greedy rule drops, given all pairs ``a < b`` that are too close."""
    live = cut_lineage(pairs.select("a", "b"))
    dropped = None
    while not live.isEmpty():
        later = live.select(F.col("b").alias("a")).distinct()
        heads = live.select("a").distinct().join(later, "a", "left_anti")
        out = live.join(heads, "a", "left_semi").select(F.col("b").alias(HASH)).distinct()
        out = cut_lineage(out)
        dropped = out if dropped is None else dropped.unionByName(out)
        live = cut_lineage(
            live.join(out, live.a == out[HASH], "left_anti").join(
                out, F.col("b") == out[HASH], "left_anti"
            )
        )
    return live.select(F.col("a").alias(HASH)) if dropped is None else dropped


def _degree(probes: np.ndarray, threshold: float) -> Column:
    """How many of the probes are near each row."""

    @F.arrow_udf("bigint")
    def degree(v: pa.Array) -> pa.Array:
        if not len(v):
            return pa.array([], pa.int64())
        x = to_matrix(v)
        near = [(cosines(x[i : i + 512], probes) >= threshold).sum(axis=1) for i in range(0, len(x), 512)]
        return pa.array(np.concatenate(near))

    return degree(F.col("_v"))


def pairs_per_row(rows: DataFrame, total: int, threshold: float, probes: int = PROBES) -> float:
    """Estimate of the pairs of ``rows`` over their number, from the first ``probes`` rows of the order."""
    some = first_by_hash(rows, probes, total)
    if some.num_rows < 2:
        return 0.0
    near = rows.agg(F.sum(_degree(to_matrix(some.column("_v")), threshold))).first()[0]
    # each probe is near itself, unless it is the zero vector
    return max(0.0, (near - some.num_rows) / some.num_rows / 2)


def _upto(last: str, share: float) -> str:
    """The hash below which about ``share`` of the hashes above ``last`` lie."""
    low = int(last[:_DIGITS], 16) + 1 if last else 0
    upto = low + int((16**_DIGITS - low) * min(1.0, share))
    return "g" if share >= 1 or upto >= 16**_DIGITS else f"{upto:0{_DIGITS}x}"


def near_dup(
    df: DataFrame,
    key: str | Sequence[str],
    vec: str,
    threshold: float = 0.95,
    seed: int = 42,
    first: int = FIRST,
    block: int = BLOCK,
    linear: float = LINEAR,
) -> DataFrame:
    """The rows of ``df`` that the sequential rule keeps (a cosine equal to the threshold drops)."""
    if threshold > 1:
        return df
    spark = df.sparkSession
    rows = unit_vectors(df, key, vec, seed)
    alive = store(collapse_copies(rows).drop("_n"), "near-dup")
    total = alive.count()

    parts, last, decided = [spark.createDataFrame([], f"{HASH} string")], "", 0
    while total:
        short = total <= SMALL * first
        if short or not decided:
            # on the driver: the first prefix, or all of a short rest
            batch = first_by_hash(alive, total if short else first, total, last)
            x, names = to_matrix(batch.column("_v")), batch.column(HASH)
            mask = greedy_rows(x, threshold)
            parts.append(spark.createDataFrame(pa.table({HASH: names.filter(pa.array(mask))})))
            last, decided = names[-1].as_py(), decided + batch.num_rows
            if batch.num_rows == total:
                break
            alive = store(alive.filter(F.col(HASH) > last).filter(_apart(x[mask], threshold)), "near-dup")
            total = alive.count()
            continue
        # on executors: a prefix twice as long as all before it, or all that is left
        share = 1.0 if pairs_per_row(alive, total, threshold) <= linear else 2.0 * decided / total
        cut = _upto(last, share)
        inner = alive if cut == "g" else store(alive.filter(F.col(HASH) < cut), "near-dup")
        n = total if cut == "g" else inner.count()
        dropped = drop_by_rounds(edges(inner, n, threshold, block))
        chosen = store(inner.join(dropped, HASH, "left_anti"), "near-dup")
        parts.append(chosen.select(HASH))
        if cut == "g":
            break
        rest = alive.filter(F.col(HASH) >= cut)
        gone = struck(rest, total, chosen, threshold, block)
        alive = store(rest.join(gone, HASH, "left_anti"), "near-dup")
        decided, last, total = decided + n, cut, alive.count()
    survivors = parts[0]
    for part in parts[1:]:
        survivors = survivors.unionByName(part)
    return df.withColumn(HASH, order_hash(key, seed)).join(survivors, HASH, "left_semi").drop(HASH)
