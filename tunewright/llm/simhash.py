"""SimHash near copies with a Gray-order hierarchical index.

A fingerprint has 64 bits, by majority over the XXH64 values of a text's word shingles. Texts whose
fingerprints differ in at most ``distance`` bits are linked.

Equal fingerprints shrink to one before anything else. Fingerprints that link share one of
``distance + 1`` blocks of bits, so each goes to one cell per block; a cell with more than
``CELL_ROWS`` members is cut again by blocks of its remaining bits, so that a cell stays small
whatever its block holds (after four cuts its free bits bound it). In a task, the members of its
cells are sorted by Gray rank, with the bits of the cell first, so that neighbours share bits.
Groups of neighbours are factored into upper nodes: a mask of the bits on which all below agree, and
their pattern. A query goes down from its cell's node, adding the differences on the bits that
each node newly fixes, and leaves a whole group once they exceed the distance; a group whose free
bits cannot exceed it is linked as a whole. Tasks emit a spanning set of links, and components
are found over these.

Defined results: null and empty texts have fingerprint zero and are linked like others; texts with
fewer words than a shingle use their whole sequence; repeated rows are kept; null ids are never
the smallest of a component that has another. Columns of the input that are called like an output
column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.llm import words as W
from tunewright.llm.columns import plain, restored
from tunewright.llm.components import Union, components
from tunewright.llm.registry import query
from tunewright.session import store

CELL_ROWS = 4096
FAN_OUT = 8
_FRONT = 1_000_000


def word_runs(
    column: pa.Array, shingle: int
) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words with one space between, starts and ends of the shingles in them; of each text, the
    number of its first shingle and how many it has.
    """
    data, offsets = W.texts(column)
    starts, ends, first = W.spans(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return b"", none, none, np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1, np.int64)
    # one space between words, so that a shingle is a slice
    inside = ~W.SPACE[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    place = np.cumsum(keep) - 1
    flat = W.LOWER[data[keep]]
    flat[W.SPACE[flat]] = 32
    flat = flat.tobytes()
    starts, ends = place[starts], place[ends - 1] + 1
    n = np.diff(first)
    shingles = np.where(n == 0, 0, np.maximum(n - shingle + 1, 1))
    begin = np.cumsum(shingles) - shingles
    at = np.arange(shingles.sum()) - np.repeat(begin, shingles) + np.repeat(first[:-1], shingles)
    stop = np.minimum(at + shingle - 1, np.repeat(first[1:], shingles) - 1)
    return flat, starts[at], ends[stop], begin, shingles


def fingerprints(column: pa.Array, shingle: int = 3) -> np.ndarray:
    """64-bit fingerprints of texts: A-Z lower-cased, words between ASCII white space."""
    from xxhash import xxh64_intdigest as xxh

    flat, starts, ends, begin, shingles = word_runs(column, shingle)
    out = np.zeros(len(shingles), np.uint64)
    if not len(starts):
        return out
    s, e = starts.tolist(), ends.tolist()
    h = np.array([xxh(flat[a:b], 42) for a, b in zip(s, e, strict=True)], np.uint64)
    some = np.flatnonzero(shingles)
    out[some] = _majority(h, begin[some], shingles[some])
    return out


_LANES = np.array(
    [sum(((v >> i) & 1) << (8 * i) for i in range(8)) for v in range(256)], np.uint64
)


def _majority(h: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bits set in more than half of each run of hashes; eight bits are summed in one number."""
    # runs of at most 255, so that no lane overflows
    parts = -(-n // 255)
    owner = np.repeat(np.arange(len(n)), parts)
    cut = begin[owner] + 255 * (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts))
    where = np.cumsum(parts) - parts
    out = np.zeros(len(n), np.uint64)
    octets = h.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        sums = np.add.reduceat(_LANES[octets[:, k]], cut)
        counts = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8), where, axis=0, dtype=np.int64)
        for i in range(8):
            out |= (2 * counts[:, i] > n).astype(np.uint64) << np.uint64(8 * k + i)
    return out


def _fingerprint(text: str, carried: list[str], shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.pieces(batches, 2 << 20):
            fp = fingerprints(b.column(text), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in carried], pa.array(fp)], names=[*carried, "_fp"]
            )

    return run


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each number in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class GrayIndex:
    """Fingerprints of several cells, each with the bits that all members of its cell share."""

    def __init__(self, cell: np.ndarray, fp: np.ndarray, fixed: np.ndarray):
        # The cell's bits are equal for all its members: with those set to zero, the Gray rank
        # orders the members by their other bits.
        order = np.lexsort((gray_rank(fp & ~fixed), cell))
        self.order, self.fp, cell = order, fp[order], cell[order]
        level_cell = cell
        agree = np.full(len(fp), ~np.uint64(0))
        self.levels = [(self.fp, agree, None)]  # pattern, mask, first child
        pattern = self.fp
        while True:
            # up to FAN_OUT neighbours of one cell form a node
            edge = np.concatenate([[True], level_cell[1:] != level_cell[:-1]])
            start = np.flatnonzero(edge)
            size = np.diff(np.append(start, len(level_cell)))
            if (size == 1).all():
                self.roots = level_cell
                break
            inner = np.arange(len(level_cell)) - np.repeat(start, size)
            head = np.flatnonzero(inner % FAN_OUT == 0)
            ones = np.bitwise_and.reduceat(pattern, head)
            zeros = np.bitwise_and.reduceat(~pattern, head)
            agree = np.bitwise_and.reduceat(agree, head) & (ones | zeros)
            pattern, level_cell = ones & agree, level_cell[head]
            self.levels.append((pattern, agree, np.append(head, len(inner))))
        where = np.searchsorted(self.roots, cell)
        self.root = where

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links between members of a cell, in parts, so that all near ones are connected."""
        step = 1024
        for i in range(0, len(self.fp), step):
            q = np.arange(i, min(i + step, len(self.fp)))
            yield from self._down(q, self.root[q], None, None, len(self.levels) - 1, distance)

    def _down(self, q, node, seen, mask, level, distance):
        """Go down from the nodes; ``seen`` is the sum of differences on the bits in ``mask``."""
        pattern, agree, child = self.levels[level]
        fresh = agree[node] if mask is None else agree[node] & ~mask
        diff = _bits((self.fp[q] ^ pattern[node]) & fresh)
        if seen is not None:
            diff += seen
        near = diff <= distance
        q, node, diff = q[near], node[near], diff[near]
        if level == 0:
            other = q < node
            if other.any():
                yield q[other], node[other]
            return
        if not len(q):
            return
        mask = agree[node]
        free = 64 - _bits(mask)
        # any two members of such a group link, and the query with each of them
        whole = (diff + free <= distance) & (free <= distance)
        if whole.any():
            leaf = node[whole]
            for _, _, c in self.levels[level:0:-1]:
                leaf = c[leaf]
            yield q[whole], leaf
        q, node, diff, mask = q[~whole], node[~whole], diff[~whole], mask[~whole]
        n = child[node + 1] - child[node]
        total = np.cumsum(n)
        i = 0
        while i < len(q):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + _FRONT)))
            r = n[i:j]
            below = np.arange(r.sum()) - np.repeat(np.cumsum(r) - r, r)
            below += np.repeat(child[node[i:j]], r)
            yield from self._down(
                np.repeat(q[i:j], r), below, np.repeat(diff[i:j], r), np.repeat(mask[i:j], r),
                level - 1, distance,
            )
            i = j


def _cell_links(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not sum(p.num_rows for p in parts):
            return
        t = pa.Table.from_batches(parts)
        fp = t["_fp"].to_numpy().view(np.uint64)
        fixed = t["_fixed"].to_numpy().view(np.uint64)
        key = np.rec.fromarrays([fixed, fp & fixed], names="m,v")
        cell = np.unique(key, return_inverse=True)[1].ravel()
        index = GrayIndex(cell, fp, fixed)
        # members of different cells of this task may be equal fingerprints: one number each
        name, number = np.unique(index.fp, return_inverse=True)
        union = Union(len(name))
        for a, b in index.links(distance):
            union.add(number[a], number[b])
        linked = np.flatnonzero(union.root != np.arange(len(name)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(name[linked].view(np.int64)), pa.array(name[union.root[linked]].view(np.int64))],
            names=["a", "b"],
        )

    return run


def _blocks(fixed: int, parts: int) -> list[int]:
    """The bits outside ``fixed`` in ``parts`` masks of about equal size."""
    free = [i for i in range(64) if not fixed >> i & 1]
    return [
        sum(1 << i for i in free[len(free) * k // parts : len(free) * (k + 1) // parts])
        for k in range(parts)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cells(fps: DataFrame, distance: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``_fp`` and ``_fixed``, the mask of the bits that the cell's members share."""
    parts = distance + 1
    todo = fps.select("_fp", F.lit(0).cast("bigint").alias("_fixed"))
    masks, out = [0], None
    for depth in range(4):
        split = F.create_map(
            *[
                x
                for m in masks
                for x in (
                    F.lit(_signed(m)),
                    F.array(*[F.lit(_signed(m | b)) for b in _blocks(m, parts)]),
                )
            ]
        )
        todo = todo.select("_fp", F.explode(split[F.col("_fixed")]).alias("_fixed"))
        todo = todo.withColumn("_value", F.col("_fp").bitwiseAND(F.col("_fixed")))
        masks = sorted({m | b for m in masks for b in _blocks(m, parts)})
        if depth == 3:
            done = todo
        else:
            hot = store(
                todo.groupBy("_fixed", "_value").count().filter(F.col("count") > cell_rows), "hot-cells"
            ).drop("count")
            some = not hot.isEmpty()
            done = todo.join(hot, ["_fixed", "_value"], "left_anti") if some else todo
        out = done if out is None else out.unionByName(done)
        if depth == 3 or not some:
            break
        todo = store(todo.join(hot, ["_fixed", "_value"], "left_semi"), "hot-cells").drop("_value")
    return out


def link_fingerprints(fps: DataFrame, distance: int = 3, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints within the distance; ``_fp`` is distinct."""
    placed = cells(fps, distance, cell_rows).repartition("_fixed", "_value")
    return placed.select("_fp", "_fixed").mapInArrow(_cell_links(distance), "a bigint, b bigint")


def _placed(
    df: DataFrame, key: str, text: str, distance: int, shingle: int, cell_rows: int, keep: list[str]
) -> tuple[DataFrame, DataFrame]:
    """The columns ``keep`` with _fp; the fingerprints with their _root and component_id."""
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*[f"`{c}` {kind[c]}" for c in keep], "_fp bigint"])
    used = list(dict.fromkeys([*keep, text]))
    rows = store(df.select(used).mapInArrow(_fingerprint(text, keep, shingle), schema), "fingerprints")
    distinct = store(rows.groupBy("_fp").agg(F.min(key).alias("_first")), "distinct-fingerprints")
    joined = components(link_fingerprints(distinct.select("_fp"), distance, cell_rows))
    named = distinct.join(joined, F.col("_fp") == F.col("node"), "left")
    named = named.select("_fp", "_first", F.coalesce("root", "_fp").alias("_root"))
    smallest = named.groupBy("_root").agg(F.min("_first").alias("component_id"))
    return rows, named.join(smallest, "_root").select("_fp", "_root", "component_id")


def near_copies(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    distance: int = 3,
    shingle: int = 3,
    cell_rows: int = CELL_ROWS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add fingerprint (16 hex digits) and component_id (smallest key) to the columns ``keep``."""
    df = df.drop("fingerprint", "component_id")
    keep = [c for c in (keep or df.columns) if c in df.columns]
    rows, by_fp = _placed(df, key, text, distance, shingle, cell_rows, keep)
    out = rows.join(by_fp, "_fp")
    return out.select(*keep, F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def dedup(
    df: DataFrame, key: str = "doc_id", text: str = "text", distance: int = 3, shingle: int = 3
) -> DataFrame:
    """One row of each component: that with the smallest key; rows without a key are kept.

    Keys may repeat, with like or unlike texts; columns of the input may have any names. Only keys move
    while the texts meet those that go in one join.
    """
    df, names = plain(df)
    key, text = names[key], names[text]
    rows, by_fp = _placed(df, key, text, distance, shingle, CELL_ROWS, [key])
    marked = store(rows.filter(F.col(key).isNotNull()).join(by_fp, "_fp").select(key, "_fp", "_root"), "components")
    least = marked.groupBy("_root").agg(F.min(key).alias("_least"))
    named = store(marked.join(least, "_root"), "components")
    if named.groupBy(key).count().filter("count > 1").isEmpty():
        gone = named.filter(F.col(key) != F.col("_least")).select(key)
        return restored(df.join(gone, key, "left_anti"), names)
    kept = named.filter(F.col(key) == F.col("_least")).groupBy("_root", key).agg(F.min("_fp").alias("_fp"))
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    again = df.mapInArrow(_fingerprint(text, df.columns, shingle), kind + ", _fp bigint")
    out = again.join(kept.select(key, "_fp"), [key, "_fp"], "left_semi").dropDuplicates([key, "_fp"])
    return restored(out.select(df.columns).unionByName(df.filter(F.col(key).isNull())), names)


@query("op10_simhash_gray_index")
def op10_simhash_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_copies(docs, keep=["doc_id"])
