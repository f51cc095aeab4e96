"""Exact cosine joins in blocks of bounded size.

Close vectors meet in the cells of a tree of pivots (``pivot_tree``), which prune by the triangle
inequality. A cell of a few thousand members is compared in one task. The members of larger cells are stored
once, in packs; a Cartesian product of the stored packs then gives each task some of both sides to read, so a
cell that holds a third of the table becomes many equal tasks, and no member is copied or shuffled for
each pack that it meets. Where cells do not pay (a low threshold, or vectors without clusters) all rows
form one cell. Only pairs that reach the threshold leave a task.

Where the packs of one cell are many, rows that are close share a pack (``boxes``): packs whose boxes are too far
apart never meet, nor do such strips of packs that do, and a few axes rule out most of the pairs that are left.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunewright.functions.vectors import from_matrix, normalize, to_matrix
from tunewright.operators import boxes
from tunewright.operators.pivot_tree import ROOT_CELLS, Cells, angle_limit, pivot_cells, semi
from tunewright.operators.rank import BROADCAST_ROWS, HASH, as_list, order_hash
from tunewright.session import cut_lineage, store

BLOCK = 4096
PACK = 4096  # rows that travel as one value
WIDE = 4  # times as many, where packs are many
PACKS_PER_FILE = 4  # a task has the packs of two files, and Python gets their pairs at once
STRIP = 512  # rows of a pack compared at once
BOX_ROWS = 1 << 19  # from here on close rows share a pack; their shuffle takes memory
FILL = 0.75  # of a pack that a leaf of the tree has on average
HEAD = 24  # axes that bound cosines
FEW = 256  # one candidate in so many pairs is few
TRIAL = 16  # one row in so many tells whether candidates are few
GATHER = 1 << 20  # numbers of a side that are gathered at once
EMIT = 65_536  # pairs that leave a task at once
NONE = np.zeros(0, np.int64)
DECIMALS = 9  # cosines are compared at nine decimals


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.round(x @ y.T, DECIMALS)


def _cosines_of(x: np.ndarray, y: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Cosines of some pairs of rows, some at a time."""
    n = max(1, GATHER // x.shape[1])
    parts = [np.einsum("ij,ij->i", x[at[k : k + n]], y[to[k : k + n]]) for k in range(0, len(at), n)]
    return np.round(np.concatenate(parts), DECIMALS) if parts else np.zeros(0)


def hash_number(h: Column) -> Column:
    """The last eight hex digits as a number: independent of the digits that order rows."""
    return F.conv(F.substring(h, 25, 8), 16, 10).cast("long")


def unit_vectors(df: DataFrame, key: str | Sequence[str], vec: str, seed: int) -> DataFrame:
    return df.select(
        order_hash(key, seed).alias(HASH), normalize(F.col(vec).cast("array<double>")).alias("_v")
    )


def collapse_copies(rows: DataFrame) -> DataFrame:
    """One row per distinct non-zero vector, with the first hash; zero vectors are left alone.

    Combines on the map side, so copies never meet in one task in full.
    """
    zero = F.forall("_v", lambda x: x == 0)
    apart = F.when(zero, F.col(HASH)).otherwise(F.lit(""))
    return (
        rows.groupBy(F.xxhash64("_v", apart).alias("_k"), apart.alias("_z"), "_v")
        .agg(F.min(HASH).alias(HASH), F.count("*").alias("_n"))
        .select(HASH, "_v", "_n")
    )


def _copies(rows: DataFrame, first: DataFrame, total: int) -> DataFrame:
    """``(a, b)``: the first row of each vector and its copies.

    Vectors that hold more than a thousandth of the rows are fewer than a thousand: they are
    broadcast. What is left has no hot vector and is joined by shuffle.
    """
    multi = first.filter("_n > 1").select(F.col(HASH).alias("a"), "_v", "_n")
    share = max(1, total // 1000)
    hot = F.broadcast(multi.filter(F.col("_n") > share).drop("_n"))
    cold = multi.filter(F.col("_n") <= share).drop("_n")
    pairs = rows.join(hot, "_v").unionByName(
        rows.join(hot.select("_v"), "_v", "left_anti").join(cold, "_v")
    )
    return pairs.filter(F.col("a") < F.col(HASH)).select("a", F.col(HASH).alias("b"))


def _pack(size: int, axes: np.ndarray | None = None):
    """Rows that stand together, as bytes: a pack is of one cell and has at most ``size`` rows.

    With axes it is of one leaf, its strips have small boxes, and its own box stands beside it.
    """

    def whole(parts: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(parts).combine_chunks()
        cell, box = table.column("_cell")[0].as_py(), ()
        if axes is not None:
            z = boxes.turned(to_matrix(table.column("_v")), axes)
            box, turns = boxes.box_columns(z), boxes.order(z, STRIP)
            head = boxes.first_axes(z, HEAD)[turns].astype(np.float32)
            table = table.take(pa.array(turns)).append_column("_head", from_matrix(head))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        columns = [[cell], [uuid.uuid4().hex], [sink.getvalue().to_pybytes()]]
        types = (pa.string(), pa.string(), pa.binary())
        arrays = [*[pa.array(c, t) for c, t in zip(columns, types, strict=True)], *box]
        return pa.RecordBatch.from_arrays(arrays, names=["_cell", "_id", "_pack", "_low", "_high"][: len(arrays)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, at = [], 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            by = "_leaf" if "_leaf" in table.column_names else "_cell"
            names = batch.column(batch.schema.get_field_index(by)).dictionary_encode()
            table = table.drop_columns("_leaf") if by == "_leaf" else table
            codes = names.indices.to_numpy()
            cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if low == high:
                    continue
                cell = names.dictionary[codes[low]].as_py()
                if parts and cell != at:
                    yield whole(parts)
                    parts, rows = [], 0
                at = cell
                while low < high:
                    n = min(size - rows, high - low)
                    parts.append(table.slice(low, n))
                    rows, low = rows + n, low + n
                    if rows == size:
                        yield whole(parts)
                        parts, rows = [], 0
        if parts:
            yield whole(parts)

    return run


def _unpack(value: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(value.as_buffer()).read_all()


def _divided(cells: Cells, block: int) -> tuple[DataFrame, DataFrame | None, int]:
    """Members of the cells that one task compares, members of the larger ones, and the rows of those."""
    limit = max(2 * block, PACK)
    large = cells.sizes.filter(F.col("_n") > limit)
    n, rows = large.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    if not n:
        return cells.members, None, 0
    if cells.cells == 1:
        return cells.members.limit(0), cells.members, rows
    slices = large.select("_cell", F.ceil(F.col("_n") / PACK).alias("_slices"))
    big = cells.members.join(F.broadcast(slices) if n <= BROADCAST_ROWS else slices, "_cell")
    big = big.withColumn("_slice", hash_number(F.col(HASH)) % F.col("_slices"))
    big = big.repartition("_cell", "_slice").sortWithinPartitions("_cell").select(cells.members.columns)
    return semi(cells.members, large, n, "left_anti"), big, rows


def _turn(members: DataFrame, rows: int) -> boxes.Turn | None:
    """Axes, and leaves of about a pack, from a sample; none where there are few packs."""
    if rows < BOX_ROWS:
        return None
    some = boxes.sample(members, rows, hash_number(F.col(HASH)))
    return boxes.learn(some, int(rows / FILL / _pack_rows(rows))) if some.size else None


def _pack_rows(rows: int) -> int:
    """Rows of a pack: more of them, if packs are so many that sending them to each other takes long."""
    return PACK * min(WIDE, max(1, rows // (64 * PACK)))


def _packs(members: DataFrame, rows: int, one: bool, turn: boxes.Turn | None) -> DataFrame:
    """The members in packs, stored: as many tasks read them as there are cores, or more."""
    cores = members.sparkSession.sparkContext.defaultParallelism
    size, schema, axes = PACK, "_cell string, _id string, _pack binary", None
    if turn is not None:
        size, axes, schema = _pack_rows(rows), turn.axes, f"{schema}, _low array<double>, _high array<double>"
        if one:
            members = members.withColumn("_leaf", turn.leaf("_v"))
            members = members.repartition("_leaf").sortWithinPartitions("_leaf")
    elif one and rows < 2 * cores * PACK:
        members = members.repartition(max(1, min(cores, 4 * rows // PACK)))
    packs = members.mapInArrow(_pack(size, axes), schema)
    return store(packs, "packs", rows_per_file=PACKS_PER_FILE)


def _meet(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Packs of one cell side by side, if their boxes do not forbid it."""
    names = {c: f"{c}2" for c in right.columns}
    here = F.expr("_cell = _cell2")
    if "_low" in left.columns:
        here &= boxes.within(boxes.widest(threshold, DECIMALS))
    return left.hint("shuffle_replicate_nl").join(right.withColumnsRenamed(names), here)


class _Side:
    """A table of unit vectors, ready to be compared; one of a pack with axes also by strips."""

    def __init__(self, table: pa.Table):
        self.x = to_matrix(table.column("_v"))
        self.small = self.x.astype(np.float32)
        self.guest = table.column("_guest").to_numpy()
        self.head = None
        if "_head" in table.column_names:
            self.head = to_matrix(table.column("_head"), np.float32)
            self.low, self.high = boxes.bounds(self.head, STRIP)


def _reaching(left: _Side, right: _Side, low: np.float32, same: bool) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """Rows ``i:k`` of the left with rows ``j:l`` of the right, and where in them a cosine may reach ``low``."""
    for i in range(0, len(left.x), STRIP):
        first, k = i if same else 0, min(i + STRIP, len(left.x))
        raw = left.small[i:k] @ right.small[first:].T
        yield i, k, first, len(right.x), np.flatnonzero(raw >= low)


class _Scan:
    """Where products of rows reach a bound. Its room is used again for each strip."""

    def __init__(self):
        self.raw, self.hit = np.empty(STRIP * STRIP, np.float32), np.empty(STRIP * STRIP, bool)

    def __call__(self, x: np.ndarray, y: np.ndarray, low: np.float32) -> np.ndarray:
        shape, n = (len(x), len(y)), len(x) * len(y)
        np.matmul(x, y.T, out=self.raw[:n].reshape(shape))
        hit = np.greater_equal(self.raw[:n], low, out=self.hit[:n])
        return np.flatnonzero(hit) if hit.any() else NONE


def _reaching_boxes(
    left: _Side, right: _Side, low: np.float32, same: bool, widest: float
) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """The same by strips of both sides. Few products bound a cosine; all are made where that leaves many pairs."""
    dense, scan = False, _Scan()
    for a, i in enumerate(range(0, len(left.x), STRIP)):
        k = min(i + STRIP, len(left.x))
        first = a if same else 0
        near = boxes.apart(left.low[a], left.high[a], right.low[first:], right.high[first:]) <= widest
        for b in np.flatnonzero(near) + first:
            j, end = int(b) * STRIP, min(int(b + 1) * STRIP, len(right.x))
            # after strips with many candidates some rows tell whether the next have many, too
            step = TRIAL if dense else 1
            found = scan(left.head[i:k:step], right.head[j:end], low)
            dense = len(found) * step * FEW > (k - i) * (end - j)
            if dense:
                found = scan(left.small[i:k], right.small[j:end], low)
            elif step > 1:
                found = scan(left.head[i:k], right.head[j:end], low)
            if len(found):
                yield i, k, j, end, found


def _near(
    left: pa.Table | _Side, right: pa.Table | _Side, threshold: float, same: bool = False
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of two tables of a cell that reach the threshold and belong to this cell, and their cosines.

    A strip of the left table at a time, or a part of one; of the ``same`` table each pair once.
    """
    left, right = (side if isinstance(side, _Side) else _Side(side) for side in (left, right))
    x, y = left.x, right.x
    # single precision finds what may reach the threshold (unit vectors: its error is below the slack)
    low = np.float32(threshold - (x.shape[1] + 8) * 2.0**-23)
    if left.head is None:
        strips = _reaching(left, right, low, same)
    else:
        strips = _reaching_boxes(left, right, low, same, boxes.widest(threshold, DECIMALS))
    parts: list[tuple[np.ndarray, ...]] = []
    strip = held = 0
    for i, k, j, end, found in strips:
        if parts and (i != strip or held >= GATHER):
            yield tuple(map(np.concatenate, zip(*parts, strict=True)))
            parts, held = [], 0
        strip = i
        at, to = np.divmod(found, end - j)
        at, to = at + i, to + j
        if len(at) * 64 > (k - i) * (end - j):
            sims = np.round((x[i:k] @ y[j:end].T)[at - i, to - j], DECIMALS)
        else:
            sims = _cosines_of(x, y, at, to)
        kept = (sims >= threshold) & ((left.guest[at] & right.guest[to]) == 0)
        if same:
            kept &= to > at
        if kept.any():
            parts.append((at[kept], to[kept], sims[kept]))
            held += len(parts[-1][0])
    if parts:
        yield tuple(map(np.concatenate, zip(*parts, strict=True)))


def _words(hashes: pa.Array) -> np.ndarray:
    """Order hashes as four numbers each, which compare as the strings do."""
    return np.array(hashes.to_numpy(zero_copy_only=False), "S32").view(">u8").astype(np.uint64).reshape(-1, 4)


def _later(words: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Does the hash of the row ``at`` come after that of the row ``to``?"""
    x, y = words[at, 0], words[to, 0]
    out, tie = x > y, np.flatnonzero(x == y)
    for k in range(1, words.shape[1]):
        x, y = words[at[tie], k], words[to[tie], k]
        out[tie] = x > y
        tie = tie[x == y]
    return out


def _pairs(
    left: pa.Table, right: pa.Table, threshold: float, same: bool, name: str
) -> Iterator[pa.RecordBatch]:
    """Pairs by ``name``, the lower hash first, once for each pair of rows that has the names."""
    hashes, names = (
        pa.concat_arrays([c for t in (left, right) for c in t.column(k).chunks]) for k in (HASH, name)
    )
    words = many = None
    if "_m" in left.column_names:
        many = np.concatenate([t.column("_m").to_numpy() for t in (left, right)])
    for at, to, sims in _near(left, right, threshold, same):
        words = _words(hashes) if words is None else words
        to = to + left.num_rows
        for i in range(0, len(at), EMIT):
            x, y, s = at[i : i + EMIT], to[i : i + EMIT], sims[i : i + EMIT]
            swap = _later(words, x, y)
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            if many is not None and (many[x] * many[y] > 1).any():
                times = many[x] * many[y]
                x, y, s = (np.repeat(side, times) for side in (x, y, s))
            columns = [names.take(pa.array(x)), names.take(pa.array(y)), pa.array(s)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "cosine"])


def _grouped(compare, schema: T.StructType, group: DataFrame) -> DataFrame:
    """``compare`` on each cell, in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        if table.num_rows:
            yield from compare(table)

    return group.groupBy("_cell").applyInArrow(run, schema)


def edges(
    rows: DataFrame, total: int, threshold: float, block: int = BLOCK, root_cells: int = ROOT_CELLS,
    name: str = HASH,
) -> DataFrame:
    """All pairs ``(a, b, cosine)`` of order hashes with ``a < b`` and cosine >= threshold.

    Or of what the column ``name`` holds; a pair then comes ``_m * _m`` times if there is a column ``_m``.
    """
    columns = [HASH, "_v", *[c for c in (name, "_m") if c != HASH and c in rows.columns]]
    cells = cells_for(rows.select(columns), total, threshold, block, root_cells)
    schema = T.StructType(
        [T.StructField(c, rows.schema[name].dataType) for c in "ab"] + [T.StructField("cosine", T.DoubleType())]
    )

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, i, j in zip(*map(batch.column, ("_pack", "_pack2", "_id", "_id2")), strict=True):
                same = i == j
                left = _unpack(x)
                yield from _pairs(left, left if same else _unpack(y), threshold, same, name)
            batch = x = y = left = None  # else it would be held until the next is there

    small, large, n = _divided(cells, block)
    found = _grouped(lambda t: _pairs(t, t, threshold, True, name), schema, small)
    if large is None:
        return found
    turn = _turn(large, n)
    packs = _packs(large, n, cells.cells == 1, turn)
    met = _meet(packs, packs, threshold).filter("_id <= _id2")
    met = met.select("_id", "_pack", "_id2", "_pack2").mapInArrow(across, schema)
    return met if cells.cells == 1 else found.unionByName(met)


def _hit(left: pa.Table, right: pa.Table, threshold: float) -> pa.RecordBatch:
    """The hashes of ``left`` that have a vector of ``right`` near them."""
    hit = np.zeros(left.num_rows, bool)
    for at, _, _ in _near(left, right, threshold):
        hit[at] = True
    hashes = left.column(HASH).combine_chunks().filter(pa.array(hit))
    return pa.RecordBatch.from_arrays([hashes], names=[HASH])


def struck(
    rows: DataFrame, total: int, others: DataFrame, threshold: float, block: int = BLOCK,
    root_cells: int = ROOT_CELLS,
) -> DataFrame:
    """The hashes of ``rows`` that have a vector of ``others`` with cosine >= threshold.

    Both together make one tree. A task emits a row once for each pack of others that is near it.
    ``total`` counts both.
    """
    both = rows.select(HASH, "_v", F.lit(0).alias("_side")).unionByName(
        others.select(HASH, "_v", F.lit(1).alias("_side"))
    )
    cells = cells_for(both, total, threshold, block, root_cells)
    schema = T.StructType([T.StructField(HASH, T.StringType())])

    def within(table: pa.Table) -> Iterator[pa.RecordBatch]:
        side = table.column("_side").to_numpy()
        left, right = (table.filter(pa.array(side == k)) for k in (0, 1))
        if left.num_rows and right.num_rows:
            yield _hit(left, right, threshold)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("_pack"), batch.column("_pack2"), strict=True):
                yield _hit(_unpack(x), _unpack(y), threshold)
            batch = x = y = None

    small, large, n = _divided(cells, block)
    found = _grouped(within, schema, small)
    if large is not None:
        turn = _turn(large, n)
        sides = [_packs(large.filter(F.col("_side") == k), n, cells.cells == 1, turn) for k in (0, 1)]
        met = _meet(*sides, threshold).select("_pack", "_pack2").mapInArrow(across, schema)
        found = met if cells.cells == 1 else found.unionByName(met)
    return found.distinct()


def cells_for(
    rows: DataFrame, total: int, threshold: float, block: int = BLOCK, root_cells: int = ROOT_CELLS
) -> Cells:
    """The cells in which pairs that reach the threshold meet."""
    theta = angle_limit(threshold, DECIMALS)
    return pivot_cells(rows, total, theta, block, hash_number(F.col(HASH)), root_cells)


def _named(pairs: DataFrame, df: DataFrame, key: str | Sequence[str], seed: int) -> DataFrame:
    """Replace the order hashes ``a`` and ``b`` by the key columns."""
    names = as_list(key)
    ids = df.select(order_hash(key, seed).alias(HASH), *names)
    for side in ("a", "b"):
        renamed = ids.select(
            F.col(HASH).alias(side), *[F.col(k).alias(f"{side}_{k}") for k in names]
        )
        pairs = pairs.join(renamed, side)
    return pairs.select(*[f"a_{k}" for k in names], *[f"b_{k}" for k in names])


def _keyed(first: DataFrame, df: DataFrame, key: str | Sequence[str], seed: int) -> DataFrame:
    """``first`` with its keys as ``_key``, and how many rows of ``df`` have them as ``_m``."""
    keys = F.struct(*[F.col(f"`{k}`") for k in as_list(key)]).alias("_key")
    ids = df.select(order_hash(key, seed).alias(HASH), keys)
    return first.join(ids.groupBy(HASH).agg(F.first("_key").alias("_key"), F.count("*").alias("_m")), HASH)


def similar_pairs(
    df: DataFrame,
    key: str | Sequence[str],
    vec: str,
    threshold: float,
    seed: int = 42,
    block: int = BLOCK,
    root_cells: int = ROOT_CELLS,
) -> DataFrame:
    """All pairs of distinct vectors with cosine >= threshold, the earlier of the seeded order first.

    A vector stands for all rows that hold it, under the key of the first; ``vector_copies`` lists
    them. Both together are all pairs of rows, without a product of two groups of copies.
    """
    first = collapse_copies(unit_vectors(df, key, vec, seed)).drop("_n")
    first = store(_keyed(first, df, key, seed), "vectors")
    pairs = edges(first, first.count(), threshold, block, root_cells, "_key")
    names = [F.col(f"{side}.`{k}`").alias(f"{side}_{k}") for side in ("a", "b") for k in as_list(key)]
    return pairs.select(*names, "cosine")


def vector_copies(df: DataFrame, key: str | Sequence[str], vec: str, seed: int = 42) -> DataFrame:
    """The first row of each vector that repeats (``a``) with each of its copies (``b``)."""
    rows = unit_vectors(df, key, vec, seed)
    first = cut_lineage(collapse_copies(rows))
    total = first.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    return _named(_copies(rows, first, total), df, key, seed)
