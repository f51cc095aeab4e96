"""Near copies among embeddings with a robust-pruned flat graph.

Links are pairs of vectors whose cosine, in double precision, reaches the threshold.

1. Equal vectors become one node with a weight.
2. Dense spots, found in a bounded sample, become balls: all nodes within half the threshold's angle
   of a spot's centre. Any two members of a ball link, so their links are counted, not formed. A
   group of near copies that holds a third of the rows is one ball. Between two balls, a member
   whose angle to the other centre leaves no doubt counts the ball as a whole; others are compared
   one by one, in blocks.
3. The nodes outside balls are the graph. Centres fitted on the sample cut them into overlapping
   shards (each node lies in the ``OVERLAP`` nearest), in slices of bounded size. Each slice links
   its nodes by robust pruning: from the nearest on, a neighbour is kept unless one kept before is
   nearer to it by the factor ``ALPHA``. The adjacency lists of all slices are united per node.
4. All nodes are queries. A query goes to the shards of its ``PROBES`` nearest centres, walks greedily
   from the slice's medoids with a beam, and then expands the range: neighbours of every node within
   the threshold are tried until nothing new is within. United lists lead to nodes of other
   shards: those are tried in a join.
5. What is found is verified by its cosine. Recall is audited against brute force for a bounded
   sample of queries.

No task holds more than a slice of nodes and a block of queries, and no list of links reaches the
driver.

Defined results: vectors that are null, zero, or hold null or non-finite components link with nothing,
nor do vectors of unlike lengths (each length has a graph) or rows without an id; copies link with each other. Repeated rows
count each. An empty table gives an empty result. Columns of the input that are called like an
output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.llm.components import components
from tunewright.llm.registry import query
from tunewright.session import store

SAMPLE = 8192
DENSE = 4
SLICE_ROWS = 1000
QUERY_ROWS = 2000
OVERLAP = 2
PROBES = 4
DEGREE = 24
ALPHA = 1.2
BEAM = 16
MEDOIDS = 16
MOST_CENTRES = 2048
AUDIT = 200


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    # the largest component first, so that no square overflows or vanishes
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


@dataclass
class Layout:
    """What is fitted on the sample: ball centres and shard centres."""

    threshold: float
    balls: np.ndarray
    centres: np.ndarray

    @property
    def theta(self) -> float:
        return float(np.arccos(self.threshold))

    @property
    def reach(self) -> float:
        """Two vectors within this angle of a centre link for certain."""
        return self.theta / 2 - 1e-7


def fit(sample: np.ndarray, rows: int, threshold: float, seed: int = 1) -> Layout:
    """Ball centres at the dense spots of a sample, shard centres by spherical k-means on the rest."""
    out = Layout(threshold, sample[:0], sample[:1])
    n = len(sample)
    if not n:
        return out
    near = np.cos(out.reach)
    count = np.zeros(n, np.int64)
    for i in range(0, n, 512):
        count[i : i + 512] = (sample[i : i + 512] @ sample.T >= near).sum(axis=1)
    free = np.ones(n, bool)
    balls = []
    for i in np.argsort(-count, kind="stable").tolist():
        if count[i] < DENSE:
            break
        if not free[i]:
            continue
        group = sample[(sample @ sample[i] >= near) & free]
        centre = group.mean(axis=0)
        centre /= max(np.linalg.norm(centre), 1e-300)
        inside = (sample @ centre >= near) & free
        inside[i] = True
        free &= ~inside
        if inside.sum() >= DENSE:
            balls.append(centre)
    rest = sample[free] if free.any() else sample
    k = int(min(max(1, -(-rows // SLICE_ROWS) * OVERLAP), MOST_CENTRES, max(1, len(rest) // 8)))
    rng = np.random.default_rng(seed)
    centres = rest[rng.choice(len(rest), k, replace=False)]
    for _ in range(5):
        own = np.concatenate(
            [(rest[i : i + 1024] @ centres.T).argmax(axis=1) for i in range(0, len(rest), 1024)]
        )
        total = np.zeros_like(centres)
        np.add.at(total, own, rest)
        norm = np.linalg.norm(total, axis=1)
        some = norm > 1e-12
        centres[some] = total[some] / norm[some, None]
    return Layout(threshold, np.array(balls).reshape(-1, sample.shape[1]), centres)


def _best(sims: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest values of each row, largest first."""
    k = min(k, sims.shape[1])
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(sims, top, 1), axis=1, kind="stable"), 1)


def _locate(shared):
    """Ball, angle, other balls in doubt or in reach, and nearest shards of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: Layout = shared.value
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                x = _matrix(part.column("vec"))
                n = len(x)
                ball, angle = np.full(n, -1, np.int32), np.zeros(n)
                others: list[list[dict]] = [[] for _ in range(n)]
                if len(at.balls):
                    a = _angle(x @ at.balls.T)
                    nearest = a.argmin(axis=1)
                    angle = a[np.arange(n), nearest]
                    ball = np.where(angle <= at.reach, nearest, -1).astype(np.int32)
                    close = (a <= at.theta + at.reach) & (ball >= 0)[:, None]
                    close[np.arange(n), nearest] = False
                    for r, c in zip(*np.nonzero(close), strict=True):
                        others[r].append({"ball": int(c), "angle": float(a[r, c])})
                shards = _best(x @ at.centres.T, PROBES).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in ("node", "first", "weight", "vec")],
                        pa.array(ball),
                        pa.array(angle),
                        pa.array(others, pa.list_(pa.struct([("ball", pa.int32()), ("angle", pa.float64())]))),
                        pa.array(shards.tolist(), pa.list_(pa.int32())),
                    ],
                    names=["node", "first", "weight", "vec", "ball", "angle", "others", "shards"],
                )

    return run


def prune(sims: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """Robust-pruned neighbours of each node of a slice, reverse edges included."""
    m = len(sims)
    if m < 2:
        return [np.zeros(0, np.int64)] * m
    s = sims.copy()
    np.fill_diagonal(s, -2.0)
    cand = _best(s, min(m - 1, 3 * degree))
    own = np.take_along_axis(s, cand, 1)
    alive = np.ones(cand.shape, bool)
    edges = []
    rows = np.arange(m)
    for _ in range(degree):
        pick = alive.argmax(axis=1)
        some = alive[rows, pick]
        if not some.any():
            break
        chosen = cand[rows, pick]
        edges.append(np.stack([rows[some], chosen[some]], axis=1))
        # squared distance of unit vectors: 2 - 2 cos
        covered = alpha * alpha * (1 - sims[chosen[:, None], cand]) <= 1 - own
        alive &= ~covered
        alive[rows, pick] = False
    e = np.concatenate(edges)
    e = np.unique(np.concatenate([e, e[:, ::-1]]), axis=0)
    # the nearest of a hub's reverse edges
    order = np.lexsort((-sims[e[:, 0], e[:, 1]], e[:, 0]))
    e = e[order]
    cut = np.searchsorted(e[:, 0], np.arange(m + 1))
    return [e[a : min(b, a + 2 * degree), 1] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _groups(batches, "unit"):
        x = _matrix(t["vec"].combine_chunks())
        node = t["node"].to_numpy()
        sims = x @ x.T
        for i, near in enumerate(prune(sims)):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([node[i]], pa.int64()),
                    pa.array([node[near].tolist()], pa.list_(pa.int64())),
                    pa.array([sims[i, near].tolist()], pa.list_(pa.float64())),
                ],
                names=["node", "near", "cosines"],
            )


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of equal keys; the rows come sorted by the key."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            if held and k[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = k[a]
            held.append(b.slice(a, z - a))
    if held:
        yield pa.Table.from_batches(held)


def search(
    x: np.ndarray, near: np.ndarray, q: np.ndarray, threshold: float, beam: int = BEAM
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) within the threshold, by greedy search and range expansion.

    ``near`` holds the nodes' neighbours, filled up with -1.
    """
    m, b = len(x), len(q)
    rng = np.random.default_rng(m)
    entry = rng.choice(m, min(m, MEDOIDS), replace=False)
    # medoids: of the nodes nearest to each entry, the one nearest to their mean
    own = (x @ x[entry].T).argmax(axis=1)
    mean = np.zeros((len(entry), x.shape[1]))
    np.add.at(mean, own, x)
    entry = np.unique((x @ mean.T).argmax(axis=0))
    seen = np.zeros((b, m), bool)
    seen[:, entry] = True
    sims = q @ x[entry].T
    hits_q, hits_n = [], []

    def hit(r: np.ndarray, c: np.ndarray, s: np.ndarray) -> None:
        ok = s >= threshold
        hits_q.append(r[ok])
        hits_n.append(c[ok])

    hit(np.repeat(np.arange(b), len(entry)), np.tile(entry, b), sims.ravel())
    top = _best(sims, beam)
    pool = np.full((b, beam), -1, np.int64)
    value = np.full((b, beam), -2.0)
    pool[:, : top.shape[1]] = entry[top]
    value[:, : top.shape[1]] = np.take_along_axis(sims, top, 1)
    done = pool < 0
    live = np.arange(b)
    while len(live):
        open_value = np.where(done[live], -3.0, value[live])
        at = open_value.argmax(axis=1)
        go = open_value[np.arange(len(live)), at] > -3.0
        live, at = live[go], at[go]
        if not len(live):
            break
        done[live, at] = True
        around = near[pool[live, at]]
        r, c = np.nonzero(around >= 0)
        node = around[r, c]
        fresh = ~seen[live[r], node]
        r, c, node = r[fresh], c[fresh], node[fresh]
        seen[live[r], node] = True
        s = np.einsum("ij,ij->i", q[live[r]], x[node])
        hit(live[r], node, s)
        new_node = np.full(around.shape, -1, np.int64)
        new_value = np.full(around.shape, -2.0)
        new_node[r, c], new_value[r, c] = node, s
        all_node = np.concatenate([pool[live], new_node], axis=1)
        all_value = np.concatenate([value[live], new_value], axis=1)
        all_done = np.concatenate([done[live], new_node < 0], axis=1)
        keep = np.argpartition(-all_value, beam - 1, axis=1)[:, :beam]
        pool[live] = np.take_along_axis(all_node, keep, 1)
        value[live] = np.take_along_axis(all_value, keep, 1)
        done[live] = np.take_along_axis(all_done, keep, 1)
    r, node = np.concatenate(hits_q), np.concatenate(hits_n)
    while len(r):
        # range expansion: the neighbours of what was found last
        around = near[node]
        i, j = np.nonzero(around >= 0)
        pairs = np.unique(r[i] * m + around[i, j])
        a, c = np.divmod(pairs, m)
        fresh = ~seen[a, c]
        a, c = a[fresh], c[fresh]
        seen[a, c] = True
        s = np.einsum("ij,ij->i", q[a], x[c])
        ok = s >= threshold
        r, node = a[ok], c[ok]
        hits_q.append(r)
        hits_n.append(node)
    return np.concatenate(hits_q), np.concatenate(hits_n)


def _search(threshold: float):
    # a neighbour of a found node can only be in range itself within twice the angle
    wide = np.cos(min(2 * np.arccos(threshold), np.pi)) - 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, "unit"):
            asks = t["asks"].to_numpy(zero_copy_only=False)
            index, queries = t.filter(pa.array(~asks)), t.filter(pa.array(asks))
            if not len(index) or not len(queries):
                continue
            x, q = _matrix(index["vec"].combine_chunks()), _matrix(queries["vec"].combine_chunks())
            node, ask = index["node"].to_numpy(), queries["node"].to_numpy()
            order = np.argsort(node)
            sizes = np.array([len(v) for v in index["near"].to_pylist()], np.int64)
            flat = index["near"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            cosines = index["cosines"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(node)), sizes)
            at = np.minimum(np.searchsorted(node, flat, sorter=order), len(node) - 1)
            local = order[at]
            here = node[local] == flat
            near = _padded(owner[here], local[here], len(node))
            r, c = search(x, near, q, threshold)
            other = ask[r] != node[c]
            r, c = r[other], c[other]
            # neighbours in other shards of what was found
            away = ~here & (cosines >= wide)
            out = _padded(owner[away], np.flatnonzero(away), len(node))
            i, j = np.nonzero(out[c] >= 0) if out.shape[1] else (r[:0], r[:0])
            far = flat[out[c[i], j]] if out.shape[1] else flat[:0]
            a = np.concatenate([ask[r], ask[r[i]]])
            z = np.concatenate([node[c], far])
            sure = np.concatenate([np.ones(len(r), bool), np.zeros(len(i), bool)])
            keep = a != z
            yield pa.RecordBatch.from_arrays(
                [pa.array(v[keep]) for v in (np.minimum(a, z), np.maximum(a, z), sure)],
                names=["a", "b", "sure"],
            )

    return run


def _padded(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Values of each owner as rows, filled up with -1."""
    order = np.argsort(owner, kind="stable")
    owner, value = owner[order], value[order]
    first = np.searchsorted(owner, np.arange(n + 1))
    width = int(np.diff(first).max(initial=0))
    out = np.full((n, width), -1, np.int64)
    out[owner, np.arange(len(owner)) - first[owner]] = value
    return out


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        c = np.einsum("ij,ij->i", _matrix(b.column("va")), _matrix(b.column("vb")))
        yield pa.RecordBatch.from_arrays(
            [b.column("a"), b.column("b"), pa.array(c)], names=["a", "b", "cosine"]
        )


def _units(rows: DataFrame, key: str, most: int, name: str) -> DataFrame:
    """Number of slices of at most about ``most`` rows for each value of ``key``."""
    return rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))


def _block_counts(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, "unit"):
            asks = t["asks"].to_numpy(zero_copy_only=False)
            index, queries = t.filter(pa.array(~asks)), t.filter(pa.array(asks))
            if not len(index) or not len(queries):
                continue
            x, q = _matrix(index["vec"].combine_chunks()), _matrix(queries["vec"].combine_chunks())
            hit = q @ x.T >= threshold
            some = np.flatnonzero(hit.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(queries["node"].to_numpy()[some]),
                    pa.array(hit[some] @ index["weight"].to_numpy()),
                    pa.array(index["node"].to_numpy()[hit[some].argmax(axis=1)]),
                ],
                names=["node", "n", "b"],
            )

    return run


def _doubtful(doubt: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """Members ``node`` of one ball against the members of another, block by block."""
    blocks = _units(members, "ball", SLICE_ROWS, "blocks")
    parts = _units(doubt, "ball", QUERY_ROWS, "parts")
    cuts = blocks.join(parts, "ball")
    own = members.join(cuts, "ball").select(
        "ball", "node", "vec", "weight", F.pmod(F.xxhash64("node"), "blocks").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("asks"),
    )
    asked = doubt.join(cuts, "ball").select(
        "ball", "node", "vec", F.lit(0).cast("bigint").alias("weight"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - F.lit(1).cast("bigint"))).alias("block"),
        F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), F.lit(True).alias("asks"),
    )
    both = own.unionByName(asked)
    both = both.select(F.xxhash64("ball", "block", "part").alias("unit"), "asks", "node", "weight", "vec")
    return both.repartition("unit").sortWithinPartitions("unit").mapInArrow(
        _block_counts(threshold), "node bigint, n bigint, b bigint"
    )


def graph(singles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Slices of the overlapping shards, and the united adjacency lists of all their nodes."""
    placed = singles.select("node", "weight", "vec", F.inline(
        F.transform(F.slice("shards", 1, OVERLAP), lambda s: F.struct(s.alias("shard")))
    ))
    slices = F.broadcast(_units(placed, "shard", SLICE_ROWS, "slices"))  # MOST_CENTRES rows at most
    placed = placed.join(slices, "shard").withColumn("slice", F.pmod(F.xxhash64("node"), "slices"))
    placed = store(placed.withColumn("unit", F.xxhash64("shard", "slice")), "shards")
    lists = (
        placed.select("unit", "node", "vec").repartition("unit").sortWithinPartitions("unit")
        .mapInArrow(_build, "node bigint, near array<bigint>, cosines array<double>")
    )
    # a node is in OVERLAP slices, and each gives it at most twice the degree
    union = lists.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("near", "cosines")))).alias("_e")
    )
    united = union.select("node", F.col("_e.near").alias("near"), F.col("_e.cosines").alias("cosines"))
    return placed, store(united, "adjacency")


def valid(key: str, vector: str) -> Column:
    """Can the row link at all?"""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(key).isNotNull() & finite & F.exists(v, lambda x: x != 0)


def lengths(df: DataFrame, key: str, vector: str) -> list[int]:
    """The lengths of the valid vectors, most frequent first. Vectors of two lengths have no cosine."""
    sizes = df.filter(valid(key, vector)).groupBy(F.size(vector).alias("d")).count()
    return [r["d"] for r in sizes.orderBy(F.desc("count"), "d").collect()]


def link(df: DataFrame, dim: int, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95) -> dict:
    """Of the vectors of length ``dim``: tables ``nodes`` (with balls), ``pairs`` (verified links between nodes of which one at least is
    outside balls), ``counts`` (links counted in balls) and ``edges`` (enough links to connect them).
    """
    spark = df.sparkSession
    rows = df.filter(valid(key, vector) & (F.size(vector) == dim))
    rows = rows.select(F.col(key).alias("id"), F.col(vector).alias("vec"))
    distinct = rows.groupBy("vec").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("weight"))
    distinct = store(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    n = distinct.count()
    chosen = distinct.orderBy(F.xxhash64("first"), "node").limit(SAMPLE).select("vec").toArrow()
    sample = _matrix(chosen["vec"].combine_chunks()) if n else np.zeros((0, 1))
    layout = fit(sample, n, threshold)
    kind = distinct.schema["vec"].dataType.simpleString()
    nodes = distinct.mapInArrow(
        _locate(spark.sparkContext.broadcast(layout)),
        f"node bigint, first bigint, weight bigint, vec {kind}, ball int, angle double, "
        "others array<struct<ball:int,angle:double>>, shards array<int>",
    )
    nodes = store(nodes, "nodes")

    # balls
    members = nodes.filter("ball >= 0")
    balls = members.groupBy("ball").agg(
        F.sum("weight").alias("total"), F.max("angle").alias("radius"), F.min("node").alias("head")
    )
    balls = F.broadcast(balls)  # at most SAMPLE / DENSE rows
    inside = members.join(balls, "ball")
    counts = inside.select("node", (F.col("total") - F.col("weight")).alias("n"))
    edges = inside.select(F.col("node").alias("a"), F.col("head").alias("b"))
    across = members.select("node", "vec", F.inline("others"))
    across = across.join(balls, "ball").filter(F.col("angle") - F.col("radius") <= layout.theta + 1e-9)
    sure = F.col("angle") + F.col("radius") <= layout.theta - 1e-9
    whole = across.filter(sure)
    counts = counts.unionByName(whole.select("node", F.col("total").alias("n")))
    edges = edges.unionByName(whole.select(F.col("node").alias("a"), F.col("head").alias("b")))
    doubt = store(across.filter(~sure).select("ball", "node", "vec"), "doubt")
    if not doubt.isEmpty():
        found = store(_doubtful(doubt, members.select("ball", "node", "vec", "weight"), threshold), "doubt")
        counts = counts.unionByName(found.select("node", "n"))
        edges = edges.unionByName(found.select(F.col("node").alias("a"), "b"))

    # the graph
    placed, adjacency = graph(nodes.filter("ball < 0"))
    asked = nodes.select("node", "vec", F.explode("shards").alias("shard"))
    # a row for each of at most MOST_CENTRES shards
    parts = F.broadcast(_units(asked, "shard", QUERY_ROWS, "parts"))
    slices = F.broadcast(placed.groupBy("shard").agg(F.max("slices").alias("slices")))
    own = placed.join(parts, "shard").join(adjacency, "node").select(
        "shard", F.col("slice").cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(False).alias("asks"), "node", "vec", "near", "cosines",
    )
    asked = asked.join(parts, "shard").join(slices, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
        F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), F.lit(True).alias("asks"),
        "node", "vec", F.array().cast("array<bigint>").alias("near"),
        F.array().cast("array<double>").alias("cosines"),
    )
    both = own.unionByName(asked)
    both = both.select(F.xxhash64("shard", "slice", "part").alias("unit"), "asks", "node", "vec", "near", "cosines")
    met = both.repartition("unit").sortWithinPartitions("unit").mapInArrow(
        _search(threshold), "a bigint, b bigint, sure boolean"
    )
    met = store(met.groupBy("a", "b").agg(F.max("sure").alias("sure")), "met")
    pairs = met.filter("sure").select("a", "b")
    tried = met.filter("NOT sure").select("a", "b")
    if not tried.isEmpty():
        for c in ("a", "b"):
            tried = tried.join(nodes.select(F.col("node").alias(c), F.col("vec").alias("v" + c)), c)
        checked = tried.mapInArrow(_cosines, "a bigint, b bigint, cosine double")
        pairs = pairs.unionByName(checked.filter(F.col("cosine") >= threshold).select("a", "b"))
    return {"nodes": nodes, "pairs": store(pairs, "pairs"), "counts": counts, "edges": edges}


def _named(t: dict) -> DataFrame:
    """(vec, n_links, component_id) of the tables of ``link``."""
    nodes, pairs = t["nodes"], t["pairs"]
    weight = nodes.select("node", "weight")
    # a member of a ball never meets its own ball in the graph
    sides = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sides = sides.join(weight.withColumnRenamed("node", "b"), "b")
    counts = t["counts"].unionByName(sides.select(F.col("a").alias("node"), F.col("weight").alias("n")))
    counts = counts.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(t["edges"].unionByName(pairs))
    named = nodes.select("node", "first", "weight", "vec").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "root").join(counts, "node", "left")
    return named.select(
        "vec", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )


def near_copies(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95
) -> DataFrame:
    """Per row: the key, n_links, component_id and kept. A graph is built for each length of vectors."""
    parts = [_named(link(df, d, key, vector, threshold)) for d in lengths(df, key, vector) or [0]]
    named = reduce(DataFrame.unionByName, parts)
    out = df.select(F.col(key), F.col(vector).alias("vec")).join(named, "vec", "left")
    some = F.col(key).isNotNull()
    return out.select(
        key,
        F.when(some, F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
        F.when(some, F.coalesce("component_id", key)).alias("component_id"),
        (some & (F.coalesce("component_id", key) == F.col(key))).alias("kept"),
    )


def audit(
    df: DataFrame, linked: DataFrame, key: str = "vec_id", vector: str = "embedding",
    threshold: float = 0.95, queries: int = AUDIT,
) -> float:
    """Recall of ``linked`` (what ``near_copies`` returns for ``df``): links that it has of those that
    brute force finds for ``queries`` rows. They are drawn by hash from all valid rows, whatever was
    found for them; keys must be unique.
    """
    rows = df.filter(valid(key, vector))
    drawn = F.broadcast(rows.orderBy(F.xxhash64(key), key).limit(queries).select(key, F.col(vector).alias("vec")))
    asked = linked.join(drawn, key).select("n_links", "vec").toArrow()
    if not asked.num_rows:
        return 1.0
    vectors = asked["vec"].combine_chunks()
    size = pc.list_value_length(vectors).to_numpy()
    q = {int(d): _matrix(vectors.take(pa.array(np.flatnonzero(size == d)))) for d in np.unique(size)}
    shared = df.sparkSession.sparkContext.broadcast(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in batches:
            size = pc.list_value_length(b.column(0)).to_numpy()
            for d, x in shared.value.items():
                some = np.flatnonzero(size == d)
                if len(some):
                    n += int((x @ _matrix(b.column(0).take(pa.array(some))).T >= threshold).sum())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    total = rows.select(vector).mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0]
    links = total - asked.num_rows
    return sum(asked["n_links"].to_pylist()) / links if links > 0 else 1.0


@query("op9_robust_pruned_graph")
def op9_robust_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
