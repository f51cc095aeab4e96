import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tunewright.operators import diversity, guard, near_dup, nearest, similarity_join
from tunewright.operators.diversity import diverse_n
from tunewright.session import cut_lineage


def unit(x):
    n = np.linalg.norm(x, axis=1, keepdims=True)
    n[n == 0] = 1
    return x / n


def sims(x):
    u = unit(x)
    return np.round(u @ u.T, 9)


def greedy(x, order, threshold):
    s, kept = sims(x), []
    for i in order:
        if all(s[i, k] < threshold for k in kept):
            kept.append(i)
    return sorted(kept)


def farthest(x, order, n):
    s, picks = sims(x), [order[0]]
    while len(picks) < n:
        best = {i: max(s[i, p] for p in picks) for i in order if i not in picks}
        picks.append(min(best, key=lambda i: (best[i], order.index(i))))
    return picks


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95])
@pytest.mark.parametrize("shape", [(4096, 4096, 16), (16, 32, 0), (1, 64, 1e9)])
def test_near_dup_equals_the_sequential_rule(vectors, seeded, threshold, shape, monkeypatch):
    """On the driver, by doubling prefixes, and all at once after the first row."""
    df, x = vectors
    first, block, linear = shape
    monkeypatch.setattr(near_dup, "SMALL", 1)
    out = near_dup.near_dup(df, "id", "v", threshold, 42, first, block, linear)
    expected = greedy(x, seeded(range(len(x))), threshold)
    assert sorted(r.id for r in out.collect()) == expected


def test_near_dup_limits(vectors):
    df, x = vectors
    assert near_dup.near_dup(df, "id", "v", 1.5).count() == len(x)
    # copies are dropped at threshold 1, the zero vectors are not copies of each other
    assert near_dup.near_dup(df, "id", "v", 1.0).count() == 260 + 2


@pytest.mark.parametrize("block", [4096, 40])
@pytest.mark.parametrize("threshold", [0.3, 0.9, 0.97])
def test_similar_pairs_find_every_pair(vectors, seeded, threshold, block):
    df, x = vectors
    out = similarity_join.similar_pairs(df, "id", "v", threshold, block=block).collect()
    place = {i: n for n, i in enumerate(seeded(range(len(x))))}
    s = sims(x)
    # copies of row 0 (ids 260..349) are listed apart
    group = sorted([0, *range(260, 350)], key=place.get)
    first, others = group[0], set(group[1:])
    copies = similarity_join.vector_copies(df, "id", "v").collect()
    assert sorted((r.a_id, r.b_id) for r in copies) == sorted((first, i) for i in others)
    expected = set()
    rest = [i for i in range(len(x)) if i not in others]
    for a in rest:
        for b in rest:
            if place[a] < place[b] and s[a, b] >= threshold:
                expected.add((a, b))
    assert {(r.a_id, r.b_id) for r in out} == expected
    assert len(out) == len(expected)


@pytest.mark.parametrize("threshold", [0.95, 0.999999, 1.0])
def test_cells_lose_no_pair_near_the_threshold(spark, threshold):
    angle = np.arange(1200) * 1e-5
    x = np.stack([np.cos(angle), np.sin(angle)], axis=1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>")
    df = df.filter("id < 300") if threshold < 0.999 else df
    one = similarity_join.similar_pairs(df, "id", "v", threshold, block=4096).collect()
    cells = similarity_join.similar_pairs(df, "id", "v", threshold, block=60).collect()
    assert len(one) > 1000 and set(one) == set(cells) and len(one) == len(cells)


def test_tiny_blocks_and_no_anchors(vectors):
    df, _ = vectors
    some = df.filter("id < 30")
    one = similarity_join.similar_pairs(some, "id", "v", 0.3)
    assert set(similarity_join.similar_pairs(some, "id", "v", 0.3, block=2).collect()) == set(one.collect())
    none = guard.scope_scores(some, "id", "v", df.limit(0), "v").collect()
    assert len(none) == 30 and {r.max_cosine for r in none} == {None}
    twice = some.unionByName(some.filter("id = 3"))
    for limit in (4096, 5):
        out = guard.scope_scores(twice, "id", "v", df.filter("id < 40"), "v", limit, 7).collect()
        assert len(out) == 31 and len({round(r.max_cosine, 9) for r in out if r.id == 3}) == 1


def clustered(n, seed=0):
    """Groups of about 20 close vectors, in 12 directions."""
    rng = np.random.default_rng(seed)
    a = unit(rng.normal(size=(12, 24)))
    groups = n // 240 + 1
    b = unit(np.repeat(a, groups, axis=0) + rng.normal(size=(12 * groups, 24)) * 0.12)
    return unit(b[rng.integers(0, len(b), n)] + rng.normal(size=(n, 24)) * 0.004)


def rows_of(spark, x):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>")
    return cut_lineage(similarity_join.unit_vectors(df, "id", "v", 42))


@pytest.mark.parametrize("root_cells", [24, 2048])
def test_the_tree_of_pivots_loses_no_pair_and_looks_at_few(spark, root_cells):
    """One level, and several where the first may only have 24 cells."""
    looked, depth = [], []
    for n in (900, 3600):
        x = clustered(n)
        rows = rows_of(spark, x)
        cells = similarity_join.cells_for(rows, n, 0.98, 48, root_cells)
        looked.append(cells.pairs() / n)
        depth.append(max(r._cell.count(".") for r in cells.members.select("_cell").collect()))
        pairs = similarity_join.edges(rows, n, 0.98, 48, root_cells).select("a", "b").collect()
        assert len(pairs) == len(set(pairs)) == int((np.triu(sims(x), 1) >= 0.98).sum())
        assert all(r.a < r.b for r in pairs)
    # of 450 and 1,800 pairs per row
    assert max(looked) < 120 and looked[1] < 3 * looked[0]
    assert max(depth) >= (1 if root_cells == 24 else 0)


def test_a_group_that_no_pivot_splits_stays_whole(spark):
    """Three quarters of the rows within the limit of each other: cells for the others, blocks for these."""
    rng = np.random.default_rng(4)
    ball = unit(np.eye(24)[:1] + rng.normal(size=(600, 24)) * 0.002)
    x = np.vstack([ball, clustered(200)])
    rows = rows_of(spark, x)
    pairs = similarity_join.edges(rows, 800, 0.98, 32, 16).select("a", "b").collect()
    assert len(pairs) == len(set(pairs)) == int((np.triu(sims(x), 1) >= 0.98).sum())


def shuffled_values(df):
    """Columns of the plan's exchanges."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange" in line]


@pytest.mark.parametrize("threshold", [0.2, 0.98])
def test_packs_of_large_cells_lose_no_pair(spark, monkeypatch, threshold):
    """One cell of all rows, and large cells beside small ones; members are not shuffled for what they meet."""
    monkeypatch.setattr(similarity_join, "PACK", 40)
    rng = np.random.default_rng(4)
    ball = unit(np.eye(24)[:1] + rng.normal(size=(300, 24)) * 0.002)
    x = np.vstack([ball, clustered(300)])
    rows = rows_of(spark, x)
    pairs = similarity_join.edges(rows, len(x), threshold, 16, 16)
    if threshold < 0.9:
        assert not shuffled_values(pairs)
    got = [(r.a, r.b) for r in pairs.collect()]
    assert len(got) == len(set(got)) == int((np.triu(sims(x), 1) >= threshold).sum())
    left, right = rows.filter("_order_hash < 'a'"), rows.filter("_order_hash >= 'a'")
    names = {r._order_hash for r in left.collect()}
    want = {h for a, b in got for h, other in ((a, b), (b, a)) if h in names and other not in names}
    hit = similarity_join.struck(left, len(x), right, threshold, 16, 16).collect()
    assert sorted(r._order_hash for r in hit) == sorted(want) and want


@pytest.mark.parametrize("dim", [1, 3, 700])
def test_single_precision_loses_no_pair(dim, monkeypatch):
    """Cosines within 1e-9 of the threshold on both sides, few and many in a strip."""
    monkeypatch.setattr(similarity_join, "GATHER", 1000)
    rng = np.random.default_rng(dim)
    x = unit(rng.normal(size=(600, dim)))
    y = unit(x + rng.normal(size=x.shape) * 1e-4)
    a, b = (pa.table({"_v": pa.array(v.tolist()), "_guest": np.zeros(len(v), np.int32)}) for v in (x, y))
    exact = np.round(x @ y.T, 9)
    for t in (-0.1, 1.0, float(np.diag(exact)[5]), float(np.diag(exact)[5]) + 1e-9, *np.quantile(exact, [0.5, 0.997])):
        got = [tuple(p) for at, to, _ in similarity_join._near(a, b, t) for p in zip(at.tolist(), to.tolist(), strict=True)]
        seen = np.zeros(exact.shape, bool)
        seen[tuple(np.array(got, int).reshape(-1, 2).T)] = True
        # halves of the ninth decimal may be summed to either side
        half = np.abs(np.abs(x @ y.T - t) - 5e-10) < 1e-13
        assert len(got) == len(set(got)) and ((seen == (exact >= t)) | half).all()


def test_pairs_of_repeated_and_null_keys(spark):
    """A pair comes once for each row that has its keys, of any type and name."""
    rows = [("x", 1, [1.0, 0.0]), ("x", 1, [1.0, 0.0]), (None, 2, [1.0, 0.01]), (None, 2, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "`k.1` string, n int, v array<double>").withColumnRenamed("k.1", "k")
    got = similarity_join.similar_pairs(df, ["k", "n"], "v", 0.9).collect()
    assert len(got) == 2 * 2 and {frozenset([(r.a_k, r.a_n), (r.b_k, r.b_n)]) for r in got} == {
        frozenset([("x", 1), (None, 2)])
    }


@pytest.mark.parametrize("block", [4096, 24])
def test_struck_rows_are_those_near_another_table(spark, block):
    x = clustered(700)
    x[::50] = unit(np.random.default_rng(1).normal(size=(14, 24)))
    rows = rows_of(spark, x)
    left, right = rows.filter("_order_hash < 'a'"), rows.filter("_order_hash >= 'a'")
    out = similarity_join.struck(left, 700, right, 0.98, block, 16).collect()
    a, b = (t.orderBy("_order_hash").collect() for t in (left, right))
    near = np.round(np.array([r._v for r in a]) @ np.array([r._v for r in b]).T, 9) >= 0.98
    want = [r._order_hash for r, hit in zip(a, near.any(axis=1), strict=True) if hit]
    assert sorted(r._order_hash for r in out) == want and 0 < len(want) < len(a)


def test_prefixes_double_until_pairs_are_linear(spark, seeded, monkeypatch):
    """Two dense groups that hold most rows: prefixes are cut while they have many pairs."""
    rng = np.random.default_rng(2)
    ball = unit(np.repeat(np.eye(8)[:2], 450, axis=0) + rng.normal(size=(900, 8)) * 0.2)
    x = np.vstack([ball, unit(rng.normal(size=(100, 8)))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>")
    rows = rows_of(spark, x)
    exact = (np.triu(sims(x), 1) >= 0.9).sum() / 1000
    assert near_dup.pairs_per_row(rows, 1000, 0.9) == pytest.approx(exact, rel=0.2)
    sizes = []
    real = near_dup.edges
    monkeypatch.setattr(near_dup, "edges", lambda r, n, *a: sizes.append(n) or real(r, n, *a))
    monkeypatch.setattr(near_dup, "SMALL", 1)
    out = near_dup.near_dup(df, "id", "v", 0.9, 42, 8, 64, 4)
    assert sorted(r.id for r in out.collect()) == greedy(x, seeded(range(1000)), 0.9)
    assert len(sizes) > 1 and sum(sizes) < 900


def test_greedy_rows_in_batches(vectors):
    _, x = vectors
    for t in (0.5, 0.95):
        assert near_dup.greedy_rows(unit(x), t, 7).tolist() == near_dup.greedy_batch(unit(x), t).tolist()


def test_no_rows_and_one(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0])], "id int, v array<double>")
    for rows, n in ((df, 1), (df.limit(0), 0)):
        assert near_dup.near_dup(rows, "id", "v", 0.9).count() == n
        assert similarity_join.similar_pairs(rows, "id", "v", 0.9).count() == 0


@pytest.mark.parametrize(("candidates", "tree"), [(999, 10**9), (7, 10**9), (50, 0)])
def test_farthest_points_are_exact(vectors, seeded, candidates, tree, monkeypatch):
    monkeypatch.setattr(diversity, "TREE_ROWS", tree)
    df, x = vectors
    out = diverse_n(df, 30, "id", "v", pick_column="p", candidates=candidates).collect()
    got = [r.id for r in sorted(out, key=lambda r: r.p)]
    assert got == farthest(x, seeded(range(len(x))), 30)


@pytest.mark.parametrize("fold", [4096, 5])
@pytest.mark.parametrize("spread", [0.1, 3.0])
def test_cells_that_cannot_hold_the_next_pick_stay_closed(spark, seeded, monkeypatch, fold, spread):
    """Groups far apart, and vectors without groups; with folds, and without."""
    monkeypatch.setattr(diversity, "CELL_ROWS", 100)
    monkeypatch.setattr(diversity, "CELLS", 40)
    monkeypatch.setattr(diversity, "OPEN_ROWS", 20)
    monkeypatch.setattr(diversity, "FOLD", fold)
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(40, 12)), 15, axis=0) + rng.normal(size=(600, 12)) * spread
    x[7] = x[8] = x[300]
    x[9] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>")
    opened, written = [], []
    opens, stores = diversity.Cells.open, diversity.store

    def count(self, *a):
        out = opens(self, *a)
        opened.append(self.rows[out].sum())
        return out

    monkeypatch.setattr(diversity.Cells, "open", count)
    monkeypatch.setattr(diversity, "store", lambda d, name: written.append(d.columns) or stores(d, name))
    out = diverse_n(df, 60, "id", "v", pick_column="p", candidates=9).collect()
    got = [r.id for r in sorted(out, key=lambda r: r.p)]
    assert got == farthest(x, seeded(range(600)), 60)
    if spread < 1:
        # until each group has a pick, those that have one stay closed
        assert min(opened) < 120 and np.mean(opened) < 500
    # the rows, the rows by cell, and folds: no pass writes vectors
    assert len(written) == 2 if fold > 60 else 2 < len(written) < len(opened)


def test_farthest_points_of_all_rows(vectors):
    df, x = vectors
    out = diverse_n(df, 1000, "id", "v", pick_column="p")
    assert out.count() == len(x)
    assert diverse_n(df, 1000, "id", "v").count() == len(x)


def test_scope_scores_of_large_anchor_tables(spark, vectors):
    df, x = vectors
    anchors = df.filter("id < 40")
    small = {r.id: r.max_cosine for r in guard.scope_scores(df, "id", "v", anchors, "v").collect()}
    large = {r.id: r.max_cosine for r in guard.scope_scores(df, "id", "v", anchors, "v", 5).collect()}
    expected = (unit(x) @ unit(x[:40]).T).max(axis=1)
    for i, e in enumerate(expected):
        assert small[i] == pytest.approx(e) and large[i] == pytest.approx(e)


@pytest.mark.parametrize("part_rows", [65_536, 30])
def test_nearest_anchors_of_many(spark, part_rows):
    """Questions near anchors, far from all, equal to one, null and zero; anchors with copies and zeros."""
    rng = np.random.default_rng(8)
    y = np.vstack([clustered(500, 1), np.zeros((1, 24))])
    x = np.vstack([clustered(300, 1)[::3], unit(rng.normal(size=(80, 24))), y[:20], -y[:9], np.zeros((2, 24))])
    rows = [(i % 150, v.tolist()) for i, v in enumerate(x)] + [(7, None), (None, y[3].tolist())]
    df = spark.createDataFrame(rows, "id int, v array<double>").repartition(3)
    anchors = spark.createDataFrame([(v.tolist(),) for v in [*y, *y[:30]]], "a array<double>")
    for given, zero in ((anchors, 0.0), (anchors.filter("aggregate(a, 0D, (s, e) -> s + abs(e)) > 0"), -1.0)):
        out = nearest.max_cosine_join(df, "id", "v", given, "a", 16, part_rows).collect()
        want = [(i, None if v is None else 0.0 if not any(v) else max(zero, (y[:500] @ np.array(v)).max())) for i, v in rows]
        got = sorted(((r.id, None if r.max_cosine is None else round(r.max_cosine, 9)) for r in out), key=str)
        assert got == sorted(((i, None if m is None else round(float(m), 9)) for i, m in want), key=str)


def test_bounds_leave_anchors_unread():
    y = clustered(5000, 1)
    centre = y[0]
    far = np.arccos(np.clip(y @ centre, -1, 1))
    x = unit(centre + np.random.default_rng(3).normal(size=(40, 24)) * 0.001)
    top, seen = nearest.best_of(x, np.arccos(np.clip(x @ centre, -1, 1)), y, far)
    assert np.allclose(top, (x @ y.T).max(axis=1)) and seen < 3000


def test_embedder_factory_runs_per_task(spark):
    from tunewright.functions import embed as em

    def factory():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("ab",), (None,)], "t string").select(em.embed(F.col("t"), factory).alias("v"))
    assert sorted(r.v for r in df.collect()) == [[0.0, 1.0], [2.0, 1.0]]
