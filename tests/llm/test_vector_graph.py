import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tunewright.llm import vector_graph as G
from tunewright.llm.components import Union


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def brute(ids, x, threshold=0.95):
    x = unit(np.asarray(x, float))
    hit = x @ x.T >= threshold
    u = Union(len(x))
    a, b = np.nonzero(hit)
    order = np.argsort(ids, kind="stable")
    place = np.argsort(order)
    u.add(place[a], place[b])
    return hit.sum(axis=1) - 1, np.asarray(ids)[order][u.root[place]]


def world(seed, d=24):
    """Noise, small groups, two large near groups, and two groups at about the threshold's angle."""
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=(700, d))]
    for _ in range(25):
        parts.append(rng.normal(size=(1, d)) + 0.12 * rng.normal(size=(rng.integers(2, 7), d)))
    for _ in range(2):
        parts.append(3 * rng.normal(size=(1, d)) + 0.1 * rng.normal(size=(150, d)))
    a = unit(rng.normal(size=(1, d)))
    b = unit(rng.normal(size=(1, d)))
    b = unit(b - (a @ b.T) * a)
    tilt = np.arccos(0.95)
    parts.append(a + 0.01 * rng.normal(size=(80, d)))
    parts.append(np.cos(tilt) * a + np.sin(tilt) * b + 0.01 * rng.normal(size=(80, d)))
    parts.append(np.repeat(parts[0][:1], 60, axis=0))
    return np.concatenate(parts).astype(np.float32)


@pytest.mark.parametrize("small", [False, True])
def test_links_equal_brute_force(spark, small, monkeypatch):
    if small:
        monkeypatch.setattr(G, "SLICE_ROWS", 60)
        monkeypatch.setattr(G, "QUERY_ROWS", 50)
        monkeypatch.setattr(G, "SAMPLE", 400)
    x = world(3)
    ids = np.random.default_rng(0).permutation(len(x)) + 10
    want_n, want_c = brute(ids, x)
    rows = [(int(i), v.tolist(), 5) for i, v in zip(ids, x, strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int").repartition(4)
    out = G.near_copies(df)
    got = {r.vec_id: r for r in out.collect()}
    assert len(got) == len(x)
    n = np.array([got[int(i)].n_links for i in ids])
    # vectors within rounding of the threshold aside, nothing is found that is no link
    assert n.sum() >= 0.99 * want_n.sum() and (n <= want_n).all()
    same = np.mean([got[int(i)].component_id == c for i, c in zip(ids, want_c, strict=True)])
    assert same > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert G.audit(df.drop("n_links"), out) > 0.98


def test_doubtful_balls_are_compared_one_by_one(spark):
    rng = np.random.default_rng(8)
    d = 16
    a = np.eye(d)[:1]
    tilt = np.arccos(0.95)
    b = np.cos(tilt) * a + np.sin(tilt) * np.eye(d)[1:2]
    x = np.concatenate([a + 0.03 * rng.normal(size=(120, d)), b + 0.03 * rng.normal(size=(120, d))])
    want_n, want_c = brute(np.arange(len(x)), x)
    assert 120 < want_n.mean() < 230
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in G.near_copies(df).collect()}
    assert [got[i] for i in range(len(x))] == list(zip(want_n.tolist(), want_c.tolist(), strict=True))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [1e-200, 1e-210]),
        (11, [1e200, 0.0]), (12, [-1.0, 0.0]), (13, [0.95, (1 - 0.95**2) ** 0.5 - 1e-6]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = G.near_copies(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert by[1] == [(5, 1, True)] and by[2] == [(5, 1, False)] * 2 and by[10] == [(5, 1, False)]
    assert by[11] == [(5, 1, False)] and by[13] == [(5, 1, False)]
    for i in (3, 4, 5, 6, 7, 8, 9, 12):
        assert by[i] == [(0, i, True)]
    assert by[None] == [(0, None, False)]
    assert G.near_copies(df.limit(0)).count() == 0
    assert {r.n_links for r in G.near_copies(df.filter("vec_id = 3")).collect()} == {0}


def test_vectors_of_several_lengths(spark):
    """As many as there are: each length links among itself, the rarer ones too."""
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for d, n in ((3, 40), (2, 25), (7, 1)):
        x = unit(rng.normal(size=(n, d)))
        x[n // 2 :] = x[: n - n // 2]
        ids = np.arange(n) + 100 * d
        found = brute(ids, x)
        want |= {int(i): (int(a), int(c)) for i, a, c in zip(ids, *found, strict=True)}
        rows += [(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)]
    rows += [(1, None), (2, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    out = G.near_copies(df)
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    assert got == want | {1: (0, 1), 2: (0, 2)}
    assert G.audit(df, out) == 1.0
    # links that were lost of rows without any link left lower the recall
    assert G.audit(df, out.withColumn("n_links", F.when(F.col("vec_id") < 300, 0).otherwise(F.col("n_links")))) < 0.9


def test_pruned_graph_is_searched_whole():
    rng = np.random.default_rng(5)
    x = unit(rng.normal(size=(600, 16)))
    x[300:360] = unit(x[300] + 0.05 * rng.normal(size=(60, 16)))
    lists = G.prune(x @ x.T)
    assert max(map(len, lists)) <= 2 * G.DEGREE and min(map(len, lists)) > 0
    near = G._padded(np.repeat(np.arange(600), [len(v) for v in lists]), np.concatenate(lists), 600)
    q, n = G.search(x, near, x, 0.95)
    found = set(zip(q.tolist(), n.tolist(), strict=True))
    want = set(zip(*map(np.ndarray.tolist, np.nonzero(x @ x.T >= 0.95)), strict=True))
    assert len(found) == len(q) and found <= want and len(found) > 0.99 * len(want)


def test_matrix():
    m = G._matrix(pa.array([[3.0, 4.0], [1e300, 0.0]]))
    assert m.tolist() == [[0.6000000000000001, 0.8], [1.0, 0.0]] or np.allclose(m, [[0.6, 0.8], [1, 0]])
