import numpy as np
import pyarrow as pa
import pytest

from tunewright.functions.vectors import from_matrix
from tunewright.operators import boxes, similarity_join
from tunewright.operators.similarity_join import HASH


def unit(x):
    n = np.linalg.norm(x, axis=1, keepdims=True)
    n[n == 0] = 1
    return x / n


def groups(n, dim=24, seed=0):
    """Close groups in four directions, some vectors anywhere, and a zero vector."""
    rng = np.random.default_rng(seed)
    x = np.eye(dim)[rng.integers(0, min(4, dim), n)] + rng.normal(size=(n, dim)) * rng.choice([0.02, 0.1, 1.0], (n, 1))
    x[5] = 0
    return unit(x)


@pytest.mark.parametrize("dim", [3, 24, 90])
def test_boxes_are_never_farther_than_their_members(dim):
    x = groups(600, dim)
    x[7] = np.nan
    turn = boxes.learn(x, 9)
    z = boxes.turned(x, turn.axes)
    real = np.delete(np.arange(600), 7)
    far = ((x[real, None] - x[None, real]) ** 2).sum(axis=2)
    turns = boxes.order(z, 40)
    assert sorted(turns) == list(range(600))
    for n in (2, dim):
        head = boxes.first_axes(z[turns], n)
        low, high = boxes.bounds(head, 40)
        gaps = boxes.apart(low[:, None], high[:, None], low, high)
        for a in range(15):
            for b in range(15):
                i, j = (np.searchsorted(real, np.setdiff1d(turns[40 * k : 40 * k + 40], 7)) for k in (a, b))
                assert gaps[a, b] <= far[np.ix_(i, j)].min() + 1e-9
        assert gaps.max() > 0.01
        # what is left of a vector bounds a product from above
        some = boxes.first_axes(z, n)[real]
        assert (some @ some.T >= x[real] @ x[real].T - 1e-9).all()
    assert len(np.bincount(turn.leaves(x))) == (turn.axis < 0).sum() > 4


@pytest.mark.parametrize("threshold", [-0.2, 0.2, 0.9, 0.999])
@pytest.mark.parametrize("same", [False, True])
def test_strips_of_packs_lose_no_pair(monkeypatch, threshold, same):
    """Few and many candidates, with axes that leave much of a vector."""
    monkeypatch.setattr(similarity_join, "STRIP", 32)
    monkeypatch.setattr(similarity_join, "HEAD", 6)
    x = groups(400)
    axes = boxes.learn(x, 4).axes
    sides = []
    for v in (x, x if same else groups(300, seed=3)):
        z = boxes.turned(v, axes)
        at = boxes.order(z, 32)
        head = from_matrix(boxes.first_axes(z[at], 6).astype(np.float32))
        guest = np.arange(len(v)) % 3 % 2
        sides.append((v[at], pa.table({"_v": pa.array(v[at].tolist()), "_guest": guest, "_head": head}), guest))
    (a, left, g), (b, right, h) = sides
    strips = list(similarity_join._near(left, right, threshold, same))
    got = [p for at, to, _ in strips for p in zip(at.tolist(), to.tolist(), strict=True)]
    want = (np.round(a @ b.T, 9) >= threshold) & ((g[:, None] & h) == 0)
    want = np.triu(want, 1) if same else want
    assert len(got) == len(set(got)) and set(got) == set(zip(*map(np.ndarray.tolist, np.nonzero(want)), strict=True))
    # a strip of the left side leaves at once
    assert len(strips) <= -(-len(a) // 32)


@pytest.mark.parametrize("threshold", [0.3, 0.98])
def test_packs_that_are_far_apart_do_not_meet(spark, monkeypatch, threshold):
    monkeypatch.setattr(similarity_join, "PACK", 64)
    monkeypatch.setattr(similarity_join, "BOX_ROWS", 100)
    monkeypatch.setattr(boxes, "LEAF_SAMPLE", 4)
    met = []
    meet = similarity_join._meet
    monkeypatch.setattr(similarity_join, "_meet", lambda *a: met.append(meet(*a)) or met[-1])
    # no root cells: all rows are one cell
    x = groups(900)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>")
    rows = similarity_join.unit_vectors(df, "id", "v", 42).localCheckpoint()
    pairs = similarity_join.edges(rows, 900, threshold, 32, 1).select("a", "b").collect()
    want = np.triu(np.round(x @ x.T, 9) >= threshold, 1).sum()
    assert len(pairs) == len(set(pairs)) == want and all(r.a < r.b for r in pairs)
    n = met[0].select("_id").distinct().count()
    assert n >= 14 and met[0].count() < n * n
    left, right = rows.filter(f"{HASH} < 'a'"), rows.filter(f"{HASH} >= 'a'")
    a, b = (t.orderBy(HASH).collect() for t in (left, right))
    near = np.round(np.array([r._v for r in a]) @ np.array([r._v for r in b]).T, 9) >= threshold
    hit = similarity_join.struck(left, 900, right, threshold, 32, 1).collect()
    assert sorted(r[HASH] for r in hit) == [r[HASH] for r, k in zip(a, near.any(axis=1), strict=True) if k]


def test_the_lower_hash_comes_first():
    """Also where hashes differ only at the end."""
    x = unit(np.random.default_rng(2).normal(size=(50, 3)))
    names = [f"{(i * 37) % 5:08x}{'0' * 20}{(i * 7) % 50:04x}" for i in range(50)]
    t = pa.table({"_v": pa.array(x.tolist()), "_guest": np.zeros(50, int), HASH: names})
    out = list(similarity_join._pairs(t, t, -1.0, True, HASH))
    a, b = ([v for batch in out for v in batch.column(k).to_pylist()] for k in (0, 1))
    assert len(set(zip(a, b, strict=True))) == len(a) == 50 * 49 // 2 and all(p < q for p, q in zip(a, b, strict=True))
