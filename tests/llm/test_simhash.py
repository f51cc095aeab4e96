import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tunewright.llm import simhash as S
from tunewright.llm.components import components


def slow_fp(text):
    w = (text or "").encode().lower().split()
    parts = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << i for i in range(64) if sum(x >> i & 1 for x in h) * 2 > len(h))


def slow_components(ids, fps, distance=3):
    root = list(range(len(ids)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(len(ids)):
        groups[top(i)].append(i)
    return [min((ids[k] for k in groups[top(i)] if ids[k] is not None), default=None) for i in range(len(ids))]


def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)] + ["É", "THE"]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    out = [" ".join(say(rng.randrange(400))) for _ in range(150)]
    base = say(900)
    for _ in range(150):
        w = list(base)
        w[rng.randrange(900)] = rng.choice(words)
        out.append("\n ".join(w))
    return [*out, *out[:20], "", None, " \t", "a", "A  b", "a b", "x" * 300_000, "one two three"]


def test_fingerprints_equal_the_definition():
    t = corpus() + ["q " * 5000 + "z"]
    assert S.fingerprints(pa.array(t)).tolist() == [slow_fp(x) for x in t]


@pytest.mark.parametrize("cell_rows", [4096, 10])
def test_components_equal_brute_force(spark, cell_rows):
    t = corpus()
    ids = list(range(1000, 1000 + len(t)))
    df = spark.createDataFrame(
        [(i, x, "clash") for i, x in zip(ids, t, strict=True)], "doc_id long, text string, component_id string"
    )
    got = {r.doc_id: r for r in S.near_copies(df.repartition(3), cell_rows=cell_rows).collect()}
    fps = [slow_fp(x) for x in t]
    assert [got[i].fingerprint for i in ids] == [f"{f:016x}" for f in fps]
    assert [got[i].component_id for i in ids] == slow_components(ids, fps)


def test_links_of_dense_cells(spark):
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 2**64, 6, dtype=np.uint64)
    fps = []
    for c in centre:
        for _ in range(120):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 8)):
                x ^= np.uint64(1) << np.uint64(b)
            fps.append(x)
    fps = np.unique(np.array([*fps, 0, 1, 2**63, 2**64 - 1], np.uint64))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "_fp long")
    want = slow_components(list(range(len(fps))), [int(x) for x in fps])
    for cell_rows in (4096, 50, 5):
        found = components(S.link_fingerprints(df, 3, cell_rows)).collect()
        root = {r.node: r.root for r in found}
        mine = defaultdict(list)
        for i, x in enumerate(fps.view(np.int64).tolist()):
            mine[root.get(x, x)].append(i)
        got = [0] * len(fps)
        for m in mine.values():
            for i in m:
                got[i] = min(m)
        assert got == want


def test_gray_rank():
    x = np.arange(1000, dtype=np.uint64)
    assert (S.gray_rank(x ^ (x >> np.uint64(1))) == x).all()


def test_dedup_nulls_copies_and_empty(spark):
    rows = [(3, "a b c d"), (1, "A b c d"), (1, "A b c d"), (None, "a b c d"), (None, "q"), (7, "other words here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in S.dedup(df).collect()), key=str)
    assert got == [(1, "A b c d"), (7, "other words here"), (None, "a b c d"), (None, "q")]
    assert S.near_copies(df.limit(0)).count() == 0 and S.dedup(df.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(501, 900)] + [(7, 7)]
    rng = random.Random(1)
    rng.shuffle(path)
    df = spark.createDataFrame([(b, a) for a, b in path], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 500 for i in range(500, 900)}
