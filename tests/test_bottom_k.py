"""Bottom-k sketches against sorted hashes, and the samples that they give."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tunewright.operators import bottom_k, rank
from tunewright.operators import sample as sm


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(6)
    out = [(i, "hot" if rng.random() < 0.4 else rng.choice([None, "", "é", *map(str, range(30))])) for i in range(5000)]
    return spark.createDataFrame(out, "id long, s string").repartition(7)


@pytest.mark.parametrize(("k", "held"), [(1, 1 << 20), (7, 100), (1000, 1 << 20), (50, 1)])
def test_sketches(rows, k, held):
    """Also where a task gives its sketches out many times."""
    want = defaultdict(list)
    for r in rows.select("s", rank.order_hash("id", 3).alias("h")).collect():
        want[r.s].append(r.h)
    got = {r._s: (r._size, r._low) for r in bottom_k.sketches(rows, "s", "id", 3, k, held).collect()}
    assert {s: n for s, (n, _) in got.items()} == {s: len(h) for s, h in want.items()}
    for s, h in want.items():
        if s is not None:
            assert got[s][1] == sorted(h)[:k]


@pytest.mark.parametrize("n", [60, 100, 1000])
def test_same_sample_as_by_counts(rows, n, monkeypatch):
    ids = lambda: sorted(r.id for r in sm.stratified_n(rows, n, "s", "id", 5).collect())
    found = ids()
    monkeypatch.setattr(bottom_k, "MOST", 0)
    assert found == ids()


def test_one_pass_of_the_keys(rows):
    plan = bottom_k.sketches(rows, "s", "id", 3, 9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Window" not in plan


@pytest.mark.parametrize("kind", ["double", "date", "boolean", "decimal(9,2)", "timestamp", "binary"])
def test_kinds_of_strata(spark, kind):
    d = spark.range(200).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("s"))
    s = F.date_add(F.lit("2024-01-01").cast("date"), F.col("s").cast("int")) if kind in ("date", "timestamp") else F.col("s")
    s = s.cast("string") if kind == "binary" else s
    d = d.withColumn("s", s.cast(kind))
    got = bottom_k.sketches(d, "s", "id", 1, 3).collect()
    assert sorted(r._size for r in got) == [40, 80, 80]
    assert sm.stratified_n(d, 10, "s", "id").count() == 10


def test_odd_doubles_and_no_rows(spark):
    d = spark.createDataFrame([(i, v) for i, v in enumerate([float("nan"), 0.0, -0.0] * 4)], "id long, s double")
    assert sorted(r._size for r in bottom_k.sketches(d, "s", "id", 1, 3).collect()) == [4, 8]
    assert sm.stratified_n(d.limit(0), 5, "s", "id").collect() == []


def test_nested_strata_go_by_counts(spark):
    d = spark.range(20).select("id", F.array(F.col("id") % 2).alias("s"))
    assert not bottom_k.fits(d, "s", 5)
    assert sm.stratified_n(d, 6, "s", "id").count() == 6
