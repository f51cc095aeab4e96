"""Last writes as the state of a stream, against the batch."""

import math
import random
from functools import partial

import pytest

from tunewright.operators import track
from tunewright.streaming import state

HISTORY = "run_id string, key string, value double, step bigint, ts double, seq bigint"


@pytest.fixture()
def fed(spark, tmp_path):
    """Streams batches of rows, one file each, and gives the rows emitted by each batch."""

    def feed(batches):
        folder, emitted = str(tmp_path / "in"), []
        for rows in batches:
            spark.createDataFrame(rows, HISTORY).coalesce(1).write.mode("append").parquet(folder)
            stream = spark.readStream.schema(HISTORY).parquet(folder)
            changes = state.metric_changes(stream)
            out = []
            changes.writeStream.outputMode("update").foreachBatch(
                lambda b, _, out=out: out.extend(b.collect())
            ).option("checkpointLocation", str(tmp_path / "offsets")).trigger(
                availableNow=True
            ).start().awaitTermination()
            emitted.append(out)
        return emitted

    return feed


def test_late_repeated_and_odd_rows(fed):
    nan, big = float("nan"), (1 << 62) + 1
    first, second, third = fed(
        [
            [
                ("r", "loss", 1.0, 5, 10.0, 1),
                ("r", "loss", 2.0, 5, 10.0, 2),
                ("r", "loss", nan, 6, 1.0, 1),
                ("r", "loss", 3.0, 5000, None, None),
                (None, None, 4.0, None, 1.0, big),
                ("r", "acc", 5.0, -1, nan, 1),
            ],
            [
                ("r", "loss", 9.0, 5, 9.0, 99),  # late
                ("r", "loss", 2.0, 5, 10.0, 2),  # again
                ("r", "loss", 7.0, 5000, -1e9, None),
                (None, None, 6.0, -1, 1.0, big + 1),
                ("r", "acc", 8.0, -1, 1e300, 5),  # below NaN
            ],
            [("r", "loss", 0.5, 6, 1.0, 2), ("s", "loss", 0.5, 6, 1.0, 2)],
        ]
    )
    by = lambda rows: {(r.run_id, r.key, r.step): (r.value, r.ts, r.seq) for r in rows}
    a, b, c = by(first), by(second), by(third)
    assert len(first) == 5 and a["r", "loss", 5] == (2.0, 10.0, 2)
    assert math.isnan(a["r", "loss", 6][0]) and a["r", "loss", 5000] == (3.0, None, None)
    assert a[None, None, -1] == (4.0, 1.0, big) and math.isnan(a["r", "acc", -1][1])
    assert b == {("r", "loss", 5000): (7.0, -1e9, None), (None, None, -1): (6.0, 1.0, big + 1)}
    assert c == {("r", "loss", 6): (0.5, 1.0, 2), ("s", "loss", 6): (0.5, 1.0, 2)}


def test_table_equals_the_batch(spark, tmp_path):
    """A hot run and a hot step, overlapping batches, a restart, and a batch replayed by another stream."""
    rng = random.Random(3)
    rows = [
        (
            "hot" if rng.random() < 0.4 else f"r{rng.randrange(20)}",
            rng.choice(["loss", "acc"]),
            rng.random(),
            -1 if rng.random() < 0.3 else rng.randrange(3000),
            float(rng.randrange(50)),
            i,
        )
        for i in range(6000)
    ]
    history = spark.createDataFrame(rows, HISTORY)
    folder, target = str(tmp_path / "in"), str(tmp_path / "current")

    def go(offsets, **options):
        stream = spark.readStream.schema(HISTORY).option("maxFilesPerTrigger", 2).parquet(folder)
        q = state.keep_current(state.metric_changes(stream), target, str(tmp_path / offsets), parts=4, **options)
        q.awaitTermination()

    history.filter("seq > 2500").repartition(3).write.mode("append").parquet(folder)
    go("offsets")
    history.filter("seq < 3500").repartition(3).write.mode("append").parquet(folder)
    go("offsets")
    want = {tuple(r) for r in track.current(history, state.KEYS).collect()}
    read = lambda: spark.read.parquet(f"{target}/rows").select("run_id", "key", "value", "step", "ts", "seq")
    assert {tuple(r) for r in read().collect()} == want and read().count() == len(want)
    go("offsets again", source="again")
    assert {tuple(r) for r in read().collect()} == want and read().count() == len(want)


def test_empty_batch(fed):
    assert fed([[], [("r", "k", 1.0, None, None, None)]])[1][0].step == -1


@pytest.mark.parametrize("buckets", [1, 5])
def test_many_runs_in_one_state(fed, monkeypatch, buckets):
    """Null and other runs and keys, of the same steps, stay apart, and only changes are emitted."""
    monkeypatch.setattr(state, "metric_changes", partial(state.metric_changes, buckets=buckets))
    names = [(r, k) for r in ("a", "b", "", None) for k in ("x", "", None)]
    rows = [(r, k, float(i), i, 1.0, i) for r, k in names for i in (-1, 0, 1, 2000)]
    later = [(r, k, 9.0, 1, 0.5 if r == "a" else 2.0, 1) for r, k in names]
    first, second = fed([rows, rows + later])
    got = lambda out: sorted(map(repr, ((r.run_id, r.key, r.value, r.step, r.ts, r.seq) for r in out)))
    assert got(first) == sorted(map(repr, rows))
    assert got(second) == sorted(repr(r) for r in later if r[0] != "a")
