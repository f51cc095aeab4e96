"""Current metrics kept by a stream: the last write of each metric and step is the state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tunewright.operators import track
from tunewright.session import store
from tunewright.sources import sinks

KEYS = ("run_id", "key", "step")
# steps of a metric that stay together
_STEPS = 1024
BUCKETS = 1 << 14  # states, however many runs there are; fixed for the life of a checkpoint
_LOWEST = -(1 << 63)
_ROW = "value double, ts double, seq bigint"
_STATE = "runs array<string>, keys array<string>, steps array<bigint>, ts array<double>, seq array<bigint>"
_KINDS = ("O", "O", "i8", "f8", "i8")


def _last_of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per key of each batch, so a key that fills the input does not fill the shuffle."""
    for rows in batches:
        yield rows.sort_values(["_ts", "_seq"], kind="stable").drop_duplicates(
            list(KEYS), keep="last"
        )


def _last_writes(
    key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    given = state.get if state.exists else ((),) * len(_KINDS)
    runs, keys, steps, ts, seq = (np.array(a, d) for a, d in zip(given, _KINDS, strict=True))
    rows = np.empty(len(steps), object)  # None: the row was emitted by an earlier batch
    for b in batches:
        old = np.arange(len(steps) + len(b)) < len(steps)
        runs = np.concatenate([runs, b["run_id"].to_numpy(object)])
        keys = np.concatenate([keys, b["key"].to_numpy(object)])
        steps = np.concatenate([steps, b["step"].to_numpy("i8")])
        ts = np.concatenate([ts, b["_ts"].to_numpy("f8")])
        seq = np.concatenate([seq, b["_seq"].to_numpy("i8")])
        rows = np.concatenate([rows, b["_row"].to_numpy(object)])
        run, name = (pd.factorize(a, use_na_sentinel=False)[0] for a in (runs, keys))
        # of equal writes the known one stands
        by = np.lexsort((old, seq, ts, steps, name, run))
        other = [a[by][1:] != a[by][:-1] for a in (run, name, steps)]
        last = by[np.append(np.any(other, axis=0), True)]
        runs, keys, steps, ts, seq, rows = (a[last] for a in (runs, keys, steps, ts, seq, rows))
    state.update(tuple(a.tolist() for a in (runs, keys, steps, ts, seq)))
    new = np.array([r is not None for r in rows], bool)
    if new.any():
        yield pd.DataFrame({"run_id": runs[new], "key": keys[new], "step": steps[new], "_row": rows[new]})


def metric_changes(history: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """A stream of metric history rows as a stream of changes: each row that became the last write
    of its ``(run_id, key, step)`` by ``(ts, seq)``, to be written in update mode.

    Late and repeated rows emit nothing. A null ``ts`` or ``seq`` is lower than any other, NaN is the
    highest ``ts``, a null step is -1; null runs and keys are keys like others. Each 1,024 steps of a metric
    lie in one of ``buckets`` states, so a run with a third of all rows spreads over many states, and many
    short runs do not cost a call to Python each; rows of one key are reduced batch by batch before they
    are shuffled. A state holds the order of the last writes and stays, as a row may come at any time: 24 bytes
    a step and its run and key. With many of them, set the state store's provider to the RocksDB one.
    """
    step = F.coalesce("step", F.lit(track.NO_STEP)).cast("bigint")
    ordered = history.select(
        "run_id",
        "key",
        step.alias("step"),
        F.pmod(F.xxhash64("run_id", "key", F.floor(step / _STEPS)), F.lit(buckets)).alias("_bucket"),
        F.coalesce("ts", F.lit(float("-inf"))).alias("_ts"),
        F.coalesce("seq", F.lit(_LOWEST)).cast("bigint").alias("_seq"),
        # pandas would turn NaN into null
        F.to_json(F.struct("value", "ts", "seq")).alias("_row"),
    )
    # pandas gives back a NaN as null
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in ordered.schema])
    last = ordered.mapInPandas(_last_of_batches, schema)
    changes = last.groupBy("_bucket").applyInPandasWithState(
        _last_writes,
        "run_id string, key string, step bigint, _row string",
        _STATE,
        "update",
        GroupStateTimeout.NoTimeout,
    )
    row = F.from_json("_row", _ROW)
    return changes.withColumn("_row", row).select(
        "run_id", "key", "_row.value", "step", "_row.ts", "_row.seq"
    )


def keep_current(
    changes: DataFrame,
    target: str,
    checkpoint: str,
    available_now: bool = True,
    source: str = "metrics",
    parts: int = sinks.PARTS,
) -> StreamingQuery:
    """Upsert a stream of changes into the table of current metrics at ``target/rows``.

    The number of a batch is its guard, and rows are compared by ``(ts, seq)``: a replay after a
    failure changes nothing. One stream at a time writes to a target.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # read to its end even if the batch is known, so that its states are committed
        rows = store(batch, "metric-changes")
        sinks.upsert(rows, target, KEYS, f"{source}-{batch_id}", parts=parts)

    writer = changes.writeStream.outputMode("update").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
