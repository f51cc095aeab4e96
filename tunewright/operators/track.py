"""Run tracking as tables derived from one bulk event table.

An event is ``(run_id, kind, key, value, num, step, ts, seq)``:

========  ==================  ==========================  =======================
kind      key                 value (text)                num
========  ==================  ==========================  =======================
start     run name or null    config as JSON or null
param     parameter           JSON
metric    metric                                          number
artifact                      path
end                           final status (or null)
========  ==================  ==========================  =======================

``ts`` is epoch seconds; ``seq`` orders events of one moment. Every table is one aggregation that
combines on the map side, so a run with a third of all events is no problem.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = (
    "run_id string, kind string, key string, value string, num double, step bigint, ts double,"
    " seq bigint"
)
NO_STEP = -1  # fixed value: the step of a metric logged without one
ORDER = ("ts", "seq")


def _of(kind: str) -> Column:
    return F.col("kind") == kind


def _last(value: Column, kind: str) -> Column:
    """Value of the latest event of a kind."""
    return F.max_by(value, F.when(_of(kind), F.struct(*ORDER)))


def runs(events: DataFrame) -> DataFrame:
    """One row per started run. A run without an end event is ``running``."""
    # other kinds need not leave the scan
    grouped = run_history(events).groupBy("run_id").agg(
        F.count_if(_of("start")).alias("_starts"),
        F.count_if(_of("end")).alias("_ends"),
        _last(F.struct("key", "value", "ts"), "start").alias("_s"),
        _last(F.struct("value", "ts"), "end").alias("_e"),
    )
    status = F.when(F.col("_ends") > 0, F.coalesce("_e.value", F.lit("finished"))).otherwise(
        F.lit("running")
    )
    name = F.coalesce(F.nullif("_s.key", F.lit("")), F.substring("run_id", 1, 8))
    return grouped.filter("_starts > 0").select(
        "run_id",
        name.alias("run_name"),
        F.col("_s.value").alias("config_json"),
        F.col("_s.ts").alias("start_ts"),
        F.col("_e.ts").alias("end_ts"),
        status.alias("status"),
    )


def run_history(events: DataFrame) -> DataFrame:
    """Start and end events. Stored as they are, so a run may end in a later batch."""
    return events.filter(_of("start") | _of("end"))


def artifact_key(path: Column) -> Column:
    return F.concat(F.lit("artifact:"), F.substring_index(F.rtrim(path, F.lit("/")), "/", -1))


def absolute(path: Column, base: str = "/") -> Column:
    full = F.when(F.startswith(path, F.lit("/")), path).otherwise(
        F.concat(F.lit(base.rstrip("/") + "/"), path)
    )
    return F.rtrim(full, F.lit("/"))


def param_history(events: DataFrame, base: str = "/") -> DataFrame:
    """Parameter and artifact events as ``(run_id, key, value, ts, seq)`` rows."""
    artifact = _of("artifact")
    return events.filter(_of("param") | artifact).select(
        "run_id",
        F.when(artifact, artifact_key(F.col("value"))).otherwise(F.col("key")).alias("key"),
        F.when(artifact, absolute(F.col("value"), base)).otherwise(F.col("value")).alias("value"),
        *ORDER,
    )


def metric_history(events: DataFrame) -> DataFrame:
    """Metric events as rows; only numbers count, a missing step is -1."""
    return events.filter(_of("metric") & F.col("num").isNotNull()).select(
        "run_id",
        "key",
        F.col("num").alias("value"),
        F.coalesce("step", F.lit(NO_STEP)).cast("bigint").alias("step"),
        *ORDER,
    )


def current(table: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """Last write per key."""
    rest = [c for c in table.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return table.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*table.columns)


def params(events: DataFrame, base: str = "/") -> DataFrame:
    return current(param_history(events, base), ["run_id", "key"]).drop("ts", "seq")


def metrics(events: DataFrame) -> DataFrame:
    return current(metric_history(events), ["run_id", "key", "step"]).drop("seq")


def metric_events(
    wide: DataFrame, run_id: str = "run_id", step: str = "step", order: Sequence[str] = ORDER
) -> DataFrame:
    """Wide log rows (one column per metric) as long ``(run_id, key, value, step)`` rows, with the
    ``order`` columns (``ts``, ``seq``) that the rows have: with both they are metric history.
    """
    order = [c for c in order if c in wide.columns]
    names = [
        f.name
        for f in wide.schema.fields
        if f.name not in (run_id, step, *order)
        and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]
    cells = F.array(
        *[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in names]
    )
    return (
        wide.select(
            F.col(run_id).alias("run_id"), F.col(step).alias("step"), *order, F.inline(cells)
        )
        .filter("value IS NOT NULL")
        .select(
            "run_id",
            "key",
            "value",
            F.coalesce("step", F.lit(NO_STEP)).cast("bigint").alias("step"),
            *order,
        )
    )


def log_entries(
    logs: DataFrame, run_id: str = "run_id", step: str = "step", epoch: str = "epoch"
) -> DataFrame:
    """Log lines as they are stored: epoch at four decimals (zero becomes null), other doubles at
    six, rows without any value left out."""
    values = [f for f in logs.schema.fields if f.name not in (run_id, step, epoch)]
    some = F.coalesce(*[F.col(f.name).cast("string") for f in values]).isNotNull()
    rounded = [
        F.round(f.name, 6).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f.name)
        for f in values
    ]
    return logs.filter(some).select(
        run_id,
        step,
        F.when(F.col(epoch) != 0, F.round(epoch, 4)).alias(epoch),
        *rounded,
    )


def summary(events: DataFrame) -> DataFrame:
    """Latest train and eval loss per run, zero if never logged."""

    def latest(key: str) -> Column:
        at = F.when(F.col("key") == key, F.struct(*ORDER))
        return F.coalesce(F.max_by("value", at), F.lit(0.0)).alias(key)

    return metric_history(events).groupBy("run_id").agg(latest("train_loss"), latest("eval_loss"))


CELLS = pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())]))


def _cells(node: dict, prefix: str = "") -> Iterator[dict[str, str]]:
    """Leaves of a nested object. An object is opened only if it holds an object."""
    for name, value in node.items():
        if isinstance(value, dict) and any(isinstance(v, dict) for v in value.values()):
            yield from _cells(value, f"{prefix}{name}.")
        else:
            yield {"key": prefix + name, "value": json.dumps(value)}


def flatten_config(
    configs: DataFrame, run_id: str = "run_id", column: str = "config_json"
) -> DataFrame:
    """Nested JSON objects as ``(run_id, key, value)`` with dotted keys and JSON values.

    Whether an object is opened depends on the row, so no common schema is looked for: one pass,
    any depth, a batch at a time.
    """

    @F.arrow_udf("array<struct<key:string,value:string>>")
    def cells(batch: pa.Array) -> pa.Array:
        return pa.array([list(_cells(json.loads(t) if t else {})) for t in batch.to_pylist()], CELLS)

    flat = configs.select(F.col(run_id).alias("run_id"), cells(column).alias("_cells"))
    return flat.select("run_id", F.explode_outer("_cells").alias("_c")).filter(
        "_c IS NOT NULL"
    ).select("run_id", "_c.key", "_c.value")
