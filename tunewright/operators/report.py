"""Tables behind the usual run and evaluation reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.functions import text as tx


def history(metrics: DataFrame, key: str | None = None) -> DataFrame:
    """Metric rows in step order."""
    rows = metrics if key is None else metrics.filter(F.col("key") == key)
    return rows.orderBy("run_id", "key", "step")


def loss_curve(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """``(step, series, value)``: train loss from ``loss`` and ``train_loss``, eval loss, and the
    learning rate."""
    keep = [run_id] if run_id else []
    sources = [
        (name, series)
        for name, series in (
            ("loss", "train"),
            ("train_loss", "train"),
            ("eval_loss", "eval"),
            ("learning_rate", "learning_rate"),
        )
        if name in log.columns
    ]
    cells = F.array(
        *[F.struct(F.lit(s).alias("series"), F.col(c).alias("value")) for c, s in sources]
    )
    return log.select(*keep, "step", F.inline(cells)).filter("value IS NOT NULL")


def flatten(results: DataFrame, column: str = "quantitative", keep: Sequence[str] = ()):
    """Nested metric maps as ``(metric, sub_metric, value)`` rows."""
    outer = results.select(*keep, F.explode(column).alias("metric", "_scores"))
    return outer.select(*keep, "metric", F.explode("_scores").alias("sub_metric", "value"))


def pivot(long: DataFrame, sub_metrics: Sequence[str] | None = None) -> DataFrame:
    """A row per metric and a column per sub-metric, at four decimals."""
    grouped = long.groupBy("metric").pivot("sub_metric", list(sub_metrics) if sub_metrics else None)
    return grouped.agg(F.round(F.max("value"), 4))


def compare(metrics: DataFrame, keys: Sequence[str] | None = None, step: int | None = None):
    """Runs side by side: a row per run and a column per metric (its value at the last step)."""
    rows = metrics if step is None else metrics.filter(F.col("step") == step)
    last = F.max_by("value", F.col("step"))
    return rows.groupBy("run_id").pivot("key", list(keys) if keys else None).agg(last)


def preview(
    qualitative: DataFrame, order: Sequence[str], n: int = 5, input_chars: int = 200,
    output_chars: int = 300,
) -> DataFrame:
    """The first ``n`` samples with shortened texts."""
    return qualitative.orderBy(*order).limit(n).select(
        *order,
        tx.preview(F.col("input"), input_chars).alias("input"),
        tx.preview(F.col("output"), output_chars).alias("output"),
    )
