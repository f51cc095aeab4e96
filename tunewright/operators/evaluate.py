"""Evaluation: pair predictions with references, score them, keep the results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.functions import text as tx
from tunewright.functions.embed import EmbedderFactory
from tunewright.functions.token_vectors import TokenEncoderFactory
from tunewright.operators import guard, infer, metrics
from tunewright.operators.prompt import render, strip_prompt, with_system
from tunewright.session import store
from tunewright.specs import EvalSpec


def pair(predictions: DataFrame, references: DataFrame, key: str, strict: bool = True) -> DataFrame:
    """Join predictions and references on the key.

    ``strict`` raises if a key is on one side only: one aggregate over the key columns.
    """
    if strict:
        marks = predictions.select(key, F.lit(1).alias("p"), F.lit(0).alias("r")).unionByName(
            references.select(key, F.lit(0).alias("p"), F.lit(1).alias("r"))
        )
        odd = (
            marks.groupBy(key)
            .agg(F.sum("p").alias("p"), F.sum("r").alias("r"))
            .filter("p <> 1 OR r <> 1")
            .limit(1)
            .collect()
        )
        if odd:
            raise ValueError(f"predictions and references do not match at {odd[0].asDict()}")
    return predictions.join(references, key)


def build_prompts(df: DataFrame, spec: EvalSpec, out: str = "prompt") -> DataFrame:
    text = render(df, spec.input_template, spec.aliases)
    return df.withColumn(out, with_system(text, spec.system_prompt))


def predict_pairs(
    df: DataFrame, spec: EvalSpec, key: str, factory: infer.PredictorFactory,
    embedder: EmbedderFactory | None = None,
) -> DataFrame:
    """Prompts, (guarded) model outputs and references: ``(key, prediction, reference, ...)``."""
    prompted = build_prompts(df, spec)
    if spec.guard is not None:
        answered = guard.predict_guarded(
            prompted, "prompt", factory, spec.guard, embedder, None, spec.batch_size,
            spec.max_new_tokens, "prediction",
        )
    else:
        raw = infer.predict(prompted, "prompt", factory, spec.batch_size, spec.max_new_tokens)
        answered = raw.withColumn("prediction", strip_prompt(F.col("raw_output"), F.col("prompt")))
    columns = [F.col(key), F.col("prediction"), F.col(spec.reference_column).alias("reference")]
    if spec.answerable_column and spec.answerable_column in df.columns:
        columns.append(tx.truthy(df, spec.answerable_column).alias("answerable"))
    return answered.select(*columns)


def evaluate(
    pairs: DataFrame, names: Sequence[str], key: str = "id",
    extra: Sequence[metrics.Metric] = (), embedder: EmbedderFactory | None = None,
    token_encoder: TokenEncoderFactory | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """All metrics as one long table, per group if ``by`` is given. Call on pairs that are stored or cheap
    to recompute.
    """
    return metrics.run_all(pairs, [*metrics.build(names, embedder, token_encoder), *extra], by)


def evaluate_model(
    df: DataFrame, spec: EvalSpec, key: str, factory: infer.PredictorFactory,
    extra: Sequence[metrics.Metric] = (), embedder: EmbedderFactory | None = None,
    token_encoder: TokenEncoderFactory | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Predict once, store the answers, then score. Returns the results and the stored pairs.

    Stored, not cached: a lost executor must not ask the model again and get other answers.
    """
    pairs = store(predict_pairs(df, spec, key, factory, embedder), "predictions")
    return evaluate(pairs, spec.metrics, key, extra, embedder, token_encoder), pairs


def results_json(long: DataFrame) -> DataFrame:
    """A long results table as one row of JSON: ``{"quantitative": {metric: {sub: value}}}``.

    The input has one row per sub-metric, so the lists collected here are short.
    """
    per_metric = long.groupBy("metric").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("sub_metric", "value")))).alias("v")
    )
    return per_metric.agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "v"))).alias("quantitative")
    ).select(F.to_json(F.struct("quantitative")).alias("value"))
