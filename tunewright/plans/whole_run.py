"""Data preparation, prediction on the test split, evaluation and report in one call."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.functions.embed import EmbedderFactory
from tunewright.functions.token_vectors import TokenEncoderFactory
from tunewright.operators import evaluate as ev
from tunewright.operators import infer, metrics, report, templates
from tunewright.plans import data_prep
from tunewright.sources import sinks, tables
from tunewright.specs import DataSpec, EvalSpec


def run(
    spark: SparkSession,
    data: DataSpec,
    evaluation: EvalSpec,
    factory: infer.PredictorFactory,
    out: str,
    qualitative: DataFrame | None = None,
    extra: Sequence[metrics.Metric] = (),
    embedder: EmbedderFactory | None = None,
    token_encoder: TokenEncoderFactory | None = None,
) -> DataFrame:
    """Write ``out/splits`` and ``out/results``; return the results as a long table."""
    if len(data.key) != 1:
        raise ValueError("evaluation needs a single key column")
    root = out.rstrip("/")
    sinks.write_splits(data_prep.run(spark, data, embedder), f"{root}/splits")
    test = tables.load(spark, f"{root}/splits").filter(F.col("split") == "test")
    found = templates.for_model(data.model_name) if data.use_model_template else None
    spec = replace(evaluation, input_template=found[1]) if found else evaluation
    results, _ = ev.evaluate_model(
        test, spec, data.key[0], factory, extra, embedder, token_encoder
    )
    shown = None
    if qualitative is not None:
        shown = infer.qualitative(
            qualitative, factory, batch_size=spec.batch_size, max_new_tokens=spec.max_new_tokens
        )
    sinks.write_results(f"{root}/results", results, shown)
    raw = tables.read_results(spark, f"{root}/results/quantitative")

    return report.flatten(raw)
