"""Readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.operators import track

# The fields of a training log line, of stored results and of model metadata.
LOG_FIELDS = (
    "epoch", "loss", "grad_norm", "learning_rate", "train_runtime", "train_samples_per_second",
    "train_steps_per_second", "total_flos", "train_loss", "eval_loss", "eval_runtime",
    "eval_samples_per_second", "eval_steps_per_second",
)
LOG_SCHEMA = "step bigint, " + ", ".join(f"{c} double" for c in LOG_FIELDS)
RUN_LOG_SCHEMA = "run_id string, " + LOG_SCHEMA
RESULTS_SCHEMA = (
    "quantitative map<string,map<string,double>>, "
    "qualitative array<struct<input:string,output:string>>"
)
MODEL_SCHEMA = "approach string, base_model string, training_date string"


def load(
    spark: SparkSession, path: str, fmt: str = "parquet", split: str | None = None,
    split_column: str = "split", schema: str | None = None, **options,
) -> DataFrame:
    """A table, or one split of it. On a table partitioned by split, others are not read."""
    reader = spark.read.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df if split is None else df.filter(F.col(split_column) == split)


def read_training_log(spark: SparkSession, path: str, schema: str = LOG_SCHEMA) -> DataFrame:
    """JSON lines of one or many runs; fields a line lacks are null, blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation results, one row per file; a missing section is empty."""
    raw = spark.read.schema(RESULTS_SCHEMA).option("multiLine", True).json(path)
    return raw.select(
        F.coalesce("quantitative", F.expr("map()").cast("map<string,map<string,double>>")).alias(
            "quantitative"
        ),
        F.coalesce(
            "qualitative", F.array().cast("array<struct<input:string,output:string>>")
        ).alias("qualitative"),
        F.input_file_name().alias("file"),
    )


def describe_models(metadata: DataFrame, model_name: str | None = None) -> DataFrame:
    """Name, adaptation method and training date of each model, with defaults."""
    named = F.lit(model_name) if model_name else F.nullif(F.col("base_model"), F.lit(""))
    return metadata.select(
        F.coalesce(named, F.lit("unknown")).alias("name"),
        F.coalesce("approach", F.lit("unknown")).alias("adaptation_method"),
        F.try_to_timestamp("training_date").alias("training_date"),
        *[c for c in metadata.columns if c not in ("approach", "base_model", "training_date")],
    )


def models(spark: SparkSession, glob: str, model_name: str | None = None) -> DataFrame:
    """Catalogue of model folders by their metadata files."""
    raw = spark.read.schema(MODEL_SCHEMA).option("multiLine", True).json(glob)
    return describe_models(raw.withColumn("file", F.input_file_name()), model_name)


def read_tracking(
    spark: SparkSession, base: str, table: str, backend: str = "parquet"
) -> DataFrame:
    """``runs``, ``params`` or ``metrics`` history."""
    return spark.read.format(backend).load(f"{base.rstrip('/')}/{table}")


def current_tracking(
    spark: SparkSession, base: str, table: str, backend: str = "parquet"
) -> DataFrame:
    """The last write per key of a history; for ``runs`` one row per started run."""
    history = read_tracking(spark, base, table, backend)
    if table == "runs":
        return track.runs(history)
    keys = ["run_id", "key", "step"] if table == "metrics" else ["run_id", "key"]
    return track.current(history, keys)


def read_upserted(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A current table that ``sinks.upsert_tracking`` keeps; for ``runs`` one row per started run."""
    rows = spark.read.parquet(f"{base.rstrip('/')}/{table}/rows").drop("_part")
    return track.runs(rows) if table == "runs" else rows
