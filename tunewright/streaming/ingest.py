"""Streams: training log ingest, and prompts on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tunewright.operators import clean as cl
from tunewright.operators import prompt as pr
from tunewright.operators import track
from tunewright.sources.tables import RUN_LOG_SCHEMA
from tunewright.specs import CleanSpec, PromptSpec


def read_log_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(RUN_LOG_SCHEMA).option("maxFilesPerTrigger", max_files).json(path)
    )


def ingest_metrics(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    available_now: bool = True,
    source: str = "log",
) -> StreamingQuery:
    """Wide log rows to metric history below ``target/source=<name>/batch_id=<n>``.

    A batch owns its folder and overwrites it, so a replay after a failure leaves one copy. Batch
    numbers are a stream's own: each stream into one target needs a ``source`` name of its own,
    which stays the same over restarts. Rows without a ``ts`` get the time of their batch; ``seq``
    orders batches and the rows in them, so the history feeds ``current_tracking``.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        if "ts" not in batch.columns:
            now = F.unix_micros(F.current_timestamp()) / 1_000_000
            batch = batch.withColumn("ts", now.cast("double"))
        place = F.lit(batch_id << 43) + F.monotonically_increasing_id() % (1 << 43)
        track.metric_events(batch.withColumn("seq", place)).write.mode("overwrite").parquet(
            f"{target.rstrip('/')}/source={source}/batch_id={batch_id}"
        )

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def prompts(
    stream: DataFrame, prompt: PromptSpec, columns: tuple[str, ...] = (), lower: bool = False
) -> DataFrame:
    """Strip (and lower) text, then format: stateless, so any stream takes it."""
    spec = CleanSpec(False, False, True, lower, columns)
    return pr.format_prompts(cl.clean(stream, spec), prompt)


def write_parquet(
    stream: DataFrame, target: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").option("path", target)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
