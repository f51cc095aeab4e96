"""Writers. Spark writes every file; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.operators import evaluate, track
from tunewright.session import store

PARTS = 64  # hash partitions of a current table
#: Keys of the tracking tables; a run has its last start and its last end.
TRACKING_KEYS = {
    "runs": ("run_id", "kind"),
    "params": ("run_id", "key"),
    "metrics": ("run_id", "key", "step"),
}


def write_results(path: str, long: DataFrame, qualitative: DataFrame | None = None) -> None:
    """Overwrite ``path/quantitative`` (one JSON object) and ``path/qualitative`` (JSON lines)."""
    base = path.rstrip("/")
    # one row: the results of all metrics
    evaluate.results_json(long).coalesce(1).write.mode("overwrite").text(f"{base}/quantitative")
    if qualitative is not None:
        qualitative.select("input", "output").write.mode("overwrite").json(f"{base}/qualitative")


def append_log(logs: DataFrame, path: str) -> None:
    """Append log lines. Lines carry a run id, so runs can share a folder."""
    if "run_id" not in logs.columns:
        raise ValueError("log lines need a run_id")
    track.log_entries(logs).write.mode("append").json(path)


def write_splits(df: DataFrame, path: str, out: str = "split") -> None:
    """One folder per split; readers of one split touch only its files."""
    df.write.mode("overwrite").partitionBy(out).parquet(path)


def write_tracking(
    events: DataFrame, base: str, backend: str = "parquet", artifact_base: str = "/"
) -> None:
    """Append an event batch to the histories ``runs``, ``params`` and ``metrics``.

    Backend ``none`` writes nothing. ``tables.current_tracking`` reads the resolved tables.
    """
    if backend == "none":
        return
    if backend not in ("parquet", "orc"):
        raise ValueError(f"no tracking backend {backend!r}; there are none, orc, parquet")
    root = base.rstrip("/")
    tables = {
        "runs": track.run_history(events),
        "params": track.param_history(events, artifact_base),
        "metrics": track.metric_history(events),
    }
    for name, table in tables.items():
        table.write.mode("append").format(backend).save(f"{root}/{name}")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def upsert(
    batch: DataFrame, path: str, keys: Sequence[str], batch_id: str, order: Sequence[str] = track.ORDER,
    parts: int = PARTS,
) -> bool:
    """Write the last row per key into the table at ``path``; False if the batch was there before.

    The table lies in ``parts`` hash partitions of the keys. Only those that the batch touches are read,
    and only those are overwritten; a task writes one file for each of its partitions. The batch id is
    noted once the write is complete. A batch that failed midway may be applied again: a row loses
    against a later one by ``order`` whatever came first, so repeated and late batches change nothing
    that they should not. One writer at a time; ``parts`` is fixed for the life of a table.
    """
    spark = batch.sparkSession
    rows, noted = f"{path.rstrip('/')}/rows", f"{path.rstrip('/')}/batches"
    if _exists(spark, noted):
        known = spark.read.schema("batch_id string").parquet(noted)
        if not known.filter(F.col("batch_id") == batch_id).isEmpty():
            return False
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    # one row per key before anything else is read
    new = store(track.current(batch, keys, order).withColumn("_part", part), "upsert-batch")
    touched = [r[0] for r in new.select("_part").distinct().collect()]  # at most ``parts`` numbers
    if touched:
        if _exists(spark, rows):
            old = spark.read.schema(new.schema).parquet(rows).filter(F.col("_part").isin(touched))
            both = old.select(new.columns).unionByName(new)
            merged = track.current(both, [*keys, "_part"], order).select(new.columns)
        else:
            merged = new
        # what is overwritten must not be read at the same time
        merged = store(merged, "upsert-merged")
        merged.repartition(len(touched), "_part").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("_part").parquet(rows)
    spark.createDataFrame([(batch_id,)], "batch_id string").coalesce(1).write.mode("append").parquet(noted)
    return True


def upsert_tracking(
    events: DataFrame, base: str, batch_id: str, artifact_base: str = "/", parts: int = PARTS,
    only: Sequence[str] = tuple(TRACKING_KEYS),
) -> None:
    """Bring the current tables ``runs``, ``params`` and ``metrics`` below ``base`` up to date."""
    tables = {
        "runs": track.run_history(events),
        "params": track.param_history(events, artifact_base),
        "metrics": track.metric_history(events),
    }
    for name in only:
        upsert(tables[name], f"{base.rstrip('/')}/{name}", TRACKING_KEYS[name], batch_id, parts=parts)
