"""Session set-up for tests and benches, and the shared checkpoint folder.

On a cluster the session is made by the platform; these helpers only read it.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "tunewright", **conf: str) -> SparkSession:
    """A local session for tests and benches."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give local Python workers this package, wherever the driver found it. Once per context.

    On a cluster it is installed or passed with ``--py-files``.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tunewright_shipped", False) or not sc.master.startswith("local"):
        return
    package = Path(__file__).resolve().parent
    base = os.path.join(tempfile.mkdtemp(prefix="tunewright-code-"), package.name)
    sc.addPyFile(shutil.make_archive(base, "zip", package.parent, package.name))
    sc._tunewright_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the executors would
    not see it, and it would be lost with its machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tunewright-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the plan restarts from files in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(
    df: DataFrame, name: str, folder: str | None = None, rows_per_file: int | None = None
) -> DataFrame:
    """Write a wide table to the shared folder (or to ``folder``) and go on from there.

    Unlike a checkpoint it is columnar and compressed, and later passes read only the columns they
    need.
    """
    path = folder or scratch_path(df.sparkSession, name)
    writer = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly work per row on a table of few files, which may be small.

    A table of more files than there are cores is left as it is. Nothing runs to find out.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


LOCAL_ROWS = 10_000


def settle(df: DataFrame) -> DataFrame:
    """Compute a table that is usually small once, instead of in every step that reads it.

    Up to ``LOCAL_ROWS`` rows it becomes a local relation; a larger one is checkpointed.
    """
    rows = df.limit(LOCAL_ROWS + 1).toArrow()
    if rows.num_rows <= LOCAL_ROWS:
        return df.sparkSession.createDataFrame(rows, df.schema)
    return cut_lineage(df)
