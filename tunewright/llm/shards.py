"""Shards by jump consistent hashing.

A row's shard follows from its key and the number of shards alone; there is no ring table. With one
more shard, a row stays or moves into the new shard, and about one row in ``shards + 1`` moves.

Each row also gets its place in its shard (``slot``, gapless from 0). Tasks count their own rows per
shard while they hash them, the counts of all tasks give the offsets, and both are added: no row is
sorted, and no shard passes through one task, however many rows have one key. The numbered rows are
stored in the shared folder first, so that a lost executor cannot renumber them; another run may
number the rows of a shard differently.

Defined results: null keys form one key; equal keys share a shard; repeated rows get a slot each;
a null text has no bytes; an empty table gives an empty result. Columns of the input that are called
like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunewright.llm.registry import query
from tunewright.session import store

OFFSET_ROWS = 100_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key (Lamping and Veach, 2014)."""
    if shards < 1:
        raise ValueError("there must be a shard at least")
    key = keys.astype(np.uint64)
    out = np.zeros(len(key), np.int64)
    j = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        out[live] = j[live]
        k = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        key[live] = k
        step = float(1 << 31) / ((k >> np.uint64(33)).astype(np.float64) + 1.0)
        # beyond the last shard the exact value is of no interest, and might not fit
        j[live] = np.minimum((out[live] + 1) * step, float(shards)).astype(np.int64)
        live = live[j[live] < shards]
    return out


def _place(shards: int, columns: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        seen = np.zeros(shards, np.int64)
        for b in batches:
            keys = b.column("_key").to_numpy(zero_copy_only=False).view(np.uint64)
            now, grown = jump(keys, shards), jump(keys, shards + 1)
            order = np.argsort(now, kind="stable")
            counts = np.bincount(now, minlength=shards)
            first = np.concatenate([[0], np.cumsum(counts)[:-1]])
            nth = np.empty(len(now), np.int64)
            nth[order] = np.arange(len(now)) - np.repeat(first, counts) + np.repeat(seen, counts)
            seen += counts
            yield pa.RecordBatch.from_arrays(
                [
                    *[b.column(c) for c in columns],
                    pa.array(now.astype(np.int32)),
                    pa.array(grown.astype(np.int32)),
                    pa.array(np.full(len(now), task, np.int32)),
                    pa.array(nth),
                ],
                names=[*columns, "shard", "grown_shard", "_task", "_nth"],
            )

    return run


def assign(df: DataFrame, key: Sequence[str], shards: int) -> DataFrame:
    """Add shard, slot and grown_shard (the shard if there were one more)."""
    spark = df.sparkSession
    df = df.drop("shard", "slot", "grown_shard")
    kept = df.schema.fields
    schema = ", ".join(
        [
            *[f"`{f.name}` {f.dataType.simpleString()}" for f in kept],
            "shard int, grown_shard int, _task int, _nth bigint",
        ]
    )
    keyed = df.withColumn("_key", F.xxhash64(*key))
    placed = store(keyed.mapInArrow(_place(shards, [f.name for f in kept]), schema), "shards")
    sizes = placed.groupBy("shard", "_task").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("_rows").over(earlier) - F.col("_rows")
    offsets = sizes.select("shard", "_task", before.alias("_before"))
    tasks = placed.agg(F.max("_task")).first()[0]
    if tasks is not None and (tasks + 1) * shards <= OFFSET_ROWS:
        offsets = F.broadcast(offsets)
    return placed.join(offsets, ["shard", "_task"]).select(
        *[f.name for f in kept],
        "shard",
        (F.col("_nth") + F.col("_before")).alias("slot"),
        "grown_shard",
    )


def moved(assigned: DataFrame) -> DataFrame:
    """The rows that change their place when a shard is appended; all go to the new one."""
    return assigned.filter("shard <> grown_shard")


def write_shards(assigned: DataFrame, folder: str, files_per_shard: int = 1) -> None:
    """Write one folder ``shard=<n>`` for each shard, in ``files_per_shard`` tasks for each."""
    part = F.col("slot") % files_per_shard
    assigned.repartition(F.col("shard"), part).write.partitionBy("shard").parquet(folder)


@query("op8_jump_hash_shards")
def op8_jump_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    return assign(docs, ["doc_id"], 16).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
