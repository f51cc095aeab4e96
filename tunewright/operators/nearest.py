"""Largest cosine to a table of anchors of any size.

Some anchors become centres. A question's home is its nearest centre; at an angle ``a`` from it, as that is
an anchor too, no anchor farther than ``2 * a`` from the centre can be nearer to the question. Questions of
a home are grouped in bands by ``a``, and an anchor is copied only to the groups whose band reaches it. So
each question is sent once, to a task that has all anchors that matter to it.

In a task anchors are taken in the order of how near a question of the band can be to them (the difference
of their angles to the centre bounds it), a block at a time, until no question can gain.

Large groups are many tasks: their questions are dealt out in slices. A group that more than ``PART_ROWS``
anchors matter to (questions far from all anchors) is cut by anchors as well, and only its questions are
sent to each part.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.functions.vectors import normalize, to_matrix
from tunewright.operators.diversity import greedy_local
from tunewright.operators.rank import HASH, first_by_hash
from tunewright.session import store

CENTRES = 1024
BANDS = (0.05, 0.1, 0.2, 0.4, 0.8, 1.6, math.pi)  # upper ends, in radians
PART_ROWS = 65_536
STEP = 1024  # anchors compared before the bounds are looked at again
SLACK = 1e-6  # widens angles against rounding


def _angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1.0, 1.0))


def _homes(centres: np.ndarray):
    @F.arrow_udf("struct<_cell:int,_band:int,_angle:double>")
    def home(v: pa.Array) -> pa.Array:
        angle = _angles(to_matrix(v), centres) if len(v) else np.zeros((0, 1))
        cell = angle.argmin(axis=1).astype(np.int32)
        own = angle[np.arange(len(cell)), cell]
        band = np.searchsorted(BANDS, own).clip(max=len(BANDS) - 1).astype(np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(cell), pa.array(band), pa.array(own)], names=["_cell", "_band", "_angle"]
        )

    return home(F.col("_v"))


def _reached(centres: np.ndarray, groups: np.ndarray):
    """The groups (rows of cell and band) that an anchor matters to, with its angle to their centre."""
    upper = 2 * np.array(BANDS)[groups[:, 1]] + SLACK

    @F.arrow_udf("array<struct<_cell:int,_band:int,_far:double>>")
    def reached(v: pa.Array) -> pa.Array:
        if not len(v):
            return pa.array([], pa.list_(pa.struct([("_cell", pa.int32()), ("_band", pa.int32()), ("_far", pa.float64())])))
        far = _angles(to_matrix(v), centres)[:, groups[:, 0]]
        row, group = np.nonzero(far <= upper)
        each = pa.StructArray.from_arrays(
            [
                pa.array(groups[group, 0].astype(np.int32)),
                pa.array(groups[group, 1].astype(np.int32)),
                pa.array(far[row, group]),
            ],
            names=["_cell", "_band", "_far"],
        )
        bounds = np.searchsorted(row, np.arange(len(v) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), each)

    return reached(F.col("_v"))


def best_of(x: np.ndarray, angle: np.ndarray, anchors: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, int]:
    """Largest cosine of each row of ``x`` to the anchors, and how many anchors were compared.

    ``angle`` and ``far`` are the angles of both to one centre.
    """
    top = np.full(len(x), -np.inf)
    low, high = angle.min(), angle.max()
    # a question of the group is at least this far from the anchor
    apart = np.maximum(0.0, np.maximum(low - far, far - high))
    order = np.argsort(apart, kind="stable")
    seen = 0
    for i in range(0, len(order), STEP):
        if (top >= math.cos(min(math.pi, max(0.0, apart[order[i]] - SLACK)))).all():
            break
        part = order[i : i + STEP]
        top = np.maximum(top, (x @ anchors[part].T).max(axis=1))
        seen += len(part)
    return top, seen


def max_cosine_join(
    left: DataFrame, key: str, vec: str, anchors: DataFrame, anchor_vec: str, block: int = 4096,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Per left row the largest cosine to any anchor; null without anchors, and for a null vector.

    A zero vector has cosine 0 to everything.
    """
    spark = left.sparkSession
    named = F.col("_k").alias(key)
    left = left.select(F.col(key).alias("_k"), F.col(vec).cast("array<double>").alias("_v"))
    lost = left.filter("_v is null").select(named, F.lit(None).cast("double").alias("max_cosine"))
    rows = left.filter("_v is not null").withColumn("_v", normalize(F.col("_v")))
    rows = store(rows.withColumn("_id", F.monotonically_increasing_id()), "questions")
    y = anchors.select(F.col(anchor_vec).cast("array<double>").alias("_v")).filter("_v is not null")
    y = y.withColumn("_v", normalize(F.col("_v")))
    y = store(y.distinct().withColumn(HASH, F.md5(F.col("_v").cast("string"))), "anchors")
    zero = F.forall("_v", lambda v: v == 0)
    none = y.filter(zero).limit(1).count()
    y = y.filter(~zero)
    total = y.count()
    if not total:
        flat = F.lit(0.0 if none else None).cast("double")
        return rows.select(named, flat.alias("max_cosine")).unionByName(lost)
    # centres far from each other, out of a seeded sample of the anchors
    sample = to_matrix(first_by_hash(y, 4 * CENTRES, total).column("_v"))
    centres = sample[greedy_local(sample, min(CENTRES, max(1, math.isqrt(total))))]

    asked = rows.filter(~zero)
    placed = store(asked.withColumn("_at", _homes(centres)).select("_k", "_id", "_v", "_at.*"), "questions")
    counts = placed.groupBy("_cell", "_band").agg(F.count(F.lit(1)).alias("_n")).toArrow()
    groups = np.stack([counts.column(c).to_numpy() for c in ("_cell", "_band")], axis=1)
    top = spark.createDataFrame([], f"_id bigint, {_field(rows)}, _m double")
    if len(groups):
        near = y.withColumn("_at", F.explode(_reached(centres, groups))).select("_v", HASH, "_at.*")
        near = store(near, "anchors")
        sizes = near.groupBy("_cell", "_band").agg(F.count(F.lit(1)).alias("_a"))
        # at most CENTRES * len(BANDS) groups
        plan = F.broadcast(
            spark.createDataFrame(counts).join(F.broadcast(sizes), ["_cell", "_band"]).select(
                "_cell", "_band",
                F.ceil(F.col("_n") / block).cast("int").alias("_slices"),
                F.ceil(F.col("_a") / part_rows).cast("int").alias("_parts"),
            )
        )
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        lhs = placed.join(plan, ["_cell", "_band"])
        lhs = lhs.withColumn("_slice", F.pmod(F.xxhash64("_id"), F.col("_slices")).cast("int"))
        lhs = lhs.withColumn("_part", each("_parts")).drop("_slices", "_parts")
        rhs = near.join(plan, ["_cell", "_band"])
        rhs = rhs.withColumn("_part", F.pmod(F.xxhash64(HASH), F.col("_parts")).cast("int"))
        rhs = rhs.withColumn("_slice", each("_slices")).select("_cell", "_band", "_slice", "_part", "_v", "_far")

        def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if a.empty or b.empty:
                return pd.DataFrame({"_id": a["_id"].iloc[:0], "_k": a["_k"].iloc[:0], "_m": pd.Series([], dtype=float)})
            found, _ = best_of(
                np.stack(a["_v"].to_numpy()), a["_angle"].to_numpy(),
                np.stack(b["_v"].to_numpy()), b["_far"].to_numpy(),
            )
            return pd.DataFrame({"_id": a["_id"].to_numpy(), "_k": a["_k"].to_numpy(), "_m": found})

        where = ["_cell", "_band", "_slice", "_part"]
        top = (
            lhs.groupBy(*where)
            .cogroup(rhs.groupBy(*where))
            .applyInPandas(best, f"_id bigint, {_field(rows)}, _m double")
        )
        if (sizes.agg(F.max("_a")).first()[0] or 0) > part_rows:
            top = top.groupBy("_id").agg(F.first("_k").alias("_k"), F.max("_m").alias("_m"))
    value = F.greatest("_m", F.lit(0.0)) if none else F.col("_m")
    rest = rows.filter(zero).select(named, F.lit(0.0).alias("max_cosine"))
    return top.select(named, value.alias("max_cosine")).unionByName(rest).unionByName(lost)


def _field(rows: DataFrame) -> str:
    return f"_k {rows.schema['_k'].dataType.simpleString()}"
