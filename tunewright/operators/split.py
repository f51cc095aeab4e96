"""Exact train / val / test split with seeded membership."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.operators import rank
from tunewright.session import LOCAL_ROWS, cut_lineage, settle
from tunewright.specs import SplitSpec

NAMES = ("train", "val", "test")


def check_ratios(spec: SplitSpec) -> None:
    total = spec.train + spec.val + spec.test
    if abs(total - 1.0) > 1e-6:
        raise ValueError(f"the shares of train, val and test add up to {total:.4f}, not 1")


def split_sizes(n: int, spec: SplitSpec) -> tuple[int, int, int]:
    """Rows of train, val and test: test first, then val out of the rest, both rounded up."""
    check_ratios(spec)
    n_test = math.ceil(spec.test * n)
    rest = n - n_test
    n_val = math.ceil(spec.val / (spec.train + spec.val) * rest)
    if n and rest - n_val <= 0:
        raise ValueError(f"With {n} rows the train split would be empty")
    return rest - n_val, n_val, n_test


def largest_remainder(
    df: DataFrame, size: str, total: int, draws: int, out: str, classes: int
) -> DataFrame:
    """Share ``draws`` among classes in proportion to ``size``: floors, then largest remainders.

    Ties go to the lowest class. Up to ``LOCAL_ROWS`` classes are shared out on the driver. More are
    ordered by (remainder, class) in ranges of equal size, whatever the remainders are.
    """
    exact = F.col(size) / F.lit(float(max(total, 1))) * F.lit(float(draws))
    floors = df.withColumn("_floor", F.floor(exact)).withColumn("_rest", exact - F.col("_floor"))
    if classes <= LOCAL_ROWS:
        rows = floors.toArrow()
        first = sorted(
            range(rows.num_rows),
            key=lambda i, rest=rows["_rest"].to_pylist(), s=rows["_s"].to_pylist(): (-rest[i], s[i]),
        )
        floor = rows["_floor"].to_pylist()
        for i in first[: max(0, draws - sum(floor))]:
            floor[i] += 1
        shared = rows.append_column(out, pa.array(floor, pa.int64())).drop_columns(["_floor", "_rest"])
        return df.sparkSession.createDataFrame(shared)
    given = floors.agg(F.sum("_floor")).first()[0] or 0
    order = [F.col("_rest").desc(), F.col("_s").asc()]
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = floors.repartitionByRange(parts, *order).withColumn("_band", F.spark_partition_id())
    ranked = rank.bucketed_rank(cut_lineage(ranged), "_band", order, "_rank").drop("_band")
    extra = F.when(F.col("_rank") <= draws - given, 1).otherwise(0)
    return ranked.withColumn(out, F.col("_floor") + extra).drop("_floor", "_rest", "_rank")


def class_quotas(df: DataFrame, column: str, spec: SplitSpec) -> tuple[DataFrame, int, int]:
    """Per class the rows of test and of test + val; the number of classes; the row count."""
    classes = settle(df.groupBy(F.col(f"`{column}`").alias("_s")).agg(F.count("*").alias("_n")))
    facts = classes.agg(
        F.sum("_n").alias("n"),
        F.count("*").alias("classes"),
        F.min("_n").alias("least"),
        F.count_if(F.col("_s").isNull()).alias("nulls"),
    ).first()
    n = facts.n or 0
    if facts.nulls:
        raise ValueError(f"stratify column {column!r} holds nulls")
    if n and facts.least < 2:
        raise ValueError("the least populated class has only 1 row; stratifying needs 2")
    n_train, n_val, n_test = split_sizes(n, spec)
    for name, size in zip(NAMES, (n_train, n_val, n_test)):
        if size < facts.classes:
            raise ValueError(f"{name} split of {size} rows is smaller than {facts.classes} classes")
    quotas = largest_remainder(classes, "_n", n, n_train + n_val, "_tv", facts.classes)
    quotas = largest_remainder(
        quotas, "_tv", n_train + n_val, n_train, "_train", facts.classes
    )
    test = F.col("_n") - F.col("_tv")
    quotas = quotas.select(
        F.col("_s").alias(column),
        test.alias("test"),
        (test + F.col("_tv") - F.col("_train")).alias("upto_val"),
    )
    return settle(quotas), facts.classes, n


def split(
    df: DataFrame,
    spec: SplitSpec,
    key: str | Sequence[str],
    out: str = "split",
    check_key: bool = True,
) -> DataFrame:
    """Add a ``split`` column. Sizes are exact; membership depends on seed and key only.

    The cut points are found over the key columns; the result is a projection of ``df``. The key
    must be unique; ``check_key=False`` leaves out the check (a shuffle of the key).
    """
    check_ratios(spec)
    if check_key:
        rank.require_unique(df, key)
    h = rank.order_hash(key, spec.seed)
    if spec.stratify_column is None:

        def wants(n: int) -> list[int]:
            _, n_val, n_test = split_sizes(n, spec)
            return [n_test, n_test + n_val]

        _, (test, val) = rank.global_cuts(df, key, spec.seed, wants)
        test_cut, val_cut = F.lit(test or ""), F.lit(val or "")
        return df.withColumn(out, _name(h, test_cut, val_cut))
    quotas, classes, n = class_quotas(df, spec.stratify_column, spec)
    wants = ["test", "upto_val"]
    cuts = rank.stratum_cuts(
        df, spec.stratify_column, key, spec.seed, quotas, wants, classes, rank.digits_for(n)
    ).withColumnsRenamed({"test": "_test_cut", "upto_val": "_val_cut"})
    joined = rank.attach(df, cuts, spec.stratify_column, classes, h)
    test_cut = F.coalesce("_test_cut", F.lit(""))
    val_cut = F.coalesce("_val_cut", F.lit(""))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return joined.select(*columns, _name(h, test_cut, val_cut).alias(out))


def _name(h, test_cut, val_cut):
    return F.when(h <= test_cut, "test").when(h <= val_cut, "val").otherwise("train")


def parts(df: DataFrame, out: str = "split") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, val and test as three tables."""
    return tuple(df.filter(F.col(out) == name).drop(out) for name in NAMES)


def leakage(df: DataFrame, key: str | Sequence[str], out: str = "split") -> DataFrame:
    """Keys that occur in more than one split."""
    return (
        df.groupBy(*rank.as_list(key))
        .agg(F.min(out).alias("_lo"), F.max(out).alias("_hi"), F.count("*").alias("rows"))
        .filter("_lo <> _hi")
        .drop("_lo", "_hi")
    )


def distribution(df: DataFrame, column: str, out: str = "split") -> DataFrame:
    """Share of each class in each split, in the whole table, and the difference of the two.

    One aggregation over the table; the rest works on (split, class) counts.
    """
    cells = df.groupBy(out, column).agg(F.count("*").alias("n"))
    per_split = cells.groupBy(out).agg(F.sum("n").alias("_split_n"))
    per_class = cells.groupBy(column).agg(F.sum("n").alias("_class_n"))
    total = cells.agg(F.sum("n").alias("_n"))
    return (
        cells.join(per_split, out)
        .join(per_class, column)
        .join(F.broadcast(total))  # one row
        .select(
            out,
            column,
            "n",
            (F.col("n") / F.col("_split_n")).alias("share"),
            (F.col("_class_n") / F.col("_n")).alias("overall"),
        )
        .withColumn("difference", F.abs(F.col("share") - F.col("overall")))
    )
