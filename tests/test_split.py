import pytest
from pyspark.sql import functions as F

from tunewright.operators import split as sp
from tunewright.specs import SplitSpec


def table(spark, n):
    return spark.range(n).select("id", (F.col("id") % 3).alias("label"))


def sizes(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


def test_exact_sizes(spark):
    assert sizes(sp.split(table(spark, 100), SplitSpec(), "id")) == {"train": 80, "val": 10, "test": 10}
    assert sizes(sp.split(table(spark, 300), SplitSpec(), "id")) == {"train": 239, "val": 31, "test": 30}


def test_disjoint_and_covering(spark):
    out = sp.split(table(spark, 200), SplitSpec(), "id")
    assert sp.leakage(out, "id").count() == 0
    train, val, test = sp.parts(out)
    assert train.columns == ["id", "label"]
    every = train.unionByName(val).unionByName(test)
    assert sorted(r.id for r in every.collect()) == list(range(200))


def test_leakage_is_found(spark):
    df = spark.createDataFrame([(1, "train"), (1, "test"), (2, "val")], "id int, split string")
    assert [tuple(r) for r in sp.leakage(df, "id").collect()] == [(1, 2)]


def test_reproducible_whatever_the_partitioning(spark):
    for spec in (SplitSpec(), SplitSpec(stratify_column="label")):
        runs = [
            sorted(tuple(r) for r in sp.split(table(spark, 100).repartition(n), spec, "id").collect())
            for n in (1, 17)
        ]
        assert runs[0] == runs[1]
    a = sp.split(table(spark, 100), SplitSpec(seed=1), "id")
    b = sp.split(table(spark, 100), SplitSpec(seed=2), "id")
    assert sorted(a.collect()) != sorted(b.collect())


def test_stratified(spark):
    out = sp.split(table(spark, 300), SplitSpec(stratify_column="label"), "id")
    assert sizes(out) == {"train": 239, "val": 31, "test": 30}
    worst = sp.distribution(out, "label").agg(F.max("difference")).first()[0]
    assert worst < 0.05


def test_many_classes_rank_in_bands(spark, monkeypatch):
    df = spark.range(2000).select("id", (F.col("id") % 90).alias("label"))
    spec = SplitSpec(stratify_column="label")
    expected = sorted(tuple(r) for r in sp.split(df, spec, "id").collect())
    monkeypatch.setattr(sp, "LOCAL_ROWS", 10)
    assert sorted(tuple(r) for r in sp.split(df, spec, "id").collect()) == expected


def test_bad_ratios(spark):
    with pytest.raises(ValueError, match="not 1"):
        sp.split(table(spark, 10), SplitSpec(0.5, 0.1, 0.1), "id")


def test_small_classes(spark):
    df = spark.createDataFrame([(i, 0 if i else 1) for i in range(50)], "id int, label int")
    with pytest.raises(ValueError, match="only 1 row"):
        sp.split(df, SplitSpec(stratify_column="label"), "id")
    df = spark.range(40).select("id", (F.col("id") % 20).alias("label"))
    with pytest.raises(ValueError, match="smaller than 20 classes"):
        sp.split(df, SplitSpec(stratify_column="label"), "id")


def test_wide_rows_are_not_shuffled(spark):
    out = sp.split(table(spark, 100), SplitSpec(), "id")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
