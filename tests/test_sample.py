import numpy as np
import pytest
from pyspark.sql import functions as F

from tunewright.operators import rank
from tunewright.operators import sample as sm
from tunewright.specs import SampleSpec


@pytest.fixture()
def hundred(spark):
    return spark.range(100).select("id", (F.col("id") + 100).alias("b"))


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_no_size_or_large_size_changes_nothing(hundred):
    assert sm.downsample(hundred, SampleSpec(n=None), "id").count() == 100
    for strategy in ("random", "first", "stratified", "diversity", "invalid"):
        spec = SampleSpec(n=100, strategy=strategy, stratify_column="b")
        assert sm.downsample(hundred, spec, "id").count() == 100


def test_random_is_exact_and_reproducible(hundred, seeded):
    first = ids(sm.downsample(hundred, SampleSpec(n=20), "id"))
    assert first == sorted(seeded(range(100))[:20])
    for n in (1, 17):
        assert ids(sm.downsample(hundred.repartition(n), SampleSpec(n=20), "id")) == first
    assert ids(sm.downsample(hundred, SampleSpec(n=20, seed=0), "id")) != first
    assert ids(sm.random_n(hundred, 0, "id")) == []


def test_first(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([10, 20, 30, 40, 50])], "id int, a int")
    assert ids(sm.downsample(df, SampleSpec(n=3, strategy="first"), "id")) == [0, 1, 2]


def test_first_beyond_the_heap_limit(hundred):
    for n in (1, 33, 99, 100, 150):
        for topk in (0, 999):
            out = rank.first_by_columns(hundred.repartition(7), ["b", "id"], n, topk)
            assert ids(out) == list(range(min(n, 100)))


def test_first_with_nulls_and_dates(spark):
    df = spark.createDataFrame(
        [(1, None), (2, "2024-01-03"), (3, "2024-01-01"), (4, None), (5, "2024-01-02")], "id int, d string"
    ).withColumn("d", F.to_date("d"))
    expected = [[1], [1, 4], [1, 3, 4], [1, 3, 4, 5], [1, 2, 3, 4, 5]]
    for n, want in enumerate(expected, 1):
        assert ids(rank.first_by_columns(df, ["d", "id"], n)) == want


def test_first_is_a_filter_on_the_scan(spark, tmp_path):
    spark.range(5000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = rank.first_by_columns(df, ["id"], 10)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(id,9)" in plan and "Exchange" not in plan
    search = rank.smallest(df, ["id"], 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in search


def test_unknown_strategy(hundred):
    with pytest.raises(ValueError, match="no strategy"):
        sm.downsample(hundred, SampleSpec(n=2, strategy="invalid"), "id")


@pytest.fixture()
def strata(spark):
    labels = ["A"] * 50 + ["B"] * 30 + ["C"] * 20
    return spark.createDataFrame(list(enumerate(labels)), "id int, label string")


def test_stratified_keeps_proportions(strata):
    spec = SampleSpec(n=20, strategy="stratified", stratify_column="label")
    out = sm.downsample(strata, spec, "id")
    assert {r.label: r["count"] for r in out.groupBy("label").count().collect()} == {
        "A": 10, "B": 6, "C": 4,
    }
    again = sm.downsample(strata.repartition(17), spec, "id")
    assert ids(again) == ids(out)


def test_stratified_errors(strata):
    with pytest.raises(ValueError, match="to stratify by"):
        sm.downsample(strata, SampleSpec(n=2, strategy="stratified", stratify_column="no"), "id")
    with pytest.raises(ValueError, match="needs stratify_column"):
        sm.downsample(strata, SampleSpec(n=2, strategy="stratified"), "id")


def test_stratified_more_strata_than_rows(spark):
    df = spark.range(60).select("id", (F.col("id") / 3).cast("int").alias("s"))
    with pytest.raises(ValueError, match="too small"):
        sm.stratified_n(df, 5, "s", "id")


def test_many_strata_use_the_salted_join(spark, monkeypatch):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 40).alias("s")
    )
    expected = ids(sm.stratified_n(df, 200, "s", "id"))
    monkeypatch.setattr(rank, "BROADCAST_ROWS", 0)
    assert ids(sm.stratified_n(df, 200, "s", "id")) == expected
    assert len(expected) == 200


@pytest.fixture()
def diverse(spark):
    texts = [("summarize", "text a"), ("classify", "text b"), ("translate", "text c")] * 10
    return spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(texts)], "id int, instruction string, input string"
    )


def test_diversity(diverse):
    out = sm.downsample(diverse, SampleSpec(n=5, strategy="diversity"), "id")
    assert out.count() == 5
    assert out.select("instruction").distinct().count() == 3
    assert out.columns == diverse.columns


def test_diversity_of_copies_never_picks_a_row_twice(spark):
    df = spark.createDataFrame([(i, "instr", "inp") for i in range(5)], "id int, instruction string, input string")
    assert len(set(ids(sm.downsample(df, SampleSpec(n=2, strategy="diversity"), "id")))) == 2


def test_quality(spark):
    good = "distinct instruction with enough length for the filter"
    df = spark.createDataFrame(
        [
            (1, "aaaaa", "x"),
            (2, "b" * 5000, "y"),
            (3, f"First {good}", "z"),
            (4, "Second different words that pass and stay after removal", "w"),
            (5, f"First {good}", "z"),
        ],
        "id int, instruction string, input string",
    )
    out = sm.downsample(df, SampleSpec(n=3, strategy="quality"), "id").collect()
    assert len(out) == 2
    assert all(20 <= len(f"{r.instruction} {r.input}") <= 4000 for r in out)


def test_quality_with_nothing_left(spark):
    df = spark.createDataFrame([(i, "tiny", "x") for i in range(4)], "id int, instruction string, input string")
    assert sm.downsample(df, SampleSpec(n=2, strategy="quality"), "id").count() == 0


def test_quality_missing_column(hundred):
    spec = SampleSpec(n=2, strategy="quality", text_columns=("instruction",))
    with pytest.raises(ValueError, match="to build a text from"):
        sm.downsample(hundred, spec, "id")


def test_text_columns_need_strings(hundred):
    with pytest.raises(ValueError, match="nothing to embed"):
        sm.downsample(hundred, SampleSpec(n=2, strategy="diversity"), "id")


def test_zero_settings_are_honoured(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, "xy", "a")], "id int, output string, instruction string")
    spec = SampleSpec(strategy="curated", min_chars=0, max_chars=1)
    assert ids(sm.downsample(df, spec, "id")) == [1]


def test_unique_key_check(spark):
    df = spark.createDataFrame([(1, 2), (1, 2)], "id int, x int")
    with pytest.raises(ValueError, match="not unique"):
        rank.require_unique(df, "id")


def test_seeded_rank(hundred, seeded):
    got = {r.id: r["rank"] for r in rank.seeded_rank(hundred.repartition(5), "id", 42).collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda t: t[1])] == seeded(range(100))
    assert sorted(got.values()) == list(range(1, 101))


def test_normalize_and_cosine(spark):
    from tunewright.functions import vectors as vx

    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    out = df.select(
        vx.normalize(F.col("a")).alias("u"), vx.cosine(F.col("a"), F.col("b")).alias("c"),
        vx.dot(F.col("a"), F.col("b")).alias("d"), vx.max_cosine(F.col("a"), np.eye(2)).alias("m"),
    ).collect()
    assert out[0].u == [0.6, 0.8] and out[1].u == [0.0, 0.0]
    assert out[0].c == pytest.approx(0.96) and out[1].c == 0.0
    assert out[0].d == 24.0 and out[0].m == pytest.approx(0.8)


def test_first_n_is_exact_on_ties(spark):
    df = spark.createDataFrame([(i, i % 10) for i in range(100)], "id int, b int").repartition(5)
    out = sm.first_n(df, 15, "b", "id")
    assert sorted(ids(out)) == sorted([*range(0, 100, 10), *range(1, 51, 10)])
    spec = SampleSpec(n=15, strategy="first", order_by=("b",))
    assert sorted(ids(sm.downsample(df, spec, "id"))) == sorted(ids(out))
    # beyond a top-k, with ranges that are cut again
    far = rank.first_by_columns(df, ["b", "id"], 37, topk=3, range_rows=4)
    want = sorted(range(100), key=lambda i: (i % 10, i))[:37]
    assert sorted(ids(far)) == sorted(want)


def test_repeated_keys_raise(spark):
    df = spark.createDataFrame([(i % 30, "x") for i in range(40)], "id int, s string")
    for strategy in ("random", "first", "stratified"):
        spec = SampleSpec(n=5, strategy=strategy, stratify_column="s")
        with pytest.raises(ValueError, match="not unique"):
            sm.downsample(df, spec, "id")
    assert sm.downsample(df, SampleSpec(n=5), "id", check_key=False).count() >= 5


def test_parts_of_a_key_do_not_run_together(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("", "c"), ("c", None), ("1:c", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(rank.order_hash(["x", "y"], 1).alias("h")).distinct().count() == len(rows)


def test_samples_keep_the_order_of_columns(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "t" * 30) for i in range(60)], "id int, s string, text string")
    for strategy in ("random", "first", "stratified", "diversity", "quality"):
        spec = SampleSpec(n=9, strategy=strategy, stratify_column="s", text_columns=("text",))
        assert sm.downsample(df, spec, "id").columns == ["id", "s", "text"]
