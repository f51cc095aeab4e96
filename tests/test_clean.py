import pytest

from tunewright.operators import clean as cl
from tunewright.specs import CleanSpec

FINANCIAL = [
    (1, "  Revenue rose 10%. ", 2),
    (2, "Net loss of $5M.", 0),
    (3, "Net loss of $5M.", 0),
    (4, None, 1),
    (5, "Flat quarter.", 1),
    (6, "  Revenue ROSE 10%.", 2),
]


@pytest.fixture()
def financial(spark):
    return spark.createDataFrame(FINANCIAL, "id long, sentence string, label long")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_drops_missing_and_copies(financial):
    out = rows(cl.clean(financial, CleanSpec(), "id"))
    assert [r[0] for r in out] == [1, 2, 5, 6]
    assert out[0][1] == "Revenue rose 10%."


def test_keeps_missing_when_switched_off(financial):
    out = cl.clean(financial, CleanSpec(drop_missing=False), "id")
    assert out.filter("sentence IS NULL").count() == 1


def test_lower_comes_before_dedup(financial):
    out = rows(cl.clean(financial, CleanSpec(lower=True), "id"))
    assert [r[0] for r in out] == [1, 2, 5]
    assert all(r[1] == r[1].lower() for r in out)


def test_keeps_copies_when_switched_off(financial):
    assert cl.clean(financial, CleanSpec(drop_duplicates=False), "id").count() == 5


def test_target_columns_leave_others_alone(spark):
    df = spark.createDataFrame([(1, "  x  ", "  y  "), (2, None, "z")], "id int, a string, b string")
    out = rows(cl.clean(df, CleanSpec(columns=("b",)), "id"))
    assert out == [(1, "  x  ", "y"), (2, None, "z")]


def test_input_frame_is_unchanged(financial):
    before = rows(financial.filter("sentence IS NOT NULL"))
    cl.clean(financial, CleanSpec(), "id").count()
    assert rows(financial.filter("sentence IS NOT NULL")) == before


def test_empty(spark):
    df = spark.createDataFrame([], "id long, sentence string, label long")
    assert cl.clean(df, CleanSpec(), "id").count() == 0


def test_nulls_and_nan(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), "a"), (2, 1.0, None), (3, 2.0, "")], "id int, x double, s string"
    )
    assert [r.id for r in cl.drop_missing(df).collect()] == [3]
    twice = df.unionByName(df).drop("id").withColumn("s", df.s.substr(1, 0))
    assert cl.dedup_exact(twice).count() == 3


def test_unknown_column_raises(financial):
    with pytest.raises(KeyError, match="nope"):
        cl.clean(financial, CleanSpec(columns=("nope",)), "id")


def test_dedup_keeps_lowest_key_whatever_the_partitioning(financial):
    for n in (1, 17):
        out = cl.dedup_exact(financial.repartition(n), ["sentence"], "id")
        assert sorted(r.id for r in out.collect()) == [1, 2, 4, 5, 6]
        assert out.columns == ["id", "sentence", "label"]
