"""Ids that stand for several texts."""

from tunewright.llm import simhash as S


def check_repeated_ids(spark, dedup):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (7, c), (7, b + " "), (7, c), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in dedup(df).collect()), key=str)
    assert got == sorted([(3, a), (5, b), (7, c), (None, a)], key=str)
    unlike = spark.createDataFrame([(5, b), (5, c)], "doc_id long, text string")
    assert sorted(r.text for r in dedup(unlike).collect()) == [b, c]
    assert dedup(df.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    check_repeated_ids(spark, S.dedup)
