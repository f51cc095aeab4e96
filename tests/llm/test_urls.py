import pytest

from tunewright.llm import urls

RULES = urls.RULES


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("http://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/1", "example.org", "/en/1", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
        ("http://org", "org", "", None, "allow"),
        ("http://casino-win.example.com/en/1", "casino-win.example.com", "/en/1", None, "block"),
        ("http://casinos.example.com/en/1", "casinos.example.com", "/en/1", None, "allow"),
        ("http://free-bets.example.com/en/1", "free-bets.example.com", "/en/1", None, "block"),
        ("http://free.example.com/free/free", "free.example.com", "/free/free", None, "allow"),
        ("http://xxx.example.com/fr/1", "xxx.example.com", "/fr/1", "com/fr/", "allow"),
        ("http://a.com?x=porn", "a.com", "", None, "block"),
        ("no scheme, porn", "", "", None, "block"),
        ("://", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://a.com/\nfr://b.net/x", "a.com", "/\nfr://b.net/x", None, "allow"),
        ("http://a.com/" + "porn" * 100_000, "a.com", "/" + "porn" * 100_000, None, "allow"),
    ],
)
def test_judge(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(1, url, "clash")], "page_id long, url string, verdict string")
    got = urls.judge(df, "url", RULES).first()
    assert (got.host, got.path, got.rule, got.verdict) == (host, path, rule, verdict)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://adult.com/x")] * 3, "page_id long, url string")
    out = urls.judge(df)
    assert [r.verdict for r in out.collect()] == ["block"] * 3
    assert urls.judge(df.limit(0)).columns == out.columns
    assert urls.judge(df.limit(0)).count() == 0


def test_weights():
    v = urls.Vocabulary((), ("free", "win"), 2.0, (("free", 2.0),))
    assert urls.find_terms("http://free.com", v) == ([], ["free"], 2.0)
    assert urls.find_terms("http://win.win", v) == ([], ["win"], 1.0)
    assert urls.find_terms("http://freé", v) == ([], [], 0.0)
