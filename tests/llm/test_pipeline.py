"""The pipeline against a brute-force version of each stage."""

from collections import Counter

import corpus_pipeline as P
from tunewright.llm import langid as L

from .test_decontaminate import slow as slow_hits
from .test_langid import slow_grams
from .test_packing import check, slow_ids
from .test_simhash import slow_components, slow_fp

D = "/root/testdata/sf0.001"


def slow_language(docs):
    counts = {}
    for d in docs:
        if d.text is not None and d.lang is not None:
            counts.setdefault(d.lang, Counter()).update(slow_grams(d.text))
    share = {k: {g: n / c.total() for g, n in c.items()} for k, c in counts.items()}
    top = Counter()
    for c in share.values():
        for g, s in c.items():
            top[g] = max(top[g], s)
    kept = {k: {g for g, s in c.items() if s >= L.FLOOR and s >= L.CLOSE * top[g]} for k, c in share.items()}
    out = []
    for d in docs:
        g = slow_grams(d.text)
        best = max((sum(x in k for x in g) / len(g) for k in kept.values()), default=0) if g else 0
        if g and (best >= 0.2 or len(g) < 20):
            out.append(d)
    return out


def slow_copies(docs):
    docs = sorted(docs, key=lambda d: d.doc_id)
    root = slow_components([d.doc_id for d in docs], [slow_fp(d.text) for d in docs])
    return [d for d, r in zip(docs, root, strict=True) if d.doc_id == r]


def test_stages(spark, tmp_path):
    spark.read.parquet(f"{D}/documents.parquet").createOrReplaceTempView("docs_in")
    odd = [(9001, None), (9002, "12 .."), (9003, ""), (9004, "ъ ы э ю я щ ш ч " * 20), (9005, "Ok.")]
    more = spark.createDataFrame(
        [(i, t, None, None, None) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long"
    )
    docs = spark.table("docs_in").unionByName(more)
    rows = docs.collect()
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    want = slow_language(rows)
    assert {9005} == {d.doc_id for d in want if d.doc_id > 9000}
    hits = lambda ds: [d for d, h in zip(ds, slow_hits([(0, d.text) for d in ds], bench), strict=True) if not h[1]]
    for name, stage, slow in (
        ("language", P.language, slow_language),
        ("near_copies", P.near_copies, slow_copies),
        ("benchmark", P.benchmark, hits),
    ):
        want = slow(rows)
        stage(spark, docs, D).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        assert out.columns == docs.columns
        key = lambda r: r.doc_id
        assert sorted(out.collect(), key=key) == sorted(want, key=key), name
        docs, rows = out, want
    assert 0 < len(rows) < 200
    ids = dict(zip([d.doc_id for d in rows], slow_ids([d.text for d in rows]), strict=True))
    check(P.sequences(spark, docs, D).collect(), ids, 4096)


def test_run(spark):
    out = P.run(spark, D)
    assert {"doc_id", "sequence_id", "offset", "ids"} <= set(out.columns)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    rows = slow_copies(slow_language(docs.values()))
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    rows = [d for d, h in zip(rows, slow_hits([(0, d.text) for d in rows], bench), strict=True) if not h[1]]
    check(out.collect(), dict(zip([d.doc_id for d in rows], slow_ids([d.text for d in rows]), strict=True)), 4096)


CLASHING = ("items", "hits", "n_words", "score", "lang_pred", "n_grams", "_n", "_node", "_root", "_fp", "c0", "ids")


def test_stages_keep_columns_of_any_name(spark):
    """Extra columns that are called like those of the operators, unique and repeated ids, no rows."""
    docs = spark.read.parquet(f"{D}/documents.parquet").limit(60)
    wide = docs.select(*[docs[c] for c in docs.columns], *[docs["n_chars"].alias(c) for c in CLASHING])
    repeated = wide.unionByName(wide.filter("doc_id % 3 = 0"))
    for name, stage in P.STAGES:
        plain = stage(spark, docs, D)
        for df, rows in ((wide, plain), (repeated, stage(spark, docs.unionByName(docs.filter("doc_id % 3 = 0")), D))):
            out = stage(spark, df, D)
            if name == P.STAGES[-1][0]:
                assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in rows.collect())
                continue
            assert out.columns == df.columns
            got = out.collect()
            assert all(r[c] == r.n_chars for r in got for c in CLASHING)
            narrow = Counter(tuple(r[: len(docs.columns)]) for r in got)
            assert narrow == Counter(tuple(r) for r in rows.collect()), name
        assert stage(spark, wide.limit(0), D).count() == 0
