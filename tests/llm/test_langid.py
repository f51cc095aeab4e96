import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tunewright.llm import langid as L


def slow_grams(text, size=4):
    s = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    s = re.sub(" +", " ", s).strip(" ")
    if not s:
        return []
    s = f" {s} "
    s = s.ljust(size)
    return [s[i : i + size] for i in range(len(s) - size + 1)]


TEXTS = [
    "Hello, wOrld", "", None, "12 34", "a", "  é1é  ", "İstanbul ΣΑΣ", "漢字", "x" * 5000,
    "ab.", ".ab", "🙂 ok 🙂", "a b c",
]


def test_grams_equal_the_definition():
    h, first = L.grams(pa.array(TEXTS))
    want = [slow_grams(t) for t in TEXTS]
    assert np.diff(first).tolist() == [len(w) for w in want]
    flat = [g for w in want for g in w]
    names = {}
    for g, x in zip(flat, h.tolist(), strict=True):
        assert names.setdefault(g, x) == x
    assert len(set(names.values())) == len(names)
    one, _ = L.grams(pa.array(TEXTS[:1]))
    assert (one == h[: len(one)]).all()


def test_masks_name_every_language_of_a_gram():
    rng = np.random.default_rng(2)
    for n in (3, 20, 70):
        kept = {f"l{i:02}": rng.integers(0, 2**64, 500, dtype=np.uint64) for i in range(n)}
        shared = rng.integers(0, 2**64, 5, dtype=np.uint64)
        kept["l00"] = np.concatenate([kept["l00"], shared])
        kept[f"l{n - 1:02}"] = np.concatenate([kept[f"l{n - 1:02}"], shared])
        f = L.Filters(kept, {k: 500 for k in kept})
        m = f.masks(shared)
        for i, name in enumerate(f.languages):
            bit = f._bit(m, i)
            assert bit.all() if name in ("l00", f"l{n - 1:02}") else not bit.any()
            assert f._bit(f.masks(kept[name]), i).all()


def test_shares_are_corrected_for_false_positives(monkeypatch):
    monkeypatch.setattr(L, "SLOTS", 1 << 10)
    rng = np.random.default_rng(3)
    own, other = (rng.integers(0, 2**64, 250, dtype=np.uint64) for _ in range(2))
    f = L.Filters({"a": own}, {"a": 250})
    h = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    raw = f._bit(f.masks(h), 0).mean()
    assert raw > 0.05 and f.shares(h, np.array([0, len(h)]))[0, 0] < 0.02
    mixed = np.concatenate([own, other])
    assert abs(f.shares(mixed, np.array([0, 500]))[0, 0] - 0.5) < 0.1


def test_counts_and_kept_grams_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("text", "lang").collect()
    counts = {}
    for r in rows:
        counts.setdefault(r["lang"], Counter()).update(slow_grams(r["text"]))
    totals = {k: sum(c.values()) for k, c in counts.items()}
    top = Counter()
    for k, c in counts.items():
        for g, n in c.items():
            top[g] = max(top[g], n / totals[k])
    f = L.learn(docs)
    assert f.languages == sorted(totals, key=lambda k: (-totals[k], k))
    for i, k in enumerate(f.languages):
        for g in list(counts[k])[::37]:
            s = counts[k][g] / totals[k]
            keep = s >= L.FLOOR and s >= L.CLOSE * top[g]
            bit = f._bit(f.masks(_hash(g)), i)[0]
            assert bit == keep or bit == 1


def _hash(gram):
    h = np.zeros(1, np.uint64)
    for c in gram:
        h = h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(ord(c)) + np.uint64(1)
    return L.W.mix(h)


def test_held_out_accuracy_and_rows(spark):
    out = L.op4_language_bitmask_filters(spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sorted(r.doc_id for r in out) == sorted(docs)
    right = []
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out:
            right.append(r.lang_pred == docs[r.doc_id].lang)
    assert np.mean(right) > 0.98


def test_nulls_ties_unknown_and_empty(spark):
    rows = [(1, "alpha beta gamma", "x", 5), (2, "uno dos tres", "y", 5), (3, None, "x", 5), (4, "q", None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    f = L.learn(df)
    ask = spark.createDataFrame(
        [(1, "beta"), (2, "tres dos"), (3, None), (4, "12 ."), (5, "zzzz"), (6, "w" * 100), (6, "w" * 100)],
        "doc_id long, text string",
    )
    got = L.predict(ask, f).withColumn("ok", L.accepted()).collect()
    assert [r.lang_pred for r in got] == ["x", "y", "und", "und", "x", "x", "x"]
    assert [r.ok for r in got] == [True, True, False, False, True, False, False]
    none = L.learn(df.limit(0))
    assert {r.lang_pred for r in L.predict(ask, none).collect()} == {"und"}
    assert L.predict(ask.limit(0), f).count() == 0
