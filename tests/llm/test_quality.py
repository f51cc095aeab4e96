"""Features and scores against plain Python, and accuracy on rows held out."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tunewright.llm import quality as Q
from tunewright.llm import words as W

D = "/root/testdata/sf0.01"
MASK = (1 << 64) - 1
TEXTS = [None, "", " ", "a", "ab", "abc de", "naïve naïve naïve größe\n\tx", "𝒳 y 𝒳 y", "x" * 50, "The cat. The cat!"]


def slow_mix(x):
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & MASK
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & MASK
    return x ^ x >> 33


def slow_bucket(h):
    return slow_mix(h & MASK) >> (64 - Q.BITS)


def word_hash(w):
    data = np.frombuffer(w.encode(), np.uint8)
    return int(W.hashes(data, np.array([0]), np.array([len(data)]))[0])


def slow_bag(text):
    text = text or ""
    out = Counter([0])
    w = [word_hash(x) for x in text.split()]
    out.update(slow_bucket(x) for x in w)
    out.update(slow_bucket(y - x + 0x51ED) for x, y in zip(w, w[1:], strict=False))
    for size in Q.SIZES:
        for i in range(len(text) - size + 1):
            h = size
            for c in text[i : i + size]:
                h = (h * 0x9E3779B97F4A7C15 + ord(c)) & MASK
            out[slow_bucket(h)] += 1
    return out


@pytest.mark.parametrize("block", [1 << 20, 7, 3])
def test_features(monkeypatch, block):
    monkeypatch.setattr(Q, "_BLOCK", block)
    for t, (k, v) in zip(TEXTS, Q.bags(pa.array(TEXTS, pa.string())), strict=True):
        want = slow_bag(t)
        assert dict(zip(k.tolist(), np.rint(v * want.total()).astype(int).tolist(), strict=True)) == want


def model(labels=("no", "yes"), seen=0.7):
    rng = np.random.default_rng(2)
    keep = rng.random(Q.BUCKETS) < seen
    keep[0] = True
    vectors = rng.normal(size=(Q.BUCKETS, Q.DIM)).astype(np.float32) * keep[:, None]
    return Q.Model(list(labels), vectors, rng.normal(size=(len(labels), Q.DIM)).astype(np.float32), keep)


@pytest.mark.parametrize("block", [1 << 20, 5])
def test_scores_are_the_softmax_of_the_mean_vector(monkeypatch, block):
    monkeypatch.setattr(Q, "_BLOCK", block)
    m = model(("a", "b", "c"))
    got = Q.Scorer(m).probabilities(pa.array(TEXTS, pa.string()))
    for t, p in zip(TEXTS, got, strict=True):
        bag = {k: n for k, n in slow_bag(t).items() if m.seen[k]}
        mean = sum(n * m.vectors[k].astype(float) for k, n in bag.items()) / sum(bag.values())
        x = np.exp(m.output.astype(float) @ mean)
        assert np.allclose(p, x / x.sum(), atol=1e-5)


def test_a_step_goes_down_the_gradient():
    """One example and one epoch: the first step is that of the stated loss, over the sum of squared shares."""
    bucket, share = np.array([3, 9], np.int32), np.array([0.25, 0.75], np.float32)
    vectors, output, seen = Q.fit([(1, bucket, share)], 2, epochs=1)
    start = np.random.default_rng(7).normal(size=(2, Q.DIM)).astype(np.float32) / np.float32(4)
    back = np.array([0.5, -0.5], np.float32) @ start
    assert np.allclose(vectors[bucket], -Q.RATE * np.outer(share / (share @ share), back), atol=1e-6)
    assert np.allclose(output, start) and sorted(np.flatnonzero(seen)) == [0, 3, 9]


def test_odd_tables(spark):
    good, bad = "plain words of a good text. ", "junk junk junk junk "
    rows = [(i, (good if i % 2 else bad) * (1 + i % 4), 7, "s", 0.5) for i in range(80)]
    rows += [(100, None, 7, "s", 0.5), (101, "", 7, "s", 0.5), (None, good, 7, "s", 0.5), (3, good, 7, "s", 0.5)]
    rows += [(102, good * 20_000, 7, "s", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, _label string, score double").repartition(4)
    marks = [(i, i % 2) for i in range(80)] + [(5, 0), (5, 1), (7, None), (None, 1), (999, 1), (100, 1), (3, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    m = Q.learn(df, labels)
    assert m.labels == [0, 1]
    out = Q.score(df, m).collect()
    assert len(out) == len(rows) and out[0].quality == 7
    for r in out:
        if r.doc_id is not None and r.doc_id < 80 and r.doc_id != 5:
            assert (r.score > 0.5) == (r.doc_id % 2 == 1), r.doc_id
    assert next(r.score for r in out if r.doc_id == 102) > 0.5
    assert len({r.score for r in out if r.doc_id in (100, 101)}) == 1
    assert Q.score(df.limit(0), m).count() == 0
    # the sample is a bound on rows, also where keys repeat
    many = df.unionByName(df).unionByName(df)
    assert Q.learn(many, labels, sample=10).seen.sum() <= Q.learn(df, labels, sample=10).seen.sum()
    # the same rows in another order give the same model
    again = Q.learn(df.repartition(2, "text"), labels)
    assert np.array_equal(m.vectors, again.vectors) and np.array_equal(m.output, again.output)
    none = Q.learn(df, labels.limit(0))
    assert {r.score for r in Q.score(df, none).collect()} == {0.5}
    for y in (0, 1):
        one = Q.learn(df, labels.filter(f"quality = {y}"))
        assert {r.score for r in Q.score(df, one).collect()} == {float(y)}


def test_held_out_accuracy(spark):
    out = {r.doc_id: r for r in Q.op11_subword_quality(spark, D).collect()}
    assert len(out) == spark.read.parquet(f"{D}/documents.parquet").count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    held = [(out[i], y) for i, y in labels.items() if out[i].held_out]
    assert 40 < len(held) < len(labels) / 3
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in out.values())
    assert np.mean([r.predicted == y for r, y in held]) > 0.97
    assert all(r.predicted == 1 for r, y in held if y == 1)


def test_labels_held_out_are_not_read(spark, tmp_path):
    """Turning the labels of the rows held out changes nothing."""
    from pyspark.sql import functions as F

    labels = spark.read.parquet(f"{D}/labels.parquet")
    turned = F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))
    labels.withColumn("quality", turned.cast("long")).write.parquet(str(tmp_path / "labels.parquet"))
    (tmp_path / "documents.parquet").symlink_to(f"{D}/documents.parquet")
    a, b = (sorted(Q.op11_subword_quality(spark, d).collect()) for d in (D, str(tmp_path)))
    assert a == b
