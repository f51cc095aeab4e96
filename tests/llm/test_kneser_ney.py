import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tunewright.llm import kneser_ney as N

END = b"\x00end"


def words(text):
    return [*(text or "").encode().lower().split(), END]


class Slow:
    def __init__(self, texts):
        self.c, self.pair, self.docs = Counter(), Counter(), len(texts)
        for t in texts:
            w = words(t)
            self.c.update(w)
            self.pair.update(zip([None, *w], w))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.kinds = Counter(w for _, w in self.pair)
        self.dp = self.discount(self.pair.values())
        self.dw = self.discount(self.kinds.values())
        self.spare = sum(self.dw[min(x, 3) - 1] for x in self.kinds.values())
        self.back = defaultdict(float)
        for (v, _), x in self.pair.items():
            self.back[v] += self.dp[min(x, 3) - 1]

    @staticmethod
    def discount(counts):
        n = Counter(counts)
        return N.discounts([n[k] for k in (1, 2, 3, 4)])

    def p1(self, w):
        if not self.pair:
            return 1 / (self.v + 1)
        x, total = self.kinds.get(w, 0), len(self.pair)
        return (x - (self.dw[min(x, 3) - 1] if x else 0)) / total + self.spare / total / (self.v + 1)

    def p(self, v, w):
        total = self.docs if v is None else self.c.get(v, 0)
        if not total:
            return self.p1(w)
        x = self.pair.get((v, w), 0)
        return (x - (self.dp[min(x, 3) - 1] if x else 0)) / total + self.back[v] / total * self.p1(w)

    def score(self, text):
        w = words(text)
        base = sum(math.log10((self.c.get(x, 0) + 0.1) / (self.n + 0.1 * (self.v + 1))) for x in w)
        return len(w), sum(x in self.c for x in w), base, sum(math.log10(self.p(v, x)) for v, x in zip([None, *w], w))


def same(got, want):
    n, known, base, s = want
    assert (got.n_tokens, got.n_known) == (n, known)
    assert got.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
    assert got.score == pytest.approx(s, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_against_brute_force(spark, ranges, monkeypatch):
    monkeypatch.setattr(N, "_FLUSH", 300)
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(60)] + ["É", "The"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    say = lambda n: " ".join(rng.choices(vocab, weights, k=n))
    texts = [say(rng.randrange(30)) for _ in range(120)] + ["", None, "hot " * 700, "a b", "a b"]
    ask = [*texts[:30], "new words only", "w0 new w1 w59 w58", "", None, "x" * 300_000, "w59 w59 w59", "hot w3 hot"]
    slow = Slow(texts)
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    model = N.train(df, ranges=ranges)
    assert (model.vocabulary.size, model.vocabulary.total) == (slow.v, slow.n)
    q = spark.createDataFrame([(i, t, 0.0) for i, t in enumerate(ask)], "doc_id long, text string, score double")
    for r in N.score(q, model).collect():
        same(r, slow.score(ask[r.doc_id]))
        assert r.train_tokens == slow.n
    context = [*slow.c, b"new"]
    for v in (None, b"w0", b"w59", b"hot", b"new"):
        assert sum(slow.p(v, w) for w in context) == pytest.approx(1)


def test_query(spark):
    rows = N.op3_kneser_ney_score(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    out = {i for i in docs if zlib.crc32(str(i).encode()) % 10 == 0}
    slow = Slow([t for i, t in docs.items() if i not in out])
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        same(r, slow.score(docs[r.doc_id]))
        assert r.held_out == (r.doc_id in out) and r.train_tokens == slow.n
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_empty_training_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = N.train(df.limit(0), ranges=3)
    got = {r.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in N.score(df, model).collect()}
    assert got == {1: (3, 0, 0.0, 0.0), 2: (1, 0, 0.0, 0.0)}
    assert N.score(df.limit(0), N.train(df, ranges=2)).count() == 0


def test_model_needs_a_mounted_folder(spark, monkeypatch):
    monkeypatch.setattr(N, "scratch_path", lambda s, n: "hdfs://host/x")
    with pytest.raises(RuntimeError):
        N.shared_folder(spark)
