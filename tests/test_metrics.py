import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tunewright.functions.stem import score_stem, stem, stem_vocab
from tunewright.functions.token_vectors import digest_vectors
from tunewright.operators import evaluate as ev
from tunewright.operators import guard, metrics
from tunewright.specs import REFUSAL_MESSAGE, EvalSpec, GuardSpec

PAIRS = [
    (1, "the quick brown foxes were jumping", "the quick brown fox was jumping over lazy dogs"),
    (2, "alpha beta gamma", "delta epsilon zeta"),
    (3, "same words here", "same words here"),
    (4, "", "nothing to match"),
    (5, "Running runs; RUN! a a a", "run a running a"),
    (6, "!!!", "???"),
    (7, "déjà vu again", "deja vu again and again"),
    (8, "b a b a b", "a b a b a"),
]


@pytest.fixture()
def pairs(spark):
    return spark.createDataFrame(PAIRS, "id int, prediction string, reference string").repartition(3)


def tokens(text, stemmed):
    words = [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
    return [score_stem(w) for w in words] if stemmed else words


def f1(overlap, p, r):
    return 2 * overlap / (p + r) if overlap else 0.0


def brute_rouge(prediction, reference, stemmed):
    p, r = tokens(prediction, stemmed), tokens(reference, stemmed)
    out = []
    for n in (1, 2):
        grams = [Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1)) for t in (p, r)]
        out.append(f1((grams[0] & grams[1]).total(), grams[0].total(), grams[1].total()))
    table = np.zeros((len(p) + 1, len(r) + 1), dtype=int)
    for i, a in enumerate(p):
        for j, b in enumerate(r):
            table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
    return [*out, f1(int(table[-1, -1]), len(p), len(r))]


@pytest.mark.parametrize("stemmed", [True, False])
def test_rouge_equals_brute_force(pairs, stemmed):
    expected = {i: brute_rouge(p, r, stemmed) for i, p, r in PAIRS}
    got = {r.id: [r.rouge1, r.rouge2, r.rougeL] for r in metrics.rouge_scores(pairs, "id", stemmed).collect()}
    assert got.keys() == expected.keys()
    for i in expected:
        assert got[i] == pytest.approx(expected[i])
    for n in (1, 2):
        one = metrics.rouge_n_scores(pairs, "id", n, stemmed).collect()
        assert {r.id: r[f"rouge{n}"] for r in one} == pytest.approx({i: e[n - 1] for i, e in expected.items()})
    longest = metrics.rouge_l_scores(pairs, "id", stemmed).collect()
    assert {r.id: r.rougeL for r in longest} == pytest.approx({i: e[2] for i, e in expected.items()})


def test_ngrams_are_not_shuffled(pairs):
    plan = metrics.rouge_scores(pairs, "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def values(df):
    return {r.sub_metric: r.value for r in df.collect()}


def test_rouge_bounds(spark, pairs):
    same = values(metrics.rouge(pairs.filter("id = 3")))
    assert all(v > 0.9 for v in same.values()) and set(same) == {"rouge1", "rouge2", "rougeL"}
    assert all(v < 0.1 for v in values(metrics.rouge(pairs.filter("id = 2"))).values())
    assert values(metrics.rouge(pairs.filter("id < 0"))) == {"rouge1": 0.0, "rouge2": 0.0, "rougeL": 0.0}
    mixed = values(metrics.rouge(pairs.filter("id IN (2, 3)")))
    assert mixed["rouge1"] == pytest.approx(0.5)


def test_rouge_by_group(pairs):
    grouped = metrics.rouge(pairs.withColumn("g", F.col("id") == 3), by=["g"]).collect()
    assert {(r.g, r.sub_metric): r.value for r in grouped}[(True, "rougeL")] == 1.0


@pytest.mark.parametrize(
    ("word", "expected"),
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("agreed", "agre"),
        ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"), ("hopping", "hop"),
        ("falling", "fall"), ("filing", "file"), ("happy", "happi"), ("relational", "relat"),
        ("conditional", "condit"), ("vietnamization", "vietnam"), ("triplicate", "triplic"),
        ("hopefulness", "hope"), ("electrical", "electr"), ("adjustment", "adjust"),
        ("adoption", "adopt"), ("probate", "probat"), ("rate", "rate"), ("controll", "control"),
        ("skies", "sky"), ("dying", "die"), ("spied", "spi"), ("died", "die"), ("is", "is"),
    ],
)
def test_stems(word, expected):
    assert stem(word) == expected


def test_short_words_are_not_stemmed_for_scores():
    assert score_stem("was") == "was" and score_stem("cats") == "cat"


def test_stem_vocabulary(spark):
    df = spark.createDataFrame([("cats cats cat",)], "t string")
    out = stem_vocab(df, F.split("t", " ")).collect()
    assert {(r.token, r.stem, r.n) for r in out} == {("cats", "cat", 2), ("cat", "cat", 1)}


@pytest.mark.parametrize("given", [False, True])
def test_bertscore_equals_brute_force(pairs, given):
    factory = (lambda: digest_vectors) if given else None
    got = {r.id: r for r in metrics.bertscore_scores(pairs, "id", factory).collect()}
    for i, p, r in PAIRS:
        a, b = tokens(p, False), tokens(r, False)
        if not a or not b:
            assert got[i].bertscore_f1 == 0.0
            continue
        x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in map(digest_vectors, (a, b)))
        s = x @ y.T
        pr, rc = s.max(axis=1).mean(), s.max(axis=0).mean()
        assert got[i].bertscore_precision == pytest.approx(pr)
        assert got[i].bertscore_recall == pytest.approx(rc)
        assert got[i].bertscore_f1 == pytest.approx(2 * pr * rc / (pr + rc))


def test_identical_texts_score_one(pairs):
    out = values(metrics.bertscore(pairs.filter("id = 3")))
    assert out == pytest.approx(dict.fromkeys(out, 1.0))
    assert values(metrics.semantic_similarity(pairs.filter("id = 3")))["semantic_similarity"] == pytest.approx(1.0, abs=1e-6)


def test_empty_input_gives_zeros(pairs):
    none = pairs.filter("id < 0")
    for metric in (metrics.bertscore, metrics.semantic_similarity, metrics.refusal):
        out = metric(none).collect()
        assert out and all(r.value == 0.0 for r in out)


def refusals(spark, rows):
    return spark.createDataFrame(rows, "id int, prediction string, reference string, answerable boolean")


def test_refusal(spark):
    out = values(metrics.refusal(refusals(spark, [
        (1, REFUSAL_MESSAGE, "x", False), (2, "an answer", "y", True), (3, f" {REFUSAL_MESSAGE}\n", "z", False),
    ])))
    assert out == {"refusal_precision": 1.0, "refusal_recall": 1.0, "false_refusal_rate": 0.0}
    out = values(metrics.refusal(refusals(spark, [(1, REFUSAL_MESSAGE, "x", True), (2, "a", "y", None)])))
    assert out["false_refusal_rate"] == 0.5
    out = values(metrics.refusal(refusals(spark, [(1, REFUSAL_MESSAGE, "x", True)]).drop("answerable")))
    assert set(out.values()) == {0.0} and len(out) == 3


def test_registry(pairs):
    with pytest.raises(ValueError, match="no metric 'nope'"):
        metrics.build(["nope"])
    out = ev.evaluate(pairs, ["rouge", "bertscore", "semantic_similarity", "refusal"])
    # one pass: one scan, one exchange of partial sums
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("Exchange SinglePartition") == 1
    assert {r.metric for r in out.collect()} == set(metrics.BUILTIN)


def test_custom_metric(pairs):
    equal = metrics.from_row_scorer("exact", lambda p, r: [float(a == b) for a, b in zip(p, r)], "em")
    out = ev.evaluate(pairs, [], extra=[equal]).collect()
    assert [tuple(r) for r in out] == [("exact", "em", 0.125)]


def test_pairing(spark):
    p = spark.createDataFrame([(1, "a"), (2, "b")], "id int, prediction string")
    r = spark.createDataFrame([(1, "a"), (3, "b")], "id int, reference string")
    with pytest.raises(ValueError, match="do not match"):
        ev.pair(p, r, "id")
    assert ev.pair(p, r, "id", strict=False).count() == 1


TEST_SET = [
    (1, "Summarise the text", "Revenue rose 10%.", "Revenue increased.", 1),
    (2, "Explain the concept", "Compound interest", "Interest on interest.", 0),
]


def test_evaluate_model(spark):
    df = spark.createDataFrame(TEST_SET, "id int, instruction string, input string, output string, ok int")
    spec = EvalSpec(metrics=("rouge", "refusal"), answerable_column="ok", batch_size=1)
    results, pairs = ev.evaluate_model(df, spec, "id", lambda: (lambda ps, n: [p + "Generated answer." for p in ps]))
    rows = sorted(tuple(r) for r in pairs.collect())
    assert rows == [
        (1, "Generated answer.", "Revenue increased.", True),
        (2, "Generated answer.", "Interest on interest.", False),
    ]
    assert results.count() == 6
    pairs.unpersist()
    # a named column that does not exist means no answerable information
    plain = ev.predict_pairs(df, EvalSpec(answerable_column="none"), "id", lambda: (lambda ps, n: ps))
    assert "answerable" not in plain.columns


def test_guard_verdicts(spark):
    def word_embedder():
        return lambda texts: np.array([[t.count("money"), t.count("cat"), 1e-3] for t in texts])

    df = spark.createDataFrame(
        [(1, "money", "money money"), (2, "cat", "cat"), (3, "money", "cat")], "id int, q string, a string"
    )

    def model():
        def run(prompts, limit):
            assert all("money" in p for p in prompts), "out of scope prompts must not reach the model"
            return [p + " cat cat cat" if p.endswith("3") else p + " money" for p in prompts]

        return run

    spec = GuardSpec(0.45, 0.4, ("money",))
    prompts = df.withColumn("p", F.concat("q", F.lit(" "), F.col("id").cast("string")))
    out = {r.id: r for r in guard.predict_guarded(prompts, "p", model, spec, word_embedder).collect()}
    assert out[1].answer == "money" and out[1].reason is None and not out[1].should_refuse
    assert out[2].answer == REFUSAL_MESSAGE and out[2].reason == "out_of_scope"
    assert out[2].confidence_score is None
    assert out[3].answer == REFUSAL_MESSAGE and out[3].reason == "low_confidence"
    after = GuardSpec(0.45, 0.4, ("money",), check_before=False)
    every = guard.predict_guarded(prompts, "p", lambda: (lambda ps, n: ps), after, word_embedder)
    assert {r.id: r.reason for r in every.collect()}[2] == "out_of_scope"


def slow_clipped(pairs):
    """Clipped precision by plain counting over all pairs."""
    match, total, p_len, r_len = [0, 0], [0, 0], 0, 0
    for p, r in pairs:
        p, r = (re.findall("[a-z0-9]+", (t or "").lower()) for t in (p, r))
        p_len, r_len = p_len + len(p), r_len + len(r)
        for n in (1, 2):
            x, y = (Counter(zip(*[t[i:] for i in range(n)], strict=False)) for t in (p, r))
            match[n - 1] += sum(min(c, y[g]) for g, c in x.items())
            total[n - 1] += sum(x.values())
    share = [m / t if t else 0.0 for m, t in zip(match, total, strict=True)]
    penalty = min(1.0, np.exp(1 - r_len / p_len)) if p_len else 0.0
    score = penalty * (share[0] * share[1]) ** 0.5
    return {"score": score, "length_penalty": penalty, "precision1": share[0], "precision2": share[1]}


@pytest.mark.parametrize("tasks", [1, 7])
def test_corpus_metric_merges_states(spark, tasks, monkeypatch):
    """Whole and grouped, with a null group, a null text, and more groups than a task holds."""
    monkeypatch.setattr(metrics, "HELD_GROUPS", 2)
    monkeypatch.setattr(metrics, "FAN_IN", 2)
    rows = [(p, r, i % 4 if i % 4 else None, "x") for i, p, r in PAIRS * 5] + [(None, "a b", 9, "x")]
    df = spark.createDataFrame(rows, "prediction string, reference string, g int, h string").repartition(tasks)
    metric = metrics.clipped_precision()
    want = slow_clipped([r[:2] for r in rows])
    got = {r.sub_metric: r.value for r in metric(df).collect()}
    assert got == pytest.approx(want, abs=1e-6) and 0 < got["score"] < 1
    out = metric(df, ["g", "h"]).collect()
    for g in {r[2] for r in rows}:
        want = slow_clipped([r[:2] for r in rows if r[2] == g])
        assert {r.sub_metric: r.value for r in out if r.g == g and r.h == "x"} == pytest.approx(want, abs=1e-6)
    assert len(out) == 4 * 5
    none = df.limit(0)
    assert {r.value for r in metric(none).collect()} == {0.0}
    assert metric(none, ["g"]).count() == 0


def test_run_all_by_group_and_of_nothing(pairs):
    by = pairs.withColumn("g", F.col("id") % 2)
    out = metrics.run_all(by, [*metrics.build(["rouge"]), metrics.clipped_precision()], ["g"])
    rouge = {(r.g, r.sub_metric): r.value for r in out.collect() if r.metric == "rouge"}
    for g in (0, 1):
        for r in metrics.rouge(by.filter(F.col("g") == g)).collect():
            assert rouge[g, r.sub_metric] == r.value
    assert out.filter("metric = 'clipped_precision'").count() == 8
    nothing = metrics.run_all(pairs, [])
    assert nothing.columns == ["metric", "sub_metric", "value"] and nothing.count() == 0
    assert ev.evaluate(by, ["refusal"], by=["g"]).filter("g = 1").count() == 3


def test_batches_are_scored_some_rows_at_a_time(monkeypatch):
    """What is held at once is bounded by tokens, whatever the rows of a batch; a long row stays whole."""
    rng = np.random.default_rng(3)
    p, r = (
        pa.array([None if n == 9 else [f"w{k}" for k in rng.integers(0, 7, n)] for n in rng.integers(0, 12, 60)])
        for _ in range(2)
    )
    p = pa.concat_arrays([p, pa.array([["a"] * 50])])
    r = pa.concat_arrays([r, pa.array([["a"] * 3])])
    monkeypatch.setattr(metrics, "TOKENS", 20)
    seen = []

    def score(x, y):
        seen.append(len(x.flatten()) + len(y.flatten()))
        return metrics._shared_of(x, y)

    assert metrics._by_slices(score, p, r).equals(metrics._shared_of(p, r))
    assert max(seen[:-1]) <= 23 and sum(seen) == len(p.flatten()) + len(r.flatten()) and len(seen) > 20
    assert metrics._by_slices(score, p[:0], r[:0]).equals(metrics._shared_of(p[:0], r[:0]))


def test_batches_are_embedded_some_rows_at_a_time(monkeypatch):
    from tunewright.functions import embed as em

    rng = np.random.default_rng(4)
    tokens = pa.array([[f"w{k}" for k in rng.integers(0, 40, n)] for n in rng.integers(0, 30, 50)] + [[]])
    monkeypatch.setattr(em, "TOKENS", 25)
    seen = []
    real = em._hashed
    monkeypatch.setattr(em, "_hashed", lambda t, dim: seen.append(len(t.flatten())) or real(t, dim))
    assert np.array_equal(em._in_slices(tokens, 16), real(tokens, 16))
    assert max(seen) <= 30 and sum(seen) == len(tokens.flatten()) and len(seen) > 20
