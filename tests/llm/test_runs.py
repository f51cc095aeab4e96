"""Runs against comparing every word with every other place."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from tunewright.llm import runs as R
from tunewright.llm import words as W

D = "/root/testdata/sf0.001"


def slow_runs(w):
    """(start, length, period) by definition: stretches with words q apart alike, smallest period only."""
    found = {}
    n = len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse(w, runs):
    gone = set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def found_in(sequences):
    codes = W.mix(np.concatenate([np.asarray(x, np.uint64) for x in sequences] or [np.zeros(0, np.uint64)]))
    first = np.concatenate([[0], np.cumsum([len(x) for x in sequences])]).astype(np.int64)
    out = [[] for _ in sequences]
    for t, s, n, q in zip(*(x.tolist() for x in R.find(codes, first)), strict=True):
        out[t].append((s, n, q))
    return out


def sequences(seed):
    rng = np.random.default_rng(seed)
    out = [[], [1], [1] * 5, [1] * 6, [2, 3] * 4, [2, 3] * 3 + [2], [4] * 400]
    for _ in range(45):
        x = rng.integers(0, rng.integers(1, 400) + 1, rng.integers(0, 700)).tolist()
        for _ in range(rng.integers(0, 5)):
            q = int(rng.integers(1, 1 + max(1, len(x) // 6)))
            part = rng.integers(0, int(rng.integers(1, 30)), q).tolist()
            if rng.random() < 0.4:
                # a period of a period
                small = part[: max(1, q // 9)]
                part = (small * 9)[:q] + [99]
            at = int(rng.integers(0, len(x) + 1))
            reps = (part * int(rng.integers(2, 8)))[: len(part) * 6 - int(rng.integers(0, q + 1))]
            x[at:at] = reps
        out.append(x)
    fib = [1, 2]
    a, b = [1], [1, 2]
    while len(b) < 1500:
        a, b = b, b + a
    thue = [1]
    while len(thue) < 2048:
        thue = thue + [3 - t for t in thue]
    return [*out, fib, b, b * 5, thue, thue + thue[:700] * 4]


@pytest.mark.parametrize("seed", range(2))
def test_all_runs_are_found(seed):
    every = sequences(seed)
    assert found_in(every) == [slow_runs(x) for x in every]
    assert sum(q >= R.BASE for r in found_in(every) for _, _, q in r) > 5
    assert found_in([]) == [] and found_in([[], []]) == [[], []]


def test_long_periods_and_nested_ones():
    rng = np.random.default_rng(9)
    for q in (8, 9, 15, 16, 17, 63, 64, 65, 127, 300):
        for extra in (0, 1, q - 1):
            x = rng.integers(0, 3, 40).tolist() + (rng.integers(5, 10**6, q).tolist() * 6)[: 4 * q + extra] + [0, 1]
            assert found_in([x]) == [slow_runs(x)]
            short = x[: 40 + 4 * q - 1]
            assert found_in([short]) == [slow_runs(short)]
    block = [1, 2] * 60 + [7] * 50 + [9]
    x = block * 5
    assert found_in([x, x[1:]]) == [slow_runs(x), slow_runs(x[1:])]


def test_the_selected_positions_are_few():
    """Of random words about 2 / t of all positions; of a long stretch of one word none."""
    rng = np.random.default_rng(1)
    for t in (8, 64):
        names = W.mix(rng.integers(0, 2**63, 50_000).astype(np.uint64))
        low = R._least(names, t)
        n = len(low)
        share = ((low == names[:n]) | (low == names[t : t + n])).mean()
        assert 1 / t < share < 3 / t


def test_words_are_compared_by_their_bytes(monkeypatch):
    real = W.hashes
    monkeypatch.setattr(R.W, "hashes", lambda d, s, e: real(d, s, e) % np.uint64(3))
    text = " ".join(f"w{i * i % 23}" for i in range(300)) + " a b" * 5
    data, offsets = W.texts(R.pa.array([text]))
    _, start, length, period = R.runs_of(data, *W.spans(data, offsets))
    assert list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True)) == slow_runs(text.split())


def test_texts(spark):
    rows = [
        (1, None, "p"), (2, "", "p"), (3, " \t\n", "p"), (4, "a " * 30_000 + "b", "p"), (5, "x y x y\x0bx y", "p"),
        (6, "é ü é ü é ü é ü end", "p"), (6, "é ü é ü é ü é ü end", "p"), (None, "q " * 6, "p"),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, runs string, n_words int, collapsed int")
    out = R.detect(df).collect()
    assert len(out) == len(rows)
    for r, (i, t, _) in zip(sorted(out, key=lambda r: r.doc_id or 0), sorted(rows, key=lambda r: r[0] or 0), strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        want = slow_runs(w) if len(w) < 1000 else [(0, 30_000, 1)]
        assert (r.doc_id, r.n_words, [tuple(x) for x in r.runs]) == (i, len(w), want)
        assert r.collapsed == collapse(w, want)
    assert R.detect(df.limit(0)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").collect()
    want = {}
    for d in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        n, h = len(w), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = slow_runs(w)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want[d.doc_id] = (
            len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapse(w, runs)),
        )
    out = R.op12_synchronising_runs(spark, D)
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == want
    assert sum(r[0] > 0 for r in want.values()) > 10
    assert max(r[3] or 0 for r in want.values()) >= R.BASE
