import hashlib
import random
import re

import numpy as np
import pytest

from tunewright.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(text)


def slow(docs, bench, size=10):
    out = []
    for _, text in docs:
        w, hit, items = split(text), set(), set()
        for item, t in bench:
            b = split(t)
            n = min(size, len(b))
            wins = {tuple(b[i : i + n]) for i in range(max(1, len(b) - size + 1))} if b else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wins:
                    hit.update(range(i, i + n))
                    if item is not None:
                        items.add(str(item))
        out.append((len(w), len(hit), sorted(items)))
    return out


@pytest.mark.parametrize("block_words", [1_000_000, 40])
def test_against_brute_force(spark, block_words):
    rng = random.Random(5)
    words = ["a", "b", "c", "É", "é", "x1", "the"]
    say = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(n))
    bench = [(i, say(rng.choice([1, 3, 9, 10, 11, 25]))) for i in range(8)]
    bench += [(3, bench[3][1]), (100, bench[0][1]), (None, say(12)), (101, None), (102, " .. "), (103, "q")]
    docs = [(i, say(rng.randrange(60))) for i in range(60)]
    docs += [(i, say(5) + " " + bench[i % 8][1].upper() + "! " + say(4)) for i in range(60, 90)]
    docs += [(5, docs[5][1]), (None, None), (91, ""), (92, "q " * 3000), (93, "w" * 400_000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, items int")
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = D.annotate(df.coalesce(1), b, block_words=block_words).collect()
    have = [(r.n_words, sum(h.end - h.start for h in r.hits), sorted(r["items"])) for r in got]
    assert [r.doc_id for r in got] == [d for d, _ in docs]
    assert have == slow(docs, bench)


def test_long_item_and_empty_tables(spark):
    w = [f"w{i}" for i in range(2500)]
    b = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    d = spark.createDataFrame([(1, " ".join(w[995:1020])), (2, "w1 w3")], "doc_id long, text string")
    got = {r.doc_id: r for r in D.annotate(d, b).collect()}
    assert [(h.start, h.end) for h in got[1].hits] == [(0, 25)] and not got[2].hits
    assert [r.doc_id for r in D.clean(d, b).collect()] == [2]
    assert D.annotate(d, b.limit(0)).filter("size(hits) > 0").count() == 0
    assert D.annotate(d.limit(0), b).count() == 0


def test_rarest_word_leads():
    index = D.Index(["1"], ["the the rare the"], 10)
    counts = np.where(index.vocabulary == index._h[2], 1, 1000)
    index.set_counts(counts)
    assert index.probe_off.tolist() == [2]


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
