import random
import struct
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tunewright.llm import packing as K

PATH = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
ODD = [
    "", None, "<|endoftext|>a b", "it's don't ΣΑΣ. İ é  x\xa0y 漢字　 a\x1cb 12 ___ 🙂 <|endoftext|>",
    " ́a", "x" * 50_000, "\n\t ", "a" + "́" * 3,
]


def slow_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(PATH))
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def test_words_give_the_tokens_of_the_text(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toArrow()["text"].to_pylist()
    texts = docs + ODD
    w = K.WordTokens(str(PATH))
    for known in (10**6, 50):
        monkeypatch.setattr(K, "KNOWN_WORDS", known)
        for _ in range(2):
            ids, first = w.of(pa.array(texts, pa.string()))
            got = [ids[a:b].tolist() + [2] for a, b in zip(first[:-1], first[1:], strict=True)]
            assert got == slow_ids(texts)


@pytest.mark.parametrize("size", [7, 100])
def test_patterns_place_everything_once(size):
    rng = random.Random(size)
    for _ in range(50):
        h = Counter(rng.choice([rng.randint(1, size), 1, size // 2]) for _ in range(rng.randint(0, 300)))
        patterns = K.shortest_pack_first(dict(h), size)
        placed = Counter()
        for parts, packs in patterns:
            assert packs > 0 and sum(a * t for a, t in parts) <= size
            for a, t in parts:
                placed[a] += t * packs
        assert placed == h
        least = -(-sum(a * n for a, n in h.items()) // size)
        assert sum(c for _, c in patterns) <= 1.5 * least + 2


def check(rows, ids, size):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(docs) == set(ids)
    for d, parts in docs.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            own = ids[d][r.start : r.start + r.length]
            assert r.start == at and r.length == len(own) and r.doc_tokens == len(ids[d])
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
            at += r.length
        assert at == len(ids[d])
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size


@pytest.mark.parametrize("offset_rows", [500_000, 0])
def test_pack(spark, monkeypatch, offset_rows):
    monkeypatch.setattr(K, "OFFSET_ROWS", offset_rows)
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(90))) for _ in range(200)]
    texts += ["same text of one length"] * 150 + ODD
    ids = dict(enumerate(slow_ids(texts)))
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, start int")
    out = K.pack(df.repartition(5), str(PATH), size=64)
    rows = out.collect()
    check(rows, ids, 64)
    for r in rows:
        assert r.ids == ids[r.doc_id][r.start : r.start + r.length]
    assert K.pack(df.limit(0), str(PATH), size=64).count() == 0


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b")] * 5, "doc_id long, text string")
    rows = K.pack(df, str(PATH), size=8).collect()
    assert Counter((r.sequence_id, r.offset) for r in rows).most_common(1)[0][1] == 1
    assert [r.length for r in rows] == [3] * 5


def test_query(spark):
    out = K.op6_shortest_pack_first(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    check(out.collect(), dict(zip([d.doc_id for d in docs], slow_ids([d.text for d in docs]), strict=True)), 4096)
    p = K.padding(out).first()
    assert p.padding / p.tokens < 0.02
