from collections import Counter, defaultdict

import numpy as np

from tunewright.llm import shards


def slow_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_is_the_published_function():
    keys = np.random.default_rng(1).integers(0, 2**64, 2000, dtype=np.uint64)
    for n in (1, 2, 16, 1000):
        assert shards.jump(keys, n).tolist() == [slow_jump(int(k), n) for k in keys]


def check(rows, n):
    slots, where = defaultdict(list), {}
    for r in rows:
        slots[r.shard].append(r.slot)
        assert where.setdefault(r.doc_id, r.shard) == r.shard
        assert r.grown_shard in (r.shard, n)
    for s, found in slots.items():
        assert 0 <= s < n and sorted(found) == list(range(len(found)))


def test_slots_with_a_hot_key_nulls_and_copies(spark):
    rows = [(i % 50 if i % 3 else 7, "x") for i in range(3000)] + [(None, None)] * 40
    df = spark.createDataFrame(rows, "doc_id long, shard string").repartition(5)
    for n in (1, 16):
        out = shards.assign(df, ["doc_id"], n).collect()
        assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
        check(out, n)
    assert shards.assign(df.limit(0), ["doc_id"], 4).count() == 0


def test_offsets_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(shards, "OFFSET_ROWS", 0)
    df = spark.range(500).withColumnRenamed("id", "doc_id").repartition(7)
    check(shards.assign(df, ["doc_id"], 16).collect(), 16)


def test_query_covers_all_rows_and_moves_the_needed_share(spark, tmp_path):
    out = shards.op8_jump_hash_shards(spark, "/root/testdata/sf0.01")
    rows = out.collect()
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    import zlib

    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        b = docs[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.law) == (len(b) + 1, zlib.crc32(b), "key")
    check(rows, 16)
    assert 0.02 < shards.moved(out).count() / len(rows) < 0.12
    shards.write_shards(out, str(tmp_path / "s"), 2)
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(rows)
