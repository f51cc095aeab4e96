"""The manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tunewright.llm import merkle as M

D = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, path string, rank int, size string, `group` int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow_leaf(r, plus=0):
    out = ""
    for f in FIELDS:
        v = r[f]
        if v is not None and f == "n_chars":
            v += plus
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def slow_tree(leaves, fanout):
    """The top, and for each leaf its list of levels of (before, after)."""
    nodes = [(d, [i]) for i, d in enumerate(leaves)]
    paths = [[] for _ in leaves]
    while len(nodes) > 1:
        up = []
        for i in range(0, len(nodes), fanout):
            run = nodes[i : i + fanout]
            for k, (_, below) in enumerate(run):
                for x in below:
                    paths[x].append(([d for d, _ in run[:k]], [d for d, _ in run[k + 1 :]]))
            up.append((sha("".join(d for d, _ in run)), [x for _, b in run for x in b]))
        nodes = up
    return nodes[0][0], paths


def slow(rows, fanout=2):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, below = [], []
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, slow_leaf(r)))
        top, paths = slow_tree([slow_leaf(r) for r in groups[g]], fanout)
        tops.append(top)
        below.append(paths)
    root, above = slow_tree(tops, fanout)
    out = []
    for g, top, paths, up in zip(names, tops, below, above, strict=True):
        for r, path in zip(groups[g], paths, strict=True):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            at = slow_leaf(r, 1) if hit else slow_leaf(r)
            for before, after in path + up:
                at = sha("".join([*before, at, *after]))
            proof = sha("".join(d for before, after in path + up for d in [*before, *after]))
            out.append((r["doc_id"], slow_leaf(r), top, root, proof, at, at == root))
    return sorted(out, key=str)


def fast(df, fanout=2, levels=2):
    plus = [F.col(f) + 1 if f == "n_chars" else F.col(f) for f in FIELDS]
    hit = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, M.digest_of(plus))
    rows, root = M.manifest(df, "doc_id", FIELDS, "lang", hit, fanout, levels)
    return sorted((tuple(r) for r in M.verified(rows, root).collect()), key=str)


ODD = [
    (1, "a", None, "s", 1), (None, "b", "en", None, None), (None, "b", "en", None, None), (3, None, "en", "s", None),
    (7, "", "", "s", 0), (8, "é" * 40_000, "ü", "s", 40_000), (9, "x", "zz", "s", 1), (9, "y", "zz", "s", 1),
    (-4, "x", "zz", "s", 1),
]


@pytest.mark.parametrize(("fanout", "levels"), [(2, 3), (3, 2)])
def test_trees_of_all_depths(spark, fanout, levels):
    rows = [(i * 3, f"text {i}", ("aa", "bb", "cc", "d")[min(i % 9, 3) if i else 3], "s", i) for i in range(150)]
    rows = [r for r in rows if r[2] != "d" or r[0] in (0, 9)] + [(5000, "one", "lone", "s", 3)] + ODD
    df = spark.createDataFrame([(*r, "p", 5, "x", 2) for r in rows], SCHEMA).repartition(5)
    assert fast(df, fanout, levels) == slow([r.asDict() for r in df.collect()], fanout)


def test_one_row_one_group_and_none(spark):
    for rows in ([(4, "a", "en", "s", 1)], [(i, "a", "en", "s", 1) for i in range(6)], [(2, None, None, None, None)]):
        df = spark.createDataFrame([(*r, "p", 5, "x", 2) for r in rows], SCHEMA)
        assert fast(df) == slow([r.asDict() for r in df.collect()])
    assert fast(spark.createDataFrame([], SCHEMA)) == []


def test_a_hot_key_is_spread(spark):
    df = spark.range(4000).select(F.lit(5).alias("k"), F.lit("g").alias("group")).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = M.numbered(df, "group", ["k"])
        assert sorted(r["rank"] for r in out.collect()) == list(range(4000))
        assert len([f for f in out.inputFiles() if "sorted-leaves" in f]) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_offsets_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(M, "OFFSET_ROWS", 0)
    df = spark.createDataFrame([(*r, "p", 5, "x", 2) for r in ODD], SCHEMA)
    assert fast(df) == slow([r.asDict() for r in df.collect()])


def test_a_changed_record_is_found(spark, monkeypatch):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(20)]
    df = spark.createDataFrame([(*r, "p", 5, "x", 2) for r in rows], SCHEMA)
    real = M.build

    def broken(leaves, fanout, levels):
        dag = real(leaves, fanout, levels)
        dag.rounds = [r.withColumn("children", F.reverse("children")) for r in dag.rounds]
        return dag

    monkeypatch.setattr(M, "build", broken)
    with pytest.raises(Exception, match="another leaf"):
        fast(df)


def test_query(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").collect()
    out = M.op13_merkle_manifest(spark, D)
    want = slow([r.asDict() for r in docs])
    assert sorted((tuple(r) for r in out.collect()), key=str) == want
    assert {r[-1] for r in want} == {True, False}
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
