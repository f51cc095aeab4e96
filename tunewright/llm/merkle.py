"""Merkle manifest of a table: a content-addressed DAG, and proofs by descent from its root.

Each row is a leaf, the SHA-256 of its fields. The leaves of a group (a language, say) ascend by key; runs
of ``fanout`` consecutive nodes become the SHA-256 of their digests, level by level, until one remains.
The groups' tops form a tree of the same kind, whose top is the root.

*Building.* Rows are sorted once by ranges and numbered within their groups from the tasks' own counts,
so a group with a third of the rows is spread over many tasks. A block holds the ``fanout ** LEVELS``
consecutive nodes below one node ``LEVELS`` levels up. A round builds all blocks, one task call for each,
and stores a record (digest, children) for every node made; the blocks' tops are the nodes of the next
round. Rounds follow the logarithm of the rows: three for 10^9 rows at a fan-out of two.

*Proofs.* Requests descend. In the last round's blocks first, a request starts at the top's digest, looks
up its children, takes that named by the next digit of its rank, collects the others, and goes on from
the digest it took. The segment collected in a block is reversed, so that it leads upward, and put before
the path that the block's top got in the round above. At the bottom the digest reached must be that of
the leaf. A task holds the records of one block and the path of its top, never a whole level.

A path is bytes: for each level, from the leaf up, the number of siblings before and after (two bytes each,
little-endian) and their digests of 32 bytes, left to right.

Defined results: a null field is ``-`` and null keys come first; a null group is a group, and comes
first; rows with the same key are ordered by their digests, and rows alike in all fields are
interchangeable; an empty text has the size 0; an empty table gives an empty result. Extra columns
are left alone: only the named ones are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256
from struct import pack, unpack_from

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunewright.llm.registry import query
from tunewright.session import store

FANOUT = 2
LEVELS = 10
#: (group, task) pairs up to which their offsets are broadcast.
OFFSET_ROWS = 100_000
_RECORDS = "group string, block bigint, size bigint, digest binary, children array<binary>, top boolean"
_PATHS = "group string, rank bigint, size bigint, digest binary, changed binary, key bigint, path binary, subroot binary"


def digest_of(columns: Sequence[Column]) -> Column:
    """SHA-256 (lowercase hex) over fields: ``-`` for null, else UTF-8 byte count, ``:`` and value."""
    parts = []
    for c in columns:
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def parent(children: Sequence[bytes]) -> bytes:
    return sha256(b"".join(children).hex().encode()).digest()


def depth(size: int, fanout: int) -> int:
    """Levels above ``size`` nodes."""
    levels = 0
    while size > 1:
        size = -(-size // fanout)
        levels += 1
    return levels


def numbered(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add rank (gapless from 0 within the group, by ``order``) and size (rows of the group).

    The place in the input is the last sort key: rows alike in all keys are spread over the tasks.
    """
    keys = [group, *order, "_in"]
    df = df.withColumn("_in", F.monotonically_increasing_id())
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_in")
    placed = store(placed.withColumn("_at", F.monotonically_increasing_id()), "sorted-leaves")
    placed = placed.withColumn("_task", F.shiftright("_at", 33))
    sizes = placed.groupBy(group, "_task").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    sizes = store(sizes, "leaf-offsets")
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, 0)
    offsets = sizes.select(
        F.col(group).alias("_group"),
        F.col("_task").alias("_of"),
        "_first",
        (F.sum("_rows").over(earlier) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(whole).alias("size"),
    )
    if sizes.count() <= OFFSET_ROWS:
        offsets = F.broadcast(offsets)
    joined = placed.join(offsets, (F.col(group) == F.col("_group")) & (F.col("_task") == F.col("_of")))
    rank = F.col("_before") + F.col("_at") - F.col("_first")
    return joined.withColumn("rank", rank).drop("_at", "_task", "_first", "_before", "_group", "_of")


@dataclass
class Dag:
    """``rounds[i]``: the records made in round i; ``tops``: (group, digest) of every group."""

    rounds: list[DataFrame]
    tops: DataFrame
    fanout: int
    levels: int


def _grow(fanout: int, levels: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        size = table.column("size")[0].as_py()
        nodes = table.column("digest").to_pylist()
        made: dict[bytes, list[bytes]] = {}
        for _ in range(min(levels, depth(size, fanout))):
            runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
            nodes = [parent(r) for r in runs]
            made |= zip(nodes, runs, strict=True)
        n = len(made)
        return pa.table(
            {
                "group": pa.array([key[0].as_py()] * n, pa.string()),
                "block": pa.array([key[1].as_py()] * n, pa.int64()),
                "size": pa.array([size] * n, pa.int64()),
                "digest": pa.array(list(made), pa.binary()),
                "children": pa.array(list(made.values()), pa.list_(pa.binary())),
                "top": pa.array([d == nodes[0] for d in made], pa.bool_()),
            }
        )

    return run


def build(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> Dag:
    """Records of all nodes above ``leaves`` (group, rank, size, digest)."""
    span = fanout**levels
    nodes = leaves.select("group", "rank", "size", "digest")
    rounds: list[DataFrame] = []
    while (nodes.agg(F.max("size")).first()[0] or 0) > 1:
        blocks = nodes.filter("size > 1").withColumn("block", F.floor(F.col("rank") / span))
        made = blocks.groupBy("group", "block").applyInArrow(_grow(fanout, levels), _RECORDS)
        rounds.append(store(made, "merkle-records"))
        up = rounds[-1].filter("top").select(
            "group", F.col("block").alias("rank"), F.ceil(F.col("size") / span).alias("size"), "digest"
        )
        nodes = store(up.unionByName(nodes.filter("size = 1")), "merkle-nodes")
    return Dag(rounds, nodes.select("group", "digest"), fanout, levels)


def _descend(fanout: int, levels: int):
    def run(key: tuple[pa.Scalar, ...], nodes: pa.Table, right: pa.Table) -> pa.Table:
        children, above = {}, None
        for r in right.to_pylist():
            if r["children"] is None:
                above = r
            else:
                children[r["digest"]] = r["children"]
        paths = []
        if nodes.num_rows:
            steps = min(levels, depth(nodes.column("size")[0].as_py(), fanout))
        for rank, digest in zip(nodes.column("rank").to_pylist(), nodes.column("digest").to_pylist(), strict=True):
            at, segment = above["digest"], []
            for k in reversed(range(steps)):
                own = children[at]
                d = rank // fanout**k % fanout
                segment.append(pack("<HH", d, len(own) - d - 1) + b"".join(own[:d]) + b"".join(own[d + 1 :]))
                at = own[d]
            if at != digest:
                raise ValueError("a stored record leads to another leaf")
            paths.append(b"".join(reversed(segment)) + above["path"])
        n = nodes.num_rows
        return pa.table(
            {
                **{c: nodes.column(c) for c in ("group", "rank", "size", "digest", "changed", "key")},
                "path": pa.array(paths, pa.binary()),
                "subroot": pa.array([above["subroot"] if n else None] * n, pa.binary()),
            }
        ).cast(_PATH_TYPES)

    return run


_PATH_TYPES = pa.schema(
    [
        ("group", pa.string()), ("rank", pa.int64()), ("size", pa.int64()), ("digest", pa.binary()),
        ("changed", pa.binary()), ("key", pa.int64()), ("path", pa.binary()), ("subroot", pa.binary()),
    ]
)


def prove(leaves: DataFrame, dag: Dag, tops: DataFrame) -> DataFrame:
    """Add path and subroot to ``leaves`` (group, rank, size, digest, changed, key).

    ``tops`` has for each group its digest and the path of the group's top above it.
    """
    span = dag.fanout**dag.levels
    found = tops.select("group", F.lit(0).cast("bigint").alias("rank"), "digest", "path", "subroot")
    empty = F.lit(None).cast("binary").alias("changed"), F.lit(None).cast("bigint").alias("key")
    for i in reversed(range(len(dag.rounds))):
        if i:
            # the nodes of this round: tops of the blocks below, and groups that were a single node there
            below = dag.rounds[i - 1].filter("top")
            nodes = below.select(
                "group", F.col("block").alias("rank"), F.ceil(F.col("size") / span).alias("size"), "digest", *empty
            )
        else:
            nodes = leaves
        keyed = nodes.filter("size > 1").withColumn("block", F.floor(F.col("rank") / span))
        made = dag.rounds[i].select(
            "group", "block", "digest", "children",
            F.lit(None).cast("binary").alias("path"), F.lit(None).cast("binary").alias("subroot"),
        )
        heads = found.join(dag.rounds[i].select("group").distinct(), "group", "left_semi").select(
            "group", F.col("rank").alias("block"), "digest",
            F.lit(None).cast("array<binary>").alias("children"), "path", "subroot",
        )
        right = made.unionByName(heads).groupBy("group", "block")
        walked = keyed.groupBy("group", "block").cogroup(right).applyInArrow(_descend(dag.fanout, dag.levels), _PATHS)
        single = nodes.filter("size = 1").select("group", "rank", "size", "digest", "changed", "key")
        # a group that was a single node before this round has its path already
        rest = found.join(dag.rounds[i].select("group").distinct(), "group", "left_anti")
        if i:
            out = walked.select("group", "rank", "digest", "path", "subroot")
            found = store(out.unionByName(rest), "merkle-paths")
        else:
            alone = single.join(rest.select("group", "path", "subroot"), "group")
            return walked.unionByName(alone)
    return leaves.join(found.select("group", "path", "subroot"), "group")


def steps(path: bytes) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """The siblings before and after, level by level from the leaf up."""
    at = 0
    while at < len(path):
        a, b = unpack_from("<HH", path, at)
        at += 4
        got = [path[at + 32 * i : at + 32 * (i + 1)] for i in range(a + b)]
        at += 32 * (a + b)
        yield got[:a], got[a:]


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for before, after in steps(path):
        leaf = parent([*before, leaf, *after])
    return leaf


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        proofs, roots = [], []
        for leaf, changed, path in zip(*(b.column(c).to_pylist() for c in ("digest", "changed", "path")), strict=True):
            proofs.append(parent([x for before, after in steps(path) for x in (*before, *after)]).hex())
            roots.append(fold(leaf if changed is None else changed, path).hex())
        yield pa.RecordBatch.from_arrays(
            [b.column("key"), b.column("digest"), b.column("subroot"), pa.array(proofs, pa.string()), pa.array(roots, pa.string())],
            names=["key", "digest", "subroot", "proof", "folded"],
        )


def manifest(
    df: DataFrame,
    key: str,
    fields: Sequence[str],
    group: str,
    changed: Column | None = None,
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> tuple[DataFrame, str | None]:
    """Digests, proofs and checks of all rows, and the root (hex; None for an empty table).

    ``changed``: a digest (hex) that stands in for a row's leaf when the root is recomputed, or null.
    Columns of the result: key, digest (the leaf), subroot, path (as in the module's text), changed.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaf = F.unhex(digest_of([F.col(f) for f in fields])).alias("digest")
    other = F.unhex(changed if changed is not None else F.lit(None).cast("string")).alias("changed")
    leaves = df.select(named.alias("group"), F.col(key).cast("bigint").alias("key"), leaf, other)
    leaves = store(numbered(leaves, "group", ["key", "digest"]), "merkle-leaves")
    dag = build(leaves, fanout, levels)
    tops = dag.tops.select(F.lit("").alias("group"), F.col("group").alias("of"), "digest")
    tops = store(numbered(tops, "group", ["of"]), "merkle-tops")
    upper = build(tops, fanout, levels)
    top = upper.tops.first()
    if top is None:
        return leaves.select("key", "digest", F.lit(None).cast("binary").alias("subroot"), F.lit(None).cast("binary").alias("path"), "changed"), None
    start = upper.tops.select("group", "digest", F.lit(b"").alias("path"), F.col("digest").alias("subroot"))
    # ranks of tops serve as keys, so that the paths find back to their groups
    asked = tops.withColumn("key", F.col("rank")).withColumn("changed", F.lit(None).cast("binary"))
    paths = prove(asked.select("group", "rank", "size", "digest", "changed", "key"), upper, start)
    known = tops.select(F.col("of").alias("group"), F.col("rank").alias("key"))
    paths = store(paths.drop("group").join(known, "key"), "merkle-top-paths")
    heads = paths.select("group", "digest", "path", F.col("digest").alias("subroot"))
    return prove(leaves, dag, heads).select("key", "digest", "subroot", "path", "changed"), bytes(top["digest"]).hex()


def verified(rows: DataFrame, root: str | None) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified of the rows of ``manifest``."""
    out = rows.mapInArrow(_verify, "key bigint, digest binary, subroot binary, proof string, folded string")
    hexed = lambda c: F.lower(F.hex(c))
    return out.select(
        "key",
        hexed("digest").alias("leaf"),
        hexed("subroot").alias("subroot"),
        F.lit(root).cast("string").alias("root"),
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.lit(root)).alias("verified"),
    )


_CRC = """list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length({s}) + 1), lambda i: ascii(substr({s}, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384)))"""

_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _sql() -> str:
    def h(changed: bool) -> str:
        parts = []
        for f in _FIELDS:
            v = "(n_chars + 1)" if changed and f == "n_chars" else f
            parts.append(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')")
        return f"sha256({' || '.join(parts)})"

    return f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {h(False)} AS leaf,
    CASE WHEN xor(4294967295, {_CRC.format(s="doc_id::VARCHAR")}) % 7 = 0 THEN {h(True)} END AS changed
  FROM documents),
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY g) AS n FROM leaves),
lv(g, level, idx, n, digest) AS (
  SELECT g, 0, idx, n, leaf FROM ranked
  UNION ALL
  SELECT g, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
  FROM lv WHERE n > 1 GROUP BY g, level, idx // 2, n),
subs AS MATERIALIZED (
  SELECT g, digest AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS idx, count(*) OVER () AS n
  FROM lv WHERE n = 1),
tv(level, idx, n, digest) AS (
  SELECT 0, idx, n, subroot FROM subs
  UNION ALL
  SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
  FROM tv WHERE n > 1 GROUP BY level, idx // 2, n),
own AS (
  SELECT r.doc_id, r.leaf, r.changed, r.g, r.idx, r.n, s.subroot, s.idx AS sidx, s.n AS sn
  FROM ranked r JOIN subs s ON r.g = s.g),
path AS MATERIALIZED (
  SELECT o.doc_id, o.leaf, l.level AS step, (o.idx >> l.level) & 1 AS is_right, x.digest AS sibling
  FROM own o JOIN (SELECT DISTINCT g, level FROM lv WHERE n > 1) l ON l.g = o.g
  LEFT JOIN lv x ON x.g = o.g AND x.level = l.level AND x.idx = xor(o.idx >> l.level, 1)
  UNION ALL
  SELECT o.doc_id, o.leaf, 1000 + l.level, (o.sidx >> l.level) & 1, x.digest
  FROM own o CROSS JOIN (SELECT DISTINCT level FROM tv WHERE n > 1) l
  LEFT JOIN tv x ON x.level = l.level AND x.idx = xor(o.sidx >> l.level, 1)),
steps AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY step) AS k FROM path),
folded(doc_id, k, cur) AS (
  SELECT doc_id, 0, coalesce(changed, leaf) FROM own
  UNION ALL
  SELECT f.doc_id, f.k + 1, sha256(CASE WHEN s.is_right = 1 THEN coalesce(s.sibling, '') || f.cur
    ELSE f.cur || coalesce(s.sibling, '') END)
  FROM folded f JOIN steps s ON s.doc_id = f.doc_id AND s.k = f.k + 1),
last AS (SELECT doc_id, arg_max(cur, k) AS folded_root FROM folded GROUP BY doc_id),
proofs AS (SELECT doc_id, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM steps GROUP BY doc_id),
root AS (SELECT digest AS root FROM tv WHERE n = 1)
SELECT o.doc_id, o.leaf, o.subroot, root.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
  l.folded_root, l.folded_root = root.root AS verified
FROM own o JOIN last l ON l.doc_id = o.doc_id LEFT JOIN proofs p ON p.doc_id = o.doc_id CROSS JOIN root"""


@query("op13_merkle_manifest", _sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plus = [F.col(f) + 1 if f == "n_chars" else F.col(f) for f in _FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, digest_of(plus))
    rows, root = manifest(docs, "doc_id", _FIELDS, "lang", tampered)
    return verified(rows, root).withColumnRenamed("key", "doc_id")
