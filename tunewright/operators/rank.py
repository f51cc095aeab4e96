"""Seeded order and exact selection of "the first n rows" in it, without a global sort.

Rows get a place by ``md5(seed|key)``. The digest spreads rows evenly, so its first hex digits cut
any table into buckets of equal size, whatever the data looks like. Counting buckets (map-side
combined, at most 16**digits rows) tells which bucket holds the n-th row; only that bucket is
sorted. The digest of the n-th row is then a constant, and the selection itself is a filter: the
wide rows are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

DIGITS = 4  # 65,536 buckets: 1e11 rows leave 1.5 million narrow rows in each
BUCKET_ROWS = 1000  # below 65,536 buckets, about so many rows share one
HASH = "_order_hash"
BUCKET = "_order_bucket"

# A lookup of at most this many narrow rows may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000
SALTS = 256


def as_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def order_hash(key: str | Sequence[str], seed: int) -> Column:
    """``md5(seed|key)`` as text.

    The parts of a key of several columns carry their length, or ``~`` for null, so that different
    keys never give one text.
    """
    names = as_list(key)
    parts = [F.col(f"`{k}`").cast("string") for k in names]
    if len(names) > 1:
        parts = [
            F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("~"))
            for p in parts
        ]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def digits_for(rows: int) -> int:
    """Hex digits that give a table of this size enough buckets, and not many more."""
    digits = 1
    while digits < DIGITS and 16**digits * BUCKET_ROWS < rows:
        digits += 1
    return digits


def bucket_of(h: Column, digits: int = DIGITS) -> Column:
    return F.substring(h, 1, digits)


def require_unique(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Raise if the key repeats. One shuffle of the key columns."""
    names = as_list(key)
    clash = df.groupBy(*names).count().filter("count > 1").limit(1).collect()
    if clash:
        raise ValueError(f"key {names} is not unique, e.g. {clash[0].asDict()}")
    return df


def bucketed_rank(df: DataFrame, bucket: str, order: list[Column], out: str) -> DataFrame:
    """Exact 1-based rank by (bucket, order).

    ``bucket`` must be a column of bounded cardinality that never decreases along the order. The
    offsets hold one row per bucket, so their single-task window and broadcast are bounded.
    """
    counts = df.groupBy(bucket).agg(F.count("*").alias("_n"))
    before = W.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy(bucket).orderBy(*order)
    return (
        df.join(F.broadcast(offsets), bucket)
        .withColumn(out, (F.row_number().over(inside) + F.col("_before")).cast("long"))
        .drop("_before")
    )


def seeded_rank(
    df: DataFrame, key: str | Sequence[str], seed: int, out: str = "rank", digits: int = DIGITS
) -> DataFrame:
    """Every row's 1-based place in the seeded order."""
    h = order_hash(key, seed)
    keyed = df.withColumn(HASH, h).withColumn(BUCKET, bucket_of(F.col(HASH), digits))
    return bucketed_rank(keyed, BUCKET, [F.col(HASH)], out).drop(HASH, BUCKET)


def global_cuts(
    df: DataFrame, key: str | Sequence[str], seed: int, wants, digits: int = DIGITS
) -> tuple[int, list[str | None]]:
    """Row count, and the order hash of the n-th row for each n in ``wants(count)``.

    A cut is None where n < 1. Two passes over the key columns; the driver sees bucket counts (at
    most 16**digits) and the cuts.
    """
    hashes = df.select(order_hash(key, seed).alias(HASH)).withColumn(
        BUCKET, bucket_of(F.col(HASH), digits)
    )
    counts = sorted((r[0], r[1]) for r in hashes.groupBy(BUCKET).count().collect())
    total = sum(n for _, n in counts)
    targets = wants(total)
    needed: dict[str, list[tuple[int, int]]] = {}
    for slot, want in enumerate(targets):
        seen = 0
        for bucket, n in counts:
            if seen < want <= seen + n:
                needed.setdefault(bucket, []).append((slot, want - seen))
                break
            seen += n
    cuts: list[str | None] = [None] * len(targets)
    if needed:
        inside = W.partitionBy(BUCKET).orderBy(HASH)
        test = F.lit(False)
        for bucket, slots in needed.items():
            for _, place in slots:
                test = test | ((F.col(BUCKET) == bucket) & (F.col("_place") == place))
        found = (
            hashes.filter(F.col(BUCKET).isin(list(needed)))
            .withColumn("_place", F.row_number().over(inside))
            .filter(test)
            .collect()
        )
        at = {(r[BUCKET], r["_place"]): r[HASH] for r in found}
        for bucket, slots in needed.items():
            for slot, place in slots:
                cuts[slot] = at[(bucket, place)]
    return total, cuts


def first_in_order(df: DataFrame, key: str | Sequence[str], seed: int, n: int) -> DataFrame:
    """Exactly the first ``n`` rows of the seeded order (all rows if there are no more)."""
    total, (cut,) = global_cuts(df, key, seed, lambda total: [min(n, total)])
    if total <= n:
        return df
    if cut is None:
        return df.limit(0)
    return df.filter(order_hash(key, seed) <= F.lit(cut))


def stratum_cuts(
    df: DataFrame,
    stratum: str,
    key: str | Sequence[str],
    seed: int,
    wants: DataFrame,
    names: list[str],
    strata: int,
    digits: int = DIGITS,
) -> DataFrame:
    """Per stratum, the order hash of the n-th row for each column of ``wants``.

    ``wants`` holds the stratum and one count column per name, ``strata`` its number of rows. The
    result has the stratum and, under each name, the cut (null where the count is below 1).
    """
    bounded = F.broadcast if strata * len(names) <= BROADCAST_ROWS else (lambda df: df)
    h = df.filter(F.col(f"`{stratum}`").isNotNull()).select(
        F.col(f"`{stratum}`").alias("_s"), order_hash(key, seed).alias(HASH)
    )
    h = h.withColumn(BUCKET, bucket_of(F.col(HASH), digits))
    upto = W.partitionBy("_s").orderBy(BUCKET)
    counts = (
        h.groupBy("_s", BUCKET)
        .agg(F.count("*").alias("_n"))
        .withColumn("_hi", F.sum("_n").over(upto))
        .withColumn("_lo", F.col("_hi") - F.col("_n"))
    )
    targets = wants.select(
        F.col(f"`{stratum}`").alias("_s"),
        F.explode(
            F.array(
                *[F.struct(F.lit(n).alias("_name"), F.col(n).alias("_want")) for n in names]
            )
        ).alias("_t"),
    ).select("_s", "_t._name", "_t._want")
    crossing = (
        counts.join(bounded(targets), "_s")
        .filter("_lo < _want AND _want <= _hi")
        .select("_s", BUCKET, "_name", (F.col("_want") - F.col("_lo")).alias("_need"))
    )
    # (stratum, bucket) keeps a hot stratum spread over all buckets
    inside = W.partitionBy("_s", BUCKET, "_name").orderBy(HASH)
    cuts = (
        h.join(bounded(crossing), ["_s", BUCKET])
        .withColumn("_place", F.row_number().over(inside))
        .filter("_place = _need")
        .groupBy("_s")
        .agg(*[F.max(F.when(F.col("_name") == n, F.col(HASH))).alias(n) for n in names])
    )
    return cuts.withColumnRenamed("_s", stratum)


def attach(df: DataFrame, lookup: DataFrame, on: str, rows: int, spread: Column) -> DataFrame:
    """Left join of wide rows with a lookup of a known number of rows.

    A small lookup is broadcast. A larger one is repeated once per salt and the wide side gets a
    salt from ``spread`` (an order hash), so one hot value fills many tasks, not one.
    """
    if rows <= BROADCAST_ROWS:
        return df.join(F.broadcast(lookup), on, "left")
    salted = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.conv(F.substring(spread, 1, 2), 16, 10).cast("int")
    return df.withColumn("_salt", salt).join(salted, [on, "_salt"], "left").drop("_salt")


RANGE_ROWS = 1_000_000  # so many narrow rows may be sorted in one task
GROUP_LIMIT = 999  # up to here Spark keeps only n rows per group before the shuffle
GROUPS = 256


def smallest(df: DataFrame, order: list[str], n: int, tree: bool = True) -> DataFrame:
    """The ``n`` smallest rows. As a tree: per task, then per group of tasks, then overall, so the
    last task sees ``GROUPS * n`` rows however many tasks there are."""
    if tree and n <= GROUP_LIMIT:
        inside = W.partitionBy("_group").orderBy(*order)
        df = (
            df.withColumn("_group", F.spark_partition_id() % GROUPS)
            .withColumn("_place", F.row_number().over(inside))
            .filter(F.col("_place") <= n)
            .drop("_group", "_place")
        )
    return df.orderBy(*order).limit(n)


def first_by_hash(rows: DataFrame, n: int, total: int, after: str = "") -> pa.Table:
    """The ``n`` rows with the lowest order hashes above ``after``, fetched to the driver.

    Hashes are uniform, so a bound on them leaves about ``2 * n`` rows to sort. It is widened if
    the rows have been thinned out.
    """
    start = int(after, 16) / 16**32 if after else 0.0
    width = 2.0 * n / max(total, 1)
    rows = rows.filter(F.col(HASH) > after)
    while True:
        upto = start + width
        some = rows if upto >= 1 else rows.filter(F.col(HASH) < f"{int(upto * 16**32):032x}")
        batch = some.orderBy(HASH).limit(n).toArrow()
        if batch.num_rows == n or upto >= 1:
            return batch
        width *= 4


def first_by_columns(
    df: DataFrame, order: list[str], n: int, topk: int = GROUP_LIMIT, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """The first ``n`` rows by plain columns, which must identify a row together.

    Only the order columns are searched for the n-th row; the rows are then selected by comparison
    with it, a filter that reaches the scan. Up to ``topk`` rows the search is a top-k tree. Beyond,
    the order columns are range partitioned (and checkpointed, so that the ranges stand still) and
    counts per range tell where the n-th row is. That range is cut again until it is small.
    """
    place = F.struct(*[F.col(f"`{c}`") for c in order])
    if n <= topk:
        narrow = df.select(*[F.col(f"`{c}`") for c in order])
        last = smallest(narrow, order, n).agg(F.count("*"), F.max(place)).first()
        if last[0] < n:
            return df
        if n < 1:
            return df.limit(0)
        lead = F.col(f"`{order[0]}`")
        fields = [F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, last[1])]
        near = lead.isNull() if last[1][0] is None else lead.isNull() | (lead <= F.lit(last[1][0]))
        return df.filter(near & (place <= F.struct(*fields)))
    from tunewright.session import cut_lineage

    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows, need, before = df.select(place.alias("_o")), n, 0
    while True:
        ranged = cut_lineage(
            rows.repartitionByRange(parts, "_o").withColumn("_range", F.spark_partition_id())
        )
        at, size = None, 0
        for r in sorted(ranged.groupBy("_range").count().collect(), key=lambda r: r["_range"]):
            if need <= r["count"]:
                at, size = r["_range"], r["count"]
                break
            need -= r["count"]
        if at is None:
            return df
        rows = ranged.filter(F.col("_range") == at).select("_o")
        # a range that does not shrink holds one value
        if size <= range_rows or size == before:
            break
        before = size
    # the last of the first ``need`` rows: a top-k of a bounded range
    cut = rows.orderBy("_o").limit(need).agg(F.max("_o").alias("_o"))
    return df.join(F.broadcast(cut), place <= F.col("_o")).drop("_o")  # one row
