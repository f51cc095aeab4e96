"""Bottom-k sketches: the lowest order hashes of each stratum, with its size, in one pass of the keys."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunewright.operators.rank import GROUPS, HASH, order_hash

#: Sketches hold so many hashes at most; larger samples find their cuts by counts.
MOST = 1_000
#: Keys that a task holds before it gives out its sketches and begins new ones.
HELD = 1 << 20


def fits(df: DataFrame, stratum: str, k: int) -> bool:
    """Can strata of this column have sketches of ``k`` hashes?"""
    kind = df.schema[stratum].dataType
    return 1 <= k <= MOST and isinstance(kind, T.AtomicType) and not isinstance(kind, T.VariantType)


class _Sketches:
    """Sizes and lowest hashes of the strata that a task has seen."""

    def __init__(self, k: int):
        self.k, self.held = k, []

    def rows(self) -> int:
        return sum(len(b[1]) for b in self.held)

    def add(self, strata: pa.Array, hashes: pa.Array) -> None:
        self.held.append((strata, hashes, np.ones(len(hashes), "i8")))

    def shrink(self) -> None:
        """Keep ``k`` hashes a stratum; the first of them has the count of those that went."""
        if not self.held:
            return
        strata = pa.concat_arrays([b[0] for b in self.held])
        hashes = pa.concat_arrays([b[1] for b in self.held])
        n = np.concatenate([b[2] for b in self.held])
        codes = pc.fill_null(strata.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        by = np.lexsort((hashes.to_numpy(zero_copy_only=False).astype("S32"), codes))
        codes, n = codes[by], n[by]
        first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(by) else by
        sizes = np.diff(np.append(first, len(by)))
        place = np.arange(len(by)) - np.repeat(first, sizes)
        # the null stratum is counted and never drawn
        kept = np.flatnonzero((place < self.k) & ((codes >= 0) | (place == 0)))
        total = np.add.reduceat(n, first) if len(by) else n
        left = np.zeros(len(by), "i8")
        left[first] = total
        at = pa.array(by[kept])
        self.held = [(strata.take(at), hashes.take(at), left[kept])]

    def take(self, schema: pa.Schema) -> pa.RecordBatch | None:
        """All sketches, one row a stratum."""
        self.shrink()
        if not self.rows():
            return None
        strata, hashes, n = self.held.pop()
        first = np.flatnonzero(n)
        ends = np.append(first, len(n)).astype("i4")
        columns = [strata.take(pa.array(first)), pa.array(n[first]), pa.ListArray.from_arrays(ends, hashes)]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _partial(k: int, held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, schema = _Sketches(k), None
        for b in batches:
            if schema is None:
                kind = b.schema.field(0).type
                fields = [("_s", kind), ("_size", pa.int64()), ("_low", pa.list_(b.schema.field(1).type))]
                schema = pa.schema(fields)
            found.add(b.column(0), b.column(1))
            if found.rows() > held:
                found.shrink()
                if found.rows() > held // 2:
                    yield found.take(schema)
        last = found.take(schema)
        if last is not None:
            yield last

    return run


def _lowest(k: int) -> list[Column]:
    low = F.slice(F.array_sort(F.flatten(F.collect_list("_low"))), 1, k)
    return [F.sum("_size").alias("_size"), low.alias("_low")]


def sketches(
    df: DataFrame, stratum: str, key: str | Sequence[str], seed: int, k: int, held: int = HELD
) -> DataFrame:
    """``(_s, _size, _low)``: each stratum, the number of its rows and its ``k`` lowest order hashes in
    order (all, if it has fewer). What the null stratum has as hashes is not defined.

    Tasks reduce their rows to sketches in bounded memory; sketches merge per group of tasks and then
    overall, so a stratum with a third of all rows is ``GROUPS`` sketches to its last task.
    """
    narrow = df.select(F.col(f"`{stratum}`").alias("_s"), order_hash(key, seed).alias(HASH))
    kind = T.StructType(
        [
            T.StructField("_s", narrow.schema["_s"].dataType),
            T.StructField("_size", T.LongType()),
            T.StructField("_low", T.ArrayType(T.StringType())),
        ]
    )
    parts = narrow.mapInArrow(_partial(k, held), kind)
    parts = parts.withColumn("_group", F.spark_partition_id() % GROUPS)
    merged = parts.groupBy("_s", "_group").agg(*_lowest(k))
    return merged.groupBy("_s").agg(*_lowest(k))
