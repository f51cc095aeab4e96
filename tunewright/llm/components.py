"""Connected components of a link table, by contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.session import store


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for all ends of the links ``(a, b)``; root is the smallest node reachable.

    In each round every node points to its smallest neighbour (or itself), pointers are shortened,
    and the links between the roots that remain go to the next round. Nothing is gathered: a hub
    is a minimum with map-side combining and the wide side of joins with unique keys. Every round
    starts from files in the shared folder.
    """
    left = store(_ordered(edges.select("a", "b")), "links")
    found = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        point = store(point.select("node", F.least("node", "to").alias("to")), "pointers")
        for _ in range(2):
            point = _follow(point, "to", point)
        point = store(point, "pointers")
        if found is None:
            found = point.withColumnRenamed("to", "root")
        else:
            found = store(_follow(found, "root", point), "roots")
        left = store(_ordered(_follow(_follow(left, "a", point), "b", point)), "links")
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found


def _ordered(edges: DataFrame) -> DataFrame:
    small = F.least("a", "b").alias("a")
    return edges.filter("a <> b").select(small, F.greatest("a", "b").alias("b")).distinct()


def _follow(df: DataFrame, column: str, point: DataFrame) -> DataFrame:
    """Replace ``column`` by where it points."""
    p = point.select(F.col("node").alias("_node"), F.col("to").alias("_to"))
    out = df.join(p, F.col(column) == F.col("_node"), "left")
    return out.withColumn(column, F.coalesce("_to", column)).select(df.columns)


class Union:
    """Components of numbers 0..n-1 within a task; links come in arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up
