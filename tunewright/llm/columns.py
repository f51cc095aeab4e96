"""Rows under plain column names, for operators that add columns of their own on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plain(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same rows with columns named c0, c1 ..., and the new name of each: no name of the input can be
    that of a column which is added.
    """
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def restored(out: DataFrame, names: dict[str, str]) -> DataFrame:
    """The input's columns again, under their names."""
    return out.select(*names.values()).toDF(*names)
