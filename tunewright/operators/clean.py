"""Cleaning: missing values, white space, case, exact duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.functions import text as tx
from tunewright.operators.rank import as_list
from tunewright.specs import CleanSpec


def targets(df: DataFrame, columns: Sequence[str] = ()) -> list[str]:
    """The columns a step works on: the named ones, or all."""
    names = list(columns) or df.columns
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise KeyError(f"columns {missing} not found. Available: {sorted(df.columns)}")
    return names


def drop_missing(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Drop rows where any target is null or NaN. Empty text stays."""
    return df.na.drop("any", subset=targets(df, columns))


def strip(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    names = tx.string_columns(df, targets(df, columns))
    return df.withColumns({c: tx.strip(F.col(f"`{c}`")) for c in names})


def lower(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    names = tx.string_columns(df, targets(df, columns))
    return df.withColumns({c: F.lower(F.col(f"`{c}`")) for c in names})


def dedup_exact(
    df: DataFrame, columns: Sequence[str] = (), key: str | Sequence[str] | None = None
) -> DataFrame:
    """Keep the row with the lowest key of each group of equal targets; nulls are equal.

    Grouping combines on the map side, so a text that fills a third of the table leaves one row per
    task before the shuffle. A 64-bit hash leads the grouping key: sorting compares whole texts
    only where the hashes meet.
    """
    names = targets(df, columns)
    if set(names) == set(df.columns):
        return df.dropDuplicates()
    if key is None:
        raise ValueError("dedup on some of the columns needs a key to define the first row")
    rest = [c for c in df.columns if c not in names]
    if rest == as_list(key) and len(rest) == 1:
        # only the key is left over: a plain minimum, which hashes instead of sorting
        return df.groupBy(*names).agg(F.min(rest[0]).alias(rest[0])).select(*df.columns)
    place = F.struct(*[F.col(f"`{k}`") for k in as_list(key)])
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), place).alias("_first")
    by = [F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("_h"), *[F.col(f"`{c}`") for c in names]]
    grouped = df.groupBy(*by).agg(first)
    return grouped.select(
        *[F.col(f"_first.`{c}`").alias(c) if c in rest else F.col(f"`{c}`") for c in df.columns]
    )


def clean(
    df: DataFrame, spec: CleanSpec = CleanSpec(), key: str | Sequence[str] | None = None
) -> DataFrame:
    """Missing, strip, lower, duplicates, in this order; each can be switched off.

    Without ``columns`` all columns are targets except the key, which exists only to give rows an
    order.
    """
    names = list(spec.columns)
    if not names and key is not None:
        names = [c for c in df.columns if c not in as_list(key)]
    if spec.drop_missing:
        df = drop_missing(df, names)
    if spec.strip:
        df = strip(df, names)
    if spec.lower:
        df = lower(df, names)
    if spec.drop_duplicates:
        df = dedup_exact(df, names, key)
    return df
