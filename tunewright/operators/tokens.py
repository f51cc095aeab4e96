"""Tokenise and truncate."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.functions import text as tx

TokenizerFactory = Callable[[], Callable[[list[str]], list[list[int]]]]

BLANKS = "[ \t\n\r]+"


def tokenize(
    df: DataFrame,
    column: str,
    max_length: int,
    factory: TokenizerFactory | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Token sequences of at most ``max_length``; other columns are dropped unless kept.

    The built-in tokenizer splits at blanks and stays in Catalyst. A factory supplies a model's
    tokenizer, made once per task and called once per batch.
    """
    if factory is None:
        tokens = tx.split_words(F.coalesce(F.col(column), F.lit("")), BLANKS)
    else:

        @F.arrow_udf("array<int>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            tokenizer = factory()
            for batch in batches:
                texts = ["" if t is None else t for t in batch.to_pylist()]
                yield pa.array(tokenizer(texts), pa.list_(pa.int32()))

        tokens = encode(F.col(column))
    return df.select(*keep, tokens.alias("_all")).select(
        *keep,
        F.slice("_all", 1, max_length).alias("tokens"),
        F.least(F.size("_all"), F.lit(max_length)).alias("n_tokens"),
        (F.size("_all") > max_length).alias("was_truncated"),
    )
