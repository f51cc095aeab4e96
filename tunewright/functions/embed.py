"""Text to vector. An embedder is a factory of ``list[str] -> (n, dim) array``.

The factory runs once per Python task, so a model is loaded once and used for many batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tunewright.functions import text as tx
from tunewright.functions.vectors import from_matrix, row_slices

Encoder = Callable[[list[str]], np.ndarray]
EmbedderFactory = Callable[[], Encoder]

DEFAULT_DIM = 64
TOKENS = 1 << 19  # tokens that are hashed at once


def _bucket_and_sign(words: list[str], dim: int) -> tuple[np.ndarray, np.ndarray]:
    digests = [hashlib.md5(w.encode()).hexdigest() for w in words]
    bucket = np.array([int(d[:4], 16) % dim for d in digests], dtype=np.int64)
    sign = np.array([1.0 if d[4] < "8" else -1.0 for d in digests])
    return bucket, sign


def _hashed(tokens: pa.Array, dim: int) -> np.ndarray:
    n = len(tokens)
    coded = tokens.flatten().dictionary_encode()
    if not len(coded):
        return np.zeros((n, dim))
    bucket, sign = _bucket_and_sign(coded.dictionary.to_pylist(), dim)
    codes = coded.indices.to_numpy()
    rows = pc.list_parent_indices(tokens).to_numpy()
    weights = sign[codes]
    return np.bincount(rows * dim + bucket[codes], weights=weights, minlength=n * dim).reshape(n, dim)


def _in_slices(tokens: pa.Array, dim: int) -> np.ndarray:
    """Some rows at a time: the numbers of their tokens take more room than the tokens."""
    out = np.zeros((len(tokens), dim))
    for i, n in row_slices(tokens, items=TOKENS):
        out[i : i + n] = _hashed(tokens.slice(i, n), dim)
    return out


def hashed(c: Column, dim: int = DEFAULT_DIM) -> Column:
    """Built-in embedder: signed feature hashing of words.

    Words are made by Spark; Python hashes each distinct word of ``TOKENS`` once.
    """

    @F.arrow_udf("array<double>")
    def encode(tokens: pa.Array) -> pa.Array:
        return from_matrix(_in_slices(tokens, dim))

    return encode(tx.words(c))


def embed(c: Column, factory: EmbedderFactory | None = None, dim: int = DEFAULT_DIM) -> Column:
    """Embed a text column with a caller's model, or with the built-in one.

    A model counts as non-deterministic, so the optimizer does not copy the call into filters.
    """
    if factory is None:
        return hashed(c, dim)

    @F.arrow_udf("array<double>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        for batch in batches:
            texts = ["" if t is None else t for t in batch.to_pylist()]
            yield from_matrix(np.asarray(model(texts), dtype=np.float64))

    return encode.asNondeterministic()(c)


def embed_phrases(
    spark, phrases, factory: EmbedderFactory | None = None, dim: int = DEFAULT_DIM
) -> np.ndarray:
    """Vectors of a short configured list of phrases, made by the same embedder."""
    rows = (
        spark.createDataFrame([(i, p) for i, p in enumerate(phrases)], "i int, p string")
        .select("i", embed(F.col("p"), factory, dim).alias("v"))
        .collect()
    )
    return np.array([r.v for r in sorted(rows, key=lambda r: r.i)], dtype=np.float64)
