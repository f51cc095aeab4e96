"""Token vectors and greedy token matching (the arithmetic of BERTScore)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# A token encoder maps the tokens of one text to an (n, dim) matrix.
TokenEncoder = Callable[[list[str]], np.ndarray]
TokenEncoderFactory = Callable[[], TokenEncoder]

ROWS = 2048  # tokens compared at a time, so a pair of long texts stays small in memory


def digest_vectors(tokens: list[str]) -> np.ndarray:
    """Built-in vectors: the 32 hex digits of a token's md5, centred."""
    raw = bytes.fromhex("".join(hashlib.md5(t.encode()).hexdigest() for t in tokens))
    bytes_ = np.frombuffer(raw, dtype=np.uint8).reshape(len(tokens), 16)
    digits = np.stack([bytes_ >> 4, bytes_ & 15], axis=2).reshape(len(tokens), 32)
    return digits.astype(np.float64) - 7.5


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    norms[norms == 0] = 1.0
    return m / norms


def match(p: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best cosine of each p row among r, and of each r row among p."""
    best_p, best_r = np.empty(len(p)), np.full(len(r), -np.inf)
    for at in range(0, len(p), ROWS):
        sims = p[at : at + ROWS] @ r.T
        best_p[at : at + ROWS] = sims.max(axis=1)
        np.maximum(best_r, sims.max(axis=0), out=best_r)
    return best_p, best_r


def best_match_scores(
    predicted: Column, expected: Column, factory: TokenEncoderFactory | None = None
) -> Column:
    """``[precision, recall]`` per row; zero if either side has no tokens.

    The built-in vectors do not depend on context, so repeated tokens are compared once and
    weighted, and every distinct token of a batch gets its vector once. A factory's encoder sees
    each text as a whole.
    """

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encoder = factory() if factory else None
        for ps, rs in batches:
            out = []
            if encoder is None:
                both = pa.concat_arrays([ps.flatten(), rs.flatten()]).dictionary_encode()
                table = _unit(digest_vectors(both.dictionary.to_pylist())) if len(both) else None
                codes = both.indices.to_numpy()
                p_at = np.r_[0, ps.value_lengths().to_numpy().cumsum()]
                r_at = np.r_[0, rs.value_lengths().to_numpy().cumsum()] + p_at[-1]
                for i in range(len(ps)):
                    p = codes[p_at[i] : p_at[i + 1]]
                    r = codes[r_at[i] : r_at[i + 1]]
                    if not len(p) or not len(r):
                        out.append([0.0, 0.0])
                        continue
                    pu, pn = np.unique(p, return_counts=True)
                    ru, rn = np.unique(r, return_counts=True)
                    bp, br = match(table[pu], table[ru])
                    out.append([float(bp @ pn / len(p)), float(br @ rn / len(r))])
            else:
                for p, r in zip(ps.to_pylist(), rs.to_pylist()):
                    if not p or not r:
                        out.append([0.0, 0.0])
                        continue
                    bp, br = match(_unit(np.asarray(encoder(p))), _unit(np.asarray(encoder(r))))
                    out.append([float(bp.mean()), float(br.mean())])
            yield pa.array(out, pa.list_(pa.float64()))

    return run(predicted, expected)
