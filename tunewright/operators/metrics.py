"""Corpus metrics over keyed pairs ``(key, prediction, reference[, answerable])``.

Every metric is a function of a pairs table and returns the long table
``(metric, sub_metric, value)``, with one block of rows per group if ``by`` is given. Values are
means over rows at six decimals; no rows give zeros. The ``*_scores`` functions return one row per
pair.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunewright.functions import embed as em
from tunewright.functions import text as tx
from tunewright.functions import vectors as vx
from tunewright.functions.stem import stem_tokens
from tunewright.functions.token_vectors import TokenEncoderFactory, best_match_scores
from tunewright.specs import REFUSAL_MESSAGE

#: Of pairs, and of pairs and group columns where groups are asked for.
Metric = Callable[..., DataFrame]
#: An aggregate over row scores, which it gets by their names.
Value = Callable[[Callable[[str], Column]], Column]
TOKENS = 1 << 16  # tokens of both sides that are scored at once
TINY = 1e-9  # fixed value: keeps refusal ratios from dividing by zero


def long_table(df: DataFrame, metric: str, values: dict[str, Column], by: Sequence[str] = ()):
    """Aggregate once, then turn the value columns into rows."""
    return _long(df, [(metric, k, v) for k, v in values.items()], by)


def _long(df: DataFrame, values: Sequence[tuple[str, str, Column]], by: Sequence[str]) -> DataFrame:
    cells = [F.round(F.coalesce(v, F.lit(0.0)), 6) for _, _, v in values]
    wide = df.groupBy(*by).agg(*[c.alias(f"_value{i}") for i, c in enumerate(cells)])
    rows = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"),
                F.lit(sub).alias("sub_metric"),
                F.col(f"_value{i}").alias("value"),
            )
            for i, (metric, sub, _) in enumerate(values)
        ]
    )
    return wide.select(*by, F.inline(rows))


@dataclass(frozen=True)
class RowMetric:
    """A metric whose values aggregate scores of single rows.

    ``rows`` gives the score columns of a pairs table, ``values`` the aggregates over them. Several
    such metrics run in one pass over the pairs.
    """

    name: str
    rows: Callable[[DataFrame], dict[str, Column]]
    values: Callable[[], dict[str, Value]]

    def __call__(self, pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        return in_one_pass(pairs, [self], by)


def in_one_pass(pairs: DataFrame, metrics: Sequence[RowMetric], by: Sequence[str] = ()) -> DataFrame:
    """One select of all row scores (with the group columns), one aggregate."""
    columns, values = [F.col(c) for c in by], []
    for i, m in enumerate(metrics):
        # names of their own: two metrics may score under one name
        columns += [c.alias(f"_{i}_{k}") for k, c in m.rows(pairs).items()]
        values += [(m.name, k, _renamed(v, i)) for k, v in m.values().items()]
    return _long(pairs.select(*columns), values, by)


def _renamed(value: Value, i: int) -> Column:
    return value(lambda name: F.col(f"_{i}_{name}"))


def _mean(name: str) -> Value:
    return lambda col: F.avg(col(name))


# ROUGE ------------------------------------------------------------------------------------------


def _f1(overlap: Column, predicted: Column, expected: Column) -> Column:
    # 2PR / (P + R) = 2 * overlap / (predicted + expected)
    return F.when(overlap > 0, 2.0 * overlap / (predicted + expected)).otherwise(0.0)


def _tokens(stem: bool) -> tuple[Column, Column]:
    sides = tx.score_tokens(F.col("prediction")), tx.score_tokens(F.col("reference"))
    return tuple(map(stem_tokens, sides)) if stem else sides


def _coded(p: pa.Array, r: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """Row and token number of every token of both sides, and how many numbers there are."""
    coded = pa.concat_arrays([p.flatten(), r.flatten()]).dictionary_encode()
    rows = [pc.list_parent_indices(side).to_numpy() for side in (p, r)]
    sides = np.split(coded.indices.to_numpy().astype(np.int64), [len(rows[0])])
    return rows, sides, max(1, len(coded.dictionary))


def _grams(rows: list, sides: list, words: int, n: int) -> tuple[list, list, int]:
    """Row and number of every n-gram: each is the (n-1)-gram before it and one more token."""
    at, gram, size = rows, sides, words
    for k in range(1, n):
        whole = [len(x) - k for x in sides]
        ends = [x[k:] for x in sides]
        same = [x[k:] == x[:-k] if len(x) > k else np.zeros(0, bool) for x in rows]
        head = [g[: max(0, m)] for g, m in zip(gram, whole, strict=True)]
        keys = [h * words + e for h, e in zip(head, ends, strict=True)]
        _, numbers = np.unique(np.concatenate(keys), return_inverse=True)
        size = int(numbers.max(initial=0)) + 1
        gram = np.split(numbers, [len(keys[0])])
        at = [np.where(ok, x[: len(ok)], -1) for ok, x in zip(same, rows, strict=True)]
    kept = [x >= 0 for x in at]
    return (
        [x[k] for x, k in zip(at, kept, strict=True)],
        [g[k] for g, k in zip(gram, kept, strict=True)],
        size,
    )


def _clipped(rows: list, grams: list, size: int, n: int) -> np.ndarray:
    """Per row the n-grams that both sides share, each as often as the side that has fewer."""
    (a, na), (b, nb) = (
        np.unique(row * size + gram, return_counts=True) for row, gram in zip(rows, grams, strict=True)
    )
    both, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    return np.bincount(both // size, weights=np.minimum(na[ia], nb[ib]), minlength=n).astype(np.int64)


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


def _by_slices(score, p: pa.Array, r: pa.Array) -> pa.Array:
    """``score`` on some rows of a batch at a time: its numbers for tokens take more room than the tokens."""
    parts = [score(p.slice(i, n), r.slice(i, n)) for i, n in vx.row_slices(p, r, items=TOKENS)]
    return pa.concat_arrays(parts) if parts else score(p, r)


@F.arrow_udf(_longs("n1", "n2", "lcs", "p", "r"))
def _shared(p: pa.Array, r: pa.Array) -> pa.Array:
    """Shared unigrams and bigrams, longest common subsequence, and the tokens of each side."""
    return _by_slices(_shared_of, p, r)


def _shared_of(p: pa.Array, r: pa.Array) -> pa.Array:
    rows, sides, words = _coded(p, r)
    ones = _clipped(*_grams(rows, sides, words, 1), len(p))
    twos = _clipped(*_grams(rows, sides, words, 2), len(p))
    sizes = [np.bincount(x, minlength=len(p)) for x in rows]
    return pa.StructArray.from_arrays(
        [pa.array(x, pa.int64()) for x in (ones, twos, _lcs(rows, sides, words, len(p)), *sizes)],
        names=["n1", "n2", "lcs", "p", "r"],
    )


def _overlap(n: int):
    def of(p: pa.Array, r: pa.Array) -> pa.Array:
        rows, sides, words = _coded(p, r)
        shared = _clipped(*_grams(rows, sides, words, n), len(p))
        sizes = [np.bincount(x, minlength=len(p)) for x in rows]
        return pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in (shared, *sizes)], names=["n", "p", "r"]
        )

    @F.arrow_udf(_longs("n", "p", "r"))
    def overlap(p: pa.Array, r: pa.Array) -> pa.Array:
        return _by_slices(of, p, r)

    return overlap


def _of_grams(overlap: Column, s: Column, n: int) -> Column:
    p, r = (F.greatest(s[k] - (n - 1), F.lit(0)) for k in ("p", "r"))
    return _f1(overlap, p, r)


def rouge_n_scores(pairs: DataFrame, key: str, n: int, stem: bool = True, out: str | None = None):
    """ROUGE-n F1 per row. A map: both texts are in the row, so n-grams are counted there."""
    s = F.col("_s")
    scored = pairs.select(key, _overlap(n)(*_tokens(stem)).alias("_s"))
    return scored.select(key, _of_grams(s["n"], s, n).alias(out or f"rouge{n}"))


def lcs_length(a: list, b: list) -> int:
    """Length of the longest common subsequence; one machine word handles 64 cells
    (Hyyro 2004)."""
    if len(a) > len(b):
        a, b = b, a
    where: dict = {}
    for i, token in enumerate(a):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for token in b:
        match = row & where.get(token, 0)
        if match:
            row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def _lcs(rows: list, sides: list, words: int, n: int) -> np.ndarray:
    """Per row; tokens that the other text of the pair lacks are left out first."""
    keys = [row * words + code for row, code in zip(rows, sides, strict=True)]
    shared = []
    for mine, other in ((0, 1), (1, 0)):
        keep = np.isin(keys[mine], keys[other])
        ends = np.bincount(rows[mine][keep], minlength=n).cumsum()
        shared.append([x.tolist() for x in np.split(sides[mine][keep], ends[:-1])])
    return np.array([lcs_length(a, b) for a, b in zip(*shared, strict=True)][:n], np.int64)


ROUGE = ("rouge1", "rouge2", "rougeL")


def _rouge_parts(s: Column) -> dict[str, Column]:
    scores = _of_grams(s["n1"], s, 1), _of_grams(s["n2"], s, 2), _f1(s["lcs"], s["p"], s["r"])
    return dict(zip(ROUGE, scores, strict=True))


def rouge_scores(pairs: DataFrame, key: str, stem: bool = True) -> DataFrame:
    """ROUGE-1, ROUGE-2 and ROUGE-L F1 per row. A map over the rows."""
    scored = pairs.select(key, _shared(*_tokens(stem)).alias("_s"))
    return scored.select(key, *[c.alias(k) for k, c in _rouge_parts(F.col("_s")).items()])


def rouge_l_scores(pairs: DataFrame, key: str, stem: bool = True, out: str = "rougeL"):
    """ROUGE-L F1 per row. A map over the rows."""
    return rouge_scores(pairs, key, stem).select(key, F.col("rougeL").alias(out))


def rouge_metric(stem: bool = True) -> RowMetric:
    def mean(name: str):
        return lambda col: F.avg(_rouge_parts(col("shared"))[name])

    return RowMetric(
        "rouge",
        lambda pairs: {"shared": _shared(*_tokens(stem))},
        lambda: {k: mean(k) for k in ROUGE},
    )


def rouge(pairs: DataFrame, key: str = "id", stem: bool = True, by: Sequence[str] = ()):
    return rouge_metric(stem)(pairs, by)


# BERTScore --------------------------------------------------------------------------------------


BERTSCORE = ("bertscore_precision", "bertscore_recall", "bertscore_f1")


def _bertscore(pairs: DataFrame, factory: TokenEncoderFactory | None) -> dict[str, Column]:
    p, r = tx.score_tokens(F.col("prediction")), tx.score_tokens(F.col("reference"))
    return {"pair": best_match_scores(p, r, factory)}


def _bertscore_parts(pair: Column) -> dict[str, Column]:
    both = pair[0] + pair[1]
    f1 = F.when(both != 0, 2 * pair[0] * pair[1] / both).otherwise(0.0)
    return dict(zip(BERTSCORE, (pair[0], pair[1], f1), strict=True))


def bertscore_scores(
    pairs: DataFrame, key: str, factory: TokenEncoderFactory | None = None
) -> DataFrame:
    """Greedy token matching per key: precision, recall, F1. A map over the rows."""
    scored = pairs.select(key, _bertscore(pairs, factory)["pair"].alias("_s"))
    return scored.select(key, *[c.alias(k) for k, c in _bertscore_parts(F.col("_s")).items()])


def bertscore_metric(factory: TokenEncoderFactory | None = None) -> RowMetric:
    def mean(name: str):
        return lambda col: F.avg(_bertscore_parts(col("pair"))[name])

    return RowMetric(
        "bertscore", lambda pairs: _bertscore(pairs, factory), lambda: {k: mean(k) for k in BERTSCORE}
    )


def bertscore(
    pairs: DataFrame, key: str = "id", factory: TokenEncoderFactory | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    return bertscore_metric(factory)(pairs, by)


# Semantic similarity ----------------------------------------------------------------------------


def _similarity(
    embedder: em.EmbedderFactory | None, vectors: tuple[str, str] | None
) -> Column:
    if vectors:
        p, r = (F.col(c).cast("array<double>") for c in vectors)
    else:
        p, r = em.embed(F.col("prediction"), embedder), em.embed(F.col("reference"), embedder)
    return vx.soft_cosine(p, r)


def semantic_similarity_scores(
    pairs: DataFrame, key: str, embedder: em.EmbedderFactory | None = None,
    vectors: tuple[str, str] | None = None,
) -> DataFrame:
    """``p.r / (|p||r| + 1e-8)`` per key, over given vector columns or embedded texts."""
    return pairs.select(key, _similarity(embedder, vectors).alias("semantic_similarity"))


def similarity_metric(
    embedder: em.EmbedderFactory | None = None, vectors: tuple[str, str] | None = None
) -> RowMetric:
    name = "semantic_similarity"
    return RowMetric(
        name, lambda pairs: {name: _similarity(embedder, vectors)}, lambda: {name: _mean(name)}
    )


def semantic_similarity(
    pairs: DataFrame, key: str = "id", embedder: em.EmbedderFactory | None = None,
    vectors: tuple[str, str] | None = None, by: Sequence[str] = (),
) -> DataFrame:
    return similarity_metric(embedder, vectors)(pairs, by)


# Refusal ----------------------------------------------------------------------------------------


def is_refusal(prediction: Column) -> Column:
    return tx.strip(prediction) == F.lit(REFUSAL_MESSAGE.strip())


def refusal_metric() -> RowMetric:
    def rows(pairs: DataFrame) -> dict[str, Column]:
        known = "answerable" in pairs.columns
        answerable = F.coalesce("answerable", F.lit(True)) if known else F.lit(None).cast("boolean")
        return {
            "answerable": answerable,
            "refused": F.coalesce(is_refusal(F.col("prediction")), F.lit(False)),
        }

    def true(col) -> Column:
        return F.count_if(~col("answerable") & col("refused"))

    def false(col) -> Column:
        return F.count_if(col("answerable") & col("refused"))

    return RowMetric(
        "refusal",
        rows,
        lambda: {
            "refusal_precision": lambda col: true(col) / (true(col) + false(col) + F.lit(TINY)),
            "refusal_recall": lambda col: true(col) / (F.count_if(~col("answerable")) + F.lit(TINY)),
            "false_refusal_rate": lambda col: F.try_divide(false(col).cast("double"), F.count("*")),
        },
    )


def refusal(pairs: DataFrame, key: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall of refusing, and false refusals among **all** rows.

    Without an ``answerable`` column all values are zero. A null there counts as answerable.
    """
    return refusal_metric()(pairs, by)


# Registry and extension -------------------------------------------------------------------------

#: Made from the embedder and the token encoder of a run.
BUILTIN: dict[str, Callable[..., RowMetric]] = {
    "rouge": lambda embedder, encoder: rouge_metric(),
    "bertscore": lambda embedder, encoder: bertscore_metric(encoder),
    "semantic_similarity": lambda embedder, encoder: similarity_metric(embedder),
    "refusal": lambda embedder, encoder: refusal_metric(),
}


def from_row_scorer(
    name: str, scorer: Callable[[list[str], list[str]], Iterable[float]], sub_metric: str = "score"
) -> Metric:
    """A metric from a function that scores a batch of predictions against references."""

    @F.arrow_udf("double")
    def score(p: pa.Array, r: pa.Array) -> pa.Array:
        return pa.array(np.asarray(list(scorer(p.to_pylist(), r.to_pylist())), dtype=np.float64))

    return RowMetric(
        name,
        lambda pairs: {"score": score("prediction", "reference")},
        lambda: {sub_metric: _mean("score")},
    )


@dataclass(frozen=True)
class CorpusMetric:
    """A metric of a whole corpus that is no mean over rows.

    ``partial`` makes a state (bytes) of a batch of pairs, ``merge`` makes one of two, ``finish`` turns the
    last into values by sub-metric. Merging must not depend on the order. The state should not grow with
    the rows: tasks hold one per group, and merge theirs in a tree, so a group with any share of the rows
    reaches no task with more than the states of ``FAN_IN`` others. Groups without rows have no values; a
    corpus without rows has those of an empty batch.
    """

    name: str
    partial: Callable[[pa.RecordBatch], bytes]
    merge: Callable[[bytes, bytes], bytes]
    finish: Callable[[bytes], dict[str, float]]

    def __call__(self, pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        by = list(by)
        kinds = [f"`{c}` {pairs.schema[c].dataType.simpleString()}" for c in by]
        used = [c for c in ("prediction", "reference", "answerable") if c in pairs.columns]
        state = ", ".join([*kinds, "_part int, _state binary"])
        rows = pairs.select(*used, *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)])
        states = rows.mapInArrow(self._states(used, by), state)
        for level in range(MERGES, 0, -1):
            # a node of the tree sees FAN_IN states of a group, or one for each FAN_IN ** MERGES tasks
            part = F.pmod("_part", F.lit(FAN_IN**level))
            states = states.withColumn("_part", part).groupBy(*by, "_part").applyInArrow(self._merged(), state)
        if not by:
            empty = pa.RecordBatch.from_arrays([pa.array([], pa.string())] * len(used), names=used)
            none = pairs.sparkSession.createDataFrame([(0, bytearray(self.partial(empty)))], state)
            states = states.unionByName(none)
        schema = ", ".join([*kinds, "metric string, sub_metric string, value double"])
        out = states.groupBy(*by).applyInArrow(self._finished(by), schema)
        return out.withColumn("value", F.round("value", 6))

    def _states(self, used: list[str], by: list[str]):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
            from pyspark import TaskContext

            held: dict[tuple, bytes] = {}
            kinds = None

            def flush() -> pa.RecordBatch:
                columns = [pa.array([k[i] for k in held], kinds[i]) for i in range(len(by))]
                part = pa.array([TaskContext.get().partitionId()] * len(held), pa.int32())
                out = pa.RecordBatch.from_arrays(
                    [*columns, part, pa.array(list(held.values()), pa.binary())], names=[*by, "_part", "_state"]
                )
                held.clear()
                return out

            for b in batches:
                if not b.num_rows:
                    continue
                groups = [b.column(f"_by{i}") for i in range(len(by))]
                kinds = [g.type for g in groups]
                for key, rows in _groups_of(groups, b.num_rows):
                    found = self.partial(b.select(used).take(rows) if by else b.select(used))
                    held[key] = self.merge(held[key], found) if key in held else found
                if len(held) > HELD_GROUPS:
                    yield flush()
            if held:
                yield flush()

        return run

    def _merged(self):
        def run(table: pa.Table) -> pa.Table:
            state = reduce(self.merge, table.column("_state").to_pylist())
            one = table.slice(0, 1)
            return one.set_column(one.schema.get_field_index("_state"), "_state", pa.array([state], pa.binary()))

        return run

    def _finished(self, by: list[str]):
        def run(table: pa.Table) -> pa.Table:
            values = self.finish(reduce(self.merge, table.column("_state").to_pylist()))
            n = len(values)
            columns = {c: pa.array([table.column(c)[0].as_py()] * n, table.schema.field(c).type) for c in by}
            return pa.table(
                columns
                | {
                    "metric": pa.array([self.name] * n, pa.string()),
                    "sub_metric": pa.array(list(values), pa.string()),
                    "value": pa.array([float(v) for v in values.values()], pa.float64()),
                }
            )

        return run


FAN_IN = 64
MERGES = 2  # levels below the last
HELD_GROUPS = 10_000


def _groups_of(columns: list[pa.Array], rows: int) -> Iterable[tuple[tuple, pa.Array]]:
    """The groups of a batch and the numbers of their rows."""
    if not columns:
        return [((), None)]
    table = pa.table([*columns, pa.array(np.arange(rows))], names=[*map(str, range(len(columns))), "row"])
    found = table.group_by(list(map(str, range(len(columns))))).aggregate([("row", "list")])
    keys = zip(*(found.column(str(i)).to_pylist() for i in range(len(columns))), strict=True)
    return [(k, r.values) for k, r in zip(keys, found.column("row_list"), strict=True)]


def clipped_precision(max_n: int = 2) -> CorpusMetric:
    """Clipped n-gram precision over the corpus with a penalty for short predictions (BLEU, 2002).

    The state is the clipped matches and the n-grams predicted for each n, and the tokens of both sides.
    Tokens are runs of a-z and 0-9 in the lower-cased text; null is empty. The value is 0 where some n
    has no match.
    """
    word = re.compile("[a-z0-9]+")

    def partial(batch: pa.RecordBatch) -> bytes:
        out = np.zeros(2 * max_n + 2)
        for p, r in zip(*(batch.column(c).to_pylist() for c in ("prediction", "reference")), strict=True):
            p, r = (word.findall((t or "").lower()) for t in (p, r))
            out[-2:] += len(p), len(r)
            for n in range(1, max_n + 1):
                x, y = (Counter(zip(*[t[i:] for i in range(n)], strict=False)) for t in (p, r))
                out[n - 1] += (x & y).total()
                out[max_n + n - 1] += x.total()
        return out.tobytes()

    def merge(a: bytes, b: bytes) -> bytes:
        return (np.frombuffer(a) + np.frombuffer(b)).tobytes()

    def finish(state: bytes) -> dict[str, float]:
        x = np.frombuffer(state)
        match, total, (p, r) = x[:max_n], x[max_n:-2], x[-2:]
        penalty = 0.0 if not p else min(1.0, float(np.exp(1 - r / p)))
        share = np.divide(match, total, out=np.zeros(max_n), where=total > 0)
        value = penalty * float(np.exp(np.log(share).mean())) if (share > 0).all() else 0.0
        return {"score": value, "length_penalty": penalty} | {f"precision{n + 1}": v for n, v in enumerate(share)}

    return CorpusMetric("clipped_precision", partial, merge, finish)


def build(
    names: Sequence[str], embedder: em.EmbedderFactory | None = None,
    token_encoder: TokenEncoderFactory | None = None,
) -> list[Metric]:
    """Metrics by name; an unknown name raises."""
    odd = [n for n in names if n not in BUILTIN]
    if odd:
        raise ValueError(f"no metric {odd[0]!r}; there are {', '.join(sorted(BUILTIN))}")
    return [BUILTIN[n](embedder, token_encoder) for n in names]


def run_all(pairs: DataFrame, metrics: Sequence[Metric], by: Sequence[str] = ()) -> DataFrame:
    """Metrics over rows share one pass; any other has its own. With ``by``, each is given per group."""
    rows = [m for m in metrics if isinstance(m, RowMetric)]
    tables = [in_one_pass(pairs, rows, by)] if rows else []
    tables += [m(pairs, by) if by else m(pairs) for m in metrics if not isinstance(m, RowMetric)]
    if not tables:
        none = pairs.select(*by, F.lit("").alias("metric"), F.lit("").alias("sub_metric"), F.lit(0.0).alias("value"))
        return none.limit(0)
    return reduce(DataFrame.unionByName, tables)
