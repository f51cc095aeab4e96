"""Shared inputs of the queries, on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.functions import stem
from tunewright.functions.text import WHITESPACE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows. Joined on (conversation, turn), so one
    long conversation spreads over all tasks."""
    c = table(spark, sf_dir, "conversations")
    user = c.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("instruction"))
    answer = c.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    return user.join(answer, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        "instruction",
        F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("input"),
        "output",
        "turn",
    )


CHAT_SQL = """chat AS (
  SELECT u.conv_id || '-' || u.turn AS id, u.text AS instruction, 'turn ' || u.turn AS input,
         a.text AS output, u.turn AS turn
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; most have none."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


LABELLED_SQL = """labelled AS (
  SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

LEFT_PAD, RIGHT_PAD = "  \t", " \n　"


def padded(c) -> F.Column:
    return F.concat(F.lit(LEFT_PAD), c, F.lit(RIGHT_PAD))


def padded_sql(c: str) -> str:
    return f"'{LEFT_PAD}' || {c} || '{RIGHT_PAD}'"


def strip_sql(c: str) -> str:
    return f"trim({c}, '{WHITESPACE}')"


def hash_sql(key: str, seed: int = 42) -> str:
    return f"md5('{seed}|' || CAST({key} AS VARCHAR))"


def embed_sql(src: str, out: str) -> str:
    """CTEs that embed ``src(id, text)`` into ``out(id, v)`` like the built-in embedder."""
    return f"""{out}_t AS MATERIALIZED (
  SELECT id, md5(t) AS h FROM (
    SELECT id, unnest(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+')) AS t
    FROM {src}) WHERE t <> ''),
{out}_b AS MATERIALIZED (
  SELECT id, CAST('0x' || substr(h, 1, 4) AS INT) % 64 AS b,
         sum(CASE WHEN substr(h, 5, 1) < '8' THEN 1.0 ELSE -1.0 END) AS w
  FROM {out}_t GROUP BY 1, 2),
{out} AS MATERIALIZED (
  SELECT s.id, list(CAST(coalesce(b.w, 0) AS DOUBLE) ORDER BY r.b) AS v
  FROM {src} s CROSS JOIN (SELECT unnest(range(64)) AS b) r
  LEFT JOIN {out}_b b ON b.id = s.id AND b.b = r.b GROUP BY s.id)"""


def unit_sql(src: str, out: str, seed: int = 42) -> str:
    """CTE with order hash and unit vector of ``src(id, v)``."""
    return f"""{out} AS MATERIALIZED (
  SELECT id, {hash_sql("id", seed)} AS h,
         list_transform(v, lambda x: x / CASE WHEN list_inner_product(v, v) = 0 THEN 1
                                         ELSE sqrt(list_inner_product(v, v)) END) AS v
  FROM {src})"""


def cosine_sql(a: str, b: str) -> str:
    return (
        f"CASE WHEN list_inner_product({a}, {a}) = 0 OR list_inner_product({b}, {b}) = 0 THEN 0.0 "
        f"ELSE list_inner_product({a}, {b}) / "
        f"(sqrt(list_inner_product({a}, {a})) * sqrt(list_inner_product({b}, {b}))) END"
    )


EMBEDDINGS_SQL = (
    "emb AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v "
    "FROM embeddings)"
)


def greedy_sql(src: str, threshold: float, out: str) -> str:
    """CTEs for the sequential near-duplicate rule on ``src(id, h, v)``: one row per step."""
    return f"""{out}_r AS MATERIALIZED (SELECT id, h, v, row_number() OVER (ORDER BY h) AS i FROM {src}),
{out}_a AS MATERIALIZED (
  SELECT y.i, coalesce(list(x.i) FILTER (WHERE x.i IS NOT NULL), []) AS near
  FROM {out}_r y LEFT JOIN {out}_r x
    ON x.i < y.i AND round(list_inner_product(x.v, y.v), 9) >= {threshold} GROUP BY y.i),
{out}_s AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS kept
  UNION ALL
  SELECT a.i, CASE WHEN list_has_any(s.kept, a.near) THEN s.kept ELSE list_append(s.kept, a.i) END
  FROM {out}_s s JOIN {out}_a a ON a.i = s.i + 1),
{out} AS MATERIALIZED (
  SELECT r.id, r.h, r.v FROM {out}_r r
  WHERE r.i IN (SELECT unnest(kept) FROM (SELECT kept FROM {out}_s ORDER BY i DESC LIMIT 1)))"""


def farthest_sql(src: str, n: int, out: str) -> str:
    """CTEs for exact farthest-point picks on ``src(id, h, v)``."""
    return f"""{out}_s AS (
  SELECT 0 AS step, id, h, v,
         CASE WHEN h = (SELECT min(h) FROM {src}) THEN 9.0
              ELSE round(list_inner_product(v, (SELECT arg_min(v, h) FROM {src})), 9) END AS m,
         h = (SELECT min(h) FROM {src}) AS picked
  FROM {src}
  UNION ALL
  SELECT s.step + 1, s.id, s.h, s.v,
         CASE WHEN s.h = p.h THEN 9.0
              ELSE greatest(s.m, round(list_inner_product(s.v, p.v), 9)) END,
         s.h = p.h
  FROM {out}_s s, (SELECT h, v FROM {out}_s ORDER BY m, h LIMIT 1) p
  WHERE s.step < {n} - 1),
{out} AS (SELECT id, step AS pick FROM {out}_s WHERE picked)"""


# Suffix stripping in SQL ------------------------------------------------------------------------


def _shape_sql(e: str) -> str:
    """c(onsonant) or v(owel) for each character; a y after a consonant is a vowel."""
    out = f"translate({e}, 'aeioubcdfghjklmnpqrstvwxz0123456789', 'vvvvv{'c' * 30}')"
    out = f"regexp_replace({out}, '^y', 'c')"
    for _ in range(4):  # as many as letters y stand in a row
        out = f"replace(replace({out}, 'cy', 'cv'), 'vy', 'vc')"
    return out


def _measure_sql(shape: str) -> str:
    return f"((len({shape}) - len(replace({shape}, 'vc', ''))) // 2)"


def _cvc_sql(w: str, shape: str) -> str:
    return (
        f"((ends_with({shape}, 'cvc') AND right({w}, 1) NOT IN ('w', 'x', 'y')) "
        f"OR (len({w}) = 2 AND {shape} = 'vc'))"
    )


def _suffix_sql(suffixes: list[tuple[str, str, str]], name: str, src: str, ok: str) -> str:
    """CTEs for a step that takes the first suffix that fits: (suffix, replacement, tested part)."""

    def case(value) -> str:
        return " ".join(f"WHEN ends_with(w, '{s}') THEN {value(s, n, t)}" for s, n, t in suffixes)

    return f"""{name}_c AS (
  SELECT token, w, CASE {case(lambda s, n, t: f"left(w, -{len(s)})")} END AS base,
    CASE {case(lambda s, n, t: f"'{n}'")} END AS new, CASE {case(lambda s, n, t: f"'{s}'")} END AS suffix,
    CASE {case(lambda s, n, t: t)} END AS tested FROM {src}),
{name}_s AS (SELECT *, {_shape_sql("tested")} AS shape FROM {name}_c),
{name} AS MATERIALIZED (
  SELECT token, CASE WHEN base IS NOT NULL AND {ok} THEN base || new ELSE w END AS w FROM {name}_s)"""


def stem_sql(src: str, out: str) -> str:
    """CTEs that stem the distinct tokens ``src(token)`` into ``out(token, stem)``."""
    m = _measure_sql
    fixed = " ".join(f"WHEN token = '{a}' THEN '{b}'" for a, b in stem.IRREGULAR.items())
    derived = [(s, n, "left(w, -3)" if s == "logi" else f"left(w, -{len(s)})") for s, n in stem.STEP2]
    plain = lambda pairs: [(s, n, f"left(w, -{len(s)})") for s, n in pairs]
    return f"""{out}_a AS MATERIALIZED (
  SELECT token, CASE
    WHEN ends_with(token, 'ies') AND len(token) = 4 THEN left(token, -1)
    WHEN ends_with(token, 'sses') OR ends_with(token, 'ies') THEN left(token, -2)
    WHEN ends_with(token, 'ss') THEN token WHEN ends_with(token, 's') THEN left(token, -1)
    ELSE token END AS w FROM {src}),
{out}_b1 AS (
  SELECT *, CASE WHEN ends_with(w, 'ed') THEN left(w, -2) WHEN ends_with(w, 'ing') THEN left(w, -3)
            END AS base FROM {out}_a),
{out}_b2 AS (
  SELECT *, {_shape_sql("base")} AS shape, {_shape_sql("left(w, -3)")} AS eed FROM {out}_b1),
{out}_b AS MATERIALIZED (
  SELECT token, CASE
    WHEN ends_with(w, 'ied') THEN CASE WHEN len(w) = 4 THEN left(w, -1) ELSE left(w, -2) END
    WHEN ends_with(w, 'eed') THEN CASE WHEN {m("eed")} > 0 THEN left(w, -1) ELSE w END
    WHEN base IS NULL OR NOT contains(shape, 'v') THEN w
    WHEN right(base, 2) IN ('at', 'bl', 'iz') THEN base || 'e'
    WHEN len(base) >= 2 AND right(base, 1) = left(right(base, 2), 1) AND ends_with(shape, 'c')
      THEN CASE WHEN right(base, 1) IN ('l', 's', 'z') THEN base ELSE left(base, -1) END
    WHEN {m("shape")} = 1 AND {_cvc_sql("base", "shape")} THEN base || 'e' ELSE base END AS w
  FROM {out}_b2),
{out}_c AS MATERIALIZED (
  SELECT token, CASE WHEN ends_with(w, 'y') AND len(w) > 2
      AND ends_with({_shape_sql("left(w, -1)")}, 'c') THEN left(w, -1) || 'i' ELSE w END AS w
  FROM {out}_b),
{out}_d AS MATERIALIZED (
  SELECT token, CASE WHEN ends_with(w, 'alli') AND {m(_shape_sql("left(w, -4)"))} > 0
                THEN left(w, -2) ELSE w END AS w FROM {out}_c),
{_suffix_sql(derived, f"{out}_e", f"{out}_d", f"{m('shape')} > 0")},
{_suffix_sql(plain(stem.STEP3), f"{out}_f", f"{out}_e", f"{m('shape')} > 0")},
{_suffix_sql(plain([(s, "") for s in stem.STEP4]), f"{out}_g", f"{out}_f",
             f"{m('shape')} > 1 AND (suffix <> 'ion' OR right(base, 1) IN ('s', 't'))")},
{out}_h1 AS (SELECT *, left(w, -1) AS base, {_shape_sql("left(w, -1)")} AS shape FROM {out}_g),
{out}_h AS MATERIALIZED (
  SELECT token, CASE WHEN ends_with(w, 'e') AND ({m("shape")} > 1
      OR ({m("shape")} = 1 AND NOT {_cvc_sql("base", "shape")})) THEN base ELSE w END AS w
  FROM {out}_h1),
{out} AS MATERIALIZED (
  SELECT token, CASE WHEN len(token) <= 3 THEN token {fixed}
    WHEN ends_with(w, 'll') AND {m(_shape_sql("left(w, -1)"))} > 1 THEN left(w, -1) ELSE w END AS stem
  FROM {out}_h)"""
