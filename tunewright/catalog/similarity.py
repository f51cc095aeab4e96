"""Vectors, near duplicates, diverse and quality samples, guardrail."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunewright.catalog import query
from tunewright.catalog.common import (
    CHAT_SQL,
    EMBEDDINGS_SQL,
    chat_pairs,
    cosine_sql,
    embed_sql,
    farthest_sql,
    greedy_sql,
    hash_sql,
    strip_sql,
    table,
    unit_sql,
)
from tunewright.functions import embed as em
from tunewright.functions import vectors as vx
from tunewright.operators import guard, near_dup, similarity_join
from tunewright.operators import sample as sm
from tunewright.operators.diversity import diverse_n
from tunewright.session import spread
from tunewright.specs import ANCHOR_PHRASES, REFUSAL_MESSAGE, GuardSpec, SampleSpec

DOCS_SQL = "docs AS (SELECT doc_id AS id, text FROM documents)"


@query(
    "embed_text",
    f"""WITH {DOCS_SQL}, {embed_sql("docs", "vec")}
SELECT id AS doc_id, unnest(v) AS x, unnest(range(64))::INT AS i FROM vec""",
)
def embed_text(spark, sf):
    d = spread(table(spark, sf, "documents")).select("doc_id", em.embed(F.col("text")).alias("v"))
    return d.select("doc_id", F.posexplode_outer("v").alias("i", "x"))


def letters():
    """A stand-in model: length, letters e, and a constant."""
    return lambda texts: [[len(t), t.count("e"), 1.0] for t in texts]


@query(
    "embed_custom",
    """SELECT doc_id, unnest([length(text), length(text) - length(replace(text, 'e', '')), 1])::DOUBLE AS x,
  unnest(range(3))::INT AS i FROM documents""",
)
def embed_custom(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", em.embed(F.col("text"), letters).alias("v"))
    return d.select("doc_id", F.posexplode_outer("v").alias("i", "x"))


@query(
    "normalize",
    f"""WITH {EMBEDDINGS_SQL}, {unit_sql("emb", "u")}
SELECT id AS vec_id, round(unnest(v), 6) AS x, unnest(range(64))::INT AS i FROM u""",
)
def normalize(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", vx.normalize(F.col("embedding")).alias("v"))
    return e.select("vec_id", F.posexplode_outer("v").alias("i", "x")).withColumn("x", F.round("x", 6))


@query(
    "similar_pairs",
    f"""WITH {EMBEDDINGS_SQL}, {unit_sql("emb", "u")}
SELECT a.id AS a_vec_id, b.id AS b_vec_id, round(round(list_inner_product(a.v, b.v), 9), 6) AS cosine
FROM u a JOIN u b ON a.h < b.h AND round(list_inner_product(a.v, b.v), 9) >= 0.3""",
)
def similar_pairs(spark, sf):
    e = table(spark, sf, "embeddings")
    out = similarity_join.similar_pairs(e, "vec_id", "embedding", 0.3)
    return out.withColumn("cosine", F.round("cosine", 6))


@query(
    "similar_pairs_cells",
    f"""WITH {EMBEDDINGS_SQL}, {unit_sql("emb", "u")}
SELECT a.id AS a_vec_id, b.id AS b_vec_id, round(round(list_inner_product(a.v, b.v), 9), 6) AS cosine
FROM u a JOIN u b ON a.h < b.h AND round(list_inner_product(a.v, b.v), 9) >= 0.3""",
)
def similar_pairs_cells(spark, sf):
    """Small blocks: several tasks, also such as have only one side."""
    e = table(spark, sf, "embeddings")
    out = similarity_join.similar_pairs(e, "vec_id", "embedding", 0.3, block=64)
    return out.withColumn("cosine", F.round("cosine", 6))


COPIES_SQL = f"""{DOCS_SQL}, {embed_sql("docs", "vec")}, {unit_sql("vec", "u")},
firsts AS MATERIALIZED (
  SELECT v, min(h) AS h, min_by(id, h) AS id FROM u WHERE list_inner_product(v, v) > 0 GROUP BY v)"""


@query(
    "similar_pairs_documents",
    f"""WITH {COPIES_SQL}
SELECT a.id AS a_doc_id, b.id AS b_doc_id, round(round(list_inner_product(a.v, b.v), 9), 6) AS cosine
FROM firsts a JOIN firsts b ON a.h < b.h AND round(list_inner_product(a.v, b.v), 9) >= 0.95""",
)
def similar_pairs_documents(spark, sf):
    """Vectors with copies, in cells of small blocks."""
    d = spread(table(spark, sf, "documents")).select("doc_id", em.embed(F.col("text")).alias("v"))
    out = similarity_join.similar_pairs(d, "doc_id", "v", 0.95, block=128)
    return out.withColumn("cosine", F.round("cosine", 6))


@query(
    "similar_pairs_tree",
    f"""WITH {COPIES_SQL}
SELECT a.id AS a_doc_id, b.id AS b_doc_id, round(round(list_inner_product(a.v, b.v), 9), 6) AS cosine
FROM firsts a JOIN firsts b ON a.h < b.h AND round(list_inner_product(a.v, b.v), 9) >= 0.9""",
)
def similar_pairs_tree(spark, sf):
    """Few cells on the first level and small blocks: large cells get pivots of their own."""
    d = spread(table(spark, sf, "documents")).select("doc_id", em.embed(F.col("text")).alias("v"))
    out = similarity_join.similar_pairs(d, "doc_id", "v", 0.9, block=64, root_cells=16)
    return out.withColumn("cosine", F.round("cosine", 6))


@query(
    "vector_copies",
    f"""WITH {COPIES_SQL}
SELECT f.id AS a_doc_id, u.id AS b_doc_id FROM firsts f JOIN u ON u.v = f.v AND u.h <> f.h""",
)
def vector_copies(spark, sf):
    d = spread(table(spark, sf, "documents")).select("doc_id", em.embed(F.col("text")).alias("v"))
    return similarity_join.vector_copies(d, "doc_id", "v")


@query(
    "near_duplicates",
    f"""WITH RECURSIVE {EMBEDDINGS_SQL}, {unit_sql("emb", "u")}, {greedy_sql("u", 0.3, "kept")}
SELECT id AS vec_id FROM kept""",
)
def near_duplicates(spark, sf):
    e = table(spark, sf, "embeddings")
    return near_dup.near_dup(e, "vec_id", "embedding", 0.3).select("vec_id")


@query(
    "near_duplicates_rounds",
    f"""WITH RECURSIVE {EMBEDDINGS_SQL}, {unit_sql("emb", "u")}, {greedy_sql("u", 0.35, "kept")}
SELECT id AS vec_id FROM kept""",
)
def near_duplicates_rounds(spark, sf):
    """Short prefixes and small blocks, so the pair join and the rounds do the work."""
    e = table(spark, sf, "embeddings")
    out = near_dup.near_dup(e, "vec_id", "embedding", 0.35, first=32, block=128, linear=0)
    return out.select("vec_id")


@query(
    "near_duplicate_documents",
    f"""WITH RECURSIVE {DOCS_SQL}, {embed_sql("docs", "vec")}, {unit_sql("vec", "u")},
{greedy_sql("u", 0.95, "kept")} SELECT id AS doc_id FROM kept""",
)
def near_duplicate_documents(spark, sf):
    d = spread(table(spark, sf, "documents")).select("doc_id", em.embed(F.col("text")).alias("v"))
    return near_dup.near_dup(d, "doc_id", "v", 0.95).select("doc_id")


@query(
    "sample_diverse",
    f"""WITH RECURSIVE {EMBEDDINGS_SQL}, {unit_sql("emb", "u")}, {farthest_sql("u", 25, "far")}
SELECT id AS vec_id, pick FROM far""",
)
def sample_diverse(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return diverse_n(e, 25, "vec_id", "embedding", pick_column="pick").select("vec_id", "pick")


QUALITY_SQL = f"""docs AS (
  SELECT doc_id AS id, lang || ' ' || text AS text FROM documents
  WHERE length(lang || ' ' || text) BETWEEN 20 AND 4000),
{embed_sql("docs", "vec")}, {unit_sql("vec", "u")}, {greedy_sql("u", 0.9, "kept")},
{farthest_sql("kept", 30, "far")}"""


@query("sample_quality", f"WITH RECURSIVE {QUALITY_SQL} SELECT id AS doc_id FROM far")
def sample_quality(spark, sf):
    d = spread(table(spark, sf, "documents").select("doc_id", "lang", "text"))
    spec = SampleSpec(
        n=30, strategy="quality", text_columns=("lang", "text"), dedup_threshold=0.9
    )
    return sm.downsample(d, spec, "doc_id").select("doc_id")


# Guardrail --------------------------------------------------------------------------------------

ANCHOR_TABLE_SQL = f"""WITH {CHAT_SQL},
q AS (SELECT id, instruction AS text FROM chat), {embed_sql("q", "qv")},
b AS (SELECT item_id AS id, text FROM benchmark), {embed_sql("b", "bv")}
SELECT qv.id, round(max({cosine_sql("qv.v", "bv.v")}), 6) AS max_cosine FROM qv, bv GROUP BY qv.id"""


def _scope(spark, sf, limit, block=4096):
    q = chat_pairs(spark, sf).select("id", em.embed(F.col("instruction")).alias("v"))
    b = table(spark, sf, "benchmark").select(em.embed(F.col("text")).alias("v"))
    out = guard.scope_scores(q, "id", "v", b, "v", limit, block)
    return out.withColumn("max_cosine", F.round("max_cosine", 6))


@query("anchor_scope", ANCHOR_TABLE_SQL)
def anchor_scope(spark, sf):
    return _scope(spark, sf, guard.ANCHOR_ROWS)


@query("anchor_scope_blocks", ANCHOR_TABLE_SQL)
def anchor_scope_blocks(spark, sf):
    """The path for anchor tables beyond the limit, in several blocks."""
    return _scope(spark, sf, 8, 16)


SPEC = GuardSpec(confidence_threshold=0.35, scope_threshold=0.1)

_PHRASES = ", ".join(f"({i}, '{p}')" for i, p in enumerate(ANCHOR_PHRASES))
VERDICT_SQL = f"""{CHAT_SQL},
p AS (SELECT * FROM (VALUES {_PHRASES}) t(id, text)), {embed_sql("p", "pv")},
q AS (SELECT id, instruction AS text FROM chat), {embed_sql("q", "qv")},
a AS (SELECT id, output AS text FROM chat), {embed_sql("a", "av")},
scope AS (SELECT qv.id, max({cosine_sql("qv.v", "pv.v")}) AS scope_score FROM qv, pv GROUP BY 1),
scores AS (
  SELECT qv.id, scope_score, {cosine_sql("qv.v", "av.v")} AS confidence_score
  FROM qv JOIN av ON av.id = qv.id JOIN scope ON scope.id = qv.id),
verdict AS (
  SELECT *, CASE WHEN scope_score < 0.1 THEN 'out_of_scope'
            WHEN confidence_score < 0.35 THEN 'low_confidence' END AS reason FROM scores)"""


def _checked(spark, sf):
    pairs = chat_pairs(spark, sf).select(
        "id",
        "output",
        em.embed(F.col("instruction")).alias("qv"),
        em.embed(F.col("output")).alias("av"),
    )
    return guard.check(pairs, "qv", "av", em.embed_phrases(spark, SPEC.anchors), SPEC)


@query(
    "guard_check",
    f"""WITH {VERDICT_SQL}
SELECT v.id, round(scope_score, 6) AS scope_score, round(confidence_score, 6) AS confidence_score,
       reason, reason IS NOT NULL AS should_refuse,
       CASE WHEN reason IS NULL THEN output ELSE '{REFUSAL_MESSAGE.replace("'", "''")}' END AS answer
FROM verdict v JOIN chat ON chat.id = v.id""",
)
def guard_check(spark, sf):
    out = guard.apply(_checked(spark, sf), "output")
    return out.select(
        "id",
        F.round("scope_score", 6).alias("scope_score"),
        F.round("confidence_score", 6).alias("confidence_score"),
        "reason",
        "should_refuse",
        "answer",
    )


@query(
    "guard_reasons",
    f"""WITH {VERDICT_SQL}
SELECT coalesce(reason, 'none') AS reason, count(*) AS n, round(avg(scope_score), 6) AS avg_scope,
       round(avg(confidence_score), 6) AS avg_confidence FROM verdict GROUP BY 1""",
)
def guard_reasons(spark, sf):
    out = guard.reasons(_checked(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("avg_scope", "avg_confidence")})


def echo_words():
    """A stand-in model: the prompt, then its words in reverse case."""
    return lambda prompts, limit: [p + "\nAnswer: " + p.lower() + " " for p in prompts]


@query(
    "guard_predict",
    f"""WITH {CHAT_SQL},
p AS (SELECT * FROM (VALUES {_PHRASES}) t(id, text)), {embed_sql("p", "pv")},
q AS (SELECT id, instruction AS text FROM chat), {embed_sql("q", "qv")},
a AS (SELECT id, {strip_sql("chr(10) || 'Answer: ' || lower(instruction) || ' '")} AS text
      FROM chat),
{embed_sql("a", "av")},
s AS (SELECT qv.id, max({cosine_sql("qv.v", "pv.v")}) AS scope_score FROM qv, pv GROUP BY 1),
c AS (
  SELECT s.id, scope_score, a.text,
         CASE WHEN scope_score >= 0.1 THEN {cosine_sql("qv.v", "av.v")} END AS confidence_score
  FROM s JOIN qv ON qv.id = s.id JOIN av ON av.id = s.id JOIN a ON a.id = s.id)
SELECT id, CASE WHEN scope_score < 0.1 THEN 'out_of_scope'
                WHEN confidence_score < 0.35 THEN 'low_confidence' END AS reason,
       round(confidence_score, 6) AS confidence_score,
       CASE WHEN scope_score < 0.1 OR confidence_score < 0.35
            THEN '{REFUSAL_MESSAGE.replace("'", "''")}' ELSE text END AS answer FROM c""",
)
def guard_predict(spark, sf):
    pairs = chat_pairs(spark, sf).select("id", "instruction")
    out = guard.predict_guarded(pairs, "instruction", echo_words, SPEC)
    return out.select(
        "id", "reason", F.round("confidence_score", 6).alias("confidence_score"), "answer"
    )
