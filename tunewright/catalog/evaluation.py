"""Inference, pairing and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunewright.catalog import query
from tunewright.catalog.common import (
    CHAT_SQL,
    EMBEDDINGS_SQL,
    LABELLED_SQL,
    chat_pairs,
    embed_sql,
    labelled,
    padded,
    stem_sql,
    strip_sql,
    table,
)
from tunewright.catalog.corpus import INPUT_SQL
from tunewright.functions import text as tx
from tunewright.operators import evaluate as ev
from tunewright.operators import infer, metrics, report
from tunewright.operators import prompt as pr
from tunewright.session import scratch_path, spread
from tunewright.sources import sinks, tables
from tunewright.specs import INPUT_TEMPLATE, REFUSAL_MESSAGE, EvalSpec

MESSAGE_SQL = REFUSAL_MESSAGE.replace("'", "''")


def echo():
    return lambda prompts, limit: [p + " Generated answer.\n" for p in prompts]


def _pairs(spark, sf):
    return spread(chat_pairs(spark, sf)).select(
        "id", F.col("instruction").alias("prediction"), F.col("output").alias("reference"), "turn"
    )


PAIRS_SQL = f"""{CHAT_SQL},
pairs AS (SELECT id, instruction AS prediction, output AS reference, turn FROM chat)"""


# Prompts and predictions ------------------------------------------------------------------------


@query(
    "evaluation_prompts",
    f"WITH {CHAT_SQL} SELECT id, 'Be brief.' || '\n\n' || {INPUT_SQL} AS prompt FROM chat",
)
def evaluation_prompts(spark, sf):
    spec = EvalSpec(input_template=INPUT_TEMPLATE, system_prompt=" Be brief. ")
    return ev.build_prompts(chat_pairs(spark, sf), spec).select("id", "prompt")


@query(
    "strip_prompt",
    f"""WITH {CHAT_SQL}
SELECT id, {strip_sql("CASE WHEN turn > 0 THEN output ELSE chr(10) || output || ' ' END")} AS answer
FROM chat""",
)
def strip_prompt(spark, sf):
    """First turns echo their prompt, later ones do not."""
    c = chat_pairs(spark, sf)
    raw = F.when(F.col("turn") > 0, F.col("output")).otherwise(
        F.concat(F.col("instruction"), F.lit("\n"), F.col("output"), F.lit(" "))
    )
    return c.select("id", pr.strip_prompt(raw, F.col("instruction")).alias("answer"))


ASK_SQL = f"""WITH {LABELLED_SQL},
asked AS (
  SELECT doc_id, CASE WHEN quality = 0 THEN '  ' WHEN toxic = 1 THEN NULL ELSE text END AS question,
         CASE WHEN quality IS NULL THEN NULL WHEN lang = 'en' THEN '' ELSE source END AS context
  FROM labelled)
SELECT doc_id,
  CASE WHEN question IS NULL OR trim(question) = '' THEN NULL
       WHEN coalesce(context, '') <> '' THEN 'Context: ' || context || '\n\nQuestion: ' || question
       ELSE question END AS prompt,
  CASE WHEN question IS NULL OR trim(question) = ''
       THEN 'Missing or empty ''question'' field' END AS error
FROM asked"""


@query("ask_prompts", ASK_SQL)
def ask_prompts(spark, sf):
    d = labelled(spark, sf)
    asked = d.select(
        "doc_id",
        F.when(F.col("quality") == 0, "  ").when(F.col("toxic") == 1, None)
        .otherwise(F.col("text")).alias("question"),
        F.when(F.col("quality").isNull(), None).when(F.col("lang") == "en", "")
        .otherwise(F.col("source")).alias("context"),
    )
    return infer.ask(asked).select("doc_id", "prompt", "error")


@query(
    "predict",
    f"WITH {CHAT_SQL} SELECT id, instruction || ' Generated answer.\n' AS raw_output FROM chat",
)
def predict(spark, sf):
    out = infer.predict(chat_pairs(spark, sf).select("id", "instruction"), "instruction", echo)
    return out.select("id", "raw_output")


@query(
    "qualitative",
    "SELECT text AS input, 'Generated answer.' AS output FROM conversations WHERE role = 'user'",
)
def qualitative(spark, sf):
    prompts = table(spark, sf, "conversations").filter("role = 'user'")
    return infer.qualitative(prompts.select(F.col("text").alias("prompt")), echo)


@query(
    "preview",
    """SELECT conv_id, turn,
  CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS input,
  CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS output
FROM conversations ORDER BY conv_id, turn LIMIT 5""",
)
def preview(spark, sf):
    c = table(spark, sf, "conversations")
    q = c.select("conv_id", "turn", F.col("text").alias("input"), F.col("text").alias("output"))
    return report.preview(q, ["conv_id", "turn"])


@query("pair", f"WITH {PAIRS_SQL} SELECT id, prediction, reference FROM pairs")
def pair(spark, sf):
    p = _pairs(spark, sf)
    return ev.pair(p.select("id", "prediction"), p.select("id", "reference"), "id")


# ROUGE ------------------------------------------------------------------------------------------


def stems_of_sql(src: str) -> str:
    """CTEs ``toks(id, side, w, i)`` with stems: side p or r, word, place."""
    words = lambda c, side: (
        f"SELECT id, '{side}' AS side, unnest(w) AS token, unnest(range(len(w))) AS i FROM ("
        f"SELECT id, list_filter(regexp_split_to_array(lower(coalesce({c}, '')), '[^a-z0-9]+'), "
        f"lambda x: x <> '') AS w FROM {src})"
    )
    return f"""raw_toks AS MATERIALIZED ({words("prediction", "p")} UNION ALL {words("reference", "r")}),
vocabulary AS (SELECT DISTINCT token FROM raw_toks), {stem_sql("vocabulary", "stems")},
toks AS MATERIALIZED (SELECT id, side, stem AS w, i FROM raw_toks JOIN stems USING (token))"""


def stemmed_rouge_sql(src: str, n: int) -> str:
    """CTE ``s{n}(id, f)``: ROUGE-n F1 over ``toks``."""
    runs = " || ' ' || ".join(f"lead(w, {k}) OVER o" if k else "w" for k in range(n))
    return f"""sg{n} AS MATERIALIZED (
  SELECT id, side, g, count(*) AS n FROM (
    SELECT id, side, {runs} AS g FROM toks WINDOW o AS (PARTITION BY id, side ORDER BY i))
  WHERE g IS NOT NULL GROUP BY 1, 2, 3),
s{n} AS (
  SELECT x.id, coalesce(2.0 * o / (SELECT sum(n) FROM sg{n} WHERE sg{n}.id = x.id), 0.0)::DOUBLE AS f
  FROM {src} x LEFT JOIN (
    SELECT p.id, sum(least(p.n, r.n)) AS o FROM sg{n} p JOIN sg{n} r
    ON r.id = p.id AND r.g = p.g AND p.side = 'p' AND r.side = 'r' GROUP BY 1) y ON y.id = x.id)"""


def grams_sql(src: str, column: str, n: int, out: str) -> str:
    """CTE ``out(id, g, n)``: n-gram counts per id."""
    runs = " || ' ' || ".join(f"lead(w, {k}) OVER o" if k else "w" for k in range(n))
    return f"""{out} AS (
  SELECT id, g, count(*) AS n FROM (
    SELECT id, {runs} AS g FROM (
      SELECT id, unnest(w) AS w, unnest(range(len(w))) AS i FROM (
        SELECT id, list_filter(regexp_split_to_array(lower({column}), '[^a-z0-9]+'),
                               lambda x: x <> '') AS w FROM {src}))
    WINDOW o AS (PARTITION BY id ORDER BY i)) WHERE g IS NOT NULL
  GROUP BY 1, 2)"""


def rouge_sql(n: int) -> str:
    return f"""{grams_sql("pairs", "prediction", n, f"p{n}")},
{grams_sql("pairs", "reference", n, f"r{n}")},
o{n} AS (SELECT p.id, sum(least(p.n, r.n)) AS o FROM p{n} p JOIN r{n} r
         ON r.id = p.id AND r.g = p.g GROUP BY 1),
f{n} AS (
  SELECT pairs.id, turn, coalesce(2.0 * o / (pn + rn), 0.0)::DOUBLE AS f FROM pairs
  LEFT JOIN o{n} ON o{n}.id = pairs.id
  LEFT JOIN (SELECT id, sum(n) AS pn FROM p{n} GROUP BY 1) a ON a.id = pairs.id
  LEFT JOIN (SELECT id, sum(n) AS rn FROM r{n} GROUP BY 1) b ON b.id = pairs.id)"""


@query(
    "rouge_scores",
    f"""WITH {PAIRS_SQL}, {rouge_sql(1)}, {rouge_sql(2)}
SELECT f1.id, round(f1.f, 6) AS rouge1, round(f2.f, 6) AS rouge2
FROM f1 JOIN f2 ON f2.id = f1.id""",
)
def rouge_scores(spark, sf):
    s = metrics.rouge_scores(_pairs(spark, sf), "id", stem=False)
    return s.select("id", F.round("rouge1", 6).alias("rouge1"), F.round("rouge2", 6).alias("rouge2"))


@query("rouge1_by_turn", f"WITH {PAIRS_SQL}, {rouge_sql(1)} SELECT turn, round(avg(f), 6) AS rouge1 FROM f1 GROUP BY 1")
def rouge1_by_turn(spark, sf):
    p = _pairs(spark, sf)
    s = metrics.rouge_n_scores(p, "id", 1, stem=False).join(p.select("id", "turn"), "id")
    return s.groupBy("turn").agg(F.round(F.avg("rouge1"), 6).alias("rouge1"))


@query(
    "rouge_documents",
    f"""WITH pairs AS (
  SELECT d.doc_id AS id, d.text AS prediction, b.text AS reference, 0 AS turn
  FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark)),
{rouge_sql(1)}, {rouge_sql(2)}
SELECT f1.id, round(f1.f, 6) AS rouge1, round(f2.f, 6) AS rouge2
FROM f1 JOIN f2 ON f2.id = f1.id""",
)
def rouge_documents(spark, sf):
    """Every document against a benchmark item."""
    b = table(spark, sf, "benchmark")
    d = spread(table(spark, sf, "documents")).withColumn("item_id", F.col("doc_id") % b.count())
    pairs = d.join(b.withColumnRenamed("text", "reference"), "item_id").select(
        F.col("doc_id").alias("id"), F.col("text").alias("prediction"), "reference"
    )
    s = metrics.rouge_scores(pairs, "id", stem=False)
    return s.select("id", F.round("rouge1", 6).alias("rouge1"), F.round("rouge2", 6).alias("rouge2"))


LCS_SQL = """lists AS MATERIALIZED (
  SELECT pairs.id, coalesce(list(w ORDER BY i) FILTER (side = 'p'), []) AS p,
         coalesce(list(w ORDER BY i) FILTER (side = 'r'), []) AS r
  FROM pairs LEFT JOIN toks ON toks.id = pairs.id GROUP BY 1),
lcs AS (
  SELECT id, 0 AS i, list_transform(p, lambda x: 0) AS line FROM lists
  UNION ALL
  SELECT id, i + 1, list_transform(range(1, len(c) + 1), lambda j: list_max(c[1:j])) FROM (
    SELECT l.id, l.i, list_transform(range(1, len(t.p) + 1), lambda j: CASE
      WHEN t.p[j] = t.r[l.i + 1] THEN CASE WHEN j > 1 THEN l.line[j - 1] ELSE 0 END + 1
      ELSE l.line[j] END) AS c
    FROM lcs l JOIN lists t ON t.id = l.id WHERE l.i < len(t.r))),
sl AS (
  SELECT lists.id, CASE WHEN len(p) = 0 OR len(r) = 0 THEN 0.0
    ELSE 2.0 * list_max(line) / (len(p) + len(r)) END AS f
  FROM lists JOIN lcs ON lcs.id = lists.id AND lcs.i = len(r))"""


@query(
    "rouge",
    f"""WITH RECURSIVE {PAIRS_SQL}, {stems_of_sql("pairs")}, {stemmed_rouge_sql("pairs", 1)},
{stemmed_rouge_sql("pairs", 2)}, {LCS_SQL}
SELECT 'rouge' AS metric, 'rouge1' AS sub_metric, round(avg(f), 6) AS value FROM s1
UNION ALL SELECT 'rouge', 'rouge2', round(avg(f), 6) FROM s2
UNION ALL SELECT 'rouge', 'rougeL', round(avg(f), 6) FROM sl""",
)
def rouge(spark, sf):
    """With stems, as users get it."""
    return metrics.rouge(_pairs(spark, sf), "id")


@query(
    "rouge_l_scores",
    f"""WITH RECURSIVE {PAIRS_SQL},
toks AS MATERIALIZED (
  SELECT id, list_filter(regexp_split_to_array(lower(prediction), '[^a-z0-9]+'),
                         lambda x: x <> '') AS p,
         list_filter(regexp_split_to_array(lower(reference), '[^a-z0-9]+'),
                     lambda x: x <> '') AS r FROM pairs),
lcs AS (
  SELECT id, 0 AS i, list_transform(p, lambda x: 0) AS line FROM toks
  UNION ALL
  SELECT id, i + 1, list_transform(range(1, len(c) + 1), lambda j: list_max(c[1:j])) FROM (
    SELECT l.id, l.i, list_transform(range(1, len(t.p) + 1), lambda j: CASE
      WHEN t.p[j] = t.r[l.i + 1] THEN CASE WHEN j > 1 THEN l.line[j - 1] ELSE 0 END + 1
      ELSE l.line[j] END) AS c
    FROM lcs l JOIN toks t ON t.id = l.id WHERE l.i < len(t.r)))
SELECT toks.id, round(CASE WHEN len(p) = 0 OR len(r) = 0 THEN 0.0
  ELSE 2.0 * list_max(line) / (len(p) + len(r)) END, 6) AS "rougeL"
FROM toks JOIN lcs ON lcs.id = toks.id AND lcs.i = len(r)""",
)
def rouge_l_scores(spark, sf):
    s = metrics.rouge_l_scores(_pairs(spark, sf), "id", stem=False)
    return s.withColumn("rougeL", F.round("rougeL", 6))


# BERTScore --------------------------------------------------------------------------------------

TOKEN_VECTOR_SQL = (
    "list_transform(range(1, 33), lambda i: instr('0123456789abcdef', substr(md5(g), i, 1)) - 8.5)"
)
BERTSCORE_SQL = f"""{PAIRS_SQL},
{grams_sql("pairs", "prediction", 1, "p1")}, {grams_sql("pairs", "reference", 1, "r1")},
vocab AS (
  SELECT g, list_transform(v, lambda x: CAST(x / sqrt(list_inner_product(v, v)) AS DOUBLE)) AS v
  FROM (SELECT g, list_transform({TOKEN_VECTOR_SQL}, lambda x: CAST(x AS DOUBLE)) AS v
        FROM (SELECT g FROM p1 UNION SELECT g FROM r1))),
sims AS (
  SELECT p.id, p.g AS pg, p.n AS pn, r.g AS rg, r.n AS rn, list_inner_product(x.v, y.v) AS c
  FROM p1 p JOIN r1 r ON r.id = p.id JOIN vocab x ON x.g = p.g JOIN vocab y ON y.g = r.g),
prec AS (SELECT id, sum(n * c) / sum(n) AS p FROM (
  SELECT id, pg, any_value(pn) AS n, max(c) AS c FROM sims GROUP BY 1, 2) GROUP BY 1),
rec AS (SELECT id, sum(n * c) / sum(n) AS r FROM (
  SELECT id, rg, any_value(rn) AS n, max(c) AS c FROM sims GROUP BY 1, 2) GROUP BY 1),
scored AS (
  SELECT pairs.id, turn, coalesce(p, 0.0) AS p, coalesce(r, 0.0) AS r,
         CASE WHEN coalesce(p + r, 0.0) <> 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f
  FROM pairs LEFT JOIN prec ON prec.id = pairs.id LEFT JOIN rec ON rec.id = pairs.id)"""


@query(
    "bertscore_scores",
    f"""WITH {BERTSCORE_SQL} SELECT id, round(p, 6) AS bertscore_precision,
round(r, 6) AS bertscore_recall, round(f, 6) AS bertscore_f1 FROM scored""",
)
def bertscore_scores(spark, sf):
    s = metrics.bertscore_scores(_pairs(spark, sf), "id")
    return s.select("id", *[F.round(c, 6).alias(c) for c in s.columns if c != "id"])


@query(
    "bertscore",
    f"""WITH {BERTSCORE_SQL}, m AS (SELECT avg(p) AS p, avg(r) AS r, avg(f) AS f FROM scored)
SELECT 'bertscore' AS metric, 'bertscore_precision' AS sub_metric, round(p, 6) AS value FROM m
UNION ALL SELECT 'bertscore', 'bertscore_recall', round(r, 6) FROM m
UNION ALL SELECT 'bertscore', 'bertscore_f1', round(f, 6) FROM m""",
)
def bertscore(spark, sf):
    return metrics.bertscore(_pairs(spark, sf), "id")


# Semantic similarity ----------------------------------------------------------------------------


def soft_sql(a: str, b: str) -> str:
    return (
        f"list_inner_product({a}, {b}) / "
        f"(sqrt(list_inner_product({a}, {a})) * sqrt(list_inner_product({b}, {b})) + 1e-8)"
    )


SIMILARITY_SQL = f"""{PAIRS_SQL},
p AS (SELECT id, prediction AS text FROM pairs), {embed_sql("p", "pv")},
r AS (SELECT id, reference AS text FROM pairs), {embed_sql("r", "rv")},
sim AS (
  SELECT pairs.id, turn, {soft_sql("pv.v", "rv.v")} AS s
  FROM pairs JOIN pv ON pv.id = pairs.id JOIN rv ON rv.id = pairs.id)"""


@query(
    "semantic_similarity_scores",
    f"WITH {SIMILARITY_SQL} SELECT id, round(s, 6) AS semantic_similarity FROM sim",
)
def semantic_similarity_scores(spark, sf):
    s = metrics.semantic_similarity_scores(_pairs(spark, sf), "id")
    return s.withColumn("semantic_similarity", F.round("semantic_similarity", 6))


@query(
    "semantic_similarity_by_turn",
    f"""WITH {SIMILARITY_SQL}
SELECT turn, 'semantic_similarity' AS metric, 'semantic_similarity' AS sub_metric,
       round(avg(s), 6) AS value FROM sim GROUP BY 1""",
)
def semantic_similarity_by_turn(spark, sf):
    return metrics.semantic_similarity(_pairs(spark, sf), "id", by=["turn"])


@query(
    "semantic_similarity_vectors",
    f"""WITH {EMBEDDINGS_SQL}
SELECT 'semantic_similarity' AS metric, 'semantic_similarity' AS sub_metric,
       round(avg({soft_sql("a.v", "b.v")}), 6) AS value FROM emb a JOIN emb b ON b.id = a.id + 1""",
)
def semantic_similarity_vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("reference_v"))
    pairs = e.select("vec_id", F.col("embedding").alias("prediction_v")).join(nxt, "vec_id")
    vectors = ("prediction_v", "reference_v")
    return metrics.semantic_similarity(pairs, "vec_id", vectors=vectors)


# Refusal ----------------------------------------------------------------------------------------

REFUSAL_SQL = f"""{LABELLED_SQL},
rows AS (
  SELECT doc_id, lang, coalesce(quality, 1) <> 0 AS answerable,
         trim(CASE WHEN toxic = 1 OR quality = 0 AND n_chars > 500
              THEN '  {MESSAGE_SQL} ' ELSE text END) = '{MESSAGE_SQL}' AS refused FROM labelled),
m AS (
  SELECT lang, count(*) AS n, count(*) FILTER (NOT answerable AND refused) AS tp,
         count(*) FILTER (answerable AND refused) AS fp,
         count(*) FILTER (NOT answerable) AS un FROM rows GROUP BY GROUPING SETS ((), (lang)))"""


def refusal_rows_sql(keep: str, where: str) -> str:
    names = {
        "refusal_precision": "tp / (tp + fp + 1e-9)",
        "refusal_recall": "tp / (un + 1e-9)",
        "false_refusal_rate": "fp / n",
    }
    return "\nUNION ALL ".join(
        f"SELECT {keep}'refusal' AS metric, '{k}' AS sub_metric, round({v}, 6) AS value "
        f"FROM m WHERE {where}"
        for k, v in names.items()
    )


def _refusals(spark, sf):
    d = spread(labelled(spark, sf))
    refuses = (F.col("toxic") == 1) | ((F.col("quality") == 0) & (F.col("n_chars") > 500))
    d = d.withColumn("q", F.coalesce("quality", F.lit(1)))
    return d.select(
        F.col("doc_id").alias("id"),
        "lang",
        F.when(refuses, F.lit(f"  {REFUSAL_MESSAGE} ")).otherwise(F.col("text")).alias("prediction"),
        F.col("source").alias("reference"),
        tx.truthy(d, "q").alias("answerable"),
    )


@query("refusal", f"WITH {REFUSAL_SQL} {refusal_rows_sql('', 'lang IS NULL')}")
def refusal(spark, sf):
    return metrics.refusal(_refusals(spark, sf))


@query("refusal_by_lang", f"WITH {REFUSAL_SQL} {refusal_rows_sql('lang, ', 'lang IS NOT NULL')}")
def refusal_by_lang(spark, sf):
    return metrics.refusal(_refusals(spark, sf), by=["lang"])


@query(
    "is_refusal",
    f"""WITH {LABELLED_SQL}
SELECT doc_id, coalesce(toxic = 1, false) AS refused FROM labelled""",
)
def is_refusal(spark, sf):
    d = labelled(spark, sf)
    said = F.when(F.col("toxic") == 1, padded(F.lit(REFUSAL_MESSAGE))).otherwise(F.col("text"))
    return d.select("doc_id", metrics.is_refusal(said).alias("refused"))


@query(
    "answerable",
    f"""WITH {LABELLED_SQL}
SELECT doc_id, coalesce(quality, 0) <> 0 AS by_number, source <> 'src0' AS by_text,
       coalesce(toxic > 0, false) AS by_flag FROM labelled""",
)
def answerable(spark, sf):
    d = labelled(spark, sf).withColumns(
        {
            "flag": F.col("toxic") > 0,
            "label": F.when(F.col("source") == "src0", "").otherwise(F.col("source")),
        }
    )
    return d.select(
        "doc_id",
        tx.truthy(d, "quality").alias("by_number"),
        tx.truthy(d, "label").alias("by_text"),
        tx.truthy(d, "flag").alias("by_flag"),
    )


# Run-all, custom metrics, result files ----------------------------------------------------------


ALL_PAIRS_SQL = f"""pairs AS MATERIALIZED (
  SELECT doc_id AS id, source AS reference, 0 AS turn,
    CASE WHEN toxic = 1 OR quality = 0 AND n_chars > 500 THEN '  {MESSAGE_SQL} ' ELSE text END AS prediction
  FROM labelled)"""


@query(
    "evaluate_all",
    f"""WITH {REFUSAL_SQL}, {BERTSCORE_SQL.replace(PAIRS_SQL, ALL_PAIRS_SQL)},
{SIMILARITY_SQL.replace(f"{PAIRS_SQL},", "").replace("p AS (SELECT", "sp AS (SELECT").replace("r AS (SELECT", "sr AS (SELECT")
 .replace(embed_sql("p", "pv"), embed_sql("sp", "pv")).replace(embed_sql("r", "rv"), embed_sql("sr", "rv")).strip()},
{stems_of_sql("pairs")}, {stemmed_rouge_sql("pairs", 1)}, {stemmed_rouge_sql("pairs", 2)}
{refusal_rows_sql("", "lang IS NULL")}
UNION ALL SELECT 'bertscore', 'bertscore_precision', round(avg(p), 6) FROM scored
UNION ALL SELECT 'bertscore', 'bertscore_recall', round(avg(r), 6) FROM scored
UNION ALL SELECT 'bertscore', 'bertscore_f1', round(avg(f), 6) FROM scored
UNION ALL SELECT 'semantic_similarity', 'semantic_similarity', round(avg(s), 6) FROM sim
UNION ALL SELECT 'rouge', 'rouge1', round(avg(f), 6) FROM s1
UNION ALL SELECT 'rouge', 'rouge2', round(avg(f), 6) FROM s2
-- the references are single words: the longest common subsequence is the shared word
UNION ALL SELECT 'rouge', 'rougeL', round(avg(f), 6) FROM s1""",
)
def evaluate_all(spark, sf):
    pairs = _refusals(spark, sf)
    names = ("rouge", "bertscore", "semantic_similarity", "refusal")
    return ev.evaluate(pairs, names)


def same_start():
    return metrics.from_row_scorer(
        "same_start", lambda p, r: [float(a[:1] == b[:1]) for a, b in zip(p, r)]
    )


@query(
    "custom_metric",
    f"""WITH {PAIRS_SQL}
SELECT 'same_start' AS metric, 'score' AS sub_metric,
  round(avg(CASE WHEN substr(prediction, 1, 1) = substr(reference, 1, 1) THEN 1.0 ELSE 0.0 END), 6)
  AS value FROM pairs""",
)
def custom_metric(spark, sf):
    return ev.evaluate(_pairs(spark, sf), [], "id", extra=[same_start()])


def _clipped_sql(by: str) -> str:
    """Corpus sums per group: ``by`` is a list of columns with a comma at the end, or nothing."""
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""

    def grams(n: int, side: str) -> str:
        return (
            f"{side}{n} AS (SELECT id, turn, g, count(*) AS n FROM (SELECT id, turn, unnest(list_transform("
            f"range(greatest(len({side}) - {n - 1}, 0)), lambda i: array_to_string({side}[i + 1:i + {n}], ' '))) AS g "
            "FROM tok) GROUP BY 1, 2, 3)"
        )

    def sums(n: int) -> str:
        return (
            f"m{n} AS (SELECT {by} coalesce(sum(least(p.n, coalesce(r.n, 0))), 0) AS m, coalesce(sum(p.n), 0) AS t "
            f"FROM p{n} p LEFT JOIN r{n} r USING (id, turn, g) {group})"
        )

    join = f"USING ({by.rstrip(', ')})" if by else "ON true"
    return f"""WITH {PAIRS_SQL},
tok AS (SELECT id, turn, regexp_extract_all(lower(prediction), '[a-z0-9]+') AS p,
  regexp_extract_all(lower(reference), '[a-z0-9]+') AS r FROM pairs),
{grams(1, "p")}, {grams(1, "r")}, {grams(2, "p")}, {grams(2, "r")}, {sums(1)}, {sums(2)},
len AS (SELECT {by} sum(len(p)) AS p, sum(len(r)) AS r FROM tok {group}),
v AS (SELECT {by} CASE WHEN len.p = 0 THEN 0.0 ELSE least(1.0, exp(1 - len.r / len.p)) END AS bp,
  coalesce(m1.m / nullif(m1.t, 0), 0.0) AS p1, coalesce(m2.m / nullif(m2.t, 0), 0.0) AS p2
  FROM len LEFT JOIN m1 {join} LEFT JOIN m2 {join})
SELECT {by} 'clipped_precision' AS metric, unnest(['score', 'length_penalty', 'precision1', 'precision2']) AS sub_metric,
  round(unnest([CASE WHEN p1 > 0 AND p2 > 0 THEN bp * exp((ln(greatest(p1, 1e-300)) + ln(greatest(p2, 1e-300))) / 2) ELSE 0.0 END,
    bp, p1, p2]), 6) AS value FROM v"""


@query("corpus_metric", _clipped_sql(""))
def corpus_metric(spark, sf):
    """A value that is no mean of rows, merged from the states of tasks."""
    return ev.evaluate(_pairs(spark, sf), [], "id", extra=[metrics.clipped_precision()])


@query("corpus_metric_by_turn", _clipped_sql("turn, "))
def corpus_metric_by_turn(spark, sf):
    return ev.evaluate(_pairs(spark, sf), [], "id", extra=[metrics.clipped_precision()], by=["turn"])


RESULTS_SQL = f"WITH {REFUSAL_SQL} {refusal_rows_sql('', 'lang IS NULL')}"


def _stored_results(spark, sf):
    path = scratch_path(spark, "results")
    sinks.write_results(path, metrics.refusal(_refusals(spark, sf)))
    return tables.read_results(spark, f"{path}/quantitative")


@query("results_sink", RESULTS_SQL)
def results_sink(spark, sf):
    """Write results as JSON, read them back, flatten."""
    return report.flatten(_stored_results(spark, sf))


@query(
    "results_pivot",
    f"""WITH {REFUSAL_SQL}
SELECT 'refusal' AS metric, round(tp / (tp + fp + 1e-9), 4) AS refusal_precision,
       round(tp / (un + 1e-9), 4) AS refusal_recall, round(fp / n, 4) AS false_refusal_rate
FROM m WHERE lang IS NULL""",
)
def results_pivot(spark, sf):
    names = ["refusal_precision", "refusal_recall", "false_refusal_rate"]
    return report.pivot(report.flatten(_stored_results(spark, sf)), names)
