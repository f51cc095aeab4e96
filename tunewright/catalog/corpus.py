"""Scans, cleaning, sampling, splitting, prompts, tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.catalog import query
from tunewright.catalog.common import (
    CHAT_SQL,
    LABELLED_SQL,
    chat_pairs,
    hash_sql,
    stem_sql,
    labelled,
    padded,
    padded_sql,
    strip_sql,
    table,
)
from tunewright.functions import text as tx
from tunewright.functions.stem import stem_vocab
from tunewright.operators import clean as cl
from tunewright.operators import prompt as pr
from tunewright.operators import rank, templates, tokens
from tunewright.operators import sample as sm
from tunewright.operators import split as sp
from tunewright.plans import data_prep
from tunewright.session import scratch_path, spread
from tunewright.sources import sinks, tables
from tunewright.specs import (
    DEFAULT_SYSTEM_PROMPT,
    FULL_TEMPLATE,
    INPUT_TEMPLATE,
    CleanSpec,
    DataSpec,
    PromptSpec,
    SampleSpec,
    SplitSpec,
)

# Scans ------------------------------------------------------------------------------------------


@query(
    "load_table",
    "SELECT doc_id, lang, source, CAST(length(text) AS INT) AS n_points, n_chars FROM documents",
)
def load_table(spark, sf):
    d = tables.load(spark, f"{sf}/documents.parquet")
    return d.select("doc_id", "lang", "source", F.length("text").alias("n_points"), "n_chars")


@query("load_split", "SELECT doc_id, text FROM documents WHERE lang = 'fr'")
def load_split(spark, sf):
    d = tables.load(spark, f"{sf}/documents.parquet", split="fr", split_column="lang")
    return d.select("doc_id", "text")


# Cleaning ---------------------------------------------------------------------------------------


def _scored(spark, sf):
    score = F.when(F.col("quality") < F.col("toxic"), F.lit(float("nan"))).otherwise(
        F.col("quality") - F.col("toxic")
    )
    return labelled(spark, sf).select("doc_id", "lang", "text", score.cast("double").alias("score"))


@query(
    "drop_missing",
    f"""WITH {LABELLED_SQL}
SELECT doc_id, lang, CAST(quality - toxic AS DOUBLE) AS score FROM labelled
WHERE quality IS NOT NULL AND quality >= toxic""",
)
def drop_missing(spark, sf):
    return cl.drop_missing(_scored(spark, sf).select("doc_id", "lang", "score"), ["lang", "score"])


@query("strip_whitespace", f"SELECT doc_id, {strip_sql(padded_sql('text'))} AS text FROM documents")
def strip_whitespace(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", padded(F.col("text")).alias("text"))
    return cl.strip(d)


@query("lowercase", "SELECT doc_id, lower(text) AS text, lower(source) AS source FROM documents")
def lowercase(spark, sf):
    return cl.lower(table(spark, sf, "documents").select("doc_id", "text", "source"))


@query(
    "dedup_exact",
    """SELECT doc_id, text, lang, source FROM documents
WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)""",
)
def dedup_exact(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return cl.dedup_exact(d, ["text"], "doc_id")


@query(
    "dedup_rows",
    f"WITH {LABELLED_SQL} SELECT DISTINCT lang, source, quality, toxic FROM labelled",
)
def dedup_rows(spark, sf):
    return cl.dedup_exact(labelled(spark, sf).select("lang", "source", "quality", "toxic"))


CLEAN_SQL = f"""cleaned AS (
  SELECT min(doc_id) AS doc_id, text, lang, quality FROM (
    SELECT doc_id, lower({strip_sql(padded_sql("text"))}) AS text, lang, quality
    FROM labelled WHERE quality IS NOT NULL) GROUP BY text, lang, quality)"""


@query("clean", f"WITH {LABELLED_SQL}, {CLEAN_SQL} SELECT doc_id, text, lang, quality FROM cleaned")
def clean(spark, sf):
    d = labelled(spark, sf).select("doc_id", padded(F.col("text")).alias("text"), "lang", "quality")
    return cl.clean(d, CleanSpec(lower=True), "doc_id")


@query(
    "clean_columns",
    f"""SELECT doc_id, {strip_sql(padded_sql("text"))} AS text, {padded_sql("source")} AS source
FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)""",
)
def clean_columns(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id", padded(F.col("text")).alias("text"), padded(F.col("source")).alias("source")
    )
    return cl.clean(d, CleanSpec(columns=("text",)), "doc_id")


# Sampling ---------------------------------------------------------------------------------------


@query("seeded_rank", f"SELECT doc_id, row_number() OVER (ORDER BY {hash_sql('doc_id')}) AS rank FROM documents")
def seeded_rank(spark, sf):
    return rank.seeded_rank(table(spark, sf, "documents").select("doc_id"), "doc_id", 42)


@query(
    "sample_random",
    f"SELECT doc_id, text FROM documents ORDER BY {hash_sql('doc_id')} LIMIT 137",
)
def sample_random(spark, sf):
    return sm.random_n(table(spark, sf, "documents").select("doc_id", "text"), 137, "doc_id")


@query(
    "sample_random_orders",
    f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {hash_sql('o_orderkey', 7)} LIMIT 5000",
)
def sample_random_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sm.random_n(o, 5000, "o_orderkey", 7)


@query("sample_first", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars, doc_id LIMIT 100")
def sample_first(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return sm.first_n(d, 100, ["n_chars", "doc_id"])


@query(
    "sample_first_large",
    """SELECT o_orderkey, o_orderpriority FROM orders
ORDER BY o_orderpriority, o_orderkey LIMIT 12000""",
)
def sample_first_large(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return sm.first_n(o, 12000, ["o_orderpriority", "o_orderkey"])


def quota_sql(src: str, column: str, n: int) -> str:
    return f"""sizes AS (SELECT {column} AS s, count(*) AS size FROM {src} GROUP BY 1),
q0 AS (
  SELECT s, size, greatest(1, CAST(round_even(size * {float(n)} / (SELECT sum(size) FROM sizes), 0)
         AS BIGINT)) AS q FROM sizes WHERE s IS NOT NULL),
fix AS (
  SELECT {n} - sum(q) AS d,
         (SELECT s FROM q0 ORDER BY q DESC, s LIMIT 1) AS most,
         (SELECT s FROM q0 ORDER BY q, s LIMIT 1) AS least FROM q0),
quotas AS (
  SELECT s, least(size, CAST(q + CASE WHEN (d > 0 AND s = most) OR (d < 0 AND s = least)
         THEN d ELSE 0 END AS BIGINT)) AS quota FROM q0, fix)"""


def stratified_sql(src: str, column: str, key: str, n: int, seed: int = 42) -> str:
    return f"""{quota_sql(src, column, n)},
drawn AS (
  SELECT x.* FROM (
    SELECT *, row_number() OVER (PARTITION BY {column} ORDER BY {hash_sql(key, seed)}) AS place
    FROM {src}) x JOIN quotas ON s = {column} WHERE place <= quota)"""


@query(
    "stratified_quotas",
    f"WITH {quota_sql('documents', 'lang', 137)} SELECT s AS lang, quota FROM quotas",
)
def stratified_quotas(spark, sf):
    return sm.stratified_quotas(table(spark, sf, "documents"), 137, "lang")[0]


@query(
    "sample_stratified",
    f"WITH {stratified_sql('documents', 'lang', 'doc_id', 137)} SELECT doc_id, lang, text FROM drawn",
)
def sample_stratified(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return sm.stratified_n(d, 137, "lang", "doc_id")


@query(
    "sample_stratified_orders",
    f"""WITH {stratified_sql('orders', 'o_orderpriority', 'o_orderkey', 1001)}
SELECT o_orderkey, o_orderpriority FROM drawn""",
)
def sample_stratified_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return sm.stratified_n(o, 1001, "o_orderpriority", "o_orderkey")


@query(
    "sample_stratified_nulls",
    f"""WITH {LABELLED_SQL}, {stratified_sql('labelled', 'quality', 'doc_id', 60)}
SELECT doc_id, quality FROM drawn""",
)
def sample_stratified_nulls(spark, sf):
    return sm.stratified_n(
        labelled(spark, sf).select("doc_id", "quality"), 60, "quality", "doc_id"
    )


@query(
    "downsample",
    f"""WITH {stratified_sql('customer', 'c_mktsegment', 'c_custkey', 100, 0)}
SELECT c_custkey, c_mktsegment FROM drawn""",
)
def downsample(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    spec = SampleSpec(n=100, strategy=" Stratified ", seed=0, stratify_column="c_mktsegment")
    return sm.downsample(c, spec, "c_custkey")


@query(
    "build_text",
    f"""WITH {LABELLED_SQL}
SELECT doc_id, lang || ' ' || coalesce(CAST(quality AS VARCHAR), 'None') || ' ' || text AS built
FROM labelled""",
)
def build_text(spark, sf):
    d = labelled(spark, sf)
    return d.select("doc_id", tx.build_text(d, ["lang", "quality", "text"]).alias("built"))


@query(
    "default_text_columns",
    f"""WITH {CHAT_SQL}
SELECT 'chat' AS src, id::VARCHAR AS id, instruction || ' ' || input AS built FROM chat
UNION ALL SELECT 'documents', doc_id::VARCHAR, text FROM documents""",
)
def default_text_columns(spark, sf):
    """Instruction and input where a table has both, else its first text column."""
    out = []
    for name, d, key in (
        ("chat", chat_pairs(spark, sf), "id"),
        ("documents", table(spark, sf, "documents"), "doc_id"),
    ):
        text = tx.build_text(d, tx.default_text_columns(d))
        id_ = F.col(key).cast("string").alias("id")
        out.append(d.select(F.lit(name).alias("src"), id_, text.alias("built")))
    return out[0].unionByName(out[1])


@query("length_filter", "SELECT doc_id FROM documents WHERE length(text) BETWEEN 20 AND 4000")
def length_filter(spark, sf):
    d = table(spark, sf, "documents")
    return sm.length_filter(d, F.col("text"), 20, 4000).select("doc_id")


@query(
    "sample_curated",
    f"""WITH {LABELLED_SQL} SELECT doc_id, quality FROM labelled
WHERE {strip_sql("source")} <> '' AND length(text) BETWEEN 50 AND 5000 AND quality >= 1
ORDER BY {hash_sql('doc_id')} LIMIT 90""",
)
def sample_curated(spark, sf):
    spec = SampleSpec(
        n=90, strategy="curated", min_chars=50, max_chars=5000, output_column="text",
        instruction_column="source", score_column="quality", min_score=1,
    )
    return sm.downsample(labelled(spark, sf), spec, "doc_id").select("doc_id", "quality")


@query("group_sizes", f"WITH {LABELLED_SQL} SELECT quality, count(*) AS size FROM labelled WHERE quality IS NOT NULL GROUP BY 1")
def group_sizes(spark, sf):
    return sm.group_sizes(labelled(spark, sf), "quality")


# Splitting --------------------------------------------------------------------------------------


def split_sql(src: str, key: str, seed: int = 42, test: float = 0.1, val: float = 0.1) -> str:
    train = round(1 - test - val, 10)
    return f"""n AS (SELECT count(*) AS n FROM {src}),
sizes AS (SELECT n, CAST(ceil(CAST({test} AS DOUBLE) * n) AS BIGINT) AS n_test FROM n),
cuts AS (
  SELECT n_test, n_test + CAST(ceil(CAST({val} AS DOUBLE) /
         (CAST({train} AS DOUBLE) + CAST({val} AS DOUBLE)) * (n - n_test)) AS BIGINT) AS upto
  FROM sizes),
placed AS (
  SELECT s.*, row_number() OVER (ORDER BY {hash_sql(key, seed)}) AS place FROM {src} s),
split AS (
  SELECT placed.*, CASE WHEN place <= n_test THEN 'test' WHEN place <= upto THEN 'val'
         ELSE 'train' END AS split FROM placed, cuts)"""


@query("split_random", f"WITH {split_sql('documents', 'doc_id')} SELECT doc_id, text, split FROM split")
def split_random(spark, sf):
    return sp.split(table(spark, sf, "documents").select("doc_id", "text"), SplitSpec(), "doc_id")


@query(
    "split_orders",
    f"""WITH {split_sql('orders', 'o_orderkey', 7, 0.15, 0.05)}
SELECT split, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM split GROUP BY 1""",
)
def split_orders(spark, sf):
    spec = SplitSpec(train=0.8, val=0.05, test=0.15, seed=7)
    s = sp.split(table(spark, sf, "orders").select("o_orderkey"), spec, "o_orderkey")
    return s.groupBy("split").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


def class_split_sql(src: str, column: str, key: str, seed: int = 42) -> str:
    """Stratified 0.8 / 0.1 / 0.1."""

    def share(size: str, total: str, draws: str, rel: str, out: str, keep: str) -> str:
        return f"""{out}_f AS (
  SELECT {rel}.*, floor(CAST({size} AS DOUBLE) / {total} * {draws}) AS f,
         CAST({size} AS DOUBLE) / {total} * {draws}
         - floor(CAST({size} AS DOUBLE) / {total} * {draws}) AS r FROM {rel}, cuts),
{out}_k AS (SELECT *, row_number() OVER (ORDER BY r DESC, s) AS k FROM {out}_f),
{out} AS (
  SELECT {keep}, CAST(f + CASE WHEN k <= {draws} - (SELECT sum(f) FROM {out}_f) THEN 1 ELSE 0 END
         AS BIGINT) AS {out} FROM {out}_k, cuts)"""

    return f"""n AS (SELECT count(*) AS n FROM {src}),
sizes AS (SELECT n, CAST(ceil(CAST(0.1 AS DOUBLE) * n) AS BIGINT) AS n_test FROM n),
cuts AS (
  SELECT n, n_test, n - n_test AS n_tv, n - n_test - CAST(ceil(CAST(0.1 AS DOUBLE) /
         (CAST(0.8 AS DOUBLE) + CAST(0.1 AS DOUBLE)) * (n - n_test)) AS BIGINT) AS n_train
  FROM sizes),
classes AS (SELECT {column} AS s, count(*) AS size FROM {src} GROUP BY 1),
{share("size", "n", "n_tv", "classes", "tv", "s, size")},
{share("tv", "n_tv", "n_train", "tv", "train", "s, size, tv")},
placed AS (
  SELECT x.*, row_number() OVER (PARTITION BY {column} ORDER BY {hash_sql(key, seed)}) AS place
  FROM {src} x),
split AS (
  SELECT placed.*, CASE WHEN place <= size - tv THEN 'test' WHEN place <= size - train THEN 'val'
         ELSE 'train' END AS split FROM placed JOIN train ON s = {column})"""


@query(
    "split_stratified",
    f"""WITH {class_split_sql('orders', 'o_orderpriority', 'o_orderkey')}
SELECT o_orderkey, o_orderpriority, split FROM split""",
)
def split_stratified(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return sp.split(o, SplitSpec(stratify_column="o_orderpriority"), "o_orderkey")


@query(
    "split_stratified_documents",
    f"WITH {class_split_sql('documents', 'lang', 'doc_id')} SELECT doc_id, lang, split FROM split",
)
def split_stratified_documents(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return sp.split(d, SplitSpec(stratify_column="lang"), "doc_id")


@query(
    "split_leakage",
    f"""WITH {split_sql('documents', 'doc_id')}
SELECT md5(text) AS text_md5, count(*) AS rows FROM split GROUP BY text
HAVING count(DISTINCT split) > 1""",
)
def split_leakage(spark, sf):
    d = sp.split(table(spark, sf, "documents").select("doc_id", "text"), SplitSpec(), "doc_id")
    return sp.leakage(d.select(F.md5("text").alias("text_md5"), "split"), "text_md5")


@query(
    "split_distribution",
    f"""WITH {split_sql('documents', 'doc_id')},
c AS (SELECT split, lang, count(*) AS n FROM split GROUP BY 1, 2),
s AS (SELECT split, lang, n, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY split) AS share,
             CAST(sum(n) OVER (PARTITION BY lang) AS DOUBLE) / sum(n) OVER () AS overall FROM c)
SELECT split, lang, n, round(share, 6) AS share, round(overall, 6) AS overall,
       round(abs(share - overall), 6) AS difference FROM s""",
)
def split_distribution(spark, sf):
    d = sp.split(table(spark, sf, "documents").select("doc_id", "lang"), SplitSpec(), "doc_id")
    out = sp.distribution(d, "lang")
    return out.withColumns({c: F.round(c, 6) for c in ("share", "overall", "difference")})


RATIOS = ((0.8, 0.1, 0.1), (0.7, 0.15, 0.15), (0.6, 0.3, 0.1), (0.5, 0.0, 0.5))


@query(
    "split_sizes",
    "WITH r(train, val, test) AS (VALUES "
    + ", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for a, b, c in RATIOS)
    + """), n AS (SELECT count(*) AS n FROM orders),
t AS (SELECT *, CAST(ceil(test * n) AS BIGINT) AS n_test FROM r, n),
v AS (SELECT *, CAST(ceil(val / (train + val) * (n - n_test)) AS BIGINT) AS n_val FROM t)
SELECT train, val, test, n - n_test - n_val AS n_train, n_val, n_test FROM v""",
)
def split_sizes(spark, sf):
    """Rows of each part of the orders, split by several ratios."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    parts = []
    for ratios in RATIOS:
        split = sp.split(orders, SplitSpec(*ratios), "o_orderkey")
        sizes = [F.count_if(F.col("split") == name).alias(f"n_{name}") for name in sp.NAMES]
        shares = [F.lit(x).alias(name) for x, name in zip(ratios, sp.NAMES, strict=True)]
        parts.append(split.agg(*sizes).select(*shares, "n_train", "n_val", "n_test"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "split_sink",
    f"WITH {split_sql('documents', 'doc_id')} SELECT doc_id, text, split FROM split",
)
def split_sink(spark, sf):
    path = scratch_path(spark, "splits")
    d = table(spark, sf, "documents").select("doc_id", "text")
    sinks.write_splits(sp.split(d, SplitSpec(), "doc_id"), path)
    parts = [tables.load(spark, path, split=name) for name in sp.NAMES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("doc_id", "text", "split")


# Prompts ----------------------------------------------------------------------------------------

FULL_SQL = (
    "'### Instruction:\n' || instruction || '\n\n### Input:\n' || input || "
    "'\n\n### Response:\n' || output"
)
INPUT_SQL = (
    "'### Instruction:\n' || instruction || '\n\n### Input:\n' || input || '\n\n### Response:\n'"
)


@query("format_prompts", f"WITH {CHAT_SQL} SELECT id, {FULL_SQL} AS formatted_text FROM chat")
def format_prompts(spark, sf):
    out = pr.format_prompts(chat_pairs(spark, sf), PromptSpec(template=FULL_TEMPLATE))
    return out.select("id", "formatted_text")


@query(
    "format_aliases",
    f"""WITH {LABELLED_SQL}
SELECT doc_id, 'Text: ' || text || ' {{' || coalesce(CAST(quality AS VARCHAR), 'None') || '}} '
  || coalesce(CASE WHEN toxic > 0 THEN 'True' ELSE NULL END,
              CASE WHEN toxic = 0 THEN 'False' ELSE 'None' END) || ' ' || text AS prompt
FROM labelled""".replace("{{", "{").replace("}}", "}"),
)
def format_aliases(spark, sf):
    d = labelled(spark, sf).withColumn("is_toxic", F.col("toxic") > 0)
    spec = PromptSpec(
        template="Text: {body} {{{grade}}} {is_toxic} {text}",
        aliases={"body": "text", "grade": "quality"},
        output_column="prompt",
    )
    return pr.format_prompts(d, spec).select("doc_id", "prompt")


@query(
    "format_numbers",
    "SELECT o_orderkey, 'Order ' || o_orderkey || ' is ' || o_orderpriority || ': '"
    " || printf('%.2f', o_totalprice) AS prompt FROM orders",
)
def format_numbers(spark, sf):
    spec = PromptSpec(
        template="Order {o_orderkey:d} is {o_orderpriority:s}: {o_totalprice:.2f}",
        output_column="prompt",
    )
    return pr.format_prompts(table(spark, sf, "orders"), spec).select("o_orderkey", "prompt")


_SYSTEM = DEFAULT_SYSTEM_PROMPT.replace("'", "''")


@query(
    "system_prompt",
    f"WITH {CHAT_SQL} SELECT id, '{_SYSTEM}' || '\n\n' || {INPUT_SQL} AS prompt FROM chat",
)
def system_prompt(spark, sf):
    spec = PromptSpec(INPUT_TEMPLATE, {}, f"  {DEFAULT_SYSTEM_PROMPT}\n", "prompt")
    return pr.format_prompts(chat_pairs(spark, sf), spec).select("id", "prompt")


@query(
    "template_lookup",
    """WITH m AS (
  SELECT p_partkey, p_brand || '/' || CASE WHEN p_size < 8 THEN 'SmolLM2-360M'
    WHEN p_size < 16 THEN 'tiny-gpt2' WHEN p_size < 24 THEN 'SmolLM-1B'
    WHEN p_size < 32 THEN 'GPT2-xl' WHEN p_size < 40 THEN 'SmolLM2-135M-chat'
    ELSE p_name END AS model_name FROM part),
k AS (
  SELECT p_partkey, model_name, CASE
    WHEN ends_with(model_name, 'SmolLM2-135M') THEN 'HuggingFaceTB/SmolLM2-135M'
    WHEN ends_with(model_name, 'SmolLM2-360M') THEN 'HuggingFaceTB/SmolLM2-360M'
    WHEN contains(model_name, 'SmolLM2') THEN 'SmolLM2'
    WHEN ends_with(model_name, 'tiny-gpt2') THEN 'sshleifer/tiny-gpt2'
    WHEN contains(model_name, 'gpt2') THEN 'gpt2'
    WHEN contains(model_name, 'SmolLM') THEN 'SmolLM2'
    WHEN contains(lower(model_name), 'gpt2') THEN 'gpt2' END AS template_key FROM m)
SELECT p_partkey, model_name, template_key,
  CASE WHEN template_key IS NOT NULL THEN length('### Instruction:
{instruction}

### Input:
{input}

### Response:
')::INT END AS eval_chars FROM k""",
)
def template_lookup(spark, sf):
    size = F.col("p_size")
    tail = (
        F.when(size < 8, "SmolLM2-360M").when(size < 16, "tiny-gpt2").when(size < 24, "SmolLM-1B")
        .when(size < 32, "GPT2-xl").when(size < 40, "SmolLM2-135M-chat").otherwise(F.col("p_name"))
    )
    m = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.col("p_brand"), F.lit("/"), tail).alias("model_name")
    )
    return templates.resolve(m).select(
        "p_partkey", "model_name", "template_key",
        F.length("eval_input_template").alias("eval_chars"),
    )


# Tokens -----------------------------------------------------------------------------------------


@query(
    "tokenize",
    """WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda x: x <> '') AS w
  FROM documents)
SELECT doc_id, array_to_string(w[1:128], ' ') AS joined, least(len(w), 128)::INT AS n_tokens,
       len(w) > 128 AS was_truncated FROM t""",
)
def tokenize(spark, sf):
    t = tokens.tokenize(spread(table(spark, sf, "documents")), "text", 128, keep=("doc_id",))
    return t.select(
        "doc_id", F.array_join("tokens", " ").alias("joined"), "n_tokens", "was_truncated"
    )


@query(
    "stem_vocabulary",
    f"""WITH words AS (
  SELECT unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS token
  FROM documents),
counts AS MATERIALIZED (SELECT token, count(*) AS n FROM words GROUP BY 1), {stem_sql("counts", "stems")}
SELECT token, stem, n FROM stems JOIN counts USING (token)""",
)
def stem_vocabulary(spark, sf):
    d = spread(table(spark, sf, "documents"))
    return stem_vocab(d, tx.score_tokens(F.col("text")))


# Whole preparation ------------------------------------------------------------------------------

PREPARE_SQL = f"""base AS (
  SELECT min(doc_id) AS doc_id, text, lang, source FROM (
    SELECT doc_id, {strip_sql("text")} AS text, lang, source FROM documents)
  GROUP BY text, lang, source),
{split_sql("base", "doc_id")}
SELECT doc_id, split, 'Language: ' || lang || '\n\n' || text AS formatted_text FROM split"""


@query("prepare_documents", f"WITH {PREPARE_SQL}")
def prepare_documents(spark, sf):
    spec = DataSpec(
        path=f"{sf}/documents.parquet", key=("doc_id",), sample=SampleSpec(n=None),
        prompt=PromptSpec(template="Language: {lang}\n\n{text}"),
    )
    df = tables.load(spark, spec.path, spec.fmt).select("doc_id", "text", "lang", "source")
    return data_prep.prepare(df, spec).select("doc_id", "split", "formatted_text")
