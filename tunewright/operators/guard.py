"""Refusal guardrail over embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunewright.functions import embed as em
from tunewright.functions import vectors as vx
from tunewright.operators.infer import PredictorFactory, predicted
from tunewright.operators.prompt import strip_prompt
from tunewright.operators.nearest import max_cosine_join
from tunewright.operators.rank import BROADCAST_ROWS
from tunewright.operators.similarity_join import BLOCK
from tunewright.specs import REFUSAL_MESSAGE, GuardSpec

# Anchors that fit one matrix in each Python worker; in a larger table they are searched by cells.
ANCHOR_ROWS = 4096
assert ANCHOR_ROWS < BROADCAST_ROWS


def scope_score(question_vec: Column, anchors: np.ndarray) -> Column:
    """Largest cosine of the question to the anchors."""
    return vx.max_cosine(question_vec, anchors)


def scope_scores(
    df: DataFrame, key: str, vec: str, anchors: DataFrame, anchor_vec: str,
    anchor_rows: int = ANCHOR_ROWS, block: int = BLOCK,
) -> DataFrame:
    """Scope score per row against an anchor table of any size.

    The anchor table is read up to the limit. Within it, it becomes a constant matrix and no row
    moves; beyond it both sides are joined in blocks. Either way each row gets one score, which is
    null if there are no anchors.
    """
    rows = anchors.select(F.col(anchor_vec).cast("array<double>")).limit(anchor_rows + 1).collect()
    if not rows:
        return df.select(key, F.lit(None).cast("double").alias("max_cosine"))
    if len(rows) <= anchor_rows:
        return df.select(
            key,
            scope_score(F.col(vec), np.array([r[0] for r in rows])).alias("max_cosine"),
        )
    return max_cosine_join(df, key, vec, anchors, anchor_vec, block)


def confidence_score(question_vec: Column, answer_vec: Column) -> Column:
    return vx.cosine(question_vec, answer_vec)


def verdict(scope: Column, confidence: Column, spec: GuardSpec) -> Column:
    """``{should_refuse, reason, scope_score, confidence_score}``; scope comes before confidence."""
    reason = F.when(scope < spec.scope_threshold, "out_of_scope").when(
        confidence < spec.confidence_threshold, "low_confidence"
    )
    return F.struct(
        reason.isNotNull().alias("should_refuse"),
        reason.alias("reason"),
        scope.alias("scope_score"),
        confidence.alias("confidence_score"),
    )


def check(
    df: DataFrame, question_vec: str, answer_vec: str, anchors: np.ndarray,
    spec: GuardSpec = GuardSpec(),
) -> DataFrame:
    """Add the verdict columns for given question and answer vectors."""
    scored = df.withColumns(
        {
            "scope_score": scope_score(F.col(question_vec), anchors),
            "confidence_score": confidence_score(F.col(question_vec), F.col(answer_vec)),
        }
    )
    v = verdict(F.col("scope_score"), F.col("confidence_score"), spec)
    return scored.withColumns({"reason": v["reason"], "should_refuse": v["should_refuse"]})


def apply(df: DataFrame, answer: str, out: str = "answer") -> DataFrame:
    """Put the refusal text where the verdict says so."""
    return df.withColumn(
        out, F.when(F.col("should_refuse"), F.lit(REFUSAL_MESSAGE)).otherwise(F.col(answer))
    )


def reasons(df: DataFrame) -> DataFrame:
    """Rows and mean scores per reason; answered rows count under ``none``."""
    return df.groupBy(F.coalesce("reason", F.lit("none")).alias("reason")).agg(
        F.count("*").alias("n"),
        F.avg("scope_score").alias("avg_scope"),
        F.avg("confidence_score").alias("avg_confidence"),
    )


def predict_guarded(
    df: DataFrame,
    prompt_col: str,
    factory: PredictorFactory,
    spec: GuardSpec = GuardSpec(),
    embedder: em.EmbedderFactory | None = None,
    question_col: str | None = None,
    batch_size: int = 8,
    max_new_tokens: int = 256,
    out: str = "answer",
) -> DataFrame:
    """Predict behind the guardrail, in one pass over the rows.

    With ``check_before`` an out-of-scope prompt becomes null before the model call, so the model
    never sees it. The echoed prompt is taken off the answer before its confidence is scored.
    """
    anchors = em.embed_phrases(df.sparkSession, spec.anchors, embedder)
    question = F.col(question_col or prompt_col)
    scored = df.withColumn("_qv", em.embed(question, embedder)).withColumn(
        "scope_score", scope_score(F.col("_qv"), anchors)
    )
    prompt = F.col(prompt_col)
    sent = F.when(F.col("scope_score") >= spec.scope_threshold, prompt) if spec.check_before else prompt
    raw = scored.withColumn("_raw", predicted(sent, factory, batch_size, max_new_tokens))
    answered = raw.withColumn("_clean", strip_prompt(F.col("_raw"), prompt))
    confidence = confidence_score(F.col("_qv"), em.embed(F.col("_clean"), embedder))
    judged = answered.withColumn(
        "confidence_score", F.when(F.col("_raw").isNotNull(), confidence)
    )
    v = verdict(F.col("scope_score"), F.col("confidence_score"), spec)
    judged = judged.withColumns({"reason": v["reason"], "should_refuse": v["should_refuse"]})
    return apply(judged, "_clean", out).drop("_qv", "_raw", "_clean")
