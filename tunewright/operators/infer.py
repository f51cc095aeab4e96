"""Batch inference and what surrounds it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunewright.functions import text as tx
from tunewright.operators.prompt import render, strip_prompt

Predictor = Callable[[list[str], int], list[str]]
PredictorFactory = Callable[[], Predictor]

QUESTION_ERROR = "Missing or empty 'question' field"  # fixed value


def predicted(
    prompt: Column, factory: PredictorFactory, batch_size: int = 8, max_new_tokens: int = 256
) -> Column:
    """Model output per prompt. The model is made once per task and sees ``batch_size`` prompts at
    a time; null prompts never reach it and give null.

    Marked non-deterministic so that a later filter or generator cannot make the optimizer copy the
    call and run the model twice.
    """

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        for batch in batches:
            prompts = batch.to_pylist()
            at = [i for i, p in enumerate(prompts) if p is not None]
            out: list[str | None] = [None] * len(prompts)
            for start in range(0, len(at), batch_size):
                chunk = at[start : start + batch_size]
                answers = model([prompts[i] for i in chunk], max_new_tokens)
                for i, answer in zip(chunk, answers, strict=True):
                    out[i] = answer
            yield pa.array(out, pa.string())

    return run.asNondeterministic()(prompt)


def predict(
    df: DataFrame,
    prompt_col: str,
    factory: PredictorFactory,
    batch_size: int = 8,
    max_new_tokens: int = 256,
    out: str = "raw_output",
) -> DataFrame:
    """Only the prompt column goes to Python; the other columns stay in the JVM."""
    return df.withColumn(out, predicted(F.col(prompt_col), factory, batch_size, max_new_tokens))


def qualitative(
    df: DataFrame, factory: PredictorFactory, prompt_col: str = "prompt", batch_size: int = 8,
    max_new_tokens: int = 256,
) -> DataFrame:
    """``(input, output)`` for free prompts."""
    raw = predict(df.select(prompt_col), prompt_col, factory, batch_size, max_new_tokens)
    return raw.select(
        F.col(prompt_col).alias("input"),
        strip_prompt(F.col("raw_output"), F.col(prompt_col)).alias("output"),
    )


def ask(
    df: DataFrame, question: str = "question", context: str = "context", template: str | None = None
) -> DataFrame:
    """Add ``prompt`` and ``error``: a blank question is an error, a context goes in front."""
    blank = F.col(question).isNull() | (tx.strip(F.col(question)) == "")
    has_context = F.coalesce(F.col(context), F.lit("")) != ""
    if template is not None:
        text = render(df, template)
    else:
        text = F.when(
            has_context,
            F.concat(F.lit("Context: "), F.col(context), F.lit("\n\nQuestion: "), F.col(question)),
        ).otherwise(F.col(question))
    return df.withColumns(
        {"prompt": F.when(~blank, text), "error": F.when(blank, F.lit(QUESTION_ERROR))}
    )
