"""Prompt templates by model name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunewright.specs import FULL_TEMPLATE, INPUT_TEMPLATE

# The known models, in the order in which a name is compared with them. All of them
# use the same two templates.
KNOWN_MODELS = (
    "HuggingFaceTB/SmolLM2-135M",
    "HuggingFaceTB/SmolLM2-360M",
    "SmolLM2",
    "sshleifer/tiny-gpt2",
    "gpt2",
)
FAMILY_MARKS = (("SmolLM", "SmolLM2", False), ("gpt2", "gpt2", True))


def template_key(name: Column) -> Column:
    """The known model a name stands for, or null: equal, else containing, else by family."""
    tests = [(name == k, k) for k in KNOWN_MODELS]
    tests += [
        (F.contains(name, F.lit(k)) | F.endswith(name, F.lit(k.split("/")[-1])), k)
        for k in KNOWN_MODELS
    ]
    tests += [
        (F.contains(F.lower(name) if any_case else name, F.lit(mark)), k)
        for mark, k, any_case in FAMILY_MARKS
    ]
    first, *rest = tests
    return reduce(lambda acc, t: acc.when(*t), rest, F.when(*first))


def resolve(df: DataFrame, column: str = "model_name") -> DataFrame:
    """Add the template key and both templates; null for unknown or empty names."""
    key = template_key(F.col(column))
    known = F.col("template_key").isNotNull()
    return df.withColumn("template_key", key).withColumns(
        {
            "formatting_template": F.when(known, F.lit(FULL_TEMPLATE)),
            "eval_input_template": F.when(known, F.lit(INPUT_TEMPLATE)),
        }
    )


def for_model(name: str | None) -> tuple[str, str] | None:
    """The same lookup for one configured name, at plan time."""
    if not name:
        return None
    known = any(name == k or k in name or name.endswith(k.split("/")[-1]) for k in KNOWN_MODELS)
    known |= any(m in (name.lower() if any_case else name) for m, _, any_case in FAMILY_MARKS)
    return (FULL_TEMPLATE, INPUT_TEMPLATE) if known else None
