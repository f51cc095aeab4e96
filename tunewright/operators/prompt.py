"""Templates to text columns. A template is read once, on the driver, and becomes one ``concat``."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunewright.functions import text as tx
from tunewright.specs import PromptSpec


def _piece(df: DataFrame, column: str, spec: str) -> Column:
    if not spec:
        return tx.shown(df, column)
    c = F.col(f"`{column}`")
    kind = df.schema[column].dataType
    if spec == "s" and isinstance(kind, T.StringType):
        return tx.shown(df, column)
    if spec == "d" and isinstance(kind, T.IntegralType):
        return c.cast("string")
    digits = spec[1:-1]
    if spec[0] == "." and spec[-1] == "f" and digits.isdigit() and isinstance(kind, T.NumericType):
        return F.format_string(f"%.{int(digits)}f", c.cast("double"))
    raise ValueError(f"format {spec!r} is not supported for column {column!r}")


def render(df: DataFrame, template: str, aliases: dict[str, str] | None = None) -> Column:
    """The template as an expression over the columns of ``df``. Null shows as ``None``."""
    names = {c: c for c in df.columns}
    for alias, column in (aliases or {}).items():
        if column not in df.columns:
            raise KeyError(f"column {column!r} not found. Available keys: {sorted(df.columns)}")
        names[alias] = column
    out = []
    for literal, field, spec, conversion in string.Formatter().parse(template):
        if literal:
            out.append(F.lit(literal))
        if field is None:
            continue
        if conversion or field not in names:
            raise KeyError(
                f"the template asks for {field!r}; the row has {', '.join(sorted(names))}"
            )
        out.append(_piece(df, names[field], spec))
    return F.concat(*out) if out else F.lit("")


def with_system(text: Column, system_prompt: str | None) -> Column:
    if not system_prompt:
        return text
    return F.concat(F.lit(system_prompt.strip() + "\n\n"), text)


def format_prompts(df: DataFrame, spec: PromptSpec = PromptSpec()) -> DataFrame:
    text = render(df, spec.template, spec.aliases)
    return df.withColumn(spec.output_column, with_system(text, spec.system_prompt))


def strip_prompt(output: Column, prompt: Column) -> Column:
    """Remove an echoed prompt from the front of an output, then outer white space."""
    rest = F.when(
        F.startswith(output, prompt), output.substr(F.length(prompt) + 1, F.length(output))
    ).otherwise(output)
    return tx.strip(rest)
