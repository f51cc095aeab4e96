"""String expressions. All of them stay in Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that count as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def string_columns(df: DataFrame, columns=None) -> list[str]:
    """String columns among ``columns`` (default: all), in schema order of ``columns``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns) if columns else df.columns
    return [c for c in names if isinstance(types[c], T.StringType)]


def shown(df: DataFrame, name: str) -> Column:
    """A column as it appears in a prompt: null is ``None``, booleans are ``True``/``False``."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.BooleanType):
        text = F.when(c, "True").when(~c, "False")
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("None"))


def build_text(df: DataFrame, columns) -> Column:
    """The columns as one text, with single spaces between them."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no column {missing[0]!r} to build a text from")
    return F.concat_ws(" ", *[shown(df, c) for c in columns])


def default_text_columns(df: DataFrame, explicit=None) -> list[str]:
    if explicit:
        return list(explicit)
    if {"instruction", "input"} <= set(df.columns):
        return ["instruction", "input"]
    strings = string_columns(df)
    if not strings:
        raise ValueError("nothing to embed: name text columns, or have string columns")
    return strings[:1]


def split_words(c: Column, separator: str) -> Column:
    return F.array_remove(F.split(c, separator), "")


def score_tokens(c: Column) -> Column:
    """Tokens of the ROUGE family: lower case runs of ASCII letters and digits."""
    return split_words(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+")


def words(c: Column) -> Column:
    """Lower case runs of letters and digits of any script."""
    return split_words(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+")


def truthy(df: DataFrame, name: str) -> Column:
    """Python truth of a column; null counts as false."""
    c = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        test = c
    elif isinstance(kind, T.StringType):
        test = c != ""
    elif isinstance(kind, T.NumericType):
        test = c != 0
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        test = F.size(c) > 0
    else:
        test = c.isNotNull()
    return F.coalesce(test, F.lit(False))


def preview(c: Column, limit: int) -> Column:
    text = F.coalesce(c, F.lit(""))
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))
    ).otherwise(text)
