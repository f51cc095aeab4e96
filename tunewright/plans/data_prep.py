"""Load, sample, clean, split and format: a lazy plan over one stored table, if any."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tunewright.functions.embed import EmbedderFactory
from tunewright.operators import clean as cl
from tunewright.operators import prompt as pr
from tunewright.operators import sample as sm
from tunewright.operators import split as sp
from tunewright.operators import templates
from tunewright.session import store
from tunewright.sources import tables
from tunewright.specs import DataSpec, PromptSpec


def prompt_spec(spec: DataSpec) -> PromptSpec:
    """A known model's template replaces the configured one, unless that is switched off."""
    found = templates.for_model(spec.model_name) if spec.use_model_template else None
    return replace(spec.prompt, template=found[0]) if found else spec.prompt


def prepare(
    df: DataFrame, spec: DataSpec, embedder: EmbedderFactory | None = None,
    keep: bool | None = None, folder: str | None = None,
) -> DataFrame:
    """Sample, clean, split and format; the result has ``split`` and the prompt column.

    The split (and a sample after cleaning) reads the cleaned keys to place its cuts. ``keep``
    writes the cleaned table to the shared folder first, so that those passes read one column of
    it, at once; by default this is done where cleaning removes duplicates, which would otherwise
    be shuffled for every pass. ``folder`` names another place for the table. It is read by the
    result and left there: remove it when the result is written.
    """
    if not spec.sample_after_clean:
        df = sm.downsample(df, spec.sample, spec.key, embedder)
    df = cl.clean(df, spec.clean, spec.key)
    if spec.clean.drop_duplicates if keep is None else keep:
        df = store(df, "cleaned", folder)
    if spec.sample_after_clean:
        df = sm.downsample(df, spec.sample, spec.key, embedder)
    return pr.format_prompts(sp.split(df, spec.split_spec, spec.key), prompt_spec(spec))


def run(
    spark: SparkSession, spec: DataSpec, embedder: EmbedderFactory | None = None,
    keep: bool | None = None, folder: str | None = None,
) -> DataFrame:
    df = tables.load(spark, spec.path, spec.fmt, spec.split, spec.split_column)
    return prepare(df, spec, embedder, keep, folder)
