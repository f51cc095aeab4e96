"""Documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; all but the last
return the columns of ``documents``. Between stages the rows are written as Parquet to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunewright.llm import decontaminate, langid, packing, simhash
from tunewright.session import scratch_path, ship_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without texts that have no letters or are in none of the labelled languages."""
    ship_package(spark)
    return langid.known(docs, langid.learn(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (SimHash of three-word shingles, at most 3 bits apart):
    that with the smallest id.
    """
    ship_package(spark)
    return simhash.dedup(docs, shingle=3, distance=3)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    ship_package(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, items)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids and places in training sequences."""
    ship_package(spark)
    import public_tokenizers

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(docs.select("doc_id", "text"), path, keep=["doc_id"])


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("sequences", sequences),
]

#: No stage is within SQL: filters of n-grams, XXH64 over shingles, a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
