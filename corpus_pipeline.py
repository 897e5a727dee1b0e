"""A training corpus from ``documents``: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the ``docs`` of the next one. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtally.llm import line_quality, mixing, near_dedup, packing, suffix_dedup
from jobtally.llm.queries import tokenizer_path
from jobtally.session import scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, without their failing lines."""
    return line_quality.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id; five-word shingles, similarity 0.8."""
    return near_dedup.one_of_each(docs)


def suffix_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings that an earlier text has; texts of which nothing is left go."""
    return suffix_dedup.deduplicated(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it (not at all, once or twice)."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens, with their ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("suffix_repeats", suffix_repeats),
    ("source_mix", source_mix),
    ("sequences", sequences),
]

#: suffix sorting and the tokenizer have no SQL; the tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
