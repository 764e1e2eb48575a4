"""A corpus pipeline of five stages; each stage's rows are written and read again as the next one's documents.

Every stage takes nulls in any column, empty and very long texts, repeated rows, empty tables and further columns, and
returns the columns that it got, but for the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm import jaccard, mixing, pii, quality, tokens
from quillmill.llm.base import stage_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts go, as they have under 20 words; repeated rows are judged alike."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Rows without an id or without words stay, and so do repeated rows of an id that stays."""
    return jaccard.one_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data and credentials replaced by their kind; n_chars is counted again. Null texts stay null."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks. A null source is one of its own; texts without words have no weight, but a rate like their source's others."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents packed into sequences. A null or empty text is its end mark only; repeated rows are packed each."""
    return tokens.pack(docs, tokens.public_encoding)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", near_duplicates),
    ("personal data", redact),
    ("mixing sources", mix_sources),
    ("packing", pack),
]
#: No SQL gives these rows: language models, similarity groups and packing are in them. tests/llm holds the stages to rules written out again.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir; those of the other stages stay in the shared folder, as the result is computed from them."""
    docs = table(spark, sf_dir, "documents")
    folder = stage_folder(spark)
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
