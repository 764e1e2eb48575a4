"""The queries of this subpackage by name, and SQL for those that SQL can express.

A query applies its operator with production parameters to its whole table; the columns it returns are the
operator's own, or digests of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm import fingerprints, jaccard, licences, mixing, pii, quality, repeats, revisits, tokens, toxicity
from quillmill.llm.base import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.pack(table(spark, sf_dir, "documents"), tokens.public_encoding)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_next(table(spark, sf_dir, "documents"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op10_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.resolved_pages(table(spark, sf_dir, "pages"))


def licence_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence scan over published texts in many forms; the test tables have no whole licences."""
    return licences.scanned_variants(spark)


_ALL = (op1_packing, op2_mixing, op3_quality, op4_fingerprints, op5_licences, op6_personal_data, op7_toxicity, op8_jaccard_join, op9_suffix_repeats, op10_revisits, licence_variants)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
ORACLES: dict[str, str] = {"op2_mixing": mixing.plan_sql(), "op5_licences": licences.scan_sql(), "op10_revisits": revisits.RESOLVED_SQL, "licence_variants": licences.variants_sql()}
