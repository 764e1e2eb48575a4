"""What a Python worker holds: batches bounded in bytes, and few passes a task."""

import sys

import pytest
from pyspark.sql import functions as F

from quillmill import queries as core
from quillmill.functions import mask
from quillmill.functions.batches import bounded_batches
from quillmill.plans.jobs import judged
from quillmill.plans.translate import Lexicon, translate_all, translate_body, translate_short

KEY, MOST = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20
ROWS, CHARS = 500, 10_000


@pytest.fixture
def unbounded(spark):
    """The session without a bound of its own, as a user's is at first."""
    before = spark.conf.get(KEY)
    spark.conf.unset(KEY)
    yield spark
    spark.conf.set(KEY, before)


@pytest.fixture
def long_texts(unbounded):
    """5 MB in one partition, in fewer rows than Spark's own bound on a batch."""
    return unbounded.range(0, ROWS, 1, 1).select(F.concat(F.col("id").cast("string"), F.lit(" "), F.repeat(F.lit("zq "), CHARS // 3 + 1)).alias("t"))


def test_the_last_size_holds_but_not_over_a_sessions_own(unbounded):
    for size in (MOST, 8 << 20, MOST):
        bounded_batches(unbounded, size)
        assert unbounded.conf.get(KEY) == str(size)
    unbounded.conf.set(KEY, "3m")
    bounded_batches(unbounded)
    assert unbounded.conf.get(KEY) == "3m"


def sizes():
    """A translator of texts into the size of the batch that they came in; made here, so that it travels by value."""

    class Sizes:
        writes_names = True

        def translate(self, texts, task):
            return [str(sum(map(len, texts)))] * len(texts)

    return Sizes()


def test_a_translators_batches_are_bounded(long_texts):
    short = translate_short(long_texts, "t", "n", sizes()).agg(F.max(F.col("n").cast("long"))).first()[0]
    body = translate_body(long_texts, "t", "n", sizes()).agg(F.max(F.col("n").cast("long"))).first()[0]
    assert CHARS < short <= MOST + 2 * CHARS and CHARS < body <= MOST + 2 * CHARS


def test_a_job_has_two_python_passes(spark, sf_dir):
    plan = core.QUERIES["translate_verify_publish"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 2


def test_columns_translated_together_and_apart(spark):
    said = ["Asha Rao paid $5 million at 10.30 am. The stock market is in New Delhi. ", "", None, "**The** app", " \n"]
    rows = spark.createDataFrame([(i, a, b) for i, a in enumerate(said) for b in said], "i int, a string, b string")
    apart = translate_short(translate_body(translate_body(rows, "a", "x", Lexicon()), "b", "y", Lexicon()), "b", "z", Lexicon())
    at_once = translate_all(rows, Lexicon(), {"a": "x", "b": "y"}, {"b": "z"})
    assert at_once.columns == apart.columns and sorted(map(repr, at_once.collect())) == sorted(map(repr, apart.collect()))
    assert judged(rows.selectExpr("i as id", "a as title", "b as body"), Lexicon(), {}).count() == len(said) ** 2


def test_batches_of_masks_are_bounded(long_texts):
    def batch_size(text, start):
        return str(sum(map(len, sys._getframe(1).f_locals["texts"]))), []  # of the batch that the text came in

    made = mask._masked_in_python(mask.unmasked(F.col("t")), [batch_size])
    most = long_texts.select(made["text"].cast("long").alias("n")).agg(F.max("n")).first()[0]
    assert CHARS < most <= MOST + 2 * CHARS


@pytest.mark.parametrize("name", ["unmask", "mask_nouns", "mask_terms", "mask_all", "blob_roundtrip", "translate_verify_publish"])
def test_queries_with_a_python_pass_are_bounded(unbounded, sf_dir, name):
    core.QUERIES[name](unbounded, sf_dir)
    assert unbounded.conf.get(KEY) == str(MOST)
