"""Functions of pandas series whose Arrow batches are bounded in bytes, not only in rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


_KEY, _OURS = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.quillmill.batchBytes"


def bounded_batches(spark: SparkSession, size: int = 2 << 20) -> None:
    """Arrow batches of `size` bytes or one row at most from here on, unless the session has a bound of its own.

    A batch's buffers stand in the JVM and, copied, in its Python worker, doubled as they grow. The last size asked for
    holds, also for plans that were made before and run later.
    """
    if spark.conf.get(_KEY, "1") in ("1", spark.conf.get(_OURS, "1")):  # no one's bound, or one that was set here
        spark.conf.set(_KEY, str(size))
        spark.conf.set(_OURS, str(size))


def by_batches(run: Callable, kind: str) -> Callable[..., Column]:
    """A pandas function of columns. In the active session its batches are bounded: Spark's own bound is 10,000 rows of any length."""
    bounded_batches(SparkSession.active())
    return F.pandas_udf(run, kind)
