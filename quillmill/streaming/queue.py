"""The work queue as a stream: newly pending rows are handled in batches until none is left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillmill.plans.jobs import Options, articles
from quillmill.plans.translate import Translator
from quillmill.sources.tables import Store


def drain(run: Callable[[], bool]) -> int:
    """Run a job until it says that there is no more; how often it ran. A job must settle or give up each row some time."""
    n = 1
    while run():
        n += 1
    return n


def work_queue(spark: SparkSession, folder: str, schema: str, checkpoint: str, source: Store, target: Store, translator: Translator, options: Options) -> StreamingQuery:
    """A stream over a folder of new articles: each micro-batch is added to the source's articles by key, then the queue is drained.

    A micro-batch that is run again replaces the same keys, so the stream may be restarted at any point.
    """
    def handle(rows: DataFrame, _: int) -> None:
        if not source.exists("articles"):
            source.write("articles", rows.limit(0))
        known = source.read("articles")
        # rows that are known keep their status
        source.upsert("articles", rows.dropDuplicates(["id"]).join(known.select("id"), "id", "left_anti").select(*known.columns), ["id"])
        drain(lambda: articles(source, target, translator, options))

    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
