"""The jobs: articles, timelines, entities, the vocabulary miner, reset, as plans over DataFrames and a Store.

Every job is one batch: it writes the rows of the batch, by key, the target's before the source's status, so a run
that is repeated after a failure gives the same tables, and no batch costs more for a larger table than its scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.gates import verify
from quillmill.functions.glossary import apply_glossary
from quillmill.functions.text import target_tokens, simple_sentences, strip, strip_bold, title_fallback, title_trim
from quillmill.functions.values import BATCH, MAX_ATTEMPTS, SAMPLE, SHARDS, TEST_BATCH, TOP
from quillmill.operators import mining, state
from quillmill.operators.nested import refresh
from quillmill.plans.translate import Translator, translate_all, translate_back, translate_short
from quillmill.sources.codec import deflate, inflate
from quillmill.sources.tables import SCHEMAS, Store, open_store


@dataclass
class Options:
    shard: int = 0
    shards: int = SHARDS
    batch: int = BATCH
    glossary: dict[str, str] = field(default_factory=dict)
    #: Where a batch's results lie while its tables are written; the target itself if it is a folder.
    scratch: str = ""

    def work(self, target: Store) -> Store:
        return open_store(target.spark, self.scratch) if self.scratch else target

    def __post_init__(self) -> None:
        if not 0 <= self.shard < self.shards:
            raise ValueError(f"shard {self.shard} is not below {self.shards}")

    @classmethod
    def test_run(cls, **more: object) -> Options:
        return cls(batch=TEST_BATCH, **more)


def judged(rows: DataFrame, translator: Translator, glossary: dict[str, str]) -> DataFrame:
    """rows (id, title, body) with body_hi, title_hi, gates and error; error is null for rows that may be published.

    A body that fails a gate, or is empty, fails the row; a title that fails is replaced by the body's beginning. The
    glossary is for translators that don't write names themselves. The back-translation is computed only for those.
    """
    out = translate_all(rows, translator, {"body": "body_raw"}, {"title": "title_raw"})
    back = None if translator.writes_names else translate_back(translator, F.col("body_raw"))
    if back is not None:
        out = out.withColumn("back", back)
        back = F.col("back")
    out = out.withColumn("gates", verify(F.col("body"), F.col("body_raw"), back, translator.writes_names))
    out = out.withColumn("title_gates", verify(F.coalesce("title", F.lit("")), F.col("title_raw"), back, translator.writes_names))
    title = F.when(F.col("title_gates.passed"), F.col("title_raw")).otherwise(title_fallback(F.col("body_raw")))
    body = F.col("body_raw")
    if not translator.writes_names:
        body, title = apply_glossary(body, glossary), apply_glossary(title, glossary)
    error = F.when(strip(F.col("body_raw")) == "", "empty body translation").when(~F.col("gates.passed"), F.concat(F.lit("body gate: "), F.to_json("gates")))
    return out.withColumn("body_hi", body).withColumn("title_hi", title_trim(title)).withColumn("error", error).drop("body_raw", "title_raw", "back")


def _counted(target: Store, bad: DataFrame, key: str, table: str) -> DataFrame:
    """The failures of these keys with one more attempt each; bad: the key and error."""
    known = target.read(table)
    known = known.join(F.broadcast(bad.select(key)), key, "left_semi")  # a batch's keys
    return state.count_failures(known, bad, key, [])


def articles(source: Store, target: Store, translator: Translator, options: Options) -> bool:
    """One batch of articles; whether there may be more. Only rows of the batch are written."""
    table = source.read("articles")
    rows = state.pending(table, "id", "translated_hi", options.shard, options.shards, options.batch, "rephrased_article")
    decoded = rows.select("*", F.col("rephrased_title").alias("title"), inflate(F.col("rephrased_article")).alias("blob"))
    decoded = decoded.select(*table.columns, "title", F.col("blob.text").alias("body"), F.col("blob.error").alias("broken"))
    done = judged(decoded, translator, options.glossary).withColumn("error", F.coalesce("broken", "error")).select(*table.columns, "title_hi", "body_hi", "error")
    # written once: translations are dear, and the next states must agree with each other
    work = options.work(target)
    work.write("_batch", done)
    done = work.read("_batch")
    good, bad = done.filter("error is null"), done.filter("error is not null")
    good_ids = good.select(F.col("id").alias("article_id"))
    new = good.select(F.col("id").alias("article_id"), deflate(F.col("body_hi")).alias("rephrased_article_hi"), F.col("title_hi").alias("rephrased_title_hi"), F.lit(1).alias("headline_verified_hi"))
    target.upsert("translations", new, ["article_id"])
    target.delete("translation_failures", good_ids, ["article_id"])
    work.write("_failed", _counted(target, bad.select(F.col("id").alias("article_id"), "error"), "article_id", "translation_failures"))
    counted = work.read("_failed")
    target.upsert("translation_failures", counted, ["article_id"])
    changed = state.quarantine(state.publish(done.select(*table.columns), good, "id", "translated_hi"), counted.withColumnRenamed("article_id", "id"), "id", "translated_hi")
    source.upsert("articles", changed.filter(F.col("translated_hi") != state.PENDING), ["id"])
    return bool(state.has_more(done, options.batch).first()[0])


def _short(rows: DataFrame, keys: list[str], text: str, translator: Translator, glossary: dict[str, str]) -> DataFrame:
    """keys, text_hi and error of short texts; error is null for those that pass the number and script gates."""
    out = translate_short(rows, text, "raw", translator)
    out = out.withColumn("gates", verify(F.coalesce(F.col(text), F.lit("")), F.col("raw")))
    error = F.when(~F.col("gates.passed"), F.concat(F.lit("gate: "), F.to_json("gates")))
    return out.select(*keys, apply_glossary(F.col("raw"), glossary).alias("text_hi"), error.alias("error"))


def pending_milestones(events: DataFrame, links: DataFrame, options: Options) -> DataFrame:
    """Milestones of pending events of a shard, in the order of their keys; the broadcast decision is left to the optimizer."""
    of = events.filter(F.col("translated_hi") == state.PENDING).select(F.col("id").alias("event_id"))
    mine = links.filter(state.in_shard(F.col("event_id"), options.shard, options.shards))
    return mine.join(of, "event_id").orderBy("event_id", "article_id").limit(options.batch)


def timelines(source: Store, target: Store, translator: Translator, options: Options) -> bool:
    """One batch of event titles and their milestones; whether there may be more.

    The batch's events, the largest ids first, bring at most a batch of their milestones that aren't done, so an event
    with many takes several batches. Failures are counted by event and milestone; a milestone that has failed
    MAX_ATTEMPTS times is given up, an event whose title has is quarantined. An event is published when its title is
    translated and each of its milestones is translated or given up, so none is stranded and none holds up the rest.
    """
    events, links = source.read("events"), source.read("event_articles")
    titles = state.pending(events, "id", "translated_hi", options.shard, options.shards, options.batch)
    work, keys = options.work(target), ["event_id", "article_id"]
    work.write("_titles", titles)
    titles = work.read("_titles")
    ids = F.broadcast(titles.select(F.col("id").alias("event_id")))  # a batch of them
    named = target.read("event_translations").join(ids, "event_id", "left_semi").select("event_id")
    failed = target.read("milestone_failures").join(ids, "event_id", "left_semi")
    settled = target.read("event_milestone_translations").join(ids, "event_id", "left_semi").select(*keys)
    settled = settled.union(failed.filter(F.col("attempts") >= MAX_ATTEMPTS).select(*keys))
    mine = links.join(ids, "event_id", "left_semi")
    stones = mine.join(settled, keys, "left_anti").orderBy(F.desc("event_id"), "article_id").limit(options.batch)
    fresh = titles.join(named.withColumnRenamed("event_id", "id"), "id", "left_anti")
    work.write("_said_titles", _short(fresh, ["id"], "title", translator, options.glossary))
    work.write("_said_stones", _short(stones, keys, "milestone", translator, options.glossary))
    said, said_stones = work.read("_said_titles"), work.read("_said_stones")
    new = said.filter("error is null").select(F.col("id").alias("event_id"), F.col("text_hi").alias("title_hi"))
    target.upsert("event_translations", new, ["event_id"])
    target.upsert("event_milestone_translations", said_stones.filter("error is null").select(*keys, F.col("text_hi").alias("milestone_hi")), keys)
    bad = said.filter("error is not null").select(F.col("id").alias("event_id"), "error")
    work.write("_failed_titles", _counted(target, bad, "event_id", "event_failures"))
    work.write("_failed_stones", _counted_stones(target, said_stones.filter("error is not null").select(*keys, "error")))
    target.upsert("event_failures", work.read("_failed_titles"), ["event_id"])
    target.upsert("milestone_failures", work.read("_failed_stones"), keys)
    gone = said_stones.filter("error is null").select(*keys)
    target.delete("milestone_failures", gone, keys)
    over = settled.union(gone).union(work.read("_failed_stones").filter(F.col("attempts") >= MAX_ATTEMPTS).select(*keys))
    waiting = mine.join(over, keys, "left_anti").select(F.col("event_id").alias("id")).distinct()
    titled = named.union(new.select("event_id")).select(F.col("event_id").alias("id"))
    finished = titled.join(waiting, "id", "left_anti")
    lost = work.read("_failed_titles").withColumnRenamed("event_id", "id")
    changed = state.quarantine(state.publish(titles, finished, "id", "translated_hi"), lost, "id", "translated_hi")
    work.write("_events", changed.filter(F.col("translated_hi") != state.PENDING))
    more = titles.count() >= options.batch or waiting.join(titled, "id", "left_semi").limit(1).count() > 0
    source.upsert("events", work.read("_events"), ["id"])
    return more


def _counted_stones(target: Store, bad: DataFrame) -> DataFrame:
    """The failures of these milestones with one more attempt each."""
    keys = ["event_id", "article_id"]
    known = target.read("milestone_failures").join(F.broadcast(bad.select(*keys)), keys, "left_semi")
    packed = [x.withColumn("key", F.struct(*keys)) for x in (known, bad)]
    return state.count_failures(*packed, "key", []).select("key.*", "attempts", "last_error")


def entities(library: DataFrame, translated: DataFrame, translate: Callable[[Column], Column]) -> DataFrame:
    """The translated library after a refresh."""
    return refresh(library, translated, translate)


def corpus_sample(articles_: DataFrame, key: str, text: str, most: int = SAMPLE) -> DataFrame:
    """The latest texts, without bold marks; rows without text are skipped."""
    return articles_.filter(F.col(text).isNotNull()).orderBy(F.desc(key)).limit(most).select(key, strip_bold(F.col(text)).alias("text"))


def mine(sample: DataFrame, text: str, translator: Translator, most: int = TOP) -> DataFrame:
    """Candidates for the glossary from translated sentences of a sample."""
    each = sample.select(F.explode(simple_sentences(F.col(text))).alias("sentence"))
    spoken = translate_short(each, "sentence", "spoken", translator)
    top = mining.top_tokens(spoken, "spoken", target_tokens, most)
    return mining.candidates(top, lambda token: translate_back(translator, token))


def reset(target: Store, sure: bool = False, source: Store | None = None) -> tuple[DataFrame, bool]:
    """Row counts before, and whether the tables were emptied: only if sure.

    With the source, its published and quarantined rows become pending again, so that they are translated anew.
    """
    tables = {n: target.read(n) for n in SCHEMAS if target.exists(n)}
    counts = state.row_counts(tables)
    counts = counts.sparkSession.createDataFrame(counts.collect(), counts.schema)  # a row a table, taken before the change
    if sure:
        for name, rows in state.truncated(tables, sure).items():
            target.write(name, rows)
        for name in ("articles", "events") if source else ():
            if source.exists(name):
                rows = source.read(name)
                again = F.when(F.col("translated_hi").isNull(), None).otherwise(state.PENDING)
                source.write(name, rows.withColumn("translated_hi", again.cast(rows.schema["translated_hi"].dataType)))
    return counts, sure
