"""Mixing sources to target weights.

Tokens are summed by source, each source gets a target, the repetition rate is target over size, and a document
is emitted floor(rate) times plus one hash-seeded Bernoulli copy with the fraction as its probability.

Everything is built-in Spark expressions. Sums by source are partial sums before their shuffle, so a source with
a third of all rows costs one row a task; documents meet their source's rate by a broadcast of a counted size, or
beyond it by a join on (source, salt).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm.base import checkpoint, small_enough

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Seeds tried for a source's Bernoulli draws; the one whose total comes nearest the target is used.
SEEDS = 64
PRIME = (1 << 31) - 1
#: Each seed's factor: the powers of a primitive root.
FACTORS = [pow(48271, k + 1, PRIME) for k in range(SEEDS)]
_SALTS = 64


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """sources with rank, 0 for the first source by code point, null last; no task sees all of them."""
    parts = checkpoint(sources.orderBy(F.asc_nulls_last("source"))).withColumn("part", F.spark_partition_id())
    # one row a partition: as many as there are shuffle partitions at most
    counts = parts.groupBy("part").count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy(F.asc_nulls_last("source"))
    ranked = parts.join(F.broadcast(offsets), "part").withColumn("rank", F.col("before") + F.row_number().over(within) - 1)
    return ranked.drop("part", "before")


def targets(sources: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """source, source_size, n -> these, target.

    Targets share all sizes by weight; those above `most` times their source's size stop there and the excess is
    shared by weight again until none is above. The fixed point is min(most * size, level * weight) with one level
    for all; the loop finds it from sums over the sources and never collects them.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = checkpoint(_ranked(sources).withColumn("weight", weight))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        over = F.lit(most) * F.col("source_size") <= F.lit(level) * F.col("weight")
        held, rest, count = ranked.agg(
            F.sum(F.when(over, F.lit(most) * F.col("source_size"))), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)
        ).first()
        if count == stopped or not rest:
            break
        level, stopped = (total - (held or 0.0)) / rest, count
    return ranked.withColumn("target", F.least(F.lit(most) * F.col("source_size"), F.lit(level) * F.col("weight"))).drop("weight", "rank")


def _draw(factor: Column | int) -> Column:
    """A number in [0, 1) from the row's key and a seed's factor: multiplication modulo a prime shuffles the keys anew."""
    factor = factor if isinstance(factor, Column) else F.lit(factor)
    return (F.col("key") * factor.cast("long") % F.lit(PRIME)) / F.lit(float(PRIME))


def _with_sources(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """docs joined to their source's row, null source to null."""
    if small_enough(sources, 512):
        other = F.broadcast(sources.withColumnRenamed("source", "_source"))
        return docs.join(other, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    salted = docs.withColumn("_salt", F.pmod("key", F.lit(_SALTS)))
    other = sources.withColumnRenamed("source", "_source").withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return salted.join(other, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_salt") == F.col("_other"))).drop("_source", "_salt", "_other")


def _keyed(docs: DataFrame, doc_id: str, text: str, source: str) -> list[Column]:
    """source, size, and key: a number below PRIME from a digest of the id, the text and the source."""
    digest = F.md5(F.concat_ws("|", F.col(doc_id).cast("string"), F.coalesce(F.col(text), F.lit("")), F.col(source)).cast("binary"))
    key = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(PRIME)
    return [F.col(source).alias("source"), n_words(text).alias("size"), key.alias("key")]


def _rates(slim: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """source, source_size, target, rate, base (its floor), fraction and seed for each source."""
    rates = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    rates = rates.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    rates = checkpoint(rates.withColumn("base", F.floor("rate")).withColumn("fraction", F.col("rate") - F.floor("rate")))
    # the extra copies' words under every seed, in one pass of partial sums; then the seed that comes nearest
    extra = [F.sum(F.when(_draw(FACTORS[k]) < F.col("fraction"), F.col("size")).otherwise(0)).alias(f"s{k}") for k in range(SEEDS)]
    drawn = _with_sources(slim, rates).groupBy("source").agg(F.first(F.col("fraction") * F.col("source_size")).alias("goal"), *extra)
    offs = F.array(*[F.struct(F.abs(F.col(f"s{k}") - F.col("goal")).alias("off"), F.lit(k).alias("k"), F.lit(FACTORS[k]).alias("seed")) for k in range(SEEDS)])
    seeds = drawn.select(F.col("source").alias("_seeded"), F.array_min(offs)["seed"].alias("seed"))
    return checkpoint(rates.join(seeds, F.col("source").eqNullSafe(F.col("_seeded"))).drop("_seeded"))


def _copies() -> Column:
    return (F.col("base") + F.when(_draw(F.col("seed")) < F.col("fraction"), 1).otherwise(0)).cast("int")


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row for each row of docs: doc_id, size, source_size, target, rate, copies, taken.

    Sizes are words, 0 for null or empty text. A null source is a source of its own, the last. A source of size 0
    has the rate 0. Repeated rows are rows of their own and share one draw. An empty table gives an empty plan.
    Very long texts count whole. Reruns agree: draws are hashes of (doc_id, text, source, seed). As the seed is the one
    of several whose total comes nearest the target, a copy's probability is only about the fraction. Other columns of docs aren't read.
    """
    slim = checkpoint(docs.select(F.col(doc_id).alias("doc_id"), *_keyed(docs, doc_id, text, source)))  # numbers: the texts are read once
    out = _with_sources(slim, _rates(slim.drop("doc_id"), weights, most)).withColumn("copies", _copies())
    return out.select("doc_id", "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """docs with each row as often as mix_plan says, all its columns as they are; rows without copies are absent.

    Nulls, empty texts, repeated rows and empty tables as in mix_plan; very long texts are rows like others.
    """
    rates = _rates(checkpoint(docs.select(*_keyed(docs, doc_id, text, source))), weights, most)
    whole = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), *_keyed(docs, doc_id, text, source))
    out = _with_sources(whole, rates).withColumn("copies", _copies()).filter("copies > 0")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def plan_sql(weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> str:
    """mix_plan() of documents in DuckDB's SQL; the level is found from sums in the order of size by weight."""
    factors = ", ".join(f"({k}, {c})" for k, c in enumerate(FACTORS))
    return rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  ('0x' || substr(md5(concat_ws('|', doc_id::VARCHAR, coalesce(text, ''), source)), 1, 15))::BIGINT % {PRIME} AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, ([{", ".join(f"{float(x)}::DOUBLE" for x in weights)}])[rank % {len(weights)} + 1] AS weight, {most}::DOUBLE * source_size AS stop FROM s),
o AS (SELECT *, stop / weight AS turn, (SELECT sum(size) FROM d)::DOUBLE - coalesce(sum(stop) OVER before, 0) AS rest, sum(weight) OVER after AS share FROM w
  WINDOW before AS (ORDER BY stop / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), after AS (ORDER BY stop / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT coalesce(arg_min(rest / share, turn), 1e300) AS level FROM o WHERE turn > rest / share),
t AS (SELECT source, source_size, least(stop, level * weight) AS target FROM o, l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS base FROM t),
f(k, factor) AS (VALUES {factors}),
x AS (SELECT r.source, k, factor, abs(sum(CASE WHEN (key * factor % {PRIME}) / {float(PRIME)}::DOUBLE < rate - base THEN size ELSE 0 END)::DOUBLE - any_value((rate - base) * source_size)) AS off
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source CROSS JOIN f GROUP BY ALL),
b AS (SELECT source, arg_min(factor, (off, k)) AS factor FROM x GROUP BY source),
c AS (SELECT d.doc_id, d.size, r.source_size, r.target, r.rate, (base + CASE WHEN (key * factor % {PRIME}) / {float(PRIME)}::DOUBLE < rate - base THEN 1 ELSE 0 END)::INT AS copies
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, size * copies AS taken, rate, copies FROM c"""
