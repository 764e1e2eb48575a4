"""State transitions: (target, source) -> new target, as plain DataFrames.

Spark's file tables have no MERGE, so a table's new state is computed and written to a new place; keys are unique in
what these functions return. Each is one shuffle on the key: rows of both sides are united and reduced with partial
aggregation instead of being joined, so a key with many rows costs one row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.values import ERROR_CHARS, MAX_ATTEMPTS, SHARDS

PENDING, PUBLISHED, QUARANTINED = 0, 1, 2


def in_shard(key: Column, shard: int, shards: int = SHARDS) -> Column:
    """The remainder has the sign of the key, so negative keys are in no shard but 0."""
    return key % shards == shard


def pending(table: DataFrame, key: str, status: str, shard: int, shards: int, batch: int, *needed: str) -> DataFrame:
    """The next batch of a shard: pending rows with the needed columns, the largest keys first. A null status isn't pending."""
    rows = table.filter((F.col(status) == PENDING) & in_shard(F.col(key), shard, shards))
    for c in needed:
        rows = rows.filter(F.col(c).isNotNull())
    return rows.orderBy(F.desc(key)).limit(batch)


def pending_by_sql(table: DataFrame, key: str, status: str, shard: int, shards: int, batch: int) -> DataFrame:
    """pending() as a statement with positional parameters."""
    sql = f"SELECT * FROM {{table}} WHERE {status} = ? AND {key} % ? = ? ORDER BY {key} DESC LIMIT ?"
    return table.sparkSession.sql(sql, args=[PENDING, shards, shard, batch], table=table)


def has_more(rows: DataFrame, batch: int) -> DataFrame:
    return rows.agg((F.count("*") >= batch).alias("has_more"))


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, without the order columns."""
    values = [c for c in rows.columns if c not in keys and c not in order]
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])


def replace_by_key(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """target with the rows of source in place of its own of the same keys; of several in source the last by order."""
    values = [c for c in target.columns if c not in keys]
    marked = target.select(*keys, F.lit(0).alias("_new"), *[F.lit(None).cast(source.schema[c].dataType).alias(f"_{c}") for c in order], *values)
    fresh = source.select(*keys, F.lit(1).alias("_new"), *[F.col(c).alias(f"_{c}") for c in order], *values)
    return latest(marked.union(fresh), keys, ["_new", *[f"_{c}" for c in order]]).select(*target.columns)


def count_failures(target: DataFrame, failures: DataFrame, key: str, order: list[str]) -> DataFrame:
    """target (key, attempts, last_error) with one more attempt for each row of failures (key, error, *order); the last error is kept."""
    old = target.select(key, F.col("attempts").cast("long").alias("n"), F.col("last_error").alias("e"), F.lit(0).alias("_new"), *[F.lit(None).cast(failures.schema[c].dataType).alias(c) for c in order])
    new = failures.select(key, F.lit(1).cast("long").alias("n"), F.left(F.col("error"), F.lit(ERROR_CHARS)).alias("e"), F.lit(1).alias("_new"), *order)
    last = F.max_by(F.struct("e"), F.struct("_new", *order))["e"].alias("last_error")
    return old.unionByName(new).groupBy(key).agg(F.sum("n").alias("attempts"), last)


def clear(target: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """target without the keys of done."""
    return target.join(done.select(key).distinct(), key, "left_anti")


def quarantine(table: DataFrame, failures: DataFrame, key: str, status: str, most: int = MAX_ATTEMPTS) -> DataFrame:
    """table with status QUARANTINED for keys with that many attempts."""
    return _marked(table, failures.filter(F.col("attempts") >= most).select(key), key, status, QUARANTINED)


def publish(table: DataFrame, done: DataFrame, key: str, status: str) -> DataFrame:
    """table with status PUBLISHED for the keys of done."""
    return _marked(table, done.select(key), key, status, PUBLISHED)


def _marked(table: DataFrame, keys: DataFrame, key: str, status: str, value: int) -> DataFrame:
    marks = keys.distinct().withColumn("_mark", F.lit(value))
    out = table.join(marks, key, "left")
    return out.withColumn(status, F.coalesce(F.col("_mark"), F.col(status)).cast(table.schema[status].dataType)).select(*table.columns)


def truncated(tables: dict[str, DataFrame], sure: bool = False) -> dict[str, DataFrame]:
    """The tables without rows if sure; as they are otherwise (a dry run)."""
    return {name: df.filter(F.lit(False)) if sure else df for name, df in tables.items()}


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, n for each table, and their total."""
    each = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        each = one if each is None else each.union(one)
    return each.union(each.agg(F.sum("n").alias("n")).select(F.lit("total").alias("table_name"), "n"))
