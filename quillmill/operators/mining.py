"""The vocabulary miner: tokens by frequency, and a reviewable report."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.glossary import looks_loan, suggested_latin
from quillmill.functions.text import countable
from quillmill.functions.values import TOP


def top_tokens(texts: DataFrame, text: str, tokens: Callable[[Column], Column], most: int = TOP) -> DataFrame:
    """token, n: the most frequent countable tokens, ties by the token. Counts are partial before their shuffle."""
    each = texts.select(F.explode(tokens(F.col(text))).alias("token")).filter(countable(F.col("token")))
    return each.groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(most)


def ranked(top: DataFrame) -> DataFrame:
    """A top list with its ranks; it is as long as its limit, so one task may order it."""
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "token")))


def candidates(top: DataFrame, gloss: Callable[[Column], Column]) -> DataFrame:
    """token, n, gloss, suggest_latin, flag for a top list."""
    glossed = top.withColumn("gloss", gloss(F.col("token")))
    return glossed.select("token", "n", "gloss", suggested_latin(F.col("token"), F.col("gloss")).alias("suggest_latin"), looks_loan(F.col("token"), F.col("gloss")).alias("flag"))


def listed(rows: DataFrame) -> list[dict[str, Any]]:
    """Candidates by rank, as a JSON document's list; it is as long as its limit."""
    found = ranked(rows).orderBy("rank").select("token", F.col("n").alias("freq"), "gloss", "suggest_latin", "flag").collect()
    return [r.asDict() for r in found]


def report_line(rank: Column, n: Column, token: Column, gloss: Column, latin: Column, flag: Column) -> Column:
    return F.concat(F.lit("| "), rank.cast("string"), F.lit(" | "), n.cast("string"), F.lit(" | "), token, F.lit(" | "), gloss, F.lit(" | "), latin, F.lit(" | "), F.when(flag, "✅").otherwise(""), F.lit(" |"))


def report(rows: DataFrame, sampled: int) -> str:
    """The report of ranked candidates as Markdown; the list is as long as its limit."""
    head = [f"# Words for the glossary, from {sampled} texts", "", "| rank | times | word | meaning | spelling | loan |", "|-|-|-|-|-|-|"]
    line = report_line(*(F.col(c) for c in ("rank", "n", "token", "gloss", "suggest_latin", "flag")))
    return "\n".join(head + [r[0] for r in ranked(rows).orderBy("rank").select(line).collect()])
