"""Merging of nested records: incidents appended by URL, and profiles refreshed from a newer library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields that a refresh takes from the newer profile, with a translation of the texts among them, and those it leaves alone.
VOLATILE, COUNTS = ("role", "party", "state"), ("criminal_cases", "criminal_cases_in_news")
STABLE = ("constituency",)
PLAIN = ("wikipedia", "affidavit_url", "image_placeholder")
INCIDENTS = ("controversies", "criminal_incidents")


def append_new(old: Column, new: Column, translate: Callable[[Column], Column] = lambda x: x) -> Column:
    """old with those incidents of new that have a URL which old lacks, their text translated.

    Incidents are structs with source_url and incident_text. Repeats within new are all appended; none of old goes.
    """
    seen = F.transform(F.coalesce(old, F.slice(new, 1, 0)), lambda c: F.coalesce(c["source_url"], F.lit("")))
    fresh = F.filter(F.coalesce(new, F.slice(old, 1, 0)), lambda c: (F.coalesce(c["source_url"], F.lit("")) != "") & ~F.array_contains(seen, F.coalesce(c["source_url"], F.lit(""))))
    added = F.transform(fresh, lambda c: c.withField("incident_text", translate(F.coalesce(c["incident_text"], F.lit("")))))
    return F.concat(F.coalesce(old, F.slice(new, 1, 0)), added)


def refresh(library: DataFrame, translated: DataFrame, translate: Callable[[Column], Column]) -> DataFrame:
    """The translated library brought up to date: the persons of library in its order.

    Known persons, found by (category, name), the last of repeats, take the volatile fields and new incidents and keep
    the rest; new ones are translated whole; those who are gone from library are dropped. A name is unique enough
    within a category that the join's keys are as spread as the persons.
    """
    text = lambda c, side="": F.coalesce(F.col(f"{side}{c}"), F.lit(""))
    fields = [c for c in translated.columns if c not in ("category", "name", "pos")]
    last = translated.groupBy("category", "name").agg(F.max_by(F.struct(*fields), "pos").alias("t"))
    both = library.join(last, ["category", "name"], "left")
    known = F.col("t").isNotNull()

    def kept(c: str, otherwise: Column) -> Column:
        return F.when(known, F.col(f"t.{c}")).otherwise(otherwise).alias(c)

    out: list[Column] = [F.col("category"), F.col("pos"), F.col("name"), kept("name_hi", translate(F.col("name")))]
    for c in VOLATILE:
        out += [text(c).alias(c), translate(text(c)).alias(f"{c}_hi")]
    for c in STABLE:
        out += [kept(c, text(c)), kept(f"{c}_hi", translate(text(c)))]
    out += [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in COUNTS]
    out += [kept(c, text(c)) for c in PLAIN]
    for c in INCIDENTS:
        whole = F.transform(F.col(c), lambda x: x.withField("incident_text", translate(F.coalesce(x["incident_text"], F.lit("")))))
        out.append(F.when(known, append_new(F.col(f"t.{c}"), F.col(c), translate)).otherwise(F.coalesce(whole, F.slice(F.col(c), 1, 0))).alias(c))
    return both.select(*out)
