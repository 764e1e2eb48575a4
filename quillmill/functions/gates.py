"""Gates: what a translation must pass. Each gives a struct with its verdict and its reasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.text import filled, foreign_letters, names, numbers


def number_gate(source: Column, target: Column) -> Column:
    """number_ok if no number of the source is missing; extra numbers are told but tolerated."""
    want, got = numbers(source), numbers(target)
    missing = F.array_except(want, got)
    return F.struct((F.size(missing) == 0).alias("number_ok"), missing.alias("numbers_missing"), F.array_except(got, want).alias("numbers_extra"))


def script_gate(target: Column) -> Column:
    bad = foreign_letters(target)
    return F.struct((bad == "").alias("script_ok"), bad.alias("bad_chars"))


def entity_gate(source: Column, target: Column, back: Column | None = None, off: bool = True) -> Column:
    """entity_ok if a quarter of the source's names, or one, at most, is in neither the target nor its back-translation.

    With off, as for models that write names in the target's script, it passes without reading back, so the
    back-translation is pruned from the plan.
    """
    if off:
        return F.struct(F.lit(True).alias("entity_ok"), F.array().cast("array<string>").alias("entities_missing"))
    found = names(source)
    hay = F.lower(F.concat_ws(" ", filled(target), filled(back if back is not None else F.lit(""))))
    missing = F.filter(found, lambda x: ~hay.contains(F.lower(x)))
    allowed = F.greatest(F.lit(1), F.floor(F.size(found) / 4))
    return F.struct((F.size(missing) <= allowed).alias("entity_ok"), missing.alias("entities_missing"))


def verify(source: Column, target: Column, back: Column | None = None, off: bool = True) -> Column:
    """passed, and all gates' fields."""
    gates = [number_gate(source, target), script_gate(target), entity_gate(source, target, back, off)]
    fields = [["number_ok", "numbers_missing", "numbers_extra"], ["script_ok", "bad_chars"], ["entity_ok", "entities_missing"]]
    passed = gates[0]["number_ok"] & gates[1]["script_ok"] & gates[2]["entity_ok"]
    return F.struct(passed.alias("passed"), *[g[f].alias(f) for g, fs in zip(gates, fields, strict=True) for f in fs])
