"""Glossary substitution and the loan-word heuristic of the vocabulary miner."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.text import filled, strip
from quillmill.functions.values import DEVANAGARI, LOAN_HINTS, LOAN_SEED, ROMAN


def ordered(glossary: dict[str, str]) -> list[tuple[str, str]]:
    """Its pairs, the longest key first, equal lengths as they stand."""
    return sorted(glossary.items(), key=lambda pair: -len(pair[0]))


def apply_glossary(text: Column, glossary: dict[str, str]) -> Column:
    """Terms that no Devanagari sign touches are replaced; blanks and tabs become one blank; white space at the ends goes.

    The danda is in the block, so a term right before it stays. Replacements are taken as they are.
    """
    out = filled(text)
    for term, latin in ordered(glossary):
        quoted = latin.replace("\\", "\\\\").replace("$", "\\$")
        out = F.regexp_replace(out, rf"(?<![{DEVANAGARI}])\Q{term}\E(?![{DEVANAGARI}])", quoted)
    return strip(F.regexp_replace(out, "[ \\t]+", " "))


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def consonants(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z]", "")


def skeleton(token: Column) -> Column:
    """The Latin consonants of a Devanagari token, by code point."""
    letters = F.transform(F.split(token, ""), lambda c: F.coalesce(F.try_element_at(_map(ROMAN), c), F.lit("")))
    return consonants(F.array_join(letters, ""))


def sounds_alike(token: Column, gloss: Column) -> Column:
    """Whether six tenths of the shorter one's consonants are among the other's; false if it has fewer than two."""
    a, b = skeleton(token), consonants(F.regexp_replace(F.lower(strip(filled(gloss))), "[aeiou]", ""))
    short, long = F.when(F.length(b) < F.length(a), b).otherwise(a), F.when(F.length(b) < F.length(a), a).otherwise(b)
    hits = F.size(F.filter(F.split(short, ""), lambda c: (c != "") & long.contains(c)))
    return (F.length(short) >= 2) & (hits / F.nullif(F.length(short), F.lit(0)) >= 0.6)


def looks_loan(token: Column, gloss: Column) -> Column:
    return token.isin(*LOAN_SEED) | token.rlike(LOAN_HINTS) | F.coalesce(sounds_alike(token, gloss), F.lit(False))


def suggested_latin(token: Column, gloss: Column) -> Column:
    return F.coalesce(F.try_element_at(_map(LOAN_SEED), token), F.when(looks_loan(token, gloss), F.lower(strip(filled(gloss)))), F.lit(""))
