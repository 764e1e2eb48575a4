"""Text functions as column expressions. A null text counts as empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.values import CAPITAL_STOP_WORDS, DEVANAGARI, EDGE, TARGET_STOP_WORDS, NAME, NUMBER, TITLE_CHARS, WS, WS_CHARS


def filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(text, F.lit(WS_CHARS))


def strip_bold(text: Column) -> Column:
    return F.replace(filled(text), F.lit("**"), F.lit(""))


def _parts(text: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(text, pattern), strip), lambda x: x != "")


def sentences(text: Column) -> Column:
    """Sentences: cut at white space after .!? before a capital, digit, quote or bracket."""
    plain = F.replace(filled(text), F.lit("’"), F.lit("'"))
    return _parts(F.replace(strip(plain), F.lit("**"), F.lit("")), rf"(?<=[.!?])[{WS}]+(?=[A-Z0-9\"'(])")


def simple_sentences(text: Column) -> Column:
    """Sentences of the vocabulary miner: cut at any white space after .!?"""
    return _parts(filled(text), rf"(?<=[.!?])[{WS}]+")


def sorted_set(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))


def numbers(text: Column) -> Column:
    """The distinct numbers, sorted as text: commas dropped, zeros at the end of a fraction dropped."""
    found = F.regexp_extract_all(filled(text), F.lit(NUMBER), F.lit(0))
    plain = F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")))
    short = F.transform(plain, lambda x: F.when(x.contains("."), F.regexp_replace(F.regexp_replace(x, "0+$", ""), "[.]+$", "")).otherwise(x))
    return sorted_set(F.filter(short, lambda x: x != ""))


def names(text: Column) -> Column:
    """The distinct capitalised words of three or more characters that aren't stop-words, sorted."""
    found = F.regexp_extract_all(filled(text), F.lit(f"{EDGE}{NAME}{EDGE}"), F.lit(0))
    return sorted_set(F.filter(found, lambda x: (F.length(x) > 2) & ~x.isin(*CAPITAL_STOP_WORDS)))


def foreign_letters(text: Column) -> Column:
    """The distinct letters that are neither Devanagari nor below U+0250, sorted, as one text."""
    found = F.regexp_extract_all(filled(text), F.lit(rf"[\p{{L}}&&[^\x{{0000}}-\x{{024F}}{DEVANAGARI}]]"), F.lit(0))
    return F.array_join(sorted_set(found), "")


def title_fallback(body: Column, chars: int = TITLE_CHARS) -> Column:
    """What stands before the first danda, or else the first characters."""
    return F.coalesce(F.nullif(strip(F.split_part(filled(body), F.lit("।"), F.lit(1))), F.lit("")), F.left(filled(body), F.lit(chars)))


def title_trim(title: Column) -> Column:
    """Without quotes, dandas and blanks at both ends, then without white space."""
    return strip(F.btrim(filled(title), F.lit("\"'। ")))


def quote_strip(text: Column) -> Column:
    """Without one quote at each end."""
    return F.regexp_replace(filled(text), "^[\"']|[\"']$", "")


def shorten(text: Column, chars: int) -> Column:
    return F.left(text, F.lit(chars))


def target_tokens(text: Column) -> Column:
    """Runs of the Devanagari block, dandas and digits included."""
    return F.regexp_extract_all(filled(text), F.lit(f"[{DEVANAGARI}]+"), F.lit(0))


def letter_tokens(text: Column) -> Column:
    return F.regexp_extract_all(filled(text), F.lit(r"\p{L}+"), F.lit(0))


def countable(token: Column) -> Column:
    return (F.length(token) >= 3) & ~token.isin(*TARGET_STOP_WORDS)
