"""Masking of protected spans by placeholders, and back.

A mask is a struct of the text, the (placeholder, original) entries in order, and the next index; each phase folds
its matches into it, so phases can be combined.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.batches import by_batches
from quillmill.functions.text import filled
from quillmill.functions.values import CAPITAL_STOP_WORDS, EDGE, MONEY, NEWS_TERMS, NOUNS, TIME, WS

_ENTRIES = "array<struct<placeholder:string,original:string>>"


def unmasked(text: Column) -> Column:
    """The mask of a text in which nothing is masked yet."""
    return F.struct(filled(text).alias("text"), F.array().cast(_ENTRIES).alias("entries"), F.lit(0).alias("next"))


def _step(mask: Column, kind: str, original: Column, text: Callable[[Column], Column]) -> Column:
    placeholder = F.concat(F.lit(f"__{kind}_"), mask["next"].cast("string"), F.lit("__"))
    entry = F.struct(placeholder.alias("placeholder"), original.alias("original"))
    return F.struct(text(placeholder).alias("text"), F.concat(mask["entries"], F.array(entry)).alias("entries"), (mask["next"] + 1).alias("next"))


def _first_replaced(text: Column, part: Column, new: Column) -> Column:
    at = F.position(part, text)
    changed = F.concat(F.substring(text, F.lit(1), at - 1), new, F.substring(text, at + F.length(part), F.length(text)))
    return F.when(at > 0, changed).otherwise(text)


def _matches(mask: Column, pattern: str) -> Column:
    return F.regexp_extract_all(mask["text"], F.lit(pattern), F.lit(0))


def mask_times(mask: Column) -> Column:
    """Clock times, each at its first occurrence in the text; their dots are kept as colons."""
    return F.aggregate(_matches(mask, f"{EDGE}{TIME}{EDGE}"), mask, lambda m, x: _step(m, "TIME", F.replace(x, F.lit("."), F.lit(":")), lambda p: _first_replaced(m["text"], x, p)))


def mask_money(mask: Column) -> Column:
    return F.aggregate(_matches(mask, f"{MONEY}{EDGE}"), mask, lambda m, x: _step(m, "MONEY", x, lambda p: _first_replaced(m["text"], x, p)))


def mask_nouns(mask: Column) -> Column:
    """Names of several capitalised words that don't start with a stop-word, the longest first, all their occurrences."""
    return _masked_in_python(mask, [_noun_phase()])


def mask_terms(mask: Column, terms: list[str] | None = None) -> Column:
    """News terms, the longest first: the first occurrence's spelling, wherever the text has just that."""
    return _masked_in_python(mask, [_term_phase(terms or NEWS_TERMS)])


def mask_nouns_and_terms(mask: Column) -> Column:
    """mask_nouns, then mask_terms, in one pass over the rows."""
    return _masked_in_python(mask, [_noun_phase(), _term_phase(NEWS_TERMS)])


# ---------------------------------------------------------------- phases whose patterns come from the text

#: A phase: (text, index of the next placeholder) -> (text, originals in the order of their placeholders).
Phase = Callable[[str, int], tuple[str, list[str]]]


def _masked_in_python(mask: Column, phases: list[Phase]) -> Column:
    """The phases by Arrow batches: as expressions, each name and term of a text would cost a pattern and a copy of the text."""

    def run(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        out, found = [], []
        for x, start in zip(texts, starts, strict=True):
            originals: list[str] = []
            for phase in phases:
                x, more = phase(x, start + len(originals))
                originals += more
            out.append(x)
            found.append(originals)
        return pd.DataFrame({"text": out, "originals": found})

    made = by_batches(run, "text string, originals array<string>")(mask["text"], mask["next"])
    # one row's struct, so that the function is called once
    return F.transform(F.array(made), lambda m: _joined(mask, m))[0]


def _joined(mask: Column, made: Column) -> Column:
    new = F.transform(made["originals"], lambda x, k: F.struct(F.concat(F.lit("__NOUN_"), (mask["next"] + k).cast("string"), F.lit("__")).alias("placeholder"), x.alias("original")))
    return F.struct(made["text"].alias("text"), F.concat(mask["entries"], new).alias("entries"), (mask["next"] + F.size(made["originals"])).alias("next"))


def _is_word(c: str) -> bool:
    return c == "_" or unicodedata.category(c)[0] in "LN"


def _at_edge(text: str, k: int) -> bool:
    """Whether a word begins or ends at k."""
    before, after = k > 0 and _is_word(text[k - 1]), k < len(text) and _is_word(text[k])
    return before != after


def _replaced(text: str, part: str, new: str) -> str:
    """text with part replaced wherever both its ends are word edges."""
    out, last, at = [], 0, text.find(part)
    while at >= 0:
        end = at + len(part)
        if _at_edge(text, at) and _at_edge(text, end):
            out += [text[last:at], new]
            last, at = end, text.find(part, end)
        else:
            at = text.find(part, at + 1)
    return "".join([*out, text[last:]])


def _noun_phase() -> Phase:
    """One scan finds all runs of capitalised words; every occurrence of a name lies in one of them.

    A run that is a name is replaced whole, as no longer name fits into it. Only in the others, which start with a
    stop-word, are names looked up, between their word edges.
    """
    runs = regex.compile(EDGE + NOUNS.replace(WS, r"\s") + EDGE)  # there, \s is all white space of Unicode
    first, stop = re.compile("[a-zA-Z.]+"), frozenset(CAPITAL_STOP_WORDS)

    def phase(text: str, start: int) -> tuple[str, list[str]]:
        found = [m.span() for m in runs.finditer(text)]
        names = {text[a:b] for a, b in found if first.match(text, a)[0] not in stop}
        if not names:
            return text, []
        order = sorted(names, key=lambda x: (-len(x), x))
        mark = {x: f"__NOUN_{start + k}__" for k, x in enumerate(order)}
        longest = len(order[0])

        def inside(run: str) -> str:
            edges = [k for k in range(len(run) + 1) if _at_edge(run, k)]
            there = {run[a:b] for i, a in enumerate(edges) for b in edges[i + 1 :] if b - a <= longest} & names
            for x in sorted(there, key=lambda x: (-len(x), x)):
                run = _replaced(run, x, mark[x])
            return run

        out, last = [], 0
        for a, b in found:
            run = text[a:b]
            out += [text[last:a], mark.get(run) or inside(run)]
            last = b
        return "".join([*out, text[last:]]), order

    return phase


def _term_phase(terms: list[str]) -> Phase:
    """Only terms that the text has at all are looked for by pattern; letters of ASCII count as equal in both cases."""
    ordered = sorted(set(terms), key=lambda x: (-len(x), x))
    patterns = {x: re.compile("".join(f"[{c.lower()}{c.upper()}]" if c.isascii() and c.isalpha() else re.escape(c) for c in x)) for x in ordered}

    def phase(text: str, start: int) -> tuple[str, list[str]]:
        low, found = text.lower(), []
        for x in ordered:
            if x.lower() not in low:
                continue
            at = patterns[x].search(text)
            while at and not (_at_edge(text, at.start()) and _at_edge(text, at.end())):
                at = patterns[x].search(text, at.start() + 1)
            if at:
                text = _replaced(text, at[0], f"__NOUN_{start + len(found)}__")
                found.append(at[0])
        return text, found

    return phase


def unmask(text: Column, entries: Column) -> Column:
    """The text with all placeholders replaced, in the entries' order."""
    return F.aggregate(entries, filled(text), lambda t, e: F.replace(t, e["placeholder"], e["original"]))
