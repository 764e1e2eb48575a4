"""Translation as a pluggable function of text batches, and the masked translation of bodies and headlines."""

from __future__ import annotations

import re
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.batches import bounded_batches, by_batches
from quillmill.functions.mask import mask_money, mask_nouns_and_terms, mask_times, unmask, unmasked
from quillmill.functions.text import quote_strip, sentences, strip, strip_bold


class Translator(Protocol):
    """writes_names: whether it writes names in the target's script, so that the entity gate is off."""

    writes_names: bool

    def translate(self, texts: list[str], task: str) -> list[str]:
        """task: body, headline or back."""
        ...


class Lexicon:
    """A deterministic word-for-word translator for tests: words of its table are replaced, all else stays."""

    #: A small everyday vocabulary.
    WORDS = {"the": "वह", "of": "का", "and": "और", "in": "में", "to": "को", "is": "है", "was": "था", "for": "लिए", "on": "पर", "with": "साथ", "from": "से", "that": "कि", "this": "यह", "not": "नहीं", "are": "हैं", "by": "द्वारा"}

    def __init__(self, words: dict[str, str] | None = None, writes_names: bool = True):
        self.words, self.writes_names = words or self.WORDS, writes_names
        self.back = {v: k for k, v in self.words.items()}

    def translate(self, texts: list[str], task: str) -> list[str]:
        if task == "back":
            return [re.sub(r"[ऀ-ॿ]+", lambda m: self.back.get(m[0], m[0]), x).replace("।", ".") for x in texts]
        return [re.sub(r"[.]$", "।", re.sub(r"(?<![\w])[A-Za-z]+(?![\w])", lambda m: self.words.get(m[0].lower(), m[0]), x)) for x in texts]


class Seq2Seq:
    """A sequence-to-sequence model of the transformers library, loaded once a worker."""

    writes_names = False

    def __init__(self, name: str, source: str = "eng_Latn", target: str = "hin_Deva", beams: int = 4, back_beams: int = 2, tokens: int = 256):
        self.name, self.source, self.target, self.beams, self.back_beams, self.tokens = name, source, target, beams, back_beams, tokens
        self._loaded = None

    def translate(self, texts: list[str], task: str) -> list[str]:
        if self._loaded is None:
            from transformers import AutoModelForSeq2SeqLM, AutoTokenizer

            self._loaded = AutoTokenizer.from_pretrained(self.name), AutoModelForSeq2SeqLM.from_pretrained(self.name).eval()
        tokenizer, model = self._loaded
        into = self.source if task == "back" else self.target
        tokenizer.src_lang = self.target if task == "back" else self.source
        coded = tokenizer(texts, return_tensors="pt", padding=True, truncation=True, max_length=self.tokens)
        beams = self.back_beams if task == "back" else self.beams
        made = model.generate(**coded, forced_bos_token_id=tokenizer.convert_tokens_to_ids(into), max_length=self.tokens, num_beams=beams)
        return tokenizer.batch_decode(made, skip_special_tokens=True)


#: What a causal model is asked for, by task.
PROMPTS = {
    "body": "You translate news from English. Write this sentence in plain {language}, in its own script. Keep every name, number and placeholder as it stands. Give the translation only.\n\n{text}\n\n{language}:",
    "headline": "You write headlines. Put this one into short, natural {language}, in its own script. Keep names, numbers and placeholders. Give one line, without quotes.\n\n{text}\n\n{language}:",
    "back": "Translate this {language} text into English, word by word where you can. Keep names and numbers. Give the translation only.\n\n{text}\n\nEnglish:",
}


class Causal:
    """A causal chat model in a local file, loaded once a worker. Its sampling makes results vary."""

    writes_names = True

    def __init__(self, path: str, language: str, prompts: dict[str, str] | None = None, context: int = 2048, tokens: int = 256, temperature: float = 0.2, top_p: float = 0.9):
        self.path, self.language, self.prompts, self.context, self.tokens, self.temperature, self.top_p = path, language, prompts or PROMPTS, context, tokens, temperature, top_p
        self._loaded = None

    def translate(self, texts: list[str], task: str) -> list[str]:
        if self._loaded is None:
            from llama_cpp import Llama

            self._loaded = Llama(model_path=self.path, n_ctx=self.context, verbose=False)
        options = {"max_tokens": self.tokens, "temperature": self.temperature, "top_p": self.top_p, "echo": False}
        made = [self._loaded(self.prompts[task].format(text=x, language=self.language), **options)["choices"][0]["text"].strip() for x in texts]
        return [re.sub("^[\"']|[\"']$", "", x) for x in made]


def _called(translator: Translator, task: str, text: Column) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(translator.translate([x or "" for x in texts], task))

    return by_batches(run, "string")(text)


def _called_by_sentence(translator: Translator, task: str, parts: Column) -> Column:
    """Each row's sentences translated and joined again, in their order; no shuffle."""

    def run(rows: pd.Series) -> pd.Series:
        made = iter(translator.translate([s for x in rows for s in x], task))
        return pd.Series([" ".join(next(made) for _ in x) for x in rows])

    return by_batches(run, "string")(parts)


def mask_all(text: Column) -> Column:
    """Times, money, names and news terms masked, with one running index."""
    return mask_nouns_and_terms(mask_money(mask_times(unmasked(text))))


def with_masks(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with a mask column. Each phase is a column of its own, as its text is read more than once."""
    return _with_all_masks(df, {text: out})


def _with_all_masks(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with a mask column for each text column; a phase of all of them in one pass."""
    bounded_batches(df.sparkSession)
    df = df.withColumns({out: unmasked(F.col(text)) for text, out in columns.items()})
    for phase in (mask_times, mask_money, mask_nouns_and_terms):
        df = df.withColumns({out: phase(F.col(out)) for out in columns.values()})
    return df


def translate_all(df: DataFrame, translator: Translator, bodies: dict[str, str], shorts: dict[str, str]) -> DataFrame:
    """df with the translations of text columns, each under its new name.

    Bodies are masked whole, cut into sentences, translated and unmasked; short texts are translated in one piece, empty
    for empty. All columns are masked in one Python pass and translated in another, so a task holds two workers.
    """
    plain = {text: f"_{out}_plain" for text, out in shorts.items()}
    df = df.withColumns({new: strip_bold(strip(F.coalesce(F.col(text), F.lit("")))) for text, new in plain.items()}) if shorts else df
    df = _with_all_masks(df, {text: f"_{out}_mask" for text, out in bodies.items()} | {plain[text]: f"_{out}_mask" for text, out in shorts.items()})
    raw = {out: _called_by_sentence(translator, "body", sentences(F.col(f"_{out}_mask.text"))) for out in bodies.values()}
    raw |= {out: _called(translator, "headline", F.col(f"_{out}_mask.text")) for out in shorts.values()}
    df = df.withColumns({f"_{out}_raw": column for out, column in raw.items()})
    made = {out: unmask(F.col(f"_{out}_raw"), F.col(f"_{out}_mask.entries")) for out in bodies.values()}
    for out in shorts.values():
        whole = unmask(quote_strip(F.col(f"_{out}_raw")), F.col(f"_{out}_mask.entries"))
        made[out] = F.when(F.col(f"_{out}_plain") == "", "").otherwise(whole)
    return df.withColumns(made).drop(*plain.values(), *[f"_{out}_{x}" for out in made for x in ("mask", "raw")])


def translate_body(df: DataFrame, text: str, out: str, translator: Translator) -> DataFrame:
    """df with the translation of text: masked whole, cut into sentences, translated, unmasked."""
    return translate_all(df, translator, {text: out}, {})


def translate_short(df: DataFrame, text: str, out: str, translator: Translator) -> DataFrame:
    """df with the translation of a short text, in one piece; empty for empty."""
    return translate_all(df, translator, {}, {text: out})


def translate_back(translator: Translator, text: Column) -> Column:
    return _called(translator, "back", text)
