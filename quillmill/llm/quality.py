"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio between trusted texts and the raw corpus.

Two multinomials over hashed byte 4-grams are counted, one over all documents and one over trusted ones. A text's
score is the mean over its 4-grams of log(trusted / raw); texts under a fixed threshold are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillmill.llm.base import Words, bounded_batches, flat, mix, per_text, prefix_sums, slices, small_enough, span_hashes, windows

#: Hash buckets of the multinomials.
BUCKETS = 1 << 16
#: Texts whose mean log ratio is lower are rejected.
THRESHOLD = -0.7
#: Counts added to each bucket, as if so many 4-grams had been seen, spread as in the raw corpus.
PRIOR = 100_000.0
_SLICE = 1 << 20
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the four bytes from each place, and whether they lie in one text."""
    if len(data) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, bool)
    wide = data.astype(np.uint32)
    value = wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24
    value *= np.uint32(2654435761)
    value >>= np.uint32(32 - BUCKETS.bit_length() + 1)
    inside = np.ones(len(value), bool)
    for back in (1, 2, 3):
        at = offsets[1:-1] - back
        inside[at[(at >= 0) & (at < len(inside))]] = False
    return value, inside


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each key is found twice or more."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    n, texts = len(data), len(offsets) - 1
    words, sums = Words(data, offsets), prefix_sums(data)
    out = {"n_words": np.diff(words.first), "word_chars": per_text(words.inside & ((data & 0xC0) != 0x80), offsets), "n_symbols": per_text(_SYMBOL[data], offsets)}
    salt = mix(np.arange(1, texts + 1, dtype=np.uint64))

    # lines with a word that are equal to an earlier one of their text
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < n]
    ends = np.append(starts[1:], n) if len(starts) else starts
    ends = ends - ((ends > starts) & (data[ends - 1] == 10)) if len(starts) else ends
    full = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[full], ends[full]
    owner = np.searchsorted(offsets, starts, "right") - 1
    keys = span_hashes(sums, starts, ends) ^ salt[owner]
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:][keys[order][1:] == keys[order][:-1]]] = True
    out["n_dup_lines"] = np.bincount(owner[again], minlength=texts)

    # words in windows of 8 that are found twice or more
    owner = np.repeat(np.arange(texts), out["n_words"])
    keys = windows(span_hashes(sums, words.starts, words.ends), 8)
    cover = np.zeros(len(owner) + 1, np.int64)
    if len(keys):
        places = np.flatnonzero(owner[: len(keys)] == owner[7:])
        places = places[_repeats(keys[places] ^ salt[owner[places]])]
        np.add.at(cover, places, 1)
        np.add.at(cover, places + 8, -1)
    covered = np.cumsum(cover)[:-1] > 0
    out["n_repeat_words"] = per_text(covered, words.first)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in slices(batch, 0, _SLICE):
            value, inside = _grams(*flat(part.column(0)))
            total += np.bincount(value[inside], minlength=BUCKETS)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["bucket", "n"])


def gram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of the hashed 4-grams of all texts: summed in each task, then by bucket; BUCKETS numbers reach the driver."""
    bounded_batches(docs.sparkSession)
    parts = docs.select(F.col(text).cast("string")).mapInArrow(_count, "bucket int, n long")
    out = np.zeros(BUCKETS, np.float64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def log_ratios(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(trusted / raw) by bucket. Without trusted or raw counts all are 0."""
    if not trusted.sum() or not raw.sum():
        return np.zeros(BUCKETS, np.float32)
    prior = (raw + 0.5) / (raw + 0.5).sum()
    # the prior's weight is a hundredth of the trusted counts at most, so that few trusted texts still count
    weight = min(PRIOR, 0.01 * trusted.sum())
    return (np.log((trusted + weight * prior) / (trusted.sum() + weight)) - np.log(prior)).astype(np.float32)


def trusted_texts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts of all documents labelled quality 1; the ids are broadcast if they are few enough, and shuffled if not."""
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("_id")).distinct()
    return docs.select(doc_id, text).join(F.broadcast(good) if small_enough(good, 16) else good, F.col(doc_id) == F.col("_id"), "left_semi").select(text)


def _scored(docs: DataFrame, carried: list[str], ratios: np.ndarray, threshold: float, text: str) -> DataFrame:
    """The carried columns as _0, _1 and so on, then the results."""
    bounded_batches(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast(ratios)  # BUCKETS numbers, whatever the input
    picked = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(carried)], F.col(text).cast("string").alias("_text"))
    kind = StructType(picked.schema.fields[:-1])
    for name in COUNTS:
        kind = kind.add(name, "long")
    kind = kind.add("base_failed", "boolean").add("score", "double").add("kept", "boolean")
    schema, at = to_arrow_schema(kind), len(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = table.value
        for batch in batches:
            for part in slices(batch, at, _SLICE):
                data, offsets = flat(part.column(at))
                c = text_counts(data, offsets)
                value, inside = _grams(data, offsets)
                sums = np.zeros(len(data) + 1)
                np.cumsum(np.where(inside, ratio[value], np.float32(0)), dtype=np.float64, out=sums[1 : len(value) + 1])
                sums[len(value) + 1 :] = sums[len(value)]
                mean = (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(1, np.diff(offsets) - 3)
                failed = (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])
                made = [pa.array(c[k].astype(np.int64)) for k in COUNTS] + [pa.array(failed), pa.array(mean), pa.array(~failed & (mean >= threshold))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], schema=schema)

    return picked.mapInArrow(run, kind)


def _ratios(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> np.ndarray:
    return log_ratios(gram_counts(trusted_texts(docs, labels, doc_id=doc_id, text=text), text), gram_counts(docs, text))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept for each row of docs.

    labels: doc_id, quality; rows with quality 1 are trusted. Without any, or without documents, all ratios are 0
    and the base rules decide alone. Null and empty texts have no words and fail the base rules. Texts under four
    bytes score 0. Repeated rows get equal results. Texts are read whole; a task needs about a hundred bytes of
    memory for each byte of its longest text. Other columns of docs aren't read.
    """
    return _scored(docs, [doc_id], _ratios(docs, labels, doc_id, text), threshold, text).withColumnRenamed("_0", doc_id)


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that quality() keeps, with all their columns, whatever these are called.

    Null, empty and short texts go, as base_failed; very long ones are judged whole. Repeated rows are judged alike. An
    empty table gives no rows; without labels all that the base rules leave is kept.
    """
    marked = _scored(docs, docs.columns, _ratios(docs, labels, doc_id, text), threshold, text)
    return marked.filter("kept").select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])
