"""Improbable-feature digests.

A feature is a window of WINDOW bytes. Windows are ranked by how rare their entropy is among all documents'
windows; in every stretch of SPAN windows the rarest is popular, and windows popular often enough are features.
Texts of fewer than SHORT bytes have few such features, so they have finer ones besides: windows of FINE_WINDOW bytes,
ranked and chosen in the same way. Features are put into Bloom filters of BITS bits, PER_FILTER to each, in order: the chain is the fingerprint. Two
fingerprints are compared by the filters' common bits, normalised by what chance gives.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.base import bounded_batches, flat, mix, shuffle_partitions

WINDOW, SPAN, POPULAR = 32, 32, 8
FINE_WINDOW, FINE_SPAN, FINE_POPULAR, SHORT = 8, 4, 1, 512
BITS, PER_FILTER, HASHES = 2048, 160, 5
#: Of texts to a task, and the most ranges of ids; beyond both, tasks get larger.
TASK_BYTES, MOST_BUCKETS = 64 << 20, 1 << 14
#: Steps of entropy, from 0 to as many bits as a window can have.
STEPS = 1024
_CHUNK, _HELD = 1 << 17, 500_000
_GAIN = np.array([0.0, *[c * np.log2(c) if c else 0.0 for c in range(WINDOW + 1)]])
_GAIN = np.round((_GAIN[2:] - _GAIN[1:-1]) * (1 << 16)).astype(np.int64)  # of one more of a byte, by how many there are


def entropies(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The entropy of the window bytes (WINDOW at most) from each place, in STEPS steps.

    A window's sum of c * log2(c) over its byte counts c changes by a gain and a loss when it moves on; how many equal
    bytes are in the window before and after each place comes from comparing the buffer with itself, shifted.
    """
    n = len(data) - window + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for a in range(0, len(data), _CHUNK):  # pieces that stay in cache
        b = min(len(data), a + _CHUNK)
        own = data[a:b]
        for shift in range(1, window):
            low = max(a - shift, 0) + shift  # first place with one that far before it
            if low < b:
                before[low:b] += data[low:b] == data[low - shift : b - shift]
            high = min(b, len(data) - shift)
            if a < high:
                after[a:high] += own[: high - a] == data[a + shift : high + shift]
    sums = np.zeros(n, np.int64)
    # the first window, byte by byte; there `before` counts no byte outside it
    sums[0] = _GAIN[before[:window]].sum()
    sums[1:] = _GAIN[before[window:]] - _GAIN[after[: n - 1]]
    np.cumsum(sums, out=sums)
    top = int(window * np.log2(window) * (1 << 16))
    return ((top - sums) * (STEPS - 1) // top).clip(0, STEPS - 1).astype(np.int32)


def _inside(offsets: np.ndarray, n: int, width: int) -> np.ndarray:
    """Whether the width bytes from each of n places lie in one text."""
    out = np.zeros(n + 1, np.int32)
    ends = np.maximum(offsets[1:] - width + 1, offsets[:-1]).clip(max=n)
    np.add.at(out, offsets[:-1].clip(max=n), 1)
    np.add.at(out, ends, -1)
    return np.cumsum(out[:n]) > 0


def entropy_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many windows of all texts have each entropy: two rows of STEPS numbers, of WINDOW and of FINE_WINDOW bytes, summed in tasks before they are gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, STEPS), np.int64)
        for batch in batches:
            for part in _parts(batch, [0]):
                data, offsets = flat(part.column(0))
                for row, window in zip(total, (WINDOW, FINE_WINDOW), strict=True):
                    e = entropies(data, window)
                    row += np.bincount(e[_inside(offsets, len(e), window)], minlength=STEPS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total.ravel()[found])], ["step", "n"])

    bounded_batches(docs.sparkSession)
    out = np.zeros(2 * STEPS, np.int64)
    for step, n in docs.select(F.col(text).cast("string")).mapInArrow(run, "step int, n long").groupBy("step").agg(F.sum("n")).collect():
        out[step] = n
    return out.reshape(2, STEPS)


def ranks(counts: np.ndarray) -> np.ndarray:
    """The rank of each entropy by row, the rarest first, equal counts by the higher entropy; the lowest tenth of the scale last: runs of one byte say little."""
    out = np.empty(counts.shape, np.int64)
    for row, own in zip(out, counts, strict=True):
        row[np.lexsort((-np.arange(STEPS), own))] = np.arange(STEPS)
    out[:, : STEPS // 10] = STEPS
    return out


def _popular(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray, window: int, span: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts, places and hashes of windows that are the rarest in `least` stretches of `span` windows; span is a power of two.

    A text without one has its rarest window, one shorter than a window none.
    """
    e = entropies(data, window)
    owners, places = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(e):
        key = rank[e] << 40 | np.arange(len(e))  # of equal ranks the leftmost
        # stretches lie in one text; in texts of fewer windows than a stretch, the whole text is one
        low, size = key, 1
        while size < span:
            low = np.minimum(low[:-size], low[size:]) if len(low) > size else low[:0]
            size *= 2
        ok = _inside(offsets, len(low), window + span - 1)
        chosen = (low & ((1 << 40) - 1))[ok]
        new = np.append(True, chosen[1:] != chosen[:-1])[: len(chosen)]
        first = np.flatnonzero(new)
        popular = chosen[first][np.diff(np.append(first, len(chosen))) >= least]
        popular = popular[rank[e[popular]] < STEPS]
        owners, places = np.searchsorted(offsets, popular, "right") - 1, popular
    sizes = np.diff(offsets)
    has = np.zeros(len(sizes), bool)
    has[owners] = True
    lone = np.flatnonzero(~has & (sizes >= window))
    rarest = np.array([int(key[offsets[i] : offsets[i + 1] - window + 1].min() & ((1 << 40) - 1)) for i in lone], np.int64)
    owners, places = np.append(owners, lone), np.append(places, rarest)
    words = np.lib.stride_tricks.sliding_window_view(data, window)[places].copy().view(np.uint64) if len(places) else np.zeros((0, window // 8), np.uint64)
    hashes = np.zeros(len(places), np.uint64)
    for k in range(window // 8):
        hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + words[:, k])
    return owners, places, hashes


def features(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts and hashes of their features, in order: those of WINDOW bytes, then a short text's finer ones.

    A text shorter than the smallest window is one feature; an empty one has none.
    """
    found = [_popular(data, offsets, rank[0], WINDOW, SPAN, POPULAR)]
    sizes = np.diff(offsets)
    fine = np.flatnonzero((sizes >= FINE_WINDOW) & (sizes < SHORT))
    own = np.append(0, np.cumsum(sizes[fine]))
    owners, places, hashes = _popular(data[np.repeat(offsets[fine] - own[:-1], sizes[fine]) + np.arange(own[-1])], own, rank[1], FINE_WINDOW, FINE_SPAN, FINE_POPULAR)
    found.append((fine[owners], places, hashes))
    tiny = np.flatnonzero((sizes > 0) & (sizes < FINE_WINDOW))
    small = np.array([int.from_bytes(hashlib.blake2b(data[offsets[i] : offsets[i + 1]].tobytes(), digest_size=8).digest(), "little") for i in tiny], np.uint64)
    found.append((tiny, np.zeros(len(tiny), np.int64), small))
    level = np.repeat(np.arange(3), [len(x[0]) for x in found])
    owners, places, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((places, level, owners))
    return owners[order], hashes[order]


def chains(owners: np.ndarray, hashes: np.ndarray, n: int) -> list[np.ndarray]:
    """Each text's chain of Bloom filters, as rows of BITS / 8 bytes."""
    counts = np.bincount(owners, minlength=n)
    links = -(-counts // PER_FILTER)
    base = np.cumsum(links) - links
    place = np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (base[owners] + place // PER_FILTER) * BITS
    bits = np.zeros(int(links.sum()) * BITS, np.uint8)
    for k in range(HASHES):
        bits[at + (hashes >> np.uint64(11 * k) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    rows = np.packbits(bits).reshape(-1, BITS // 8)
    return [rows[a : a + m] for a, m in zip(base.tolist(), links.tolist(), strict=True)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: over the shorter chain's filters, weighted by their bits, the best normalised overlap with one of the other's.

    Equal fingerprints give 1, also empty ones; an empty and another one 0.
    """
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    wide_a, wide_b = a.view(np.uint64), b.view(np.uint64)
    set_a, set_b = np.bitwise_count(wide_a).sum(1, dtype=np.int64), np.bitwise_count(wide_b).sum(1, dtype=np.int64)
    best = np.zeros(len(a))
    for i in range(len(a)):
        common = np.bitwise_count(wide_b & wide_a[i]).sum(1, dtype=np.int64)
        fewer = np.minimum(set_b, set_a[i])
        chance = set_b * set_a[i] / BITS
        chance += 3 * np.sqrt(chance)  # no more than chance is no likeness
        best[i] = ((common - chance) / np.maximum(fewer - chance, 1)).clip(0, 1).max()
    return float((best * set_a).sum() / set_a.sum())


def _parts(batch: pa.RecordBatch, columns: list[int], limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about `limit` bytes in those columns together."""
    if not batch.num_rows:
        return
    sizes = sum(np.asarray(pc.fill_null(pc.binary_length(batch.column(c)), 0), dtype=np.int64) for c in columns)
    part = (np.cumsum(sizes) - sizes) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def encoded(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def decoded(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, BITS // 8)


def fingerprint(docs: DataFrame, counts: np.ndarray | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (base64 of the chain; empty for null and empty texts) for each row of docs.

    counts: entropy_counts of the corpus; counted from docs if not given. Fingerprints that are to be compared need
    the same counts. Equal texts have equal fingerprints.
    """
    bounded_batches(docs.sparkSession)
    rank = docs.sparkSession.sparkContext.broadcast(ranks(entropy_counts(docs, text) if counts is None else counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, [1]):
                data, offsets = flat(part.column(1))
                made = chains(*features(data, offsets, rank.value), len(part))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([encoded(x) for x in made])], ["doc_id", "fingerprint"])

    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(run, picked.select("doc_id", F.lit("").alias("fingerprint")).schema)


# ---------------------------------------------------------------- each document, its edited text and its neighbour


def in_order(docs: DataFrame, doc_id: str, text: str, buckets: int) -> DataFrame:
    """bucket, guest, doc_id, text: documents in buckets of descending id, each with the document that follows its last one.

    Bounds are ids, about evenly spread, from an approximate percentile: `buckets` numbers. Every bound starts a
    bucket and is copied, as a guest, to the bucket before it; the first of all is the guest of the last bucket. So
    each document meets its successor in its own bucket, and no task holds more than a bucket.
    """
    shares = [k / buckets for k in range(1, buckets + 1)]
    some = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = some.agg(F.percentile_approx("doc_id", shares, 20 * buckets), F.max("doc_id")).first()
    bounds = np.array(sorted({*(found[0] or []), *([found[1]] if found[1] is not None else [])}, reverse=True), np.int64)
    if not len(bounds):  # no document with an id: all are one bucket
        return some.select(F.lit(0).alias("bucket"), F.explode(F.array(F.lit(False), F.lit(True))).alias("guest"), "doc_id", "text")
    last, rising = len(bounds) - 1, bounds[::-1].copy()

    def place_of(ids: pd.Series) -> pd.Series:
        """Twice the bucket, and one more for a bound."""
        at = np.searchsorted(rising, ids.to_numpy(), "left")
        return pd.Series(2 * (last - at) + (rising[at] == ids.to_numpy()), dtype="int32")

    place = F.pandas_udf(place_of, "int")(F.coalesce("doc_id", F.lit(int(rising[0]))))  # null ids come last, in the last bucket
    host = F.when(F.col("bucket") == 0, F.lit(last)).otherwise(F.col("bucket") - 1)
    placed = some.withColumn("place", place).withColumn("bucket", F.shiftright("place", 1)).withColumn("starts", F.col("doc_id").isNotNull() & (F.col("place") % 2 == 1))
    own = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    both = F.when(F.col("starts"), F.array(own, F.struct(host.alias("bucket"), F.lit(True).alias("guest")))).otherwise(F.array(own))
    return placed.withColumn("at", F.explode(both)).select("at.bucket", "at.guest", "doc_id", "text")


def compare_next(docs: DataFrame, counts: np.ndarray | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of docs.

    A document's next one is that with the next lower id, after the lowest the highest; null ids come last. Rows with
    one id are in the order of a hash of their texts. The edited text has its last floor(n_chars / 2) characters
    replaced by as many (or all) of the next text's first. Null texts are empty, very long ones are read whole. A lone document is its own next. An
    empty table gives no rows. Other columns of docs aren't read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    counts = entropy_counts(docs, text) if counts is None else counts
    rank = spark.sparkContext.broadcast(ranks(counts))
    # two buckets or more a task; bounds and their percentile are kept on the driver, so they have an end
    partitions = min(MOST_BUCKETS // 2, max(64, shuffle_partitions(spark), int(counts[0].sum()) // TASK_BYTES))
    order = [F.col("bucket"), F.col("guest"), F.desc_nulls_last("doc_id"), F.xxhash64("text"), F.col("text")]
    dealt = in_order(docs, doc_id, text, 2 * partitions).repartition(partitions, "bucket").sortWithinPartitions(*order)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def compared(rows: list[tuple[int, bool, int | None, str]]) -> pa.RecordBatch:
        """For all rows but the last and guests."""
        mine = [i for i in range(len(rows) - 1) if not rows[i][1]]
        texts = [x[3] for x in rows]
        edited = []
        for i in mine:
            n = len(texts[i])
            edited.append(texts[i][: n - n // 2] + texts[i + 1][: n // 2])
        made = chains(*features(*flat(pa.array(texts + edited, pa.large_string())), rank.value), len(texts) + len(edited))
        of_edited = made[len(texts) :]
        columns = [
            [rows[i][2] for i in mine],
            [len(texts[i]) for i in mine],
            [hashlib.sha256(x.encode()).hexdigest() for x in edited],
            [encoded(made[i]) for i in mine],
            [encoded(x) for x in of_edited],
            [likeness(made[i], x) for i, x in zip(mine, of_edited, strict=True)],
            [likeness(made[i], made[i + 1]) for i in mine],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bool, int | None, str]] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[1] and held and held[-1][:2] == row[:2]:
                    continue  # one guest is enough
                held.append((*row[:3], row[3] or ""))
                size += len(held[-1][3])
                if size > _HELD:
                    yield compared(held)
                    held, size = held[-1:], 0
        if held:
            # each bucket ends with a guest, so the last row held is one
            yield compared(held)

    return dealt.mapInArrow(run, schema_text(schema))


def schema_text(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'double' if f.type == pa.float64() else 'string'}" for f in schema)
