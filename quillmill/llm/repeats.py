"""Repeated passages by an enhanced suffix array, distributed.

A passage of LEAST bytes that starts in two documents is a prefix that two suffixes share. The suffix array is built
in parts such that suffixes with an equal LEAST-byte prefix always lie in one part: each window of LEAST bytes
belongs to the least-hashed GRAM-byte string in it, and the windows in a row with the same one make a run, whose
bytes say all about them.

1. Runs are hashed. Equal runs are one entry with several occurrences; only the occurrences in its first document
   are left open. Where a GRAM-byte string has one run only, nothing is left open.
2. The bytes of the open runs go to parts by their string (by their windows where a string has many runs). In each
   part the windows whose prefix recurs are sorted, common prefixes of neighbours are measured, and a stack scan
   gives the tree of common-prefix intervals: each is a repeat with all its occurrences, maximal if the bytes to the
   left differ. All occurrences but those in the interval's first document are repeats of an earlier document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.base import bounded_batches, checkpoint, flat, mix, prefix_sums, shuffle_partitions, slices, span_hashes

LEAST, GRAM = 50, 24
#: Runs of one string in one block, or in all, beyond which its windows are dealt out one by one.
HOT_BLOCK, HOT = 64, 4000
#: Windows of such strings in a block, of which equal ones are settled before they are sent.
HOT_ROWS = 100_000
_SLICE, _FLUSH = 1 << 19, 500_000
#: Rows whose suffixes make one part, if its keys can be told apart.
PART = 10_000
#: What is known of a run or span: a repeat of an earlier document, open, or open and dealt out by window; PACKED rows carry runs to their bucket.
COVERED, OPEN, HOT_OPEN, PACKED = range(4)
#: Bits of a span's number of windows; the rest is its place.
_BITS = 16


def runs(data: np.ndarray, offsets: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' runs of windows: prefix sums of the buffer, each run's string hash, its first window, how many windows."""
    sums = prefix_sums(data)
    if len(data) < least:
        return sums, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = np.arange(len(data) - gram + 1)
    hashes = span_hashes(sums, places, places + gram)
    low = np.uint64(0xFFFFFFFF)
    best = (hashes & ~low) | places.astype(np.uint64)  # of equal ones the leftmost
    width, span, count = best, 1, least - gram + 1
    while span * 2 <= count:
        width = np.minimum(width[:-span], width[span:])
        span *= 2
    best = np.minimum(width[: len(best) - count + 1], width[count - span :])
    at = (best & low).astype(np.int64)
    inside = np.ones(len(at), bool)
    for end in offsets[1:-1].tolist():
        inside[max(0, end - least + 1) : end] = False
    new = np.append(True, (at[1:] != at[:-1]) | (inside[1:] != inside[:-1]))
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(at)))
    ok = inside[first]
    return sums, hashes[at[first[ok]]], first[ok], many[ok]


def common_prefixes(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For sorted rows of padded bytes, how many each has in common with the one before; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differs = rows[1:] != rows[:-1]
        equal = np.where(differs.any(1), differs.argmax(1), rows.shape[1])
        out[1:] = np.minimum(equal, np.minimum(sizes[1:], sizes[:-1]))
    return out


def intervals(common: np.ndarray, left: np.ndarray, least: int) -> list[tuple[int, int, int, bool]]:
    """The common-prefix intervals of length `least` or more: (first, last, length, whether left extensions differ).

    A stack holds the open intervals from the outermost in; one closes where the common prefix gets shorter.
    """
    changes = np.append(0, np.cumsum(left[1:] != left[:-1])).tolist() if len(left) else []
    found, stack = [], []
    for i, length in enumerate([*common.tolist(), 0]):
        start = i - 1
        while stack and stack[-1][0] > length:
            size, start = stack.pop()
            found.append((start, i - 1, size, changes[i - 1] > changes[start]))
        if length >= least and (not stack or stack[-1][0] < length):
            stack.append((length, start))
    return found


def repeated_windows(texts: list[bytes], counts: np.ndarray, left: np.ndarray, owner: np.ndarray, least: int = LEAST) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
    """For texts and their first `counts` windows: length, first owner, texts and places of each repeat's occurrences, and whether it is maximal."""
    sizes = np.array([len(x) for x in texts], np.int64)
    base = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    which = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = base[which] + place
    keys = span_hashes(prefix_sums(data), start, start + least)
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    again = order[np.append(same, False) | np.append(False, same)]
    if not len(again):
        return
    which, place, start = which[again], place[again], start[again]
    wide = int(sizes.max())
    padded = np.append(data, np.zeros(wide, np.uint8))
    rows = np.lib.stride_tricks.sliding_window_view(padded, wide)[start]
    rest = sizes[which] - place
    rows[np.arange(wide) >= rest[:, None]] = 0
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{wide}").ravel(), kind="stable")
    which, place, rest, rows = which[order], place[order], rest[order], rows[order]
    before = np.where(place > 0, padded[base[which] + place - 1].astype(np.int64), left[which])
    owners = owner[which]
    for first, last, length, maximal in intervals(common_prefixes(rows, rest), before, least):
        yield length, int(owners[first : last + 1].min()), which[first : last + 1], place[first : last + 1], maximal


# ---------------------------------------------------------------- the distributed steps

_KINDS = "kind int, bucket int, doc_id long, spans array<long>, packed binary"
_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("doc_id", pa.int64()), ("spans", pa.list_(pa.int64())), ("packed", pa.binary())])


def _width(least: int, gram: int) -> str:
    """The type that numbers of a run's windows are packed in."""
    return "u1" if least - gram + 1 < 256 else "<u2"


def _spans(kind: int, doc: np.ndarray, pos: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """A row for each document with its runs: place and number of windows in one number."""
    order = np.lexsort((pos, doc))
    doc, code = doc[order], (pos << _BITS | (count - 1))[order]
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)).astype(np.int32)), pa.array(code))
    n = len(first)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.nulls(n, pa.int32()), pa.array(doc[first]), lists, pa.nulls(n, pa.binary())], schema=_SCHEMA)


def _settle(gram: np.ndarray, run: np.ndarray, doc: np.ndarray, pos: np.ndarray, count: np.ndarray, flag: np.ndarray, hot: int) -> tuple[list[pa.RecordBatch], np.ndarray, np.ndarray, np.ndarray]:
    """Sort runs and say which are covered, which of the rest stand in strings with several documents' runs, and in hot ones.

    Returns the rows of those covered, the order of the rest, and for it the two answers.
    """
    order = np.lexsort((doc, run, gram))
    g, r, d = gram[order], run[order], doc[order]
    new_gram = np.append(True, g[1:] != g[:-1])
    new_run = new_gram | np.append(True, r[1:] != r[:-1])
    first = np.flatnonzero(new_run)
    lowest = np.repeat(d[first], np.diff(np.append(first, len(d))))
    late = d > lowest
    rows = [_spans(COVERED, d[late], pos[order][late], count[order][late])] if late.any() else []
    start = np.flatnonzero(new_gram)
    kinds = np.add.reduceat(new_run.astype(np.int64), start)
    low = np.minimum.reduceat(lowest, start)
    high = np.maximum.reduceat(lowest, start)
    flagged = np.logical_or.reduceat(flag[order], start)
    sizes = np.diff(np.append(start, len(g)))
    is_hot = np.repeat((kinds > hot) | flagged, sizes)
    is_open = np.repeat((low < high) | flagged, sizes)
    rest = ~late
    return rows, order[rest], is_open[rest], is_hot[rest]


def _packed_runs(docs: DataFrame, doc_id: str, text: str, least: int, gram: int, buckets: int) -> DataFrame:
    """The runs of all documents by bucket, after what a block can settle alone."""

    def flush(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        grams, hashes, doc, pos, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        rows, order, _, hot = _settle(grams, hashes, doc, pos, count, np.zeros(len(doc), bool), HOT_BLOCK)
        yield from rows
        lone = order[hot]
        if len(lone):
            yield _spans(HOT_OPEN, doc[lone], pos[lone], count[lone])
            # one run of each hot string goes on, to tell the other blocks
            _, keep = np.unique(grams[lone], return_index=True)
            lead = np.zeros(len(doc), bool)
            lead[lone[keep]] = True
            order = np.append(order[~hot], lone[keep])
        else:
            lead = np.zeros(len(doc), bool)
        to = (grams[order] % np.uint64(buckets)).astype(np.int64)
        order = order[np.lexsort((pos[order], doc[order], to))]
        cuts = np.searchsorted((grams[order] % np.uint64(buckets)).astype(np.int64), np.arange(buckets + 1))
        packed = []
        for k in range(buckets):
            i = order[cuts[k] : cuts[k + 1]]
            there, own = np.unique(doc[i], return_inverse=True)
            g, h = grams[i] // np.uint64(buckets), hashes[i]
            wide = "<u2" if len(there) < 1 << 16 else "<u4"
            packed.append(b"".join([np.array([len(i), len(there)], "<u4").tobytes(), there.astype("<i8").tobytes(), (g & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), (g >> np.uint64(32) & np.uint64(0xFF)).astype("u1").tobytes(), (h & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), (h >> np.uint64(32) & np.uint64(0xFFFF)).astype("<u2").tobytes(), own.astype(wide).tobytes(), pos[i].astype("<u4").tobytes(), count[i].astype(_width(least, gram)).tobytes(), np.packbits(lead[i]).tobytes()]))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(buckets, PACKED, np.int32)), pa.array(np.arange(buckets, dtype=np.int32)), pa.nulls(buckets, pa.int64()), pa.nulls(buckets, pa.list_(pa.int64())), pa.array(packed)], schema=_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        many = 0
        for batch in batches:
            for part in slices(batch, 1, _SLICE):
                data, offsets = flat(part.column(1))
                sums, grams, first, count = runs(data, offsets, least, gram)
                own = np.searchsorted(offsets, first, "right") - 1
                parts.append((grams, span_hashes(sums, first, first + count + least - 1), np.asarray(part.column(0))[own], first - offsets[own], count))
                many += len(first)
                if many >= _FLUSH:
                    yield from flush(parts)
                    parts, many = [], 0
        if many:
            yield from flush(parts)

    picked = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    return picked.mapInArrow(run, _KINDS)


def _settled(packed: DataFrame, least: int, gram: int, buckets: int, partitions: int) -> DataFrame:
    """Covered and open runs by document, after the runs of all blocks have met in their bucket."""

    def done(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = []
        for x in blobs:
            n, m = map(int, np.frombuffer(x, "<u4", 2))
            at = 8

            def read(kind: str, count: int) -> np.ndarray:
                nonlocal at
                out = np.frombuffer(x, kind, count, at)  # noqa: B023
                at += out.nbytes
                return out

            docs = read("<i8", m)
            g = read("<u4", n).astype(np.uint64) | read("u1", n).astype(np.uint64) << np.uint64(32)
            h = read("<u4", n).astype(np.uint64) | read("<u2", n).astype(np.uint64) << np.uint64(32)
            own, pos, count, flag = read("<u2" if m < 1 << 16 else "<u4", n), read("<u4", n), read(_width(least, gram), n), read("u1", -(-n // 8))
            parts.append((g, h, docs[own], pos.astype(np.int64), count.astype(np.int64), np.unpackbits(flag, count=n) > 0))
        g, h, doc, pos, count, flag = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(g):
            return
        # most strings have one run
        order = np.argsort(g)
        same = g[order][1:] == g[order][:-1]
        shared = order[np.append(same, False) | np.append(False, same)]
        if not len(shared):
            return
        g, h, doc, pos, count, flag = (x[shared] for x in (g, h, doc, pos, count, flag))
        rows, order, is_open, is_hot = _settle(g, h, doc, pos, count, flag, HOT)
        yield from rows
        mine = ~flag[order]  # a flagged run is open in its block already
        for kind, which in ((OPEN, is_open & ~is_hot & mine), (HOT_OPEN, is_open & is_hot & mine)):
            i = order[which]
            if len(i):
                yield _spans(kind, doc[i], pos[i], count[i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            kinds = np.asarray(batch.column(0))
            if (kinds != PACKED).any():
                yield batch.filter(pa.array(kinds != PACKED))
            some = batch.filter(pa.array(kinds == PACKED))
            for bucket, x in zip(some.column(1).to_pylist(), some.column(4).to_pylist(), strict=True):
                if bucket != now and held:
                    yield from done(held)
                    held = []
                now = bucket
                held.append(x)
        if held:
            yield from done(held)

    # rows that a block has settled need no bucket
    spread = packed.withColumn("bucket", F.coalesce("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")))
    return spread.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(run, _KINDS).drop("bucket", "packed")


def _with_spans(docs: DataFrame, spans: DataFrame, doc_id: str, text: str, how: str, limit: int = 64 << 20) -> DataFrame:
    """doc_id, text, spans: a broadcast join if all spans together are small, a shuffled one otherwise."""
    side = spans.withColumnRenamed("doc_id", "_id")
    size = spans.agg(F.sum(F.size("spans") * 8 + 64)).first()[0] or 0
    some = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return some.join(F.broadcast(side) if size <= limit else side, F.col("doc_id") == F.col("_id"), how).select("doc_id", "text", "spans")


def _open_bytes(open_runs: DataFrame, docs: DataFrame, doc_id: str, text: str, least: int, gram: int) -> DataFrame:
    """key, doc_id, pos, n, before, bytes of open runs, and of single windows for hot ones.

    Of equal hot windows in one block only those of the first document go on; the others are covered, and have no bytes.
    """
    coded = open_runs.select("doc_id", F.transform("spans", lambda x: F.shiftleft(x, 1).bitwiseOR(F.when(F.col("kind") == HOT_OPEN, 1).otherwise(0))).alias("spans"))
    spans = checkpoint(coded.groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans")))
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int64()), ("n", pa.int32()), ("before", pa.int32()), ("bytes", pa.binary())])

    def settled(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        key, doc, pos, n = (rows.column(c).to_numpy() for c in ("key", "doc_id", "pos", "n"))
        order = np.lexsort((doc, key))
        first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        late = np.zeros(len(key), bool)
        late[order] = doc[order] > np.repeat(doc[order][first], np.diff(np.append(first, len(key))))
        key = np.where(late, mix(doc.view(np.uint64)).view(np.int64), key)
        blobs = pc.if_else(pa.array(late), pa.scalar(None, pa.binary()), rows.column("bytes"))
        return pa.Table.from_arrays([pa.array(key), pa.array(doc), pa.array(pos), pa.array(n), rows.column("before"), blobs], schema=schema).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for rows, hot in windows(batches):
            yield rows.filter(pa.array(~hot))
            waiting.append(rows.filter(pa.array(hot)))
            if sum(map(len, waiting)) > HOT_ROWS:
                yield settled(waiting)
                waiting = []
        if any(map(len, waiting)):
            yield settled(waiting)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for batch in batches:
            for part in slices(batch, 1, _SLICE):
                data, offsets = flat(part.column(1))
                lists = part.column(2)
                code = np.asarray(lists.flatten())
                own = np.repeat(np.arange(len(part)), np.asarray(pc.list_value_length(lists)))
                hot, count, pos = (code & 1) > 0, (code >> 1 & (1 << _BITS) - 1) + 1, code >> _BITS + 1
                start = offsets[own] + pos
                ok = start + count + least - 1 <= offsets[own + 1]  # an id on several texts
                hot, count, pos, start, own = (x[ok] for x in (hot, count, pos, start, own))
                reps = np.where(hot, count, 1)
                shift = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
                hot, pos, start, own = np.repeat(hot, reps), np.repeat(pos, reps) + shift, np.repeat(start, reps) + shift, np.repeat(own, reps)
                count = np.where(hot, 1, np.repeat(count, reps))
                sums = prefix_sums(data)
                keys = span_hashes(sums, start, start + least)
                cold = np.flatnonzero(~hot)
                if len(cold):  # the string of the run's first window
                    for chunk in np.array_split(cold, -(-len(cold) // 20_000)):
                        places = start[chunk][:, None] + np.arange(least - gram + 1)
                        keys[chunk] = span_hashes(sums, places, places + gram).min(1)
                doc = np.asarray(part.column(0))[own]
                raw = data.tobytes()
                cut = [raw[a : a + n + least - 1] for a, n in zip(start.tolist(), count.tolist(), strict=True)]
                before = np.where(pos > 0, data[np.maximum(start - 1, 0)], 256 + doc % 2**20).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(doc), pa.array(pos), pa.array(count.astype(np.int32)), pa.array(before), pa.array(cut, pa.binary())], schema=schema), hot

    return _with_spans(docs, spans, doc_id, text, "inner").mapInArrow(run, "key long, doc_id long, pos long, n int, before int, bytes binary")


def _scanned(open_bytes: DataFrame, partitions: int, least: int) -> DataFrame:
    """doc_id, spans: what the suffix arrays of the parts show to repeat an earlier document."""

    def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ = pa.Table.from_batches(held)
        doc, pos, count, before = (all_.column(c).to_numpy() for c in ("doc_id", "pos", "n", "before"))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for length, lowest, which, place, _ in repeated_windows(all_.column("bytes").to_pylist(), count.astype(np.int64), before.astype(np.int64), doc, least):
            late = doc[which] > lowest
            if late.any():
                found.append((doc[which[late]], pos[which[late]] + place[late], np.full(late.sum(), length - least + 1)))
        if found:
            yield _spans(COVERED, *(np.concatenate(x) for x in zip(*found, strict=True))).select([2, 3])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            covered = batch.filter(pc.is_null(batch.column(5)))
            if len(covered):
                yield _spans(COVERED, *(np.asarray(covered.column(c)) for c in (1, 2, 3))).select([2, 3])
                batch = batch.filter(pc.is_valid(batch.column(5)))
            key = np.asarray(batch.column(0))
            while len(key):
                # a part ends between two keys
                room = max(0, PART - rows)
                ends = np.flatnonzero(np.append(key[1:] != key[:-1], False))
                cut = ends[np.searchsorted(ends, room)] + 1 if len(ends) and room <= ends[-1] else len(key)
                if held and rows >= PART and key[0] != held[-1].column(0)[-1].as_py():
                    yield from done(held)
                    held, rows = [], 0
                    continue
                held.append(batch.slice(0, cut))
                rows += cut
                batch, key = batch.slice(cut), key[cut:]
        if held:
            yield from done(held)

    return open_bytes.repartition(partitions, "key").sortWithinPartitions("key").mapInArrow(run, "doc_id long, spans array<long>")


def _ranges(spans: DataFrame, least: int) -> DataFrame:
    """doc_id, spans -> doc_id, spans: each document's bytes to remove, as sorted disjoint [start, end, start, ...]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = []
            for code in batch.column(1).to_pylist():
                code = np.sort(np.array(code, np.int64))
                start, end = code >> _BITS, (code >> _BITS) + (code & (1 << _BITS) - 1) + least
                reach = np.maximum.accumulate(end)
                first = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
                merged.append(np.stack([start[first], np.append(reach[first[1:] - 1], reach[-1])], 1).ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(merged, pa.list_(pa.int64()))], ["doc_id", "spans"])

    grouped = spans.groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return grouped.mapInArrow(run, "doc_id long, spans array<long>")


def repeated_spans(docs: DataFrame, least: int = LEAST, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans (start, end, start, ...; bytes): what each document repeats of one with a smaller doc_id.

    A byte is in a span if a string of `least` bytes that covers it also starts in a document with a smaller id.
    Documents without such bytes have no row, nor have null ids, which have no order; texts of one id don't repeat
    each other. Other columns of docs aren't read.
    """
    if not 1 <= gram <= least < gram + (1 << _BITS):
        raise ValueError(f"strings of {gram} bytes don't suit passages of {least}")
    spark = docs.sparkSession
    bounded_batches(spark)
    partitions = shuffle_partitions(spark)
    buckets = max(64, 2 * partitions)
    known = checkpoint(_settled(_packed_runs(docs, doc_id, text, least, gram, buckets), least, gram, buckets, partitions))
    later = _scanned(_open_bytes(known.filter(f"kind in ({OPEN}, {HOT_OPEN})"), docs, doc_id, text, least, gram), partitions, least)
    return checkpoint(_ranges(known.filter(f"kind = {COVERED}").select("doc_id", "spans").union(later), least))


def remove_repeats(docs: DataFrame, least: int = LEAST, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text", with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, binary, if with_kept) for each row of docs.

    Null texts are empty, very long ones are read whole, an empty table gives no rows. Rows with a null doc_id lose nothing. Repeated rows are treated alike. What remains may
    not be valid UTF-8, as bytes are removed, so kept is binary.
    """
    spans = repeated_spans(docs, least, gram, doc_id, text)
    kind = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw, cuts = (x or "").encode(), cuts or []
                edges = [0, *cuts, len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((len(raw), len(raw) - len(kept), len(cuts) // 2, hashlib.sha256(kept).hexdigest(), kept))
            made = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array(v, k) for v, k in zip(made, kinds, strict=True)][: 4 + with_kept]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_kept])

    return _with_spans(docs.withColumn(doc_id, F.col(doc_id).cast("long")), spans, doc_id, text, "left").mapInArrow(run, kind)
