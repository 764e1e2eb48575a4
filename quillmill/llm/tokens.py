"""Packing token sequences by attention cost.

Documents become token ids with an end id. Full sequences are cut off first; the rests are packed by descending
cost, linear plus quadratic in the length, each to the sequence with the lowest cost so far that has capacity left.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillmill.llm.base import bounded_batches, slices

CAPACITY = 1024
#: Attention cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 4096, 1
END = 0
#: Tokens that are packed together; more only lessens the number of short last sequences.
BLOCK_TOKENS = 2_000_000
_SLICE = 1 << 20
#: Text in which both libraries' patterns see the same classes of characters; other text goes to the tokenizer itself.
_PLAIN = re.compile("[^\x00-ſ‐-‧]|<\\|")


def encoder(vocabulary: str, ranks: str, pattern: str) -> Callable[[list[str]], list[np.ndarray]]:
    """A function from texts to ids of the tokenizer file `vocabulary`.

    ranks is the same vocabulary in the form that the quicker library reads; it is used where both give equal ids.
    """
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary)
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    quick = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(texts: list[str]) -> list[np.ndarray]:
        return [np.array(whole.encode(x, add_special_tokens=False).ids if _PLAIN.search(x) else quick.encode_ordinary(x), "<u4") for x in texts]

    return encode


def cost(n: int) -> int:
    return LINEAR * n + QUADRATIC * n * n


def pack_block(lengths: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(item, start, length, sequence, offset) of every piece of items of those lengths.

    All sequences are full but the last ones, whose lengths are the powers of two that make up what remains: so
    none needs padding. An item goes whole to the lowest-cost sequence if it fits there; else it fills that one and
    its rest goes to the next lowest. Equal costs are taken in the order of items and sequences.
    """
    pieces, sequence = [], 0
    rests = []
    for item, n in enumerate(lengths.tolist()):
        whole = n // capacity
        pieces += [(item, k * capacity, capacity, sequence + k, 0) for k in range(whole)]
        sequence += whole
        if n % capacity:
            rests.append((n % capacity, item, whole * capacity))
    total = sum(n for n, _, _ in rests)
    rooms = [capacity] * (total // capacity)
    rooms += [1 << k for k in range(capacity.bit_length(), -1, -1) if total % capacity >> k & 1]
    rests.sort(key=lambda x: (-x[0], x[1]))
    # a smaller sequence starts as if its missing room had been filled at cost
    heap = [(cost(capacity) - cost(room) if room < capacity else 0, k) for k, room in enumerate(rooms)]
    heapq.heapify(heap)
    used = [0] * len(rooms)
    for n, item, start in rests:
        while n:
            spent, k = heapq.heappop(heap)
            m = min(n, rooms[k] - used[k])
            pieces.append((item, start, m, sequence + k, used[k]))
            used[k] += m
            start, n = start + m, n - m
            if used[k] < rooms[k]:
                heapq.heappush(heap, (spent + cost(m), k))
    return pieces


def pack(docs: DataFrame, encoding: Callable[[], Callable[[list[str]], list[np.ndarray]]], capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost (and ids, little-endian, if with_ids).

    encoding is called once a task and gives the encoder. Each task packs its documents in blocks of BLOCK_TOKENS
    tokens (a longer document is a block of its own): nothing is shuffled, no task needs another's documents, and a
    sequence's id is its task's number and its place there, so a task that is run again gives the same rows. Null
    texts are empty: their only token is the end id. Repeated rows are packed each. An empty table gives no rows.
    Other columns of docs aren't read.
    """
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = StructType().add(picked.schema["doc_id"])
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost"):
        kind = kind.add(name, "long")
    if with_ids:
        kind = kind.add("ids", "binary")
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, first = encoding(), TaskContext.get().partitionId() << 40
        names: list[pa.Array] = []
        held: list[np.ndarray] = []
        tokens = 0

        def done() -> pa.RecordBatch:
            nonlocal first
            lengths = np.array([len(x) for x in held], np.int64)
            pieces = np.array(pack_block(lengths, capacity), np.int64).reshape(-1, 5)
            item, start, length, sequence, offset = pieces.T
            cut = [held[i][a : a + n].tobytes() for i, a, n in pieces[:, :3].tolist()]
            columns = [pa.concat_arrays(names).take(pa.array(item)), start, length, [zlib.crc32(x) for x in cut], lengths[item], sequence + first, offset, LINEAR * length + QUADRATIC * length * length]
            first += int(sequence.max()) + 1
            return pa.RecordBatch.from_arrays([pa.array(c) if not isinstance(c, pa.Array) else c for c in columns + [pa.array(cut, pa.binary())] * with_ids], schema=schema)

        for batch in batches:
            for part in slices(batch, 1, _SLICE):
                ids = encode([x or "" for x in part.column(1).to_pylist()])
                names.append(part.column(0))
                held += [np.append(x, np.uint32(END)).astype("<u4") for x in ids]
                tokens += sum(map(len, ids))
                if tokens >= BLOCK_TOKENS:
                    yield done()
                    names, held, tokens = [], [], 0
        if held:
            yield done()

    bounded_batches(docs.sparkSession)
    return picked.mapInArrow(run, kind)


def public_encoding() -> Callable[[list[str]], list[np.ndarray]]:
    """The public byte-level tokenizer of 50,257 ids."""
    import public_tokenizers

    path = public_tokenizers.path
    return encoder(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
