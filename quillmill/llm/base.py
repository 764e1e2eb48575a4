"""What the operators of this subpackage share: the checkpoint folder, checked broadcasts and byte kernels.

The kernels work on whole Arrow batches: the texts of a batch are one byte buffer with offsets, and words,
lines and windows are found by a few numpy passes over that buffer instead of a Python loop over characters.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import batches

#: The largest side that is broadcast, in bytes as estimated from its rows.
BROADCAST_BYTES = 64 << 20


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where that is unset, a folder of this machine is made for a local master, and a cluster is refused: its executors could not share one."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Write df to the cluster's checkpoint folder and read it from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_folder(spark: SparkSession) -> str:
    """A new folder's name in the shared folder."""
    return f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}"


def small_enough(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether df, whose rows take row_bytes at most, may be broadcast. It counts the rows."""
    return df.count() * row_bytes <= limit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- Arrow batches


def slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about `limit` bytes together, one row at least."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, null as empty, and the n + 1 offsets of the texts in them."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


# ---------------------------------------------------------------- hashing

_P, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits after which every bit depends on all."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        n = 1 << (n - 1).bit_length()
        for k, base in enumerate((_P, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, the same for equal bytes wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """The words (runs of bytes other than ASCII white space) of the texts of a buffer.

    starts, ends: their places in the buffer; first: n + 1 offsets of each text's words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        inside = ~SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[inner] = True
        edge[[0, -1]] = True
        places = np.flatnonzero(edge)
        begins = places[:-1][inside[places[:-1]]] if len(data) else places[:0]
        self.inside, self.starts = inside, begins
        self.ends = places[np.searchsorted(places, begins, "right")] if len(begins) else begins
        self.first = np.searchsorted(begins, offsets)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return span_hashes(prefix_sums(data), self.starts, self.ends)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n consecutive items from each place; those of the last n - 1 places are left out."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out *= np.uint64(_P)
        out += hashes[k : len(hashes) - n + 1 + k]
    return mix(out)


def bounded_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """As in batches.py; operators that work on whole batches take larger ones."""
    batches.bounded_batches(spark, size)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> node, root: the smallest node that each node reaches; only nodes with edges.

    In each round a node takes the least label among its neighbours' and its label's own label, so paths halve. A
    round is one join and one aggregation, and is written out; only a sum of hashes comes to the driver.
    """
    plain = edges.select("a", "b").filter("a <> b")
    both = plain.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
    both = checkpoint(both.select("e.a", "e.b").distinct())
    labels, before = checkpoint(both.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), F.least("a", "root").alias("root"))), None
    while True:
        now = labels.agg(F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()[0]
        if now == before:
            return labels
        before = now
        steps = both.union(labels.select(F.col("node").alias("a"), F.col("root").alias("b")))
        labels = checkpoint(steps.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("root")).select(F.col("a").alias("node"), "root"))
