"""Toxicity of deobfuscated text.

Words that look disguised (letters replaced by look-alikes, repeated, or spaced out) are lattices of what they may
stand for. A Viterbi search under a character trigram model of the corpus picks the likeliest reading; the readings
join the text's words. A logistic model over words and word beginnings scores the restored text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.base import Words, bounded_batches, flat, prefix_sums, slices, span_hashes

#: Labelled documents that the model is fitted on at most: those with the smallest hashes of their ids.
SAMPLE = 8000
#: Features of the model at most, those with the highest G-statistics; none under LEAST_G or in fewer than LEAST_N toxic texts.
FEATURES, LEAST_G, LEAST_N = 2000, 12.0, 3
#: Beginnings of words that count as features, in bytes.
BEGINNINGS = (4, 5, 6, 7)
CUT = 0.3
#: What a look-alike may stand for.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou"}
#: Costs, in nats, of a look-alike, of a letter for *, of dropping a sign, of dropping a separator, of taking a repeated letter once or twice.
LOOK, STAR, DROP, SEPARATOR, ONCE, TWICE = 1.0, 2.5, 6.0, 0.2, 0.5, 0.7
#: Costs of a space in a spaced-out token, each of which gives a reading.
GAPS = (-2.0, 0.0, 2.0)
CLASSES = 32
_SLICE = 1 << 20
_CLASS = np.zeros(256, np.int64)
_CLASS[np.arange(97, 123)] = np.arange(1, 27)
_CLASS[np.arange(65, 91)] = np.arange(1, 27)
_CLASS[128:192] = 27 + np.arange(64) % 5
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOKS if ord(c) < 128]] = True
_SIGN[[ord(c) for c in "._-"]] = True
_LOOK = _SIGN.copy()
_LOOK[[ord(c) for c in "._-"]] = False
_FIGURE = np.zeros(256, bool)
_FIGURE[48:58] = True
#: Signs around words, which are no part of them.
_AROUND = ".,;:?\"'()[]{}#%&*_-"
_EDGE = np.zeros(256, bool)
_EDGE[[ord(c) for c in _AROUND]] = True
_REPEATED, _GAP, _SPACED = re.compile(r"(.)\1{3,}", re.DOTALL), re.compile(r"\s+"), re.compile(r"(\S)(?: \1){3,}")
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[~_LETTER] = 32


# ---------------------------------------------------------------- the character model


def trigram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of character class trigrams of all texts, summed in each task, then by trigram; CLASSES ** 3 at most reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for part in slices(batch, 0, _SLICE):
                data, _ = flat(part.column(0))
                code = _CLASS[data[(data < 192)]]
                if len(code) > 2:
                    total += np.bincount((code[:-2] * CLASSES + code[1:-1]) * CLASSES + code[2:], minlength=CLASSES**3)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["trigram", "n"])

    bounded_batches(docs.sparkSession)
    out = np.zeros(CLASSES**3)
    for code, n in docs.select(F.col(text).cast("string")).mapInArrow(run, "trigram int, n long").groupBy("trigram").agg(F.sum("n")).collect():
        out[code] = n
    return out


def trigram_costs(counts: np.ndarray) -> np.ndarray:
    """-log of each class's probability after two others, backed by its share after one."""
    three = counts.reshape(CLASSES, CLASSES, CLASSES)
    two = three.sum(0) + 0.1
    two = two / two.sum(1, keepdims=True)
    return -np.log((three + 5 * two[None]) / (three.sum(2, keepdims=True) + 5))


def _class_of(c: str) -> int:
    return int(_CLASS[c.encode()[-1]])


def decode(token: str, costs: np.ndarray, gap: float = 0.0) -> str:
    """The likeliest reading of a lower-case token: the cheapest path through its lattice.

    States are the classes of the last two characters; each run of one character is a step. A space in the token stands
    for a space, which costs `gap`, or for nothing, a wider gap for a space.
    """
    steps, at = [], 0
    while at < len(token):
        c, end = token[at], at
        while end < len(token) and token[end] == c:
            end += 1
        n, at = end - at, end
        if c == " ":
            step = [(" ", gap), ("", 0.0)] if n == 1 else [(" ", 0.0)]
        elif c in LOOKS:
            price = STAR if c == "*" else LOOK
            step = [(x, price) for x in LOOKS[c]] + [("", DROP)]
            step += [(x * 2, price + TWICE) for x in LOOKS[c]] if n > 1 else []
        elif c.isalpha():
            step = [(c, 0.0)] if n == 1 else [(c * 2, TWICE if n > 2 else 0.0), (c, ONCE)]
        else:
            step = [("", SEPARATOR if not c.isalnum() else DROP)]
        steps.append([(word, [_class_of(x) for x in word], price) for word, price in step])
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for step in [*steps, [(" ", [0], 0.0)]]:
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (spent, path) in states.items():
            for word, classes, price in step:
                x, y, total = a, b, spent + price
                for z in classes:
                    total += costs[x, y, z]
                    x, y = y, z
                if (x, y) not in new or total < new[x, y][0]:
                    new[x, y] = total, (path, word)
        states = new
    path, words = min(states.values(), key=lambda s: s[0])[1], []
    while path:
        path, word = path
        words.append(word)
    return "".join(reversed(words)).strip()


def readings(token: str, costs: np.ndarray) -> list[str]:
    """The readings of a lower-case token: of one that is spaced out as one word, as words, and as what starts at each letter.

    More than three of a character are read as three. In a spaced-out token, gaps wider than its narrowest part words;
    the others may. Trigrams part words unsurely ("y oui diot"), so a word may begin at any of its letters: the
    beginnings that the model knows are found wherever they stand.
    """
    found = [decode(_REPEATED.sub(r"\1\1\1", "".join(token.split())), costs)]
    gaps = _GAP.findall(token)
    if gaps:
        least = min(map(len, gaps))
        words = _GAP.sub(lambda m: " " if len(m[0]) == least else "  ", token)
        words = _SPACED.sub(r"\1 \1 \1", words)
        found += [decode(words, costs, gap) for gap in GAPS]
        found += [found[0][k : k + BEGINNINGS[-1] + 1] for k in range(1, len(found[0]) - BEGINNINGS[0] + 1)]
    return found


def suspects(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of disguised words: texts' first and last bytes in the buffer, and for each whether it is spaced out."""
    n = len(data)
    letter, sign = _LETTER[data], _SIGN[data]
    flags = np.zeros(n, bool)
    if n > 2:
        flags[1:-1] |= letter[:-2] & sign[1:-1] & (letter[2:] | sign[2:])
        flags[1:-1] |= letter[1:-1] & (data[1:-1] == data[:-2]) & (data[1:-1] == data[2:])
        # a look-alike that ends a word, up to the signs around it
        flags[1:] |= _LOOK[data[1:]] & ~_EDGE[data[1:]] & (letter[:-1] | sign[:-1])
    first = words.starts
    flags[first] = False  # what stands before it is another word's or text's

    def count(x: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(x))
        return total[words.ends] - total[first]

    hit = count(flags) > 0
    # a sign that starts a word before a letter
    two = words.ends - first > 2
    hit[two] |= sign[first[two]] & letter[first[two] + 1]
    # two letters, or a word of three letters and look-alikes and nothing else that is no figure: 455 stays one
    look = _LOOK[data] & ~_EDGE[data]
    letters, looks = count(letter), count(look)
    told = letters + looks - count(look & _FIGURE[data])
    hit &= (letters >= 2) | ((told >= 1) & (letters + looks >= 3) & (count(letter | look | _EDGE[data]) == words.ends - first))
    # runs of three or more words of one character, of which most are letters
    width = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    single = (width[words.ends] - width[first] == 1) & (letter[first] | sign[first])
    owner = np.searchsorted(words.first, np.arange(len(first)), "right")
    edge = np.flatnonzero(np.append(True, (single[1:] != single[:-1]) | (owner[1:] != owner[:-1]))) if len(first) else np.zeros(0, np.int64)
    ends = np.append(edge[1:], len(first))
    spaced = single[edge] & (ends - edge >= 3) if len(edge) else np.zeros(0, bool)
    a, b = edge[spaced], ends[spaced] - 1
    starts = np.append(first[hit], first[a])
    return starts, np.append(words.ends[hit], words.ends[b]), np.append(np.zeros(hit.sum(), bool), np.ones(len(a), bool))


def restored(data: np.ndarray, offsets: np.ndarray, costs: np.ndarray, known: dict[str, list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """The texts with the readings of their disguised words at their ends. known keeps readings from call to call."""
    words = Words(data, offsets)
    starts, ends, _ = suspects(data, words)
    if not len(starts):
        return data, offsets
    raw = data.tobytes()
    owner = np.searchsorted(offsets, starts, "right") - 1
    more: dict[int, set[str]] = {}
    for i, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist(), strict=True):
        token = raw[a:b].decode("utf-8", "replace").lower().strip(_AROUND)
        found = known.get(token)
        if found is None:
            found = readings(token, costs)
            if len(token) <= 200:  # longer ones are hardly met again
                known[token] = found
            if len(known) > 200_000:
                known.clear()
        more.setdefault(i, set()).update(found)
    pieces, sizes = [], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        piece = raw[a:b] + (b" " + " ".join(sorted(more[i])).encode() if i in more else b"")
        pieces.append(piece)
        sizes.append(len(piece))
    return np.frombuffer(b"".join(pieces), np.uint8), np.append(0, np.cumsum(sizes))


# ---------------------------------------------------------------- features and the logistic model


def features(texts: pa.Array, costs: np.ndarray, known: dict[str, list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """The restored texts' features: owners and 64-bit hashes of whole words and of their beginnings, with repeats."""
    lowered = pc.utf8_lower(pc.fill_null(texts, ""))
    data, offsets = restored(*flat(lowered), costs, known)
    data = _BLANK[data]
    words, sums = Words(data, offsets), prefix_sums(data)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
    owners, hashes = [owner], [span_hashes(sums, words.starts, words.ends)]
    for n in BEGINNINGS:
        long = words.ends - words.starts > n
        owners.append(owner[long])
        hashes.append(span_hashes(sums, words.starts[long], words.starts[long] + n) ^ np.uint64(n))
    return np.concatenate(owners), np.concatenate(hashes)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


class Model:
    """Sorted feature hashes and their weights, a bias, and the character model."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, bias: float, costs: np.ndarray):
        self.hashes, self.weights, self.bias, self.costs = hashes, weights, bias, costs
        self.known: dict[str, list[str]] = {}

    def found(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Owners and numbers of the model's features in the texts, each pair once."""
        owner, hashes = features(texts, self.costs, self.known)
        if not len(self.hashes):
            return owner[:0], owner[:0]
        at = np.searchsorted(self.hashes, hashes).clip(max=len(self.hashes) - 1)
        hit = self.hashes[at] == hashes
        pairs = np.unique(owner[hit] * len(self.hashes) + at[hit])
        return pairs // len(self.hashes), pairs % len(self.hashes)

    def scores(self, texts: pa.Array) -> np.ndarray:
        owner, at = self.found(texts)
        return 1 / (1 + np.exp(-(self.bias + np.bincount(owner, self.weights[at], len(texts)))))


def logistic(owner: np.ndarray, feature: np.ndarray, label: np.ndarray, n: int, penalty: float = 0.1, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model with a squared penalty on the weights, by gradient steps with momentum."""
    weights, bias, speed, lift = np.zeros(n), float(np.log((label.sum() + 0.5) / (len(label) - label.sum() + 0.5))), np.zeros(n), 0.0
    count = np.bincount(feature, minlength=n) + 1.0  # steps by feature, as rare ones have small gradients
    many = max(1.0, np.bincount(owner, minlength=1).max() if len(owner) else 1.0)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(bias + np.bincount(owner, weights[feature], len(label)))))
        slope = np.bincount(feature, (p - label)[owner], n) + penalty * weights
        speed = 0.9 * speed - 2.0 / many * slope / (0.25 * count + penalty)
        lift = 0.9 * lift - 0.5 * (p - label).sum() / (0.25 * len(label))
        weights += 0.2 * speed
        bias += 0.2 * lift / many
    return weights, bias


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from labelled documents whose ids aren't held out, `sample` of them at most; the character model is of all texts.

    Without labels of either kind no feature is chosen, and every score is the share of toxic labels (a half without any).
    """
    costs = trigram_costs(trigram_counts(docs, text))
    rows = labels.filter("doc_id is not null and toxic is not null").filter(~held_out()).groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").alias("toxic"))
    rows = rows.orderBy(F.xxhash64("_id"), "_id").limit(sample)  # bounded, so it may be broadcast
    some = docs.filter(~held_out(doc_id)).join(F.broadcast(rows), F.col(doc_id) == F.col("_id")).select(F.col(text).cast("string").alias("text"), "toxic", F.xxhash64(doc_id, text).alias("key"))
    some = some.repartition(16, "key")

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            for part in slices(batch, 0, _SLICE):
                owner, hashes = features(part.column(0), costs, known)
                order = np.lexsort((hashes, owner))
                owner, hashes = owner[order], hashes[order]
                new = np.append(True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1]))[: len(owner)]
                toxic = np.asarray(part.column(1))[owner[new]] == 1
                value, at = np.unique(hashes[new], return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(np.bincount(at, toxic).astype(np.int64)), pa.array(np.bincount(at, ~toxic).astype(np.int64))], ["hash", "bad", "good"])

    bad, good = some.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first()
    if not bad or not good:
        share = (bad + 0.5) / (bad + good + 1)
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))), costs)
    share = bad / (bad + good)
    counted = some.mapInArrow(present, "hash long, bad long, good long").groupBy("hash").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    n = F.col("bad") + F.col("good")
    g = 2 * (F.col("bad") * F.log(F.col("bad") / (n * share)) + F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / (n * (1 - share)))).otherwise(0))
    chosen = counted.filter((F.col("bad") >= LEAST_N) & (F.col("bad") > n * share)).withColumn("g", g).filter(F.col("g") >= LEAST_G)
    top = [r["hash"] for r in chosen.orderBy(F.desc("g"), "hash").limit(FEATURES).select("hash").collect()]
    bare = Model(np.sort(np.array(top, np.int64).view(np.uint64)), np.zeros(len(top)), 0.0, costs)

    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, _SLICE):
                owner, at = bare.found(part.column(0))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(part) + 1)).astype(np.int32)), pa.array(at.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), lists], ["toxic", "key", "found"])

    kept = sorted((r["key"], r["toxic"], r["found"]) for r in some.mapInArrow(matrix, "toxic int, key long, found array<int>").collect())  # `sample` short rows
    owner = np.repeat(np.arange(len(kept)), [len(x) for *_, x in kept])
    weights, bias = logistic(owner, np.array([y for *_, x in kept for y in x], np.int64), np.array([t == 1 for _, t, _ in kept], float), len(top))
    return Model(bare.hashes, weights, bias, costs)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs. Null texts are empty and get the model's share of toxic texts without features.

    Very long texts are scored whole. Repeated rows and equal texts get equal scores. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights and CLASSES ** 3 costs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, _SLICE):
                s = shared.value.scores(part.column(2))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(s), pa.array((s >= CUT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    picked = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).cast("string").alias("text"))
    kind = picked.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    return picked.mapInArrow(run, kind)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """score() with a model fitted on docs and labels (doc_id, toxic): the whole operator.

    Labels of held-out ids are never read. Repeated rows get equal scores; an id labelled twice is toxic if either
    label says so. An empty table gives no rows. Other columns of docs and labels aren't read.
    """
    return score(docs, fit(docs, labels, sample, doc_id, text), doc_id, text)
