"""Packing and mixing."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quillmill.llm import mixing, tokens


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoder_gives_the_tokenizers_ids(whole):
    encode, rng = tokens.public_encoding(), random.Random(1)
    signs = [*"ab é\n\t.,'’1²", "\x85", "\xa0", "\x1c", "  ", "<|endoftext|>", "漢", "😀", "ß", " the", "'s"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(2000)]
    for x, ids in zip(texts, encode(texts), strict=True):
        assert ids.tolist() == whole.encode(x, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(5))
def test_block_is_packed_without_gaps_or_padding(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 5000 if seed % 2 else 60, 300)
    pieces = tokens.pack_block(lengths, 1024)
    covered, used = defaultdict(list), defaultdict(list)
    for item, start, n, sequence, offset in pieces:
        covered[item].append((start, n))
        used[sequence].append((offset, n))
    for groups, totals in ((covered, None), (used, True)):
        for k, spans in groups.items():
            end = 0
            for at, n in sorted(spans):
                assert at == end and n > 0
                end += n
            if totals:
                assert end <= 1024 and end & (end - 1) == 0
            else:
                assert end == lengths[k]


def test_costs_are_balanced():
    pieces = tokens.pack_block(np.random.default_rng(3).integers(1, 1023, 2000), 1024)
    costs = Counter()
    for _, _, n, sequence, _ in pieces:
        costs[sequence] += tokens.cost(n)
    full = sorted(costs.values())[20:]
    assert max(full) < 1.3 * min(full)


def check_packed(rows, texts, whole):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    wanted = defaultdict(Counter)
    for i, x in texts:
        ids = np.array([*whole.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        wanted[i][len(ids)] += len(ids)
        got = sorted((r.start, r.length, r.ids_crc32) for r in by_doc[i] if r.doc_tokens == len(ids))
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in got)
    for i, counts in wanted.items():
        assert Counter({n: sum(r.length for r in by_doc[i] if r.doc_tokens == n) for n in counts}) == counts
    for spans in by_sequence.values():
        end = 0
        for at, n in sorted(spans):
            assert at == end
            end += n
        assert end <= 1024


def test_pack(spark, documents, odd, odd_rows, clashing, empty, whole):
    check_packed(tokens.pack(documents, tokens.public_encoding).collect(), [(r.doc_id, r.text) for r in documents.collect()], whole)
    check_packed(tokens.pack(odd, tokens.public_encoding).collect(), [(r[0], r[1]) for r in odd_rows], whole)
    assert tokens.pack(clashing, tokens.public_encoding).count() == tokens.pack(odd, tokens.public_encoding).count()
    assert tokens.pack(empty, tokens.public_encoding).count() == 0


def test_ids_come_with_the_pieces(documents, whole):
    rows = tokens.pack(documents.filter("doc_id < 5"), tokens.public_encoding, with_ids=True).orderBy("doc_id", "start").collect()
    text = next(r.text for r in documents.filter("doc_id = 3").collect())
    ids = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in rows if r.doc_id == 3])
    assert whole.decode(ids[:-1].tolist()) == text


def fill(sizes, weights, most):
    """Targets by resharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, out, free = sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    rest = float(total)
    while free and rest > 1e-9:
        share = rest / sum(weight[s] for s in free)
        for s in sorted(free, key=str):
            out[s] += share * weight[s]
        over = {s for s in free if out[s] >= most * sizes[s]}
        rest = sum(out[s] - most * sizes[s] for s in over)
        for s in over:
            out[s] = most * sizes[s]
        free -= over
        if not over:
            break
    return out


def size(x):
    return len(re.findall(r"[^\x20\x09-\x0D]+", x or ""))


def check_mixed(rows, texts):
    sizes = Counter()
    for _, x, source in texts:
        sizes[source] += size(x)
    goal = fill(dict(sizes), (5, 2, 1), 3.0)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size) for r in rows) == sorted((i if i is not None else -1, size(x)) for i, x, _ in texts)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        assert any(sizes[s] == r.source_size and abs(goal[s] - r.target) < 1e-6 * max(1, r.target) for s in sizes)
    return sizes, goal


def test_mix(spark, sf_dir, documents, odd, odd_rows, clashing, empty):
    big = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet")
    rows = mixing.mix_plan(big).collect()
    check_mixed(rows, [(r.doc_id, r.text, r.source) for r in big.collect()])
    taken, target = Counter(), {}
    for r in rows:
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
    assert all(abs(taken[k] - target[k]) <= 0.05 * target[k] for k in target)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_plan(big.repartition(5)).collect()))
    check_mixed(mixing.mix_plan(odd).collect(), [(r[0], r[1], r[3]) for r in odd_rows])
    assert mixing.mix_plan(empty).count() == 0 and mixing.mix(empty).count() == 0
    plan = mixing.mix_plan(odd).collect()
    mixed = mixing.mix(clashing)
    assert mixed.columns == clashing.columns and mixed.count() == sum(r.copies for r in plan)


def test_many_sources_are_joined_with_salt(monkeypatch, odd):
    wanted = sorted(map(str, mixing.mix_plan(odd).collect()))
    monkeypatch.setattr(mixing, "small_enough", lambda *a: False)
    assert sorted(map(str, mixing.mix_plan(odd).collect())) == wanted
