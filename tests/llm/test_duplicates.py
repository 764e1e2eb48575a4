"""The Jaccard join, repeated passages, fingerprints and revisits against brute force."""

import gzip
import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from quillmill.llm import base, fingerprints, jaccard, repeats, revisits
from quillmill.llm import warc as archive


def shingles(x):
    w = (x or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(texts):
    """(doc_id, set size, smallest reachable id) by comparing all pairs that share a shingle."""
    sets, holders, up = [shingles(x) for _, x in texts], defaultdict(list), list(range(len(texts)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for k, own in enumerate(sets):
        common = Counter(j for s in own for j in holders[s])
        for j, n in common.items():
            if texts[k][0] is not None and texts[j][0] is not None and 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                up[root(k)] = root(j)
        for s in own:
            holders[s].append(k)
    low = {}
    for k, (i, _) in enumerate(texts):
        low[root(k)] = min(low.get(root(k), i), i) if i is not None and low.get(root(k), i) is not None else i
    return sorted((i, len(sets[k]), low[root(k)] if sets[k] else i) for k, (i, _) in enumerate(texts) if i is not None)


def found(docs):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect() if r.doc_id is not None)


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else w + "x" for w in words)


@pytest.fixture(scope="module")
def families(spark):
    """Texts with copies edited more and less, small ones, and a passage that many share."""
    rng, texts = random.Random(5), []
    passage = " ".join(f"p{k}" for k in range(60))
    for family in range(25):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 5, 8, 20, 60, 150, 400]))]
        texts += [edited(rng, words, rng.choice([0, 0.005, 0.02, 0.04, 0.06])) for _ in range(8)]
    texts += [passage + " " + " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(5, 40))) for _ in range(60)]
    rng.shuffle(texts)
    rows = [(1000 - 3 * k, x) for k, x in enumerate(texts)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_join_finds_every_link(families):
    rows, docs = families
    assert found(docs) == components(rows)


def test_large_groups_are_searched_exactly(families, monkeypatch):
    rows, docs = families
    for name, value in (("GROUP", 2), ("BLOCK", 7), ("CELL", 3), ("BLOCK_BYTES", 4000)):
        monkeypatch.setattr(jaccard, name, value)
    assert found(docs) == components(rows)


def test_large_groups_stay_large_if_their_lead_is_in_two_blocks(spark):
    words, scheme = [f"w{k}" for k in range(300)], jaccard.Scheme()
    texts = [" ".join([*words[:k], "x", *words[k + 1 :]]) for k in range(0, 300, 10)]
    sets = {x: next(jaccard.shingle_sets(*base.flat(pa.array([x])), 5)) for x in texts}
    lead, *others = sorted(texts, key=lambda x: jaccard.node_of(sets[x]))
    first, second = [lead, *others[:-4]], [lead, *others[-4:]]
    holders = defaultdict(set)
    for x in first:
        for sig in scheme.signatures(sets[x]).tolist():
            holders[sig].add(jaccard.node_of(sets[x]))
    wanted = set()
    for x in second:
        for sig in scheme.signatures(sets[x]).tolist():
            if len(holders[sig]) > jaccard.GROUP:
                wanted.add((int(jaccard._label(np.array([sig], np.uint64) // np.uint64(64), sig % 64)[0]), jaccard.node_of(sets[x])))
    blocks = [jaccard._signed(spark.createDataFrame([(k, x) for k, x in enumerate(b)], "doc_id long, text string").coalesce(1), "doc_id", "text", 5, scheme, 64) for b in (first, second)]
    assert any(node != jaccard.node_of(sets[lead]) for _, node in wanted)
    for a, b in (blocks, blocks[::-1]):
        rows = jaccard._gathered(a.union(b), scheme, 1).filter(f"kind = {jaccard.HOLDER}").collect()
        assert wanted <= {(r.a, r.b) for r in rows}


def test_join_of_documents(documents, odd, odd_rows, clashing, empty):
    assert found(documents) == components([(r.doc_id, r.text) for r in documents.collect()])
    wanted = sorted(x for x in components([(r[0], r[1]) for r in odd_rows]))
    assert found(odd) == wanted and found(clashing) == wanted
    assert jaccard.near_duplicates(odd).filter("doc_id is null and component_id is not null").count() == 0
    assert jaccard.near_duplicates(empty).count() == 0
    kept = jaccard.one_of_each(clashing)
    assert kept.columns == clashing.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "5", "7", "8", "9", "None", "None"])


@pytest.mark.parametrize("n", [5, 6, 9, 17, 40, 200, 777])
def test_similar_sets_share_a_signature(n):
    rng, scheme, t = np.random.default_rng(n), jaccard.Scheme(), Fraction(4, 5)
    for _ in range(30):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = rng.integers(0, n // 5 + 1)
        add = rng.integers(0, n // 5 + 1)
        b = np.unique(np.append(rng.permutation(a)[drop:], rng.integers(0, 2**63, add).astype(np.uint64)))
        common = len(np.intersect1d(a, b))
        if common * 5 >= 4 * (len(a) + len(b) - common):
            same = np.intersect1d(scheme.signatures(a), scheme.signatures(b))
            assert len(same)
            x, y = (np.frombuffer(jaccard.parity(s), np.uint8) for s in (a, b))
            length = min(len(x), len(y))
            least = int(np.bitwise_count(jaccard.folded(x, length) ^ jaccard.folded(y, length)).sum())
            assert jaccard.may_be_similar(least, len(a) + len(b), t) and least <= len(a) + len(b) - 2 * common


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 150)] + [(7, 7)]
    got = {r.node: r.root for r in base.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 150)}
    assert base.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- repeated passages


def removed(texts, least=50):
    owners = {}
    for i, x in texts:
        raw = (x or "").encode()
        for p in range(len(raw) - least + 1) if i is not None else ():
            w = raw[p : p + least]
            owners[w] = min(owners.get(w, i), i)
    out = []
    for i, x in texts:
        raw = (x or "").encode()
        mark = bytearray(len(raw))
        for p in range(len(raw) - least + 1) if i is not None else ():
            if owners[raw[p : p + least]] < i:
                mark[p : p + least] = b"\1" * least
        kept = bytes(b for b, m in zip(raw, mark, strict=True) if not m)
        out.append((-1 if i is None else i, len(raw), len(raw) - len(kept), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def cut(docs, **lengths):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs, **lengths).collect())


@pytest.fixture(scope="module")
def passages(spark):
    rng = random.Random(11)
    pool = ["".join(rng.choice("abc é") for _ in range(rng.choice([49, 50, 51, 80, 200]))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh \n") for _ in range(rng.randrange(60))) for _ in range(rng.randrange(6))]
        x = "".join(parts)
        at = rng.randrange(len(x) + 1)
        rows.append((rng.randrange(10**6), x[at:] + x[:at] if rng.random() < 0.3 else x))
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def test_repeats_are_removed(passages):
    rows, docs = passages
    assert cut(docs) == removed(rows)


def test_hot_strings_are_dealt_by_window(passages, monkeypatch):
    rows, docs = passages
    monkeypatch.setattr(repeats, "HOT_BLOCK", 1)
    monkeypatch.setattr(repeats, "HOT", 2)
    monkeypatch.setattr(repeats, "_FLUSH", 10)
    monkeypatch.setattr(repeats, "HOT_ROWS", 7)
    monkeypatch.setattr(repeats, "PART", 20)
    assert cut(docs) == removed(rows)


@pytest.mark.parametrize(("least", "gram"), [(30, 8), (200, 24), (600, 24), (20, 20)])
def test_other_lengths(passages, documents, least, gram):
    rows, docs = passages
    assert cut(docs, least=least, gram=gram) == removed(rows, least)
    rng = random.Random(least)
    long = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    rows = [(k, "".join(rng.choice("xyz ") for _ in range(9 * k)) + long[37 * k : 37 * k + 900]) for k in range(12)]
    assert cut(docs.sparkSession.createDataFrame(rows, "doc_id long, text string"), least=least, gram=gram) == removed(rows, least)


def test_lengths_that_do_not_suit(documents):
    for least, gram in ((10, 11), (70_000, 24), (50, 0)):
        with pytest.raises(ValueError, match="passages"):
            repeats.remove_repeats(documents, least, gram)


def test_repeats_of_documents(spark, documents, odd, odd_rows, clashing, empty):
    assert cut(documents) == removed([(r.doc_id, r.text) for r in documents.collect()])
    wanted = removed([(r[0], r[1]) for r in odd_rows])
    assert cut(odd) == wanted and cut(clashing) == wanted and cut(empty) == []
    long = ("ab" * 40 + "c" * 90) * 3
    rows = [(3, long), (2, long[5:]), (1, "x" * 49), (0, "y" * 500)]
    assert cut(spark.createDataFrame(rows, "doc_id int, text string")) == removed(rows)
    kept = repeats.remove_repeats(documents, with_kept=True).filter("n_removed > 0").first()
    assert hashlib.sha256(bytes(kept.kept)).hexdigest() == kept.kept_sha256


def test_intervals_are_all_maximal_repeats():
    rng = random.Random(2)
    for _ in range(40):
        x = "".join(rng.choice("ab") for _ in range(rng.randrange(2, 40))).encode()
        suffixes = sorted(range(len(x)), key=lambda i: x[i:])
        common = [0] + [len(next(iter([x[a : a + n] for n in range(len(x), -1, -1) if x[a : a + n] == x[b : b + n] and max(a, b) + n <= len(x)]))) for a, b in zip(suffixes, suffixes[1:], strict=False)]
        left = np.array([x[i - 1] if i else 256 for i in suffixes])
        got = {(x[suffixes[a] : suffixes[a] + n], tuple(sorted(suffixes[a : b + 1]))) for a, b, n, maximal in repeats.intervals(np.array(common), left, 1) if maximal}
        wanted = set()
        for n in range(1, len(x)):
            for s in {x[i : i + n] for i in range(len(x) - n + 1)}:
                at = [i for i in range(len(x) - n + 1) if x[i : i + n] == s]
                if len(at) > 1 and len({x[i - 1] if i else 256 for i in at}) > 1 and len({x[i + n] if i + n < len(x) else 300 + i for i in at}) > 1:
                    wanted.add((s, tuple(at)))
        assert got == wanted


# ---------------------------------------------------------------- fingerprints


def test_entropies():
    rng = np.random.default_rng(1)
    x = np.append(rng.integers(97, 100, 3000), rng.integers(0, 256, 3000)).astype(np.uint8)
    e, w = fingerprints.entropies(x), fingerprints.WINDOW
    for k in rng.integers(0, len(x) - w, 200):
        h = -sum(c / w * math.log2(c / w) for c in Counter(x[k : k + w].tolist()).values())
        assert abs(e[k] - h / math.log2(w) * (fingerprints.STEPS - 1)) <= 1.01


def test_features_do_not_depend_on_the_batch(documents):
    texts = [r.text for r in documents.limit(60).collect()] + ["", "short", "x" * 500]
    rank = fingerprints.ranks(fingerprints.entropy_counts(documents))
    together = fingerprints.chains(*fingerprints.features(*base.flat(pa.array(texts)), rank), len(texts))
    for x, chain in zip(texts, together, strict=True):
        alone = fingerprints.chains(*fingerprints.features(*base.flat(pa.array([x])), rank), 1)[0]
        assert (alone == chain).all() and (fingerprints.decoded(fingerprints.encoded(chain)) == chain).all()
        assert fingerprints.likeness(chain, chain) == 1.0


@pytest.mark.parametrize(("window", "span", "least"), [(32, 32, 8), (8, 4, 1)])
def test_popular_windows(documents, window, span, least):
    texts = [r.text for r in documents.limit(12).collect()] + ["", "short", "eight by", "x" * 90, "ab" * 60]
    texts = [x.encode()[:700].decode(errors="ignore") for x in texts]
    rank = fingerprints.ranks(fingerprints.entropy_counts(documents))[int(window == 8)]
    owners, places, _ = fingerprints._popular(*base.flat(pa.array(texts)), rank, window, span, least)
    expected, start = [], 0
    for i, x in enumerate(map(str.encode, texts)):
        own = [rank[k] for k in fingerprints.entropies(np.frombuffer(x, np.uint8), window)]
        wins = Counter(min(range(k, k + span), key=lambda j: (own[j], j)) for k in range(len(own) - span + 1))
        found = sorted(j for j, n in wins.items() if n >= least and own[j] < fingerprints.STEPS)
        if not found and own:
            found = [min(range(len(own)), key=lambda j: (own[j], j))]
        expected += [(i, start + j) for j in found]
        start += len(x)
    assert sorted(zip(owners.tolist(), places.tolist(), strict=True)) == expected


def test_short_texts_are_like_their_edits(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmnoprstu", k=rng.randrange(1, 10))) for _ in range(1 + i % 20))) for i in range(300)]
    near = {r.doc_id: r for r in fingerprints.compare_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(near[i].near_edited > 0 for i, x in rows if len(x) >= 40) and np.mean([near[i].near_edited for i, x in rows if len(x) >= 40]) > 0.3
    assert max(r.near_next for r in near.values()) < 0.4


def test_buckets_change_no_result(spark, documents, odd, monkeypatch):
    for docs in (documents, odd):
        default = sorted(map(str, fingerprints.compare_next(docs).collect()))
        monkeypatch.setattr(fingerprints, "TASK_BYTES", 1 << 11)
        monkeypatch.setattr(fingerprints, "MOST_BUCKETS", 200)
        assert sorted(map(str, fingerprints.compare_next(docs).collect())) == default
        monkeypatch.undo()


def neighbours(texts):
    """(id, text, next text) in descending order of ids."""
    order = sorted(texts, key=lambda r: -r[0])
    return [(i, x or "", order[(k + 1) % len(order)][1] or "") for k, (i, x) in enumerate(order)]


def test_next_documents(spark, documents, odd, clashing, empty):
    rows = {r.doc_id: r for r in fingerprints.compare_next(documents).collect()}
    for i, x, y in neighbours([(r.doc_id, r.text) for r in documents.collect()]):
        n = len(x)
        made = x[: n - n // 2] + y[: n // 2]
        assert (rows[i].n_chars, rows[i].edited_sha256) == (n, hashlib.sha256(made.encode()).hexdigest())
        assert 0 <= rows[i].near_next <= 1 and 0 <= rows[i].near_edited <= 1
    near = [r.near_edited for r in rows.values()]
    assert np.mean(near) > 0.4 and np.mean(np.array(near) > 0.2) > 0.95 and np.mean([r.near_next for r in rows.values()]) < 0.1
    assert fingerprints.compare_next(odd).count() == odd.count() == fingerprints.compare_next(clashing).count()
    assert fingerprints.compare_next(empty).count() == 0 and fingerprints.fingerprint(empty).count() == 0
    one = fingerprints.compare_next(spark.createDataFrame([(7, "lonely text " * 20)], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.n_chars == 240
    equal = fingerprints.fingerprint(odd).filter("doc_id in (5, 6)").select("fingerprint").distinct()
    assert equal.count() == 1 and fingerprints.fingerprint(odd).filter("doc_id in (1, 2)").select("fingerprint").distinct().first()[0] == ""


# ---------------------------------------------------------------- revisits

RECORDS = "record_id long, url string, ts long, revisit boolean, etag string, last_modified string, headers map<string,string>, digest string"


def resolved(records):
    """Each revisit's response by looking at all records."""
    key = {}
    for r in records:
        key[r[1]] = None if r[1] is None else re.sub(r"^(https?://)?(www[.])?|#.*$|/$", "", r[1].lower())
    out = []
    for r in records:
        if not r[3]:
            continue
        earlier = [s for s in records if not s[3] and key[s[1]] is not None and key[s[1]] == key[r[1]] and None not in (s[2], r[2]) and s[2] <= r[2]]
        best = max(earlier, key=lambda s: (s[2], s[0]), default=None)
        if best is None:
            out.append((r[0], None, "no response", None))
            continue
        both = [(a, b) for a, b in ((r[4], best[4]), (r[5], best[5])) if None not in (a, b)]
        ok = bool(both) and all(a == b for a, b in both)
        out.append((r[0], best[0], "resolved" if ok else "mismatch", best[7] if ok else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("buckets", [2, 64])
def test_revisits(spark, buckets):
    rng = random.Random(buckets)
    urls = ["http://a.b/x", "https://www.A.b/x#top", "a.b/x/", "http://c.d/", "http://e.f/q", None]
    records = []
    for k in range(800):
        revisit = rng.random() < 0.5
        url = "http://a.b/x" if rng.random() < 0.4 else rng.choice(urls)
        records.append((k, url, rng.randrange(300) if rng.random() < 0.97 else None, revisit, rng.choice(["1", "2", None]), rng.choice(["m", "n", None]), {"etag": "e"}, None if revisit else f"d{k}"))
    got = revisits.resolve(spark.createDataFrame(records, RECORDS).repartition(6), buckets)
    assert sorted(((r.record_id, r.response_id, r.status, r.digest) for r in got.collect()), key=str) == resolved(records)


def test_headers_are_merged(spark):
    records = [
        (1, "http://a.b/x?utm_source=f&k=1", 1, False, "t", None, {"content-type": "html", "date": "old", "server": "s"}, "d"),
        (2, "https://WWW.a.b:443/x?k=1#p", 2, True, "t", None, {"date": "new", "content-length": "0", "expires": "soon"}, None),
        (3, "a.b/x?k=1", 3, True, "t", None, None, None),
    ]
    got = {r.record_id: r for r in revisits.resolve(spark.createDataFrame(records, RECORDS)).collect()}
    assert got[2].headers == {"content-type": "html", "server": "s", "date": "new", "expires": "soon"}
    assert got[3].status == "resolved" and got[3].headers == records[0][6]
    assert revisits.resolve(spark.createDataFrame([], RECORDS)).count() == 0
    assert revisits.resolved_pages(spark.createDataFrame([(1, None, None), (2, "a", None)], "page_id long, url string, html string")).count() == 4


def test_repeated_records_and_clashing_columns(spark):
    records = [(1, "a.b/x", 1, False, "t", None, {"date": "old"}, "d"), (1, "a.b/x", 1, False, "t", None, {"date": "old"}, "d"), (2, "a.b/x", 2, True, "t", None, {}, None), (2, "a.b/x", 2, True, "t", None, {}, None)]
    made = spark.createDataFrame(records, RECORDS).select("*", *[F.lit("x").alias(c) for c in ("bucket", "response", "near", "far", "_url", "_bucket", "status", "url_key", "of")])
    assert [(r.record_id, r.response_id, r.status) for r in revisits.resolve(made).collect()] == [(2, 1, "resolved")] * 2


URLS = {
    "http://a.b/x&y": "a.b/x&y", "a.b/x?utm_source=f&b=2&a=1": "a.b/x?a=1&b=2", "a.b/x?a=1&b=2#t": "a.b/x?a=1&b=2", "A.B/%7euser/%c3%a9/%zz%4": "a.b/~user/%C3%A9/%zz%4",
    "a.b/x/?": "a.b/x", "a.b/?utm_x=1": "a.b", "a.b/x?utm_medium=q": "a.b/x", "https://www.a.b:443/x?&&k": "a.b/x?k", None: None, "": "", "a.b?x=/": "a.b?x=/",
}


def test_canonical_urls(spark):
    df = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)], "k int, u string")
    assert [r[0] for r in df.orderBy("k").select(revisits.canonical_url(F.col("u"))).collect()] == list(URLS.values())


def warc(kind, k, url, date, http, more=""):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{k}>\r\nWARC-Target-URI: {url}\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha1:{k}\r\n{more}Content-Length: {len(http)}\r\n\r\n"
    return (head + http + "\r\n\r\n").encode()


def test_archive_files(spark, tmp_path):
    profile = "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/server-not-modified\r\n"
    parts = [
        b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nx: y\r\n\r\n",
        warc("response", 1, "http://a.b/x", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nETag: \"t\"\r\nDate: old\r\nContent-Type: text/html;\r\n charset=utf-8\r\n\r\n<p>caf\u00e9: 1\r\n\r\nmore</p>"),
        warc("request", 2, "http://a.b/x", "2024-01-01T00:00:01Z", "GET /x HTTP/1.1\r\n\r\n"),
        warc("response", 3, "http://a.b/x", "2024-01-01T12:00:00.123456Z", "HTTP/1.1 404 Not Found\r\nETag: \"u\"\r\n\r\n"),
        warc("revisit", 4, "http://a.b/x?utm_q=1", "2024-01-02T00:00:00Z", "HTTP/1.1 304 Not Modified\r\nEtag: \"t\"\r\nDate: new\r\n\r\n", profile),
        warc("revisit", 5, "http://c.d/", "2024-01-02T00:00:00Z", "HTTP/1.1 304 Not Modified\r\nETag: \"t\"\r\n\r\n", profile + "WARC-Refers-To-Target-URI: http://a.b/x\r\n"),
        warc("revisit", 6, "http://a.b/x", "2023-01-01T00:00:00Z", "HTTP/1.1 304 Not Modified\r\nETag: \"t\"\r\n\r\n", profile),
        warc("revisit", 7, "http://a.b/x", "2024-01-03T00:00:00Z", "", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
    ]
    (tmp_path / "one.warc").write_bytes(b"".join(parts))
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    for path in (tmp_path / "one.warc", tmp_path / "two"):
        got = revisits.resolve(archive.records(spark, str(path)))
        rows = {r.record_id[-2]: (r.response_id, r.status, r.headers, r.digest) for r in got.collect()}
        kept = {"etag": '"t"', "content-type": "text/html; charset=utf-8"}
        assert rows == {"4": ("<urn:uuid:1>", "resolved", kept | {"date": "new"}, "sha1:1"), "5": ("<urn:uuid:1>", "resolved", kept | {"date": "old"}, "sha1:1"), "6": (None, "no response", None, None)}
    (tmp_path / "none.warc").write_bytes(b"")
    assert archive.records(spark, str(tmp_path / "none.warc")).count() == 0
