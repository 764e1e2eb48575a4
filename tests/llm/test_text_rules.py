"""Quality rules, licences, personal data and toxicity."""

import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from compare import connection, rows_of_query, rows_of_sql

from quillmill.llm import licences, pii, quality, queries, toxicity


def base_counts(x):
    x = x or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", x)
    seen, dup = set(), 0
    for line in x.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    found = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if found[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(covered)


def as_key(r):
    return (-1 if r[0] is None else r[0], *r[1:])


def test_quality(documents, labels, odd, odd_rows, clashing, empty):
    for docs, texts in ((documents, [(r.doc_id, r.text) for r in documents.collect()]), (odd, [(r[0], r[1]) for r in odd_rows])):
        rows = quality.quality(docs, labels).collect()
        got = sorted((as_key((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))) for r in rows)
        assert got == sorted(as_key((i, *base_counts(x))) for i, x in texts)
        for r in rows:
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert r.kept == (not r.base_failed and r.score >= quality.THRESHOLD)
    kept = quality.keep_quality(clashing, labels)
    assert kept.columns == clashing.columns and kept.count() == quality.quality(odd, labels).filter("kept").count()
    assert quality.quality(empty, labels).count() == 0 and quality.keep_quality(empty, labels).count() == 0
    assert quality.quality(odd, labels.limit(0)).filter("score <> 0").count() == 0


def test_scores_by_counting(documents, labels):
    raw, good, trusted = Counter(), Counter(), {r.doc_id for r in labels.filter("quality = 1").collect()}

    def grams(x):
        data = np.frombuffer(x.encode(), np.uint8)
        return [int(v) for v in quality._grams(data, np.array([0, len(data)]))[0]]

    texts = {r.doc_id: r.text for r in documents.collect()}
    for i, x in texts.items():
        raw.update(grams(x))
        if i in trusted:
            good.update(grams(x))
    ratio = quality.log_ratios(np.array([good[b] for b in range(quality.BUCKETS)], float), np.array([raw[b] for b in range(quality.BUCKETS)], float))
    for r in quality.quality(documents, labels).collect():
        values = [ratio[b] for b in grams(texts[r.doc_id])]
        assert r.score == pytest.approx(np.mean(values, dtype=float) if values else 0.0, abs=1e-6)


def test_all_trusted_texts_are_counted(spark, monkeypatch):
    n = 20_500
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality")
    assert quality.trusted_texts(docs, labels).count() == n
    whole = quality.gram_counts(docs)
    assert (quality.gram_counts(quality.trusted_texts(docs, labels)) == whole).all()
    monkeypatch.setattr(quality, "small_enough", lambda *_: False)
    assert (quality.gram_counts(quality.trusted_texts(docs, labels.union(labels))) == whole).all()


def test_junk_is_rejected_and_clean_text_kept(spark, sf_dir):
    at = sf_dir.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{at}/labels.parquet")
    rows = quality.quality(spark.read.parquet(f"{at}/documents.parquet"), labels).filter("not base_failed").join(labels, "doc_id").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert np.mean([r.kept for r in rows if r.quality == 0]) < 0.1


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, sf_dir, name):
    assert rows_of_query(queries.QUERIES[name](spark, sf_dir)) == rows_of_sql(connection(sf_dir), queries.ORACLES[name])


def test_published_licences_in_any_wrapping(spark):
    got = {r.doc_id: (r.licence or "", r.wanted) for r in licences.scanned_variants(spark).collect()}
    assert all(a == b for a, b in got.values()) and sum(b != "" for _, b in got.values()) > 50
    one_line = "MIT License Copyright (c) 2020 Jane Doe " + " ".join(licences.TEXTS[0][1].split())
    split_there = licences.TEXTS[0][1].replace("AUTHORS OR\nCOPYRIGHT", "AUTHORS\nOR COPYRIGHT")
    without = licences.TEXTS[0][1].replace("COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR", "")
    rows = licences.scan(spark.createDataFrame([(1, one_line), (2, split_there), (3, without)], "doc_id int, text string")).collect()
    assert [r.licence for r in sorted(rows, key=lambda r: r.doc_id)] == ["MIT", "MIT", None]


def test_long_licences_from_their_files(spark):
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    there = [(name, Path("/usr/share/common-licenses", f)) for f, name in files.items()]
    texts = [(name, p.read_text()) for name, p in there if p.exists()]
    if not texts:
        pytest.skip("no licence files on this machine")
    rows = [(x, name) for name, x in texts] + [(" ".join(x.split()), name) for name, x in texts if "Copyright" not in x] + [(x.replace("[yyyy] [name of copyright owner]", "2020 Jane Doe"), name) for name, x in texts]
    got = licences.scan(spark.createDataFrame([(k, x) for k, (x, _) in enumerate(rows)], "doc_id int, text string")).collect()
    assert [r.licence for r in sorted(got, key=lambda r: r.doc_id)] == [name for _, name in rows]


def test_licences(spark, odd, clashing, empty):
    mit = licences.TEXTS[0][1]
    changed = "Copyright (c) 2020 Somebody\n\n" + mit.replace("sublicense", "sub-licence").upper().replace(",", " ,")
    texts = [(1, mit), (2, changed), (3, mit + " And more."), (4, "text\nReleased under the MIT Licence!\nLICENSED UNDER CC BY-NC 4.0"), (5, None), (6, ""), (7, mit)]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(texts, "doc_id int, text string")).collect()}
    assert [got[i].licence for i in range(1, 8)] == ["MIT", "MIT", None, None, None, None, "MIT"]
    assert got[4].notices == "CC-BY-NC-4.0,MIT" and got[5].digest == got[6].digest == hashlib.sha256(b"").hexdigest()
    for name, x in licences.TEXTS:
        assert licences.digests(licences.TEXTS)[hashlib.sha256(licences.canonical_text(x).encode()).hexdigest()] == name
    assert licences.scan(clashing).count() == odd.count() and licences.scan(empty).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans():
    rng = random.Random(3)
    signs = ["1", "23", "4", ".", "@", "a", "b-", "+", " ", "-", "(", ")", "255.", "@a.b", "é", "4111111111111111", "+1 555 "]
    for _ in range(20_000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 24)))
        assert pii.base_spans(text) == base(text), text


def test_long_texts_take_linear_time():
    for x in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + "(" * 300_000, "1 " * 150_000, "a@" * 150_000):
        pii.find([x], pii.train())


def test_field_on_held_out_examples():
    field, right, nodes, added, wrong = pii.train(), 0, 0, 0, 0
    for text, found, links, truth in pii.examples(400, 1234):
        p = field.labels(np.array([pii.node_features(text, x) for x in found]), np.array(links, np.int64).reshape(-1, 3))
        best = p.argmax(1)
        right, nodes = right + (best == truth).sum(), nodes + len(truth)
        new = np.array([not x[2] for x in found]) & (best > 0) & (p.max(1) >= pii.SURE)
        added, wrong = added + new.sum(), wrong + (new & (best != truth)).sum()
    assert right > 0.97 * nodes and added > 100 and wrong < 0.02 * added


def test_skip_edges_carry_labels():
    text = "call me on +1 (555) 123-4567 any day. " + "some words here. " * 30 + "again 555.123.4567 it is. " + "more words. " * 30 + "and 555.999.4321 there"
    _, all_ = pii.find([text], pii.train())[0]
    assert [(k, text[a:b]) for k, a, b in all_] == [("phone", "+1 (555) 123-4567"), ("phone", "555.123.4567")]


@pytest.mark.parametrize(("proper", "loose", "kind"), [("4111111111111111", "4111/1111/1111/1111", "card"), ("+1 (555) 123-4567", "555.123.4567", "phone"), ("jane.doe7@site.org", "jane.doe7", "email")])
def test_evidence_reaches_dozens_of_distant_mentions(proper, loose, kind):
    far = " it is. " + "some words here stone river. " * 8
    for before, after in ((0, 60), (60, 0), (25, 35)):
        text = (loose + far) * before + proper + far + (loose + far) * after
        _, all_ = pii.find([text], pii.train())[0]
        assert sorted(a for k, a, _ in all_ if k == kind) == sorted([len(loose + far) * k for k in range(before)] + [len(loose + far) * before] + [len((loose + far) * before + proper + far) + len(loose + far) * k for k in range(after)])


@pytest.mark.parametrize("separator", [", ", ",", " ", " / ", "/"])
@pytest.mark.parametrize("form", ["{}-{}-{}", "({}) {}-{}", "{}.{}.{}", "{} {} {}"])
def test_lists_of_numbers_are_single_candidates(form, separator):
    numbers = [form.format(555, 100 + 111 * k, 4567 + k) for k in range(9)]
    for n in (2, 5, 9):
        text = "call " + separator.join(numbers[:n]) + " today"
        assert [text[a:b] for a, b, *_ in pii.candidates(text, pii.base_spans(text))] == numbers[:n]
    _, all_ = pii.find([text], pii.train())[0]
    assert [text[a:b] for kind, a, b in sorted(all_, key=lambda s: s[1]) if kind == "phone"] == numbers


def test_other_long_matches_are_cut_or_given_whole():
    def got(text):
        return [text[a:b] for a, b, *_ in pii.candidates(text, pii.base_spans(text))]

    assert got("pay 4111 1111, 1111 1111 now") == ["4111 1111, 1111 1111"]
    assert got("x " + "7" * 70 + " y") == ["7" * 70]
    assert "555-123-4567" in got("rows 12 345 6 78 9 555-123-4567 1 22 333 44 5")
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004"]
    assert got(" ".join(cards)) == cards
    assert got("+1 555-123-4567 555-987-6543, 5551234567") == ["+1 555-123-4567", "555-987-6543", "5551234567"]


def test_secrets_and_their_distant_mentions():
    far, code, other = " it is. " + "some words here stone river. " * 20, "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b", "2c26b46b68ffc68ff99b453c1d30413413422d70"
    for form in ('token = "{}"', "api_key: {}", "PASSWORD={}", "secret = '{}'"):
        text = code + far + form.format(code) + far + f"commit {other} it is" + far + code + far + other
        _, all_ = pii.find([text], pii.train())[0]
        assert {text[a:b] for k, a, b in all_ if k == "secret"} == {code} and len([x for x in all_ if x[0] == "secret"]) == 3
    plain = ["a-long-word-with-many-parts and_another_long_word_here", f"commit {other} sha256 {code}", "the key = value of it: nothing"]
    assert all(all_ == [] for _, all_ in pii.find(plain, pii.train()))


def test_secrets_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text like '%token = \"%'").collect()]
    assert len(rows) > 5
    for _, text in rows:
        wanted = {m.span(1) for m in re.finditer('token = "([0-9a-f]{40})"', text)}
        assert {(a, b) for k, a, b in pii.find([text], pii.train())[0][1] if k == "secret"} == wanted


@pytest.mark.parametrize("n", [10, 64, 65, 500])
def test_written_out_addresses_of_any_length(n):
    text = "mail " + "a1" * n + " (at) " + "h" * n + " dot " + " dot ".join(["part"] * n) + " dot org, thanks"
    assert [text[a:b] for kind, a, b in pii.find([text], pii.train())[0][1] if kind == "email"] == [text[5:-8]]


def test_names_are_found_however_many_there_are():
    for n in (999, 1000, 1001, 2500):
        text = " ".join(f"user.{k}@site.org" for k in range(n)) + " then USER.7 and user.998, not xuser.5 or user.5-x"
        names = [text[a:b] for a, b, kind, form, _ in pii.candidates(text, pii.base_spans(text)) if form == "name"]
        assert names == ["USER.7", "user.998"]


def test_names_are_found_as_by_one_pattern():
    rng = random.Random(8)
    for _ in range(5000):
        names = {"".join(rng.choice("ab.-%+_1") for _ in range(rng.randrange(1, 4))) for _ in range(4)}
        text = "".join(rng.choice(["a", "b", "A", ".", "-", "%", "+", "_", "1", " ", "@", "é", *names]) for _ in range(20))
        known = re.compile(r"(?<![\w.@-])(?:" + "|".join(map(re.escape, sorted(names, key=lambda x: (-len(x), x)))) + r")(?![\w@-])", re.IGNORECASE)
        assert list(pii._mentions(text, names)) == [m.span() for m in known.finditer(text)], (text, names)


def test_personal_data(documents, odd, odd_rows, clashing, empty):
    for docs, texts in ((documents, [(r.doc_id, r.text) for r in documents.collect()]), (odd, [(r[0], r[1]) for r in odd_rows])):
        wanted = sorted(as_key((i, *(sum(s[0] == k for s in base(x or "")) for k in PATTERNS), hashlib.sha256(pii.joined(base(x or "")).encode()).hexdigest())) for i, x in texts)
        rows = pii.personal_data(docs).collect()
        assert sorted(as_key((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)) for r in rows) == wanted
        by = dict(texts)
        assert all(set(pii.joined(base(by[r.doc_id] or "")).split(",")) <= set(r.spans.split(",")) for r in rows if r.doc_id is not None)
    out = pii.redact(clashing)
    assert out.columns == clashing.columns and out.count() == odd.count() and out.filter("text is null").count() == odd.filter("text is null").count()
    assert pii.personal_data(empty).count() == 0 and pii.redact(empty).count() == 0
    assert pii.redacted("mail a@b.co or +1 555 000 1234.", base("mail a@b.co or +1 555 000 1234.")) == "mail [EMAIL] or [PHONE]."


def test_decoding(documents):
    costs = toxicity.trigram_costs(toxicity.trigram_counts(documents))
    for token, word in {"5tup1d": "stupid", "stuuuupid": "stupid", "s.t.u.p.i.d": "stupid", "$cum": "scum", "m0r0n": "moron", "tr4sh": "trash"}.items():
        assert toxicity.decode(token, costs) == word


def reading(x, costs):
    data = np.frombuffer(x.encode(), np.uint8)
    out, _ = toxicity.restored(data, np.array([0, len(data)]), costs, {})
    return out.tobytes().decode()[len(x) :].split()


def test_long_disguises_are_decoded(documents):
    costs = toxicity.trigram_costs(toxicity.trigram_counts(documents))
    assert reading("st" + "u" * 400 + "pid", costs) == ["stupid"]
    long = " ".join("what a day it was when they all went to the river and then home again " * 3 + "you stupid idiot").replace("   ", " ")
    for x in (long, "y o u i d i o t", "y o u  i d i o t"):
        assert any(w.startswith("idio") for w in reading(x, costs)), x
    assert any(w.startswith("stup") for w in reading(long, costs))


def test_look_alikes_at_the_end_and_few_letters_are_decoded(documents):
    costs = toxicity.trigram_costs(toxicity.trigram_counts(documents))
    for x in ("shi7", "cun7", "as$", "5h17", "4$$", "tra5h", "idio7,", "(5h17)", "m0r0n5."):
        for text in (x, f"the {x} there", f"the\t{x}\n"):
            assert len(reading(text, costs)) == 1, text
    assert reading("the shi7 there", costs) == ["shit"]
    for x in ("455", "1,000", "10-20", "(50)", "3.14", "50%", "a", "the end.", "x7"):
        assert reading(f"of {x} and", costs) == [], x


def test_logistic_separates():
    owner, feature = np.array([0, 1, 1, 2, 3]), np.array([0, 0, 1, 1, 1])
    weights, bias = toxicity.logistic(owner, feature, np.array([1.0, 1.0, 0.0, 0.0, 0.0]), 2)
    assert weights[0] > 1 > weights[1] and bias < 0


def test_toxicity(spark, sf_dir, odd, clashing, empty):
    at = sf_dir.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    some = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    model = toxicity.fit(some, labels)
    rows = toxicity.score(some, model).join(labels, "doc_id").filter("held_out").collect()
    good, bad = ([r.predicted for r in rows if r.toxic == k] for k in (0, 1))
    assert np.mean(bad) > 0.85 and np.mean(good) < 0.02
    assert model.scores(pa.array(["what a 5tup1d m0r0n and 1d10t", "what a s t u p i d moron, tr4sh"])).min() > toxicity.CUT
    assert model.scores(pa.array(["", None, "the and of"])).max() < toxicity.CUT
    assert toxicity.score(clashing, model).count() == odd.count()
    got = toxicity.score(odd, model).filter("doc_id = 5").collect()
    assert len(got) == 2 and got[0] == got[1]
    assert toxicity.toxicity(empty, labels).count() == 0
    assert toxicity.toxicity(odd, labels.limit(0)).filter("score = 0.5").count() == odd.count()


def test_held_out_labels_are_never_read(spark, documents, labels):
    import zlib

    flipped = labels.rdd.map(lambda r: (r.doc_id, r.quality, 1 - r.toxic if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 else r.toxic)).toDF(labels.schema)
    a, b = (toxicity.fit(documents, x) for x in (labels, flipped))
    assert (a.hashes == b.hashes).all() and (a.weights == b.weights).all()
