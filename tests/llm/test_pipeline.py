"""The pipeline's stages, each on what the one before it kept."""

import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quillmill.llm import base, jaccard, mixing, pii, quality, queries


def test_registry():
    assert [f.split("_")[0] for f in queries.QUERIES if f.startswith("op")] == [f"op{n}" for n in range(1, 11)]
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_stages(spark, sf_dir, documents, labels, tmp_path):
    docs, kept = documents, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append(docs)
    assert all(d.columns == documents.columns for d in kept[:-1])
    ids = [Counter(r.doc_id for r in d.select("doc_id").collect()) for d in kept]
    good = {r.doc_id for r in quality.quality(documents, labels).filter("kept").collect()}
    assert set(ids[0]) == good
    lead = {r.doc_id for r in jaccard.near_duplicates(kept[0]).filter("doc_id = component_id").collect()}
    assert set(ids[1]) == lead and max(ids[1].values()) == 1
    assert ids[2] == ids[1]
    spans = pii.personal_data(kept[2])
    assert spans.filter("n_email + n_ip + n_card + n_phone > 0").count() == 0
    assert kept[2].filter(F.length("text") != F.col("n_chars")).count() == 0
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(kept[2]).collect()}
    assert ids[3] == Counter({i: n for i, n in plan.items() if n})
    pieces = kept[4].groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect()
    assert all(r.n == r.doc_tokens * ids[3][r.doc_id] for r in pieces) and {r.doc_id for r in pieces} == set(ids[3])
    assert corpus_pipeline.run(spark, sf_dir).count() == kept[4].count()


def test_stages_on_odd_rows(spark, sf_dir, odd, empty, clashing, tmp_path):
    for case, docs in (("odd", odd), ("empty", empty), ("clashing", clashing)):
        columns, counts = docs.columns, []
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, sf_dir).write.parquet(str(tmp_path / case / str(k)))
            docs = spark.read.parquet(str(tmp_path / case / str(k)))
            counts.append(docs.count())
            assert k == 4 or docs.columns == columns
        assert counts == [0] * 5 if case == "empty" else counts[0] >= counts[1] == counts[2] > 0


def test_pipeline_by_brute_force(spark, sf_dir, documents, tmp_path):
    """The rules of the stages, written out again over what each one kept."""
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality rules"](spark, documents, sf_dir).collect()
    words = lambda x: re.findall(r"[^\x20\x09-\x0D]+", x or "")
    assert 0 < len(kept) < documents.count() and all(len(words(r.text)) >= 20 for r in kept)
    sets = {r.doc_id: {tuple(w[i : i + 5]) for w in [[x.lower() for x in words(r.text)]] for i in range(len(w) - 4)} for r in kept}
    ids, near = sorted(sets), {}
    for a in ids:
        near[a] = [b for b in ids if b < a and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = {}
    for a in ids:
        group = {root[b] for b in near[a]}
        root[a] = min(group | {a})
        for b in root:
            root[b] = root[a] if root[b] in group else root[b]
    single = stages["n-gram jaccard join"](spark, spark.createDataFrame(kept, documents.schema), sf_dir).collect()
    assert sorted(r.doc_id for r in single) == [a for a in ids if root[a] == a]
    clean = {r.doc_id: r.text for r in stages["personal data"](spark, spark.createDataFrame(single, documents.schema), sf_dir).collect()}
    before = {r.doc_id: r.text for r in single}
    assert all(not re.search(r'[a-z0-9]@[a-z0-9-]+\.[a-z]|token = "[0-9a-f]{40}"', x) for x in clean.values())
    assert {i for i in clean if clean[i] != before[i]} == {i for i in clean if re.search(r"\[(EMAIL|IP|CARD|PHONE|SECRET)\]", clean[i]) and clean[i] != before[i]}


def test_shared_folder_is_the_sessions(spark):
    assert base.shared_folder(spark).startswith(f"file:{spark.sparkContext.getConf().get('spark.checkpoint.dir')}")
