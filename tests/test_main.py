"""The command line."""

import json
import sys
import types
import zlib

import pytest

from quillmill.__main__ import main
from quillmill.plans.translate import Causal
from quillmill.sources.tables import Store


def test_steps(spark, tmp_path, capsys):
    stores = ["--source", str(tmp_path / "a"), "--target", str(tmp_path / "b"), "--num-shards", "1", "--test-run"]
    assert main(["articles", "--source", "a", "--target", "b", "--shard", "3", "--num-shards", "2"]) == 1
    assert main(["init", *stores]) == 0
    blob = bytearray(zlib.compress(b"The cat is not a dog."))
    Store(spark, str(tmp_path / "a")).write("articles", spark.createDataFrame([(i, "T", blob, 0) for i in range(7)], "id long, rephrased_title string, rephrased_article binary, translated_hi int"))
    capsys.readouterr()
    assert main(["articles", *stores]) == 0 and "has_more=true" in capsys.readouterr().out
    assert main(["articles", *stores]) == 0 and "has_more=false" in capsys.readouterr().out
    assert main(["mine", *stores, "--report", str(tmp_path / "r.md"), "--candidates", str(tmp_path / "c.json")]) == 0 and "| 1 | 7 | " in (tmp_path / "r.md").read_text()
    listed = json.loads((tmp_path / "c.json").read_text())
    assert set(listed[0]) == {"token", "freq", "gloss", "suggest_latin", "flag"} and listed[0]["freq"] == 7
    capsys.readouterr()
    assert main(["reset", *stores]) == 0 and "translations: 7" in capsys.readouterr().out
    assert main(["reset", *stores, "--yes"]) == 0
    assert Store(spark, str(tmp_path / "b")).read("translations").count() == 0


def test_entities(spark, tmp_path):
    incident = {"source_url": "u", "incident_text": "The case", "year": 2020}
    person = {"name": "Asha", "role": "the chair", "criminal_cases": 1, "controversies": [incident]}
    (tmp_path / "entities.json").write_text(json.dumps({"metadata": {"v": 2}, "india": {"cabinet_ministers": [person, {"name": "New"}], "states": ["x"]}}))
    (tmp_path / "entities_hi.json").write_text(json.dumps({"india": {"cabinet_ministers": [{"name": "Asha", "name_hi": "आशा", "controversies": [{"source_url": "u", "incident_text": "old"}]}]}}))
    args = ["entities", "--source", "a", "--target", "b", "--num-shards", "1", "--library", str(tmp_path)]
    assert main(args) == 0
    made = json.loads((tmp_path / "entities_hi.json").read_text())
    asha, new = made["india"]["cabinet_ministers"]
    assert (asha["name_hi"], asha["role_hi"], asha["criminal_cases"], asha["controversies"][0]["incident_text"]) == ("आशा", "वह chair", 1, "old")
    assert new["name"] == "New" and made["metadata"] == {"v": 2} and made["india"]["states"] == ["x"]
    (tmp_path / "entities.json").write_text("{broken")
    assert main(args) == 1


def test_causal_model_is_asked_by_task(monkeypatch):
    asked = []

    class Llama:
        def __init__(self, **options):
            assert options["n_ctx"] == 2048

        def __call__(self, prompt, **options):
            asked.append(prompt)
            return {"choices": [{"text": " 'made' "}]}

    monkeypatch.setitem(sys.modules, "llama_cpp", types.SimpleNamespace(Llama=Llama))
    model = Causal("m.gguf", "Sanskrit")
    assert [model.translate(["said {x}"], task) for task in ("body", "headline", "back")] == [["made"]] * 3
    assert all("said {x}" in p and "Sanskrit" in p for p in asked) and len(set(asked)) == 3
    with pytest.raises(SystemExit):
        main(["articles", "--source", "a", "--target", "b", "--causal-model", "m.gguf"])
