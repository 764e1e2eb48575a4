"""python -m quillmill STEP --source ROOT --target ROOT: run a job over two stores.

Steps: init, articles, timelines, entities, all, mine, reset. SHARD_ID, NUM_SHARDS and TRANSLATION_BATCH_SIZE give the
defaults, SOURCE_TOKEN and TARGET_TOKEN the stores' tokens. Prints has_more=true or has_more=false; the exit status is 1 if a shard is out of range.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions.glossary import apply_glossary
from quillmill.functions.values import BATCH, SAMPLE, SHARDS, TEST_BATCH, TOP
from quillmill.operators import mining
from quillmill.operators.nested import INCIDENTS
from quillmill.plans import jobs
from quillmill.plans.translate import Causal, Lexicon, Seq2Seq, Translator, translate_short
from quillmill.sources import tables

CATEGORIES = ("cabinet_ministers", "opposition_leaders", "state_chief_ministers", "generic_politicians")
PASSED_ON = ("parties", "states", "institutions")
_INCIDENT = "struct<source_url:string,incident_text:string,extra:map<string,string>>"
PERSON = (
    "category string, pos long, name string, role string, party string, state string, constituency string, criminal_cases int, criminal_cases_in_news int, "
    f"wikipedia string, affidavit_url string, image_placeholder string, controversies array<{_INCIDENT}>, criminal_incidents array<{_INCIDENT}>"
)
TRANSLATED = ", name_hi string, role_hi string, party_hi string, state_hi string, constituency_hi string"


def _incident(x: dict) -> tuple:
    return x.get("source_url"), x.get("incident_text"), {k: str(v) for k, v in x.items() if k not in ("source_url", "incident_text")}


def persons(spark: SparkSession, library: dict, schema: str) -> DataFrame:
    names = [f.strip().split(" ")[0] for f in schema.replace(_INCIDENT, "x").split(",")]
    rows = []
    for category in CATEGORIES:
        for pos, p in enumerate(library.get("india", {}).get(category, [])):
            row = {**p, "category": category, "pos": pos} | {c: [_incident(x) for x in p.get(c, [])] for c in INCIDENTS}
            rows.append(tuple(row.get(n) for n in names))
    return spark.createDataFrame(rows, schema)


def refresh_entities(spark: SparkSession, folder: str, translator: Translator, glossary: dict[str, str]) -> bool:
    """Bring entities_hi.json up to date with entities.json; without the latter there is nothing to do."""
    source, target = Path(folder, "entities.json"), Path(folder, "entities_hi.json")
    if not source.exists():
        return True
    try:
        library = json.loads(source.read_text(encoding="utf-8"))
    except ValueError:
        return False
    old = tables.glossary(str(target)) if target.exists() else {}
    known, before = persons(spark, library, PERSON), persons(spark, old, PERSON + TRANSLATED)
    # each distinct text is translated once and comes back to the persons that have it
    texts = [F.array(*["name", "role", "party", "state", "constituency"]), *[F.transform(c, lambda x: x["incident_text"]) for c in INCIDENTS]]
    each = known.select("category", "pos", F.explode(F.array_distinct(F.flatten(F.array(*texts)))).alias("t")).filter("t is not null")
    spoken = translate_short(each.select("t").distinct(), "t", "raw", translator).select("t", apply_glossary(F.col("raw"), glossary).alias("hi"))
    own = each.join(spoken, "t").groupBy("category", "pos").agg(F.map_from_entries(F.collect_list(F.struct("t", "hi"))).alias("spoken"))
    rows = jobs.entities(known.join(own, ["category", "pos"], "left"), before, lambda c: F.coalesce(F.try_element_at(F.col("spoken"), c), c)).orderBy("category", "pos").collect()
    made = {c: [] for c in CATEGORIES}
    for r in rows:
        p = r.asDict(recursive=True)
        category, _ = p.pop("category"), p.pop("pos")
        for c in INCIDENTS:
            p[c] = [{"source_url": x["source_url"], "incident_text": x["incident_text"], **(x["extra"] or {})} for x in p[c] or []]
        made[category].append(p)
    india = {**old.get("india", {}), **made, **{k: library.get("india", {}).get(k, []) for k in PASSED_ON}}
    tables.write_document(str(target), {**old, "metadata": library.get("metadata", {}), "international": library.get("international", {}), "india": india})
    return True


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quillmill", description=__doc__)
    parser.add_argument("step", choices=["init", "articles", "timelines", "entities", "all", "mine", "reset"])
    parser.add_argument("--source", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--library", default="")
    parser.add_argument("--glossary", default="")
    parser.add_argument("--model", default="", help="a sequence-to-sequence model; the built-in lexicon without one")
    parser.add_argument("--causal-model", default="", help="a causal chat model's file, in place of --model")
    parser.add_argument("--language", default="", help="the causal model's target language, by its English name")
    parser.add_argument("--scratch", default="", help="a folder for a batch's results; needed if the target is no folder")
    parser.add_argument("--shard", type=int, default=int(os.environ.get("SHARD_ID", 0)))
    parser.add_argument("--num-shards", type=int, default=int(os.environ.get("NUM_SHARDS", SHARDS)))
    parser.add_argument("--test-run", action="store_true")
    parser.add_argument("--yes", action="store_true", help="reset: really empty the tables")
    parser.add_argument("--report", default="", help="mine: where the report goes")
    parser.add_argument("--candidates", default="", help="mine: where the candidates go as JSON")
    a = parser.parse_args(args)
    if a.causal_model and not a.language:
        parser.error("--causal-model needs --language")
    if not 0 <= a.shard < a.num_shards:
        print("has_more=false")
        return 1
    spark = SparkSession.builder.getOrCreate()
    source, target = (tables.open_store(spark, x, os.environ.get(f"{side}_TOKEN", "")) for side, x in (("SOURCE", a.source), ("TARGET", a.target)))
    glossary = tables.glossary(a.glossary) if a.glossary else {}
    translator: Translator = Causal(a.causal_model, a.language) if a.causal_model else Seq2Seq(a.model) if a.model else Lexicon()
    batch = TEST_BATCH if a.test_run else int(os.environ.get("TRANSLATION_BATCH_SIZE", BATCH))
    options = jobs.Options(a.shard, a.num_shards, batch, glossary, a.scratch)
    more, ok = False, True
    if a.step == "init":
        target.create()
    if a.step in ("articles", "all"):
        more |= jobs.articles(source, target, translator, options)
    if a.step in ("timelines", "all"):
        more |= jobs.timelines(source, target, translator, options)
    if a.step in ("entities", "all") and a.shard == 0 and a.library:
        ok = refresh_entities(spark, a.library, translator, glossary)
    if a.step == "mine":
        from quillmill.sources.codec import inflate

        texts = source.read("articles").select("id", inflate(F.col("rephrased_article"))["text"].alias("text"))
        sample = jobs.corpus_sample(texts, "id", "text", int(os.environ.get("GLOSSARY_SAMPLE", SAMPLE)))
        found = jobs.mine(sample, "text", translator, int(os.environ.get("GLOSSARY_TOP_N", TOP))).cache()
        text = mining.report(found, sample.count())
        if a.candidates:
            tables.write_document(a.candidates, mining.listed(found))
        Path(a.report).write_text(text, encoding="utf-8") if a.report else print(text)
    if a.step == "reset":
        counts, done = jobs.reset(target, a.yes, source)
        for r in counts.collect():
            print(f"{r.table_name}: {r.n}")
        print("emptied" if done else "dry run; --yes empties the tables")
    print(f"has_more={str(more and ok).lower()}")
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
