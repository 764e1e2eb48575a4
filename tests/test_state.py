"""State transitions, nested merges, sources and jobs."""

import base64
import http.server
import json
import sqlite3
import threading
import zlib

import pytest
from pyspark.sql import functions as F

from quillmill.operators import mining, nested, state
from quillmill.plans import jobs
from quillmill.plans.translate import Lexicon
from quillmill.sources import tables
from quillmill.sources.codec import deflate, inflate
from quillmill.streaming.queue import drain, work_queue

FAILURES = "article_id long, attempts long, last_error string"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_shards_and_pending(spark):
    df = spark.createDataFrame([(i, i % 2 if i != 5 else None, None if i == 8 else "t") for i in range(-4, 41)], "id long, s int, t string")
    got = [r.id for r in state.pending(df, "id", "s", 0, 4, 5, "t").collect()]
    assert got == [40, 36, 32, 28, 24]
    assert spark.range(1).select(state.in_shard(F.lit(-3), 17)).first()[0] is False


def test_replace_by_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    source = spark.createDataFrame([(2, "x", 1), (2, None, 2), (3, "z", 1)], "k long, v string, o int")
    once = state.replace_by_key(target, source, ["k"], ["o"])
    assert rows(once, "k") == [(1, "a"), (2, None), (3, "z")]
    assert rows(state.replace_by_key(once, source, ["k"], ["o"]), "k") == rows(once, "k")


def test_failures_and_quarantine(spark):
    empty = spark.createDataFrame([], FAILURES)
    failed = spark.createDataFrame([(7, "e" * 600, 1), (7, "last", 3), (7, "mid", 2), (8, "one", 1)], "article_id long, error string, o int")
    counted = state.count_failures(empty, failed, "article_id", ["o"])
    assert rows(counted, "article_id") == [(7, 3, "last"), (8, 1, "one")]
    articles = spark.createDataFrame([(7, 0), (8, 0), (9, 1)], "article_id long, s int")
    assert rows(state.quarantine(articles, counted, "article_id", "s"), "article_id") == [(7, 2), (8, 0), (9, 1)]
    done = spark.createDataFrame([(7,)], "article_id long")
    assert rows(state.clear(counted, done, "article_id"), "article_id") == [(8, 1, "one")]
    assert rows(state.publish(articles, done, "article_id", "s"), "article_id") == [(7, 1), (8, 0), (9, 1)]


@pytest.mark.parametrize("n, more", [(10, True), (9, False)])
def test_has_more(spark, n, more):
    assert state.has_more(spark.range(n), 10).first()[0] is more


def test_counts_and_reset(spark):
    assert rows(state.row_counts({"a": spark.range(3), "b": spark.range(0)}), "table_name") == [("a", 3), ("b", 0), ("total", 3)]


INCIDENT = "struct<source_url:string,incident_text:string,extra:map<string,string>>"


def test_append_new(spark):
    df = spark.createDataFrame([([("a", "x", None)], [("a", "1", None), ("b", "2", {"k": "v"}), ("b", "3", None), (None, "4", None), ("", "5", None)])], f"o array<{INCIDENT}>, n array<{INCIDENT}>")
    got = df.select(nested.append_new(F.col("o"), F.col("n"), F.upper)).first()[0]
    assert [(c.source_url, c.incident_text) for c in got] == [("a", "x"), ("b", "2"), ("b", "3")]
    assert got[1].extra == {"k": "v"}
    none = df.select(nested.append_new(F.lit(None).cast(f"array<{INCIDENT}>"), F.col("n"))).first()[0]
    assert [c.source_url for c in none] == ["a", "b", "b"]


PERSON = f"category string, pos long, name string, role string, party string, state string, constituency string, criminal_cases int, criminal_cases_in_news int, wikipedia string, affidavit_url string, image_placeholder string, controversies array<{INCIDENT}>, criminal_incidents array<{INCIDENT}>"


def test_refresh(spark):
    library = spark.createDataFrame([("c", 1, "Known", "boss", None, None, "new seat", 2, None, "w2", None, None, [("u", "t", None)], []), ("c", 2, "New", None, "p", "s", "seat", None, None, "w", None, None, None, None)], PERSON)
    old = spark.createDataFrame([("c", 1, "Known", "r", "p", "s", "seat", 1, 0, "w1", "", "", [], []), ("c", 2, "Gone", "r", "p", "s", "seat", 1, 0, "w", "", "", [], [])], PERSON)
    old = old.select("*", *[F.concat(F.lit("hi "), F.col(c)).alias(f"{c}_hi") for c in ("name", "role", "party", "state", "constituency")])
    got = {r.name: r for r in nested.refresh(library, old, F.upper).collect()}
    assert set(got) == {"Known", "New"}
    known, new = got["Known"], got["New"]
    assert (known.name_hi, known.role, known.role_hi, known.party, known.constituency, known.constituency_hi, known.criminal_cases, known.wikipedia) == ("hi Known", "boss", "BOSS", "", "seat", "hi seat", 2, "w1")
    assert [c.incident_text for c in known.controversies] == ["T"]
    assert (new.name_hi, new.role, new.party_hi, new.criminal_cases, new.wikipedia) == ("NEW", "", "P", 0, "w")


def test_codec(spark):
    df = spark.createDataFrame([(1, "héllo"), (2, ""), (3, None)], "i int, t string").withColumn("b", deflate(F.col("t")))
    got = {r.i: r.x for r in df.select("i", inflate(F.col("b")).alias("x")).collect()}
    assert (got[1].text, got[2].text, got[3].text) == ("héllo", "", None) and got[3].error
    bad = spark.createDataFrame([(bytearray(b"nonsense"),), (bytearray(zlib.compress(b"\xff")),)], "b binary").select(inflate(F.col("b")).alias("x")).collect()
    assert all(r.x.text is None and r.x.error.startswith("decompress: ") for r in bad)


def test_settings_and_documents(spark, tmp_path):
    assert tables.settings(["# no", "a = 1", "b=c=d", "", "nothing", "a=2"]) == {"a": "2", "b": "c=d"}
    assert tables.glossary(str(tmp_path / "none.json")) == {}
    tables.write_document(str(tmp_path / "g.json"), {"पुलिस": "police"})
    assert tables.glossary(str(tmp_path / "g.json")) == {"पुलिस": "police"}
    tables.write_document(str(tmp_path / "d.json"), {"a": 1, "b": ["x"]})
    assert tables.read_document(spark, str(tmp_path / "d.json"), "a int, b array<string>").first().b == ["x"]


class _Sql(http.server.BaseHTTPRequestHandler):
    """SQL over HTTP in front of a database in memory."""

    database = None

    def one(self, statement):
        args = [base64.b64decode(x["base64"]) if x["type"] == "blob" else None if x["type"] == "null" else int(x["value"]) if x["type"] == "integer" else x["value"] for x in statement.get("args", [])]
        cells = lambda v: {"type": "null"} if v is None else {"type": "integer", "value": str(v)} if isinstance(v, int) else {"type": "blob", "base64": base64.b64encode(v).decode().rstrip("=")} if isinstance(v, bytes) else {"type": "text", "value": v}
        return {"rows": [[cells(v) for v in row] for row in self.database.execute(statement["sql"], args).fetchall()]}

    def batch(self, steps):
        errors = []
        met = lambda c: c is None or (not met(c["cond"]) if c["type"] == "not" else ran[c["step"]])
        ran = []
        for step in steps:
            error = None
            if ok := met(step.get("condition")):
                try:
                    self.one(step["stmt"])
                except sqlite3.Error as e:
                    ok, error = False, {"message": str(e)}
            ran.append(ok)
            errors.append(error)
        return {"step_errors": errors}

    def do_POST(self):
        wanted = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["requests"][0]
        with LOCK:
            try:
                result = self.one(wanted["stmt"]) if wanted["type"] == "execute" else self.batch(wanted["batch"]["steps"])
                first = {"type": "ok", "response": {"result": result}}
            except sqlite3.Error as e:
                first = {"type": "error", "error": {"message": str(e)}}
        self.send_response(200 if self.headers["Authorization"] == "Bearer t" else 401)
        self.end_headers()
        self.wfile.write(json.dumps({"results": [first, {"type": "ok"}]}).encode())

    def log_message(self, *_):
        pass


LOCK = threading.Lock()


@pytest.fixture
def server():
    _Sql.database = sqlite3.connect(":memory:", check_same_thread=False, isolation_level=None)
    made = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Sql)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}"
    made.shutdown()


def test_http_sql(server):
    client = tables.HttpSql(f"'{server}'", "t")
    client.execute("CREATE TABLE a (i INTEGER, t TEXT, b BLOB)")
    client.together([("INSERT INTO a VALUES (?, ?, ?)", [5, "é", b"\x00x"]), ("INSERT INTO a VALUES (?, ?, ?)", [6, None, None])])
    assert client.rows(client.execute("SELECT * FROM a WHERE i >= ? ORDER BY i", [5])) == [[5, "é", b"\x00x"], [6, None, None]]
    assert client.scalar(client.execute("SELECT count(*) FROM a")) == 2 and client.scalar(client.execute("SELECT i FROM a WHERE i > 9")) is None
    with pytest.raises(RuntimeError, match="no such table"):
        client.execute("SELECT * FROM bad")
    with pytest.raises(RuntimeError, match="no such table"):
        client.together([("DELETE FROM a", []), ("DELETE FROM bad", [])])
    assert client.scalar(client.execute("SELECT count(*) FROM a")) == 2


@pytest.fixture(params=["folder", "jdbc", "http"])
def any_store(request, spark, tmp_path):
    if request.param == "http":
        return tables.open_store(spark, request.getfixturevalue("server"), "t")
    return tables.open_store(spark, str(tmp_path / "store") if request.param == "folder" else f"jdbc:derby:{tmp_path}/derby;create=true")


def test_stores(spark, any_store):
    any_store.create()
    assert any_store.exists("translation_failures") and any_store.read("translation_failures").count() == 0
    name, keys = "translation_failures", ["article_id"]
    any_store.write(name, spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], FAILURES))
    # a table computed from itself
    any_store.write(name, state.count_failures(any_store.read(name), spark.createDataFrame([(2, "again")], "article_id long, error string"), "article_id", []))
    assert rows(any_store.read(name), "article_id") == [(1, 1, "a"), (2, 2, "again")]
    any_store.upsert(name, spark.createDataFrame([(2, 3, None), (3, 1, "é")], FAILURES), keys)
    any_store.delete(name, spark.createDataFrame([(1,), (9,)], "article_id long"), keys)
    assert rows(any_store.read(name), "article_id") == [(2, 3, None), (3, 1, "é")]
    any_store.delete(name, any_store.read(name).filter("attempts = 3"), keys)
    any_store.upsert(name, any_store.read(name).withColumn("attempts", F.col("attempts") + 1), keys)
    assert rows(any_store.read(name), "article_id") == [(3, 2, "é")]
    any_store.write("articles", spark.createDataFrame([article(1, "x"), article(2, None)], ARTICLES))
    assert [(r.id, r.rephrased_article and zlib.decompress(r.rephrased_article)) for r in any_store.read("articles").orderBy("id").collect()] == [(1, b"x"), (2, None)]


def test_many_changes_are_merged_and_old_folders_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_CHANGES", 4)
    store, wanted = tables.Store(spark, str(tmp_path)), {}
    for k in range(12):
        new = {i: k for i in range(k % 3, k % 3 + 3)}
        store.upsert("event_translations", spark.createDataFrame([(i, str(v)) for i, v in new.items()], "event_id long, title_hi string"), ["event_id"])
        wanted |= {i: str(v) for i, v in new.items()}
        if k % 5 == 4:
            store.delete("event_translations", spark.createDataFrame([(k % 4,)], "event_id long"), ["event_id"])
            wanted.pop(k % 4, None)
        assert rows(store.read("event_translations"), "event_id") == sorted(wanted.items())
    folder = tmp_path / "event_translations"
    lists = [json.loads(x.read_text()) for x in (folder / "_lists").iterdir() if x.name.isdigit()]
    named = {x for v in lists for x in store._folders(v)}
    assert len(lists) == tables.KEPT and {x.name for x in folder.iterdir()} - {"_lists"} == named
    before = store._numbers("event_translations")
    store._put_list("event_translations", before, lists[0])
    with pytest.raises(RuntimeError, match="another writer"):
        store._put_list("event_translations", before, lists[0])


ARTICLES = "id long, rephrased_title string, rephrased_article binary, translated_hi int"


def article(i, text, status=0):
    return (i, f"Title {i} of Asha Rao", bytearray(zlib.compress(text.encode())) if text is not None else None, status)


def test_articles_job(spark, tmp_path):
    source, target = tables.Store(spark, str(tmp_path / "a")), tables.Store(spark, str(tmp_path / "b"))
    target.create()
    broken = (4, "t", bytearray(b"junk"), 0)
    source.write("articles", spark.createDataFrame([article(1, "The price of 5 was 10. It is."), article(2, None), article(3, "x y", 1), broken, article(5, "")], ARTICLES))
    for _ in range(3):
        assert jobs.articles(source, target, Lexicon(), jobs.Options(0, 1, 10)) is False
    assert rows(source.read("articles").select("id", "translated_hi"), "id") == [(1, 1), (2, 0), (3, 1), (4, 2), (5, 2)]
    made = target.read("translations").collect()
    assert [r.article_id for r in made] == [1] and zlib.decompress(made[0].rephrased_article_hi).decode() == "वह price का 5 था 10। It है।"
    assert made[0].headline_verified_hi == 1 and "Asha Rao" in made[0].rephrased_title_hi
    assert [(a, n) for a, n, _ in rows(target.read("translation_failures"), "article_id")] == [(4, 3), (5, 3)]
    assert jobs.reset(target)[1] is False and target.read("translations").count() == 1
    counts, done = jobs.reset(target, True, source)
    assert done and {r.table_name: r.n for r in counts.collect()}["total"] == 3 and target.read("translations").count() == 0
    assert {r.translated_hi for r in source.read("articles").collect()} == {0}
    jobs.articles(source, target, Lexicon(), jobs.Options(0, 1, 10))
    assert [r.article_id for r in target.read("translations").orderBy("article_id").collect()] == [1, 3]
    with pytest.raises(ValueError, match="shard"):
        jobs.Options(5, 5)


def test_timelines_job(spark, tmp_path):
    source, target = tables.Store(spark, str(tmp_path / "a")), tables.Store(spark, str(tmp_path / "b"))
    source.write("events", spark.createDataFrame([(1, "The rise of 5", 0), (2, "gone", 1)], "id long, title string, translated_hi int"))
    source.write("event_articles", spark.createDataFrame([(1, k, f"step {k} of it") for k in range(3)] + [(2, 9, "x")], "event_id long, article_id long, milestone string"))
    options = jobs.Options(0, 1, 2)
    assert drain(lambda: jobs.timelines(source, target, Lexicon(), options)) >= 2
    assert rows(target.read("event_translations"), "event_id") == [(1, "वह rise का 5")]
    assert rows(target.read("event_milestone_translations"), "article_id") == [(1, k, f"step {k} का it") for k in range(3)]
    assert rows(source.read("events").select("id", "translated_hi"), "id") == [(1, 1), (2, 1)]


def test_timelines_give_up_what_always_fails(spark, tmp_path):
    class Failing(Lexicon):
        """Loses the numbers of texts that say so."""

        def translate(self, texts, task):
            return ["lost" if "hard" in x else y for x, y in zip(texts, Lexicon.translate(self, texts, task), strict=True)]

    source, target = tables.Store(spark, str(tmp_path / "a")), tables.Store(spark, str(tmp_path / "b"))
    source.write("events", spark.createDataFrame([(k, "hard 7" if k == 5 else f"The rise of {k}", 0) for k in range(4, 7)], "id long, title string, translated_hi int"))
    stones = [(e, a, "hard 9" if (e, a) == (6, 1) else f"step {a} of it") for e in range(4, 7) for a in range(2)]
    source.write("event_articles", spark.createDataFrame(stones, "event_id long, article_id long, milestone string"))
    options = jobs.Options(0, 1, 2)
    drain(lambda: jobs.timelines(source, target, Failing(), options))
    assert rows(source.read("events").select("id", "translated_hi"), "id") == [(k, 2 if k == 5 else 1) for k in range(4, 7)]
    assert [r.event_id for r in target.read("event_translations").orderBy("event_id").collect()] == [4, 6]
    assert {(r.event_id, r.article_id) for r in target.read("event_milestone_translations").collect()} >= {(e, a) for e, a, _ in stones if e != 5 and (e, a) != (6, 1)}
    assert rows(target.read("event_failures").select("event_id", "attempts"), "event_id") == [(5, 3)]
    assert rows(target.read("milestone_failures").select("event_id", "article_id", "attempts"), "event_id") == [(6, 1, 3)]


def test_work_queue(spark, tmp_path):
    source, target = tables.Store(spark, str(tmp_path / "a")), tables.Store(spark, str(tmp_path / "b"))
    target.create()
    spark.createDataFrame([article(i, f"The text {i}.") for i in range(5)], ARTICLES).write.parquet(str(tmp_path / "in"))
    work_queue(spark, str(tmp_path / "in"), ARTICLES, str(tmp_path / "cp"), source, target, Lexicon(), jobs.Options(0, 1, 2)).awaitTermination()
    assert {r.translated_hi for r in source.read("articles").collect()} == {1}
    assert target.read("translations").count() == 5


def test_miner(spark):
    sample = spark.createDataFrame([("The cat and the dog. With the end.",), ("this is not it",)], "text string")
    got = jobs.mine(sample, "text", Lexicon(words={"cat": "कार्यकर्ता", "dog": "कारण", "end": "कारण"}))
    assert [(r.token, r.n, r.flag) for r in got.collect()] == [("कारण।", 2, False), ("कार्यकर्ता", 1, False)]
    assert mining.report(got, 2).splitlines()[-2].startswith("| 1 | 2 | कारण। | ")
