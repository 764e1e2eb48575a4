"""The registered queries of the core library and SQL that gives the same rows.

The driver's tables stand in for the library's own: documents for articles, with labels.quality as their status;
conversations for events and milestones; events and orders for logs and number templates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import gates, glossary, mask, text
from quillmill.functions.values import CAPITAL_STOP_WORDS, TARGET_STOP_WORDS, LOAN_SEED, ROMAN
from quillmill.operators import mining, nested, state
from quillmill.plans import jobs
from quillmill.plans.translate import Lexicon, with_masks
from quillmill.sources.codec import deflate, inflate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SHARD, SHARDS_HERE, BATCH_HERE = 3, 5, 10


def query(sql: str | None = None) -> Callable:
    def add(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """df over all cores: a scan of fewer partitions than there are cores is dealt out where the work on a row is heavy; larger ones stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _lines(x: Column) -> Column:
    return F.array_join(x, "\n")


def _md5(x: Column) -> Column:
    return F.md5(x.cast("binary"))


# ---------------------------------------------------------------- stand-ins


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _t(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("status"))
    docs = _t(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    return docs.select(F.col("doc_id").alias("id"), F.left("text", F.lit(80)).alias("title"), "text", F.coalesce("status", F.lit(0)).alias("translated_hi"))


_ARTICLES = "SELECT d.doc_id AS id, left(d.text, 80) AS title, d.text, coalesce(l.quality, 0) AS translated_hi FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations")
    first = turns.groupBy("conv_id").agg(F.min_by("text", "turn").alias("title"))
    return first.select(F.col("conv_id").alias("id"), "title", (F.col("conv_id") % 3).alias("translated_hi"))


_EVENTS = "SELECT conv_id AS id, arg_min(text, turn) AS title, conv_id % 3 AS translated_hi FROM conversations GROUP BY conv_id"


def _milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("event_id"), F.col("turn").alias("article_id"), F.col("text").alias("milestone"))


def _order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of texts whose numbers agree, are written differently, are dropped or are added, by the order's key."""
    orders = _t(spark, sf_dir, "orders")
    total = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    key = F.col("o_orderkey").cast("string")
    en = F.concat(F.lit("Order "), key, F.lit(" total "), total)
    hi = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("Order "), key)).when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("Order "), key, F.lit(" total "), total, F.lit("0")))
    hi = hi.when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("7 Order "), key, F.lit(" total "), total)).otherwise(en)
    return orders.select("o_orderkey", en.alias("en"), hi.alias("hi"))


_ORDER_TEXTS = """SELECT o_orderkey, 'Order ' || o_orderkey || ' total ' || total AS en,
  CASE o_orderkey % 4 WHEN 0 THEN 'Order ' || o_orderkey WHEN 1 THEN 'Order ' || o_orderkey || ' total ' || total || '0'
  WHEN 2 THEN '7 Order ' || o_orderkey || ' total ' || total ELSE 'Order ' || o_orderkey || ' total ' || total END AS hi
  FROM (SELECT o_orderkey, o_totalprice::DECIMAL(12,2)::VARCHAR AS total FROM orders)"""


def _numbers_sql(x: str) -> str:
    one = "CASE WHEN contains(replace(n, ',', ''), '.') THEN regexp_replace(regexp_replace(replace(n, ',', ''), '0+$', ''), '[.]+$', '') ELSE replace(n, ',', '') END"
    return rf"list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(coalesce({x}, ''), '\p{{Nd}}+(?:[.,]\p{{Nd}}+)?'), lambda n: {one}), lambda n: n <> '')))"


def _names_sql(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(set(CAPITAL_STOP_WORDS)))
    doubled = rf"' ' || regexp_replace(coalesce({x}, ''), '([^\p{{L}}\p{{N}}_\-])', '\1\1', 'g') || ' '"
    # hyphens are doubled apart, as they may stand inside and at the edge of a name
    found = rf"list_transform(regexp_extract_all({doubled}, '[^\p{{L}}\p{{N}}_][A-Z][a-zA-Z\-]+[^\p{{L}}\p{{N}}_]'), lambda n: regexp_extract(n, '[A-Z][a-zA-Z\-]+'))"
    return f"list_sort(list_distinct(list_filter({found}, lambda n: length(n) > 2 AND n NOT IN ({stop}))))"


def _script_sql(x: str) -> str:
    return rf"array_to_string(list_sort(list_distinct(regexp_extract_all(regexp_replace(coalesce({x}, ''), '[\x{{0000}}-\x{{024F}}\x{{0900}}-\x{{097F}}]', '', 'g'), '\p{{L}}'))), '')"


# ---------------------------------------------------------------- scans, limits, counts


@query(f"SELECT id, title, text FROM ({_ARTICLES}) WHERE text IS NOT NULL AND translated_hi = 0 AND id % {SHARDS_HERE} = {SHARD} ORDER BY id DESC LIMIT {BATCH_HERE}")
def shard_batch_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.pending(_articles(spark, sf_dir), "id", "translated_hi", SHARD, SHARDS_HERE, BATCH_HERE, "text").select("id", "title", "text")


@query(f"SELECT id, title FROM ({_EVENTS}) WHERE translated_hi = 0 AND id % {SHARDS_HERE} = {SHARD} ORDER BY id DESC LIMIT {BATCH_HERE}")
def event_batch_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.pending(_events(spark, sf_dir), "id", "translated_hi", SHARD, SHARDS_HERE, BATCH_HERE).select("id", "title")


@query(f"SELECT id, title FROM ({_EVENTS}) WHERE translated_hi = 0 AND id % {SHARDS_HERE} = {SHARD} ORDER BY id DESC LIMIT {BATCH_HERE}")
def parameter_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.pending_by_sql(_events(spark, sf_dir), "id", "translated_hi", SHARD, SHARDS_HERE, BATCH_HERE).select("id", "title")


@query(
    f"SELECT c.conv_id AS event_id, c.turn AS article_id, c.text AS milestone FROM conversations c JOIN ({_EVENTS}) e ON c.conv_id = e.id "
    f"WHERE e.translated_hi = 0 AND c.conv_id % {SHARDS_HERE} = {SHARD} ORDER BY 1, 2 LIMIT {BATCH_HERE}"
)
def milestone_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = jobs.Options(SHARD, SHARDS_HERE, BATCH_HERE)
    return jobs.pending_milestones(_events(spark, sf_dir), _milestones(spark, sf_dir), options).select("event_id", "article_id", "milestone")


@query("SELECT doc_id, replace(text, '**', '') AS text FROM documents WHERE text IS NOT NULL ORDER BY doc_id DESC LIMIT 300")
def corpus_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.corpus_sample(_t(spark, sf_dir, "documents"), "doc_id", "text")


@query(f"SELECT count(*) >= {BATCH_HERE} AS has_more FROM (SELECT id FROM ({_ARTICLES}) WHERE text IS NOT NULL AND translated_hi = 0 AND id % {SHARDS_HERE} = {SHARD} LIMIT {BATCH_HERE})")
def has_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.has_more(shard_batch_scan(spark, sf_dir), BATCH_HERE)


_COUNTED = ("documents", "conversations", "orders", "events")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _COUNTED) + " UNION ALL SELECT 'total', " + " + ".join(f"(SELECT count(*) FROM {t})" for t in _COUNTED))
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.row_counts({t: _t(spark, sf_dir, t) for t in _COUNTED})


# ---------------------------------------------------------------- text functions

_SPLIT = r"""string_split(regexp_replace(replace(regexp_replace(replace(text, '’', ''''), '^\s+|\s+$', '', 'g'), '**', ''), '([.!?])\s+([A-Z0-9"''(])', '\1' || chr(1) || '\2', 'g'), chr(1))"""
_PARTS = r"list_filter(list_transform({0}, lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"
_SENTENCES = _PARTS.format(_SPLIT)
_SIMPLE = _PARTS.format(r"string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))")


_MARKED = "replace(text, ' the ', ' **the** ')"


@query(f"SELECT doc_id, length(t) AS n, md5(t) AS digest FROM (SELECT doc_id, replace({_MARKED}, '**', '') AS t FROM documents)")
def markdown_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = text.strip_bold(F.expr(_MARKED))
    return _t(spark, sf_dir, "documents").select("doc_id", F.length(plain).cast("long").alias("n"), _md5(plain).alias("digest"))


@query(f"SELECT doc_id, length(s)::BIGINT AS n, md5(array_to_string(s, chr(10))) AS digest FROM (SELECT doc_id, {_SENTENCES} AS s FROM documents)")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _spread(_t(spark, sf_dir, "documents")).withColumn("s", text.sentences(F.col("text")))
    return docs.select("doc_id", F.size("s").cast("long").alias("n"), _md5(_lines(F.col("s"))).alias("digest"))


@query(f"SELECT doc_id, length(s)::BIGINT AS n, md5(array_to_string(s, chr(10))) AS digest FROM (SELECT doc_id, {_SIMPLE} AS s FROM documents)")
def sentence_split_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _spread(_t(spark, sf_dir, "documents")).withColumn("s", text.simple_sentences(F.col("text")))
    return docs.select("doc_id", F.size("s").cast("long").alias("n"), _md5(_lines(F.col("s"))).alias("digest"))


@query(f"SELECT doc_id, md5(array_to_string(s, ' ')) AS digest FROM (SELECT doc_id, {_SENTENCES} AS s FROM documents) WHERE length(s) > 0")
def sentence_rejoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spread(_t(spark, sf_dir, "documents"))
    # texts without sentences are dropped in a generator, as a filter would cut each text twice
    rows = rows.select("doc_id", F.explode(F.filter(F.array(text.sentences(F.col("text"))), lambda s: F.size(s) > 0)).alias("s"))
    return rows.select("doc_id", _md5(F.array_join("s", " ")).alias("digest"))


@query(f"SELECT doc_id, array_to_string({_numbers_sql('text')}, ' ') AS numbers FROM documents")
def numbers_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(text.numbers(F.col("text")), " ").alias("numbers"))


@query(
    f"""SELECT o_orderkey, length(missing) = 0 AS number_ok, array_to_string(missing, ' ') AS missing, array_to_string(extra, ' ') AS extra FROM (
  SELECT o_orderkey, list_filter(a, lambda n: NOT list_contains(b, n)) AS missing, list_filter(b, lambda n: NOT list_contains(a, n)) AS extra
  FROM (SELECT o_orderkey, {_numbers_sql("en")} AS a, {_numbers_sql("hi")} AS b FROM ({_ORDER_TEXTS})))"""
)
def number_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _order_texts(spark, sf_dir).withColumn("g", gates.number_gate(F.col("en"), F.col("hi")))
    return rows.select("o_orderkey", "g.number_ok", F.array_join("g.numbers_missing", " ").alias("missing"), F.array_join("g.numbers_extra", " ").alias("extra"))


_INJECTED = "CASE WHEN doc_id % 5 = 0 THEN text || ' жук ж' WHEN doc_id % 5 = 1 THEN text || ' हिन्दी' ELSE text END"


@query(f"SELECT doc_id, bad = '' AS script_ok, bad AS bad_chars FROM (SELECT doc_id, {_script_sql('t')} AS bad FROM (SELECT doc_id, {_INJECTED} AS t FROM documents))")
def script_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "documents").select("doc_id", gates.script_gate(F.expr(_INJECTED)).alias("g"))
    return rows.select("doc_id", "g.script_ok", "g.bad_chars")


@query(f"SELECT doc_id, length(e)::BIGINT AS n, md5(array_to_string(e, ' ')) AS digest FROM (SELECT doc_id, {_names_sql('text')} AS e FROM documents)")
def entities_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spread(_t(spark, sf_dir, "documents")).withColumn("e", text.names(F.col("text")))
    return rows.select("doc_id", F.size("e").cast("long").alias("n"), _md5(F.array_join("e", " ")).alias("digest"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("en"))
    said = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("hi"))
    return asked.join(said, ["conv_id", "turn"])


_PAIRS = "SELECT u.conv_id, u.turn, u.text AS en, a.text AS hi FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'"
_MISSING = "list_filter(e, lambda n: NOT contains(lower(hi || ' '), lower(n)))"


@query(
    f"SELECT conv_id, turn, length(m) <= greatest(1, length(e) // 4) AS entity_ok, array_to_string(m, ' ') AS missing FROM "
    f"(SELECT conv_id, turn, e, {_MISSING} AS m FROM (SELECT conv_id, turn, hi, {_names_sql('en')} AS e FROM ({_PAIRS})))"
)
def entity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pairs(spark, sf_dir).withColumn("g", gates.entity_gate(F.col("en"), F.col("hi"), None, off=False))
    return rows.select("conv_id", "turn", "g.entity_ok", F.array_join("g.entities_missing", " ").alias("missing"))


_VERIFIED = f"""SELECT conv_id, turn, length(list_filter({_numbers_sql("en")}, lambda n: NOT list_contains({_numbers_sql("hi")}, n))) = 0 AS number_ok,
  {_script_sql("hi")} = '' AS script_ok, length(list_filter({_names_sql("en")}, lambda n: NOT contains(lower(hi || ' '), lower(n)))) <= greatest(1, length({_names_sql("en")}) // 4) AS entity_ok FROM ({_PAIRS})"""


def _verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pairs(spark, sf_dir).withColumn("g", gates.verify(F.col("en"), F.col("hi"), None, off=False))
    return rows.select("conv_id", "turn", "g.passed", "g.number_ok", "g.script_ok", "g.entity_ok")


@query(f"SELECT conv_id, turn, number_ok AND script_ok AND entity_ok AS passed, number_ok, script_ok, entity_ok FROM ({_VERIFIED})")
def verify_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verified(spark, sf_dir)


@query(f"SELECT CASE WHEN number_ok AND script_ok AND entity_ok THEN 'publish' ELSE 'quarantine' END AS branch, count(*) AS n FROM ({_VERIFIED}) GROUP BY 1")
def publish_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _verified(spark, sf_dir).withColumn("branch", F.when(F.col("passed"), "publish").otherwise("quarantine"))
    return rows.groupBy("branch").agg(F.count("*").alias("n"))


_BODY = "CASE doc_id % 3 WHEN 0 THEN left(text, 40) || ' । ' || text WHEN 1 THEN '।' || text ELSE text END"


@query(f"SELECT doc_id, coalesce(nullif(regexp_replace(string_split(b, '।')[1], '^\\s+|\\s+$', '', 'g'), ''), left(b, 80)) AS title FROM (SELECT doc_id, {_BODY} AS b FROM documents)")
def title_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", text.title_fallback(F.expr(_BODY)).alias("title"))


@query("""SELECT doc_id, regexp_replace(trim(' "' || text || '।'' ', '"''। '), '^\\s+|\\s+$', '', 'g') AS title FROM documents""")
def title_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    quoted = F.concat(F.lit(' "'), F.col("text"), F.lit("।' "))
    return _t(spark, sf_dir, "documents").select("doc_id", text.title_trim(quoted).alias("title"))


@query("""SELECT doc_id, regexp_replace(t, '^["'']|["'']$', '', 'g') AS t FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '"' || text || '"' WHEN 1 THEN '''''' || text ELSE text END AS t FROM documents)""")
def quote_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.col("text")
    quoted = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('"'), head, F.lit('"'))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("''"), head)).otherwise(head)
    return _t(spark, sf_dir, "documents").select("doc_id", text.quote_strip(quoted).alias("t"))


# ---------------------------------------------------------------- the vocabulary miner

_STOP = ", ".join(f"'{w}'" for w in TARGET_STOP_WORDS)
_TOP = f"SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '\\p{{L}}+')) AS token FROM documents) WHERE length(token) >= 3 AND token NOT IN ({_STOP}) GROUP BY token ORDER BY n DESC, token LIMIT 250"


def _top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.top_tokens(_spread(_t(spark, sf_dir, "documents")), "text", text.letter_tokens)


@query(_TOP)
def token_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir)


_LOAN_PAIRS = [("कारण", "reason"), ("रूप", "form"), ("करने", "to do"), ("पुलिस", "Police"), ("बजट", " budget "), ("है।", "is."), ("जनता", "public"), ("फल", "fruit"), ("मकान", "house"), ("टमाटर", "tomato"),
    ("नगर", "city"), ("डॉक्टर", "doctor"), ("सरकार", "government"), ("मंत्री", "minister"), ("दल", ""), ("कलम", "column"), ("लंदन", "London"), ("न", "no"), ("बाज़ार", "bazaar"), ("स्कूल", "school")]
_LOANS = ", ".join(f"({k}, '{a}', '{b}')" for k, (a, b) in enumerate(_LOAN_PAIRS))
_ROMAN_SQL = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in ROMAN.items()) + "}"
_SEED_SQL = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in LOAN_SEED.items()) + "}"


@query(
    f"""WITH r AS (SELECT p_partkey, token, gloss, array_to_string(list_transform(regexp_extract_all(token, '(?s).'), lambda c: coalesce(({_ROMAN_SQL})[c], '')), '') AS a,
  regexp_replace(regexp_replace(lower(trim(gloss)), '[aeiou]', '', 'g'), '[^a-z]', '', 'g') AS b FROM (SELECT p_partkey, token, CASE WHEN p_size % 2 = 0 THEN gloss ELSE p_type END AS gloss FROM part JOIN (VALUES {_LOANS}) v(k, token, gloss) ON p_partkey % {len(_LOAN_PAIRS)} = k)),
s AS (SELECT *, CASE WHEN length(b) < length(a) THEN b ELSE a END AS x, CASE WHEN length(b) < length(a) THEN a ELSE b END AS y FROM r),
f AS (SELECT p_partkey, token, gloss, token IN (SELECT unnest(map_keys({_SEED_SQL}))) OR regexp_matches(token, '[\\x{{0911}}\\x{{091C}}\\x{{093C}}\\x{{092B}}\\x{{0929}}]')
  OR (length(x) >= 2 AND length(list_filter(regexp_extract_all(x, '.'), lambda c: contains(y, c))) / greatest(1, length(x)) >= 0.6) AS flag FROM s)
SELECT p_partkey, token, gloss, coalesce(({_SEED_SQL})[token], CASE WHEN flag THEN lower(trim(gloss)) END, '') AS suggest_latin, flag FROM f"""
)
def loan_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part has one of the tokens, and as its gloss that token's or the part's type."""
    pairs = F.array(*[F.struct(F.lit(a).alias("token"), F.lit(b).alias("gloss")) for a, b in _LOAN_PAIRS])
    rows = _t(spark, sf_dir, "part").withColumn("pair", F.get(pairs, F.col("p_partkey") % len(_LOAN_PAIRS)))
    rows = rows.select("p_partkey", "pair.token", F.when(F.col("p_size") % 2 == 0, F.col("pair.gloss")).otherwise(F.col("p_type")).alias("gloss"))
    token, gloss = F.col("token"), F.col("gloss")
    return rows.select("p_partkey", "token", "gloss", glossary.suggested_latin(token, gloss).alias("suggest_latin"), glossary.looks_loan(token, gloss).alias("flag"))


@query(f"SELECT rank, '| ' || rank || ' | ' || n || ' | ' || token || ' | ' || upper(token) || ' |  |  |' AS line FROM (SELECT row_number() OVER (ORDER BY n DESC, token) AS rank, n, token FROM ({_TOP}))")
def gloss_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mining.ranked(_top(spark, sf_dir))
    line = mining.report_line(F.col("rank"), F.col("n"), F.col("token"), F.upper("token"), F.lit(""), F.lit(False))
    return rows.select(F.col("rank").cast("long").alias("rank"), line.alias("line"))


# ---------------------------------------------------------------- masks and glossary


def _entries(x: str) -> Column:
    return F.array_join(F.transform(f"{x}.entries", lambda e: F.concat(e["placeholder"], F.lit("="), e["original"])), ";")


_CLOCK = "SELECT event_id, 'Seen at ' || strftime(ts, '%-I.%M') || ' am and ' || strftime(ts, '%I:%M') || 'pm, code 99.75' AS t, strftime(ts, '%-I:%M') || ' am' AS a, strftime(ts, '%I:%M') || 'pm' AS b, strftime(ts, '%-I.%M') || ' am' AS a0 FROM events"


@query(f"SELECT event_id, 'Seen at __TIME_0__ and __TIME_1__, code 99.75' AS t, '__TIME_0__=' || a || ';__TIME_1__=' || b AS entries FROM ({_CLOCK})")
def mask_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    sentence = F.concat(F.lit("Seen at "), F.date_format("ts", "h.mm"), F.lit(" am and "), F.date_format("ts", "hh:mm"), F.lit("pm, code 99.75"))
    rows = _t(spark, sf_dir, "events").select("event_id", mask.mask_times(mask.unmasked(sentence)).alias("m"))
    return rows.select("event_id", F.col("m.text").alias("t"), _entries("m").alias("entries"))


@query("""SELECT o_orderkey, 'Paid __MONEY_0__ and __MONEY_1__fee' AS t, '__MONEY_0__=$' || total || ' million;__MONEY_1__=Rs. ' || o_orderkey || ' ' AS entries
FROM (SELECT o_orderkey, o_totalprice::DECIMAL(12,2)::VARCHAR AS total FROM orders)""")
def mask_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    sentence = F.concat(F.lit("Paid $"), total, F.lit(" million and Rs. "), F.col("o_orderkey").cast("string"), F.lit(" fee"))
    # the white space after a number is part of its match, and so of what stands behind the placeholder
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", mask.mask_money(mask.unmasked(sentence)).alias("m"))
    return rows.select("o_orderkey", F.col("m.text").alias("t"), _entries("m").alias("entries"))


@query("""SELECT c_custkey, '__NOUN_0__ met New Delhi Police, and __NOUN_0__ paid ' || c_mktsegment AS t, '__NOUN_0__=Narendra Modi Roy' AS entries FROM customer""")
def mask_nouns(spark: SparkSession, sf_dir: str) -> DataFrame:
    sentence = F.concat(F.lit("Narendra Modi Roy met New Delhi Police, and Narendra Modi Roy paid "), F.col("c_mktsegment"))
    rows = _t(spark, sf_dir, "customer").select("c_custkey", mask.mask_nouns(mask.unmasked(sentence)).alias("m"))
    return rows.select("c_custkey", F.col("m.text").alias("t"), _entries("m").alias("entries"))


@query("SELECT doc_id, true AS same, md5(text) AS digest FROM documents")
def unmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spread(_t(spark, sf_dir, "documents")).withColumn("m", mask.mask_nouns(mask.unmasked(F.col("text"))))
    back = mask.unmask(F.col("m.text"), F.col("m.entries"))
    return rows.select("doc_id", (back == F.col("text")).alias("same"), _md5(back).alias("digest"))


@query()
def mask_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _spread(_t(spark, sf_dir, "documents")).select("doc_id", mask.unmasked(F.col("text")).alias("m"))
    rows = docs.withColumn("m", mask.mask_terms(F.col("m")))
    return rows.select("doc_id", F.col("m.text").alias("t"), _entries("m").alias("entries"))


@query()
def mask_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_masks(_spread(_t(spark, sf_dir, "documents").select("doc_id", "text")), "text", "m")
    return rows.select("doc_id", F.col("m.text").alias("t"), _entries("m").alias("entries"))


_GLOSSARY = {"पुलिस": "police", "कोर्ट": "court", "हाई कोर्ट": "high court", "बजट": "budget"}


@query("SELECT o_orderkey, 'police पुलिसवाला budget कोर्ट। high court ' || o_orderkey || ' court, ' || o_orderpriority AS t FROM orders")
def glossary_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.lit(" पुलिस  पुलिसवाला \tबजट कोर्ट। हाई कोर्ट "), F.col("o_orderkey").cast("string"), F.lit(" कोर्ट, "), F.col("o_orderpriority"), F.lit(" "))
    return _t(spark, sf_dir, "orders").select("o_orderkey", glossary.apply_glossary(said, _GLOSSARY).alias("t"))


# ---------------------------------------------------------------- state transitions


@query("SELECT user_id, arg_max(event_type, (k, ts, event_id)) AS title FROM (SELECT *, CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS k FROM events) GROUP BY user_id")
def translation_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views are the target's state, all other events replace it."""
    log = _t(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("title"), "ts", "event_id")
    target = state.latest(log.filter("title = 'view'"), ["user_id"], ["ts", "event_id"])
    return state.replace_by_key(target, log.filter("title <> 'view'"), ["user_id"], ["ts", "event_id"])


@query("SELECT conv_id AS event_id, arg_max('new ' || text, turn) AS title_hi FROM conversations GROUP BY conv_id")
def event_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("event_id"), F.concat(F.lit("new "), F.col("text")).alias("title_hi"), "turn")
    target = turns.filter("turn = 0").select("event_id", F.lit("old").alias("title_hi"))
    return state.replace_by_key(target, turns, ["event_id"], ["turn"])


@query("SELECT l_orderkey, l_linenumber, arg_max(m, (k, l_shipdate, l_partkey, l_suppkey, m)) AS milestone FROM (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_returnflag || l_linestatus AS m, CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS k FROM lineitem) GROUP BY 1, 2")
def milestone_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat("l_returnflag", "l_linestatus").alias("milestone"), "l_shipdate", "l_partkey", "l_suppkey", F.concat("l_returnflag", "l_linestatus").alias("m"), (F.col("l_returnflag") == "N").alias("new"))
    keys, order = ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "m"]
    target = state.latest(lines.filter("not new").drop("new"), keys, order)
    return state.replace_by_key(target, lines.filter("new").drop("new"), keys, order)


_FAILED = "SELECT user_id AS article_id, count(*) AS attempts, left(arg_max(props, (ts, event_id)), 500) AS last_error FROM events WHERE event_type = 'error' GROUP BY user_id"


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _t(spark, sf_dir, "events").filter("event_type = 'error'").select(F.col("user_id").alias("article_id"), F.col("props").alias("error"), "ts", "event_id")
    empty = spark.createDataFrame([], "article_id long, attempts long, last_error string")
    order = ["ts", "event_id"]
    # in two steps, as two runs would do it
    half = state.count_failures(empty, log.filter("ts < timestamp '2024-01-10'"), "article_id", order)
    return state.count_failures(half, log.filter("ts >= timestamp '2024-01-10'"), "article_id", order)


@query(_FAILED)
def failure_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failures(spark, sf_dir)


@query(f"SELECT * FROM ({_FAILED}) WHERE article_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 90)")
def failure_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _t(spark, sf_dir, "events").filter("event_type = 'purchase' and value > 90").select(F.col("user_id").alias("article_id"))
    return state.clear(_failures(spark, sf_dir), done, "article_id")


_USERS = "SELECT DISTINCT user_id AS article_id FROM events"


@query(f"SELECT u.article_id, CASE WHEN f.attempts >= 3 THEN 2 ELSE 0 END AS translated_hi FROM ({_USERS}) u LEFT JOIN ({_FAILED}) f ON u.article_id = f.article_id")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _t(spark, sf_dir, "events").select(F.col("user_id").alias("article_id")).distinct().withColumn("translated_hi", F.lit(0))
    return state.quarantine(table, _failures(spark, sf_dir), "article_id", "translated_hi")


@query(f"SELECT id, CASE WHEN id % 7 = 0 THEN 1 ELSE translated_hi END AS translated_hi FROM ({_ARTICLES})")
def status_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _articles(spark, sf_dir).select("id", "translated_hi")
    return state.publish(table, table.filter("id % 7 = 0"), "id", "translated_hi")


# ---------------------------------------------------------------- nested records

_INCIDENT = "struct<source_url:string,incident_text:string,extra:map<string,string>>"


def _incidents(spark: SparkSession, sf_dir: str, old: bool) -> DataFrame:
    """Incidents by user from events: the old ones have the URLs of even numbers, the new ones all, and some none."""
    n = F.get_json_object("props", "$.k").cast("int") % 6
    url = F.when(n == 5, F.lit(None)).when(n == 4, F.lit("")).otherwise(F.concat(F.lit("u"), n.cast("string")))
    incident = F.struct(url.alias("source_url"), F.col("event_type").alias("incident_text"), F.create_map(F.lit("id"), F.col("event_id").cast("string")).alias("extra"))
    rows = _t(spark, sf_dir, "events").filter((n % 2 == 0) if old else F.lit(True)).select("user_id", "event_id", incident.alias("incident"))
    listed = rows.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "incident")), lambda a, b: (a["event_id"] - b["event_id"]).cast("int")).alias("all"))
    return listed.select("user_id", F.transform("all", lambda x: x["incident"]).alias("old" if old else "new"))


_SQL_INCIDENTS = """SELECT user_id, event_id, event_type, CASE WHEN n = 5 THEN NULL WHEN n = 4 THEN '' ELSE 'u' || n END AS url, n FROM
  (SELECT user_id, event_id, event_type, (props->>'$.k')::INT % 6 AS n FROM events)"""


@query(f"""WITH i AS ({_SQL_INCIDENTS}), old AS (SELECT user_id, list(url) AS urls, string_agg(coalesce(url, '-') || ':' || event_type, ',' ORDER BY event_id) AS o FROM i WHERE n % 2 = 0 GROUP BY user_id),
new AS (SELECT i.user_id, string_agg(i.url || ':' || upper(event_type), ',' ORDER BY event_id) FILTER (i.url <> '' AND NOT coalesce(list_contains(old.urls, i.url), false)) AS a FROM i LEFT JOIN old ON i.user_id = old.user_id GROUP BY i.user_id)
SELECT new.user_id, concat_ws(',', o, a) AS incidents FROM new LEFT JOIN old ON new.user_id = old.user_id""")
def nested_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _incidents(spark, sf_dir, False).join(_incidents(spark, sf_dir, True), "user_id", "left")
    merged = nested.append_new(F.col("old"), F.col("new"), F.upper)
    line = F.array_join(F.transform(merged, lambda c: F.concat(F.coalesce(c["source_url"], F.lit("-")), F.lit(":"), c["incident_text"])), ",")
    return both.select("user_id", line.alias("incidents"))


def _persons(rows: DataFrame, key: str, name: str, version: str) -> DataFrame:
    """Persons from suppliers: a known part and new ones."""
    none = F.array().cast(f"array<{_INCIDENT}>")
    return rows.select(
        F.lit("generic_politicians").alias("category"), F.col(key).alias("pos"), F.col(name).alias("name"), F.concat(F.lit(f"role {version} "), F.col(key).cast("string")).alias("role"),
        F.lit(version).alias("party"), F.when(F.col(key) % 2 == 0, F.lit("even")).alias("state"), F.lit(f"seat {version}").alias("constituency"), F.when(F.col(key) % 3 == 0, F.col(key).cast("int")).alias("criminal_cases"),
        F.lit(0).alias("criminal_cases_in_news"), F.lit(f"wiki {version}").alias("wikipedia"), F.lit("").alias("affidavit_url"), F.lit("").alias("image_placeholder"), none.alias("controversies"), none.alias("criminal_incidents"),
    )


@query("""SELECT s_name AS name, s_suppkey AS pos, upper(s_name) AS name_hi, 'role new ' || s_suppkey AS role, 'ROLE NEW ' || s_suppkey AS role_hi, CASE WHEN s_suppkey % 2 = 0 THEN 'even' ELSE '' END AS state,
CASE WHEN s_suppkey % 4 = 0 THEN 'seat new' ELSE 'seat old' END AS constituency, CASE WHEN s_suppkey % 4 = 0 THEN 'wiki new' ELSE 'wiki old' END AS wikipedia,
CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey::INT ELSE 0 END AS criminal_cases FROM supplier WHERE s_suppkey % 5 <> 0""")
def entity_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = _t(spark, sf_dir, "supplier")
    library = _persons(suppliers.filter("s_suppkey % 5 <> 0"), "s_suppkey", "s_name", "new")
    old = _persons(suppliers.filter("s_suppkey % 4 <> 0"), "s_suppkey", "s_name", "old")
    hi = [F.upper(c).alias(f"{c}_hi") for c in ("name", "role", "party", "state", "constituency")]
    out = jobs.entities(library, old.select("*", *hi), F.upper)
    return out.select("name", F.col("pos").cast("long").alias("pos"), "name_hi", "role", "role_hi", "state", "constituency", "wikipedia", "criminal_cases")


# ---------------------------------------------------------------- blobs and the flagship


@query("SELECT doc_id, md5(text) AS digest, CAST(NULL AS VARCHAR) AS error FROM documents")
def blob_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spread(_t(spark, sf_dir, "documents")).select("doc_id", inflate(deflate(F.col("text"))).alias("b"))
    return rows.select("doc_id", _md5(F.col("b.text")).alias("digest"), F.col("b.error").alias("error"))


@query()
def translate_verify_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pending documents translated and judged, with the status that they get."""
    rows = _articles(spark, sf_dir).filter("translated_hi = 0 and text is not null").select("id", "title", F.col("text").alias("body"))
    done = jobs.judged(_spread(rows), Lexicon(), {})
    status = F.when(F.col("error").isNull(), state.PUBLISHED).otherwise(state.PENDING)
    return done.select("id", "title_hi", "body_hi", "gates.number_ok", "gates.script_ok", F.left("error", F.lit(500)).alias("error"), status.alias("translated_hi"))
