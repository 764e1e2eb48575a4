"""Not-modified revisits of an archive, resolved to the full response that they stand for.

A revisit record says that a page had not changed and holds no body. Each one is joined as of its time to the latest
earlier full response of the same canonical URL; if its validators agree, it takes that response's body and headers,
updated by those of its own that a not-modified answer may update. Built-in Spark expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers of a not-modified answer that update the stored ones.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Time buckets that a URL's records are dealt into.
BUCKETS = 64


#: Escapes of characters that need none, by their two digits.
_PLAIN = {f"{ord(c):02X}": c for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-._~"}
TRACKING = "^utm_[a-z]+="


def _unescaped(x: Column) -> Column:
    """Escapes of characters that need none decoded, the others in capitals."""

    def one(part: Column, k: Column) -> Column:
        digits = F.upper(F.left(part, F.lit(2)))
        known = F.create_map(*[F.lit(v) for pair in _PLAIN.items() for v in pair])
        fixed = F.concat(F.coalesce(F.try_element_at(known, digits), F.concat(F.lit("%"), digits)), F.substring(part, 3, 2**31 - 1))
        return F.when(k == 0, part).when(digits.rlike("^[0-9A-F]{2}$"), fixed).otherwise(F.concat(F.lit("%"), part))

    return F.array_join(F.transform(F.split(x, "%", -1), one), "")


def canonical_url(url: Column) -> Column:
    """Without scheme, www., default port, fragment, tracking parameters, empty parameters and last slash; the host in lower case, parameters sorted, escapes alike. Null stays null."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z]+://", "")
    host = F.lower(F.regexp_extract(bare, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www[.]", ""), ":(80|443)$", "")
    rest = _unescaped(F.regexp_extract(bare, "^[^/?]*(.*)$", 1))
    path, query = F.regexp_replace(F.regexp_extract(rest, "^([^?]*)", 1), "/$", ""), F.regexp_extract(rest, "^[^?]*[?](.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def resolve(records: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """record_id, url_key, response_id, status, headers, digest for each revisit.

    records: record_id, url, ts (long), revisit (boolean), etag, last_modified (strings), headers (map of lower-case
    names), digest (of a full response's body). status: resolved; no response, if none is earlier; or mismatch, if a
    validator that both have differs, or neither kind is in both. Only resolved revisits have headers and digest.
    Of responses with one time the one with the larger record_id counts; a response at the revisit's own time counts
    as earlier. Null URLs and times match nothing. Repeated revisits are resolved each. Other columns aren't read.

    An empty table gives no rows, and headers may be null. Long URLs and headers are taken whole.

    A URL may hold any share of the records: they are dealt by (URL, time bucket). Within a bucket the latest response
    is carried along in order of time; what a bucket gets from earlier ones comes from their last responses, a row a
    bucket of a URL.
    """
    some = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), F.col("ts").cast("long").alias("ts"), "revisit", "etag", "last_modified", "headers", "digest")
    shares = [k / buckets for k in range(1, buckets)]
    bounds = sorted(set(some.agg(F.percentile_approx("ts", shares, 10 * buckets)).first()[0] or []))  # buckets - 1 numbers
    placed = some.withColumn("bucket", F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]).cast("array<bigint>"), lambda b: b < F.col("ts"))))
    full = F.struct("ts", "record_id", "etag", "last_modified", "headers", "digest")
    usable = ~F.col("revisit") & F.col("url_key").isNotNull() & F.col("ts").isNotNull()
    placed = placed.withColumn("response", F.when(usable, full))
    # at one time responses come before revisits
    order = Window.partitionBy("url_key", "bucket").orderBy("ts", "revisit", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    within = placed.withColumn("near", F.last("response", ignorenulls=True).over(order)).filter("revisit")
    # a URL has `buckets` rows here at most
    known = placed.filter("url_key is not null and ts is not null").groupBy("url_key", "bucket")
    ends = known.agg(F.max_by("response", F.when(F.col("response").isNotNull(), F.struct("ts", "record_id"))).alias("response"), F.max("revisit").alias("asks"))
    before = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.withColumn("far", F.last("response", ignorenulls=True).over(before)).filter("asks and far is not null")
    handed = handed.select(F.col("url_key").alias("_url"), F.col("bucket").alias("_bucket"), "far")
    both = within.join(handed, (F.col("url_key") == F.col("_url")) & (F.col("bucket") == F.col("_bucket")) & F.col("ts").isNotNull(), "left")
    found = both.withColumn("of", F.coalesce("near", "far"))
    same_tag, same_date = F.col("etag") == F.col("of.etag"), F.col("last_modified") == F.col("of.last_modified")
    agrees = F.coalesce(same_tag, same_date, F.lit(False)) & F.coalesce(same_date, F.lit(True))
    status = F.when(F.col("of").isNull(), "no response").when(agrees, "resolved").otherwise("mismatch")
    own = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(F.coalesce("of.headers", F.create_map().cast("map<string,string>")), lambda k, _: ~F.map_contains_key(own, k))
    ok = F.col("status") == "resolved"
    return found.withColumn("status", status).select(
        "record_id", "url_key", F.col("of.record_id").alias("response_id"), "status", F.when(ok, F.map_concat(kept, own)).alias("headers"), F.when(ok, F.col("of.digest")).alias("digest")
    )


def crawls(pages: DataFrame) -> DataFrame:
    """Archive records of pages, as five crawls might have made them; a record's id is 8 * page_id + the crawl, and so is its place in time.

    Crawl 0 got not-modified for each fifth page, before any response. Crawl 1 got all pages in full but each seventh.
    Crawl 2 got not-modified for all, with an entity tag for even pages and a date for odd ones. Crawl 3 got a changed
    version of each third page. Crawl 4 got not-modified for all, with the validators of crawl 1.
    """
    page, html = F.col("page_id"), F.coalesce(F.col("html"), F.lit(""))
    first, second = F.md5(html.cast("binary")), F.md5(F.concat(html, F.lit(" changed")).cast("binary"))
    dates = [F.concat(F.lit(f"day {k} of "), page.cast("string")) for k in range(5)]

    def full(k: int, tag: Column, body: Column) -> Column:
        headers = F.create_map(F.lit("etag"), tag, F.lit("last-modified"), dates[k], F.lit("content-type"), F.lit("text/html"), F.lit("date"), dates[k])
        return F.struct(F.lit(k).alias("crawl"), F.lit(False).alias("revisit"), tag.alias("etag"), dates[k].alias("last_modified"), headers.alias("headers"), F.sha2(body.cast("binary"), 256).alias("digest"))

    def not_modified(k: int, tag: Column, date: Column) -> Column:
        given = F.create_map(F.lit("content-length"), F.lit("0"), F.lit("date"), dates[k], F.lit("etag"), tag, F.lit("last-modified"), date)
        headers = F.map_filter(given, lambda _, v: v.isNotNull())
        return F.struct(F.lit(k).alias("crawl"), F.lit(True).alias("revisit"), tag.alias("etag"), date.alias("last_modified"), headers.alias("headers"), F.lit(None).cast("string").alias("digest"))

    none, even = F.lit(None).cast("string"), page % 2 == 0
    records = F.array(
        F.when(page % 5 == 0, not_modified(0, first, none)), F.when(page % 7 != 0, full(1, first, html)), not_modified(2, F.when(even, first), F.when(~even, dates[1])),
        F.when(page % 3 == 0, full(3, second, F.concat(html, F.lit(" changed")))), not_modified(4, first, dates[1]),
    )
    each = pages.select("page_id", "url", F.explode(F.filter(records, lambda r: r.isNotNull())).alias("r"))
    return each.select((page * 8 + F.col("r.crawl")).alias("record_id"), "url", (F.col("r.crawl") * F.lit(1 << 40) + page).alias("ts"), "r.revisit", "r.etag", "r.last_modified", "r.headers", "r.digest")


def resolved_pages(pages: DataFrame) -> DataFrame:
    """resolve() of crawls(), with the merged headers as sorted name=value text."""
    text = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    out = resolve(crawls(pages))
    return out.select("record_id", F.floor(F.col("record_id") / 8).alias("page_id"), "url_key", "response_id", "status", text.alias("headers"), "digest")


_ESCAPES_SQL = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in _PLAIN.items()) + "}"
RESOLVED_SQL = rf"""
WITH bare AS (SELECT page_id, coalesce(html, '') AS html, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z]+://', '') AS b FROM pages),
cut AS (SELECT page_id, html, regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^www[.]', ''), ':(80|443)$', '') AS host, b IS NULL AS absent,
  string_split(regexp_extract(b, '^[^/?]*(.*)$', 1), '%') AS parts FROM bare),
plain AS (SELECT page_id, html, host, absent, parts[1] || array_to_string(list_transform(parts[2:], lambda x: CASE WHEN regexp_full_match(upper(left(x, 2)), '[0-9A-F][0-9A-F]')
  THEN coalesce(({_ESCAPES_SQL})[upper(left(x, 2))], '%' || upper(left(x, 2))) || substr(x, 3) ELSE '%' || x END), '') AS rest FROM cut),
query AS (SELECT page_id, html, host, absent, regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '/$', '') AS path,
  array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*[?](.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}'))), '&') AS q FROM plain),
keyed AS (SELECT page_id, html, CASE WHEN NOT absent THEN host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS url_key, md5(html) AS first, md5(html || ' changed') AS second,
  'day 1 of ' || page_id AS day1 FROM query),
responses AS (SELECT url_key, page_id * 8 + 1 AS id, (1::BIGINT << 40) + page_id AS ts, first AS etag, day1 AS lm, sha256(html) AS digest FROM keyed WHERE page_id % 7 <> 0
  UNION ALL SELECT url_key, page_id * 8 + 3, 3 * (1::BIGINT << 40) + page_id, second, 'day 3 of ' || page_id, sha256(html || ' changed') FROM keyed WHERE page_id % 3 = 0),
revisits AS (SELECT url_key, page_id, 0 AS crawl, first AS etag, NULL AS lm FROM keyed WHERE page_id % 5 = 0
  UNION ALL SELECT url_key, page_id, 2, CASE WHEN page_id % 2 = 0 THEN first END, CASE WHEN page_id % 2 <> 0 THEN day1 END FROM keyed
  UNION ALL SELECT url_key, page_id, 4, first, day1 FROM keyed),
asked AS (SELECT *, page_id * 8 + crawl AS record_id, crawl * (1::BIGINT << 40) + page_id AS ts FROM revisits),
found AS (SELECT a.*, r.id, r.etag AS r_etag, r.lm AS r_lm, r.digest, CASE WHEN r.id IS NULL THEN 'no response'
    WHEN coalesce(a.etag = r.etag, a.lm = r.lm, false) AND coalesce(a.lm = r.lm, true) THEN 'resolved' ELSE 'mismatch' END AS status
  FROM asked a ASOF LEFT JOIN responses r ON a.url_key = r.url_key AND a.ts >= r.ts)
SELECT record_id, page_id, url_key, id AS response_id, status, CASE WHEN status = 'resolved' THEN 'content-type=text/html;date=day ' || crawl || ' of ' || page_id
  || ';etag=' || coalesce(etag, r_etag) || ';last-modified=' || coalesce(lm, r_lm) END AS headers, CASE WHEN status = 'resolved' THEN digest END AS digest FROM found"""
