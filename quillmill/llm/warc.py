"""Archive records from WARC files, as resolve() of revisits takes them. Built-in Spark expressions only.

A file is read as text that is cut before each record's version line, so a plain one is split among tasks and one of
gzip members, a member a record, is unpacked as a stream; no file has to fit into memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What stands between two records, up to the last figure of the next one's version.
SEPARATOR = "\r\n\r\nWARC/1."
#: Fixed value: the profile of revisits that say that a page had not changed.
NOT_MODIFIED = "server-not-modified"


def _fields(block: Column) -> Column:
    """A header block's fields by lower-case name, the first of repeats; lines that start with white space go on the one before."""
    lines = F.split(F.regexp_replace(block, "\r?\n[ \\t]+", " "), "\r?\n")
    pairs = F.transform(F.filter(lines, lambda x: x.contains(":")), lambda x: F.struct(F.lower(F.trim(F.split_part(x, F.lit(":"), F.lit(1)))).alias("k"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("v")))
    first = F.filter(pairs, lambda p, i: F.array_position(F.transform(pairs, lambda q: q["k"]), p["k"]) == i + 1)
    return F.map_from_entries(first)


def records(spark: SparkSession, path: str) -> DataFrame:
    """record_id, url, ts (microseconds), revisit, etag, last_modified, headers, digest of the WARC files at path.

    Full responses are response records with status 200; revisits are revisit records whose profile is that of a
    not-modified answer, and have the URL of the record that they refer to, if they name it. Other records are left
    out. Missing fields are null, an empty file gives no rows. A body is not returned, only its digest; one that has
    a record separator inside it gives further pieces, which have no record type and so are left out.
    """
    raw = spark.read.text(path, lineSep=SEPARATOR)
    # a record: its version's last figure, its fields, an empty line, the answer's head, an empty line, the body
    parts = raw.select(F.split_part("value", F.lit("\r\n\r\n"), F.lit(1)).alias("own"), F.split_part("value", F.lit("\r\n\r\n"), F.lit(2)).alias("answer"))
    parsed = parts.select(_fields(F.col("own")).alias("own"), F.regexp_extract("answer", r"^HTTP/\S+ +([0-9]{3})", 1).alias("code"), _fields(F.col("answer")).alias("headers"))

    def own(name: str) -> Column:
        return F.try_element_at("own", F.lit(name))

    kind = own("warc-type")
    revisit = (kind == "revisit") & F.coalesce(own("warc-profile").contains(NOT_MODIFIED), F.lit(False))
    wanted = parsed.filter(((kind == "response") & (F.col("code") == "200")) | revisit)
    moment = F.unix_micros(F.try_to_timestamp(own("warc-date"), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][.SSSSSS][.SSS]X")))
    return wanted.select(
        own("warc-record-id").alias("record_id"), F.coalesce(F.when(revisit, own("warc-refers-to-target-uri")), own("warc-target-uri")).alias("url"), moment.alias("ts"), F.coalesce(revisit, F.lit(False)).alias("revisit"),
        F.try_element_at("headers", F.lit("etag")).alias("etag"), F.try_element_at("headers", F.lit("last-modified")).alias("last_modified"), "headers",
        F.when(~revisit, own("warc-payload-digest")).alias("digest"),
    )
