"""Compressed text blobs. Spark has no zlib functions, so these are Arrow-batched UDFs."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column

from quillmill.functions.batches import by_batches


def _inflate_one(blob: object) -> tuple[str | None, str | None]:
    if blob is None:
        return None, "decompress: no data"
    try:
        return zlib.decompress(blob).decode("utf-8"), None
    except (zlib.error, TypeError, UnicodeDecodeError) as e:
        return None, f"decompress: {e}"


def inflate(blob: Column) -> Column:
    """A struct of text and error; one of the two is null."""

    def run(blobs: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_inflate_one(b) for b in blobs], columns=["text", "error"])

    return by_batches(run, "text string, error string")(blob)


def deflate(text: Column) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else zlib.compress(x.encode()))

    return by_batches(run, "binary")(text)
