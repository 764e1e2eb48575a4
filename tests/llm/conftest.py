import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ("size", "score", "kept", "copies", "sequence_id", "bucket", "node", "spans", "_text", "digest", "id", "row", "key")


def prose(seed, n):
    rng = random.Random(seed)
    syllables = "the of and er on st re an ti en ou ha nd ed".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    long = prose(9, 60_000)
    return [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \t\n", None, None, 3),
        (4, "one", "en", None, 3),
        (5, prose(1, 120), "en", "b", 1),
        (5, prose(1, 120), "en", "b", 1),
        (6, prose(1, 120), "en", "c", 1),
        (7, long, "en", "a", 1),
        (8, "word " * 400, "en", "a", 1),
        (9, "é 漢字 😀 \x1c\x85\xa0 <|endoftext|> ﬁ", "en", "a", 1),
        (None, prose(2, 60), "en", "a", 1),
        (None, None, None, None, None),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit("x").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
