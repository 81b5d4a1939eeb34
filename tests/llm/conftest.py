import random

import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

# Names that operators use inside; extra columns must be free to have them.
CLASHING = ("row", "size", "shard", "slot", "tokens", "topic", "key", "cid", "k1", "n", "_text", "tox_score", "id", "hash")


def prose(seed, words):
    draw = random.Random(seed)
    syllables = "an the re ti on er in at or es nd th st en ou".split()
    return " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def documents(spark):
    """NULLs, empty and long texts, copies, repeated rows and ids, and extra columns with clashing names."""
    long = prose(1, 30_000)
    base = prose(2, 200)
    near = base.split()
    near[100] = "changed"
    rows = [
        (1, None, "en", "s0"), (2, "", "en", "s0"), (3, " \t\n ", None, None), (4, "Word", "en", "s1"),
        (5, base, "en", "s0"), (6, base, "de", "s1"), (7, " ".join(near), "en", "s0"), (8, base.upper(), "fr", "s2"),
        (9, long, "en", "s0"), (10, "x " * 300, "en", "s0"), (11, "ünï " * 60 + "çödé", "fr", "s1"),
        (12, "token = \"0641917ea4e9feb9cda83477b57ac2654884f485\" and 0641917ea4e9feb9cda83477b57ac2654884f485", "en", "s1"),
        (12, "same id, another text " + prose(3, 60), "en", "s1"), (13, prose(4, 60), "en", "s0"),
        (13, prose(4, 60), "en", "s0"), (None, prose(5, 60), "en", "s0"), (None, None, None, None),
        (2**62 + 1, prose(6, 60), "en", "s0"),
    ]
    schema = T.StructType.fromDDL("doc_id long, text string, lang string, source string")
    for name in CLASHING:
        schema = schema.add(name, T.StringType())
    return spark.createDataFrame([r + ("extra",) * len(CLASHING) for r in rows], schema)


@pytest.fixture(scope="session")
def plain_rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.collect()]


def table_rows(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet").collect()
