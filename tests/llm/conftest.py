import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

WORDS = "the and of with stone river light under over green small house tree water night day".split()


def prose(seed: int, n: int) -> str:
    """``n`` words without two that stand beside each other often."""
    state, out = seed * 7919 + 1, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state >> 8 & 15] + str(state >> 16 & 255))
    return " ".join(out)


LONG = prose(5, 6000)
BASE = prose(1, 120)
NEAR = BASE.rsplit(" ", 2)[0] + " other end"

#: doc_id, text, lang, source: nulls, empty and long texts, copies, near copies and repeated rows.
MESSY = [
    (1, BASE, "en", "a"),
    (2, BASE, "en", None),
    (3, BASE.upper(), None, "a"),
    (4, NEAR, "de", "b"),
    (5, "", "en", "a"),
    (6, None, "en", "a"),
    (7, " \t\n ", "en", "a"),
    (8, "three short words", "en", "b"),
    (9, "Three  short\twords", "en", "b"),
    (10, LONG, "en", "b"),
    (10, LONG, "en", "b"),
    (None, prose(9, 60), "en", "b"),
    (None, None, None, None),
    (11, prose(11, 40) + " ünïcödé 漢字かな \U0001f600 <|endoftext|> " + prose(12, 5), "fr", "c"),
    (12, "x" * 30_000, None, "c"),
    (13, "漢" * 9_000, "zh", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
#: Columns of a caller that are named like those that operators make on the way.
CLASHING = "node cluster bucket key part group rank features label place ids component _may_go _at at".split()


@pytest.fixture(scope="session")
def messy(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(MESSY, SCHEMA).repartition(3)
    return rows.withColumns({name: F.lit(name) for name in CLASHING})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    """Texts of the test tables by doc_id, in order."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return dict(sorted((r["doc_id"], r["text"]) for r in rows))
