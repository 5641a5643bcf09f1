"""Every registered query against its SQL on DuckDB."""

import math
import os
from decimal import Decimal

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
# The queries of the subpackage for documents are tested beside it.
OWN = [name for name in entry.queries() if name not in entry._llm_queries()]
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{SF_DIR}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(OWN) == set(entry.oracle_sql()) - set(entry._llm_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, oracle, name):
    got = entry.queries()[name](spark, SF_DIR)
    found = oracle.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(got.columns)
    expected = _rows(columns, found.fetchall())
    assert expected, "the query must give rows to compare"
    assert _rows(got.columns, got.collect()) == expected


@pytest.mark.parametrize("name", ["consolidate", "consolidate_best", "left_equi_join", "id_generate"])
def test_query_without_automatic_broadcasts(spark, oracle, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        test_query(spark, oracle, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_words_of_any_length_are_searched(spark, oracle):
    words = oracle.execute("select distinct upper(unnest(regexp_split_to_array(text, '[^A-Za-z]+'))) from benchmark").fetchall()
    words = {w for w, in words if w}
    texts = [t.replace("ß", "ss").upper() for t, in oracle.execute("select text from documents").fetchall()]
    wanted = {w: sum(w in t for t in texts) for w in words if len(w) < 4}
    got = entry.queries()["substring_join_all_words"](spark, SF_DIR).collect()
    found = {r["palavra"]: r["n"] for r in got if r["palavra"] is not None and len(r["palavra"]) < 4}
    assert found and found == {w: n for w, n in wanted.items() if n}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
