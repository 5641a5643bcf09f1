"""Loads called again after every kind of end, and appends that open the files they must."""

import os
import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.checks import KeyViolation
from ledgerloom.plans import ledger, load
from ledgerloom.plans.ledger import Ledger, UnfinishedLoad, abandon, load_once, published
from ledgerloom.plans.load import load_frame
from ledgerloom.sinks import key_index
from ledgerloom.sinks.key_index import files_that_may_hold, rows_of_files, table_files
from ledgerloom.sinks.tables import ensure_schema, write_table


class Killed(RuntimeError):
    pass


@pytest.fixture
def schema(spark, tmp_path):
    name = f"s_{uuid.uuid4().hex}"
    ensure_schema(spark, name, str(tmp_path / name))
    return name


@pytest.fixture
def folder(spark, tmp_path):
    rows = spark.range(0, 60, 1, 3).selectExpr("if(id % 10 = 3, 'much too long a text', 'S' || id % 3) as Segmento", "id as CNPJ", "'n' || id as Nome")
    rows.write.option("header", True).csv(str(tmp_path / "in"))
    return str(tmp_path / "in")


def _load(spark, schema, folder):
    return load_once(
        spark, folder, f"{schema}.bancos", glob="*.csv", types={"cnpj": "string"}, declared="bancos_enquadramento",
        key_columns=("cnpj",), rejects=f"{schema}.bad", log_table=f"{schema}.runs",
    )


def _check_once(spark, schema):
    held = spark.table(f"{schema}.bancos")
    assert sorted(int(r["cnpj"]) for r in held.collect()) == [i for i in range(60) if i % 10 != 3]
    assert sorted(r["id"] for r in held.collect()) == list(range(1, 55))
    assert sorted(int(r["cnpj"]) for r in spark.table(f"{schema}.bad").collect()) == list(range(3, 60, 10))
    assert held.select("data_processamento").distinct().count() == 1


def _states(spark, schema):
    return [r["state"] for r in spark.table(f"{schema}.load_ledger").orderBy("recorded_at").collect()]


def test_a_second_call_does_nothing(spark, schema, folder):
    first = _load(spark, schema, folder)
    again = _load(spark, schema, folder)
    assert (first.resumed, again.resumed, again.rows_written) == (False, True, 54)
    _check_once(spark, schema)
    assert _states(spark, schema) == ["begun", "written", "verified"]


def _half(df, table, mode):
    """A commit that is cut short: some of the files are there."""
    write_table(df.limit(7), table, "append")
    raise Killed


def _raises(*args, **kwargs):
    raise Killed


def _on_state(state):
    def record(self, load_id, target, rejects, reached, *rest, kept=Ledger.record):
        if reached == state:
            raise Killed
        return kept(self, load_id, target, rejects, reached, *rest)

    return record


KILLS = {
    "before the ledger row": lambda m: m.setattr(Ledger, "record", _on_state("begun")),
    "while landing": lambda m: m.setattr(load, "_land", _raises),
    "before the write": lambda m: m.setattr(load, "write_table", _raises),
    "within the write": lambda m: m.setattr(load, "write_table", _half),
    "after the write": lambda m: m.setattr(Ledger, "record", _on_state("written")),
    "before the check": lambda m: m.setattr(load, "verify", _raises),
    "within the rejects": lambda m: m.setattr(
        load, "write_table", lambda df, table, mode: _half(df, table, mode) if table.endswith("bad") else write_table(df, table, mode)
    ),
    "before the last ledger row": lambda m: m.setattr(Ledger, "record", _on_state("verified")),
}


@pytest.mark.parametrize("kill", list(KILLS))
def test_killed_between_any_two_steps(spark, schema, folder, monkeypatch, kill):
    with monkeypatch.context() as patched:
        KILLS[kill](patched)
        with pytest.raises(Killed):
            _load(spark, schema, folder)
    if spark.catalog.tableExists(f"{schema}.bancos") and kill != "before the ledger row":
        assert published(spark, f"{schema}.bancos").count() == 0
    _load(spark, schema, folder)
    _check_once(spark, schema)
    assert _load(spark, schema, folder).resumed
    _check_once(spark, schema)
    assert published(spark, f"{schema}.bancos").count() == 54


def test_killed_twice_and_appended_to(spark, schema, folder, monkeypatch):
    """Rows of other loads stay; another load waits until the open one is finished or abandoned."""
    target = f"{schema}.bancos"
    other = spark.range(3).selectExpr("'x' as Segmento", "id + 900 as CNPJ", "'other' as Nome")
    load_frame(other, target, declared="bancos_enquadramento")
    for kill in ("within the write", "after the write"):
        with monkeypatch.context() as patched:
            KILLS[kill](patched)
            with pytest.raises(Killed):
                _load(spark, schema, folder)
        assert [r["nome"] for r in published(spark, target).collect()] == ["other"] * 3
    more = f"{folder}/../more"
    other.write.option("header", True).csv(more)
    with pytest.raises(UnfinishedLoad) as found:
        load_once(spark, more, target, declared="bancos_enquadramento")
    assert abandon(spark, f"{schema}.load_ledger", str(found.value).split(": ")[1].split(",")[0]) > 0
    assert spark.table(target).count() == 3
    load_once(spark, more, target, declared="bancos_enquadramento", sep=",")
    _load(spark, schema, folder)
    assert spark.table(target).count() == 60
    assert spark.table(target).select("id").distinct().count() == 60


def test_other_files_are_another_load(spark, schema, folder):
    _load(spark, schema, folder)
    spark.createDataFrame([("S", "77", "x")], "Segmento string, CNPJ string, Nome string").write.mode("append").option("header", True).csv(folder)
    assert not _load(spark, schema, folder).resumed
    assert spark.table(f"{schema}.bancos").count() == 54 + 55


def test_rows_with_a_time_of_their_own(spark, schema, tmp_path, monkeypatch):
    """Nothing in them tells the load; it is done anew and gives each row once."""
    rows = spark.range(20).selectExpr("'S' as segmento", "id as cnpj", "'n' as nome", "'2020-01-02 03:04:05' as data_processamento")
    rows.write.option("header", True).csv(str(tmp_path / "own"))
    for kill in ("within the write", "before the check", None):
        with monkeypatch.context() as patched:
            if kill:
                KILLS[kill](patched)
                with pytest.raises(Killed):
                    load_once(spark, str(tmp_path / "own"), f"{schema}.bancos", declared="bancos_enquadramento")
            else:
                load_once(spark, str(tmp_path / "own"), f"{schema}.bancos", declared="bancos_enquadramento")
    assert sorted(int(r["cnpj"]) for r in spark.table(f"{schema}.bancos").collect()) == list(range(20))


# --- the index of keys -------------------------------------------------------------------------


def _spoil(files):
    for path in files:
        path = path.removeprefix("file:")
        with open(path, "wb") as file:
            file.write(b"no Parquet at all")
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_an_append_opens_only_files_that_may_hold_its_keys(spark, schema):
    target = f"{schema}.t"
    for start in (0, 1000, 2000):
        load_frame(spark.range(start, start + 100, 1, 2).selectExpr("id", "'x' || id as x"), target, indexed=True)
    ids = lambda *values: spark.createDataFrame([(v,) for v in values], "id bigint")
    assert files_that_may_hold(ids(5000, 6000), target, ["id"]) == set()
    found = files_that_may_hold(ids(1010), target, ["id"])
    assert len(found) == 1 and [r["id"] // 1000 for r in rows_of_files(spark, target, found).limit(1).collect()] == [1]
    # The range of the second file holds it, and its filter does not.
    rows = spark.createDataFrame([(i * 10, "y") for i in range(300, 400)], "id bigint, x string")
    load_frame(rows, target, indexed=True)
    assert len(files_that_may_hold(ids(3001), target, ["id"])) <= 1
    hits = sum(len(files_that_may_hold(ids(3001 + 10 * i), target, ["id"])) for i in range(12))
    assert hits <= 2
    with pytest.raises(KeyViolation):
        load_frame(ids(7000, 1010).selectExpr("id", "'z' as x"), target, indexed=True)
    # Files whose range or filter leaves them out are not opened: they may as well be spoilt.
    old = table_files(spark, target)
    _spoil(old)
    summary = load_frame(ids(9000, 9001).selectExpr("id", "'z' as x"), target, indexed=True)
    assert (summary.rows_written, summary.rows_held_before) == (2, 400)
    assert sorted(r["id"] for r in rows_of_files(spark, target, table_files(spark, target) - old).collect()) == [9000, 9001]


def test_numbered_ids_go_on_from_the_index(spark, schema):
    target = f"{schema}.t"
    rows = spark.range(0, 30, 1, 3).select(F.col("id").alias("v"))
    load_frame(rows, target)
    assert load_frame(rows, target, indexed=True).min_id == 31
    _spoil(table_files(spark, target))
    summary = load_frame(rows, target, indexed=True)
    assert (summary.min_id, summary.max_id, summary.rows_held_before) == (61, 90, 60)


@pytest.mark.parametrize("kind", ["int", "string", "decimal(12,0)", "date", "timestamp", "double", "boolean"])
def test_keys_of_any_type(spark, schema, kind):
    """What the target holds is found, whatever its type, with nulls and in partitions."""
    target = f"{schema}.t"
    value = {"date": "date_add(date'2020-01-01', cast(id as int))", "timestamp": "timestamp_seconds(id * 1000)", "boolean": "id % 2 = 0"}.get(kind, f"cast(id as {kind})")
    rows = spark.range(40).selectExpr("id + 1 as id", f"if(id = 7, null, {value}) as k", "cast(2000 + id % 3 as int) as ano")
    load_frame(rows, target, partition_by=("ano",))
    same = rows.where("id = 12").selectExpr("cast(100 as bigint) as id", "k", "ano")
    with pytest.raises(KeyViolation):
        load_frame(same, target, indexed=True, unique=[["k", "ano"]])
    nothing = rows.where("id = 8").selectExpr("cast(101 as bigint) as id", "k", "ano")
    load_frame(nothing, target, indexed=True, unique=[["k", "ano"]])
    other_year = same.selectExpr("id", "k", "1990 as ano")
    load_frame(other_year, target, indexed=True, unique=[["k", "ano"]])
    assert spark.table(target).count() == 42


def test_an_index_that_was_cut_short_is_made_whole(spark, schema, monkeypatch):
    target = f"{schema}.t"
    load_frame(spark.range(0, 50, 1, 2).selectExpr("id"), target)
    with monkeypatch.context() as patched:
        patched.setattr(key_index, "_mark", _raises)
        with pytest.raises(Killed):
            load_frame(spark.range(60, 70).selectExpr("id"), target, indexed=True)
    with pytest.raises(KeyViolation):
        load_frame(spark.range(49, 60).selectExpr("id"), target, indexed=True)
    summary = load_frame(spark.range(60, 70).selectExpr("id"), target, indexed=True)
    assert (summary.rows_held_before, summary.rows_written) == (50, 10)


def test_files_written_without_the_index_and_gone_ones(spark, schema):
    target = f"{schema}.t"
    load_frame(spark.range(0, 50).selectExpr("id"), target)
    load_frame(spark.range(50, 60).selectExpr("id"), target, indexed=True)
    load_frame(spark.range(60, 70).selectExpr("id"), target)
    with pytest.raises(KeyViolation):
        load_frame(spark.range(69, 75).selectExpr("id"), target, indexed=True)
    load_frame(spark.range(0, 5).selectExpr("id"), target, mode="overwrite")
    summary = load_frame(spark.range(50, 60).selectExpr("id"), target, indexed=True)
    assert (summary.rows_held_before, spark.table(target).count()) == (5, 15)


def test_time_of_an_open_load_is_kept(spark, schema, folder, monkeypatch):
    with monkeypatch.context() as patched:
        KILLS["within the write"](patched)
        with pytest.raises(Killed):
            _load(spark, schema, folder)
    began = Ledger(spark, f"{schema}.load_ledger").states().first()["load_time"]
    _load(spark, schema, folder)
    assert spark.table(f"{schema}.bancos").first()["data_processamento"] == began
    assert began.replace(tzinfo=timezone.utc) <= datetime.now(timezone.utc) and ledger.BEGUN == "begun"
