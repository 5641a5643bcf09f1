"""Tables that change with their folder, tables along a curve, names that nearly match, streams into tables."""

import random
import uuid

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators.fuzzy import fuzzy_join, fuzzy_pairs, match_percent
from ledgerloom.plans import load
from ledgerloom.plans.load import load_frame
from ledgerloom.sinks.clustered import files_of, lookup, with_curve, write_clustered
from ledgerloom.sinks.key_index import table_files
from ledgerloom.sinks.tables import ensure_schema, write_table
from ledgerloom.sources.tables import SchemaClash, catalogue_folder, merged_columns, wider_type
from ledgerloom.streaming.incremental import load_new_into_table


@pytest.fixture
def schema(spark, tmp_path):
    name = f"s_{uuid.uuid4().hex}"
    ensure_schema(spark, name, str(tmp_path / name))
    return name


# --- catalogue ---------------------------------------------------------------------------------


def test_wider_types():
    assert wider_type("int", "bigint") == wider_type("bigint", "int") == "bigint"
    assert wider_type("float", "double") == wider_type("int", "double") == "double"
    assert wider_type("decimal(5,2)", "decimal(4,3)") == "decimal(6,3)"
    assert wider_type("bigint", "double") is wider_type("int", "string") is wider_type("decimal(38,0)", "decimal(38,9)") is None
    assert merged_columns([[("a", "int"), ("b", "string")], [("c", "date"), ("a", "bigint")]]) == [("a", "bigint"), ("b", "string"), ("c", "date")]
    with pytest.raises(SchemaClash, match="column a"):
        merged_columns([[("a", "int")], [("a", "string")]])


def test_a_folder_that_gets_columns_and_wider_types(spark, schema, tmp_path):
    folder = str(tmp_path / "raw")
    spark.range(3).selectExpr("cast(id as int) as k", "'x' as t", "cast(1.5 as float) as f", "2020 as ano").write.partitionBy("ano").parquet(f"{folder}/p")
    spark.range(2).selectExpr("id as a", "'y' as b").write.parquet(f"{folder}/q")
    (table, other) = catalogue_folder(spark, folder, schema)
    assert dict(spark.table(table).dtypes) == {"k": "int", "t": "string", "f": "float", "ano": "int"}
    spark.range(10**10, 10**10 + 2).selectExpr("date'2020-01-01' as d", "id as k", "cast(2.5 as double) as f", "2021 as ano").write.mode("append").partitionBy("ano").parquet(f"{folder}/p")
    spark.range(1).selectExpr("'new' as c", "id as a").write.mode("append").parquet(f"{folder}/q")
    assert catalogue_folder(spark, folder, schema) == [table, other]
    assert dict(spark.table(table).dtypes) == {"k": "bigint", "t": "string", "f": "double", "d": "date", "ano": "int"}
    rows = [(r.k, r.t, r.f, str(r.d), r.ano) for r in spark.table(table).orderBy("k").collect()]
    assert rows == [(i, "x", 1.5, "None", 2020) for i in range(3)] + [(10**10 + i, None, 2.5, "2020-01-01", 2021) for i in range(2)]
    held = spark.table(other)
    assert held.columns == ["a", "b", "c"]
    assert sorted(map(str, held.collect())) == sorted(["Row(a=0, b='y', c=None)", "Row(a=1, b='y', c=None)", "Row(a=0, b=None, c='new')"])
    # A third call finds nothing new.
    assert catalogue_folder(spark, folder, schema) == [table, other] and spark.table(table).count() == 5


def test_types_without_a_common_one_are_refused(spark, schema, tmp_path):
    folder = str(tmp_path / "raw")
    spark.range(2).selectExpr("id as a").write.parquet(f"{folder}/p")
    (table,) = catalogue_folder(spark, folder, schema)
    spark.range(2).selectExpr("'x' as a").write.mode("append").parquet(f"{folder}/p")
    with pytest.raises(SchemaClash, match="column a"):
        catalogue_folder(spark, folder, schema)
    assert spark.catalog.tableExists(table)
    assert catalogue_folder(spark, folder, schema, evolve=False) == [table]


def test_delimited_folders_that_change(spark, schema, tmp_path):
    folder = tmp_path / "raw"
    (folder / "c").mkdir(parents=True)
    (folder / "c" / "1.csv").write_text("k,t\n1,x\n")
    (table,) = catalogue_folder(spark, str(folder), schema)
    (folder / "c" / "2.csv").write_text("k,t,more\n2,y,z\n")
    with pytest.raises(SchemaClash, match="several headers"):
        catalogue_folder(spark, str(folder), schema)
    (folder / "c" / "1.csv").write_text("k,t,more\n1,x,w\n")
    catalogue_folder(spark, str(folder), schema)
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, "x", "w"), (2, "y", "z")]


# --- tables along a curve ----------------------------------------------------------------------


def test_lookups_open_few_files(spark, schema):
    rows = spark.range(0, 20_000, 1, 5).selectExpr("cast(2000 + id % 40 as int) as ano", "lpad(cast(pmod(hash(id), 500) as string), 8, '0') as cnpj", "id as v")
    table = f"{schema}.t"
    write_clustered(rows, table, ("ano", "cnpj"), 64, ("cnpj",))
    files = table_files(spark, table)
    assert len(files) == 64 and spark.table(table).count() == 20_000
    by_year, by_key = files_of(spark, table, {"ano": 2007}), files_of(spark, table, {"cnpj": "00000123"})
    both = files_of(spark, table, {"ano": 2007, "cnpj": "00000123"})
    assert len(by_year) <= 16 and len(by_key) <= 16 and len(both) <= 4
    for values in ({"ano": 2007}, {"cnpj": "00000123"}, {"ano": 2007, "cnpj": "00000123"}, {"cnpj": "none"}):
        wanted = rows.where(" and ".join(f"{k} = '{v}'" for k, v in values.items()))
        assert sorted(map(tuple, lookup(spark, table, **values).collect())) == sorted(map(tuple, wanted.collect()))
    for path in files - by_key:
        with open(path.removeprefix("file:"), "wb") as file:
            file.write(b"spoilt")
    assert lookup(spark, table, cnpj="00000123").count() == rows.where("cnpj = '00000123'").count()


def test_hot_keys_and_nulls_are_spread(spark, schema):
    rows = spark.range(9000).selectExpr("if(id % 3 = 0, 1, if(id % 7 = 0, null, id)) as k", "if(id % 5 = 0, null, 'n' || id) as t")
    write_clustered(rows, f"{schema}.t", ("k", "t"), 12)
    counts = spark.table(f"{schema}.t").groupBy("_metadata.file_path").count().collect()
    assert len(counts) == 12 and max(c["count"] for c in counts) < 2 * 9000 / 12
    assert sorted(map(str, spark.table(f"{schema}.t").collect())) == sorted(map(str, rows.collect()))
    empty = rows.limit(0)
    write_clustered(empty, f"{schema}.none", ("k", "t"), 3)
    assert lookup(spark, f"{schema}.none", k=1).count() == 0


def test_curve_interleaves_the_cells(spark):
    rows = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    found = {(r["a"], r["b"]): r["z"] for r in with_curve(rows, ("a", "b"), "z", 2).collect()}
    assert found == {(a, b): (a & 1) | (b & 1) << 1 | (a >> 1) << 2 | (b >> 1) << 3 for a in range(4) for b in range(4)}


# --- names -------------------------------------------------------------------------------------


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("percent", [75, 80, 90, 100])
def test_all_near_names_are_found(spark, percent):
    draw = random.Random(percent)
    names = ["", "A", "B", "AB", "BA", "AAAAA", "AAAA", "ÄÖÜ \U0001f600 X", "BANCO ITAÚ", "BANCO ITAU S.A."]
    for _ in range(60):
        name = "".join(draw.choice("ABC ") for _ in range(draw.randrange(1, 25)))
        names.append(name)
        for _ in range(2):
            edited = list(name)
            for _ in range(draw.randrange(1, 5)):
                at = draw.randrange(len(edited) + 1)
                edited[at : at + draw.randrange(2)] = draw.choice(["", "A", "X"])
            names.append("".join(edited))
    names = sorted(set(names))
    df = spark.createDataFrame([(n,) for n in names], "key string")
    found = {tuple(r) for r in fuzzy_pairs(df, df, percent).collect()}
    wanted = set()
    for a in names:
        for b in names:
            longer = max(len(a), len(b))
            score = 100 if not longer else 100 * (longer - _distance(a, b)) // longer
            if score >= percent:
                wanted.add((a, b, score))
    assert found == wanted


def test_fuzzy_join(spark):
    left = spark.createDataFrame([(1, " Banco Itaú "), (2, None), (3, "bradesco"), (3, "bradesco"), (4, "x")], "i int, instituicao string")
    right = spark.createDataFrame([("BANCO ITAU", 5.0), ("BRADESCO S", 4.0), ("Bradesco", 3.0), (None, 1.0)], "nome string, nota double")
    found = fuzzy_join(left, right, "instituicao", "nome", 75).select("i", "nome", "match_percent")
    wanted = [(1, "BANCO ITAU", 90), (3, "BRADESCO S", 80), (3, "BRADESCO S", 80), (3, "Bradesco", 100), (3, "Bradesco", 100)]
    assert sorted(map(tuple, found.collect())) == wanted
    with pytest.raises(ValueError):
        fuzzy_pairs(left.select(F.col("instituicao").alias("key")), right.select(F.col("nome").alias("key")), 50)


@given(st.integers(0, 60))
def test_a_match_keeps_enough_pairs_of_letters(n):
    """The count that the filter relies on, for every length and number of edits."""
    for percent in (75, 80, 90, 100):
        for longer in range(n, n * 100 // percent + 1):
            edits = longer - -(-percent * longer // 100)
            assert longer - 1 - 2 * edits >= -(-(1 - 2 * (100 - percent) / 100) * n // 1) - 1 - 1e-6 or n <= 1


def test_match_percent(spark):
    rows = spark.createDataFrame([("abc", "abd"), ("", ""), ("", "a")], "a string, b string")
    assert [r[0] for r in rows.select(match_percent(F.col("a"), F.col("b"))).collect()] == [66, 100, 0]


# --- streams -----------------------------------------------------------------------------------


def _drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.csv").write_text("Segmento,CNPJ,Nome\n" + "".join(f"{s},{c},{n}\n" for s, c, n in rows))


def test_new_files_into_a_declared_table(spark, schema, tmp_path, monkeypatch):
    """Numbered ids, rejects, a batch that was cut short and one that the stream repeats."""
    folder, target = tmp_path / "in", f"{schema}.bancos"

    def run():
        return load_new_into_table(
            spark, str(folder), target, ["Segmento", "CNPJ", "Nome"], {"cnpj": "string"}, str(tmp_path / "progress"),
            declared="bancos_enquadramento", rejects=f"{schema}.bad", files_per_batch=1,
        )

    _drop(folder, "a", [("S1", i, "x") for i in range(5)] + [("far too long a text", 99, "bad")])
    _drop(folder, "b", [("S2", 10 + i, "y") for i in range(3)])
    assert sorted(s.rows_written for s in run()) == [3, 5]
    assert run() == []
    _drop(folder, "c", [("S3", 20 + i, "z") for i in range(4)])

    class Killed(RuntimeError):
        pass

    def half(df, table, mode):
        write_table(df.limit(2), table, "append")
        raise Killed

    with monkeypatch.context() as patched:
        patched.setattr(load, "write_table", half)
        with pytest.raises(Exception, match="Killed|half"):
            run()
    assert [s.rows_written for s in run()] == [4]
    held = spark.table(target)
    assert sorted(r["id"] for r in held.collect()) == list(range(1, 13))
    assert sorted(int(r["cnpj"]) for r in held.collect()) == [*range(5), *range(10, 13), *range(20, 24)]
    assert spark.table(f"{schema}.bad").count() == 1


def test_a_batch_that_is_repeated_is_loaded_once(spark, schema, tmp_path, monkeypatch):
    """The load was verified, and the stream did not get to note it."""
    folder, target, progress = tmp_path / "in", f"{schema}.t", tmp_path / "progress"
    _drop(folder, "a", [("S1", i, "x") for i in range(5)])
    run = lambda: load_new_into_table(spark, str(folder), target, ["Segmento", "CNPJ", "Nome"], {}, str(progress))
    run()
    for commit in (progress / "commits").iterdir():
        commit.unlink()
    assert [s.resumed for s in run()] == [True]
    assert spark.table(target).count() == 5
    load_frame(spark.range(1).selectExpr("'S' as segmento", "'7' as cnpj", "'n' as nome"), target)
    assert spark.table(target).agg(F.max("id")).first()[0] == 6
