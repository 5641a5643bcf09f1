from collections import Counter
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks, columns, ids
from ledgerloom.operators.aggregate import complaints_by_year
from ledgerloom.operators.joins import left_join

AT = datetime(2024, 1, 2, 3, 4, 5, 678901, tzinfo=timezone.utc)


# --- ids ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dense_ids_follow_the_row_order(spark, parts):
    df = spark.range(0, 1000, 1, parts).select((F.col("id") * 3).alias("v"))
    got = ids.with_dense_id(df, start=11).orderBy("id").collect()
    assert [(r.id, r.v) for r in got] == [(11 + i, 3 * i) for i in range(1000)]


def test_dense_ids_equal_rdd_positions(spark):
    df = spark.range(500).select(F.col("id").alias("v")).repartition(5, "v")
    expected = {(row.v, i + 1) for row, i in df.rdd.zipWithIndex().collect()}
    assert {(r.v, r.id) for r in ids.with_dense_id(df).collect()} == expected


def test_dense_ids_do_not_depend_on_the_split(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 50_000, 1, 4).select(F.col("id").alias("v")).write.option("parquet.block.size", 4096).parquet(path)
    once = {(r.v, r.id) for r in ids.number_scan(spark.read.parquet(path)).collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scan = spark.read.parquet(path)
        assert scan.rdd.getNumPartitions() > 4
        assert {(r.v, r.id) for r in ids.number_scan(scan).collect()} == once
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {i for _, i in once} == set(range(1, 50_001))


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_no_rows_move_for_ids_of_many_files(spark, tmp_path, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        path = str(tmp_path / "many")
        spark.range(0, 3000, 1, 200).select(F.col("id").alias("v"), F.lit(1).alias("_offset")).write.parquet(path)
        df = ids.number_scan(spark.read.parquet(path))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("BroadcastExchange")[0]
        assert {(r.v, r.id) for r in df.collect()} == {(i, i + 1) for i in range(3000)}
        assert df.columns == ["id", "v", "_offset"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_another_id_column_gives_way(spark):
    for names in ([" ID", "id"], ["id", " ID"], ["x", "Id", "id_2", "ID "]):
        df = columns.clean_columns(ids.rename_id(spark.createDataFrame([tuple(range(len(names)))], names)))
        assert df.columns.count("id") == 1 and len(set(df.columns)) == len(names)
        assert df.first()["id"] == names.index("Id" if "Id" in names else names[0])


def test_next_id(spark):
    assert ids.next_id(spark.range(0)) == 1
    assert ids.next_id(spark.range(5)) == 5


# --- columns -----------------------------------------------------------------------------------


def test_audit_replaces_and_processing_time_fills(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "y", AT)], "id int, created_at string, data_processamento timestamp")
    at = columns.load_time(AT)
    got = columns.with_processing_time(columns.with_audit(df, at), at)
    assert got.where("created_at = updated_at").count() == 2
    assert got.where(F.col("data_processamento") == at).count() == 2
    assert got.columns == ["id", "created_at", "data_processamento", "updated_at"]


def test_conform_diverts_what_does_not_fit(spark):
    rows = [(1, "123", "abcdef", "1.25"), (2, "x", "abc", "2000"), (3, None, None, None)]
    df = spark.createDataFrame(rows, "id int, n string, raw string, d string")
    declared = {"t": "varchar(5)", "n": "int", "d": "decimal(3,1)", "absent": "bigint"}
    conformed = columns.conform(df, declared, {"raw": "t"})
    good = [tuple(r) for r in columns.accepted(conformed).collect()]
    bad = {r.id: sorted(map(tuple, r[columns.REJECTS])) for r in columns.rejected(conformed).collect()}
    assert good == [(3, None, None, None, None)]
    assert bad == {1: [("t", "abcdef")], 2: [("d", "2000"), ("n", "x")]}
    assert conformed.dtypes[:3] == [("id", "int"), ("t", "string"), ("n", "int")]


def test_a_fraction_is_no_whole_number(spark):
    df = spark.sql("select 2020.7D a, cast(12.70 as decimal(5,2)) b, cast(12.5 as float) c, 3.0D d, 7.25D e")
    declared = {"a": "int", "b": "bigint", "c": "smallint", "d": "int", "e": "decimal(5,1)"}
    row = columns.conform(df, declared).first()
    assert [f["column"] for f in row[columns.REJECTS]] == ["a", "b", "c"]
    assert (row["a"], row["d"], str(row["e"])) == (None, 3, "7.3")
    assert columns.left_out(df.withColumn("id", F.lit(1)), {"a": "int"}) == ["b", "c", "d", "e"]


def test_too_long(spark):
    df = spark.createDataFrame([("abc", None), ("abcd", "x"), (None, "xyz")], "a string, b string")
    assert [tuple(r) for r in columns.too_long(df, {"a": 3, "b": 2}).collect()] == [("abcd", "x"), (None, "xyz")]


# --- aggregate ---------------------------------------------------------------------------------


def test_complaints_by_year(spark):
    rows = [
        ("1", 2020, 5, 10, 1.0, "B"),
        ("1", 2020, None, 20, None, "A"),
        ("1", 2020, 7, 30, 2.5, "B"),
        (None, 2020, 1, 1, None, None),
        (None, 2020, 2, 2, None, "Z"),
    ]
    schema = (
        "cnpj_if string, ano int, quantidade_total_de_reclamacoes int, "
        "quantidade_total_de_clientes_ccs_e_scr bigint, indice double, instituicao_financeira string"
    )
    got = {tuple(r) for r in complaints_by_year(spark.createDataFrame(rows, schema)).collect()}
    assert got == {("1", 2020, 12, 60, 1.75, "A"), (None, 2020, 3, 3, None, "Z")}


def test_decimal_index_keeps_the_type_of_an_average(spark):
    df = spark.sql(
        "select '1' cnpj_if, 2020 ano, 1 quantidade_total_de_reclamacoes, 1L quantidade_total_de_clientes_ccs_e_scr, "
        "cast(id as decimal(10,2)) indice, 'x' instituicao_financeira from range(3)"
    )
    expected = df.selectExpr("avg(indice)").schema[0].dataType
    got = complaints_by_year(df)
    assert got.schema["indice_reclamacoes"].dataType == expected
    assert got.first()["indice_reclamacoes"] == 1


# --- left join ---------------------------------------------------------------------------------


def _plain(left, right):
    return left.join(right, F.col("k") == F.col("rk"), "left").drop("rk")


def _rows(df):
    return Counter(map(tuple, df.select("k", "v", "w").collect()))


def test_left_join_keeps_null_keys_and_multiplies(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("a", 2), (None, 9)], "rk string, w int")
    assert _rows(left_join(left, right, "k", "rk")) == Counter([("a", 1, 1), ("a", 1, 2), ("b", 2, None), (None, 3, None)])


def test_left_join_wants_differing_names(spark):
    with pytest.raises(ValueError, match="both sides"):
        left_join(spark.range(1), spark.range(1), "id", "id")


@pytest.mark.parametrize("hot_rows", [1, 3, 50, 10_000])
def test_hot_right_keys_give_the_same_rows(spark, hot_rows):
    """A third of the right side has one key; another key is a third of copies."""
    left = spark.range(300).select((F.col("id") % 40).alias("k"), F.col("id").alias("v"))
    left = left.unionByName(spark.createDataFrame([(None, -1), (999, -2)], "k bigint, v bigint"))
    right = spark.range(900).select(
        F.when(F.col("id") < 300, 7).when(F.col("id") < 600, 8).otherwise(F.col("id") % 45).alias("rk"),
        F.when(F.col("id").between(300, 599), 1).otherwise(F.col("id")).alias("w"),
    )
    assert _rows(left_join(left, right, "k", "rk", hot_rows=hot_rows)) == _rows(_plain(left, right))


@pytest.mark.parametrize("hot_rows", [1, 10_000])
def test_any_type_and_collation_on_the_right(spark, hot_rows):
    left = spark.sql("select cast('A' as string collate UTF8_LCASE) k, 1 v")
    right = spark.sql(
        "select cast(t as string collate UTF8_LCASE) rk, cast(t as string collate UTF8_LCASE) w, map(t, n) m, n _part "
        "from values ('a', 1), ('A', 2), ('A', 2), ('b', 3) as r(t, n)"
    )
    got = left_join(left, right, "k", "rk", hot_rows=hot_rows)
    assert got.columns == ["k", "v", "w", "m", "_part"]
    assert sorted((r.w, r._part, r.m[r.w]) for r in got.collect()) == [("A", 2, 2), ("A", 2, 2), ("a", 1, 1)]


def test_left_join_wants_keys_of_one_kind(spark):
    left, right = spark.sql("select 'abc' k, 1 v"), spark.sql("select 5 rk, 2 w")
    with pytest.raises(TypeError, match="k is text and rk is whole number"):
        left_join(left, right, "k", "rk")


# --- checks ------------------------------------------------------------------------------------


def test_assert_unique_ignores_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, "a")], "x int, y string")
    checks.assert_unique(df, ["x", "y"])
    with pytest.raises(checks.KeyViolation):
        checks.assert_unique(df, ["x"])


def test_checksum_sees_content_and_not_order(spark):
    df = spark.range(100).withColumn("t", F.concat(F.lit("r"), "id"))
    total = lambda d: d.agg(checks.checksum(["id", "t"])).first()[0]
    assert total(df) == total(df.repartition(7).orderBy(F.desc("id")))
    assert total(df) != total(df.withColumn("t", F.when(F.col("id") == 5, "x").otherwise(F.col("t"))))
    assert total(df.limit(0)) == 0


def test_verify(spark):
    df = spark.range(3)
    content = df.agg(checks.checksum(["id"])).first()[0]
    checks.verify(df, 3, content, ["id"])
    checks.verify(df, 3, None, ["id"])
    with pytest.raises(checks.LoadMismatch):
        checks.verify(df, 4, None, ["id"])
    with pytest.raises(checks.LoadMismatch):
        checks.verify(df, 3, content + 1, ["id"])
