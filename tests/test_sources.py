from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from ledgerloom.functions.values import decimal_comma
from ledgerloom.operators.columns import accepted, clean_columns, conform
from ledgerloom.schemas import RENAMES, TABLES, raw_types
from ledgerloom.sources import tables
from ledgerloom.sources.delimited import LINEAGE, file_paths, read_delimited, read_folder, sniff_separator

HEAD = "employer_name|reviews_count|employer-headquarters|employer-founded|employer-revenue|Geral|Remuneração e benefícios"
WITH_SEGMENT = (
    f"{HEAD}|Segmento|Nome|match_percent\r\n"
    "Um Banco|711|Praia Azul, Ilha Nova|1987.0|Perto de R$\u00a07\u00a0mil|2.1|4.9|S4|UM BANCO|88\r\n"
    "Outro|52|Serra Alta, Vale||Nada consta|1.3|2.2|S2|OUTRO|88\r\n"
)
WITH_NUMBER = f"{HEAD}|CNPJ|Nome|match_percent\r\nTerceiro|9|Ponta Fina, Cabo|1999.0|-|4.6|1.8|00012345|TERCEIRO|71\r\n"


@pytest.fixture
def folder(tmp_path):
    home = tmp_path / "glassdoor"
    home.mkdir()
    (home / "a.csv").write_bytes(WITH_SEGMENT.encode())
    (home / "b.csv").write_bytes(WITH_NUMBER.encode())
    (home / "notes.txt").write_text("x")
    return str(home)


def test_pipe_file_with_declared_types(spark, folder):
    types = raw_types("empregados_glassdoor")
    df = clean_columns(read_delimited(spark, f"{folder}/a.csv", types=types))
    kinds = dict(df.dtypes)
    assert kinds["geral"] == "decimal(3,1)" and kinds["reviews_count"] == "int" and kinds["nome"] == "string"
    first, second = df.orderBy("employer_name").collect()[::-1]
    assert first.employer_headquarters == "Praia Azul, Ilha Nova"
    assert first.employer_revenue == "Perto de R$\u00a07\u00a0mil"
    assert second.employer_founded is None
    assert [r.match_percent for r in (first, second)] == [88, 88]


def test_inferred_types(spark, folder):
    kinds = dict(clean_columns(read_delimited(spark, f"{folder}/a.csv")).dtypes)
    assert kinds["employer_founded"] == "double" and kinds["reviews_count"] == "int"


def test_folder_with_two_headers(spark, folder):
    types = {**raw_types("empregados_glassdoor"), "cnpj": "string"}
    df = clean_columns(read_folder(spark, folder, types=types, lineage=True))
    got = {r.nome: (r.segmento, r.cnpj, r[LINEAGE]) for r in df.collect()}
    assert got == {
        "UM BANCO": ("S4", None, "a.csv"),
        "OUTRO": ("S2", None, "a.csv"),
        "TERCEIRO": (None, "00012345", "b.csv"),
    }
    conformed = conform(df, TABLES["empregados_glassdoor"], RENAMES["empregados_glassdoor"])
    assert accepted(conformed).count() == 3
    assert "remuneracao_beneficios" in conformed.columns


def test_folder_of_many_files(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"file {i}+ç%.csv").write_text("\n" * (i % 3) + f"k,h{i % 4}\n" + "1,2\n" * i)
    rows = read_folder(spark, str(tmp_path), types={})
    assert rows.count() == sum(range(40))
    assert rows.columns == ["k", "h0", "h1", "h2", "h3"]
    assert rows.where("h3 = '2'").count() == sum(range(3, 40, 4))


def test_a_differing_header_fails_instead_of_shifting(spark, folder):
    df = read_delimited(spark, [f"{folder}/a.csv", f"{folder}/b.csv"], types=raw_types("empregados_glassdoor"))
    with pytest.raises(Exception, match="does not conform to the schema"):
        df.collect()


def test_a_value_of_another_type_fails(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text('k,indice,n\n1,"1.234,56",x\n')
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD|MALFORMED_RECORD"):
        read_delimited(spark, str(path), types={"k": "int", "n": "int"}).collect()
    with pytest.raises(Exception, match="not a decimal"):
        read_delimited(spark, str(path), types={"k": "int", "indice": "decimal(10,2)"}).collect()
    as_text = read_delimited(spark, str(path), types={"k": "int"})
    assert as_text.select(decimal_comma(F.col("indice")).cast("string")).first()[0] == "1234.56"


def test_glob_and_missing_files(spark, folder):
    assert sorted(r.path.rsplit("/", 1)[1] for r in file_paths(spark, folder, "*.csv").collect()) == ["a.csv", "b.csv"]
    with pytest.raises(FileNotFoundError):
        read_folder(spark, folder, "*.tsv")


def test_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('k,t\n1,"a ""b"", c"\n2,"two\nlines"\n')
    rows = read_delimited(spark, str(path), types={"k": "int"}, multi_line=True).orderBy("k").collect()
    assert [r.t for r in rows] == ['a "b", c', "two\nlines"]


def test_sniffed_separator(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a;b\n1;2\n")
    assert sniff_separator(spark, str(path)) == ";"
    assert read_delimited(spark, str(path), sep="sniff").columns == ["a", "b"]


def test_sniffing_passes_over_blank_lines(spark, tmp_path):
    path = tmp_path / "y.csv"
    path.write_text("\n  \na;b\n1;2\n")
    assert sniff_separator(spark, str(path)) == ";"


def test_untyped_reads_fail_on_other_headers_and_ragged_rows(spark, tmp_path):
    for name, text in {"a": "k,nome,segmento\n1,x,S1\n", "b": "k,nome,cnpj\n2,y,00012345\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    with pytest.raises(Exception, match="does not conform to the schema"):
        read_delimited(spark, str(tmp_path)).collect()
    rows = read_folder(spark, str(tmp_path)).orderBy("k").collect()
    assert [(r.segmento, r.cnpj) for r in rows] == [("S1", None), (None, 12345)]
    ragged = tmp_path / "ragged"
    ragged.mkdir()
    (ragged / "c.csv").write_text("a,b\n1,2,3\n4\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_delimited(spark, str(ragged)).collect()


def test_headers_of_a_folder_are_read_by_one_job(spark, tmp_path):
    for i in range(1000):
        (tmp_path / f"f{i}.csv").write_text(f"k,h{i % 2}\n{i},1\n")
    group = spark.sparkContext.statusTracker()
    before = max(group.getJobIdsForGroup(), default=-1)
    rows = read_folder(spark, str(tmp_path), types={})
    assert max(group.getJobIdsForGroup()) - before < 20
    assert rows.count() == 1000 and rows.columns == ["k", "h0", "h1"]


def test_a_catalogue_can_be_made_again(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "customer" / "raw").mkdir(parents=True)
    (raw / "customer" / "raw" / "f.csv").write_text("a,b\n1,x\n")
    (raw / "my-data" / "ano=2020").mkdir(parents=True)
    (raw / "my-data" / "ano=2020" / "f.csv").write_text("a\n1\n")
    assert tables.catalogue_folder(spark, str(raw), "again") == ["again.customer", "again.my_data"]
    (raw / "my-data" / "ano=2021").mkdir()
    (raw / "my-data" / "ano=2021" / "f.csv").write_text("a\n2\n3\n")
    (raw / "other").mkdir()
    (raw / "other" / "f.tsv").write_text("a\n1\n")
    assert len(tables.catalogue_folder(spark, str(raw), "again")) == 3
    assert spark.table("again.my_data").where("ano = 2021").count() == 2
    (raw / "third").mkdir()
    (raw / "third" / "f.json").write_text('{"a":1}')
    with pytest.raises(ValueError, match="third.*json"):
        tables.catalogue_folder(spark, str(raw), "again")


def test_split_reads_ask_for_bounds_and_floor_them():
    assert tables.bounds_query("s.t", "x") == "(select min(x) as low, max(x) as high from s.t) bounds"
    options = tables.split_options("x", Decimal("-3.5"), Decimal("10.25"), 8)
    assert options == {"partitionColumn": "x", "lowerBound": "-4", "upperBound": "11", "numPartitions": "8"}


def test_database_tables_are_read_split(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(tables, "read_jdbc", lambda spark, options, name, split_by, splits: asked.append((options, name, split_by, splits)))
    tables.read_tables(spark, ["s.a", "s.b"], {"url": "x"}, "chave", 5)
    assert asked == [({"url": "x"}, "s.a", "chave", 5), ({"url": "x"}, "s.b", "chave", 5)]


def test_missing_tables_are_all_named(spark):
    spark.sql("create namespace if not exists guard")
    spark.sql("create table if not exists guard.here (x int) using parquet")
    with pytest.raises(tables.MissingTables) as error:
        tables.read_tables(spark, ["guard.here", "guard.a", "guard.b"])
    assert error.value.names == ["guard.a", "guard.b"]
    assert tables.read_tables(spark, ["guard.here"])[0].count() == 0


DECLARED = {"bancos": "bancos_enquadramento", "reclamacoes": "reclamacoes"}


def test_catalogue_with_declared_and_inferred_columns(spark, tmp_path):
    raw = tmp_path / "raw"
    for name, text in {"bancos": "segmento\tcnpj\nS1\t00655522\n", "outros": "a\tb\n1\tx\n"}.items():
        (raw / name).mkdir(parents=True)
        (raw / name / "f.tsv").write_text(text)
    for year in (2020, 2021):
        (raw / "reclamacoes" / f"ano={year}").mkdir(parents=True)
        (raw / "reclamacoes" / f"ano={year}" / "f.csv").write_text(f"cnpj_if,indice\n0{year},1.5\n")
    (raw / "loose.csv").write_text("x\n")
    found = tables.catalogue_folder(spark, str(raw), "crawled", {name: raw_types(table) for name, table in DECLARED.items()})
    assert found == ["crawled.bancos", "crawled.outros", "crawled.reclamacoes"]
    complaints = spark.table("crawled.reclamacoes")
    assert {tuple(r) for r in complaints.collect()} == {("02020", "1.5", 2020), ("02021", "1.5", 2021)}
    assert "PartitionFilters: [isnotnull(ano" in complaints.where("ano = 2020")._jdf.queryExecution().toString()
    assert spark.table("crawled.bancos").first().cnpj == "00655522"
    assert dict(spark.table("crawled.outros").dtypes) == {"a": "int", "b": "string"}


def test_jdbc_settings(spark):
    options = tables.jdbc_options("jdbc:x:y", "u", "p", "some.Driver", connections=4)
    assert options["batchsize"] == "1000" and options["isolationLevel"] == "READ_UNCOMMITTED"
    tables.register_jdbc_catalog(spark, "bank_db", options)
    assert spark.conf.get("spark.sql.catalog.bank_db.url") == "jdbc:x:y"
    assert spark.conf.get("spark.sql.catalog.bank_db").endswith("JDBCTableCatalog")
    for key in [f"spark.sql.catalog.bank_db.{k}" for k in options] + ["spark.sql.catalog.bank_db"]:
        spark.conf.unset(key)
