"""The consolidated table brought up to date by new loads, against working it out anew."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import refresh
from ledgerloom.plans.consolidate import INPUTS, RESULT, consolidate, consolidate_tables, raw_named
from ledgerloom.plans.load import load_frame
from ledgerloom.plans.refresh import TOTALS, consolidate_refresh
from ledgerloom.sinks.key_index import table_files
from ledgerloom.sinks.tables import ensure_schema

COLUMNS = "instituicao_financeira string, cnpj_if string, ano int, quantidade_total_de_reclamacoes bigint, quantidade_total_de_clientes_ccs_e_scr bigint, indice decimal(10,2)"
FIRST = [("BANCO ALFA", "01", 2020, 5, 10, "1.5"), ("BANCO ALFA", "01", 2021, 7, 10, "2.5"), ("BETA S.A.", "02", 2020, 1, 1, None)]
SECOND = [("BANCO ALFA", "01", 2022, 2, 4, "4"), ("GAMA", None, 2022, 3, 3, "9.25")]
LATE = [("ABANCO ALFA", "01", 2021, 1, 1, "0.5"), ("BETA S.A.", "02", None, 4, 4, "1")]


@pytest.fixture
def schema(spark, tmp_path):
    name = f"s_{uuid.uuid4().hex}"
    ensure_schema(spark, name, str(tmp_path / name))
    banks = spark.createDataFrame([("S1", "01"), ("S2", "02")], "segmento string, cnpj string")
    reviews = "nome string, geral double, cultura_e_valores double, remuneracao_e_beneficios double, recomendam_para_outras_pessoas double"
    load_frame(banks, f"{name}.{INPUTS[1]}")
    load_frame(spark.createDataFrame([("alfa", 4.0, 3.0, 2.0, 90.0), ("banco alfa", 1.0, 1.0, 1.0, 1.0)], reviews), f"{name}.{INPUTS[2]}")
    return name


def _complain(spark, schema, rows):
    from decimal import Decimal

    typed = [(*r[:5], None if r[5] is None else Decimal(r[5])) for r in rows]
    load_frame(spark.createDataFrame(typed, COLUMNS), f"{schema}.{INPUTS[0]}")


def _check(spark, schema, best=False):
    inputs = [raw_named(name, spark.table(f"{schema}.{name}")) for name in INPUTS]
    wanted = consolidate(*inputs, best=best)
    spark.catalog.refreshTable(f"{schema}.{RESULT}")
    held = spark.table(f"{schema}.{RESULT}")
    assert sorted(map(str, held.select(*wanted.columns).collect())) == sorted(map(str, wanted.collect()))
    ids = [r["id"] for r in held.select("id").collect()]
    assert len(ids) == len(set(ids)) and None not in ids


@pytest.mark.parametrize("best", [False, True])
def test_refreshes_equal_a_full_run(spark, schema, best):
    _complain(spark, schema, FIRST)
    assert consolidate_refresh(spark, schema, best).years == (2020, 2021)
    _check(spark, schema, best)
    assert consolidate_refresh(spark, schema, best).years == ()
    _complain(spark, schema, SECOND)
    done = consolidate_refresh(spark, schema, best)
    assert (done.years, done.loads) == ((2022,), 1)
    _check(spark, schema, best)
    for rows in (LATE, FIRST[:1]):
        _complain(spark, schema, rows)
    done = consolidate_refresh(spark, schema, best)
    assert (done.years, done.loads) == ((None, 2020, 2021), 2)
    _check(spark, schema, best)


def _spoil(paths):
    for path in paths:
        path = path.removeprefix("file:")
        with open(path, "wb") as file:
            file.write(b"spoilt")
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_old_years_and_loads_are_not_read(spark, schema):
    _complain(spark, schema, FIRST)
    consolidate_refresh(spark, schema)
    _complain(spark, schema, SECOND[:1])
    consolidate_refresh(spark, schema)
    _complain(spark, schema, SECOND[1:])
    # All that is there but the totals of the year that is touched, and the load that is new.
    old = {f for f in table_files(spark, f"{schema}.{TOTALS}") if "ano=2022" not in f}
    new = {r[0] for r in spark.table(f"{schema}.{INPUTS[0]}").where("instituicao_financeira = 'GAMA'").select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")).collect()}
    _spoil(old | (table_files(spark, f"{schema}.{INPUTS[0]}") - new) | {f for f in table_files(spark, f"{schema}.{RESULT}") if "ano=2022" not in f})
    assert consolidate_refresh(spark, schema).years == (2022,)
    held = spark.table(f"{schema}.{RESULT}").where("ano = 2022").orderBy("total_reclamacoes").collect()
    assert [(r["cnpj"], r["total_reclamacoes"]) for r in held] == [("01", 2), ("01", 2), (None, 3)]


class Killed(RuntimeError):
    pass


@pytest.mark.parametrize("step", ["consolidate_yearly", "_replace_years", "merged_totals"])
def test_a_call_that_was_cut_short_is_called_again(spark, schema, monkeypatch, step):
    _complain(spark, schema, FIRST)
    consolidate_refresh(spark, schema)
    _complain(spark, schema, LATE)

    def killed(*args, kept=getattr(refresh, step), **kwargs):
        if step == "_replace_years":
            kept(*args, **kwargs)
        raise Killed

    with monkeypatch.context() as patched:
        patched.setattr(refresh, step, killed)
        with pytest.raises(Killed):
            consolidate_refresh(spark, schema)
    assert consolidate_refresh(spark, schema).years == (None, 2021)
    _check(spark, schema)


def test_new_banks_touch_all_years_without_the_complaints(spark, schema):
    _complain(spark, schema, FIRST + SECOND)
    consolidate_refresh(spark, schema)
    load_frame(spark.createDataFrame([("S3", "02")], "segmento string, cnpj string"), f"{schema}.{INPUTS[1]}")
    done = consolidate_refresh(spark, schema)
    assert (done.years, done.loads) == ((2020, 2021, 2022), 0)
    _check(spark, schema)


def test_full_after_an_overwrite(spark, schema):
    _complain(spark, schema, FIRST)
    consolidate_refresh(spark, schema)
    from decimal import Decimal

    rows = [(*r[:5], Decimal("1")) for r in SECOND]
    load_frame(spark.createDataFrame(rows, COLUMNS), f"{schema}.{INPUTS[0]}", mode="overwrite")
    assert consolidate_refresh(spark, schema, full=True).years == (2022,)
    _check(spark, schema)


def test_a_table_of_a_full_run_is_taken_over(spark, schema):
    _complain(spark, schema, FIRST)
    consolidate_tables(spark, schema)
    _complain(spark, schema, LATE)
    consolidate_refresh(spark, schema)
    _check(spark, schema)


def test_declared_tables(spark, schema):
    """Names and times of tables that are loaded as declared."""
    rows = spark.createDataFrame([("BANCO ALFA", "01", 2020, "1º", 5, 10, "1.5")], "Instituicao_financeira string, CNPJ_IF string, Ano int, Trimestre string, `Quantidade total de reclamações` int, `Quantidade total de clientes – CCS e SCR` bigint, Indice string")
    load_frame(rows, f"{schema}.{INPUTS[0]}", declared=INPUTS[0])
    assert consolidate_refresh(spark, schema).years == (2020,)
    load_frame(rows.withColumn("Ano", F.lit(2021)), f"{schema}.{INPUTS[0]}", declared=INPUTS[0])
    assert consolidate_refresh(spark, schema).years == (2021,)
    _check(spark, schema)
