"""Complaints per institution and year with the bank's segment and its employee reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.aggregate import complaints_by_year
from ledgerloom.operators.joins import left_join
from ledgerloom.operators.match import longest_substring_join, substring_join
from ledgerloom.plans.load import LoadSummary, load_frame
from ledgerloom.schemas import RENAMES, UNIQUE_KEYS
from ledgerloom.session import scratch, stage
from ledgerloom.sources.tables import read_tables

# The input tables, the result table and the review columns of the result.
INPUTS = ["reclamacoes", "bancos_enquadramento", "empregados_glassdoor"]
RESULT = "dados_consolidados"
REVIEWS = ["geral", "cultura_e_valores", "remuneracao_e_beneficios", "recomendam_para_outras_pessoas"]


def consolidate(complaints: DataFrame, banks: DataFrame, employees: DataFrame, best: bool = False) -> DataFrame:
    """The consolidated rows.

    Every bank with the institution's number and every employer whose name is contained in the
    institution's name gives a row. With ``best`` there is exactly one row per ``(cnpj, ano)``:
    the longest employer name, and the first segment in order if a bank is listed repeatedly.
    """
    # Aggregated first and staged: both the names to match and the joins start from this table,
    # and the complaints themselves are read once.
    return consolidate_yearly(stage(complaints_by_year(complaints), "yearly"), banks, employees, best)


def consolidate_yearly(yearly: DataFrame, banks: DataFrame, employees: DataFrame, best: bool = False) -> DataFrame:
    """The consolidated rows of yearly totals, which are read several times; see ``consolidate``."""
    segments = banks.select(F.col("cnpj").alias("_bank_cnpj"), "segmento")
    reviews = employees.select("nome", *REVIEWS)
    if best:
        one = segments.groupBy("_bank_cnpj").agg(F.min("segmento").alias("segmento"))
        banked = yearly.join(one, F.col("cnpj_if") == F.col("_bank_cnpj"), "left")
        joined = longest_substring_join(banked, reviews, "nome_instituicao", "nome", names=yearly)
    else:
        banked = left_join(yearly, segments, "cnpj_if", "_bank_cnpj")
        joined = substring_join(banked, reviews, "nome_instituicao", "nome", names=yearly)
    return joined.select(
        F.col("cnpj_if").alias("cnpj"),
        "nome_instituicao",
        "segmento",
        "ano",
        "total_reclamacoes",
        "total_clientes",
        "indice_reclamacoes",
        F.col("geral").alias("avaliacao_geral"),
        F.col("cultura_e_valores").alias("cultura_valores"),
        "remuneracao_e_beneficios",
        F.col("recomendam_para_outras_pessoas").alias("recomendam_empresa"),
    )


def raw_named(name: str, table: DataFrame) -> DataFrame:
    """A table under the names that ``consolidate`` takes, also if it was loaded as declared."""
    return table.withColumnsRenamed({declared: raw for raw, declared in RENAMES[name].items()})


def consolidate_tables(
    spark: SparkSession,
    schema: str,
    best: bool = False,
    mode: str = "overwrite",
    database: dict[str, str] | None = None,
    split_by: str = "id",
    **options,
) -> LoadSummary:
    """Consolidate the three tables of ``schema`` into its result table; all three must be there.

    Tables loaded as declared are taken under their declared names. Those of a ``database`` are read
    over several connections, see ``read_tables``. A result table made by this call is partitioned
    by year. Nothing that is staged meanwhile outlives the call.
    """
    options.setdefault("partition_by", ("ano",))
    tables = read_tables(spark, [f"{schema}.{name}" for name in INPUTS], database, split_by)
    inputs = [raw_named(name, table) for name, table in zip(INPUTS, tables)]
    if best:
        options["unique"] = [keys for keys in UNIQUE_KEYS[RESULT] if keys != ["id"]]
    with scratch(spark):
        return load_frame(consolidate(*inputs, best=best), f"{schema}.{RESULT}", mode=mode, **options)
