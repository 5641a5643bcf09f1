"""Complaints per institution and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def named_totals(complaints: DataFrame) -> DataFrame:
    """Totals per ``(cnpj_if, ano)`` and name, of which those of several loads can be added up."""
    return complaints.groupBy("cnpj_if", "ano", "instituicao_financeira").agg(
        F.sum("quantidade_total_de_reclamacoes").alias("complaints"),
        F.sum("quantidade_total_de_clientes_ccs_e_scr").alias("clients"),
        F.sum("indice").alias("index_sum"),
        F.count("indice").alias("index_count"),
    )


def index_type(complaints: DataFrame) -> DataType:
    """The type of the average index."""
    return complaints.select(F.avg("indice")).schema[0].dataType


def merged_totals(named: DataFrame, average_type: DataType) -> DataFrame:
    """The totals per ``(cnpj_if, ano)`` of ``named_totals``, of one load or of several."""
    average = F.try_divide(F.sum("index_sum"), F.sum("index_count")).cast(average_type)
    return named.groupBy("cnpj_if", "ano").agg(
        F.sum("complaints").alias("total_reclamacoes"),
        F.sum("clients").alias("total_clientes"),
        average.alias("indice_reclamacoes"),
        F.min("instituicao_financeira").alias("nome_instituicao"),
    )


def complaints_by_year(complaints: DataFrame) -> DataFrame:
    """Totals per ``(cnpj_if, ano)``; null keys form groups of their own.

    Sums skip nulls, the index is the plain average of the rows, and the name is the first in
    order, the same on every run. Clients add up over the quarters of a year.

    The smallest name is a text, and Spark sorts the rows of a task before it folds texts. So
    rows are first summed with the name among the keys, which hashes and leaves little to sort.
    """
    return merged_totals(named_totals(complaints), index_type(complaints))
