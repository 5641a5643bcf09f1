"""Queries over the test tables, each with the SQL that gives the same rows.

The test tables stand in for bank data: ``lineitem`` summed per part and quarter and named by
``part`` is the complaints table, ``customer`` the segments, and the words of ``benchmark`` the
reviewed employers. Parts without a customer have no segment, words inside part names match as
substrings, and words in several spellings match more than once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.values import decimal_comma, padded_key, separator_of_path
from ledgerloom.operators import checks, columns, ids
from ledgerloom.operators.aggregate import complaints_by_year
from ledgerloom.operators.fuzzy import fuzzy_pairs
from ledgerloom.operators.joins import left_join
from ledgerloom.operators.match import substring_join
from ledgerloom.plans.consolidate import INPUTS, RESULT, REVIEWS, consolidate, consolidate_tables
from ledgerloom.plans.ledger import load_once
from ledgerloom.plans.load import load_files, load_frame
from ledgerloom.plans.refresh import consolidate_refresh
from ledgerloom.session import fresh_path, stage
from ledgerloom.sinks.clustered import files_of, lookup, write_clustered
from ledgerloom.sinks.key_index import files_that_may_hold, table_files
from ledgerloom.sinks.tables import ensure_schema, ensure_table, write_table
from ledgerloom.sources.delimited import read_delimited, read_folder, with_lineage
from ledgerloom.sources.splitting import read_split
from ledgerloom.sources.tables import catalogue_folder, read_tables
from ledgerloom.streaming.incremental import load_new_files, load_new_into_table

try:
    import corpus_pipeline
    from ledgerloom.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # Only their absence is passed over, and not an import that fails inside them.
    if missing.name not in ("corpus_pipeline", "ledgerloom.llm"):
        raise
    corpus_pipeline = llm_queries = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fresh_schema(spark: SparkSession, label: str) -> str:
    schema = f"{label}_{uuid.uuid4().hex}"
    ensure_schema(spark, schema, fresh_path(spark, label))
    return schema


def _write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    writer = df.write.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


# --- the bank tables ---------------------------------------------------------------------------


def _complaints(spark, sf_dir):
    quarterly = (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", F.year("l_shipdate").alias("ano"), F.quarter("l_shipdate").alias("trimestre"))
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantidade_total_de_reclamacoes"),
            F.sum("l_orderkey").alias("quantidade_total_de_clientes_ccs_e_scr"),
            F.sum(F.col("l_discount").cast("decimal(8,2)")).cast("double").alias("indice"),
        )
    )
    names = _table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("instituicao_financeira"))
    # Summed before it is joined, so that a part with very many lines is a few rows by then.
    return quarterly.withColumnRenamed("l_partkey", "cnpj_if").join(
        names, F.col("cnpj_if") == F.col("p_partkey")
    ).drop("p_partkey")


def _banks(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer")
    return customers.select(F.col("c_custkey").alias("cnpj"), F.col("c_mktsegment").alias("segmento"))


def _employees(spark, sf_dir):
    words = _table(spark, sf_dir, "benchmark").select(
        "item_id", F.explode(F.split("text", "[^A-Za-z]+")).alias("word")
    )
    reviewed = words.where(F.col("word") != "").groupBy("word")
    scores = reviewed.agg(
        F.count("item_id").alias(REVIEWS[0]),
        F.min("item_id").alias(REVIEWS[1]),
        F.max("item_id").alias(REVIEWS[2]),
        F.sum("item_id").alias(REVIEWS[3]),
    )
    return stage(scores.select(F.concat(F.lit("  "), "word", F.lit(" ")).alias("nome"), *REVIEWS), "employees")


def _rounded_index(df: DataFrame) -> DataFrame:
    return df.withColumn("indice_reclamacoes", F.round("indice_reclamacoes", 6))


_BANK_SQL = """
with quarterly as (
  select l_partkey, year(l_shipdate)::int as ano, quarter(l_shipdate) as trimestre,
    sum(l_quantity::bigint) as reclamacoes, sum(l_orderkey) as clientes, sum(l_discount::decimal(10,2)) as indice
  from lineitem group by 1, 2, 3),
agg as (
  select l_partkey as cnpj_if, ano, sum(reclamacoes)::bigint as total_reclamacoes,
    sum(clientes)::bigint as total_clientes, round(avg(indice::double), 6) as indice_reclamacoes,
    min(p_name) as nome_instituicao
  from quarterly join part on l_partkey = p_partkey group by 1, 2),
banks as (select c_custkey as cnpj, c_mktsegment as segmento from customer),
words as (select item_id, unnest(regexp_split_to_array(text, '[^A-Za-z]+')) as word from benchmark),
employees as (
  select '  ' || word || ' ' as nome, count(*)::bigint as geral, min(item_id) as cultura_e_valores,
    max(item_id) as remuneracao_e_beneficios, sum(item_id)::bigint as recomendam_para_outras_pessoas
  from words where word <> '' group by word),
names as (select distinct p_name as name from part),
matches as (
  select * from names join employees on contains(upper(trim(name)), upper(trim(nome)))),
joined as (
  select cnpj_if, nome_instituicao, segmento, ano, total_reclamacoes, total_clientes, indice_reclamacoes,
    nome, geral, cultura_e_valores, remuneracao_e_beneficios, recomendam_para_outras_pessoas
  from agg left join banks on cnpj_if = cnpj left join matches on nome_instituicao = name),
result as (
  select cnpj_if as cnpj, nome_instituicao, segmento, ano, total_reclamacoes, total_clientes, indice_reclamacoes,
    geral as avaliacao_geral, cultura_e_valores as cultura_valores, remuneracao_e_beneficios,
    recomendam_para_outras_pessoas as recomendam_empresa, nome
  from joined)
"""


def _agg_entity_year(spark, sf_dir):
    return _rounded_index(complaints_by_year(_complaints(spark, sf_dir)))


def _left_equi_join(spark, sf_dir):
    yearly = stage(complaints_by_year(_complaints(spark, sf_dir)), "yearly")
    segments = _banks(spark, sf_dir).withColumnRenamed("cnpj", "bank_cnpj")
    return _rounded_index(left_join(yearly, segments, "cnpj_if", "bank_cnpj"))


def _substring_join(spark, sf_dir, **options):
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return substring_join(parts, _employees(spark, sf_dir), "p_name", "nome", **options)


def _consolidate(spark, sf_dir, best=False):
    inputs = _complaints(spark, sf_dir), _banks(spark, sf_dir), _employees(spark, sf_dir)
    return _rounded_index(consolidate(*inputs, best=best))


# --- sources -----------------------------------------------------------------------------------


def _csv_comma_scan(spark, sf_dir):
    path = _write_csv(_table(spark, sf_dir, "documents"), fresh_path(spark, "comma"))
    return read_delimited(spark, path, types={"doc_id": "bigint", "n_chars": "bigint"}, multi_line=True)


def _csv_tsv_scan(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer")
    path = _write_csv(customers, fresh_path(spark, "tab") + ".tsv", "\t")
    return read_delimited(spark, path, types=dict(customers.dtypes))


def _csv_pipe_scan(spark, sf_dir):
    path = _write_csv(_table(spark, sf_dir, "part"), fresh_path(spark, "glassdoor"), "|")
    inferred = read_delimited(spark, path)
    return inferred.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


def _separator_detect(spark, sf_dir):
    url = F.col("url")
    variants = F.array(
        url, F.concat(url, F.lit(".TSV")), F.concat(F.lit("Glassdoor/"), url), F.concat(url, F.lit("|.csv"))
    )
    paths = _table(spark, sf_dir, "pages").select(F.posexplode(variants).alias("variant", "path"))
    found = paths.select("variant", F.ascii(separator_of_path(F.col("path"))).alias("separator_code"))
    return found.groupBy("variant", "separator_code").agg(checks.row_count().alias("n"))


def _folder_union_scan(spark, sf_dir):
    folder = fresh_path(spark, "glassdoor")
    suppliers = _table(spark, sf_dir, "supplier")
    customers = _table(spark, sf_dir, "customer")
    _write_csv(suppliers.selectExpr("s_suppkey as chave", "s_acctbal as saldo", "s_name as Nome"), f"{folder}/a", "|")
    _write_csv(
        customers.selectExpr("c_custkey as chave", "c_mktsegment as Segmento", "c_name as Nome"), f"{folder}/b", "|"
    )
    return read_folder(spark, folder, types={"chave": "bigint", "saldo": "double"})


def _catalogue_folder(spark, sf_dir):
    folder = fresh_path(spark, "raw")
    orders = _table(spark, sf_dir, "orders").withColumn("ano", F.year("o_orderdate"))
    orders.write.partitionBy("ano").parquet(f"{folder}/orders")
    _write_csv(_table(spark, sf_dir, "customer"), f"{folder}/customer")
    schema = _fresh_schema(spark, "catalogue")
    found = [spark.table(t) for t in sorted(catalogue_folder(spark, folder, schema))]
    customers, by_year = found
    n = checks.row_count().alias("n")
    return (
        by_year.groupBy(F.lit("orders").alias("table_name"), F.col("ano").cast("int").alias("ano"))
        .agg(n)
        .unionByName(customers.groupBy(F.lit("customer").alias("table_name"), F.lit(None).cast("int").alias("ano")).agg(n))
    )


def _file_lineage(spark, sf_dir):
    paths = [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders", "customer")]
    scan = with_lineage(spark.read.schema("o_orderkey bigint").parquet(*paths))
    return scan.groupBy("arquivo_origem").agg(checks.row_count().alias("n"))


def _inputs_available(spark, sf_dir):
    names = ["lineitem", "part", "customer"]
    schema = _fresh_schema(spark, "inputs")
    for name in names:
        spark.catalog.createTable(f"{schema}.{name}", f"{sf_dir}/{name}.parquet", "parquet")
    counts = [
        df.agg(F.lit(name).alias("table_name"), checks.row_count().alias("row_count"))
        for name, df in zip(names, read_tables(spark, [f"{schema}.{name}" for name in names]))
    ]
    return counts[0].union(counts[1]).union(counts[2])


# --- columns -----------------------------------------------------------------------------------


def _id_detect_rename(spark, sf_dir):
    return ids.rename_id(_table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", " PK"))


def _id_generate(spark, sf_dir):
    return ids.with_dense_id(_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"))


def _id_generate_scan(spark, sf_dir):
    return ids.number_scan(_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"))


def _orders_some_ids(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    key = F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey"))
    return orders.select(key.alias("id"), "o_orderstatus", "o_totalprice")


def _id_not_null(spark, sf_dir):
    return columns.drop_null_ids(_orders_some_ids(spark, sf_dir))


def _audit_columns(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    brought = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate").cast("timestamp"))
    at = columns.load_time()
    df = columns.with_audit(columns.with_processing_time(orders.withColumn("data_processamento", brought), at), at)
    return df.agg(
        checks.row_count().alias("n_rows"),
        F.count_if(F.col("created_at") == F.col("updated_at")).alias("n_same"),
        F.count_if(F.col("data_processamento") == F.col("created_at")).alias("n_filled"),
        F.count_if(F.col("data_processamento") == F.col("o_orderdate").cast("timestamp")).alias("n_kept"),
    )


def _normalize_columns(spark, sf_dir):
    raw = ["Número do cliente", "Nome-do  cliente ", "nação", "Saldo (R$)", "saldo r"]
    return columns.clean_columns(_table(spark, sf_dir, "customer").toDF(*raw))


def _conform_schema(spark, sf_dir):
    score = (F.col("c_acctbal") / 1000).alias("score")
    raw = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", score, "c_mktsegment")
    declared = {
        "c_mktsegment": "varchar(9)",
        "saldo": "decimal(10,2)",
        "nota": "decimal(3,1)",
        "c_custkey": "int",
        "trimestre": "varchar(10)",
    }
    return columns.accepted(columns.conform(raw, declared, {"c_acctbal": "saldo", "score": "nota"}))


def _conform_rejects(spark, sf_dir):
    raw = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    declared = {"o_orderkey": "bigint", "o_orderpriority": "varchar(8)", "o_totalprice": "decimal(7,2)"}
    faults = columns.rejected(columns.conform(raw, declared)).select(F.explode(columns.REJECTS).alias("found"))
    return faults.groupBy(F.col("found.column").alias("fault")).agg(checks.row_count().alias("n"))


def _padded_keys(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer")
    return customers.select("c_custkey", padded_key(F.col("c_custkey")).alias("cnpj"))


def _length_violations(spark, sf_dir):
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return columns.too_long(parts, {"p_name": 9}).withColumn("n_chars", F.length("p_name"))


def _decimal_comma_parse(spark, sf_dir):
    # The test tables hold numbers, so the text form is made first: 1234.5 as "1.234,50".
    text = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    parsed = _table(spark, sf_dir, "orders").select("o_orderpriority", decimal_comma(text, 15, 2).alias("price"))
    return parsed.groupBy("o_orderpriority").agg(F.sum("price").cast("decimal(25,2)").alias("total"))


# --- checks and reports ------------------------------------------------------------------------


def _id_stats(spark, sf_dir):
    return checks.id_stats(_table(spark, sf_dir, "orders"), "o_orderkey")


def _sample_rows(spark, sf_dir):
    return checks.sample_rows(_table(spark, sf_dir, "orders"), "o_orderkey")


def _schema_report(spark, sf_dir):
    return checks.schema_report(_table(spark, sf_dir, "orders"))


def _pk_violations(spark, sf_dir):
    return checks.duplicates(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _unique_violations(spark, sf_dir):
    return checks.duplicates(_consolidate(spark, sf_dir), ["cnpj", "ano"])


# --- targets -----------------------------------------------------------------------------------


def _named_balances(spark, sf_dir, table, name, balance):
    return _table(spark, sf_dir, table).select(F.col(name).alias("nome"), F.col(balance).alias("saldo"))


def _ensure_target(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "id")
    target = f"{_fresh_schema(spark, 'ensure')}.clientes"
    before, after = ensure_table(customers, target), ensure_table(customers, target)
    write_table(customers, target, "append")
    held = spark.table(target)
    existed = [F.lit(before).alias("existed_before"), F.lit(after).alias("existed_after")]
    return held.agg(*existed, F.lit(held.columns[0]).alias("first_column"), checks.row_count().alias("n"))


def _table_roundtrip(spark, sf_dir):
    parts = _table(spark, sf_dir, "part")
    target = f"{_fresh_schema(spark, 'roundtrip')}.parts"
    ensure_table(parts, target)
    write_table(parts, target, "overwrite")
    return read_tables(spark, [target])[0]


def _load_append_twice(spark, sf_dir):
    target = f"{_fresh_schema(spark, 'append')}.saldos"
    load_frame(_named_balances(spark, sf_dir, "customer", "c_name", "c_acctbal"), target)
    load_frame(_named_balances(spark, sf_dir, "supplier", "s_name", "s_acctbal"), target)
    return spark.table(target).select("id", "nome", "saldo")


def _load_overwrite(spark, sf_dir):
    target = f"{_fresh_schema(spark, 'overwrite')}.saldos"
    load_frame(_named_balances(spark, sf_dir, "supplier", "s_name", "s_acctbal"), target)
    load_frame(_named_balances(spark, sf_dir, "customer", "c_name", "c_acctbal"), target, mode="overwrite")
    return spark.table(target).select("id", "nome", "saldo")


def _load_profile(spark, sf_dir):
    target = f"{_fresh_schema(spark, 'profile')}.pedidos"
    summary = load_frame(_orders_some_ids(spark, sf_dir), target).frame(spark)
    return summary.select("mode", "rows_in", "rows_dropped", "rows_written", "min_id", "max_id")


def _load_declared(spark, sf_dir):
    schema = _fresh_schema(spark, "declared")
    target, rejects = f"{schema}.bancos_enquadramento", f"{schema}.rejeitados"
    raw = _table(spark, sf_dir, "customer").selectExpr("c_mktsegment as Segmento", "c_custkey as CNPJ", "c_name as Nome")
    keys = {"key_columns": ("cnpj",), "declared": "bancos_enquadramento"}
    # The column takes ten characters; the other spelling has more in each of its rows.
    load_frame(raw, target, **keys)
    load_frame(raw.withColumn("Segmento", F.concat("Segmento", F.lit(" "), "CNPJ")), target, rejects=rejects, **keys)
    kept = spark.table(target).select(F.lit(False).alias("diverted"), "segmento", "cnpj", "nome")
    return kept.unionByName(spark.table(rejects).select(F.lit(True).alias("diverted"), "segmento", "cnpj", "nome"))


def _post_load_verify(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "Key")
    target = f"{_fresh_schema(spark, 'verify')}.pedidos"
    written = load_frame(orders, target).rows_written
    held = spark.table(target)
    return held.agg(
        F.lit(written).cast("bigint").alias("source_rows"),
        checks.row_count().alias("target_rows"),
        F.lit(len(held.columns)).alias("target_columns"),
        (checks.row_count() == written).alias("matches"),
    )


_RAW_TYPES = {"pk": "bigint", "nation_key": "int", "acct_bal": "double"}


def _raw_customers(spark, sf_dir):
    key = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey"))
    raw = _table(spark, sf_dir, "customer").withColumn("c_custkey", key)
    return raw.toDF("PK", "Customer Name", "Nation-Key", "Acct.Bal", "Segmento (Mercado)")


def _load_job(spark, sf_dir):
    path = _write_csv(_raw_customers(spark, sf_dir), fresh_path(spark, "clientes"))
    target = f"{_fresh_schema(spark, 'job')}.clientes"
    load_files(spark, path, target, types=_RAW_TYPES)
    return spark.table(target).drop("created_at", "updated_at")


def _incremental_load(spark, sf_dir):
    folder, target = fresh_path(spark, "novos"), fresh_path(spark, "carregados")
    raw = _raw_customers(spark, sf_dir)
    for part in (raw.where("`Nation-Key` < 10"), raw.where("`Nation-Key` >= 10 or `Nation-Key` is null")):
        _write_csv(part, f"{folder}/{uuid.uuid4().hex}")
        load_new_files(spark, folder, target, types=_RAW_TYPES, columns=raw.columns)
    return spark.read.parquet(target).drop("created_at", "updated_at")


def _left_equi_join_salted(spark, sf_dir):
    """The same rows as ``left_equi_join``, a third of the segments under one key and every key hot."""
    segments = _banks(spark, sf_dir).withColumnRenamed("cnpj", "bank_cnpj")
    third = segments.where("bank_cnpj % 3 = 0").withColumn("bank_cnpj", F.lit(1).cast("bigint"))
    yearly = complaints_by_year(_complaints(spark, sf_dir))
    return _rounded_index(left_join(yearly, segments.unionByName(third), "cnpj_if", "bank_cnpj", hot_rows=1))


def _decimal_comma_mixed(spark, sf_dir):
    """Prices with a comma, with a point, with junk and below zero; those that are no number counted."""
    price = F.col("o_totalprice")
    comma = F.translate(F.format_number(price, 2), ",.", ".,")
    point = F.concat((F.col("o_orderkey") % 1000).cast("string"), F.lit(".5"))
    kind = F.col("o_orderkey") % 5
    text = (
        F.when(kind == 0, comma).when(kind == 1, F.concat(F.lit("-"), comma)).when(kind == 2, point)
        .when(kind == 3, F.concat(comma, F.lit("x"))).otherwise(F.concat(F.lit("1,"), comma))
    )
    parsed = _table(spark, sf_dir, "orders").select(kind.alias("kind"), decimal_comma(text, 15, 2).alias("price"))
    return parsed.groupBy("kind").agg(
        F.sum("price").cast("decimal(25,2)").alias("total"), F.count_if(F.col("price").isNull()).alias("rejected")
    )


def _conform_fractions(spark, sf_dir):
    """Balances as whole numbers: fractions are rejected and not cut off."""
    half = (F.round("c_acctbal") + F.when(F.col("c_custkey") % 3 == 0, 0.5).otherwise(0)).alias("saldo")
    conformed = columns.conform(_table(spark, sf_dir, "customer").select("c_custkey", half), {"c_custkey": "int", "saldo": "int"})
    kept = columns.accepted(conformed).agg(F.lit("kept").alias("part"), checks.row_count().alias("n"), F.sum("saldo").alias("total"))
    faults = columns.rejected(conformed).agg(F.lit("rejected").alias("part"), checks.row_count().alias("n"), F.sum("saldo").alias("total"))
    return kept.unionByName(faults)


def _csv_untyped_folder(spark, sf_dir):
    """Two headers in a folder, inferred types: values come under their own names."""
    folder = fresh_path(spark, "untyped")
    customers = _table(spark, sf_dir, "customer")
    _write_csv(customers.selectExpr("c_custkey as chave", "c_acctbal as saldo"), f"{folder}/a")
    _write_csv(customers.selectExpr("c_acctbal as outro", "c_custkey as chave"), f"{folder}/b")
    return read_folder(spark, folder).selectExpr("cast(chave as bigint) as chave", "saldo", "outro")


def _separator_sniff(spark, sf_dir):
    """The separator as the first line tells it, for four files of one table."""
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    scans = []
    for number, sep in enumerate((",", ";", "\t", "|")):
        path = _write_csv(parts, fresh_path(spark, "sniffed"), sep)
        read = read_delimited(spark, path, "sniff", {"p_partkey": "bigint"})
        scans.append(read.select(F.lit(number).alias("variant"), "p_partkey", "p_brand"))
    return scans[0].unionByName(scans[1]).unionByName(scans[2]).unionByName(scans[3])


def _load_mixed_folder(spark, sf_dir):
    """A folder with two headers into one table."""
    folder = fresh_path(spark, "mixed")
    _write_csv(_table(spark, sf_dir, "supplier").selectExpr("s_suppkey as ID", "s_name as Nome"), f"{folder}/a")
    shifted = "c_custkey + 1000000 as ID"
    _write_csv(_table(spark, sf_dir, "customer").selectExpr("c_mktsegment as Segmento", shifted), f"{folder}/b")
    target = f"{_fresh_schema(spark, 'mixed')}.clientes"
    load_files(spark, folder, target, glob="*.csv", types={"id": "bigint"})
    return spark.table(target).select("id", "nome", "segmento")


def _load_retry(spark, sf_dir):
    """A load that was cut short after its write and is run again: every row and every reject once."""
    schema = _fresh_schema(spark, "retry")
    target, rejects = f"{schema}.bancos_enquadramento", f"{schema}.rejeitados"
    raw = _table(spark, sf_dir, "customer").selectExpr(
        "if(c_custkey % 7 = 0, concat(c_mktsegment, ' and more'), c_mktsegment) as Segmento", "c_custkey as CNPJ", "c_name as Nome"
    )
    options = {"declared": "bancos_enquadramento", "key_columns": ("cnpj",), "rejects": rejects, "at": datetime(2024, 1, 2, tzinfo=timezone.utc)}
    load_frame(raw, target, **options)
    spark.sql(f"TRUNCATE TABLE {rejects}")
    for _ in range(2):
        load_frame(raw, target, **options)
    kept = spark.table(target).select(F.lit(False).alias("diverted"), "segmento", "cnpj", "nome")
    return kept.unionByName(spark.table(rejects).select(F.lit(True).alias("diverted"), "segmento", "cnpj", "nome"))


def _words_in_documents(spark, sf_dir, least):
    """Words of the benchmark of ``least`` letters and more within whole documents: how many documents have each."""
    words = _table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", "[^A-Za-z]+")).alias("word"))
    needles = words.where(F.length("word") >= least).select(F.upper("word").alias("palavra")).distinct()
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("texto"))
    found = substring_join(docs, needles, "texto", "palavra")
    return found.groupBy("palavra").agg(checks.row_count().alias("n"), F.sum("doc_id").alias("ids"))


def _substring_join_long_names(spark, sf_dir):
    """Words of at least 4 letters only, as its SQL has them; ``substring_join_all_words`` has them all."""
    return _words_in_documents(spark, sf_dir, 4)


def _substring_join_all_words(spark, sf_dir):
    """All words of the benchmark, those of 1 to 3 letters too."""
    return _words_in_documents(spark, sf_dir, 1)


def _catalogue_refresh(spark, sf_dir):
    """A second call over a folder that has got a partition and a subfolder."""
    folder, schema = fresh_path(spark, "raw"), _fresh_schema(spark, "refresh")
    orders = _table(spark, sf_dir, "orders").withColumn("ano", F.year("o_orderdate"))
    last = orders.agg(F.max("ano")).first()[0]
    orders.where(F.col("ano") < last).write.partitionBy("ano").parquet(f"{folder}/orders")
    catalogue_folder(spark, folder, schema)
    orders.where(F.col("ano") == last).write.partitionBy("ano").mode("append").parquet(f"{folder}/orders")
    _write_csv(_table(spark, sf_dir, "customer"), f"{folder}/my-customers")
    tables = catalogue_folder(spark, folder, schema)
    n = checks.row_count().alias("n")
    scans = [spark.table(t).groupBy(F.lit(t.split(".")[1]).alias("table_name")).agg(n) for t in tables]
    return scans[0].unionByName(scans[1])


def _consolidate_tables(spark, sf_dir):
    """The three tables loaded, consolidated into one partitioned by year, and read back."""
    schema = _fresh_schema(spark, "consolidated")
    inputs = _complaints(spark, sf_dir), _banks(spark, sf_dir), _employees(spark, sf_dir)
    for name, df in zip(INPUTS, inputs):
        load_frame(df, f"{schema}.{name}")
    consolidate_tables(spark, schema)
    return _rounded_index(spark.table(f"{schema}.{RESULT}").drop("id", "created_at", "updated_at"))


def _append_key_index(spark, sf_dir):
    """Appends that open the files which may hold one of their keys: none for new ids beyond the old ones."""
    target = f"{_fresh_schema(spark, 'indexed')}.saldos"
    keyed = lambda table, key, name, shift: _table(spark, sf_dir, table).select(
        (F.col(key) + shift).alias("id"), F.col(name).alias("nome")
    )
    load_frame(keyed("customer", "c_custkey", "c_name", 0), target, indexed=True)
    for shift in (10**9, 2 * 10**9):
        load_frame(keyed("supplier", "s_suppkey", "s_name", shift), target, indexed=True)
    # Ids between those that are held, which no range leaves out.
    load_frame(_table(spark, sf_dir, "part").select((F.col("p_partkey") + 5 * 10**8).alias("id"), F.col("p_name").alias("nome")), target, indexed=True)
    beyond = keyed("supplier", "s_suppkey", "s_name", 3 * 10**9)
    opened = len(files_that_may_hold(beyond, target, ["id"]))
    return spark.table(target).select("id", "nome", F.lit(opened).alias("opened"))


def _load_ledger(spark, sf_dir):
    """A load called twice without a time: every row once, and the states that it went through."""
    schema = _fresh_schema(spark, "ledger")
    path = _write_csv(_raw_customers(spark, sf_dir), fresh_path(spark, "clientes"))
    for _ in range(2):
        load_once(spark, path, f"{schema}.clientes", types=_RAW_TYPES)
    rows = spark.table(f"{schema}.clientes").select(F.lit("row").alias("kind"), "id", "customer_name")
    states = spark.table(f"{schema}.load_ledger").groupBy(F.col("state").alias("kind")).agg(checks.row_count().alias("id"))
    return rows.unionByName(states.withColumn("customer_name", F.lit(None).cast("string")))


def _consolidate_refresh(spark, sf_dir):
    """Complaints loaded in three parts, of which the last has late rows, and the result brought up to date by each."""
    schema = _fresh_schema(spark, "refreshed")
    for name, df in zip(INPUTS[1:], (_banks(spark, sf_dir), _employees(spark, sf_dir))):
        load_frame(df, f"{schema}.{name}")
    complaints = stage(_complaints(spark, sf_dir), "complaints")
    first, last = complaints.agg(F.min("ano"), F.max("ano")).first()
    late = (F.col("ano") == first) & (F.col("trimestre") > 2)
    for part in ((F.col("ano") < last) & ~late, F.col("ano") == last, late):
        load_frame(complaints.where(part), f"{schema}.{INPUTS[0]}")
        consolidate_refresh(spark, schema)
    return _rounded_index(spark.table(f"{schema}.{RESULT}").drop("id", "created_at", "updated_at"))


def _csv_multiline_split(spark, sf_dir):
    """Texts with line breaks, read by a task for every so many bytes."""
    path = _write_csv(_table(spark, sf_dir, "documents"), fresh_path(spark, "split"))
    return read_split(spark, path, types={"doc_id": "bigint", "n_chars": "bigint"}, range_bytes=4 * 1024 * 1024)


def _separator_vote(spark, sf_dir):
    """The separator as the fields of the first lines tell it, where names and texts hold other separators."""
    parts = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("key, of; the | part,,"), F.concat("p_brand", F.lit(",;|\t,,;;"), "p_name").alias("brand;and,name")
    )
    scans = []
    for number, sep in enumerate((",", ";", "\t", "|")):
        path = fresh_path(spark, "voted")
        parts.write.option("header", True).option("sep", sep).option("quoteAll", True).option("escape", '"').csv(path)
        read = read_delimited(spark, path, "vote").toDF("p_partkey", "label")
        scans.append(read.select(F.lit(number).alias("variant"), F.col("p_partkey").cast("bigint").alias("p_partkey"), "label"))
    return scans[0].unionByName(scans[1]).unionByName(scans[2]).unionByName(scans[3])


def _load_sample(spark, sf_dir):
    """The five rows of the target that a load shows."""
    target = f"{_fresh_schema(spark, 'sample')}.regioes"
    regions = _table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), "r_name")
    shown = load_frame(regions, target).frame(spark)
    rows = shown.select(F.explode(F.from_json("sample", "array<struct<id bigint, r_name string>>")).alias("row"))
    return rows.select("row.*")


def _catalogue_evolve(spark, sf_dir):
    """A folder whose later files have a column more and a wider key."""
    folder, schema = fresh_path(spark, "raw"), _fresh_schema(spark, "evolve")
    orders = _table(spark, sf_dir, "orders")
    orders.where("o_orderstatus = 'F'").selectExpr("cast(o_orderkey as int) as o_orderkey", "o_orderstatus").write.parquet(f"{folder}/orders")
    catalogue_folder(spark, folder, schema)
    later = orders.where("o_orderstatus <> 'F'").select("o_orderpriority", "o_orderkey", "o_orderstatus")
    later.write.mode("append").parquet(f"{folder}/orders")
    (table,) = catalogue_folder(spark, folder, schema)
    return spark.table(table)


def _clustered_lookup(spark, sf_dir):
    """The quarters of one institution, from a table along a curve of years and institutions."""
    table = f"{_fresh_schema(spark, 'clustered')}.reclamacoes"
    complaints = stage(_complaints(spark, sf_dir), "complaints")
    write_clustered(complaints, table, ("ano", "cnpj_if"), 32, ("cnpj_if",))
    key = complaints.agg(F.min("cnpj_if")).first()[0]
    few = 2 * len(files_of(spark, table, {"cnpj_if": key})) <= len(table_files(spark, table))
    found = lookup(spark, table, cnpj_if=key)
    return found.select("cnpj_if", "ano", "trimestre", "quantidade_total_de_reclamacoes", F.lit(few).alias("few"))


def _fuzzy_name_match(spark, sf_dir):
    """Words of the benchmark that nearly are words of part names, or words of the benchmark with another letter."""
    words = lambda table, column: _table(spark, sf_dir, table).select(F.explode(F.split(F.upper(column), "[^A-Z]+")).alias("key"))
    left = words("benchmark", "text").where("key <> ''").distinct()
    changed = left.select(F.concat(F.lit("X"), F.expr("substring(key, 2)")).alias("key"))
    right = words("part", "p_name").where("key <> ''").unionByName(changed).distinct()
    return fuzzy_pairs(stage(left, "left"), stage(right, "right"))


def _incremental_table(spark, sf_dir):
    """Files that arrive in two portions, loaded into a table that numbers their rows."""
    folder, progress = fresh_path(spark, "novos"), fresh_path(spark, "progress")
    target = f"{_fresh_schema(spark, 'stream')}.clientes"
    raw = _raw_customers(spark, sf_dir).drop("PK")
    for part in (raw.where("`Nation-Key` < 10"), raw.where("`Nation-Key` >= 10 or `Nation-Key` is null")):
        _write_csv(part, f"{folder}/{uuid.uuid4().hex}")
        load_new_into_table(spark, folder, target, raw.columns, _RAW_TYPES, progress)
    held = spark.table(target)
    n_ids, last_id = held.agg(F.count_distinct("id"), F.max("id")).first()
    return held.select("customer_name", "nation_key", "acct_bal", F.lit(n_ids).alias("n_ids"), F.lit(last_id).alias("last_id"))


def entry(spark: SparkSession) -> DataFrame:
    """The consolidated table on the smallest test data."""
    return _consolidate(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | _llm_queries()


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {} if llm_queries is None else llm_queries.queries() | {"pipeline": corpus_pipeline.run}


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "consolidate": _consolidate,
        "consolidate_best": lambda spark, sf_dir: _consolidate(spark, sf_dir, best=True),
        "agg_entity_year": _agg_entity_year,
        "left_equi_join": _left_equi_join,
        "substring_join": _substring_join,
        # The same join in the form for more names than fit a broadcast.
        "substring_join_blocked": lambda spark, sf_dir: _substring_join(spark, sf_dir, broadcast_bytes=-1),
        "csv_comma_scan": _csv_comma_scan,
        "csv_tsv_scan": _csv_tsv_scan,
        "csv_pipe_scan": _csv_pipe_scan,
        "separator_detect": _separator_detect,
        "folder_union_scan": _folder_union_scan,
        "catalogue_folder": _catalogue_folder,
        "file_lineage": _file_lineage,
        "inputs_available": _inputs_available,
        "id_detect_rename": _id_detect_rename,
        "id_generate": _id_generate,
        "id_generate_scan": _id_generate_scan,
        "id_not_null": _id_not_null,
        "audit_columns": _audit_columns,
        "normalize_columns": _normalize_columns,
        "conform_schema": _conform_schema,
        "conform_rejects": _conform_rejects,
        "padded_keys": _padded_keys,
        "length_violations": _length_violations,
        "decimal_comma_parse": _decimal_comma_parse,
        "id_stats": _id_stats,
        "sample_rows": _sample_rows,
        "schema_report": _schema_report,
        "pk_violations": _pk_violations,
        "unique_violations": _unique_violations,
        "ensure_target": _ensure_target,
        "table_roundtrip": _table_roundtrip,
        "load_append_twice": _load_append_twice,
        "load_overwrite": _load_overwrite,
        "load_profile": _load_profile,
        "load_declared": _load_declared,
        "post_load_verify": _post_load_verify,
        "load_job": _load_job,
        "incremental_load": _incremental_load,
        "left_equi_join_salted": _left_equi_join_salted,
        "decimal_comma_mixed": _decimal_comma_mixed,
        "conform_fractions": _conform_fractions,
        "csv_untyped_folder": _csv_untyped_folder,
        "separator_sniff": _separator_sniff,
        "load_mixed_folder": _load_mixed_folder,
        "load_retry": _load_retry,
        "substring_join_long_names": _substring_join_long_names,
        "substring_join_all_words": _substring_join_all_words,
        "catalogue_refresh": _catalogue_refresh,
        "consolidate_tables": _consolidate_tables,
        "append_key_index": _append_key_index,
        "load_ledger": _load_ledger,
        "consolidate_refresh": _consolidate_refresh,
        "csv_multiline_split": _csv_multiline_split,
        "separator_vote": _separator_vote,
        "load_sample": _load_sample,
        "catalogue_evolve": _catalogue_evolve,
        "clustered_lookup": _clustered_lookup,
        "fuzzy_name_match": _fuzzy_name_match,
        "incremental_table": _incremental_table,
    }


_SUBSTRING_SQL = _BANK_SQL + """
select p_partkey, p_name, nome, geral, cultura_e_valores, remuneracao_e_beneficios, recomendam_para_outras_pessoas
from part left join matches on p_name = name"""

_RAW_CUSTOMER_SQL = """
select c_custkey as id, c_name as customer_name, c_nationkey as nation_key, c_acctbal as acct_bal,
  c_mktsegment as segmento_mercado
from customer where c_acctbal >= 0"""


def oracle_sql() -> dict[str, str]:
    return _own_sql() | _llm_sql()


def _llm_sql() -> dict[str, str]:
    if llm_queries is None:
        return {}
    piped = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return llm_queries.oracle_sql() | piped


def _own_sql() -> dict[str, str]:
    return {
        "consolidate": _BANK_SQL + "select * exclude (nome) from result",
        "consolidate_best": _BANK_SQL
        + """select * exclude (nome) from result
qualify row_number() over (partition by cnpj, ano order by length(trim(nome)) desc nulls last, upper(trim(nome)),
  nome, segmento) = 1""",
        "agg_entity_year": _BANK_SQL + "select * from agg",
        "left_equi_join": _BANK_SQL + "select agg.*, segmento from agg left join banks on cnpj_if = cnpj",
        "substring_join": _SUBSTRING_SQL,
        "substring_join_blocked": _SUBSTRING_SQL,
        "csv_comma_scan": "select * from documents",
        "csv_tsv_scan": "select * from customer",
        "csv_pipe_scan": "select * from part",
        "separator_detect": """
with paths as (
  select 0 as variant, url as path from pages union all select 1, url || '.TSV' from pages
  union all select 2, 'Glassdoor/' || url from pages union all select 3, url || '|.csv' from pages)
select variant::int as variant,
  (case when lower(path) like '%.tsv' then 9
    when contains(path, '|') or contains(lower(path), 'glassdoor') then 124 else 44 end)::int as separator_code,
  count(*) as n
from paths group by 1, 2""",
        "folder_union_scan": """
select s_suppkey as chave, s_acctbal as saldo, s_name as "Nome", null::varchar as "Segmento" from supplier
union all
select c_custkey, null, c_name, c_mktsegment from customer""",
        "catalogue_folder": """
select 'orders' as table_name, year(o_orderdate)::int as ano, count(*) as n from orders group by 1, 2
union all
select 'customer', null, count(*) from customer""",
        "file_lineage": """
select 'lineitem.parquet' as arquivo_origem, count(*) as n from lineitem
union all select 'orders.parquet', count(*) from orders
union all select 'customer.parquet', count(*) from customer""",
        "inputs_available": """
select 'lineitem' as table_name, count(*) as row_count from lineitem
union all select 'part', count(*) from part
union all select 'customer', count(*) from customer""",
        "id_detect_rename": "select c_custkey as id, c_name, c_nationkey, c_acctbal, c_mktsegment from customer",
        "id_generate": """
select row_number() over (order by o_orderkey) as id, o_orderkey, o_totalprice from orders""",
        "id_generate_scan": """
select row_number() over (order by o_orderkey) as id, o_orderkey, o_orderpriority from orders""",
        "id_not_null": """
select o_orderkey as id, o_orderstatus, o_totalprice from orders where o_orderstatus <> 'F'""",
        "audit_columns": """
select count(*) as n_rows, count(*) as n_same, count(*) filter (o_orderstatus = 'O') as n_filled,
  count(*) filter (o_orderstatus <> 'O') as n_kept
from orders""",
        "normalize_columns": """
select c_custkey as numero_do_cliente, c_name as nome_do_cliente, c_nationkey as nacao, c_acctbal as saldo_r,
  c_mktsegment as saldo_r_2
from customer""",
        "conform_schema": """
select c_mktsegment, c_acctbal::decimal(10,2) as saldo, (c_acctbal / 1000)::decimal(3,1) as nota,
  c_custkey::int as c_custkey, null::varchar as trimestre
from customer where length(c_mktsegment) <= 9""",
        "conform_rejects": """
select 'o_orderpriority' as fault, count(*) as n from orders where length(o_orderpriority) > 8
union all
select 'o_totalprice', count(*) from orders where abs(o_totalprice) >= 100000 having count(*) > 0""",
        "padded_keys": """
select c_custkey, case when length(c_custkey::varchar) < 8 then lpad(c_custkey::varchar, 8, '0')
  else c_custkey::varchar end as cnpj
from customer""",
        "length_violations": """
select p_partkey, p_name, length(p_name)::int as n_chars from part where length(p_name) > 9""",
        "decimal_comma_parse": """
select o_orderpriority, sum(o_totalprice::decimal(15,2))::decimal(25,2) as total from orders group by 1""",
        "id_stats": """
select min(o_orderkey) as min_id, max(o_orderkey) as max_id, count(o_orderkey) as count_id from orders""",
        "sample_rows": "select * from orders order by o_orderkey limit 5",
        "schema_report": """
select ordinal::int as ordinal, column_name, target_type, (select count(*) from orders) as row_count
from (values (1, 'id', 'BIGINT PRIMARY KEY'), (2, 'o_orderkey', 'BIGINT'), (3, 'o_custkey', 'BIGINT'),
  (4, 'o_orderstatus', 'TEXT'), (5, 'o_totalprice', 'DOUBLE PRECISION'), (6, 'o_orderdate', 'TIMESTAMP'),
  (7, 'o_orderpriority', 'TEXT')) as t(ordinal, column_name, target_type)""",
        "pk_violations": """
select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1""",
        "unique_violations": _BANK_SQL + """
select cnpj, ano, count(*) as n from result group by 1, 2 having count(*) > 1""",
        "ensure_target": """
select false as existed_before, true as existed_after, 'id' as first_column, count(*) as n from customer""",
        "table_roundtrip": "select * from part",
        "load_append_twice": """
select row_number() over (order by c_custkey) as id, c_name as nome, c_acctbal as saldo from customer
union all
select row_number() over (order by s_suppkey) + (select count(*) from customer), s_name, s_acctbal from supplier""",
        "load_overwrite": """
select row_number() over (order by c_custkey) as id, c_name as nome, c_acctbal as saldo from customer""",
        "load_profile": """
select 'overwrite' as mode, count(*) as rows_in, count(*) filter (o_orderstatus = 'F') as rows_dropped,
  count(*) filter (o_orderstatus <> 'F') as rows_written,
  min(o_orderkey) filter (o_orderstatus <> 'F') as min_id, max(o_orderkey) filter (o_orderstatus <> 'F') as max_id
from orders""",
        "load_declared": """
with raw as (
  select c_mktsegment as segmento, c_custkey, c_name as nome from customer
  union all select c_mktsegment || ' ' || c_custkey::varchar, c_custkey, c_name from customer)
select length(segmento) > 10 as diverted, segmento,
  case when length(c_custkey::varchar) < 8 then lpad(c_custkey::varchar, 8, '0') else c_custkey::varchar end as cnpj, nome
from raw""",
        "post_load_verify": """
select count(*) as source_rows, count(*) as target_rows, 8 as target_columns, true as matches from orders""",
        "load_job": _RAW_CUSTOMER_SQL,
        "incremental_load": _RAW_CUSTOMER_SQL,
        "left_equi_join_salted": _BANK_SQL + """
, doubled as (select * from banks union all select 1, segmento from banks where cnpj % 3 = 0)
select agg.*, segmento from agg left join doubled on cnpj_if = cnpj""",
        "decimal_comma_mixed": """
select (o_orderkey % 5) as kind,
  sum(case o_orderkey % 5 when 0 then o_totalprice when 1 then -o_totalprice end::decimal(15,2))::decimal(25,2) as total,
  count(*) filter (o_orderkey % 5 > 1) as rejected
from orders group by 1""",
        "conform_fractions": """
select 'kept' as part, count(*) as n, sum(round(c_acctbal))::bigint as total from customer where c_custkey % 3 <> 0
union all
select 'rejected', count(*), null from customer where c_custkey % 3 = 0""",
        "csv_untyped_folder": """
select c_custkey as chave, c_acctbal as saldo, null::double as outro from customer
union all
select c_custkey, null, c_acctbal from customer""",
        "separator_sniff": """
select variant::int as variant, p_partkey, p_brand from part, range(4) as variants(variant)""",
        "load_mixed_folder": """
select s_suppkey as id, s_name as nome, null::varchar as segmento from supplier
union all
select c_custkey + 1000000, null, c_mktsegment from customer""",
        "load_retry": """
with raw as (
  select if(c_custkey % 7 = 0, c_mktsegment || ' and more', c_mktsegment) as segmento, c_custkey, c_name as nome from customer)
select length(segmento) > 10 as diverted, segmento,
  case when length(c_custkey::varchar) < 8 then lpad(c_custkey::varchar, 8, '0') else c_custkey::varchar end as cnpj, nome
from raw""",
        "substring_join_long_names": """
with needles as (
  select distinct upper(word) as palavra
  from (select unnest(regexp_split_to_array(text, '[^A-Za-z]+')) as word from benchmark) where length(word) >= 4),
docs as (select doc_id, upper(replace(text, 'ß', 'ss')) as texto from documents)
select palavra, count(*) as n, sum(doc_id)::bigint as ids
from docs left join needles on contains(texto, palavra) group by 1""",
        "substring_join_all_words": """
with needles as (
  select distinct upper(word) as palavra
  from (select unnest(regexp_split_to_array(text, '[^A-Za-z]+')) as word from benchmark) where word <> ''),
docs as (select doc_id, upper(replace(text, 'ß', 'ss')) as texto from documents)
select palavra, count(*) as n, sum(doc_id)::bigint as ids
from docs left join needles on contains(texto, palavra) group by 1""",
        "catalogue_refresh": """
select 'orders' as table_name, count(*) as n from orders union all select 'my_customers', count(*) from customer""",
        "consolidate_tables": _BANK_SQL + "select * exclude (nome) from result",
        "append_key_index": """
select c_custkey as id, c_name as nome, 0::int as opened from customer
union all select s_suppkey + 1000000000, s_name, 0 from supplier
union all select s_suppkey + 2000000000, s_name, 0 from supplier
union all select p_partkey + 500000000, p_name, 0 from part""",
        "load_ledger": """
select 'row' as kind, c_custkey as id, c_name as customer_name from customer where c_acctbal >= 0
union all select 'begun', 1, null union all select 'written', 1, null union all select 'verified', 1, null""",
        "consolidate_refresh": _BANK_SQL + "select * exclude (nome) from result",
        "csv_multiline_split": "select * from documents",
        "separator_vote": """
select variant::int as variant, p_partkey, p_brand || ',;|' || chr(9) || ',,;;' || p_name as label
from part, range(4) as variants(variant)""",
        "load_sample": "select r_regionkey as id, r_name from region",
        "catalogue_evolve": """
select o_orderkey, o_orderstatus, if(o_orderstatus = 'F', null, o_orderpriority) as o_orderpriority from orders""",
        "clustered_lookup": _BANK_SQL + """
select l_partkey as cnpj_if, ano, trimestre::int as trimestre, reclamacoes::bigint as quantidade_total_de_reclamacoes,
  true as few
from quarterly join part on l_partkey = p_partkey
where l_partkey = (select min(l_partkey) from quarterly join part on l_partkey = p_partkey)""",
        "fuzzy_name_match": """
with words as (select distinct unnest(regexp_split_to_array(upper(replace(text, 'ß', 'ss')), '[^A-Z]+')) as w from benchmark),
lefts as (select w as left_key from words where w <> ''),
rights as (
  select 'X' || substr(left_key, 2) as right_key from lefts
  union select unnest(regexp_split_to_array(upper(p_name), '[^A-Z]+')) from part),
scored as (
  select left_key, right_key, greatest(length(left_key), length(right_key)) as longer,
    levenshtein(left_key, right_key) as edits
  from lefts, rights where right_key <> '')
select left_key, right_key, floor(100 * (longer - edits) / longer)::int as match_percent
from scored where floor(100 * (longer - edits) / longer) >= 80""",
        "incremental_table": """
select c_name as customer_name, c_nationkey::int as nation_key, c_acctbal as acct_bal,
  (select count(*) from customer) as n_ids, (select count(*) from customer) as last_id
from customer""",
    }
