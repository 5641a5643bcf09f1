"""Declared tables: columns, types, keys and the names under which raw files carry them."""

from __future__ import annotations

from pyspark.sql import types as T

# The declared columns of the four tables. Every table also has a generated
# ``id`` (primary key) and ``data_processamento`` (time of the load by default).
TABLES: dict[str, dict[str, str]] = {
    "reclamacoes": {
        "ano": "int",
        "trimestre": "varchar(10)",
        "categoria": "varchar(100)",
        "tipo": "varchar(100)",
        "cnpj_if": "varchar(20)",
        "instituicao_financeira": "varchar(200)",
        "indice": "decimal(10,2)",
        "qtd_reclamacoes_reguladas_procedentes": "int",
        "qtd_reclamacoes_reguladas_outras": "int",
        "qtd_reclamacoes_nao_reguladas": "int",
        "qtd_total_reclamacoes": "int",
        "qtd_total_clientes_ccs_scr": "bigint",
        "qtd_clientes_ccs": "bigint",
        "qtd_clientes_scr": "bigint",
        "arquivo_origem": "varchar(100)",
    },
    "bancos_enquadramento": {
        "segmento": "varchar(10)",
        "cnpj": "varchar(20)",
        "nome": "varchar(200)",
    },
    "empregados_glassdoor": {
        "employer_name": "varchar(200)",
        "reviews_count": "int",
        "culture_count": "int",
        "salaries_count": "int",
        "benefits_count": "int",
        "employer_website": "varchar(500)",
        "employer_headquarters": "varchar(200)",
        "employer_founded": "decimal(10,2)",
        "employer_industry": "varchar(500)",
        "employer_revenue": "varchar(200)",
        "url": "varchar(1000)",
        "geral": "decimal(3,1)",
        "cultura_valores": "decimal(3,1)",
        "diversidade_inclusao": "decimal(3,1)",
        "qualidade_vida": "decimal(3,1)",
        "alta_lideranca": "decimal(3,1)",
        "remuneracao_beneficios": "decimal(3,1)",
        "oportunidades_carreira": "decimal(3,1)",
        "recomendam_outras_pessoas": "decimal(5,1)",
        "perspectiva_positiva_empresa": "decimal(5,1)",
        "segmento": "varchar(10)",
        "nome": "varchar(200)",
        "match_percent": "int",
    },
    "dados_consolidados": {
        "cnpj": "varchar(20)",
        "nome_instituicao": "varchar(200)",
        "segmento": "varchar(10)",
        "ano": "int",
        "total_reclamacoes": "int",
        "total_clientes": "bigint",
        "indice_reclamacoes": "decimal(10,2)",
        "avaliacao_geral": "decimal(3,1)",
        "cultura_valores": "decimal(3,1)",
        "remuneracao_beneficios": "decimal(3,1)",
        "recomendam_empresa": "decimal(5,1)",
    },
}

# Cleaned raw name -> declared name, where the two differ.
RENAMES: dict[str, dict[str, str]] = {
    "reclamacoes": {
        "quantidade_total_de_reclamacoes": "qtd_total_reclamacoes",
        "quantidade_total_de_clientes_ccs_e_scr": "qtd_total_clientes_ccs_scr",
    },
    "bancos_enquadramento": {},
    "empregados_glassdoor": {
        "cultura_e_valores": "cultura_valores",
        "diversidade_e_inclusao": "diversidade_inclusao",
        "qualidade_de_vida": "qualidade_vida",
        "remuneracao_e_beneficios": "remuneracao_beneficios",
        "oportunidades_de_carreira": "oportunidades_carreira",
        "recomendam_para_outras_pessoas": "recomendam_outras_pessoas",
        "perspectiva_positiva_da_empresa": "perspectiva_positiva_empresa",
    },
    "dados_consolidados": {"remuneracao_e_beneficios": "remuneracao_beneficios"},
}

# Keys that may not repeat.
UNIQUE_KEYS: dict[str, list[list[str]]] = {
    "reclamacoes": [["id"]],
    "bancos_enquadramento": [["id"]],
    "empregados_glassdoor": [["id"]],
    "dados_consolidados": [["id"], ["cnpj", "ano"]],
}

# Relational type of each Spark type; anything else becomes TEXT.
_TARGET_TYPES: dict[type, str] = {
    T.StringType: "TEXT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.DoubleType: "DOUBLE PRECISION",
    T.BooleanType: "BOOLEAN",
    T.TimestampType: "TIMESTAMP",
    T.DateType: "DATE",
}

# Types the table above would turn into TEXT although the target has a close one.
_CLOSER_TYPES: dict[type, str] = {
    T.TimestampNTZType: "TIMESTAMP",
    T.FloatType: "REAL",
    T.ShortType: "SMALLINT",
    T.ByteType: "SMALLINT",
}


def raw_types(table: str) -> dict[str, str]:
    """Types by cleaned raw name, for reading the files of a table without inference."""
    raw_names = {declared: raw for raw, declared in RENAMES[table].items()}
    plain = {name: "string" if kind.startswith("varchar") else kind for name, kind in TABLES[table].items()}
    return {raw_names.get(name, name): kind for name, kind in plain.items()}


def target_type(data_type: T.DataType, strict: bool = False) -> str:
    """Relational type for a Spark type; ``strict`` keeps to the seven fixed types and TEXT."""
    if type(data_type) in _TARGET_TYPES:
        return _TARGET_TYPES[type(data_type)]
    if not strict:
        if isinstance(data_type, T.DecimalType):
            return f"NUMERIC({data_type.precision},{data_type.scale})"
        if type(data_type) in _CLOSER_TYPES:
            return _CLOSER_TYPES[type(data_type)]
    return "TEXT"


def target_columns(schema: T.StructType, strict: bool = False) -> list[tuple[str, str]]:
    """(name, type) of the table made for ``schema``: ``id`` leads as primary key, added if absent."""
    columns = [(f.name.lower(), target_type(f.dataType, strict)) for f in schema.fields]
    key = next((kind for name, kind in columns if name == "id"), "BIGINT")
    return [("id", f"{key} PRIMARY KEY"), *(c for c in columns if c[0] != "id")]
