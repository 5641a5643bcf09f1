"""Column operators of a load: audit columns, null ids, clean names, declared types."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from ledgerloom.functions.names import clean_names

REJECTS = "_rejects"
PROCESSED = "data_processamento"
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_FRACTIONAL = (FloatType, DoubleType, DecimalType)


def load_time(at: datetime | None = None) -> Column:
    """One instant as a literal: every task, retry and later read of the plan sees the same."""
    return F.lit(at or datetime.now(timezone.utc))


def with_audit(df: DataFrame, at: Column) -> DataFrame:
    """Set ``created_at`` and ``updated_at`` to the time of the load."""
    return df.withColumns({"created_at": at, "updated_at": at})


def with_processing_time(df: DataFrame, at: Column, name: str = PROCESSED) -> DataFrame:
    """Fill the processing time where the data does not bring one."""
    return df.withColumn(name, F.coalesce(F.col(name), at) if name in df.columns else at)


def drop_null_ids(df: DataFrame) -> DataFrame:
    return df.where(F.col("id").isNotNull())


def clean_columns(df: DataFrame, strict: bool = False) -> DataFrame:
    """All columns renamed to their cleaned names in one projection."""
    return df.toDF(*clean_names(df.columns, strict))


def conform(df: DataFrame, declared: dict[str, str], renames: dict[str, str] | None = None) -> DataFrame:
    """``df`` in the declared columns, order and types.

    A value that does not fit its type becomes null, one that is too long stays, and either is
    listed in ``_rejects`` with its column: keep the rows where that array is empty and divert the
    rest. Declared columns that ``df`` lacks are null; further ones are left out, but for ``id``, see
    ``left_out``. A fraction does not fit a whole number.
    """
    renames = renames or {}
    source = {renames.get(name, name): F.col(f"`{name}`") for name in df.columns}
    types = {renames.get(field.name, field.name): field.dataType for field in df.schema.fields}
    columns, faults = [], []
    for name, kind in declared.items():
        if name not in source:
            columns.append(F.lit(None).cast("string" if kind.startswith("varchar") else kind).alias(name))
            continue
        raw = source[name]
        if kind.startswith("varchar"):
            limit = int(kind[len("varchar(") : -1])
            value = raw.cast("string")
            fault = F.length(value) > limit
        else:
            value = raw.try_cast(kind)
            if kind in _WHOLE and isinstance(types[name], _FRACTIONAL):
                # A cast would cut the fraction off; a decimal of fewer places is rounded.
                value = F.when(raw == F.floor(raw), value)
            fault = raw.isNotNull() & value.isNull()
        columns.append(value.alias(name))
        as_read = F.struct(F.lit(name).alias("column"), raw.cast("string").alias("value"))
        faults.append(F.when(fault, as_read))
    kept = [source["id"].alias("id")] if "id" in source and "id" not in declared else []
    return df.select(*kept, *columns, F.array_compact(F.array(*faults)).alias(REJECTS))


def left_out(df: DataFrame, declared: dict[str, str], renames: dict[str, str] | None = None) -> list[str]:
    """Columns of ``df`` that ``conform`` leaves out."""
    named = [(renames or {}).get(name, name) for name in df.columns]
    return [name for name in named if name not in declared and name != "id"]


def accepted(conformed: DataFrame) -> DataFrame:
    return conformed.where(F.size(REJECTS) == 0).drop(REJECTS)


def rejected(conformed: DataFrame) -> DataFrame:
    return conformed.where(F.size(REJECTS) > 0)


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows in which a text is longer than its limit; a null text fits."""
    over = [F.length(name) > limit for name, limit in limits.items()]
    return df.where(F.array_contains(F.array(*over), True))
