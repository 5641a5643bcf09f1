"""Target tables: schemas and tables made when missing, appended to or replaced.

A target is named ``table``, ``schema.table`` or ``catalog.schema.table``. A relational database
is a target once ``sources.tables.register_jdbc_catalog`` has made it a catalog; its batch size,
isolation and number of connections come from the options given there.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.schemas import target_columns

# Partitions of a table that one task writes side by side; rows of further ones it sorts first.
OPEN_PARTITIONS = 64


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session with another value of a setting for a while."""
    kept = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if kept is None else spark.conf.set(key, kept)


def side_by_side(spark: SparkSession) -> AbstractContextManager[None]:
    """Writes to partitioned tables with a file open for every partition of a task.

    Spark else sorts all rows of a task by partition first. Rows take many times the memory that
    they take on disk, so a task that reads 128 MB of files would sort gigabytes.
    """
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_PARTITIONS))


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """Create the schema if missing; ``location`` is the folder for its tables."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {schema}{at}")


def is_database(spark: SparkSession, table: str) -> bool:
    """Whether the table belongs to a relational database, as the catalog of its name says."""
    parts = table.split(".")
    made_by = spark.conf.get(f"spark.sql.catalog.{parts[0]}", "") if len(parts) > 2 else ""
    return made_by.endswith("JDBCTableCatalog")


def ensure_table(df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> bool:
    """Create the table from the columns of ``df``, ``id`` first, if missing.

    A new table outside databases is partitioned by ``partition_by``, whose columns come last.

    Returns whether it was there before. If that cannot be told the error is raised: nothing is
    ever replaced because a check failed. Keys are checked before the write, see ``checks``.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        return True
    own_catalog = table.count(".") > 1 and table.split(".")[0] != "spark_catalog"
    using = "" if own_catalog else " USING parquet"
    if partition_by and not is_database(spark, table):
        using += f" PARTITIONED BY ({', '.join(f'`{name}`' for name in partition_by)})"
    fields = sorted(df.schema.fields, key=lambda f: f.name.lower() != "id")
    columns = ", ".join(f"`{f.name.lower()}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(f"CREATE TABLE {table} ({columns}){using}")
    return False


def target_ddl(df: DataFrame, table: str, strict: bool = False) -> str:
    """The statement that makes the table in a database with ``id`` as its enforced primary key.

    Spark cannot declare that key; who wants the database to enforce it runs this first.
    """
    columns = ", ".join(f"{name} {kind}" for name, kind in target_columns(df.schema, strict))
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns})"


def aligned(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the columns, order and types of an existing table, matched by name.

    Columns the rows lack are null. Columns the table lacks are an error, and so is a text for a
    column of another type or the other way round.
    """
    given = {field.name.lower(): field for field in df.schema.fields}
    columns = []
    for field in df.sparkSession.table(table).schema.fields:
        found = given.pop(field.name.lower(), None)
        if found is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        if isinstance(found.dataType, StringType) != isinstance(field.dataType, StringType):
            raise ValueError(f"{table}.{field.name} is {field.dataType.simpleString()}, not {found.dataType.simpleString()}")
        columns.append(F.col(f"`{found.name}`").cast(field.dataType).alias(field.name))
    if given:
        raise ValueError(f"table {table} has no columns {sorted(given)}")
    return df.select(*columns)


def write_table(df: DataFrame, table: str, mode: str) -> None:
    """Append to an existing table or replace its rows; see ``aligned`` for the columns.

    Replacing truncates: the table itself, with its types and keys, is kept.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be append or overwrite, not {mode!r}")
    with side_by_side(df.sparkSession):
        aligned(df, table).write.insertInto(table, overwrite=mode == "overwrite")
