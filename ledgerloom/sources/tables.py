"""Tables of a catalog, including relational databases registered as catalogs."""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.sources.delimited import file_paths, header_of, headers_below, read_delimited, separator_for

# Rows per insert statement and isolation of the relational writes.
JDBC_BATCH_ROWS = 1000
JDBC_ISOLATION = "READ_UNCOMMITTED"


class MissingTables(LookupError):
    """Some input tables are not there."""

    def __init__(self, names: list[str]):
        super().__init__("tables not available: " + ", ".join(names))
        self.names = names


def read_tables(
    spark: SparkSession,
    names: list[str],
    database: dict[str, str] | None = None,
    split_by: str = "id",
    splits: int = 64,
) -> list[DataFrame]:
    """All the named tables, or an error that lists every missing one. Empty tables count as there.

    Tables of a ``database`` (its ``jdbc_options``) are each read over ``splits`` connections, cut by
    the numeric column ``split_by``; one that is missing there is an error of the database.
    """
    if database is not None:
        return [read_jdbc(spark, database, name, split_by, splits) for name in names]
    missing = [name for name in names if not spark.catalog.tableExists(name)]
    if missing:
        raise MissingTables(missing)
    return [spark.table(name) for name in names]


def jdbc_options(url: str, user: str, password: str, driver: str, connections: int = 64) -> dict[str, str]:
    """Options for reading and writing one database, with at most ``connections`` at a time."""
    return {
        "url": url,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(JDBC_BATCH_ROWS),
        "isolationLevel": JDBC_ISOLATION,
        "numPartitions": str(connections),
    }


def register_jdbc_catalog(spark: SparkSession, name: str, options: dict[str, str]) -> None:
    """Make a database a catalog, so that ``name.schema.table`` works like any other table."""
    prefix = f"spark.sql.catalog.{name}"
    for key, value in options.items():
        spark.conf.set(f"{prefix}.{key}", value)
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")


def bounds_query(table: str, column: str) -> str:
    """What the database is asked for the smallest and largest value: one row comes back."""
    return f"(select min({column}) as low, max({column}) as high from {table}) bounds"


def split_options(column: str, low, high, splits: int) -> dict[str, str]:
    """Options that cut a relational scan; values beyond the bounds fall into its first and last part."""
    return {
        "partitionColumn": column,
        "lowerBound": str(math.floor(low)),
        "upperBound": str(math.floor(high) + 1),
        "numPartitions": str(splits),
    }


def read_jdbc(
    spark: SparkSession, options: dict[str, str], table: str, split_by: str | None = None, splits: int = 64
) -> DataFrame:
    """Scan a relational table, over ``splits`` connections if a numeric ``split_by`` is given."""
    reader = spark.read.format("jdbc").options(**options)
    if split_by is not None:
        low, high = reader.option("dbtable", bounds_query(table, split_by)).load().first()
        if low is not None:
            reader = reader.options(**split_options(split_by, low, high, splits))
    return reader.option("dbtable", table).load()


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as listed paths name it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(path).toString().rstrip("/")


#: Types that a column of the types before them is read as.
_WIDER = [("tinyint", "smallint", "int", "bigint"), ("float", "double"), ("tinyint", "smallint", "int", "double")]


class SchemaClash(ValueError):
    """Files of one folder have types of a column that no common one holds."""


def wider_type(a: str, b: str) -> str | None:
    """The type that holds the values of both, and as which Parquet files of either can be read."""
    if a == b:
        return a
    for chain in _WIDER:
        if a in chain and b in chain:
            return chain[max(chain.index(a), chain.index(b))]
    found = [re.fullmatch(r"decimal\((\d+),(\d+)\)", kind) for kind in (a, b)]
    if all(found):
        scale = max(int(m[2]) for m in found)
        precision = scale + max(int(m[1]) - int(m[2]) for m in found)
        return f"decimal({precision},{scale})" if precision <= 38 else None
    return None


def merged_columns(schemas: list[list[tuple[str, str]]]) -> list[tuple[str, str]]:
    """The columns (name, type) of all schemas in the order they come, each in the widest type it has."""
    kinds: dict[str, str] = {}
    for name, kind in (column for columns in schemas for column in columns):
        wider = wider_type(kinds.get(name, kind), kind)
        if wider is None:
            raise SchemaClash(f"column {name} is both {kinds[name]} and {kind}")
        kinds[name] = wider
    return list(kinds.items())


def _parquet_schemas(spark: SparkSession, location: str) -> list[list[tuple[str, str]]]:
    """The distinct schemas of the Parquet files below a folder, in order of their first files.

    Footers are read by tasks, and only distinct schemas reach the driver.
    """

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_schema

        def schema_of(path: str) -> str:
            store, place = fs.FileSystem.from_uri(path.replace(" ", "%20"))
            found = pq.read_schema(place, filesystem=store)
            # Files that Spark wrote say what its types were.
            own = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
            return own.decode() if own else from_arrow_schema(found).json()

        for batch in batches:
            found = [schema_of(path) for path in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["path", "schema"])

    files = file_paths(spark, location, "*.parquet")
    schemas = files.mapInArrow(read, "path string, schema string").groupBy("schema").agg(F.min("path").alias("path"))
    rows = sorted(schemas.collect(), key=lambda r: r["path"])
    return [[(f.name, f.dataType.simpleString()) for f in StructType.fromJson(json.loads(r["schema"]))] for r in rows]


def _evolve(spark: SparkSession, table: str, endings: list[str], location: str, nested: bool, sample: str) -> None:
    """Give a registered table the columns and wider types that its files have got since.

    Columns that no file has any more stay. A delimited table takes another header only if all its
    files have that one, since their columns are told by place.
    """
    held = [(c.name, c.dataType) for c in spark.catalog.listColumns(table) if not c.isPartition]
    parted = [(c.name, c.dataType) for c in spark.catalog.listColumns(table) if c.isPartition]
    partitions = [name for name, _ in parted]
    if endings == ["parquet"]:
        merged = merged_columns([held, *_parquet_schemas(spark, location)])
        merged = [column for column in merged if column[0] not in partitions]
        source, options = "parquet", {}
        if merged[: len(held)] == held:
            if added := merged[len(held) :]:
                typed = ", ".join(f"`{name}` {kind}" for name, kind in added)
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({typed})")
            return
    else:
        sep = separator_for(sample)
        headers = headers_below(spark, location)
        if len(headers) > 1:
            raise SchemaClash(f"{table}: files of one folder have several headers: {sorted(headers)[:3]}")
        names = [name for name in header_of(spark, location, sep, recursive=nested) if name not in partitions]
        if names == [name for name, _ in held]:
            return
        known = dict(held)
        found = dict(read_delimited(spark, location, sep, recursive=nested).dtypes)
        merged = [(name, known.get(name, "string" if found[name].startswith("decimal") else found[name])) for name in names]
        source, options = "csv", {"header": "true", "enforceSchema": "false", "quote": '"', "escape": '"', "sep": sep}
    if nested:
        options["recursiveFileLookup"] = "true"
    # A table with a location of its own leaves its files where they are.
    spark.sql(f"DROP TABLE {table}")
    _create_table(spark, table, merged + parted, source, options, partitions, location)


def catalogue_folder(
    spark: SparkSession, folder: str, schema: str, types: dict[str, dict[str, str]] | None = None, evolve: bool = True
) -> list[str]:
    """Register every subfolder as a table of ``schema`` and return the table names.

    Folders named ``name=value`` are partitions. Parquet brings its columns; delimited files take
    them from the header, typed by ``types[subfolder]`` or inferred; their decimals stay text, since
    the reader would drop commas from them. Other formats are refused before anything is registered.
    A table of a former call is refreshed and gets the partitions that were added since; with ``evolve``
    also the columns that its files have got since, and wider types where they have such
    (``wider_type``). Types without a common one raise ``SchemaClash``. Partitions have the schema of
    their table; columns that their files lack are null.
    """
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {schema}")
    root = _qualified(spark, folder) + "/"
    # Listed paths differ from qualified ones in the slashes after the scheme only.
    plain = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/")
    start = len(re.sub("^([a-z0-9]+):/+", r"\1:/", root)) + 1
    below = F.substring(plain, start, 1 << 20)
    samples = (
        file_paths(spark, folder)
        .where(below.contains("/"))
        .groupBy(F.substring_index(below, "/", 1).alias("subfolder"))
        .agg(F.min(below).alias("path"), F.collect_set(F.lower(F.regexp_extract(below, r"\.([^./]+)$", 1))).alias("endings"))
    ).orderBy("subfolder").collect()
    odd = {r["subfolder"]: sorted(r["endings"]) for r in samples if set(r["endings"]) not in ({"parquet"}, {"csv"}, {"tsv"})}
    if odd:
        raise ValueError(f"neither Parquet nor delimited files, or of several formats: {odd}")
    tables = []
    for subfolder, sample, endings in samples:
        # Catalogs take letters, digits and underscores only.
        table, location = f"{schema}.{re.sub('[^0-9A-Za-z_]', '_', subfolder)}", f"{folder.rstrip('/')}/{subfolder}"
        if table in tables:
            raise ValueError(f"two subfolders are both named {table}")
        partitions = [step.split("=")[0] for step in sample.split("/")[:-1] if "=" in step]
        # Subfolders that are no partitions.
        nested = any("=" not in step for step in sample.split("/")[1:-1])
        if spark.catalog.tableExists(table):
            spark.catalog.refreshTable(table)
            if evolve:
                _evolve(spark, table, endings, location, nested, sample)
            if partitions:
                spark.catalog.recoverPartitions(table)
        else:
            if endings == ["parquet"]:
                source, options = "parquet", {}
                columns = spark.read.option("recursiveFileLookup", nested).parquet(location).dtypes
            else:
                source, sep = "csv", separator_for(sample)
                found = read_delimited(spark, location, sep, (types or {}).get(subfolder), recursive=nested).dtypes
                columns = [(name, "string" if kind.startswith("decimal") else kind) for name, kind in found]
                # A file whose header differs must fail and not be read by position.
                options = {"header": "true", "enforceSchema": "false", "quote": '"', "escape": '"', "sep": sep}
            if nested:
                options["recursiveFileLookup"] = "true"
            _create_table(spark, table, columns, source, options, partitions, location)
        tables.append(table)
    return tables


def _create_table(spark, table, columns, source, options, partitions, location):
    typed = ", ".join(f"`{name}` {kind}" for name, kind in columns)
    quoted = ", ".join(f"'{key}' '{value}'" for key, value in options.items())
    spark.sql(
        f"CREATE TABLE {table} ({typed}) USING {source}"
        + (f" OPTIONS ({quoted})" if options else "")
        + (f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else "")
        + f" LOCATION '{location}'"
    )
    if partitions:
        spark.catalog.recoverPartitions(table)
