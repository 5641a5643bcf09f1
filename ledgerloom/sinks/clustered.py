"""Tables whose files hold neighbouring keys, so that a lookup opens few of them.

Rows are ordered by a curve through the space of the key columns that keeps near keys near in all of
them: each column is cut at its quantiles, and the bits of the cells' numbers are interleaved. Files
follow the curve, their ranges are kept in the index beside the table (``sinks.key_index``), and
Parquet's own Bloom filters serve lookups within a file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, NumericType, StringType

from ledgerloom.functions.names import unused
from ledgerloom.sinks.key_index import rows_of_files, update_ranges
from ledgerloom.sinks.tables import aligned

#: Bits of a column's cell number.
BITS = 7
_ACCURACY = 10_000


def _ordinal(df: DataFrame, name: str) -> Column:
    """A number in the order of a column; for texts that of their first bytes."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (StringType, BinaryType)):
        first = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0")
        return F.conv(first, 16, 10).cast("double")
    if isinstance(kind, NumericType):
        return column.cast("double")
    if kind.simpleString() == "date":
        return F.unix_date(column).cast("double")
    if kind.simpleString().startswith("timestamp"):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("int").cast("double")


def with_curve(df: DataFrame, by: tuple[str, ...], name: str, bits: int = BITS) -> DataFrame:
    """``df`` with the place of each row on the curve; nulls are in the first cell of their column.

    The quantiles are worked out over all rows, and 2^bits numbers a column come to the driver.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(_ordinal(df, column), shares, _ACCURACY).alias(f"c{i}") for i, column in enumerate(by)]).first()

    def cell(at: int) -> Column:
        value, own = _ordinal(df, by[at]), F.array(*map(F.lit, sorted(set(cuts[at] or [0.0]))))
        return F.coalesce(F.size(F.filter(own, lambda cut: cut < value)), F.lit(0))

    held = unused("_cells", df.columns)
    places = [
        F.call_function("shiftleft", F.shiftright(F.get(held, F.lit(at)), bit).bitwiseAND(F.lit(1)).cast("bigint"), F.lit(bit * len(by) + at))
        for at in range(len(by))
        for bit in range(bits)
    ]
    return df.withColumn(held, F.array(*map(cell, range(len(by))))).withColumn(name, reduce(lambda a, b: a.bitwiseOR(b), places)).drop(held)


def ensure_clustered_table(df: DataFrame, table: str, lookups: tuple[str, ...]) -> bool:
    """Create the table if missing, with Bloom filters in its files for ``lookups``; whether it was there."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        return True
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    options = ", ".join(f"'parquet.bloom.filter.enabled#{name}' 'true'" for name in lookups)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet" + (f" OPTIONS ({options})" if options else ""))
    return False


def write_clustered(
    df: DataFrame, table: str, by: tuple[str, ...], files: int, lookups: tuple[str, ...] = (), mode: str = "append"
) -> None:
    """Write rows into ``files`` files along the curve of the columns ``by``, and index the files' ranges.

    ``df`` is read three times. Rows of one key go to several files where there are very many. Every
    append is a curve of its own; write with ``mode`` overwrite, from a copy, to join them.
    """
    spark = df.sparkSession
    ensure_clustered_table(df, table, lookups)
    place = unused("_place", df.columns)
    placed = with_curve(df, by, place)
    # After the curve come the keys themselves, and for rows of one key their content.
    order = [F.col(place), *[F.col(f"`{name}`") for name in by], F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    sorted_ = placed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop(place)
    aligned(sorted_, table).write.insertInto(table, overwrite=mode == "overwrite")
    update_ranges(spark, table, list(by))


def files_of(spark: SparkSession, table: str, values: dict[str, object]) -> set[str]:
    """The files whose ranges hold all of the ``values``, by column."""
    found = None
    ranges = update_ranges(spark, table, list(values))
    for name, value in values.items():
        kind = spark.table(table).schema[name].dataType
        wanted = F.lit(value).cast(kind)
        number = F.lit(value).cast("decimal(38,0)") if kind.simpleString() in ("tinyint", "smallint", "int", "bigint") else None
        if number is not None:
            holds = (F.col("low_number") <= number) & (F.col("high_number") >= number)
        elif isinstance(kind, StringType):
            holds = (F.col("low_text") <= wanted) & (F.col("high_text") >= wanted)
        else:
            holds = F.lit(True)
        own = {r["file"] for r in ranges.where((F.col("column_name") == name) & holds).select("file").collect()}
        found = own if found is None else found & own
    return found or set()


def lookup(spark: SparkSession, table: str, **values) -> DataFrame:
    """The rows with these values; files whose ranges leave them out are not opened."""
    same = reduce(lambda a, b: a & b, [F.col(f"`{name}`") == F.lit(value) for name, value in values.items()])
    return rows_of_files(spark, table, files_of(spark, table, values)).where(same)
