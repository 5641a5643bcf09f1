"""An index of the keys in each file of a table, kept in two tables beside it.

``<table>__ranges`` has the lowest and highest value of every indexed column in every file,
``<table>__blooms`` a Bloom filter of every key in every file, as rows of 64 bits. An append asks these
which files may hold one of its keys and opens no others; the next id comes from the ranges.

The index follows the files: those that it does not know yet are read once and added, and those that
are gone are passed over. So it may be dropped, and a table may be written without it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, StringType, TimestampNTZType, TimestampType

from ledgerloom.operators.checks import KeyViolation, assert_unique

#: Bits of a filter for each key of a file, and hashes of a key.
BITS_PER_KEY, HASHES = 12, 4
#: Words of 64 bits that a filter has at most; beyond that it lets more keys pass and never misses one.
MOST_WORDS = 1 << 20
#: Keys times files up to which the filters are asked; beyond it all files of fitting ranges are opened.
MOST_TESTS = 10**10
_RANGES = (
    "column_name string, file string, n bigint, low_number decimal(38,0), high_number decimal(38,0), low_text string, high_text string"
)
_BLOOMS = "key_name string, file string, words int, word int, bits bigint"


def _label(keys: list[str]) -> str:
    return f"key {','.join(keys)}"


def _plain(path: str) -> str:
    return re.sub("^([a-z0-9]+):/+", r"\1:/", path)


def _file() -> Column:
    """The file of a row, as the index names it."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^([a-z0-9]+):/+", "$1:/")


def table_files(spark: SparkSession, table: str) -> set[str]:
    """The files of a table as it is now; their content is not read."""
    spark.catalog.refreshTable(table)
    return {_plain(path) for path in spark.table(table).inputFiles()}


def rows_of_files(spark: SparkSession, table: str, files: set[str]) -> DataFrame:
    """The rows of some files of a table; no other file is opened."""
    # Decided from the listing, before anything is read.
    return spark.table(table).where(_file().isin(sorted(files)) if files else F.lit(False))


def _ensure(spark: SparkSession, table: str) -> tuple[str, str]:
    names = f"{table}__ranges", f"{table}__blooms"
    for name, columns in zip(names, (_RANGES, _BLOOMS)):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
        spark.catalog.refreshTable(name)
    return names


def _numbered(df: DataFrame, name: str) -> Column | None:
    """A column as a whole number of the same order, if it has one."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, IntegralType) or isinstance(kind, DecimalType) and kind.scale == 0:
        return column.cast("decimal(38,0)")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("decimal(38,0)")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("decimal(38,0)")
    return None


def _bounds(df: DataFrame, name: str) -> list[Column]:
    """The lowest and highest number and text of a column; null where its type has no such order."""
    number, none = _numbered(df, name), F.lit(None)
    text = F.col(f"`{name}`") if isinstance(df.schema[name].dataType, StringType) else None
    number = none.cast("decimal(38,0)") if number is None else number
    text = none.cast("string") if text is None else text
    return [
        F.min(number).alias("low_number"),
        F.max(number).alias("high_number"),
        F.min(text).alias("low_text"),
        F.max(text).alias("high_text"),
    ]


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{name}`") for name in keys])


def _places(key_hash: Column, words: Column) -> Column:
    """Where the bits of a key are in a filter of so many words: its number, word and bit."""
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("number"),
                F.shiftright(at := F.pmod(F.xxhash64(key_hash, F.lit(i)), words.cast("bigint") * 64), 6).cast("int").alias("word"),
                F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int")).alias("bit"),
            )
            for i in range(HASHES)
        ]
    )


def _index_ranges(rows: DataFrame, name: str, into: str) -> None:
    found = rows.groupBy(_file().alias("_file")).agg(F.count(F.lit(1)).alias("n"), *_bounds(rows, name))
    found.select(F.lit(name), "_file", "n", "low_number", "high_number", "low_text", "high_text").write.insertInto(into)


def _index_blooms(rows: DataFrame, keys: list[str], into: str) -> None:
    hashed = rows.select(_file().alias("file"), *keys).dropna(subset=keys).select("file", _hash(keys).alias("key_hash"))
    wanted = F.ceil(F.log2(F.count(F.lit(1)) * BITS_PER_KEY / 64))
    words = F.least(F.pow(F.lit(2), F.greatest(wanted, F.lit(0))), F.lit(MOST_WORDS)).cast("int").alias("words")
    # A row for each new file.
    sized = hashed.join(F.broadcast(hashed.groupBy("file").agg(words)), "file")
    places = sized.select("file", "words", F.inline(_places(F.col("key_hash"), F.col("words"))))
    bits = places.groupBy("file", "words", "word").agg(F.bit_or("bit").alias("bits"))
    # Sorted, so that statistics lead to the rows of a file.
    ordered = bits.repartitionByRange("file", "word").sortWithinPartitions("file", "word")
    ordered.select(F.lit(_label(keys)), "file", "words", "word", "bits").write.insertInto(into)


def _known(spark: SparkSession, ranges: str, name: str) -> set[str]:
    return {r["file"] for r in spark.table(ranges).where(F.col("column_name") == name).select("file").distinct().collect()}


def _mark(spark: SparkSession, files: set[str], label: str, ranges: str) -> None:
    """Say that the filters of files are there as a whole."""
    marked = spark.createDataFrame([(label, path) for path in sorted(files)], "column_name string, file string")
    empty = [F.lit(None).cast(kind) for kind in ("bigint", "decimal(38,0)", "decimal(38,0)", "string", "string")]
    marked.select("column_name", "file", *empty).write.insertInto(ranges)


def update_ranges(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """The ranges of columns in the files that ``table`` has now; files new to the index are added."""
    ranges, _ = _ensure(spark, table)
    files = table_files(spark, table)
    for name in columns:
        if new := files - _known(spark, ranges, name):
            _index_ranges(rows_of_files(spark, table, new), name, ranges)
    return _of_files(spark, ranges, files).where(F.col("column_name").isin(columns))


def _of_files(spark: SparkSession, index: str, files: set[str]) -> DataFrame:
    spark.catalog.refreshTable(index)
    # A row for each file, which the driver lists for any scan of the table.
    now = spark.createDataFrame([(path,) for path in sorted(files)], "file string")
    return spark.table(index).join(F.broadcast(now), "file", "left_semi")


def update_index(spark: SparkSession, table: str, keys: list[list[str]]) -> tuple[DataFrame, DataFrame]:
    """The ranges and filters of the files that ``table`` has now; files new to the index are added."""
    ranges, blooms = _ensure(spark, table)
    files = table_files(spark, table)
    found = update_ranges(spark, table, list(dict.fromkeys(name for key in keys for name in key)))
    for key in keys:
        label = _label(key)
        if new := files - _known(spark, ranges, label):
            _index_blooms(rows_of_files(spark, table, new), key, blooms)
            # Only now: filters of a call that was cut short are not taken for whole.
            _mark(spark, new, label, ranges)
    return found, _of_files(spark, blooms, files)


def _fitting(ranges: DataFrame, rows: DataFrame, keys: list[str]) -> set[str]:
    """The files whose ranges meet those of the rows in every column of a key."""
    left = None
    for name in keys:
        low = rows.agg(*_bounds(rows, name)).first()
        own = ranges.where(F.col("column_name") == name)
        without = F.col("low_number").isNull() & F.col("low_text").isNull()
        if low["low_number"] is not None:
            meets = (F.col("low_number") <= F.lit(low["high_number"])) & (F.col("high_number") >= F.lit(low["low_number"]))
        elif low["low_text"] is not None:
            meets = (F.col("low_text") <= F.lit(low["high_text"])) & (F.col("high_text") >= F.lit(low["low_text"]))
        else:
            # Types without ranges; a column without values has no key to look for.
            meets = F.lit(not rows.where(F.col(f"`{name}`").isNotNull()).isEmpty())
        ordered = _numbered(rows, name) is not None or isinstance(rows.schema[name].dataType, StringType)
        wanted = meets if ordered else meets & without
        found = {r["file"] for r in own.where(wanted).select("file").collect()}
        left = found if left is None else left & found
    return left or set()


def files_that_may_hold(rows: DataFrame, table: str, keys: list[str]) -> set[str]:
    """The files of ``table`` that may hold one of the keys of ``rows``: all that do, and few others.

    ``rows`` has the columns in the types of the table; rows with a null in their key have none.
    """
    spark = rows.sparkSession
    ranges, blooms = update_index(spark, table, [keys])
    present = rows.select(*keys).dropna()
    files = _fitting(ranges, present, keys)
    if not files or present.count() * len(files) > MOST_TESTS:
        return files
    fitting = spark.createDataFrame([(path,) for path in sorted(files)], "file string")
    filters = blooms.where(F.col("key_name") == _label(keys)).join(F.broadcast(fitting), "file", "left_semi")
    hashed = present.select(_hash(keys).alias("key_hash")).distinct()
    # Filters come in a few sizes, powers of two; a key has its places in each of them.
    sizes = [r["words"] for r in filters.select("words").distinct().collect()]
    if not sizes:
        return set()
    by_size = hashed.select("key_hash", F.explode(F.array(*map(F.lit, sizes))).alias("words"))
    asked = by_size.select("key_hash", "words", F.inline(_places(F.col("key_hash"), F.col("words"))))
    met = asked.join(filters.select("file", "words", "word", "bits"), ["words", "word"])
    met = met.where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
    whole = met.groupBy("file", "key_hash").agg(F.count_distinct("number").alias("n")).where(F.col("n") == HASHES)
    return {r["file"] for r in whole.select("file").distinct().collect()}


def assert_new_keys(rows: DataFrame, table: str, keys: list[str]) -> set[str]:
    """Raise if a key repeats among the rows or is in the table; the files that were opened for that."""
    assert_unique(rows, keys)
    files = files_that_may_hold(rows, table, keys)
    if files:
        held = rows_of_files(rows.sparkSession, table, files).select(*keys)
        taken = rows.select(*keys).join(held, keys, "left_semi").take(3)
        if taken:
            raise KeyViolation(f"{', '.join(keys)} already in the target, for example {taken}")
    return files


def indexed_facts(spark: SparkSession, table: str, name: str = "id") -> tuple[int, int]:
    """How many rows a table has and the first whole number after those of a column, from the index."""
    by_file = update_ranges(spark, table, [name]).groupBy("file").agg(F.max("n").alias("n"), F.max("high_number").alias("high"))
    found = by_file.agg(F.sum("n").alias("n"), F.max("high").alias("high")).first()
    return found["n"] or 0, int(found["high"] or 0) + 1
