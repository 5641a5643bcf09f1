"""Row ids: found by name, or dense 1..n in file order without bringing rows together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.names import clean_name, id_position, unused
from ledgerloom.session import stage

def rename_id(df: DataFrame) -> DataFrame | None:
    """``df`` with its id column named ``id``, or None if no column is named like an id."""
    at = id_position(df.columns)
    if at is None:
        return None
    # Another column that would be cleaned to the same name gives way.
    names = [unused("id_2", df.columns) if clean_name(name) == "id" else name for name in df.columns]
    names[at] = "id"
    return df.toDF(*names)


def number_scan(scan: DataFrame, start: int = 1, name: str = "id") -> DataFrame:
    """Dense ids over a plain Parquet scan: files in order, rows in order within each file.

    Parquet knows the position of every row in its file, so an id is the rows of all earlier
    files plus that position. Counting reads footers only, and no row changes its task. Ids do
    not depend on how the scan is split, so a retried or re-planned task gives the same ones.
    """
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    counts = scan.groupBy(path.alias("_file")).agg(F.count(F.lit(1)).alias("_rows"))
    # Files written by Spark are ordered by task number, others by path.
    file_name = F.element_at(F.split("_file", "/"), -1)
    task = F.regexp_extract(file_name, r"^part-(\d+)", 1).try_cast("int")
    # One row per file in this window: a list the driver holds anyway to plan the scan.
    earlier = Window.orderBy(task.asc_nulls_first(), "_file").rowsBetween(Window.unboundedPreceding, -1)
    key, offset, at = (unused(n, scan.columns) for n in ("_file_key", "_offset", "_row"))
    # A file is 16 bytes in the broadcast, some 13 MB for 100 TB in files of 128 MB. Two paths of one
    # hash would end the job and not give wrong ids.
    same = Window.partitionBy(F.xxhash64("_file"))
    clash = F.raise_error(F.lit("two files have the same hash")).cast("bigint")
    offsets = counts.select(
        F.when(F.count(F.lit(1)).over(same) > 1, clash).otherwise(F.xxhash64("_file")).alias(key),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(offset),
    )
    located = scan.select("*", F.xxhash64(path).alias(key), row.alias(at))
    numbered = F.col(offset) + F.col(at) + F.lit(start)
    return located.join(F.broadcast(offsets), key).select(numbered.cast("bigint").alias(name), *scan.columns)


def with_dense_id(df: DataFrame, start: int = 1, name: str = "id") -> DataFrame:
    """``df`` with ids ``start``, ``start + 1``, … in the order its rows arrive.

    The rows are written once before they are counted: an arbitrary plan may split or order its
    rows anew on each run, files do not.
    """
    return number_scan(stage(df, "numbered"), start, name)


def next_id(target: DataFrame, name: str = "id") -> int:
    """First id after those of an existing table."""
    highest = target.agg(F.max(name)).first()[0]
    return 1 if highest is None else highest + 1
