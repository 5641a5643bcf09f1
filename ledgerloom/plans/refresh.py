"""The consolidated table kept up to date: only years that new loads touch are worked out again.

Beside the result a table holds the totals of every load of complaints by year, so a year is the sum of
its loads and the complaints of earlier loads are not read again. Every step replaces whole
partitions, of a load and a year or of a year, and the time up to which loads are in the result is
written last: a call that was cut short is simply called again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.aggregate import index_type, merged_totals, named_totals
from ledgerloom.operators.columns import PROCESSED, load_time, with_audit
from ledgerloom.operators.ids import number_scan
from ledgerloom.plans.consolidate import INPUTS, RESULT, consolidate_yearly, raw_named
from ledgerloom.session import scratch, stage
from ledgerloom.sinks.key_index import indexed_facts, rows_of_files, update_ranges
from ledgerloom.sinks.tables import aligned, ensure_table, setting, side_by_side
from ledgerloom.sources.tables import read_tables

TOTALS, REFRESHES = f"{RESULT}__totals", f"{RESULT}__refreshes"
_STARTS = "created_at"
_REFRESHES = "up_to timestamp, reviewed timestamp, years array<int>, refreshed_at timestamp"


@dataclass(frozen=True)
class Refresh:
    """What a call did: the years worked out again (None is a year that is null), and of how many loads."""

    years: tuple[int | None, ...]
    loads: int
    rows_written: int


@contextmanager
def _replacing_partitions(spark: SparkSession) -> Iterator[None]:
    """Overwriting replaces the partitions that rows are written to and no others."""
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"), side_by_side(spark):
        yield


def _stamp(table: DataFrame) -> str:
    for name in (_STARTS, PROCESSED):
        if name in table.columns:
            return name
    raise ValueError(f"a table of loads has {_STARTS} or {PROCESSED}, not {table.columns}")


def _in(years: list[int | None]) -> Column:
    known = [y for y in years if y is not None]
    return F.col("ano").isin(known) | (F.col("ano").isNull() if None in years else F.lit(False))


def _loads_after(spark: SparkSession, table: str, stamp: str, since: int | None) -> DataFrame:
    """Rows of later loads; files whose ranges have none are not opened. Times are microseconds."""
    if since is None:
        return spark.table(table)
    later = update_ranges(spark, table, [stamp]).where(F.col("high_number") > F.lit(since))
    files = {r["file"] for r in later.select("file").collect()}
    return rows_of_files(spark, table, files).where(F.col(stamp) > F.timestamp_micros(F.lit(since)))


def _last_load(spark: SparkSession, table: str) -> int | None:
    """The time of the last load of a table, from the ranges of its files."""
    stamp = _stamp(spark.table(table))
    return update_ranges(spark, table, [stamp]).agg(F.max("high_number").cast("bigint")).first()[0]


def consolidate_refresh(spark: SparkSession, schema: str, best: bool = False, full: bool = False, at: datetime | None = None) -> Refresh:
    """Bring the result table of ``schema`` up to date; all rows are those of ``consolidate_tables``.

    New loads of complaints, told by their time of load, give new totals; the years in them are worked
    out again and replace their partitions, with ids numbered on. Where banks or reviews were
    loaded since, all years are, from the totals. A table that was overwritten instead of appended to
    has lost loads that are in the totals: ``full`` starts from nothing, as does the first call.

    Rows that bring a time of processing of their own cannot be told apart by load, so such a table
    wants ``created_at``.
    """
    complaints, banks, employees = read_tables(spark, [f"{schema}.{name}" for name in INPUTS])
    stamp = _stamp(complaints)
    result, totals, refreshes = (f"{schema}.{name}" for name in (RESULT, TOTALS, REFRESHES))
    average = index_type(raw_named(INPUTS[0], complaints))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {refreshes} ({_REFRESHES}) USING parquet")
    spark.catalog.refreshTable(refreshes)
    times = F.struct(F.unix_micros("up_to").alias("up_to"), F.unix_micros("reviewed").alias("reviewed"))
    last = spark.table(refreshes).agg(F.max_by(times, "refreshed_at").alias("last")).first()["last"]
    full = full or last is None
    if full:
        # First, so that a call that is cut short is not taken up from the middle.
        spark.sql(f"TRUNCATE TABLE {refreshes}")
    with scratch(spark):
        since = None if full else last["up_to"]
        new = raw_named(INPUTS[0], _loads_after(spark, f"{schema}.{INPUTS[0]}", stamp, since))
        # Totals by load: the time of load stands in for the number of the load.
        named = [c for c in new.columns if c != stamp]
        by_load = _by_load(new.select(*named, F.unix_micros(stamp).alias("load")))
        added = stage(by_load, "added")
        found = added.groupBy("ano").agg(F.collect_set("load").alias("loads")).collect()
        years = [r["ano"] for r in found]
        loads = {load for r in found for load in r["loads"]}
        up_to = max(loads, default=None)
        reviewed = max(filter(None, (_last_load(spark, f"{schema}.{name}") for name in INPUTS[1:])), default=None)
        existed = ensure_table(added, totals, ("ano", "load")) and not full
        if existed:
            spark.catalog.refreshTable(totals)
            if reviewed and (last["reviewed"] is None or reviewed > last["reviewed"]):
                years = [r["ano"] for r in spark.table(totals).select("ano").distinct().collect()]
        else:
            spark.sql(f"TRUNCATE TABLE {totals}")
        if not years:
            return Refresh((), 0, 0)
        with _replacing_partitions(spark):
            aligned(added, totals).write.insertInto(totals, overwrite=True)
        spark.catalog.refreshTable(totals)
        touched = spark.table(totals).where(_in(years)).drop("load", "id")
        yearly = stage(merged_totals(touched, average), "yearly")
        rows = consolidate_yearly(yearly, raw_named(INPUTS[1], banks), raw_named(INPUTS[2], employees), best)
        written = _replace_years(spark, rows, result, full, at)
    ordered = sorted(years, key=lambda year: (year is not None, year))
    micros = [F.timestamp_micros(F.lit(value).cast("bigint")) for value in (up_to or since, reviewed)]
    spark.range(1).select(*micros, F.array(*map(F.lit, ordered)).cast("array<int>"), F.current_timestamp()).write.insertInto(refreshes)
    return Refresh(tuple(ordered), len(loads), written)


def _by_load(complaints: DataFrame) -> DataFrame:
    """``named_totals`` of every load."""
    named = complaints.withColumn("cnpj_if", F.struct("cnpj_if", "load"))
    return named_totals(named).withColumn("load", F.col("cnpj_if.load")).withColumn("cnpj_if", F.col("cnpj_if.cnpj_if"))


def _replace_years(spark: SparkSession, rows: DataFrame, result: str, full: bool, at: datetime | None) -> int:
    """Write rows in place of those of their years; their ids go on from the highest one."""
    staged = stage(with_audit(rows, load_time(at)), "refreshed")
    with_id = staged.select(F.lit(1).cast("bigint").alias("id"), "*")
    existed = ensure_table(with_id, result, ("ano",))
    if existed and spark.catalog.listColumns(result)[-1].name != "ano":
        raise ValueError(f"{result} is not partitioned by ano")
    if full and existed:
        spark.sql(f"TRUNCATE TABLE {result}")
    start = indexed_facts(spark, result)[1] if existed else 1
    with _replacing_partitions(spark):
        aligned(number_scan(staged, start), result).write.insertInto(result, overwrite=True)
    spark.catalog.refreshTable(result)
    return staged.count()
