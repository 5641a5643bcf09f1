"""The load: read, clean, land once, check, write to the target, verify.

The source is read once. Cleaned rows land as Parquet in the shared folder, counted on the way;
ids, key checks and the write work on that landing, so the text is never parsed again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, fields
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.values import padded_key, plain_number
from ledgerloom.operators.checks import KeyViolation, LoadMismatch, assert_unique, checksum, row_count, verify
from ledgerloom.operators.columns import (
    PROCESSED,
    REJECTS,
    accepted,
    clean_columns,
    conform,
    drop_null_ids,
    left_out,
    load_time,
    rejected,
    with_audit,
    with_processing_time,
)
from ledgerloom.operators.ids import next_id, number_scan, rename_id
from ledgerloom.schemas import RENAMES, TABLES
from ledgerloom.session import discard, fresh_path, stage
from ledgerloom.sinks import key_index
from ledgerloom.sinks.tables import aligned, ensure_schema, ensure_table, is_database, write_table
from ledgerloom.sources.delimited import read_delimited, read_folder


class RejectedRows(ValueError):
    """Some rows do not fit the declared table, and no table for them was named."""


@dataclass(frozen=True)
class LoadSummary:
    """What a load did. Texts of several values are joined by commas; ``sample`` is a JSON array."""

    source: str
    target: str
    mode: str
    rows_in: int
    rows_dropped: int
    rows_rejected: int
    rows_written: int
    min_id: int | None
    max_id: int | None
    columns_in: int = 0
    columns_left_out: str = ""
    rows_held_before: int = 0
    target_columns: str = ""
    sample: str = "[]"
    #: Whether the rows were there from an earlier, interrupted run of the same load.
    resumed: bool = False
    #: Keys are checked by the load; the target itself does not enforce them.
    key: str = "checked, not enforced"

    def frame(self, spark: SparkSession) -> DataFrame:
        kinds = {"int": "bigint", "str": "string", "bool": "boolean"}
        schema = ", ".join(f"{f.name} {kinds[f.type.split(' ')[0]]}" for f in fields(self))
        return spark.createDataFrame([tuple(asdict(self).values())], schema)


def transform(
    df: DataFrame,
    at: datetime | None = None,
    key_columns: tuple[str, ...] = (),
    comma_columns: tuple[str, ...] = (),
    declared: str | None = None,
) -> tuple[DataFrame, bool]:
    """Id column found and renamed, names cleaned, audit columns set; tells if an id was found.

    ``key_columns`` are cleaned names of registration numbers, which get their leading zeros, and
    ``comma_columns`` those of texts like 1.234,56, which become 1234.56. With the name of a
    ``declared`` table the rows get its columns, see ``columns.conform``, and its time of
    processing instead of the audit columns.
    """
    named = rename_id(df)
    cleaned = clean_columns(df if named is None else named)
    cleaned = cleaned.withColumns({name: padded_key(F.col(name)) for name in key_columns})
    cleaned = cleaned.withColumns({name: plain_number(F.col(name)) for name in comma_columns})
    if declared is None:
        out = with_audit(cleaned, load_time(at))
    else:
        conformed = conform(cleaned, {**TABLES[declared], PROCESSED: "timestamp"}, RENAMES[declared])
        out = with_processing_time(conformed, load_time(at))
    return out, named is not None


def _land(df: DataFrame, has_id: bool, declared: str | None, path: str) -> tuple[DataFrame, dict[str, int]]:
    """The rows that have an id, or all where none was found, written once and counted on the way."""
    with_id = F.col("id").isNotNull() if has_id else F.lit(True)
    fits = F.size(REJECTS) == 0 if declared else F.lit(True)
    seen = Observation("seen")
    counted = df.observe(
        seen,
        row_count().alias("rows_in"),
        F.count_if(~with_id).alias("rows_dropped"),
        F.count_if(with_id & ~fits).alias("rows_rejected"),
    )
    landed = stage(drop_null_ids(counted) if has_id else counted, "landed", path)
    return landed, seen.get


def _assert_new_keys(rows: DataFrame, keys: list[str], held: DataFrame | None) -> None:
    """Raise if a key repeats among the rows or is held already."""
    assert_unique(rows, keys)
    if held is not None:
        taken = rows.select(*keys).join(held.select(*keys), keys, "left_semi").take(3)
        if taken:
            raise KeyViolation(f"{', '.join(keys)} already in the target, for example {taken}")


def _of_load(table: DataFrame, stamp: str, at: datetime) -> DataFrame:
    """The rows of one load. Row groups of other loads are passed over by their statistics."""
    return table.where(F.col(stamp) == F.lit(at))


def _found(rows: DataFrame, columns: list[str]) -> dict:
    counts = [row_count().alias("rows"), checksum(columns).alias("content")]
    return rows.agg(*counts, F.min("id").alias("min_id"), F.max("id").alias("max_id")).first().asDict()


def load_frame(
    df: DataFrame,
    target: str,
    mode: str | None = None,
    source: str = "",
    at: datetime | None = None,
    location: str | None = None,
    log_table: str | None = None,
    key_columns: tuple[str, ...] = (),
    comma_columns: tuple[str, ...] = (),
    unique: list[list[str]] | None = None,
    declared: str | None = None,
    rejects: str | None = None,
    partition_by: tuple[str, ...] = (),
    indexed: bool = False,
    on_written: Callable[[], None] | None = None,
) -> LoadSummary:
    """Load rows into a target table; see the module text for the steps.

    Without a ``mode`` an existing table is appended to and a new one filled. Rows with a null id
    are dropped and counted. Rows without an id column are numbered on from the ids the target
    has; given ids must be new and unique, and so must the keys named in ``unique``, or nothing is
    written. ``declared`` and the columns are those of ``transform``; rows that do not fit the
    declared table are appended to the table ``rejects``, or end the load if none is named.
    ``location`` is the folder for a schema made by this call, ``partition_by`` the partitions of a
    table made by it. The summary is also appended to ``log_table``, if named.

    ``at``, the time of the load, is in every row and is the key of the load. A load that was cut
    short is run again with the same ``at``: rows it has written already are verified and not
    written again, and so are its rejects, which come last.

    With ``indexed`` an append to a table outside databases opens only the files that may hold one of
    its keys, as the index beside the table tells (``sinks.key_index``); ids are numbered on from the
    index, and what was written is verified in the new files. ``on_written`` is called when the rows
    are in the target and before they are verified.
    """
    spark = df.sparkSession
    again = at is not None
    at = at or datetime.now().astimezone()
    shaped, has_id = transform(df, at, key_columns, comma_columns, declared)
    landing, fitting = fresh_path(spark, "landed"), fresh_path(spark, "fitting")
    landed, seen = _land(shaped, has_id, declared, landing)
    misfits = rejected(landed) if seen["rows_rejected"] else None
    if misfits is not None:
        if rejects is None:
            examples = [row[0] for row in misfits.select(REJECTS).take(3)]
            raise RejectedRows(f"{seen['rows_rejected']} rows do not fit {declared}, for example {examples}")
        landed = stage(accepted(landed), "fitting", fitting)
    landed = landed.drop(REJECTS)

    if "." in target:
        ensure_schema(spark, target.rpartition(".")[0], location)
    with_key = landed if has_id else landed.select(F.lit(1).cast("bigint").alias("id"), "*")
    existed = ensure_table(with_key, target, partition_by)
    # Rows may bring their own time of processing; then nothing in them tells the load.
    cleaned = clean_columns(df).columns
    stamp = "created_at" if declared is None else None if PROCESSED in cleaned else PROCESSED
    in_database = is_database(spark, target)
    columns = sorted(spark.table(target).columns)
    resumed = False
    if again and existed and stamp and not in_database:
        resumed = not _of_load(spark.table(target), stamp, at).isEmpty()
    mode = mode or ("append" if existed else "overwrite")
    adds = existed and mode == "append"
    keeps_index = indexed and not in_database
    indexed = keeps_index and adds and not resumed
    if indexed:
        held_before, first_id = key_index.indexed_facts(spark, target)
        files_before = key_index.table_files(spark, target)
    else:
        held_before = spark.table(target).count() if adds else 0
    if resumed:
        facts = _resumed(landed, _of_load(spark.table(target), stamp, at), target, has_id)
        held_before -= facts["rows"] if adds else 0
    else:
        for keys in [*(unique or []), *([["id"]] if has_id else [])]:
            if indexed:
                kinds = dict(spark.table(target).dtypes)
                typed = landed.select(*[F.col(name).cast(kinds[name.lower()]).alias(name) for name in keys])
                key_index.assert_new_keys(typed, target, keys)
            else:
                _assert_new_keys(landed, keys, spark.table(target) if adds else None)
        if indexed:
            start = first_id
        else:
            start = next_id(spark.table(target)) if adds and not has_id else 1
        rows = aligned(landed if has_id else number_scan(landed, start), target)
        written = Observation("written")
        counts = [row_count().alias("rows"), checksum(columns).alias("content")]
        bounds = [F.min("id").alias("min_id"), F.max("id").alias("max_id")]
        write_table(rows.observe(written, *counts, *bounds), target, mode)
        facts = written.get
        if on_written:
            on_written()
        held = spark.table(target)
        if in_database:
            # The content of a database table would have to come back over its connections; its rows
            # are counted on its own side.
            verify(held, held_before + facts["rows"], None, columns)
        else:
            if indexed:
                held = key_index.rows_of_files(spark, target, key_index.table_files(spark, target) - files_before)
            elif adds and stamp:
                held = _of_load(held, stamp, at)
            elif adds and has_id:
                held = held.join(rows.select("id"), "id", "left_semi")
            elif adds:
                held = held.where(F.col("id") >= start)
            verify(held, facts["rows"], facts["content"], columns)
    if keeps_index:
        key_index.update_index(spark, target, [*(unique or []), ["id"]])
    if misfits is not None:
        known = ensure_table(misfits, rejects)
        done = again and known and stamp and not _of_load(spark.table(rejects), stamp, at).isEmpty()
        if not done:
            write_table(misfits, rejects, "append")
    if indexed:
        own = held
    else:
        own = _of_load(spark.table(target), stamp, at) if stamp and not in_database else spark.table(target)
    sample = [row[0] for row in own.limit(5).select(F.to_json(F.struct("*"))).collect()]
    # After a failure the landing stays for a look at it.
    for path in (landing, fitting):
        discard(spark, path)

    summary = LoadSummary(
        source=source,
        target=target,
        mode=mode,
        rows_in=seen["rows_in"],
        rows_dropped=seen["rows_dropped"],
        rows_rejected=seen["rows_rejected"],
        rows_written=facts["rows"],
        min_id=facts["min_id"],
        max_id=facts["max_id"],
        columns_in=len(df.columns),
        columns_left_out=",".join(left_out(clean_columns(df), TABLES[declared], RENAMES[declared]) if declared else []),
        rows_held_before=held_before,
        target_columns=",".join(spark.table(target).columns),
        sample=f"[{','.join(sample)}]",
        resumed=resumed,
    )
    if log_table:
        log = summary.frame(spark)
        ensure_table(log, log_table)
        write_table(log, log_table, "append")
    return summary


def _resumed(landed: DataFrame, held: DataFrame, target: str, has_id: bool) -> dict:
    """Facts on the rows that an earlier run of the load has written, which must be those that it would write now."""
    columns = sorted(c for c in held.columns if has_id or c != "id")
    given = landed if has_id else landed.select(F.lit(1).cast("bigint").alias("id"), "*")
    wanted, found = _found(aligned(given, target), columns), _found(held, columns)
    if [wanted[k] for k in ("rows", "content")] != [found[k] for k in ("rows", "content")]:
        raise LoadMismatch(f"the load's time is taken by other rows: {found}, not {wanted}")
    return found


def load_files(
    spark: SparkSession,
    path: str,
    target: str,
    glob: str | None = None,
    sep: str | None = None,
    types: dict[str, str] | None = None,
    multi_line: bool = False,
    lineage: bool = False,
    **options,
) -> LoadSummary:
    """Load one delimited file, or with ``glob`` a folder of them, into a target table."""
    if glob is None:
        df = read_delimited(spark, path, sep, types, multi_line, lineage)
    else:
        df = read_folder(spark, path, glob, sep, types, multi_line, lineage)
    return load_frame(df, target, source=path, **options)
