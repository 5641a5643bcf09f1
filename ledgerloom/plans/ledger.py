"""Loads that may be called again, whatever became of the last call, without a time of load by hand.

A load is known by its target and its input: the paths, sizes and times of the files and how they are
read. A ledger table has a row for each state that it reached: ``begun``, ``written``, ``verified`` or
``abandoned``. Before a load begins the files of its tables are noted, so that files which an
interrupted call left behind are told from those of others and removed. A load counts from the one
ledger row on that says ``verified``; until then ``published`` does not show its rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators.columns import PROCESSED, clean_columns
from ledgerloom.plans.load import LoadSummary, load_frame
from ledgerloom.sinks.key_index import rows_of_files, table_files
from ledgerloom.sinks.tables import ensure_schema, is_database
from ledgerloom.sources.delimited import read_delimited, read_folder

BEGUN, WRITTEN, VERIFIED, ABANDONED = "begun", "written", "verified", "abandoned"
_LEDGER = "load_id string, target string, rejects string, state string, load_time timestamp, recorded_at timestamp, summary string"
_BEFORE = "load_id string, attempt timestamp, table_name string, file string"


class UnfinishedLoad(RuntimeError):
    """Another load of the same table was cut short and must be called again, or abandoned, first."""


def ledger_of(target: str) -> str:
    """The ledger of a table, in its schema."""
    return f"{target.rpartition('.')[0]}.load_ledger".lstrip(".")


def fingerprint(spark: SparkSession, path: str, target: str, **reading) -> str:
    """What a load is known by: its target and the paths, sizes and times of its files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if reading.get("glob"):
        files = files.option("pathGlobFilter", reading["glob"])
    facts = [F.xxhash64("path", "length", "modificationTime", F.lit(i)).cast("decimal(38,0)") for i in (0, 1)]
    # Sums, so that a list of files of any length is not brought together.
    found = files.load(path).agg(F.count(F.lit(1)), *map(F.sum, facts)).first()
    told = json.dumps([target, *map(str, found), sorted((k, str(v)) for k, v in reading.items())])
    return hashlib.sha256(told.encode()).hexdigest()


class Ledger:
    """The states of loads in one table, and beside it the files that tables had before."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self._spark, self.name = spark, name
        if "." in name:
            ensure_schema(spark, name.rpartition(".")[0])
        for table, columns in ((name, _LEDGER), (f"{name}__before", _BEFORE)):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")

    def states(self) -> DataFrame:
        """The last state of each load."""
        self._spark.catalog.refreshTable(self.name)
        # A second call may begin the same load anew, so the order is that of time.
        last = Window.partitionBy("load_id").orderBy(F.desc("recorded_at"))
        return self._spark.table(self.name).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")

    def record(self, load_id: str, target: str, rejects: str | None, state: str, at: datetime, summary: str = "") -> None:
        """One row, one file: it is there as a whole or not at all."""
        row = (load_id, target, rejects, state, at, datetime.now(timezone.utc), summary)
        self._spark.createDataFrame([row], _LEDGER).coalesce(1).write.insertInto(self.name)

    def begin(self, load_id: str, target: str, rejects: str | None, at: datetime) -> None:
        attempt = datetime.now(timezone.utc)
        for table in filter(None, (target, rejects)):
            files = table_files(self._spark, table) if self._spark.catalog.tableExists(table) else set()
            rows = [(load_id, attempt, table, path) for path in sorted(files)] + [(load_id, attempt, table, None)]
            self._spark.createDataFrame(rows, _BEFORE).write.insertInto(f"{self.name}__before")
        self.record(load_id, target, rejects, BEGUN, at)

    def files_before(self, load_id: str, table: str) -> set[str]:
        """The files that a table had when a load was begun last."""
        name = f"{self.name}__before"
        self._spark.catalog.refreshTable(name)
        own = self._spark.table(name).where((F.col("load_id") == load_id) & (F.col("table_name") == table))
        last = own.agg(F.max("attempt")).first()[0]
        return {r["file"] for r in own.where((F.col("attempt") == F.lit(last)) & F.col("file").isNotNull()).collect()} if last else set()

    def remove_leftovers(self, load_id: str, table: str | None) -> int:
        """Delete the files that a call of a load left in a table; how many there were."""
        if table is None or not self._spark.catalog.tableExists(table):
            return 0
        left = table_files(self._spark, table) - self.files_before(load_id, table)
        jvm, conf = self._spark.sparkContext._jvm, self._spark.sparkContext._jsc.hadoopConfiguration()
        for path in left:
            file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
            file.getFileSystem(conf).delete(file, False)
        self._spark.catalog.refreshTable(table)
        return len(left)

    def unfinished(self, target: str) -> list:
        return self.states().where((F.col("target") == target) & F.col("state").isin(BEGUN, WRITTEN)).collect()


def load_once(
    spark: SparkSession,
    path: str,
    target: str,
    ledger: str | None = None,
    glob: str | None = None,
    sep: str | None = None,
    types: dict[str, str] | None = None,
    multi_line: bool = False,
    lineage: bool = False,
    rejects: str | None = None,
    **options,
) -> LoadSummary:
    """``load_files`` that gives each row once however often it is called, also after it was cut short.

    A load that is verified is not done again; its summary comes back, marked as resumed. One that
    was written and not verified is verified and its rejects are written; one that was begun is done
    anew after what it left was removed. The time of load is that of the first call. Where rows bring
    their own time of processing nothing in them tells the load, and it is done anew as well.

    ``ledger`` is a table, in the schema of the target unless named. One load of a table runs at a
    time: while another one is unfinished this raises, see ``abandon``. Tables of databases, whose
    files are not seen, are refused.
    """
    def read() -> DataFrame:
        if glob is None:
            return read_delimited(spark, path, sep, types, multi_line, lineage)
        return read_folder(spark, path, glob, sep, types, multi_line, lineage)

    load_id = fingerprint(spark, path, target, glob=glob, sep=sep, types=types, mode=options.get("mode"))
    return load_known(spark, load_id, read, target, ledger, rejects, source=path, **options)


def load_known(
    spark: SparkSession,
    load_id: str,
    read: Callable[[], DataFrame],
    target: str,
    ledger: str | None = None,
    rejects: str | None = None,
    **options,
) -> LoadSummary:
    """``load_once`` for rows that ``load_id`` stands for; they are only read if there is work to do."""
    if is_database(spark, target):
        raise ValueError(f"{target} belongs to a database, which shows no files")
    book = Ledger(spark, ledger or ledger_of(target))
    known = book.states().where(F.col("load_id") == load_id).first()
    if known and known["state"] == VERIFIED:
        return LoadSummary(**{**json.loads(known["summary"]), "resumed": True})
    others = [r for r in book.unfinished(target) if r["load_id"] != load_id]
    if others:
        raise UnfinishedLoad(f"{target}: {others[0]['load_id']}, begun {others[0]['load_time']}")
    df = read()
    stamped = options.get("declared") is None or PROCESSED not in clean_columns(df).columns
    at = datetime.now(timezone.utc)
    if known and known["state"] in (BEGUN, WRITTEN):
        at = known["load_time"].astimezone(timezone.utc)
        if known["state"] == BEGUN or not stamped:
            book.remove_leftovers(load_id, target)
        book.remove_leftovers(load_id, rejects)
    if not (known and known["state"] == WRITTEN and stamped):
        book.begin(load_id, target, rejects, at)
    written = lambda: book.record(load_id, target, rejects, WRITTEN, at)
    summary = load_frame(df, target, at=at, rejects=rejects, on_written=written, **options)
    book.record(load_id, target, rejects, VERIFIED, at, json.dumps(asdict(summary)))
    return summary


def abandon(spark: SparkSession, ledger: str, load_id: str) -> int:
    """Give up a load that was cut short: remove what it left; how many files that were."""
    book = Ledger(spark, ledger)
    known = book.states().where(F.col("load_id") == load_id).first()
    if known is None or known["state"] not in (BEGUN, WRITTEN):
        raise ValueError(f"no unfinished load {load_id}")
    left = book.remove_leftovers(load_id, known["target"]) + book.remove_leftovers(load_id, known["rejects"])
    book.record(load_id, known["target"], known["rejects"], ABANDONED, known["load_time"])
    return left


def published(spark: SparkSession, target: str, ledger: str | None = None) -> DataFrame:
    """The rows of a table without those of a load that is not verified yet."""
    book = Ledger(spark, ledger or ledger_of(target))
    open_ = book.unfinished(target)
    spark.catalog.refreshTable(target)
    return rows_of_files(spark, target, book.files_before(open_[0]["load_id"], target)) if open_ else spark.table(target)
