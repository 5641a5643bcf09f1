"""The load of a folder that keeps getting files: each call loads the files not loaded before."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.columns import drop_null_ids
from ledgerloom.plans.ledger import load_known
from ledgerloom.plans.load import LoadSummary, transform
from ledgerloom.sources.delimited import declared_schema, parse_decimals, separator_for


def _new_files(spark: SparkSession, folder: str, columns: list[str], types: dict[str, str], sep: str | None, per_batch: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.schema(declared_schema(columns, types))
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("sep", sep or separator_for(folder))
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", True)
    )
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).csv(folder)


def load_new_into_table(
    spark: SparkSession,
    folder: str,
    target: str,
    columns: list[str],
    types: dict[str, str],
    progress: str,
    sep: str | None = None,
    files_per_batch: int | None = None,
    **options,
) -> list[LoadSummary]:
    """Load the new files below ``folder`` into a table, each file once; the summaries of the batches.

    Every batch is a load of its own with all that ``load_frame`` offers: ids are numbered on, declared
    tables divert what does not fit, keys are checked. ``progress`` is a folder that keeps which
    files are done. A batch is known to the ledger of the target by that folder and its number, so one
    that was cut short is taken up again, and one that the stream repeats is not loaded twice.
    """
    done: list[LoadSummary] = []

    def load(batch: DataFrame, number: int) -> None:
        read = lambda: parse_decimals(batch, types)
        done.append(load_known(batch.sparkSession, f"{progress} {number}", read, target, source=f"{folder} {number}", **options))

    scan = _new_files(spark, folder, columns, types, sep, files_per_batch)
    query = scan.writeStream.trigger(availableNow=True).option("checkpointLocation", progress).foreachBatch(load).start()
    query.awaitTermination()
    return done


def load_new_files(
    spark: SparkSession,
    folder: str,
    target: str,
    columns: list[str],
    types: dict[str, str],
    sep: str | None = None,
    at: datetime | None = None,
) -> dict[str, int]:
    """Append the new files below ``folder`` to the Parquet folder ``target``, each file once.

    The steps are those of a load. As files are handled on their own, they must share the header
    ``columns`` and bring their id column; ids cannot be numbered on. Which files are done is kept
    beside the target, and a call that was cut short is taken up again by the next one.
    Returns how many rows were read and how many of them dropped for want of an id.
    """
    scan = _new_files(spark, folder, columns, types, sep)
    cleaned, has_id = transform(parse_decimals(scan, types), at)
    if not has_id:
        raise ValueError(f"no id column among {columns}")
    counted = cleaned.observe("seen", F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("id").isNull()).alias("rows_dropped"))
    query = (
        drop_null_ids(counted)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{target}/_progress")
        .format("parquet")
        .start(target)
    )
    query.awaitTermination()
    seen = [progress.observedMetrics["seen"] for progress in query.recentProgress if "seen" in progress.observedMetrics]
    return {name: sum(metrics[name] or 0 for metrics in seen) for name in ("rows_in", "rows_dropped")}
