"""Delimited files with line breaks in quotes, read by many tasks.

Whether a byte lies within quotes depends on all quotes before it, so such files are one task each
for Spark's own reader. Here a first pass counts the quotes of every range of bytes, a sum over the
ranges before tells whether a range begins within quotes, and in a second pass each range finds the
records that begin in it. Spark parses them as the text of one record each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.names import clean_name
from ledgerloom.session import stage
from ledgerloom.sources.delimited import declared_schema, header_of, parse_decimals, separator_for, vote_separator

RANGE_BYTES = 32 * 1024 * 1024
_PIECE = 1024 * 1024
_QUOTE, _BREAK = ord('"'), ord("\n")
_MARK = b"\xef\xbb\xbf"


class OpenQuote(ValueError):
    """A file ends within quotes, so it cannot be told where its records end."""


def _open(path: str):
    store, place = fs.FileSystem.from_uri(path.replace(" ", "%20"))
    return store.open_input_file(place)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of quotes in every range (path, start, stop)."""
    for batch in batches:
        counts = []
        for path, start, stop in zip(*(batch.column(i).to_pylist() for i in range(3))):
            with _open(path) as file:
                pieces = (file.read_at(min(_PIECE, stop - at), at) for at in range(start, stop, _PIECE))
                counts.append(sum(piece.count(b'"') for piece in pieces))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], ["path", "start", "stop", "quotes"])


def record_ends(data: bytes, inside: bool) -> tuple[np.ndarray, bool]:
    """The places of line breaks outside of quotes, and whether the end of ``data`` is inside."""
    seen = np.frombuffer(data, np.uint8)
    odd = (np.cumsum(seen == _QUOTE) + inside) & 1
    return np.flatnonzero((seen == _BREAK) & (odd == 0)), bool(odd[-1]) if len(seen) else inside


def records_of_range(file, start: int, stop: int, size: int, inside: bool, piece: int = _PIECE) -> Iterator[bytes]:
    """The records whose first byte is from ``start`` on and before ``stop``, without their line breaks.

    ``inside`` tells whether ``start`` is within quotes. A record that goes on beyond ``stop`` is read
    to its end, so only the record at hand is held.
    """
    # The byte before tells whether a record begins at the start itself.
    begins = start == 0 or not inside and file.read_at(1, start - 1) == b"\n"
    held, at = b"", start
    while at < size:
        data = file.read_at(min(piece, size - at), at)
        ends, inside = record_ends(data, inside)
        from_ = 0
        for end in ends.tolist():
            if begins:
                yield held + data[from_:end]
            held, begins, from_ = b"", at + end + 1 < stop, end + 1
            if not begins and at + from_ >= stop:
                return
        if begins:
            held += data[from_:]
        at += len(data)
        if not begins and at >= stop:
            return
    if begins and held:
        yield held


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, first, record) of every range (path, start, stop, size, inside); ``first`` marks a file's first record."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 3
        kinds = pa.string(), pa.bool_(), pa.string()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["path", "first", "record"])

    for batch in batches:
        for path, start, stop, size, inside in zip(*(batch.column(i).to_pylist() for i in range(5))):
            rows, held, first = [], 0, start == 0
            with _open(path) as file:
                for raw in records_of_range(file, start, stop, size, inside):
                    raw = raw.removeprefix(_MARK) if first else raw
                    record = raw.decode("utf-8").rstrip("\r")
                    # Blank lines are no records, as for Spark's reader.
                    if record.strip(" \t\r"):
                        rows.append((path, first, record))
                        held, first = held + len(raw), False
                    if held > _PIECE:
                        yield batch_of(rows)
                        rows, held = [], 0
            yield batch_of(rows)


def byte_ranges(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Ranges of the files' bytes: path, start, stop, size and whether the start is within quotes.

    Files that end within quotes raise ``OpenQuote``.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = listed.where("length > 0").select("path", F.col("length").alias("size"))
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(range_bytes).cast("bigint")))
    ranges = stage(files.select("path", "size", starts.alias("start")), "ranges")
    stop = F.least(F.col("start") + range_bytes, "size").alias("stop")
    tasks = max(1, ranges.count())
    counted = ranges.select("path", "start", stop).repartition(tasks, "path", "start").mapInArrow(
        _count, "path string, start bigint, stop bigint, quotes bigint"
    )
    counted = stage(counted, "quotes")
    open_ = counted.groupBy("path").agg(F.sum("quotes").alias("quotes")).where("quotes % 2 = 1").select("path").take(3)
    if open_:
        raise OpenQuote(f"quotes are not closed in {[r['path'] for r in open_]}")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before) % 2, F.lit(0)) == 1
    return stage(counted.withColumn("inside", inside).join(ranges, ["path", "start"]), "parities")


def read_split(
    spark: SparkSession,
    path: str | list[str],
    sep: str | None = None,
    types: dict[str, str] | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The rows of ``read_delimited(..., multi_line=True)``, a range of bytes a task instead of a file.

    Quotes must be in pairs, as they are in files whose quoted fields double them; a file that ends
    within quotes raises. A header that differs from that of the first file fails, and so does a row of
    another number of fields. Without ``types`` all columns are text. Tasks open the files themselves, so
    these must be in a store that they reach by its address (``file:``, ``hdfs:``, ``s3:``, ``gs:``).
    """
    ranges = byte_ranges(spark, path, range_bytes)
    first = path if isinstance(path, str) else path[0]
    if sep == "vote":
        sep = vote_separator(spark, first)
    sep = sep or separator_for(first)
    columns = header_of(spark, first, sep, multi_line=True)
    schema = declared_schema(columns, types or {})
    tasks = max(1, ranges.count())
    dealt = ranges.select("path", "start", "stop", "size", "inside").repartition(tasks, "path", "start")
    records = dealt.mapInArrow(_records, "path string, first boolean, record string")
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    names = ", ".join(f"`c{i}` string" for i in range(len(columns)))
    # A further column takes what a row has too much.
    header = F.from_csv("record", f"{names}, `more` string", {**options, "mode": "PERMISSIVE"})
    wanted = F.struct(*[F.lit(name).alias(f"c{i}") for i, name in enumerate(columns)])
    found = F.struct(*[header[f"c{i}"].alias(f"c{i}") for i in range(len(columns))])
    differs = F.raise_error(F.concat(F.lit("the header differs in "), F.col("path"))).cast("boolean")
    kept = F.when(F.col("first"), F.when(found == wanted, F.lit(False)).otherwise(differs)).otherwise(F.lit(True))
    parsed = records.where(kept).select(F.from_csv("record", schema, options).alias("row"))
    return parse_decimals(parsed.select("row.*"), {clean_name(k): v for k, v in (types or {}).items()})
