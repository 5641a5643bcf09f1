"""Delimited text files: one file, or folders whose files need not share a header."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.names import clean_name
from ledgerloom.functions.values import separator_of_header, separator_of_lines

LINEAGE = "arquivo_origem"


def separator_for(path: str) -> str:
    """Separator of a delimited file, told by its path; see ``values.separator_of_path``."""
    lowered = path.lower()
    if lowered.endswith(".tsv"):
        return "\t"
    return "|" if "|" in path or "glassdoor" in lowered else ","


def sniff_separator(spark: SparkSession, path: str) -> str:
    """Separator of one file, told by its first line that is not blank, as the reader takes it."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    row = lines.limit(1).select(separator_of_header(F.col("value"))).first()
    return row[0] if row else ","


def vote_separator(spark: SparkSession, path: str, lines: int = 20) -> str:
    """Separator of one file, told by the fields of its first lines; see ``values.separator_of_lines``."""
    first = spark.read.text(path).where(F.trim("value") != "").limit(lines)
    # The lines of one task, in order.
    row = first.coalesce(1).agg(F.collect_list("value").alias("lines")).select(separator_of_lines(F.col("lines"))).first()
    return row[0]


def _reader(spark: SparkSession, sep: str, multi_line: bool, recursive: bool = False):
    # UTF-8, header row, quote and escape both the double quote.
    return (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", recursive)
    )


def header_of(spark: SparkSession, path: str, sep: str, multi_line: bool = False, recursive: bool = False) -> list[str]:
    """Column names of one file; reads its first line only."""
    return _reader(spark, sep, multi_line, recursive).csv(path).columns


def declared_schema(columns: list[str], types: dict[str, str]) -> str:
    """Schema to read a header with, by cleaned name; other columns are text, and so are decimals."""
    kinds = [types.get(clean_name(name), "string") for name in columns]
    read_as = ["string" if kind.startswith("decimal") else kind for kind in kinds]
    return ", ".join(f"`{name.replace('`', '``')}` {kind}" for name, kind in zip(columns, read_as))


def parse_decimals(scan: DataFrame, types: dict[str, str]) -> DataFrame:
    """Declared decimals from their text; anything but a plain number fails.

    The reader itself would drop commas, so that 1.234,56 came out as 1.23456.
    """
    parsed = {}
    for name in scan.columns:
        kind = types.get(clean_name(name), "string")
        if kind.startswith("decimal"):
            text = F.col(f"`{name}`")
            fault = F.raise_error(F.concat(F.lit(f"column {name}: not a {kind}: "), text)).cast(kind)
            parsed[name] = F.when(text.isNotNull(), F.coalesce(text.try_cast(kind), fault))
    return scan.withColumns(parsed) if parsed else scan


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str | None = None,
    types: dict[str, str] | None = None,
    multi_line: bool = False,
    lineage: bool = False,
    recursive: bool = False,
) -> DataFrame:
    """Scan delimited files that share one header.

    ``types`` maps cleaned column names to Spark types and spares the inference pass over the
    data; columns it leaves out are text. A value that does not fit its type fails the read: to
    divert such rows, read the column as text and use ``conform``. Without ``types`` all types are
    inferred in a pass of its own. A header that differs fails in either case. ``multi_line`` allows line breaks inside quotes and makes each file one task, so it is off by default.
    ``recursive`` takes in the files of subfolders, which then are no partitions.
    ``sep`` is a separator, None (told by the path), "sniff" (told by the first line) or "vote" (told by
    the number of fields in the first lines). ``sources.splitting`` reads large files with line
    breaks inside quotes by many tasks.
    """
    paths = [path] if isinstance(path, str) else path
    if sep == "sniff":
        sep = sniff_separator(spark, paths[0])
    elif sep == "vote":
        sep = vote_separator(spark, paths[0])
    elif sep is None:
        sep = separator_for(paths[0])
    reader = _reader(spark, sep, multi_line, recursive)
    if types is None:
        schema = reader.option("inferSchema", True).csv(paths).schema
        reader = _reader(spark, sep, multi_line, recursive)
    else:
        schema = declared_schema(header_of(spark, paths[0], sep, multi_line, recursive), types)
    # A file whose header differs must fail and not be read by position, and so must a row of
    # another number of fields.
    df = reader.option("enforceSchema", False).option("mode", "FAILFAST").schema(schema).csv(paths)
    if lineage:
        df = with_lineage(df)
    return df if types is None else parse_decimals(df, types)


def with_lineage(scan: DataFrame) -> DataFrame:
    """A file scan with the name of the file each row comes from."""
    return scan.select("*", F.col("_metadata.file_name").alias(LINEAGE))


def file_paths(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Paths of the files below ``folder``; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path")
    )


def _first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The first line that is not blank of each file that tasks can open, by one job."""

    def read(batches):
        import pyarrow as pa
        from pyarrow import fs

        def first(path: str) -> str | None:
            try:
                store, place = fs.FileSystem.from_uri(path.replace(" ", "%20"))
                with store.open_input_file(place) as file:
                    held = b""
                    while more := file.read(64 * 1024):
                        held += more
                        lines = held.split(b"\n")
                        line = next((x for x in lines[:-1] if x.strip(b" \r")), None)
                        if line is not None:
                            return line.decode("utf-8").rstrip("\r")
                    return next((x.decode("utf-8").rstrip("\r") for x in held.split(b"\n") if x.strip(b" \r")), "")
            except (OSError, ValueError, pa.ArrowException):
                return None

        for batch in batches:
            found = [first(path) for path in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["path", "line"])

    listed = spark.createDataFrame([(path,) for path in paths], "path string")
    tasks = min(len(paths), spark.sparkContext.defaultParallelism * 4)
    rows = listed.repartition(tasks).mapInArrow(read, "path string, line string").collect()
    return {row["path"]: row["line"] for row in rows if row["line"] is not None}


def headers_below(spark: SparkSession, folder: str) -> set[str]:
    """The distinct first lines of the files below a folder that tasks can open."""
    return set(_first_lines(spark, sorted(row.path for row in file_paths(spark, folder).collect())).values())


def read_folder(
    spark: SparkSession,
    folder: str,
    glob: str = "*.csv",
    sep: str | None = None,
    types: dict[str, str] | None = None,
    multi_line: bool = False,
    lineage: bool = False,
) -> DataFrame:
    """Union by column name of all files below ``folder``.

    Files are grouped by separator and header, each group is one scan. Columns that a group
    lacks are null, so a value never lands in a column of another name. The first lines of all files
    are read by one job, whose tasks open the files themselves and read no further; the driver has
    the list of files, which it needs for the scan, and looks at one file for each distinct first
    line. Files that tasks cannot open are looked at one by one.
    """
    paths = sorted(row.path for row in file_paths(spark, folder, glob).collect())
    if not paths:
        raise FileNotFoundError(f"no file matches {glob} in {folder}")
    first_lines = _first_lines(spark, paths)
    layouts: dict[tuple[str, str], tuple[str, tuple[str, ...]]] = {}
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for path in paths:
        line = first_lines.get(path)
        known = (line, separator_for(path))
        # A header may go on after a line break in quotes, so with ``multi_line`` the line tells little.
        if line is None or multi_line or known not in layouts:
            told = {"sniff": sniff_separator, "vote": vote_separator}.get(sep)
            found = told(spark, path) if told else sep or known[1]
            layouts[known] = found, tuple(header_of(spark, path, found, multi_line))
        groups.setdefault(layouts[known], []).append(path)
    scans = [
        read_delimited(spark, members, found, types, multi_line, lineage)
        for (found, _), members in groups.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
