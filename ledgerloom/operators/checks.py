"""Checks and reports of a load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.schemas import target_columns


class KeyViolation(ValueError):
    """A key that must be unique is not."""


class LoadMismatch(RuntimeError):
    """The target does not hold what the load wrote."""


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n``; counted before they are shuffled."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise if a key repeats or is already taken; null keys do not count as equal."""
    present = df.dropna(subset=keys)
    worst = duplicates(present, keys).take(3)
    if worst:
        raise KeyViolation(f"{', '.join(keys)} not unique, for example {worst}")


def id_stats(df: DataFrame, name: str = "id") -> DataFrame:
    """Lowest and highest id and how many rows have one."""
    return df.agg(F.min(name).alias("min_id"), F.max(name).alias("max_id"), F.count(name).alias("count_id"))


def row_count() -> Column:
    return F.count(F.lit(1))


def checksum(columns: list[str]) -> Column:
    """Order-free content sum of rows; 24 bits per row, so that 10^11 rows cannot overflow it."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    return F.coalesce(F.sum(F.shiftright(hashed, 40)), F.lit(0))


def schema_report(df: DataFrame, strict: bool = False) -> DataFrame:
    """One row per target column: position, name, type, and the rows of the table."""
    columns = [
        F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("column_name"), F.lit(kind).alias("target_type"))
        for i, (name, kind) in enumerate(target_columns(df.schema, strict), start=1)
    ]
    counted = df.agg(row_count().alias("row_count"))
    return counted.select(F.inline(F.array(*columns)), "row_count")


def sample_rows(df: DataFrame, order_by: str | None = None, n: int = 5) -> DataFrame:
    """A few rows to look at: the first by a column, or any."""
    return (df if order_by is None else df.orderBy(order_by)).limit(n)


def verify(target: DataFrame, rows: int, content: int | None, columns: list[str]) -> None:
    """Read the target back and raise unless rows and content are as written.

    Without a ``content`` only the rows are counted, which a database does on its own side.
    """
    measures = [row_count().alias("rows")]
    if content is not None:
        measures.append(checksum(columns).alias("content"))
    found = target.agg(*measures).first().asDict()
    expected = {"rows": rows} if content is None else {"rows": rows, "content": content}
    if found != expected:
        raise LoadMismatch(f"wrote {expected}, found {found}")
