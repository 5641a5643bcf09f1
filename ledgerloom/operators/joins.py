"""Left outer equi-join that stays parallel when one key holds much of the right side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.names import unused
from ledgerloom.session import stage

# Rows one key may have on the right before they are split over several tasks.
HOT_ROWS = 1_000_000
# Hot keys and parts of them up to which their lists are broadcast; more are joined by shuffle.
BROADCAST_KEYS = 200_000


def _kind(data_type: T.DataType) -> str:
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return "text"
    return "whole number" if isinstance(data_type, T.IntegralType) else data_type.simpleString()


def left_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``left`` with every matching row of ``right``; null keys match nothing.

    The names of the two sides must differ, the keys be of one kind; the right key is not in the
    result. Which join is used is left to Spark: it broadcasts by measured size and splits hot keys
    of the left side at run time. A left outer join cannot be split on its right side, so that one is
    counted first, and its hot keys, if there are any, are salted; the rows are the same either way.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    kinds = [_kind(df.schema[key].dataType) for df, key in ((left, left_key), (right, right_key))]
    if kinds[0] != kinds[1]:
        raise TypeError(f"{left_key} is {kinds[0]} and {right_key} is {kinds[1]}")
    keyed = right.where(F.col(right_key).isNotNull())
    hot = keyed.groupBy(right_key).count().where(F.col("count") > hot_rows)
    if not hot.isEmpty():
        return _salted_left_join(left, keyed, left_key, right_key, hot_rows)
    return left.join(keyed, F.col(left_key) == F.col(right_key), "left").drop(right_key)


def _small(listed: DataFrame) -> DataFrame:
    """A staged list of hot keys, to be broadcast if it is not too long."""
    return F.broadcast(listed) if listed.count() <= BROADCAST_KEYS else listed


def _salted_left_join(left, right, left_key, right_key, hot_rows):
    # A row's part follows from where it lies in the staged files. That spreads equal rows too, asks
    # nothing of the types of the columns and is the same when a task is run again.
    taken = [*left.columns, *right.columns]
    hot_key, parts, part, to_part, sent_key = (unused(n, taken) for n in ("_hot_key", "_parts", "_part", "_to_part", "_sent_key"))
    staged = stage(right, "right")
    hot = stage(
        staged.groupBy(F.col(right_key).alias(hot_key))
        .count()
        .where(F.col("count") > hot_rows)
        .select(hot_key, F.ceil(F.col("count") / hot_rows).alias(parts)),
        "hot",
    )
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    located = staged.select("*", place.alias(part))
    salted = located.join(_small(hot), F.col(right_key) == F.col(hot_key), "left").withColumn(
        part, F.coalesce(F.pmod(part, parts), F.lit(0))
    )
    # A left row goes to the parts that exist for its key, so it finds a match in each of them
    # and never shows up as unmatched beside its matches.
    existing = stage(
        salted.where(F.col(parts).isNotNull()).select(F.col(hot_key).alias(sent_key), F.col(part).alias(to_part)).distinct(),
        "parts",
    )
    sent = left.join(_small(existing), F.col(left_key) == F.col(sent_key), "left").drop(sent_key)
    same_part = F.coalesce(F.col(to_part), F.lit(0)) == F.col(part)
    joined = sent.join(salted.drop(hot_key, parts), (F.col(left_key) == F.col(right_key)) & same_part, "left")
    return joined.drop(right_key, to_part, part)
