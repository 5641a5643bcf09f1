"""Names that are nearly the same, by edit distance, without comparing all of them.

Two names of which at most a quarter of the longer one's letters differ share pairs of letters. So
each name is looked up by the rarest of its pairs only, as many as it takes to meet every name that may
match, and what meets is compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.values import match_key
from ledgerloom.session import stage

#: Letters of 100 that two matching names have in common at least; names of any length share a pair from 75 on.
PERCENT = 80


def match_percent(a: Column, b: Column) -> Column:
    """100 less the share of edits in the longer name, rounded down; two empty names match fully."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 100).otherwise(F.floor(100 * (longer - F.levenshtein(a, b)) / longer)).cast("int")


def _pairs(names: DataFrame) -> DataFrame:
    """The pairs of letters of each name (key), each told apart by how often it was there before.

    A name of one letter has that letter, an empty one the empty text.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.length("key") - 1, F.lit(1)))
    listed = F.array_sort(F.transform(starts, lambda i: F.substring(F.col("key"), i, F.lit(2))))

    def numbered(held: Column) -> Column:
        # Equal pairs stand together once sorted; the number is the place within their run.
        return F.transform(held, lambda pair, i: F.concat(pair, F.lit("\0"), (i - F.array_position(held, pair) + 1).cast("string")))

    # As the element of an array the pairs are sorted once, and not again for each of them.
    told = F.get(F.transform(F.array(listed), numbered), F.lit(0))
    return names.select("key", F.explode(told).alias("pair"))


def _looked_up(names: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """The pairs by which each name is looked up: its rarest ones.

    A match within k edits of a name of n letters keeps n - 1 - 2 k of the pairs of the longer name,
    and k is at most its part of n. With so many in common, one is among the first of either.
    """
    edits = (100 - percent) / 100
    kept = F.greatest(F.ceil((1 - 2 * edits) * F.length("key") - 1e-9) - 1, F.lit(1))
    rare = (
        _pairs(names).join(counts, "pair").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "pair"))).alias("pairs"))
    )
    taken = F.slice("pairs", 1, F.greatest(F.size("pairs") - kept + 1, F.lit(1)).cast("int"))
    return rare.select("key", F.explode(taken).alias("taken")).select("key", F.col("taken.pair").alias("pair"))


def fuzzy_pairs(left: DataFrame, right: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All pairs (left_key, right_key, match_percent) of the names ``key`` of both that match so well.

    Both are distinct names. One pair of names is compared once, however many pairs of letters meet.
    """
    if not 75 <= percent <= 100:
        raise ValueError(f"percent must be from 75 to 100, not {percent}")
    both = left.select("key").unionByName(right.select("key")).distinct()
    counts = stage(_pairs(both).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    sides = [_looked_up(side, counts, percent).withColumnRenamed("key", name) for side, name in ((left, "left_key"), (right, "right_key"))]
    met = sides[0].join(sides[1], "pair")
    shorter, longer = F.least(F.length("left_key"), F.length("right_key")), F.greatest(F.length("left_key"), F.length("right_key"))
    candidates = met.where(100 * shorter >= percent * longer).select("left_key", "right_key").distinct()
    found = match_percent(F.col("left_key"), F.col("right_key"))
    return candidates.withColumn("match_percent", found).where(F.col("match_percent") >= percent)


def fuzzy_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, percent: int = PERCENT) -> DataFrame:
    """Rows of ``left`` with every row of ``right`` whose name matches well, and how well.

    Names are compared as in ``values.match_key``; null names match nothing and left rows without a
    match are left out. Columns of both sides must differ.
    """
    keyed = [
        df.withColumn(f"_{side}_key", match_key(F.col(f"`{on}`"))) for df, on, side in ((left, left_on, "left"), (right, right_on, "right"))
    ]
    names = [
        stage(df.select(F.col(f"_{side}_key").alias("key")).where("key is not null").distinct(), "names")
        for df, side in zip(keyed, ("left", "right"))
    ]
    found = stage(fuzzy_pairs(*names, percent), "matches")
    joined = keyed[0].join(found, F.col("_left_key") == F.col("left_key")).join(keyed[1], F.col("right_key") == F.col("_right_key"))
    return joined.drop("_left_key", "_right_key", "left_key", "right_key")
