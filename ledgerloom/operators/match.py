"""Join on "this name contains that name", without comparing every pair of names.

A contained name starts somewhere inside the other one. If the searched names are few enough to be
broadcast, every task looks for them in the names it has, by hashes of what begins at each place,
and a name comes out with the list of what it contains: one row, whatever was found.

Else the positions of a name whose next few characters begin some searched name are found with a
hash join, the candidate text is cut there in the lengths those searched names have, and a second
hash join keeps the candidates that are searched names. Both steps are equi-joins.

Both ways are exact: nothing is compared pairwise, also not among names that begin alike. Names go
on under a key of 128 bits and not as texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.names import unused
from ledgerloom.functions.values import match_key
from ledgerloom.operators.joins import HOT_ROWS, left_join
from ledgerloom.session import stage
from ledgerloom.shipping import ship

# Lengths of the beginnings that are looked up; a needle uses the longest that it has.
SEED_SIZES = (1, 2, 4, 8, 16)
# Characters of a name that one piece of it starts from, in the first and in the second cut.
PIECES = (16_384, 128)
# Characters that a task searches at once.
SEARCHED = 1 << 18
# Estimated bytes up to which the searched names, and the rows that have them, are broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_BYTES = 64


def _seed_size(length: Column) -> Column:
    size = F.lit(SEED_SIZES[0])
    for step in SEED_SIZES[1:]:
        size = F.when(length >= step, step).otherwise(size)
    return size


def _cut(texts: DataFrame, size: int, overlap: int) -> DataFrame:
    """Pieces of ``texts`` (key, text, starts): all starts of a piece lie in its first ``size`` characters."""
    at = F.explode(F.sequence(F.lit(1), F.col("starts"), F.lit(size))).alias("at")
    return texts.where("starts > 0").select("key", "text", "starts", at).select(
        "key",
        F.col("text").substr(F.col("at"), F.lit(size + overlap)).alias("text"),
        F.least(F.lit(size), F.col("starts") - F.col("at") + 1).alias("starts"),
    )


def _name_key(name: Column) -> Column:
    return F.unhex(F.md5(name))


def containing_pairs(names: DataFrame, needles: DataFrame) -> DataFrame:
    """Distinct pairs (key, needle) where the name of that key contains the needle as a plain substring.

    ``names`` has a column ``name`` and ``needles`` a column ``needle``, both distinct and not
    null. An empty needle is contained in every name. A name of n characters has at most
    n (n + 1) / 2 + 1 needles, whatever their number. Names are cut into short pieces that overlap
    by the longest needle, so long names spread over tasks and no position carries its name along.
    """
    # Staged, since it is read three times.
    needles = stage(needles, "needles")
    length = F.length("needle")
    blank = F.col("needle") == ""
    facts = needles.agg(
        F.coalesce(F.bool_or(blank), F.lit(False)).alias("has_blank"),
        F.coalesce(F.max(length), F.lit(0)).alias("longest"),
        F.collect_set(F.when(~blank, _seed_size(length))).alias("seed_sizes"),
    ).first()
    solid = needles.where(~blank)
    seeds = solid.select(F.col("needle").substr(F.lit(1), _seed_size(length)).alias("seed"), length.alias("span")).distinct()
    keyed = names.select(_name_key(F.col("name")).alias("key"), "name")
    blanks = keyed.select("key", F.lit("").alias("needle"))
    pairs = blanks.where(F.lit(False))
    if facts["seed_sizes"]:
        overlap = facts["longest"] - 1
        whole = keyed.select("key", F.col("name").alias("text"), F.length("name").alias("starts"))
        # Twice, so that neither step copies a long name for every small piece.
        pieces = _cut(_cut(whole, PIECES[0], overlap), PIECES[1], overlap).repartition("key", "text")
        at = F.col("at")
        starts = pieces.select("key", "text", F.explode(F.sequence(F.lit(1), F.col("starts"))).alias("at"))
        # Texts of different sizes differ, so one join on the text serves all seed sizes.
        looked_up = [F.col("text").substr(at, F.lit(size)) for size in sorted(facts["seed_sizes"])]
        spots = starts.select("key", "text", "at", F.explode(F.array_distinct(F.array(*looked_up))).alias("seed"))
        pairs = (
            spots.join(seeds, "seed")
            .where(at + F.col("span") - 1 <= F.length("text"))
            .select("key", F.col("text").substr(at, F.col("span")).alias("needle"))
            .join(solid, "needle", "left_semi")
            .select("key", "needle")
            .distinct()
        )
    return pairs.unionByName(blanks) if facts["has_blank"] else pairs


def finder(needles: list[str], searched: int) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """A function that finds for texts what of ``needles`` they contain: numbers of texts and of needles.

    Needles of up to three characters are looked up as one whole number, exactly. Of longer ones the
    beginnings are looked up by hashes of 64 bits at every place, then the lengths that needles of
    this size have, and what passes is looked up as text. ``searched`` characters are held at once.
    """
    u = np.uint64
    ids = {needle: number for number, needle in enumerate(needles)}
    by_length: dict[int, list[str]] = {}
    for needle in ids:
        if needle:
            by_length.setdefault(len(needle), []).append(needle)
    longest = max(by_length, default=0)
    base, spread = 0x9E3779B97F4A7C15, u(0xD6E8FEB86659FD93)
    room = 2 * searched + longest
    powers = np.cumprod(np.r_[u(1), np.full(room, base, np.uint64)])
    inverses = np.cumprod(np.r_[u(1), np.full(room, pow(base, -1, 2**64), np.uint64)])
    shift = u(64 - min(24, max(16, (16 * len(ids)).bit_length())))

    def points(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)

    def slots(hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ (hashes >> u(32))) * spread) >> shift

    def marked(texts: list[str]) -> np.ndarray:
        """Where the hashes of texts, all of one length, fall."""
        table = np.zeros(1 << (64 - int(shift)), bool)
        rows = points("".join(texts)).reshape(len(texts), -1) + u(1)
        table[slots((rows * powers[: rows.shape[1]]).sum(1, dtype=np.uint64))] = True
        return table

    def joined(held: np.ndarray, length: int) -> np.ndarray:
        """Up to three characters from every place on as one number."""
        out = held[: len(held) - length + 1].copy()
        for step in range(1, length):
            out |= held[step : len(held) - length + 1 + step] << u(21 * step)
        return out

    short = []
    for length in range(1, 4):
        whole = sorted((int(joined(points(n), length)[0]), ids[n]) for n in by_length.get(length, ()))
        if whole:
            short.append((length, np.array([w for w, _ in whole], np.uint64), np.array([i for _, i in whole])))
    long = []
    for size, beyond in ((4, 8), (8, 16), (16, longest + 1)):
        lengths = sorted(n for n in by_length if size <= n < beyond)
        if lengths:
            seeds = marked(list({needle[:size] for n in lengths for needle in by_length[n]}))
            long.append((size, seeds, [(n, marked(by_length[n])) for n in lengths]))

    def distinct(codes: np.ndarray, size: int) -> np.ndarray:
        if size > 1 << 24:
            return np.unique(codes)
        seen = np.zeros(size, bool)
        seen[codes] = True
        return np.flatnonzero(seen)

    def search(pieces: list[str], owners: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        text = "".join(pieces)
        held = points(text)
        lengths = np.array([len(piece) for piece in pieces])
        piece = np.repeat(np.arange(len(pieces)), lengths)
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(held))
        owner = np.array(owners)
        for length, whole, numbers in short:
            if len(held) < length:
                continue
            values = joined(held, length)
            place = np.minimum(np.searchsorted(whole, values), len(whole) - 1)
            at = np.flatnonzero((whole[place] == values) & (left[: len(values)] >= length))
            found = distinct(piece[at] * len(whole) + place[at], len(pieces) * len(whole))
            yield owner[found // len(whole)], numbers[found % len(whole)]
        sums = np.r_[u(0), np.cumsum((held + u(1)) * powers[: len(held)])]

        def passing(at: np.ndarray, length: int, table: np.ndarray) -> np.ndarray:
            at = at[left[at] >= length]
            return at[table[slots((sums[at + length] - sums[at]) * inverses[at])]]

        for size, seeds, classes in long:
            begun = passing(np.arange(len(held)), size, seeds)
            for length, table in classes:
                at = passing(begun, length, table)
                numbers = np.array([ids.get(text[i : i + length], -1) for i in at.tolist()], np.int64)
                known = numbers >= 0
                yield owner[piece[at[known]]], numbers[known]

    def find(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        if "" in ids:
            found.append((np.arange(len(texts)), np.full(len(texts), ids[""])))
        pieces, owners, count = [], [], 0
        for number, text in enumerate(texts):
            for at in range(0, len(text), searched):
                pieces.append(text[at : at + searched + longest - 1] if longest else "")
                owners.append(number)
                count += len(pieces[-1])
                if count >= searched:
                    found += search(pieces, owners)
                    pieces, owners, count = [], [], 0
        if count:
            found += search(pieces, owners)
        codes = np.unique(np.concatenate([of * len(ids) + number for of, number in found]))
        return codes // len(ids), codes % len(ids)

    return find


def _found(batches: Iterator[pa.RecordBatch], listed, searched: int) -> Iterator[pa.RecordBatch]:
    find = None
    for batch in batches:
        find = find or finder(listed.value.to_pylist(), searched)
        names = batch.column(1).dictionary_encode()
        of, numbers = find(names.dictionary.to_pylist())
        ends = np.cumsum(np.bincount(of, minlength=len(names.dictionary)))
        hits = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(numbers, pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), hits.take(names.indices)], ["key", "hits"])


def _contained(names: DataFrame, needles: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """Names (key, hits) that contain needles, one row each, and the needles (needle, number).

    ``names`` has a column ``name`` without nulls, which may repeat. The numbers follow the order of
    ``longest_substring_join``. Names longer than a piece are cut, and these pieces are shuffled.
    """
    spark = names.sparkSession
    ship(spark)
    listed = needles.orderBy(-F.length("needle"), "needle").toArrow()["needle"].combine_chunks().cast(pa.string())
    numbered = spark.createDataFrame(pa.table({"needle": listed, "number": pa.array(range(len(listed)), pa.int32())}))
    shared = spark.sparkContext.broadcast(listed)
    searched = SEARCHED

    def hits(texts: DataFrame) -> DataFrame:
        found = texts.mapInArrow(lambda batches: _found(batches, shared, searched), "key binary, hits array<int>")
        return found.where(F.size("hits") > 0).distinct()

    whole = names.select(_name_key(F.col("name")).alias("key"), F.col("name").alias("text"), F.length("name").alias("starts"))
    pieces = _cut(whole.where(F.col("starts") > PIECES[0]), PIECES[0], max(longest, 1) - 1).repartition("key", "text")
    of_long = hits(pieces.select("key", "text")).groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"))
    of_short = hits(whole.where(F.col("starts") <= PIECES[0]).select("key", "text"))
    return stage(of_short.unionByName(of_long), "hits"), numbered


def _facts(keyed: DataFrame, needle: str):
    """Of the right rows with their needles: estimated bytes, those of the needles, the longest."""
    row = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in keyed.columns])))
    per_needle = keyed.where(F.col(needle).isNotNull()).groupBy(needle).agg(F.sum(row + _ROW_BYTES).alias("rows"))
    length = F.length(needle)
    return per_needle.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(needle) + _ROW_BYTES), F.lit(0)).alias("needles"),
        F.coalesce(F.max(length), F.lit(0)).alias("longest"),
    ).first()


def _keys(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(match_key(F.col(column)).alias(name)).where(F.col(name).isNotNull())


def _left_key(df: DataFrame, column: str) -> Column:
    """The name to match. Rows without one, which match nothing, get keys of their own that no name
    has, so that they do not meet in one task."""
    nothing = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if _hashable(df, c)]), F.lit(10_007)))
    return F.coalesce(match_key(F.col(column)), nothing)


def _hashable(df: DataFrame, column: str) -> bool:
    return "map<" not in df.schema[column].dataType.simpleString()


def substring_join(
    left: DataFrame,
    right: DataFrame,
    left_name: str,
    right_name: str,
    names: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left outer join where the left name contains the right name.

    Names are compared trimmed of blanks and in upper case, as substrings and not as words, with
    accents. A blank right name matches every left name; null matches nothing. All matches are
    kept. Matching runs on the distinct names: if ``left`` is more than a scan, pass as ``names``
    a scan or staged table that has the same left names, so that they are not worked out twice.
    Right rows that fit a broadcast are put beside the left ones last, and the left rows move with a
    list of needles; else the matches are joined with the right rows first. The left rows move once.
    """
    names = left if names is None else names
    taken = [*left.columns, *right.columns]
    name, right_needle, matched, hits, number, own = (
        unused(n, taken) for n in ("_name", "_right_needle", "_matched", "_hits", "_number", "_own")
    )
    # Staged, for it is read several times.
    keyed = stage(right.withColumn(right_needle, match_key(F.col(right_name))), "needles")
    facts = _facts(keyed, right_needle)
    needles = keyed.where(F.col(right_needle).isNotNull()).select(F.col(right_needle).alias("needle")).distinct()
    sought = left.withColumn(name, _name_key(_left_key(left, left_name)))
    if facts["needles"] <= broadcast_bytes:
        found, numbered = _contained(_keys(names, left_name, "name"), needles, facts["longest"])
    if facts["rows"] <= broadcast_bytes:
        # A name moves with the list of its needles, and the rows of these are put beside it where it is.
        rows = keyed.join(numbered.withColumnsRenamed({"number": own}), F.col(right_needle) == F.col("needle"))
        found = found.withColumnsRenamed({"key": matched, "hits": hits})
        listed = sought.join(found, F.col(name) == F.col(matched), "left").drop(name, matched)
        spread = listed.select(*[F.col(f"`{c}`") for c in left.columns], F.explode_outer(hits).alias(number))
        rows = stage(rows.select(*[F.col(f"`{c}`") for c in right.columns], own), "rows")
        return spread.join(F.broadcast(rows), F.col(number) == F.col(own), "left").drop(number, own)
    if facts["needles"] <= broadcast_bytes:
        numbers = found.select("key", F.explode("hits").alias("number"))
        pairs = numbers.join(F.broadcast(numbered), "number").select("key", "needle")
    else:
        pairs = containing_pairs(_keys(names, left_name, "name").distinct(), needles)
    needle = unused("_needle", taken)
    pairs = pairs.withColumnsRenamed({"key": matched, "needle": needle})
    # Written once: its size on disk then tells Spark whether to broadcast it, and a lost
    # executor does not start the matching anew.
    matches = stage(pairs.join(keyed, F.col(needle) == F.col(right_needle)).drop(needle, right_needle), "matches")
    return left_join(sought, matches, name, matched, hot_rows).drop(name)


def longest_substring_join(
    left: DataFrame,
    right: DataFrame,
    left_name: str,
    right_name: str,
    names: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``substring_join`` with one match per left row: the longest name.

    Among equally long names the first in order counts, among its rows the first by the right
    name as written and then by the other columns. Both choices are aggregates over names and
    over right rows, so matches are never multiplied out and then thrown away.
    """
    names = left if names is None else names
    taken = [*left.columns, *right.columns]
    name, needle, matched, row = (unused(n, taken) for n in ("_name", "_needle", "_matched", "_row"))
    needles = stage(_keys(right, right_name, "needle").distinct(), "needles")
    facts = _facts(needles, "needle")
    if facts["needles"] <= broadcast_bytes:
        found, numbered = _contained(_keys(names, left_name, "name"), needles, facts["longest"])
        # The numbers are in the order that counts.
        longest = found.select(F.col("key").alias(matched), F.array_min("hits").alias("number"))
        longest = longest.join(F.broadcast(numbered), "number").select(matched, F.col("needle").alias(needle))
    else:
        order = F.struct((-F.length("needle")).alias("shorter"), F.col("needle"))
        pairs = containing_pairs(_keys(names, left_name, "name").distinct(), needles)
        longest = pairs.groupBy(F.col("key").alias(matched)).agg(F.min(order)["needle"].alias(needle))
    others = [c for c in right.columns if c != right_name]
    first_row = (
        right.groupBy(match_key(F.col(right_name)).alias(needle))
        .agg(F.min(F.struct(right_name, *others)).alias(row))
        .select(needle, f"{row}.*")
    )
    matches = stage(longest.join(first_row, needle).drop(needle), "longest")
    sought = left.withColumn(name, _name_key(_left_key(left, left_name)))
    return sought.join(matches, F.col(name) == F.col(matched), "left").drop(name, matched)
