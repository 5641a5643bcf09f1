"""Shards of near equal bytes by a k-d tree over the documents' metadata.

Every group of equal texts is one point with its total bytes as weight, so copies never part. Groups
that weigh a shard's share or more get shards of their own, the tree has the others. A
node is cut at the weighted median of its widest dimension, found by counting weights in buckets:
the first count finds the bucket in which the median lies, the second cuts that bucket by a hash of
the group. Both counts are grouped sums, so no task holds the rows of a node, and what comes to the
driver is one row per node. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import stage

# Bytes of a row besides its text.
ROW_BYTES = 8
# Buckets of one count of weights; a cut is off by at most the weight of a bucket's 1/BUCKETS part.
BUCKETS = 4096
# Rows numbered by one task of the slots, about.
SLOT_ROWS = 1_000_000
_DIMENSIONS = ("x_bytes", "x_lang", "x_source", "x_doc")


@dataclass(frozen=True)
class _Node:
    """A box of the tree with the shards ``first`` … ``first + shards - 1``; a cut once it has one."""

    first: int
    shards: int
    weight: float = 0.0
    dimension: int = 0
    low: float = 0.0
    width: float = 0.0
    bucket: int = 0
    tie: int = 0

    @property
    def target(self) -> float:
        """Weight that its left part should have."""
        return self.weight * (self.shards // 2) / self.shards

    def halves(self) -> list[_Node]:
        half = self.shards // 2
        return [_Node(self.first, half), _Node(self.first + half, self.shards - half)]


def _with_nodes(points: DataFrame, nodes: list[_Node]) -> DataFrame:
    """``points`` with the cut of their box and their bucket in it; points of other boxes without."""
    cuts = F.array(
        *[
            F.struct(
                F.lit(n.first).alias("node"),
                F.lit(n.first + n.shards // 2).alias("right"),
                F.lit(n.dimension + 1).alias("dimension"),
                F.lit(float(n.low)).alias("low"),
                F.lit(float(n.width)).alias("width"),
                F.lit(n.bucket).alias("cut_bucket"),
                F.lit(n.tie).alias("cut_tie"),
                F.lit(float(n.target)).alias("target"),
            )
            for n in nodes
        ]
    )
    # One row per box of the level, fewer than shards.
    table = F.broadcast(points.sparkSession.range(1).select(F.inline(cuts)))
    at = (F.element_at(F.array(*_DIMENSIONS), F.col("dimension")) - F.col("low")) / F.col("width") * BUCKETS
    bucket = F.when(F.col("width") > 0, F.least(F.floor(at), F.lit(BUCKETS - 1))).otherwise(F.lit(0))
    return points.join(table, "node", "left").withColumn("bucket", bucket.cast("int"))


def _descend(points: DataFrame, nodes: list[_Node]) -> DataFrame:
    """``points`` one level down."""
    right = (F.col("bucket") > F.col("cut_bucket")) | (
        (F.col("bucket") == F.col("cut_bucket")) & (F.col("tie") >= F.col("cut_tie"))
    )
    below = F.when(right, F.col("right")).otherwise(F.col("node")).alias("node")
    return _with_nodes(points, nodes).select(*[c for c in points.columns if c != "node"], below)


def _crossing(counted: DataFrame, bucket: str) -> dict[int, tuple]:
    """For each node the bucket in which its weight reaches the target, its weight and that before it."""
    running = Window.partitionBy("node").orderBy(bucket)
    reached = counted.withColumn("upto", F.sum("weight").over(running)).where(F.col("upto") >= F.col("target"))
    first = reached.groupBy("node").agg(F.min(F.struct(bucket, "upto", "weight")).alias("at"))
    return {r["node"]: (r["at"][0], r["at"]["upto"] - r["at"]["weight"], r["at"]["weight"]) for r in first.collect()}


def _cut(points: DataFrame, nodes: list[_Node]) -> list[_Node]:
    """The nodes of one level with their cuts; one row per node comes to the driver."""
    bounds = [f(d).alias(f"{name}_{d}") for d in _DIMENSIONS for name, f in (("low", F.min), ("high", F.max))]
    sums = F.sum("weight").alias("weight")
    inside = points.where(F.col("node").isin([n.first for n in nodes]))
    facts = {r["node"]: r for r in inside.groupBy("node").agg(sums, *bounds).collect()}
    sized = []
    for node in (n for n in nodes if n.first in facts):
        fact = facts[node.first]
        widths = [fact[f"high_{d}"] - fact[f"low_{d}"] for d in _DIMENSIONS]
        widest = widths.index(max(widths))
        low = fact[f"low_{_DIMENSIONS[widest]}"]
        sized.append(replace(node, weight=fact["weight"], dimension=widest, low=low, width=widths[widest]))
    if not sized:
        return []
    bucketed = _with_nodes(inside, sized)
    coarse = _crossing(bucketed.groupBy("node", "bucket", "target").agg(sums), "bucket")
    sized = [replace(n, bucket=coarse[n.first][0]) for n in sized]
    middle = _with_nodes(inside, sized).where(F.col("bucket") == F.col("cut_bucket"))
    before = {n.first: coarse[n.first][1] for n in sized}
    rest = F.col("target")
    for node in sized:
        rest = F.when(F.col("node") == node.first, F.lit(node.target - before[node.first])).otherwise(rest)
    fine = _crossing(middle.groupBy("node", "tie", rest.alias("target")).agg(sums), "tie")
    done = []
    for node in sized:
        # Rounding may put the last crossing out of reach; then the whole bucket goes left.
        tie, below, weight = fine.get(node.first, (BUCKETS, 0.0, 0.0))
        nearer_left = node.target - before[node.first] - below > weight / 2
        done.append(replace(node, tie=tie + 1 if nearer_left else tie))
    return done


def _own_shards(points: DataFrame, shards: int) -> list[bytearray]:
    """Groups that weigh at least the mean of the shards that are left for them and all smaller ones."""
    rest = points.agg(F.sum("weight").alias("weight")).first()["weight"] or 0.0
    # Not as many rows as shards come to the driver.
    largest = points.select("text_key", "weight").orderBy(F.desc("weight"), "text_key").limit(shards - 1).collect()
    own = []
    for group in largest:
        if group["weight"] * (shards - len(own)) < rest:
            break
        own.append(group["text_key"])
        rest -= group["weight"]
    return own


def kd_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` shards of near equal bytes.

    ``docs`` has doc_id, text, lang, source; further columns are ignored. Rows of equal texts share
    a shard; a text with at least its share of bytes has one to itself, and the other shards are near
    equal among themselves. A text of nearly that much can put a cut off by half its bytes. A null text
    counts as empty, null metadata as a value of their own; repeated rows keep a slot each. An
    empty table gives no rows.

    Returns doc_id, size (UTF-8 bytes plus 8), text_crc32, law (``bytes``), shard, slot (gapless
    from 0 in each shard), grown_shard (null: only the law ``key`` has one).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.unhex(F.md5(text)).alias("text_key"),
            (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
            F.coalesce(F.col("source"), F.lit("")).alias("source"),
        ),
        "shard-rows",
    )
    # A group has the metadata of its smallest row. Every dimension is brought to 0..1.
    spread = lambda c: (F.pmod(F.xxhash64(c), F.lit(1 << 20)) / F.lit(float(1 << 20))).cast("double")
    extent = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.max("size").alias("size")).first()
    low, width = extent["low"] or 0, max((extent["high"] or 0) - (extent["low"] or 0), 1)
    longest = F.log2(F.lit(float(max(extent["size"] or 0, 2 * ROW_BYTES))))
    grouped = rows.groupBy("text_key").agg(
        F.sum("size").cast("double").alias("weight"),
        F.min(F.struct("doc_id", "lang", "source")).alias("least"),
        F.min("size").alias("size"),
    )
    points = stage(
        grouped.select(
            "text_key",
            "weight",
            (F.log2("size") / longest).alias("x_bytes"),
            spread(F.col("least.lang")).alias("x_lang"),
            spread(F.col("least.source")).alias("x_source"),
            F.coalesce((F.col("least.doc_id") - low) / F.lit(float(width)), F.lit(0.0)).alias("x_doc"),
            F.pmod(F.xxhash64("text_key"), F.lit(BUCKETS)).cast("int").alias("tie"),
            F.lit(0).alias("node"),
        ),
        "shard-points",
    )
    own = _own_shards(points, shards)
    node = F.col("node")
    for shard, key in enumerate(own, shards - len(own)):
        node = F.when(F.col("text_key") == F.lit(bytes(key)), shard).otherwise(node)
    points = points.withColumn("node", node)
    level = [_Node(0, shards - len(own))]
    while level := [n for n in level if n.shards > 1]:
        cut = _cut(points, level)
        points = _descend(points, cut) if cut else points
        level = [half for n in cut for half in n.halves()]
    placed = points.select("text_key", F.col("node").alias("shard"))
    numbered = rows.select("*", F.col("_metadata.row_index").alias("at")).join(placed, "text_key")
    parts = max(64, -(-rows.count() // (shards * SLOT_ROWS)))
    part = F.pmod(F.xxhash64("doc_id", "at"), F.lit(parts)).alias("part")
    kept = stage(numbered.select("doc_id", "size", "text_crc32", "shard", "at", part), "shard-placed")
    return _with_slots(kept)


def _with_slots(rows: DataFrame) -> DataFrame:
    """Slots by part of a shard, each part after the rows of the earlier ones."""
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard and part, some thousand; grows by a row per SLOT_ROWS rows of the table.
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "at")
    ranked = rows.withColumn("rank", F.row_number().over(within) - 1)
    return ranked.join(offsets, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("offset") + F.col("rank")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
