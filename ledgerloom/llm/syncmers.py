"""Document fingerprints of closed syncmers with their positions.

A k-mer of code points is a closed syncmer if the smallest of its s-mers is its first or its last.
That depends on the k-mer alone, so an edit moves no anchor away from it. A fingerprint keeps all
anchors with their places, so it grows with the text; two of them are compared by the anchors they
share in the same order.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shipping import ship

K, S = 12, 5
# Ends of the text are code points of their own, so short texts have k-mers too.
_PAD = np.full(K - 1, 0x110000, np.uint32)
_ANCHOR = np.dtype([("hash", "<u4"), ("at", "<u4")])
# Bytes of text that one bucket of neighbouring documents should have, and how many buckets there are.
BUCKET_BYTES = 8 * 1024 * 1024
BUCKETS = (64, 10_000)
# Characters of fingerprints that a task hands over at once, about.
HANDED = 4 * 1024 * 1024
_LEAST = -(2**63)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint32(16))
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of all closed syncmers of the padded text, in order of place."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.concatenate([_PAD[: k - 1], points, _PAD[: k - 1]])
    n = len(points) - s + 1
    inner = points[:n].copy()
    for i in range(1, s):
        inner *= np.uint32(0x01000193)
        inner += points[i : i + n]
    inner = _mix(inner)
    # Smallest of the w s-mers from each place on, by doubling the stretch that is covered.
    w, span, low = k - s + 1, 1, inner
    while span < w:
        step = min(span, w - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    closed = np.flatnonzero((inner[: len(low)] == low) | (inner[w - 1 :] == low))
    if not len(closed):
        closed = np.array([int(np.argmin(low))])
    hashed = inner[closed]
    for at in range(s, k - s + 1, s):
        hashed = hashed * np.uint32(0x9E3779B1) + inner[closed + at]
    return _mix(hashed * np.uint32(0x9E3779B1) + inner[closed + k - s]), closed


def fingerprint(text: str) -> str:
    """All anchors in order of hash, with their places; empty for an empty text."""
    if not text:
        return ""
    hashes, places = anchors(text)
    # The second and later occurrences of a k-mer are anchors of their own, so that repetitive
    # texts are told by all of their length.
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    nth = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.r_[starts, len(ordered)]))
    again = nth > 0
    ordered[again] = _mix(ordered[again] + nth[again].astype(np.uint32) * np.uint32(0x9E3779B1))
    found, first = np.unique(ordered, return_index=True)
    kept = np.empty(len(found), _ANCHOR)
    kept["hash"], kept["at"] = found, places[order[first]]
    return base64.b64encode(kept.tobytes()).decode()


def likeness(a: str, b: str) -> float:
    """Share of anchors that two texts have in common and in the same order, 0 to 1.

    Twice the common ones over those of either. Two empty texts are alike, an empty one and another
    are not.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x, y = (np.frombuffer(base64.b64decode(f), _ANCHOR) for f in (a, b))
    _, in_x, in_y = np.intersect1d(x["hash"], y["hash"], assume_unique=True, return_indices=True)
    either = len(x) + len(y) - len(in_x)
    places = y["at"][in_y][np.argsort(x["at"][in_x], kind="stable")]
    common = len(places)
    if (places[1:] <= places[:-1]).any():
        ends: list[int] = []
        for place in places.tolist():
            at = bisect_left(ends, place)
            ends[at : at + 1] = [place]
        common = len(ends)
    return 2.0 * common / (either + common)


def _edited(text: str, following: str) -> str:
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one task in order of bucket and document; the rows that follow a bucket come last in it."""
    held = None
    for batch in batches:
        out, size = [], 0
        for bucket, follows, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if held is not None and held[0] != bucket:
                held = None
            if held is None and follows:
                continue
            print_ = fingerprint(text)
            if held is not None:
                _, before_id, before, before_print = held
                edited = _edited(before, text)
                edited_print = fingerprint(edited)
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                near = likeness(before_print, edited_print), likeness(before_print, print_)
                out.append((before_id, len(before), digest, before_print, edited_print, *near))
                size += len(before_print) + len(edited_print)
                if size > HANDED:
                    yield _handed(out)
                    out, size = [], 0
            held = None if follows else (bucket, doc_id, text, print_)
        yield _handed(out)


def _handed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 7
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _NAMES)


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs`` (doc_id, text) and of its edited text.

    The edited text has the last quarter replaced by the beginning of the next document's text, in
    order of doc_id; the first follows the last. Null texts are empty, a null doc_id comes first,
    and rows of one doc_id are ordered by text, or by its hash where there are very many. Further columns are ignored; a single row follows
    itself; an empty table gives no rows. Equal texts have equal fingerprints.

    Texts move once: documents are dealt to buckets of neighbouring ids, and the first rows of a
    bucket also go to the bucket before, so no window over all rows is needed. A task goes through
    its rows one by one.
    """
    ship(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LEAST))
    rows = docs.select(
        key.alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text").cast("bigint")).alias("bytes")).first()
    if not size["n"]:
        return docs.sparkSession.createDataFrame([], _SCHEMA)
    buckets = min(max(BUCKETS[0], size["bytes"] // BUCKET_BYTES), BUCKETS[1])
    shares = [i / buckets for i in range(1, buckets)]
    quantiles = rows.agg(F.percentile_approx("key", shares, 10 * buckets).alias("at")).first()["at"]
    limits, times = np.unique(np.array(quantiles, np.int64), return_counts=True)
    # A key that is several quantiles has so many rows; they get as many buckets, by their texts.
    parts = np.r_[0, np.where(times > 1, times, 0)]
    starts = np.cumsum(parts + 1) - (parts + 1)
    hot = [int(k) for k in limits[times > 1]]
    text_hash = F.when(F.col("key").isin(hot), F.xxhash64("text")).otherwise(F.lit(0)) if hot else F.lit(0).cast("bigint")
    rows = rows.withColumn("hash", text_hash)

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series, hashed: pd.Series) -> pd.Series:
        keys = key.to_numpy()
        at = np.searchsorted(limits, keys, side="right")
        own = parts[at]
        among = np.minimum((hashed.to_numpy().astype(np.float64) / 2.0**64 + 0.5) * own, own - 1).astype(np.int64)
        same = (own > 0) & (keys == np.r_[0, limits][at])
        return pd.Series(starts[at] + np.where(same, among, own))

    # One row per bucket.
    row = F.struct("key", "hash")
    first = {r["bucket"]: tuple(r["row"]) for r in rows.groupBy(bucket_of("key", "hash").alias("bucket")).agg(F.min(row).alias("row")).collect()}
    filled = sorted(first)
    before = {first[b]: filled[i - 1] for i, b in enumerate(filled)}
    first_keys = np.unique([key for key, _ in before])

    @F.pandas_udf("int")
    def bucket_before(key: pd.Series, hashed: pd.Series) -> pd.Series:
        out = np.full(len(key), -1, np.int32)
        for i in np.flatnonzero(np.isin(key.to_numpy(), first_keys)):
            out[i] = before.get((int(key.iloc[i]), int(hashed.iloc[i])), -1)
        return pd.Series(out)

    places = F.array(
        F.struct(bucket_of("key", "hash").alias("bucket"), F.lit(False).alias("follows")),
        F.struct(bucket_before("key", "hash").alias("bucket"), F.lit(True).alias("follows")),
    )
    dealt = rows.select("*", F.inline(places)).where("bucket >= 0")
    ordered = dealt.repartition("bucket").sortWithinPartitions("bucket", "follows", "key", "hash", "text")
    return ordered.select("bucket", "follows", "doc_id", "text").mapInArrow(_compare, _SCHEMA)
