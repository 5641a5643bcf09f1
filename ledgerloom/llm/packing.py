"""Documents packed into token sequences by a plan over their lengths.

The plan is made by best fit over how many pieces there are of each length, not over pieces, so its
size depends on the length of a sequence only. Then every piece takes a planned place: its rank
among the pieces of its length says which.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm.shipping import ship
from ledgerloom.session import stage

VOCABULARY = "byte_bpe_50k"
LENGTH = 2048
END_ID = 0
# Ranks within one length are counted in so many parts, and more for tables beyond RANK_ROWS each.
PARTS = 64
RANK_ROWS = 1_000_000
_END_OF_TEXT, _END_OF_TEXT_ID = "<|endoftext|>", 50256
# Characters whose classes are the same in all versions of Unicode that either library has.
_SETTLED = re.compile("[\x00-ɏ]*")


class ByteBpe:
    """Ids as the tokenizers library gives them, without added special tokens.

    The same vocabulary is loaded twice: the rank file encodes texts of settled characters, which is
    several times as fast, and the other one all texts besides.
    """

    def __init__(self, vocabulary: str) -> None:
        self._vocabulary = vocabulary
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        special = {_END_OF_TEXT: _END_OF_TEXT_ID}
        pattern = public_tokenizers.PATTERN
        self._ranks = tiktoken.Encoding(vocabulary, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        #: The bytes of every id but that of the special token.
        self.token_bytes = dict(sorted((rank, token) for token, rank in ranks.items()))

    @cached_property
    def _exact(self) -> Tokenizer:
        """Loaded by workers that meet a text which needs it."""
        tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{self._vocabulary}.json"))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    @cached_property
    def _exact_plain(self) -> Tokenizer:
        tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{self._vocabulary}.json"))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = True
        return tokenizer

    def plain_ids(self, text: str) -> np.ndarray:
        """Ids where the strings of special tokens are text like any other."""
        if _SETTLED.fullmatch(text):
            return self._ranks.encode_to_numpy(text, disallowed_special=())
        return np.array(self._exact_plain.encode(text, add_special_tokens=False).ids, "<u4")

    def ids(self, text: str) -> np.ndarray:
        if _SETTLED.fullmatch(text):
            return self._ranks.encode_to_numpy(text, allowed_special="all")
        return np.array(self._exact.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=4)
def byte_bpe(vocabulary: str) -> ByteBpe:
    """Loaded once in each worker."""
    return ByteBpe(vocabulary)


_PIECE_TYPES = {
    "doc_id": pa.int64(),
    "piece": pa.int32(),
    "start": pa.int64(),
    "length": pa.int64(),
    "ids_crc32": pa.int64(),
    "ids": pa.binary(),
}
_PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"


def _cut(batches: Iterator[pa.RecordBatch], vocabulary: str, limit: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    tokenizer = byte_bpe(vocabulary)
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.append(tokenizer.ids(text.as_py()), END_ID).astype("<u4")
            start, end = 0, len(ids) % limit or limit
            piece = 0
            while start < len(ids):
                part = ids[start:end].tobytes()
                rows.append((doc_id, piece, start, end - start, zlib.crc32(part), part if with_ids else None))
                start, end, piece = end, end + limit, piece + 1
        columns = list(zip(*rows)) or [()] * len(_PIECE_TYPES)
        arrays = [pa.array(c, t) for c, t in zip(columns, _PIECE_TYPES.values())]
        yield pa.RecordBatch.from_arrays(arrays, list(_PIECE_TYPES))


def cut_documents(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """The token pieces of every text of ``docs`` (doc_id, text), each of at most ``limit`` ids.

    A document is its ids and then ``END_ID``; of a longer one all pieces but the first are full.
    A null text is an empty one, which is its end alone. ``with_ids`` adds the ids themselves.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    pieces = texts.mapInArrow(lambda batches: _cut(batches, vocabulary, limit, with_ids), _PIECE_SCHEMA)
    return pieces if with_ids else pieces.drop("ids")


def plan_best_fit(counts: dict[int, int], limit: int = LENGTH) -> np.ndarray:
    """Places for all pieces: rows (length, rank_from, rank_to, sequence_from, offset), by length and rank.

    Lengths go from long to short, and each piece into the sequence with the least space left that
    holds it. Sequences filled alike are one run, which is taken and split as a whole.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    runs: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []
    sequences = 0

    def put(space: int, first: int, n: int) -> None:
        if n and space:
            if space not in runs:
                insort(spaces, space)
                runs[space] = []
            runs[space].append((first, n))

    def take(space: int) -> tuple[int, int]:
        run = runs[space].pop()
        if not runs[space]:
            del runs[space]
            spaces.remove(space)
        return run

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, n = take(space)
            else:
                space, first = limit, sequences
                n = -(-left // (limit // length))
                sequences += n
            each = space // length
            full = min(n, left // each)
            rest = min(left - full * each, each - 1) if full < n else 0
            for j in range(each):
                if full:
                    rows.append((length, rank, rank + full, first, limit - space + j * length))
                    rank += full
            for j in range(rest):
                rows.append((length, rank, rank + 1, first + full, limit - space + j * length))
                rank += 1
            left = counts[length] - rank
            put(space - each * length, first, full)
            if rest:
                put(space - rest * length, first + full, 1)
            put(space, first + full + (rest > 0), n - full - (rest > 0))
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, limit: int = LENGTH) -> DataFrame:
    """``pieces`` with sequence_id and offset: few sequences of at most ``limit`` ids, without gaps.

    ``pieces`` has doc_id, piece and length (1 … ``limit``) and is read several times, so hand over
    staged rows; further columns are kept. Repeated rows get a place each, an empty table has none.
    """
    ship(pieces.sparkSession)
    n = pieces.count()
    parts = max(PARTS, -(-n // RANK_ROWS))
    part = F.pmod(F.xxhash64("doc_id", "piece", "_at"), F.lit(parts)).cast("int")
    known = pieces.select("*", F.col("_metadata.row_index").alias("_at")).withColumn("_part", part)
    counts = known.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    # A row for each length, limit at most.
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = pieces.sparkSession.sparkContext.broadcast(plan_best_fit(totals, limit))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table = plan.value
        keys = (table[:, 0] << 44) + table[:, 1]
        at = np.searchsorted(keys, (length.to_numpy() << 44) + rank.to_numpy(), side="right") - 1
        row = table[at]
        return pd.DataFrame({"sequence_id": row[:, 3] + rank.to_numpy() - row[:, 1], "offset": row[:, 4]})

    within = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "_at")
    ranked = known.withColumn("_rank", F.row_number().over(within)).join(offsets, ["length", "_part"])
    placed = ranked.withColumn("_place", place("length", (F.col("_before") + F.col("_rank") - 1).cast("bigint")))
    return placed.select(*pieces.columns, F.col("_place.sequence_id"), F.col("_place.offset"))


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Every text of ``docs`` cut and packed, see ``cut_documents`` and ``pack``."""
    return pack(stage(cut_documents(docs, vocabulary, limit, with_ids), "pieces"), limit)
