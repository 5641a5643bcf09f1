"""Token ids of documents in files, compressed by a grammar of pairs (Re-Pair) for each shard.

A shard replaces its frequent pairs of neighbouring symbols by new ones, rules, again and again until
little is won by it. Pairs never reach over the end of a document, so each document is a run of
symbols of its own. A shard stores its rules, how many ids each of them stands for, and the symbols;
with the lengths any place in it is found by a search, and only the symbols that cover the wanted ids
are expanded.

A file is ``MAGIC``, its shards, a directory of them, the directory's place and ``MAGIC`` again. All
numbers are little-endian.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.packing import END_ID, VOCABULARY, byte_bpe
from ledgerloom.llm.shipping import ship
from ledgerloom.session import stage

MAGIC = b"LLREPAIR"
SUFFIX = ".repair"
#: Ids of a shard, and about how many a file has; a longer document goes on in the next shard.
SHARD_IDS, FILE_IDS = 1 << 20, 1 << 26
#: A pair becomes a rule if it is replaced so many times.
LEAST_COUNT = 8
# Pairs that are replaced in one round at most, and the part of symbols that a round must save.
_PAIRS, _LEAST_GAIN = 8192, 0.01
# Symbols below this number take two bytes; vocabularies that leave no room for rules take four.
_NARROW, _LEAST_ROOM = 1 << 16, 1 << 12
_SLOTS = 16
_SPREAD = 0x9E3779B97F4A7C15
_SHARD = struct.Struct("<IIIIQI?")
_ENTRY = struct.Struct("<QQQQ")
_TAIL = struct.Struct("<QI")
MANIFEST = "manifest"


def _slot(codes: np.ndarray) -> np.ndarray:
    bits = 8 * codes.itemsize
    spread = codes.dtype.type(_SPREAD >> (64 - bits) | 1)
    return (codes * spread) >> codes.dtype.type(bits - _SLOTS)


def _frequent(codes: np.ndarray, most: int) -> np.ndarray:
    """The pairs that occur ``LEAST_COUNT`` times or more, the commonest first, ``most`` of them."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
    counts = np.diff(np.r_[first, len(codes)])
    enough = counts >= LEAST_COUNT
    pairs, counts = codes[first[enough]], counts[enough]
    return pairs[np.argsort(-counts, kind="stable")[:most]]


def _chosen(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the pairs at the ascending places ``at`` are replaced: no two that share a symbol.

    Of two that do, the commoner goes first; of a run of the same pair every second one.
    """
    beside = at[1:] == at[:-1] + 1
    starts = np.r_[True, ~(beside & (rank[1:] == rank[:-1]))]
    index = np.arange(len(at))
    order = 2 * rank + ((index - np.maximum.accumulate(np.where(starts, index, 0))) & 1)
    chosen = np.ones(len(at), bool)
    chosen[1:] &= ~beside | (order[1:] < order[:-1])
    chosen[:-1] &= ~beside | (order[:-1] < order[1:])
    return chosen


@dataclass(frozen=True)
class Grammar:
    """Symbols below ``base`` are ids; symbol ``base + i`` stands for ``left[i]`` and then ``right[i]``."""

    base: int
    left: np.ndarray
    right: np.ndarray
    #: How many ids each rule stands for.
    lengths: np.ndarray

    @cached_property
    def sizes(self) -> np.ndarray:
        """How many ids each symbol stands for."""
        return np.concatenate([np.ones(self.base, np.int64), self.lengths.astype(np.int64)])

    @cached_property
    def _texts(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all symbols in a row, and where those of each begin."""
        out = np.arange(self.base + len(self.left), dtype=np.int64)
        while (deep := out >= self.base).any():
            width = 1 + deep
            at = np.cumsum(width) - width
            opened = np.empty(int(width.sum()), np.int64)
            opened[at] = out
            opened[at[deep]] = self.left[out[deep] - self.base]
            opened[at[deep] + 1] = self.right[out[deep] - self.base]
            out = opened
        return out.astype(np.uint32), np.cumsum(self.sizes) - self.sizes

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        texts, starts = self._texts
        sizes = self.sizes[symbols]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return texts[np.repeat(starts[symbols] - (ends - sizes), sizes) + np.arange(total)]


def compress(ids: np.ndarray, ends: np.ndarray) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """The grammar of ``ids``, its symbols, and where each document ends among them.

    ``ends`` are the places in ``ids`` after the documents' last ids, each document having one id
    or more.
    """
    base = int(ids.max()) + 1 if len(ids) else 0
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[np.asarray(ends, np.int64) - 1] = True
    left, right = [np.empty(0, np.uint32)], [np.empty(0, np.uint32)]
    sizes, rules = np.ones(base, np.uint32), 0
    narrow = _NARROW - base >= _LEAST_ROOM
    room = (_NARROW if narrow else 2**31) - base
    # A pair as one number.
    code, half = (np.uint32, 16) if narrow else (np.uint64, 32)
    while len(symbols) > 1:
        codes = (symbols[:-1].astype(code) << code(half)) | symbols[1:]
        pairs = _frequent(codes[~last[:-1]], min(_PAIRS, room - rules))
        if not len(pairs):
            break
        # Where two pairs share a slot the commoner is found, and the other one in a later round.
        table = np.full(1 << _SLOTS, -1, np.int32)
        table[_slot(pairs)[::-1]] = np.arange(len(pairs), dtype=np.int32)[::-1]
        rank = table[_slot(codes)]
        at = np.flatnonzero((rank >= 0) & ~last[:-1])
        at = at[pairs[rank[at]] == codes[at]]
        at = at[_chosen(at, rank[at].astype(np.int64))]
        kept = np.bincount(rank[at], minlength=len(pairs)) >= LEAST_COUNT
        at = at[kept[rank[at]]]
        if not len(at):
            break
        number = (base + rules + np.cumsum(kept) - 1).astype(np.uint32)
        a, b = ((part & code((1 << half) - 1)).astype(np.uint32) for part in (pairs[kept] >> code(half), pairs[kept]))
        left.append(a)
        right.append(b)
        sizes = np.concatenate([sizes, sizes[a] + sizes[b]])
        rules += len(a)
        saved = len(at) / len(symbols)
        symbols[at] = number[rank[at]]
        last[at] = last[at + 1]
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        symbols, last = symbols[stays], last[stays]
        if saved < _LEAST_GAIN:
            break
    return Grammar(base, np.concatenate(left), np.concatenate(right), sizes[base:]), symbols, np.flatnonzero(last) + 1


# --- files -------------------------------------------------------------------------------------


def shard_bytes(keys: list[int | None], counts: list[int], ids: np.ndarray, goes_on: bool) -> bytes:
    """A shard of documents of ``counts`` ids each; ``goes_on`` if the first began in the shard before."""
    grammar, symbols, ends = compress(ids, np.cumsum(counts))
    width = 2 if grammar.base + len(grammar.left) <= _NARROW else 4
    head = _SHARD.pack(width, grammar.base, len(grammar.left), len(keys), len(ids), len(symbols), goes_on)
    known = np.array([k is not None for k in keys], np.uint8)
    numbers = np.array([0 if k is None else k for k in keys], "<i8")
    parts = [known, numbers, np.array(counts, "<u4"), ends.astype("<u4")]
    parts += [grammar.left.astype("<u4"), grammar.right.astype("<u4"), grammar.lengths.astype("<u4")]
    return head + b"".join(p.tobytes() for p in parts) + symbols.astype(f"<u{width}").tobytes()


@dataclass(frozen=True)
class Shard:
    keys: list[int | None]
    #: Ids of each document in this shard, and where each ends among the symbols.
    counts: np.ndarray
    ends: np.ndarray
    grammar: Grammar
    symbols: np.ndarray
    goes_on: bool

    @classmethod
    def parse(cls, data: bytes) -> Shard:
        width, base, rules, docs, _, symbols, goes_on = _SHARD.unpack_from(data)
        at = _SHARD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        known, numbers = take("u1", docs), take("<i8", docs)
        keys = [k if is_known else None for k, is_known in zip(numbers.tolist(), known)]
        counts, ends = take("<u4", docs), take("<u4", docs)
        grammar = Grammar(base, take("<u4", rules), take("<u4", rules), take("<u4", rules))
        return cls(keys, counts.astype(np.int64), ends.astype(np.int64), grammar, take(f"<u{width}", symbols), goes_on)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        ids, end = self.grammar.expand(self.symbols), 0
        for key, n in zip(self.keys, self.counts.tolist()):
            yield key, ids[end : end + n]
            end += n

    @cached_property
    def _places(self) -> np.ndarray:
        """Where the ids of each symbol end."""
        return np.cumsum(self.grammar.sizes[self.symbols])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids at places ``start`` to ``stop`` of the shard; only symbols that cover them are expanded."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = np.searchsorted(self._places, [start, stop - 1], side="right")
        before = int(self._places[first - 1]) if first else 0
        return self.grammar.expand(self.symbols[first : last + 1])[start - before : stop - before]


class TokenFile:
    """A written file; shards are read when they are wanted."""

    def __init__(self, folder: str, path: str) -> None:
        store, _ = fs.FileSystem.from_uri(folder)
        self._source = store.open_input_file(path)
        size = self._source.size()
        tail = self._source.read_at(_TAIL.size + len(MAGIC), size - _TAIL.size - len(MAGIC))
        if tail[_TAIL.size :] != MAGIC:
            raise ValueError(f"{path} is no complete file of token ids")
        at, n = _TAIL.unpack_from(tail)
        directory = self._source.read_at(n * _ENTRY.size, at)
        #: Of each shard: place and bytes in the file, documents and ids.
        self.entries = list(_ENTRY.iter_unpack(directory))

    def __enter__(self) -> TokenFile:
        return self

    def __exit__(self, *error) -> None:
        self._source.close()

    def shard(self, i: int) -> Shard:
        at, size, _, _ = self.entries[i]
        return Shard.parse(self._source.read_at(size, at))

    def documents(self) -> Iterator[tuple[int | None, list[np.ndarray]]]:
        """(doc_id, its ids in parts) of all documents, in order."""
        held = None
        for i in range(len(self.entries)):
            shard = self.shard(i)
            for at, (key, ids) in enumerate(shard.documents()):
                if at == 0 and shard.goes_on:
                    held[1].append(ids)
                    continue
                if held is not None:
                    yield held
                held = key, [ids]
        if held is not None:
            yield held

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids at places ``start`` to ``stop`` of the file; other shards are not read."""
        found, before = [np.empty(0, np.uint32)], 0
        for i, (_, _, _, n) in enumerate(self.entries):
            if start < before + n and stop > before:
                found.append(self.shard(i).ids(max(start - before, 0), min(stop - before, n)))
            before += n
        return np.concatenate(found)


class _Writer:
    """Files of one task. Names hold the attempt, so two attempts never write to one file."""

    def __init__(self, folder: str, shard_ids: int, file_ids: int) -> None:
        self._store, self._root = fs.FileSystem.from_uri(folder)
        self._shard_ids, self._file_ids = shard_ids, file_ids
        self.partition = TaskContext.get().partitionId()
        self.done: list[tuple[int, int, str, int, int]] = []
        self._out = None
        self._start_shard(False)

    def _start_shard(self, goes_on: bool) -> None:
        self._keys: list[int | None] = []
        self._counts: list[int] = []
        self._parts: list[np.ndarray] = []
        self._held, self._goes_on = 0, goes_on

    def add(self, key: int | None, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            part = ids[at : at + self._shard_ids - self._held]
            self._keys.append(key)
            self._counts.append(len(part))
            self._parts.append(part)
            self._held += len(part)
            at += len(part)
            if self._held == self._shard_ids:
                self._end_shard(at < len(ids))
        if self._ids >= self._file_ids:
            self.close()

    @property
    def _ids(self) -> int:
        return self._held + sum(e[3] for e in self._entries) if self._out is not None else self._held

    def _end_shard(self, goes_on: bool) -> None:
        if self._out is None:
            name = f"{self.partition:06d}-{len(self.done):05d}-{uuid.uuid4().hex}{SUFFIX}"
            self._path = f"{self._root}/{name}"
            self._out = self._store.open_output_stream(self._path)
            self._out.write(MAGIC)
            self._at, self._entries, self._documents = len(MAGIC), [], 0
        data = shard_bytes(self._keys, self._counts, np.concatenate(self._parts), self._goes_on)
        self._out.write(data)
        self._entries.append((self._at, len(data), len(self._keys), self._held))
        self._documents += len(self._keys) - self._goes_on
        self._at += len(data)
        self._start_shard(goes_on)

    def close(self) -> None:
        if self._held:
            self._end_shard(False)
        if self._out is None:
            return
        self._out.write(b"".join(_ENTRY.pack(*e) for e in self._entries))
        self._out.write(_TAIL.pack(self._at, len(self._entries)) + MAGIC)
        self._out.close()
        ids = sum(e[3] for e in self._entries)
        self.done.append((self.partition, len(self.done), self._path, self._documents, ids))
        self._out = None
        self._start_shard(False)


_WRITTEN = {"partition": pa.int32(), "number": pa.int32(), "path": pa.string(), "documents": pa.int64(), "ids": pa.int64()}
_WRITTEN_SCHEMA = "partition int, number int, path string, documents bigint, ids bigint"


def _write(batches: Iterator[pa.RecordBatch], folder: str, vocabulary: str, shard_ids: int, file_ids: int):
    tokenizer, writer = byte_bpe(vocabulary), _Writer(folder, shard_ids, file_ids)
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            writer.add(key, np.append(tokenizer.ids(text.as_py()), END_ID).astype(np.uint32))
    writer.close()
    columns = list(zip(*writer.done)) or [()] * len(_WRITTEN)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _WRITTEN.values())], list(_WRITTEN))


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, shard_ids: int = SHARD_IDS, file_ids: int = FILE_IDS
) -> DataFrame:
    """Write the ids of every text of ``docs`` (doc_id, text) into ``folder``; the manifest of its files.

    Documents are written in ascending doc_id order, those without a doc_id first, and those that
    repeat one by the hash of their texts. Each is its ids and then ``END_ID``; null and empty texts
    are that alone. Further columns are ignored. A table without rows gives a manifest without files.

    ``folder`` is one that all executors reach: ``file:``, ``hdfs:``, ``s3:`` or ``gs:``. The
    manifest is written last and names what successful tasks wrote, so files of lost attempts are
    never read; a folder that has one is refused. A task holds one shard and a batch of texts.
    """
    spark = docs.sparkSession
    ship(spark)
    store, root = fs.FileSystem.from_uri(folder)
    if store.get_file_info(f"{root}/{MANIFEST}").type != fs.FileType.NotFound:
        raise FileExistsError(f"{folder} holds token files already")
    store.create_dir(root, recursive=True)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    # Ranges end within a doc_id that repeats: its rows go by their texts.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = known.repartitionByRange(*order).sortWithinPartitions(*order)
    files = ordered.mapInArrow(lambda b: _write(b, folder, vocabulary, shard_ids, file_ids), _WRITTEN_SCHEMA)
    return stage(files, MANIFEST, f"{folder}/{MANIFEST}")


_READ = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.binary()}
_BATCH_IDS = 1 << 20


def _read(batches: Iterator[pa.RecordBatch], folder: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    kinds = {name: kind for name, kind in _READ.items() if with_ids or name != "ids"}

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))

    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows, held = [], 0
            with TokenFile(folder, path) as file:
                for key, parts in file.documents():
                    n, crc = 0, 0
                    for part in parts:
                        n, crc = n + len(part), zlib.crc32(part.astype("<u4").tobytes(), crc)
                    ids = (b"".join(p.astype("<u4").tobytes() for p in parts),) if with_ids else ()
                    rows.append((key, start, n, crc, *ids))
                    start, held = start + n, held + n
                    if held > _BATCH_IDS:
                        yield batch_of(rows)
                        rows, held = [], 0
            yield batch_of(rows)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    ``with_ids`` adds the ids, 4 bytes each. A file is one task's.
    """
    ship(spark)
    files = spark.read.schema(_WRITTEN_SCHEMA).parquet(f"{folder}/{MANIFEST}")
    n = files.count()
    # One row per file in this window, which is what the driver lists for any other scan.
    earlier = Window.orderBy("partition", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("path", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).cast("bigint").alias("start"))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    return starts.repartition(max(1, n), "path").mapInArrow(lambda batches: _read(batches, folder, with_ids), schema)
