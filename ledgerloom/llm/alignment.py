"""Tokens of two vocabularies over the same texts, aligned by the bytes that they cover.

Every text is tokenised whole by both. Where a token of either ends at the same byte and the next
ones begin with a space, the text is cut: an anchor. Between two anchors lies a window of ids of both,
which is aligned once and remembered by its ids, so common words cost a lookup.

How often two ids are linked is counted over all documents. The commonest pairs, a bounded number of
them, are broadcast with their counts; the others are rare by that, and joined.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from operator import add

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.packing import ByteBpe, byte_bpe
from ledgerloom.llm.shipping import ship
from ledgerloom.session import stage

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k", "piece_bpe_32k"
#: Pairs of ids that are broadcast with their counts, 16 bytes each.
FREQUENT_PAIRS = 1 << 21
#: Windows that a worker remembers from one block of texts to the next.
REMEMBERED = 250_000
# Bytes of text that are aligned at once, and pairs that are counted at once.
_BLOCK, _COUNTED = 2 << 20, 1 << 22
_SPACE = ord(" ")
_B_MARK = np.uint32(1 << 31)
# Counts are told apart by so many classes for each doubling.
_CLASSES = 4


class _Pieces:
    """The second vocabulary: ids of a text, which it begins with a space, and the bytes of ids."""

    def __init__(self, vocabulary: str) -> None:
        path = public_tokenizers.path(f"{vocabulary}.model")
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.token_bytes = [self._bytes_of(i) for i in range(self._model.vocab_size())]

    def _bytes_of(self, i: int) -> bytes:
        piece = self._model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, text: str) -> np.ndarray:
        return self._model.encode_as_numpy(text, num_threads=1).astype(np.uint32)


def align_window(a: list[int], b: list[int], bytes_a: list[int], bytes_b: list[int]):
    """Groups, as text, and links of tokens that cover the same bytes; both have one token at least.

    ``bytes_a`` and ``bytes_b`` are the lengths of all ids. Links are all pairs that share a byte,
    each as the number ``x * len(bytes_b) + y``.
    """
    groups, links, size_b = [], [], len(bytes_b)
    i = j = 0
    while i < len(a):
        x, y = a[i], b[j]
        i, j = i + 1, j + 1
        links.append(x * size_b + y)
        # Bytes by which the first's tokens are ahead of the second's.
        ahead = bytes_a[x] - bytes_b[y]
        if not ahead:
            groups.append(f"{x}|{y}")
            continue
        of_a, of_b = f"{x}", f"{y}"
        while ahead:
            if ahead < 0:
                x, i = a[i], i + 1
                ahead += bytes_a[x]
                of_a += f",{x}"
            else:
                y, j = b[j], j + 1
                ahead -= bytes_b[y]
                of_b += f",{y}"
            links.append(x * size_b + y)
        groups.append(f"{of_a}|{of_b}")
    return groups, links


def _flat(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens in a row, where each begins and how long it is."""
    lengths = np.array([len(t) for t in tokens])
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def _covers(ids: np.ndarray, flat, data: np.ndarray) -> np.ndarray:
    """At which bytes of ``data`` the tokens, which are as long in all, have another one."""
    values, starts, lengths = flat
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    return values[np.repeat((starts[ids] - (ends - sizes)).astype(np.int32), sizes) + np.arange(len(data), dtype=np.int32)] != data


class Aligner:
    """Aligns blocks of texts and remembers windows. A pair of ids is one number, ``a * size_b + b``."""

    def __init__(self, first: ByteBpe, second: _Pieces) -> None:
        self._first, self._second = first, second
        tokens_a = [first.token_bytes.get(i, b"") for i in range(max(first.token_bytes) + 1)]
        self._flat_a, self._flat_b = _flat(tokens_a), _flat(second.token_bytes)
        self._lengths_a, self._lengths_b = self._flat_a[2], self._flat_b[2]
        self._sizes_a, self._sizes_b = self._lengths_a.tolist(), self._lengths_b.tolist()
        self.size_b = len(self._sizes_b)
        self._forget()

    def _forget(self) -> None:
        self._windows: dict[bytes, int] = {}
        self._texts: list[str] = []
        self._groups, self._links = array("q"), array("q")
        self._codes, self._starts = array("Q"), array("q")

    def _learn(self, key: bytes, a: list[int], b: list[int]) -> int:
        groups, links = align_window(a, b, self._sizes_a, self._sizes_b)
        self._texts.append(";".join(groups))
        self._groups.append(len(groups))
        self._links.append(len(links))
        self._starts.append(len(self._codes))
        self._codes.extend(links)
        self._windows[key] = number = len(self._windows)
        return number

    def _tokens(self, texts: list[str | None]) -> list[tuple[int, np.ndarray, np.ndarray, bytes]]:
        """Of the texts that both give back byte by byte: place, ids of both and the bytes."""
        found = []
        for at, text in enumerate(texts):
            if text:
                data = b" " + text.encode()
                a, b = self._first.plain_ids(" " + text), self._second.ids(text)
                if self._lengths_a[a].sum() == len(data) == self._lengths_b[b].sum():
                    found.append((at, a, b, data))
        if not found:
            return []
        data = np.frombuffer(b"".join(f[3] for f in found), np.uint8)
        other = _covers(np.concatenate([f[1] for f in found]), self._flat_a, data)
        other |= _covers(np.concatenate([f[2] for f in found]), self._flat_b, data)
        ends = np.cumsum([len(f[3]) for f in found])
        wrong = np.diff(np.r_[0, np.r_[0, np.cumsum(other)][ends]])
        return [f for f, n in zip(found, wrong.tolist()) if not n]

    def align(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """For each text (n_a, n_b, n_groups, n_links, groups_sha256), and the pairs linked in them.

        Pairs are three arrays by text and pair: the place of the text, the pair, and how many links
        of the text it has.
        """
        if len(self._windows) > REMEMBERED:
            self._forget()
        rows: list[tuple] = [(0, 0, 0, 0, "")] * len(texts)
        found = self._tokens(texts)
        if not found:
            return rows, *(np.empty(0, np.int64),) * 3
        at = [f[0] for f in found]
        a = np.concatenate([f[1] for f in found]).astype(np.uint32)
        b = np.concatenate([f[2] for f in found])
        data = np.frombuffer(b"".join(f[3] for f in found), np.uint8)
        ends_a, ends_b = np.cumsum(self._lengths_a[a]), np.cumsum(self._lengths_b[b])
        document_ends = np.cumsum([len(f[3]) for f in found])
        # A byte is an anchor where tokens of both end and the next ones have the space that follows;
        # the first byte of a text is its own space.
        of_a, of_b = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        of_a[ends_a] = True
        of_b[ends_b] = True
        anchors = of_a & of_b
        anchors[:-1] &= data == _SPACE
        anchors[document_ends] = True
        cuts = np.flatnonzero(anchors)
        numbers = self._windows_between(cuts, a, b, ends_a, ends_b)

        windows = np.diff(np.r_[0, np.searchsorted(cuts, document_ends, side="right")])
        counts_a = np.diff(np.r_[0, np.searchsorted(ends_a, document_ends, side="right")])
        counts_b = np.diff(np.r_[0, np.searchsorted(ends_b, document_ends, side="right")])
        firsts = np.cumsum(windows) - windows
        links = np.frombuffer(self._links, np.int64)[numbers]
        groups_of = np.add.reduceat(np.frombuffer(self._groups, np.int64)[numbers], firsts)
        links_of = np.add.reduceat(links, firsts)
        text_of, listed = self._texts, numbers.tolist()
        for k, (i, first, n) in enumerate(zip(at, firsts.tolist(), windows.tolist())):
            joined = ";".join([text_of[w] for w in listed[first : first + n]])
            digest = hashlib.sha256(joined.encode()).hexdigest()
            rows[i] = (int(counts_a[k]), int(counts_b[k]), int(groups_of[k]), int(links_of[k]), digest)

        ends = np.cumsum(links)
        index = np.repeat(np.frombuffer(self._starts, np.int64)[numbers] - (ends - links), links) + np.arange(ends[-1])
        codes = np.frombuffer(self._codes, np.uint64)[index]
        # Sorted by text and pair as one number; a block has fewer than 2^20 texts, pairs take 44 bits.
        place = np.repeat(np.array(at, np.uint64), links_of)
        joint = np.sort((place << np.uint64(44)) | codes)
        new = np.flatnonzero(np.r_[True, joint[1:] != joint[:-1]])
        times = np.diff(np.r_[new, len(joint)])
        return rows, (joint[new] >> np.uint64(44)).astype(np.int64), joint[new] & np.uint64((1 << 44) - 1), times

    def _windows_between(self, cuts, a, b, ends_a, ends_b) -> np.ndarray:
        """The numbers of the windows that end at ``cuts``."""
        stops_a = (4 * np.r_[0, np.searchsorted(ends_a, cuts) + 1]).tolist()
        stops_b = (4 * np.r_[0, np.searchsorted(ends_b, cuts) + 1]).tolist()
        # Ids of the second are marked, so that a window's bytes tell where they begin.
        data_a, data_b = a.tobytes(), (b | _B_MARK).tobytes()
        own_a = map(data_a.__getitem__, map(slice, stops_a, stops_a[1:]))
        own_b = map(data_b.__getitem__, map(slice, stops_b, stops_b[1:]))
        keys = list(map(add, own_a, own_b))
        numbers = list(map(self._windows.get, keys))
        ids_a, ids_b = a.tolist(), b.tolist()
        for k in [k for k, number in enumerate(numbers) if number is None]:
            if (number := self._windows.get(keys[k])) is None:
                (p, q), (r, s) = stops_a[k : k + 2], stops_b[k : k + 2]
                number = self._learn(keys[k], ids_a[p // 4 : q // 4], ids_b[r // 4 : s // 4])
            numbers[k] = number
        return np.array(numbers, np.int64)


@lru_cache(maxsize=2)
def aligner(vocabulary_a: str, vocabulary_b: str) -> Aligner:
    """Loaded once in each worker."""
    return Aligner(byte_bpe(vocabulary_a), _Pieces(vocabulary_b))


_DIGEST = {
    "row": pa.int64(),
    "doc_id": pa.int64(),
    "n_a": pa.int64(),
    "n_b": pa.int64(),
    "n_groups": pa.int64(),
    "n_links": pa.int64(),
    "groups_sha256": pa.string(),
}
_DIGEST_SCHEMA = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_PAIRS_SCHEMA = "pairs binary, times binary"


def _blocks(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``_BLOCK`` bytes, and of one text at least."""
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > _BLOCK:
            yield start, i
            start, held = i, 0
        held += n + 64
    if start < len(lengths):
        yield start, len(lengths)


def _align(batches: Iterator[pa.RecordBatch], vocabulary_a: str, vocabulary_b: str) -> Iterator[pa.RecordBatch]:
    worker = aligner(vocabulary_a, vocabulary_b)
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for start, stop in _blocks([len(t or "") for t in texts]):
            rows, place, pairs, times = worker.align(texts[start:stop])
            cuts = np.searchsorted(place, np.arange(len(rows) + 1)).tolist()
            pairs, times = pairs.astype("<u8"), times.astype("<u4")
            held = [(pairs[p:q].tobytes(), times[p:q].tobytes()) for p, q in pairwise(cuts)]
            columns = list(zip(*[(row + i, d, *r, *h) for i, (d, r, h) in enumerate(zip(doc_ids[start:stop], rows, held))]))
            row += len(rows)
            kinds = [*_DIGEST.values(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [*_DIGEST, "pairs", "times"])


def align_documents(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """Each document's tokens of both vocabularies, aligned: counts and digest of its groups, and its
    linked pairs of ids with how many links of each (``pairs``, 8 bytes each, and ``times``, 4).

    ``row`` numbers the rows by task, so stage the result and go on from the files.
    """
    ship(docs.sparkSession)
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return known.mapInArrow(lambda batches: _align(batches, vocabulary_a, vocabulary_b), f"{_DIGEST_SCHEMA}, {_PAIRS_SCHEMA}")


def _numbers(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed ones, row after row, and where each row's end."""
    if not len(column):
        return np.empty(0, kind), np.empty(0, np.int64)
    packed = column.cast(pa.large_binary())
    _, offsets, data = packed.buffers()
    ends = np.frombuffer(offsets, np.int64)[packed.offset : packed.offset + len(packed) + 1]
    numbers = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]].copy().view(kind)
    return numbers, (ends[1:] - ends[0]) // numbers.itemsize


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs and in how many documents of a task they are; a document has each of its pairs once."""

    def counts(held: list[np.ndarray]) -> pa.RecordBatch:
        pairs, n = np.unique(np.concatenate([np.empty(0, "<u8"), *held]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(n.astype(np.int64))], ["pair", "n"])

    held: list[np.ndarray] = []
    for batch in batches:
        held.append(_numbers(batch.column(0), "<u8")[0])
        if sum(map(len, held)) > _COUNTED:
            yield counts(held)
            held = []
    yield counts(held)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """Every linked pair of ids: pair, n (documents that hold it), best (none of its first id has more)."""
    partial = aligned.select("pairs").mapInArrow(_counted, "pair bigint, n bigint")
    counts = stage(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    first = F.expr(f"pair div {size_b}")
    # A row for each id of the first vocabulary at most.
    most = counts.groupBy(first.alias("first")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("first", first).join(F.broadcast(most), "first")
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _looked_up(batches: Iterator[pa.RecordBatch], known, rest: bool) -> Iterator[pa.RecordBatch]:
    """Sums over the pairs of each row that are among the ``known``, or the pairs of the ``rest``."""
    frequent, facts = known.value
    for batch in batches:
        pairs, stops = _numbers(batch.column(batch.num_columns - 2), "<u8")
        times = _numbers(batch.column(batch.num_columns - 1), "<u4")[0].astype(np.int64)
        lengths = np.diff(np.r_[0, stops])
        at = np.minimum(np.searchsorted(frequent, pairs), max(len(frequent) - 1, 0))
        found = frequent[at] == pairs if len(frequent) else np.zeros(len(pairs), bool)
        if rest:
            of = np.repeat(batch.column(0).to_numpy(), lengths)
            columns = [pa.array(of[~found]), pa.array(pairs[~found].view(np.int64)), pa.array(times[~found])]
            yield pa.RecordBatch.from_arrays(columns, ["row", "pair", "times"])
            continue
        fact = np.where(found, facts[at] if len(facts) else 0, 0)
        sums = []
        for values in ((fact & 1) * times, (fact >> 1) * times):
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(values)])
            sums.append(pa.array(ends[stops] - ends[stops - lengths]))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *sums], [*_DIGEST, "n_best", "count_sum"])


def _threshold(counts: DataFrame, most: int) -> int:
    """The least class of counts from which on there are ``most`` pairs at most, see ``_class``."""
    classes = counts.groupBy(_class().alias("class")).agg(F.count(F.lit(1)).alias("pairs"))
    # A row for each class, a few hundred.
    total, least = 0, _CLASSES * 64
    for class_, pairs in sorted(((r["class"], r["pairs"]) for r in classes.collect()), reverse=True):
        total += pairs
        if total > most:
            break
        least = class_
    return least


def _class():
    return F.floor(F.log2("n") * _CLASSES).cast("int")


def alignment_statistics(
    docs: DataFrame,
    vocabulary_a: str = VOCABULARY_A,
    vocabulary_b: str = VOCABULARY_B,
    frequent_pairs: int = FREQUENT_PAIRS,
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The first vocabulary encodes a space and the text, the second the text, to which it adds the
    space; strings of special tokens are plain text. Bytes where tokens of both end cut them into
    groups; tokens of both that share bytes are linked. A pair's count is in how many rows it is
    linked; n_best are links whose count none of the same first id exceeds, count_sum is the sum of
    counts over links. groups_sha256 is of ``a1,a2|b1;a3|b2``, all groups in order.

    Null and empty texts and those that either vocabulary does not give back byte by byte have no
    tokens: zeros and an empty groups_sha256. Repeated rows count once each, also without a doc_id.
    Further columns are ignored; an empty table has no rows. A text is one row and one task's.
    """
    spark = docs.sparkSession
    aligned = stage(align_documents(docs, vocabulary_a, vocabulary_b), "aligned")
    counts = stage(pair_counts(aligned, aligner(vocabulary_a, vocabulary_b).size_b), "counts")
    least = _threshold(counts, frequent_pairs)
    frequent = counts.where(_class() >= least).orderBy("pair").toArrow()
    facts = 2 * frequent["n"].to_numpy() + frequent["best"].to_numpy()
    known = spark.sparkContext.broadcast((frequent["pair"].to_numpy().view(np.uint64), facts))
    schema = f"{_DIGEST_SCHEMA}, n_best bigint, count_sum bigint"
    columns = [*_DIGEST, "pairs", "times"]
    sums = aligned.select(*columns).mapInArrow(lambda batches: _looked_up(batches, known, False), schema)
    rare = counts.where(_class() < least)
    if not rare.isEmpty():
        listed = aligned.select("row", "pairs", "times").mapInArrow(
            lambda batches: _looked_up(batches, known, True), "row bigint, pair bigint, times bigint"
        )
        linked = listed.join(rare, "pair")
        more = linked.groupBy(F.col("row").alias("of")).agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("n") * F.col("times")).alias("more_sum"),
        )
        joined = sums.join(more, F.col("row") == F.col("of"), "left")
        sums = joined.withColumns(
            {
                "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
                "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
            }
        )
    return sums.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
