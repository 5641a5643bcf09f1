"""BPE encoding and decoding that encodes a chunk of text once for all documents that share it.

Texts are cut where a rolling hash over the last bytes says so, so that equal passages are cut alike
wherever they stand. Chunks that occur more than once are encoded once each; documents take their
ids from there and encode the rest themselves. Where two chunks meet, the words around the cut are
encoded again; as long as that disagrees with the two sides, the chunks are put together and encoded
as one, until all cuts agree.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm.filters import filter_words, may_hold
from ledgerloom.llm.shipping import ship
from ledgerloom.session import stage

VOCABULARY = "word_bpe_49k"
# A cut after one blank in ``SPACING`` on average, and no chunk shorter or, in bytes, longer than these.
SPACING, SHORTEST, LONGEST = 96, 256, 8192
_WINDOW = 16
# Words whose ids a worker remembers, about; as many again that it met before.
_REMEMBERED = 100_000
# Characters whose normal form, lower case and class are the same in all versions of Unicode.
_SETTLED = regex.compile("[\x00-ɏ]*")
# Fixed by the vocabulary: how a normalised text falls into words, and what is no text.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SPECIAL = "<|"
_GEAR = np.random.default_rng(0x6EA4).integers(0, 2**32, 256, np.uint32)


class Bpe:
    """Ids (16 bits) and texts as the tokenizers library gives them, without added special tokens."""

    def __init__(self, vocabulary: str) -> None:
        self._tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self._tokens = [self._tokenizer.id_to_token(i) for i in range(size)]
        self._ends = np.array([token.endswith("</w>") for token in self._tokens])
        # Ids of words: those met lately, and those met before.
        self._words: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u2")

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of all ``words``; those that are not known are encoded at once."""
        if len(self._words) > _REMEMBERED:
            self._before, self._words = self._words, {}
        known = self._words
        new = []
        for word in words.difference(known):
            ids = self._before.get(word)
            if ids is None:
                new.append(word)
            else:
                known[word] = ids
        if not new:
            return
        ids = self._encoded(" ".join(new))
        # Every word ends with a token that says so, and no other does.
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) == len(new):
            raw, start = ids.tobytes(), 0
            for word, end in zip(new, (ends * 2).tolist()):
                known[word] = raw[start:end]
                start = end
        else:
            known.update((word, self._encoded(word).tobytes()) for word in new)

    def ids(self, text: str) -> bytes:
        if _SPECIAL in text or not _SETTLED.fullmatch(text):
            return self._encoded(text).tobytes()
        words = _WORDS.findall(text.lower())
        kinds = set(words)
        if not kinds <= self._words.keys():
            self._learn(kinds)
        known = self._words
        return b"".join([known[word] for word in words])

    def text(self, ids: np.ndarray) -> str:
        # This vocabulary has no decoder: its tokens stand side by side.
        return " ".join([self._tokens[i] for i in ids.tolist()])


@lru_cache(maxsize=4)
def bpe(vocabulary: str) -> Bpe:
    """Loaded once in each worker."""
    return Bpe(vocabulary)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text in UTF-8, the last one included."""
    if len(data) <= SHORTEST:
        return [len(data)] if data else []
    points = np.frombuffer(data, np.uint8)
    blanks = np.flatnonzero((points == 32) | (points == 10))
    blanks = blanks[blanks >= _WINDOW]
    rolled = np.zeros(len(blanks), np.uint32)
    for j in range(_WINDOW):
        rolled += _GEAR[points[blanks - j]] << np.uint32(j)
    chosen = blanks[rolled % np.uint32(SPACING) == 0] + 1
    ends, start = [], 0
    for end in [*chosen.tolist(), len(data)]:
        while end - start > LONGEST:  # nowhere to cut: at a length, between two characters
            at = start + LONGEST
            while data[at] & 0xC0 == 0x80:
                at -= 1
            ends.append(at)
            start = at
        if end - start >= SHORTEST or end == len(data):
            ends.append(end)
            start = end
    return ends


def _key(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def _chunks(data: bytes) -> list[bytes]:
    start, found = 0, []
    for end in cuts(data):
        found.append(data[start:end])
        start = end
    return found


def _texts(column: pa.Array) -> Iterator[bytes]:
    for value in column:
        yield value.as_buffer().to_pybytes()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = Counter(_key(c) for data in _texts(batch.column(0)) for c in _chunks(data))
        columns = [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["chunk", "n"])


def _shared(keys: list[bytes], words: np.ndarray) -> np.ndarray:
    # The hash that Spark's xxhash64 gives.
    return may_hold(words, np.array([xxhash.xxh64_intdigest(k, 42) for k in keys], np.uint64))


def _repeated(batches: Iterator[pa.RecordBatch], words) -> Iterator[pa.RecordBatch]:
    """Chunks that may occur more than once, with their texts; once a batch."""
    for batch in batches:
        found: dict[bytes, bytes] = {}
        for data in _texts(batch.column(0)):
            chunks = _chunks(data)
            keys = [_key(c) for c in chunks]
            found.update((k, c) for k, c, s in zip(keys, chunks, _shared(keys, words.value)) if s)
        columns = [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["chunk", "text"])


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    """Each chunk once; rows come in order of chunks."""
    coder, last = bpe(vocabulary), None
    for batch in batches:
        keys, ids = [], []
        for chunk, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
            if chunk != last:
                keys.append(chunk)
                ids.append(coder.ids(text.decode()))
            last = chunk
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.binary())], ["chunk", "ids"])


def joint_agrees(coder: Bpe, left: str, right: str) -> bool:
    """Whether the ids of two neighbouring chunks, put side by side, are those of both together.

    No word spans a blank, so the words next to the cut tell.
    """
    tail = left[max(left.rfind(" "), left.rfind("\n")) + 1 :]
    ends = [at for at in (right.find(" "), right.find("\n")) if at >= 0]
    head = right[: min(ends)] if ends else right
    if not tail or not head:
        return True
    return coder.ids(tail + head) == coder.ids(tail) + coder.ids(head)


def segments(data: bytes, shared, coder: Bpe) -> list[tuple[bytes | None, str]]:
    """A text as shared chunks (key, text) and stretches to encode (None, text), all joints exact."""
    chunks = _chunks(data)
    keys = [_key(c) for c in chunks]
    found: list[tuple[bytes | None, str]] = []
    loose = b""
    for chunk, key, is_shared in zip(chunks, keys, shared(keys)):
        whole = True
        try:
            text = chunk.decode()
        except UnicodeDecodeError:
            whole, text = False, ""
        if is_shared and whole and not loose:
            found.append((key, text))
        elif is_shared and whole:
            found += [(None, loose.decode()), (key, text)]
            loose = b""
        else:
            loose += chunk
    if loose:
        found.append((None, loose.decode()))
    at = 0
    while at + 1 < len(found):
        left, right = found[at][1], found[at + 1][1]
        if joint_agrees(coder, left, right):
            at += 1
        else:  # encoded as one, and the joint before is looked at again
            found[at : at + 2] = [(None, left + right)]
            at = max(at - 1, 0)
    return found


def _result(parts: list[bytes], coder: Bpe) -> tuple[int, str, str]:
    ids = np.frombuffer(b"".join(parts), "<u2")
    decoded = coder.text(ids).encode("utf-8", "surrogatepass")
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()


_PART = pa.struct([("place", pa.int32()), ("chunk", pa.binary()), ("ids", pa.binary())])
_TAKEN = {
    "doc_id": pa.int64(),
    "text_key": pa.binary(),
    "n_tokens": pa.int64(),
    "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
    "parts": pa.list_(_PART),
}
_TAKEN_SCHEMA = (
    "doc_id bigint, text_key binary, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
    "parts array<struct<place:int,chunk:binary,ids:binary>>"
)


def _taken(batches: Iterator[pa.RecordBatch], vocabulary: str, words) -> Iterator[pa.RecordBatch]:
    """Texts without shared chunks in full; of others what is encoded here and which chunks are not."""
    coder = bpe(vocabulary)
    for batch in batches:
        rows, open_keys = [], set()
        for doc_id, data in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
            found = segments(data, lambda keys: _shared(keys, words.value), coder)
            if not any(key for key, _ in found):
                rows.append((doc_id, None, *_result([coder.ids(text) for _, text in found], coder), None))
                continue
            key = _key(data)
            parts = None
            if key not in open_keys:
                open_keys.add(key)
                parts = [(i, c, None if c else coder.ids(text)) for i, (c, text) in enumerate(found)]
            rows.append((doc_id, key, None, None, None, parts))
        columns = list(zip(*rows)) or [()] * len(_TAKEN)
        parts = [None if p is None else [dict(zip(("place", "chunk", "ids"), x)) for x in p] for p in columns[-1]]
        arrays = [pa.array(c, t) for c, t in zip([*columns[:-1], parts], _TAKEN.values())]
        yield pa.RecordBatch.from_arrays(arrays, list(_TAKEN))


def _assembled(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    """Texts put together of their parts; rows come in order of text and place."""
    coder, held, parts, last = bpe(vocabulary), None, [], -1
    names = ["text_key", "n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = [pa.binary(), pa.int64(), pa.string(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    for batch in batches:
        rows = []
        for key, place, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _texts(batch.column(2))):
            if key != held:
                if held is not None:
                    rows.append((held, *_result(parts, coder)))
                held, parts, last = key, [], -1
            if place != last:  # copies bring the same parts
                parts.append(ids)
                last = place
        yield batch_of(rows)
    if held is not None:
        yield batch_of([(held, *_result(parts, coder))])


def encode_and_decode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256.

    Digests are of the ids as little-endian 32-bit numbers, and of the text that they decode to. A
    null text is empty, which has no ids and decodes to an empty text. Repeated rows stay, further
    columns are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text)
    texts = known.select("text")
    counts = texts.mapInArrow(_counted, "chunk binary, n bigint").groupBy("chunk").agg(F.sum("n").alias("n"))
    words = spark.sparkContext.broadcast(filter_words(counts.where("n > 1"), "chunk"))
    repeated = texts.mapInArrow(lambda batches: _repeated(batches, words), "chunk binary, text binary")
    sorted_ = repeated.repartition("chunk").sortWithinPartitions("chunk")
    once = stage(sorted_.mapInArrow(lambda batches: _encoded(batches, vocabulary), "chunk binary, ids binary"), "chunks")
    taken = stage(known.mapInArrow(lambda batches: _taken(batches, vocabulary, words), _TAKEN_SCHEMA), "taken")
    parts = taken.where("parts is not null").select("text_key", F.inline("parts"))
    own = parts.where("chunk is null").select("text_key", "place", "ids")
    looked_up = parts.where("chunk is not null").select("text_key", "place", "chunk").join(once, "chunk")
    together = own.unionByName(looked_up.select("text_key", "place", "ids"))
    ordered = together.repartition("text_key").sortWithinPartitions("text_key", "place")
    schema = "text_key binary, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    built = ordered.mapInArrow(lambda batches: _assembled(batches, vocabulary), schema)
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    done = taken.where("text_key is null").select(*columns)
    return done.unionByName(taken.where("text_key is not null").select("doc_id", "text_key").join(built, "text_key").select(*columns))
