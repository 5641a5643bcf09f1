"""Token ids in files of grammars: exact round trips, random places, order and repeated runs."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry
from ledgerloom.llm import token_files
from ledgerloom.llm.token_files import Shard, TokenFile, compress, read_token_files, shard_bytes, write_token_files
from ledgerloom.session import fresh_path
from tests.llm.conftest import MESSY, SF_DIR


def _ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def test_op13(spark, documents):
    wanted, start = set(), 0
    for i, text in documents.items():
        ids = _ids(text)
        wanted.add((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = entry.queries()["op13_token_files"](spark, SF_DIR).collect()
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=1, max_size=60), min_size=1, max_size=12), st.booleans())
def test_shard(docs, wide):
    """Every document and any range of places come back, for vocabularies that take two or four bytes."""
    ids = np.concatenate([np.array(d, np.uint32) for d in docs]) + np.uint32(70_000 * wide)
    shard = Shard.parse(shard_bytes(list(range(len(docs))), [len(d) for d in docs], ids, False))
    back = [(k, x.tolist()) for k, x in shard.documents()]
    assert back == [(k, [i + 70_000 * wide for i in d]) for k, d in enumerate(docs)]
    for start in range(0, len(ids), 7):
        for stop in (start, start + 1, start + 9, len(ids)):
            assert (shard.ids(start, min(stop, len(ids))) == ids[start:stop]).all()


def test_grammar():
    """Frequent pairs become rules of rules, which say how long they are; documents keep their ends."""
    ids = np.tile(np.array([5, 6, 7, 8], np.uint32), 500)
    grammar, symbols, ends = compress(ids, np.array([1000, 2000]))
    assert len(symbols) < 60 and len(ends) == 2 and grammar.sizes[symbols[: ends[0]]].sum() == 1000
    assert (grammar.expand(symbols) == ids).all() and grammar.lengths.max() >= 32
    rules = [len(grammar.expand(np.array([grammar.base + i]))) for i in range(len(grammar.left))]
    assert rules == grammar.lengths.tolist()
    run, symbols, _ = compress(np.full(4096, 3, np.uint32), np.array([4096]))
    assert len(symbols) < 64 and (run.expand(symbols) == 3).all()


def test_files(spark, messy):
    """Any rows, in shards and files so small that documents go on from one shard to the next."""
    folder = fresh_path(spark, "token-files")
    write_token_files(messy, folder, shard_ids=1000, file_ids=5000)
    files = spark.read.parquet(f"{folder}/{token_files.MANIFEST}").orderBy("partition", "number").collect()
    assert len(files) > 2 and sum(f["documents"] for f in files) == len(MESSY)
    rows = sorted(read_token_files(spark, folder, with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:i]) for i in range(len(rows))]
    keys = [r["doc_id"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    wanted = sorted(((i, _ids(t).tobytes()) for i, t, *_ in MESSY), key=str)
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in rows), key=str) == wanted
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    stream = np.frombuffer(b"".join(r["ids"] for r in rows), "<u4")
    before = 0
    for f in files:
        with TokenFile(folder, f["path"]) as file:
            for start in range(0, f["ids"], 977):
                stop = min(start + 1500, f["ids"])
                assert (file.ids(start, stop) == stream[before + start : before + stop]).all()
        before += f["ids"]
    with pytest.raises(FileExistsError):
        write_token_files(messy, folder)


def test_leftovers_of_lost_attempts_are_not_read(spark, messy):
    folder = fresh_path(spark, "token-files")
    write_token_files(messy, folder)
    path = folder.removeprefix("file:")
    with open(f"{path}/000000-00000-lost{token_files.SUFFIX}", "wb") as lost:
        lost.write(b"half a file")
    assert read_token_files(spark, folder).count() == len(MESSY)


def test_no_rows(spark, nothing):
    folder = fresh_path(spark, "token-files")
    write_token_files(nothing, folder)
    assert read_token_files(spark, folder).collect() == []
