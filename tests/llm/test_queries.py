"""The registered queries over the smallest test tables, against SQL or plain versions."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from ledgerloom.llm import language, quality, queries, syncmers
from ledgerloom.session import stage
from tests.llm import brute
from tests.llm.conftest import SF_DIR

duckdb = pytest.importorskip("duckdb")


def _run(spark, name):
    return entry.queries()[name](spark, SF_DIR)


def test_all_are_registered():
    names = {*queries.queries(), "pipeline"}
    assert names == {n for n in entry.queries() if n[:2] == "op" and n[2].isdigit()} | {"pipeline"}
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("pages", "conversations"):
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    columns = sorted(d[0] for d in found.description)
    at = [[d[0] for d in found.description].index(c) for c in columns]
    wanted = sorted((tuple(row[i] for i in at) for row in found.fetchall()), key=str)
    assert sorted((tuple(r) for r in _run(spark, name).select(*columns).collect()), key=str) == wanted


def test_op1(spark, documents):
    found = {tuple(r) for r in _run(spark, "op1_ngram_jaccard_join").collect()}
    assert found == set(brute.components(list(documents.items())))


def test_op2(spark):
    rows = {r["vec_id"]: np.array(r["embedding"], np.float32).astype(float) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()}
    got = defaultdict(list)
    for r in sorted(_run(spark, "op2_multiprobe_neighbours").collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    assert set(got) == {i for i in rows if i % 100 == 0}
    hits = 0
    for q, listed in got.items():
        exact = sorted((float(np.sqrt(((v - rows[q]) ** 2).sum())), i) for i, v in rows.items() if i != q)
        assert len(listed) == 10 and listed == sorted(listed)
        hits += len({i for _, i in listed} & {i for _, i in exact[:10]})
    assert hits >= 0.9 * 10 * len(got)


def test_op3(spark, documents):
    ids, wanted = list(documents), set()
    for at, i in enumerate(ids):
        text, following = documents[i], documents[ids[(at + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        a, b, c = map(syncmers.fingerprint, (text, edited, following))
        wanted.add((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, syncmers.likeness(a, b), syncmers.likeness(a, c)))
    assert {tuple(r) for r in _run(spark, "op3_syncmer_fingerprints").collect()} == wanted


def _library(vocabulary):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_op4(spark, documents):
    tokenizer, wanted = _library("word_bpe_49k"), set()
    for i, text in documents.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False).encode()
        wanted.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert {tuple(r) for r in _run(spark, "op4_bpe").collect()} == wanted


def _check_packing(rows, texts):
    tokenizer, wanted, total = _library("byte_bpe_50k"), set(), 0
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        first = len(ids) % 2048 or 2048
        starts = [0, *range(first, len(ids), 2048)]
        for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            wanted.add((i, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert {tuple(r[n] for n in names) for r in rows} == wanted and len(rows) == len(wanted)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 2048
    assert len(sequences) <= -(-total // 2048) + 2


def test_op6(spark, documents):
    _check_packing(_run(spark, "op6_best_fit_packing").collect(), documents)


@pytest.mark.parametrize("name", ["op5_quality_classifier", "op7_language_id"])
def test_held_out_rows(spark, documents, name):
    found = _run(spark, name).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(documents)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1


def test_op10(spark, documents):
    found = _run(spark, "op10_kd_sharding").collect()
    assert sorted(r["doc_id"] for r in found) == sorted(documents)
    slots, homes = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        homes[documents[r["doc_id"]]].add(r["shard"])
        assert r["size"] == len(documents[r["doc_id"]].encode()) + 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < 24
    assert all(len(h) == 1 for h in homes.values())
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)} and len(slots) == 24
    # Near equal, as far as whole groups allow: no shard is off by more than its largest group.
    sizes, groups = defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r["shard"]] += r["size"]
        groups[documents[r["doc_id"]]] += r["size"]
    fair, largest = sum(sizes.values()) / 24, max(groups.values())
    assert all(abs(size - fair) <= max(largest, 0.1 * fair) for size in sizes.values())


def test_pipeline(spark, documents, monkeypatch):
    """What every stage of a run keeps, against a plain version of it."""
    kept_by = {}

    def recorded(df, label):
        kept_by[label] = stage(df, label)
        return kept_by[label]

    monkeypatch.setattr(corpus_pipeline, "stage", recorded)
    rows = _run(spark, "pipeline").collect()
    assert list(kept_by) == ["language_id", "quality_classifier", "ngram_jaccard_join", "best_fit_packing"]
    docs, kept = spark.read.parquet(f"{SF_DIR}/documents.parquet"), dict(documents)
    for name, left in list(kept_by.items())[:-1]:
        if name == "language_id":
            model = language.fit_languages(docs)
            kept = {i: t for i, t in kept.items() if model.predict(t)[1] >= language.LEAST_SCORE}
        elif name == "quality_classifier":
            model = quality.fit_quality(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
            scores = model.score(quality.text_features(pa.array(list(kept.values()))))
            kept = {i: t for (i, t), s in zip(kept.items(), scores) if s >= quality.THRESHOLD}
        else:
            groups = {i: c for i, _, c in brute.components(list(kept.items()), corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_SHARE)}
            kept = {i: t for i, t in kept.items() if groups[i] == i}
        assert left.columns == docs.columns
        assert sorted(r["doc_id"] for r in left.select("doc_id").collect()) == sorted(kept), name
        docs = left
    assert 0 < len(kept) < len(documents)
    _check_packing(rows, kept)
