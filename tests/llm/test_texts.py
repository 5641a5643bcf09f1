import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm import bpe, ngram_join, packing, shingles, syncmers
from ledgerloom.llm.components import connected_components
from tests.llm import brute
from tests.llm.conftest import BASE, LONG, MESSY, prose


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


# --- n-gram join ---


def test_shingle_sets_are_those_of_the_words():
    texts = [t for _, t, _, _ in MESSY] + ["a b c", "a b c d", "A\x0bb\x0cC d", "é b c d e"]
    found = list(shingles.shingle_sets(pa.array(texts)))
    wanted = [brute.shingles(t) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in wanted]
    for i, a in enumerate(found):
        for j, b in enumerate(found):
            assert len(np.intersect1d(a, b)) == len(wanted[i] & wanted[j])


@pytest.mark.parametrize("size", [3, 7, 12, 13, 29, 36, 37, 40, 42, 44, 51, 60, 147, 399, 430, 700])
def test_linked_sets_share_a_signature(size):
    random_ = np.random.default_rng(size)
    for _ in range(60):
        a = np.unique(random_.integers(0, 2**63, size, dtype=np.uint64))
        b = list(a)
        # As many changes as the similarity allows: some dropped, some replaced, some added.
        while True:
            c = list(b)
            kind = random_.integers(3)
            if kind < 2 and len(c) > 1:
                c.pop(random_.integers(len(c)))
            if kind > 0:
                c.append(random_.integers(0, 2**63, dtype=np.uint64))
            common = len(set(c) & set(a.tolist()))
            if not ngram_join.similar(common, len(a), len(c)):
                break
            b = c
        b = np.unique(np.array(b, np.uint64))
        if not np.array_equal(a, b):
            _assert_met(ngram_join._signatures(a), ngram_join._signatures(b))


def _assert_met(a, b):
    """Two signatures in common, or a sure one."""
    common = np.intersect1d(a, b)
    assert len(common) + int((common & np.uint64(1)).sum()) >= 2


def test_spanning_links_connect_what_links_connect():
    random_ = random.Random(4)
    base = [random_.getrandbits(63) for _ in range(100)]
    sets = []
    for _ in range(60):
        own = [x if random_.random() > 0.06 else random_.getrandbits(63) for x in base]
        sets.append(np.unique(np.array(own, np.uint64)))
    forest, all_ = ngram_join._Forest(60), ngram_join._Forest(60)
    for i, j in ngram_join.spanning_links(sets, np.zeros(60, int)):
        forest.join(i, j)
    for i in range(60):
        for j in range(i):
            if ngram_join.similar(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j])):
                all_.join(i, j)
    same = [[f.root(i) == f.root(j) for i in range(60) for j in range(60)] for f in (forest, all_)]
    assert same[0] == same[1] and not all(same[0])


def test_components_of_messy_rows(messy):
    found = ngram_join.jaccard_components(messy).collect()
    assert _sorted(tuple(r) for r in found) == _sorted(brute.components([(i, t) for i, t, _, _ in MESSY]))


@pytest.mark.parametrize("paired, compared", [(2, 8192), (32, 8192), (2, 3)])
def test_components_of_many_near_copies(spark, monkeypatch, paired, compared):
    """A chain and a cloud of near copies, in blocks so small that clusters have many of them, and with
    signatures whose sets are paired with the first one only."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 7)
    monkeypatch.setattr(ngram_join, "PAIRED", paired)
    monkeypatch.setattr(ngram_join, "COMPARED", compared)
    random_ = random.Random(8)
    rows = []
    for i in range(60):
        words = BASE.split()
        for _ in range(i % 9):
            words[random_.randrange(len(words))] = f"edit{random_.random()}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, prose(50, 200 + 6 * i)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = ngram_join.jaccard_components(df).collect()
    assert _sorted(tuple(r) for r in found) == _sorted(brute.components(rows))


def test_sketches_differ_no_more_than_sets():
    random_ = np.random.default_rng(2)
    for _ in range(300):
        sizes = random_.integers(1, 10 ** random_.integers(1, 5), 2)
        base = random_.integers(0, 2**63, int(sizes.max()), dtype=np.uint64)
        a, b = (np.unique(np.r_[base[: n // 2], random_.integers(0, 2**63, n - n // 2, dtype=np.uint64)]) for n in sizes.tolist())
        sketches = [np.frombuffer(ngram_join.sketch(s), np.uint8)[None] for s in (a, b)]
        assert ngram_join._apart(*sketches)[0] <= len(np.setxor1d(a, b))


def test_near_links_connect_what_near_sets_connect():
    random_ = np.random.default_rng(9)
    base = [random_.integers(0, 2**63, n, dtype=np.uint64) for n in (30, 130, 140, 600, 700)]
    sets = []
    for _ in range(80):
        own = base[random_.integers(5)].copy()
        gone = random_.integers(0, len(own), int(len(own) * random_.uniform(0, 0.3)))
        own[gone] = random_.integers(0, 2**63, len(gone), dtype=np.uint64)
        sets.append(np.unique(own[: random_.integers(len(own) * 3 // 4, len(own) + 1)]))
    sizes, sketches = np.array([len(s) for s in sets]), [np.frombuffer(ngram_join.sketch(s), np.uint8) for s in sets]
    some, all_ = ngram_join._Forest(80), ngram_join._Forest(80)
    for i, j in ngram_join.near_links(sizes, sketches, 80):
        some.join(i, j)
    for i in range(80):
        for j in range(i):
            apart = ngram_join._apart(sketches[i][None], sketches[j][None])[0]
            if ngram_join.similar(min(sizes[i], sizes[j]), sizes[i], sizes[j], 80) and apart <= ngram_join._most_different(sizes[i] + sizes[j], 80):
                all_.join(i, j)
    same = [[f.root(i) == f.root(j) for i in range(80) for j in range(80)] for f in (some, all_)]
    assert same[0] == same[1] and not all(same[0])


def test_sketches_tell_sets_with_a_common_passage_apart():
    random_ = np.random.default_rng(4)
    passage = random_.integers(0, 2**63, 25, dtype=np.uint64)
    sizes = random_.integers(90, 600, 300)
    sets = [np.unique(np.r_[passage, random_.integers(0, 2**63, n - 25, dtype=np.uint64)]) for n in sizes.tolist()]
    sketches = [np.frombuffer(ngram_join.sketch(s), np.uint8) for s in sets]
    assert len(list(ngram_join.near_links(sizes, sketches, 80))) < 3


def test_sets_of_a_cluster_are_not_brought_together_with_all_others(spark, monkeypatch):
    """Texts with a common passage, in one cluster for it, and near copies of some: few sets are moved more than once."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 7)
    monkeypatch.setattr(ngram_join, "PAIRED", 2)
    monkeypatch.setattr(ngram_join, "COMPARED", 3)
    rows = [(i, f"{prose(1, 12)} {prose(400 + i, 14)}") for i in range(120)]
    rows += [(200 + i, f"{text} end") for i, text in rows[::6]]
    moved, compared = [], ngram_join._compared

    def counted(docs, dealt, words, share):
        moved.append(dealt.count())
        return compared(docs, dealt, words, share)

    monkeypatch.setattr(ngram_join, "_compared", counted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = ngram_join.jaccard_components(df).collect()
    assert _sorted(tuple(r) for r in found) == _sorted(brute.components(rows))
    assert len({c for _, _, c in brute.components(rows)}) == 120
    assert 100 < moved[0] and sum(moved) < 2 * len(rows)


@pytest.mark.parametrize("rows", [1, 3, 50, 1000])
def test_candidates_of_signatures_over_batches(rows):
    """Small groups are paired, of large ones all with the first, wherever batches end."""
    random_ = np.random.default_rng(5)
    groups = {7: range(200), 8: [1, 2, 2, 5], 9: [4], 11: random_.integers(0, 10**6, 33).tolist(), 12: [3, 3], 13: range(32)}
    table = sorted((s, int(n)) for s, nodes in groups.items() for n in nodes)
    batches = [
        pa.RecordBatch.from_arrays([pa.array([r[i] for r in table[at : at + rows]], pa.int64()) for i in range(2)], ["signature", "node"])
        for at in range(0, len(table), rows)
    ]
    wanted = Counter()
    for signature, nodes in groups.items():
        nodes = sorted(set(map(int, nodes)))
        whole = len(nodes) > ngram_join.PAIRED
        wanted.update({(a, b, int(whole)): 1 + signature % 2 for i, a in enumerate(nodes[: 1 if whole else None]) for b in nodes[i + 1 :]})
    found = Counter()
    for batch in ngram_join._candidates(iter(batches)):
        found.update({tuple(r.values())[:3]: r["shared"] for r in batch.to_pylist()})
    # Of a large group the first pairs are told again when its end is seen.
    assert set(found) == set(wanted) and all(found[p] == n for p, n in wanted.items() if not p[2])


def test_one_document_of_each_group_stays(messy):
    left = ngram_join.one_of_each_group(messy)
    assert left.columns == messy.columns
    groups = {i: c for i, _, c in brute.components([(i, t) for i, t, _, _ in MESSY]) if i is not None}
    kept = [r["doc_id"] for r in left.collect()]
    assert Counter(i for i in kept if i is not None) == Counter(set(groups.values()))
    assert kept.count(None) == 2


@pytest.mark.parametrize("size", [3, 4, 5, 12, 29, 36, 37, 40, 44, 45, 46, 47, 51, 60, 147, 320, 399, 401, 500, 700, 3000, 12000])
def test_sets_of_similarity_80_share_a_signature(size):
    random_ = np.random.default_rng(size)
    for _ in range(60):
        a = random_.integers(0, 2**63, size, dtype=np.uint64)
        gone = size // 5
        b = a[gone:] if random_.integers(2) else np.r_[a[size // 9 :], random_.integers(0, 2**63, size // 9, dtype=np.uint64)]
        assert ngram_join.similar(len(np.intersect1d(a, b)), len(a), len(b), 80)
        if not np.array_equal(a, b):
            signed = [ngram_join._signatures(np.unique(s), 80) for s in (a, b)]
            _assert_met(*signed)


def test_stage_finds_near_copies_of_similarity_80_to_85(spark):
    """400 words with one stretch of 30 to 40 replaced: 0.80 to 0.85 by five words, below 0.85 by four."""
    rows = []
    for at, stretch in enumerate(range(30, 44)):
        words = prose(300 + at, 400).split()
        rows.append((2 * at, " ".join(words)))
        rows.append((2 * at + 1, " ".join(words[:150] + [f"new{at}x{i}" for i in range(stretch)] + words[150 + stretch :])))
    groups = brute.components(rows, 5, 80)
    wanted = sorted(i for i, _, c in groups if i == c)
    assert len(rows) // 2 < len(wanted) < len(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert sorted(r["doc_id"] for r in corpus_pipeline.ngram_jaccard_join(spark, docs, "").collect()) == wanted
    found = ngram_join.jaccard_components(docs, 5, 80).collect()
    assert _sorted(tuple(r) for r in found) == _sorted(groups)
    # Operator 1's own settings link the shortest stretches at most.
    found = ngram_join.jaccard_components(docs).collect()
    assert _sorted(tuple(r) for r in found) == _sorted(brute.components(rows))


def test_texts_of_one_doc_id_are_decided_by_themselves(spark):
    text = [prose(70 + i, 120) for i in range(7)]
    near = [t.rsplit(" ", 2)[0] + " other end" for t in text]
    rows = [(1, text[0]), (5, near[0]), (5, text[1]), (5, None), (5, ""), (8, text[2]), (8, text[2])]
    rows += [(10, text[3]), (10, text[4]), (12, near[3]), (13, near[4]), (14, text[5]), (14, near[5]), (15, text[6].upper()), (15, text[6])]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    left = Counter(tuple(r) for r in ngram_join.one_of_each_group(df).collect())
    sure = Counter([(1, text[0]), (5, text[1]), (5, None), (5, ""), (8, text[2]), (10, text[3]), (10, text[4])])
    assert {row: n for row, n in left.items() if row[0] < 14} == sure
    assert [sum(n for (i, _), n in left.items() if i == doc_id) for doc_id in (14, 15)] == [1, 1]


def test_no_documents(nothing):
    assert ngram_join.jaccard_components(nothing).collect() == []
    assert ngram_join.one_of_each_group(nothing).collect() == []


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 100)]
    found = {tuple(r) for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {(i, 0) for i in range(41)} | {(90, 90), (100, 90)}


# --- fingerprints ---


def test_fingerprints_where_one_doc_id_holds_a_third_of_all_rows(spark, monkeypatch):
    """Its rows go to several buckets by their texts, and each is compared with the row that follows it."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(syncmers, "BUCKETS", (24, 24))
    rows = [(i, prose(i, 20)) for i in range(400)] + [(7, prose(1000 + i, 15)) for i in range(300)] + [(None, prose(2000 + i, 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    hot = F.when((F.col("doc_id") == 7) | F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(0)
    ordered = df.orderBy(F.col("doc_id").asc_nulls_first(), hot, "text").collect()
    wanted = []
    for at, (i, text) in enumerate(map(tuple, ordered)):
        following = ordered[(at + 1) % len(ordered)]["text"]
        wanted.append((i, hashlib.sha256(syncmers._edited(text, following).encode()).hexdigest(), syncmers.fingerprint(text)))
    got = [(r["doc_id"], r["edited_sha256"], r["fingerprint"]) for r in syncmers.fingerprints(df).collect()]
    assert _sorted(got) == _sorted(wanted)


def test_syncmers_are_those_of_the_definition():
    text = BASE[:300] + "漢字"
    hashes, places = syncmers.anchors(text)
    padded = [0x110000] * (syncmers.K - 1) + [ord(c) for c in text] + [0x110000] * (syncmers.K - 1)
    grams = {}
    for i in range(len(padded) - syncmers.S + 1):
        h = 0
        for x in padded[i : i + syncmers.S]:
            h = (h * 0x01000193 + x) % 2**32
        grams[i] = int(syncmers._mix(np.array([h], np.uint32))[0])
    width = syncmers.K - syncmers.S + 1
    wanted = [i for i in range(len(padded) - syncmers.K + 1) if min(grams[i + j] for j in range(width)) in (grams[i], grams[i + width - 1])]
    assert places.tolist() == wanted
    kmers = [tuple(padded[i : i + syncmers.K]) for i in wanted]
    assert len(set(zip(kmers, hashes.tolist()))) == len(set(kmers))


def test_likeness_follows_the_shared_part():
    for n in (30, 100, 1000, 5000):
        text, other = prose(n, n), prose(n + 1, n)
        a, b = syncmers.fingerprint(text), syncmers.fingerprint(text[: len(text) * 3 // 4] + other[: len(text) // 4])
        assert 0.5 < syncmers.likeness(a, b) < 0.95
        assert syncmers.likeness(a, syncmers.fingerprint(other)) < 0.3
        assert syncmers.likeness(a, a) == 1 and syncmers.likeness(b, a) == syncmers.likeness(a, b)
    assert syncmers.likeness("", "") == 1 and syncmers.likeness(syncmers.fingerprint("a"), "") == 0


def test_small_edits_of_long_texts_are_told():
    """One word in 500 edited: never the same, and like the definition says over all anchors."""
    for seed in range(8):
        words = prose(seed, 2500).split()
        changed = [f"other{i}" if i % 500 == 250 else w for i, w in enumerate(words)]
        a, b = (syncmers.fingerprint(" ".join(w)) for w in (words, changed))
        assert 0.98 < syncmers.likeness(a, b) < 1


def test_likeness_of_a_replaced_quarter_is_no_estimate():
    found = []
    for seed in range(20):
        text, other = prose(seed, 2000), prose(seed + 100, 2000)
        edited = text[: len(text) * 3 // 4] + other[: len(text) // 4]
        found.append(syncmers.likeness(syncmers.fingerprint(text), syncmers.fingerprint(edited)))
    assert np.std(found) < 0.02 and abs(np.mean(found) - 0.75) < 0.02


def test_order_counts():
    words = BASE.split()
    turned = " ".join(words[60:] + words[:60])
    assert syncmers.likeness(syncmers.fingerprint(BASE), syncmers.fingerprint(turned)) < 0.8


def test_fingerprints_of_messy_rows(messy):
    found = syncmers.fingerprints(messy).collect()
    rows = sorted(((i, t or "") for i, t, _, _ in MESSY), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    wanted = []
    for at, (doc_id, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        a, b, c = map(syncmers.fingerprint, (text, edited, following))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        wanted.append((doc_id, len(text), digest, a, b, syncmers.likeness(a, b), syncmers.likeness(a, c)))
    assert _sorted(tuple(r) for r in found) == _sorted(wanted)


def test_one_document_follows_itself(spark, nothing):
    row = syncmers.fingerprints(spark.createDataFrame([(4, "abcdefgh")], "doc_id bigint, text string")).first()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    assert syncmers.fingerprints(nothing).collect() == []


# --- BPE ---


def _library(vocabulary):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _odd_texts(n):
    random_ = random.Random(n)
    pool = [chr(c) for c in range(0x250)] + list("漢字ÅΣς́ͅﬁ \U0001f600") + ["<|endoftext|>", "<|startoftext|>"]
    blanks = [" ", "  ", "\n", "\t", "\x85", "\x1c", " "]
    for _ in range(n):
        yield "".join(random_.choice([random_.choice(pool), random_.choice(blanks), random_.choice("abc'stredlvmABC 019<|>")]) for _ in range(random_.randrange(40)))


def test_ids_are_those_of_the_library():
    words, bytes_ = _library("word_bpe_49k"), _library("byte_bpe_50k")
    ours, others = bpe.bpe("word_bpe_49k"), packing.byte_bpe("byte_bpe_50k")
    for text in _odd_texts(3000):
        ids = words.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ours.ids(text), "<u2").tolist() == ids
        assert ours.text(np.array(ids)) == words.decode(ids, skip_special_tokens=False)
        assert others.ids(text).tolist() == bytes_.encode(text, add_special_tokens=False).ids


def test_segments_join_to_the_ids_of_the_whole():
    coder, tokenizer = bpe.bpe("word_bpe_49k"), _library("word_bpe_49k")
    odd = list(_odd_texts(400))
    texts = [LONG, "x" * 30_000, "漢" * 9_000, "ab" * 5000 + " " + "<|endoftext|>" * 900, "".join(odd), " ".join(odd)]
    for text in texts:
        data = text.encode()
        assert b"".join(bpe._chunks(data)) == data
        for shared in (lambda keys: [True] * len(keys), lambda keys: [i % 2 == 0 for i in range(len(keys))]):
            parts = bpe.segments(data, shared, coder)
            assert "".join(t for _, t in parts) == text
            ids = b"".join(coder.ids(t) for _, t in parts)
            assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_equal_passages_are_cut_alike():
    passage = prose(3, 400)
    one, two = (set(bpe._chunks((start + passage).encode())) for start in (prose(4, 77) + " ", prose(6, 201) + " "))
    assert sum(map(len, one & two)) > len(passage) / 2


def test_documents_are_encoded_and_decoded(messy):
    tokenizer = _library("word_bpe_49k")
    wanted = []
    for doc_id, text, _, _ in MESSY:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False).encode()
        wanted.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert _sorted(tuple(r) for r in bpe.encode_and_decode(messy).collect()) == _sorted(wanted)


def test_nothing_to_encode(nothing):
    assert bpe.encode_and_decode(nothing).collect() == []


# --- packing ---


@pytest.mark.parametrize("seed", range(6))
def test_plan_gives_every_piece_one_place(seed):
    random_ = random.Random(seed)
    counts = Counter(min(64, int(random_.paretovariate(0.6))) for _ in range(random_.choice([1, 50, 4000])))
    plan = packing.plan_best_fit(dict(counts), 64)
    sequences = defaultdict(list)
    for length, low, high, first, offset in plan.tolist():
        for i in range(high - low):
            sequences[first + i].append((offset, length))
    assert Counter(length for s in sequences.values() for _, length in s) == counts
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    total = sum(length * n for length, n in counts.items())
    assert len(sequences) <= max(-(-total // 64) * 1.1 + 1, sum(n for length, n in counts.items() if length > 32) + 1)


def test_packed_pieces_are_those_of_the_documents(messy):
    tokenizer = _library("byte_bpe_50k")
    rows = packing.pack_documents(messy, limit=256, with_ids=True).collect()
    wanted = Counter()
    for doc_id, text, _, _ in MESSY:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        start, end, piece = 0, len(ids) % 256 or 256, 0
        while start < len(ids):
            raw = np.array(ids[start:end], "<u4").tobytes()
            wanted[(doc_id, piece, start, end - start, zlib.crc32(raw), raw)] += 1
            start, end, piece = end, end + 256, piece + 1
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    assert Counter(tuple(bytes(r[n]) if n == "ids" else r[n] for n in names) for r in rows) == wanted
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 256


def test_nothing_to_pack(nothing):
    assert packing.pack_documents(nothing).collect() == []
