"""Tokens of two vocabularies over the same texts, against the definition."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from ledgerloom.llm import alignment
from tests.llm.conftest import MESSY, SF_DIR

COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def _byte_of():
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        self.byte_of = _byte_of()

    def tokens(self, text):
        a = [(i, bytes(self.byte_of[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        return a, b

    def links(self, text):
        """(n_a, n_b, groups, linked pairs) of a text, every byte looked at."""
        if not text:
            return 0, 0, [], []
        a, b = self.tokens(text)
        data = (" " + text).encode()
        if b"".join(t for _, t in a) != data or b"".join(t for _, t in b) != data:
            return 0, 0, [], []
        cover_a = [k for k, (_, t) in enumerate(a) for _ in t]
        cover_b = [k for k, (_, t) in enumerate(b) for _ in t]
        pairs = [(a[i][0], b[j][0]) for i, j in sorted(set(zip(cover_a, cover_b)))]
        groups, at_a, at_b = [], 0, 0
        for p in range(len(data)):
            last = p + 1 == len(data)
            if last or cover_a[p] != cover_a[p + 1] and cover_b[p] != cover_b[p + 1]:
                to_a, to_b = cover_a[p] + 1, cover_b[p] + 1
                groups.append(f"{','.join(str(i) for i, _ in a[at_a:to_a])}|{','.join(str(i) for i, _ in b[at_b:to_b])}")
                at_a, at_b = to_a, to_b
        return len(a), len(b), groups, pairs

    def statistics(self, rows):
        found = [(i, *self.links(text)) for i, text in rows]
        counts = Counter(p for *_, pairs in found for p in set(pairs))
        most = defaultdict(int)
        for (a, _), n in counts.items():
            most[a] = max(most[a], n)
        out = []
        for i, n_a, n_b, groups, pairs in found:
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
            best = sum(counts[p] == most[p[0]] for p in pairs)
            out.append((i, n_a, n_b, len(groups), len(pairs), best, sum(counts[p] for p in pairs), digest))
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def _rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_op12(spark, documents, plain):
    found = _rows(entry.queries()["op12_cross_tokenizer_alignment"](spark, SF_DIR))
    assert found == sorted(plain.statistics(documents.items()), key=str)


TEXTS = MESSY[:9] + MESSY[11:] + [
    (20, " two  blanks ", None, None),
    (21, "a▁b", None, None),
    (22, "\x00\t\n control  \r\n", None, None),
    (23, "</s><s> <unk> <0x41>", None, None),
    (23, "</s><s> <unk> <0x41>", None, None),
    (24, "é", None, None),
    (25, " ", None, None),
]


@pytest.mark.parametrize("frequent", [0, 20, 1 << 21])
def test_any_text(spark, plain, frequent):
    """Also where the commonest pairs alone, or none, are broadcast."""
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string, row string, pairs string").repartition(3)
    wanted = sorted(plain.statistics([(r[0], r[1]) for r in TEXTS]), key=str)
    assert any(w[0] == 21 and w[1:] == (0, 0, 0, 0, 0, 0, "") for w in wanted)
    assert _rows(alignment.alignment_statistics(docs, frequent_pairs=frequent)) == wanted


def test_no_rows(spark, nothing):
    assert _rows(alignment.alignment_statistics(nothing)) == []


def test_windows_are_forgotten(monkeypatch):
    """What a block gives does not depend on what the worker remembers."""
    worker = alignment.aligner(alignment.VOCABULARY_A, alignment.VOCABULARY_B)
    texts = [r[1] for r in TEXTS]
    rows, *pairs = worker.align(texts)
    monkeypatch.setattr(alignment, "REMEMBERED", 0)
    again, *forgotten = worker.align(texts)
    assert rows == again and all((a == b).all() for a, b in zip(pairs, forgotten))
