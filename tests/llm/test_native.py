import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.chat import format_conversations, read_loss, read_turns
from ledgerloom.llm.sharding import kd_shards

TURNS = [
    (1, 0, "system", "be <turn:user>\nkind</turn>\n"),
    (1, 1, "user", "\\l \\b <and> \\"),
    (1, 2, "user", ""),
    (1, 3, "assistant", "a"),
    (1, 4, "assistant", None),
    (1, 5, "assistant", "ü漢\U0001f600"),
    (2, None, "assistant", "first"),
    (2, 0, None, "x"),
    (2, 0, "us>er\n", "tie"),
    (2, 0, "us>er\n", "tie"),
    (None, 0, "user", "nobody's"),
    (3, 0, "user", None),
]


def _formatted(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    done = format_conversations(turns.withColumns({"turns": F.lit(1), "pieces": F.lit(2), "formatted": F.lit(3)}))
    read = read_turns(F.col("formatted")).alias("read"), read_loss(F.col("formatted"), F.col("loss")).alias("learnt")
    return {r["conv_id"]: r for r in done.select("conv_id", "formatted", "loss", *read).collect()}


def test_conversations_are_read_back(spark):
    found = _formatted(spark, TURNS)
    wanted = defaultdict(list)
    order = sorted(TURNS, key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
    for conv, _, role, text in order:
        wanted[conv].append((role or "", text or ""))
    assert {c: [tuple(t) for t in r["read"]] for c, r in found.items()} == wanted
    for conv, row in found.items():
        assert row["learnt"] == [text for role, text in wanted[conv] if role == "assistant"]
    assert found[1]["formatted"].count("<turn:assistant>") == 1


def test_conversation_of_many_turns(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"<{i}>") for i in range(3000)]
    found = _formatted(spark, rows)[1]
    assert [t["text"] for t in found["read"]] == [f"<{i}>" for i in range(3000)]
    assert "".join(found["learnt"]) == "".join(f"<{i}>" for i in range(1, 3000, 2))


def test_time_grows_with_the_turns(spark):
    """Ten times the turns of one conversation take about ten times as long, to format and to read back."""
    import time

    def seconds(n):
        turns = spark.range(n).selectExpr("1 as conv_id", "id as turn", "if(id % 3 = 0, 'user', 'assistant') as role", "concat('<', id, '> some text of a turn') as text")
        done = format_conversations(turns)
        read = done.select(F.size(read_turns(F.col("formatted"))).alias("n"), F.array_join(read_loss(F.col("formatted"), F.col("loss")), "").alias("learnt"))
        start = time.perf_counter()
        row = read.first()
        took = time.perf_counter() - start
        assert row["n"] == n and row["learnt"] == "".join(f"<{i}> some text of a turn" for i in range(n) if i % 3)
        return took

    seconds(1000)
    least = [min(seconds(n) for _ in range(2)) for n in (1000, 10_000)]
    most = seconds(100_000)
    assert most < 30 * max(least[1], 0.5) and least[1] < 30 * max(least[0], 0.2), (least, most)


def test_spans_of_long_and_wide_texts_are_read_back(spark):
    """Spans that begin and end anywhere in the chunks, with characters beyond 16 bits."""
    texts = ["\U0001f600" * n for n in (0, 1, 1000, 1023, 1024, 1025, 3000)] + ["x<" * 700, "", "\n" * 2048]
    rows = [(1, i, "assistant", t) for i, t in enumerate(texts)] + [(2, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(texts)]
    found = _formatted(spark, rows)
    assert found[1]["learnt"] == texts and found[2]["learnt"] == texts[1::2]


def test_no_conversations(spark):
    assert _formatted(spark, []) == {}


def _check_shards(rows, texts, shards):
    slots, sizes, homes = defaultdict(list), defaultdict(int), defaultdict(set)
    for row, text in zip(rows, texts):
        raw = (text or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert row["law"] == "bytes" and row["grown_shard"] is None and 0 <= row["shard"] < shards
        slots[row["shard"]].append(row["slot"])
        sizes[row["shard"]] += row["size"]
        homes[hashlib.md5(raw).digest()].add(row["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in homes.values())
    return sizes


def test_shards_of_messy_rows(messy):
    texts = {(r["doc_id"], len(r["text"] or "")): r["text"] for r in messy.collect()}
    rows = kd_shards(messy, 5).collect()
    assert len(rows) == messy.count()
    found = [next(t for (i, _), t in texts.items() if i == r["doc_id"] and len((t or "").encode()) + 8 == r["size"]) for r in rows]
    _check_shards(rows, found, 5)


def test_shards_are_near_equal(spark, documents):
    rows = [(i, t, "en", "s") for i, t in documents.items()] * 3
    rows = [(i + 1000 * n, t + f" {i} {n}", l, s) for n, (i, t, l, s) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    found = sorted(kd_shards(df, 6).collect(), key=lambda r: r["doc_id"])
    texts = [t for _, t, _, _ in sorted(rows)]
    sizes = _check_shards(found, texts, 6)
    mean = sum(sizes.values()) / 6
    assert max(len(t.encode()) for t in texts) / mean + 0.05 > max(sizes.values()) / mean - 1


@pytest.mark.parametrize("hot", [[1 / 3], [0.1], [0.3, 0.06, 0.05]])
def test_shards_beside_hot_texts_are_near_equal(spark, hot):
    small = [f"text {i} " + "x" * (150 + i * 7919 % 100) for i in range(4000)]
    texts = list(small)
    for n, share in enumerate(hot):
        texts += [f"hot {n} " + "y" * 200] * int(share / (1 - sum(hot)) * len(small))
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 5}") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(5)
    found = sorted(kd_shards(df, 24).collect(), key=lambda r: r["doc_id"])
    sizes = _check_shards(found, texts, 24)
    assert len(sizes) == 24
    homes = {r["shard"] for r, t in zip(found, texts) if t.startswith("hot")}
    others = [size for shard, size in sizes.items() if shard not in homes]
    assert len(homes) == len(hot) and sum(others) == sum(len(t) + 8 for t in small)
    mean = sum(others) / len(others)
    assert 0.9 * mean < min(others) and max(others) < 1.1 * mean


def test_one_text_only(spark):
    df = spark.createDataFrame([(i, "same", None, None) for i in range(50)], "doc_id bigint, text string, lang string, source string")
    rows = kd_shards(df, 24).collect()
    assert len({r["shard"] for r in rows}) == 1
    assert sorted(r["slot"] for r in rows) == list(range(50))


def test_no_documents(nothing):
    assert kd_shards(nothing).collect() == []
