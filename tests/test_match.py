"""The substring join against a comparison of every pair, on frames small enough for that."""

import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators.match import BROADCAST_BYTES, finder, longest_substring_join, substring_join
from ledgerloom.session import stage

LEFT = "k bigint, name string"
RIGHT = "nome string, nota int"


def brute(left, right):
    clean = lambda s: None if s is None else s.strip(" ").upper()
    out = []
    for k, name in left:
        hits = [r for r in right if name is not None and r[0] is not None and clean(r[0]) in clean(name)]
        out += [(k, name, *r) for r in hits] or [(k, name, None, None)]
    return Counter(out)


def brute_longest(left, right):
    clean = lambda s: s.strip(" ").upper()
    out = []
    for k, name in left:
        hits = [r for r in right if name is not None and r[0] is not None and clean(r[0]) in clean(name)]
        hits.sort(key=lambda r: (-len(clean(r[0])), clean(r[0]), r[0], r[1]))
        out.append((k, name, hits[0][1] if hits else None))
    return Counter(out)


def joined(spark, left, right, **options):
    frames = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    return Counter(map(tuple, substring_join(*frames, "name", "nome", **options).select("k", "name", "nome", "nota").collect()))


CASES = [(1, "x holding ING "), (2, "HOLDING"), (3, "Itaú"), (4, None), (5, ""), (6, "Banco Votorantim"), (7, "A")]
NAMES = [("ING", 1), ("ITAU", 2), (None, 3), ("  ", 4), ("VOTORANTIM", 5), ("Votorantim", 6), ("a", 7)]


@pytest.mark.parametrize("broadcast_bytes", [BROADCAST_BYTES, -1])
def test_named_cases(spark, broadcast_bytes):
    got = joined(spark, CASES, NAMES, broadcast_bytes=broadcast_bytes)
    assert got == brute(CASES, NAMES)
    assert (1, "x holding ING ", "ING", 1) in got and (2, "HOLDING", "ING", 1) in got
    assert (3, "Itaú", "ITAU", 2) not in got
    assert (4, None, None, None) in got
    assert (5, "", "  ", 4) in got
    assert {(6, "Banco Votorantim", "VOTORANTIM", 5), (6, "Banco Votorantim", "Votorantim", 6)} <= set(got)


def test_columns_may_be_called_like_the_steps(spark):
    left = spark.createDataFrame([("BANCO ALFA", 1)], "name string, needle int")
    right = spark.createDataFrame([("alfa", 2)], "nome string, seed int")
    assert [tuple(r) for r in substring_join(left, right, "name", "nome").collect()] == [("BANCO ALFA", 1, "alfa", 2)]


def test_without_any_right_name(spark):
    assert joined(spark, CASES, [(None, 1)]) == brute(CASES, [])
    assert joined(spark, CASES, [(" ", 1)]) == brute(CASES, [(" ", 1)])


words = st.text(alphabet="AbÇ -", min_size=0, max_size=20)
slow = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@slow
@given(
    names=st.lists(st.one_of(st.none(), words), min_size=1, max_size=30),
    needles=st.lists(st.one_of(st.none(), words.map(lambda w: w[:6]), words), min_size=1, max_size=20),
    parts=st.integers(1, 5),
    broadcast_bytes=st.sampled_from([BROADCAST_BYTES, -1]),
)
def test_equals_all_pairs(spark, names, needles, parts, broadcast_bytes):
    left, right = list(enumerate(names)), [(n, i) for i, n in enumerate(needles)]
    frames = spark.createDataFrame(left, LEFT).repartition(parts), spark.createDataFrame(right, RIGHT)
    got = substring_join(*frames, "name", "nome", broadcast_bytes=broadcast_bytes).select("k", "name", "nome", "nota")
    assert Counter(map(tuple, got.collect())) == brute(left, right)
    best = longest_substring_join(*frames, "name", "nome", broadcast_bytes=broadcast_bytes).select("k", "name", "nota")
    assert Counter(map(tuple, best.collect())) == brute_longest(left, right)


def test_names_that_begin_alike(spark):
    """Many long names with one beginning give candidates by length and not by pair."""
    rng = random.Random(7)
    stem = "COOPERATIVA DE CREDITO "
    right = [(stem + "".join(rng.choices("ABC", k=4)), i) for i in range(60)]
    left = [(i, f"X {stem}{''.join(rng.choices('ABC', k=6))}") for i in range(60)]
    assert joined(spark, left, right, broadcast_bytes=-1) == brute(left, right)


def test_no_pairwise_join_in_the_plan(spark):
    left = spark.createDataFrame(CASES, LEFT)
    right = spark.createDataFrame(NAMES, RIGHT)
    plan = substring_join(left, right, "name", "nome", broadcast_bytes=-1)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_one_name_on_a_third_of_the_rows(spark):
    left = spark.range(9000).select(
        F.col("id").alias("k"), F.when(F.col("id") < 3000, "BANCO ALFA").otherwise(F.concat(F.lit("B"), "id")).alias("name")
    )
    right = spark.createDataFrame([("alfa", 1), ("banco", 2), ("b1", 3)], RIGHT)
    counted = substring_join(left, right, "name", "nome").groupBy("nome").count().collect()
    expected = {"alfa": 3000, "banco": 3000, "b1": 0}
    for i in range(3000, 9000):
        expected["b1"] += f"B{i}".startswith("B1")
    got = {r["nome"]: r["count"] for r in counted}
    assert {k: got.get(k, 0) for k in expected} == expected
    assert got[None] == 6000 - expected["b1"]


def test_long_names_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr("ledgerloom.operators.match.PIECES", (50, 7))
    rng = random.Random(3)
    left = [(i, "".join(rng.choices("AB C", k=rng.randrange(1, 400)))) for i in range(12)]
    right = [("".join(rng.choices("AB C", k=rng.randrange(1, 12))), i) for i in range(40)]
    right += [(left[0][1][5:90], 99), (left[1][1], 100)]
    assert joined(spark, left, right) == brute(left, right)


def test_helper_columns_do_not_take_the_callers(spark):
    left = spark.createDataFrame([("BANCO ALFA", 1), (None, 2)], "_name string, _needle int")
    right = spark.createDataFrame([("alfa", 2)], "nome string, _matched int")
    for join in (substring_join, longest_substring_join):
        got = join(left, right, "_name", "nome")
        assert got.columns == ["_name", "_needle", "nome", "_matched"]
        assert sorted(map(tuple, got.collect()), key=str) == [("BANCO ALFA", 1, "alfa", 2), (None, 2, None, None)]


def test_names_decide_what_is_matched(spark):
    left = spark.createDataFrame([("BANCO ALFA", 1)], "name string, k int")
    right = spark.createDataFrame([("alfa", 2)], RIGHT)
    for join in (substring_join, longest_substring_join):
        assert join(left, right, "name", "nome", names=left.limit(0)).first()["nota"] is None


def test_left_rows_move_once(spark):
    left = spark.createDataFrame(CASES, LEFT)
    right = spark.createDataFrame(NAMES, RIGHT)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for join in (substring_join, longest_substring_join):
            plan = join(left, right, "name", "nome")._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 2, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("searched", [7, 1 << 18])
def test_needles_of_all_sizes_are_found_in_one_pass(searched):
    rng = random.Random(11)
    letters = "ABÇ \U0001f600"
    texts = ["".join(rng.choices(letters, k=rng.randrange(0, 90))) for _ in range(60)]
    needles = {"", *("".join(rng.choices(letters, k=rng.randrange(1, 6))) for _ in range(80))}
    needles |= {text[3 : 3 + size] for text, size in zip(texts, (3, 4, 7, 8, 15, 16, 17, 40))}
    needles = sorted(needles)
    of, numbers = finder(needles, searched)(texts)
    assert list(zip(of.tolist(), numbers.tolist())) == [(i, j) for i, t in enumerate(texts) for j, n in enumerate(needles) if n in t]


def test_no_row_for_every_place_of_a_name(spark, monkeypatch):
    """Few needles are looked for where the names are."""
    monkeypatch.setattr("ledgerloom.operators.match.containing_pairs", None)
    assert joined(spark, CASES, NAMES) == brute(CASES, NAMES)
    # Right rows that are too many for a broadcast, with needles that are not.
    many = [("ING", i) for i in range(50)] + [("A", 1), ("  ", 2)]
    assert joined(spark, CASES, many, broadcast_bytes=1000) == brute(CASES, many)


@pytest.mark.parametrize("join", [substring_join, longest_substring_join])
def test_a_name_is_written_once_whatever_it_contains(spark, monkeypatch, join):
    """Not its text, and not a row for each of its matches."""
    written = []

    def counted(df, label, path=None):
        out = stage(df, label, path)
        written.append((label, out.count(), [c for c, kind in out.dtypes if kind == "string"]))
        return out

    monkeypatch.setattr("ledgerloom.operators.match.stage", counted)
    left = spark.createDataFrame([(i, f"{i} ABCDEFGHIJKLMNOP") for i in range(20)], LEFT)
    right = spark.createDataFrame([(letter, i) for i, letter in enumerate("ABCDEFGHIJKLMNOP")], RIGHT)
    assert join(left, right, "name", "nome").where("nota is not null").count() == (320 if join is substring_join else 20)
    assert max(rows for _, rows, _ in written) <= 20
    assert [texts for label, _, texts in written if label == "hits"] == [[]]
