import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import neighbours
from ledgerloom.llm.neighbours import nearest_neighbours
from tests.llm.conftest import SF_DIR

SCHEMA = "vec_id bigint, embedding array<float>"


def _brute(rows, query_id, query, k):
    best = {}
    for i, v in rows:
        if i != query_id and len(v) == len(query):
            d = float(np.sqrt(((np.array(v, np.float32).astype(float) - query) ** 2).sum()))
            best[i] = min(d, best.get(i, d))
    return sorted((d, i) for i, d in best.items())[:k]


def test_recall_on_the_test_vectors(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/../sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    found = nearest_neighbours(vectors, F.col("vec_id") % 100 == 0).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    hits = total = 0
    for i, v in rows:
        if i % 100 == 0:
            wanted = _brute(rows, i, np.array(v, np.float32).astype(float), 10)
            got = by_query[i]
            assert got == sorted(got) and len(got) == 10
            hits += len({j for _, j in got} & {j for _, j in wanted})
            total += 10
            exact = dict((j, d) for d, j in _brute(rows, i, np.array(v, np.float32).astype(float), len(rows)))
            assert all(abs(exact[j] - d) < 1e-12 for d, j in got)
    assert hits / total >= 0.9


def test_odd_vectors(spark):
    rows = [(i, [float(i % 3), 1.0, float(i // 3)]) for i in range(12)]
    rows += [(20, [1.0, 1.0, 0.0]), (21, [1.0, 1.0, 0.0]), (22, [0.0, 1.0, 2.0]), (22, [0.0, 1.0, 2.0])]
    bad = [(30, None), (31, [0.0] * 3), (32, [1.0, None, 1.0]), (33, [float("nan"), 1.0, 1.0]), (34, [float("inf"), 1.0, 1.0])]
    bad += [(None, [1.0, 1.0, 1.0]), (35, [])]
    rows += [(36, [1.0, 2.0]), (37, [1.0, 2.5])]
    df = spark.createDataFrame(rows + bad, SCHEMA).withColumns({"group": F.lit(1), "cell": F.lit(2), "rank": F.lit(3)})
    found = {}
    for r in nearest_neighbours(df, F.lit(True), k=4).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    assert set(found) == {i for i, _ in rows}
    for i, v in rows:
        wanted = _brute(rows, i, np.array(v), 4)
        assert [(d, j) for _, d, j in sorted(found[i])] == wanted
        assert [n for n, _, _ in sorted(found[i])] == list(range(1, len(wanted) + 1))


def test_many_equal_vectors_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "CHUNK", 8)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(100)] + [(100 + i, [float(i), 1.0, 0.5]) for i in range(30)]
    found = nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") < 20, k=5).collect()
    for q in range(20):
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [v for _, v, _ in got] == [i for i in range(7) if i != q][:5] and {s for *_, s in got} == {0.0}


@pytest.mark.parametrize("sample", [20, 200])
def test_rare_lengths_are_compared_exactly(spark, monkeypatch, sample):
    """Vectors of a length that the sample lacks, or has few of, of a scale above a slot of 1."""
    monkeypatch.setattr(neighbours, "SAMPLE", sample)
    random_ = np.random.default_rng(3)
    rows = [(i, random_.standard_normal(8).tolist()) for i in range(4000)]
    rare = [(10_000 + i, (random_.standard_normal(6) * 3).tolist()) for i in range(150)]
    # An id with vectors of both lengths is a query at both places.
    rare.append((0, rare[0][1]))
    found = {}
    df = spark.createDataFrame(rows + rare, SCHEMA)
    for r in nearest_neighbours(df, (F.col("vec_id") >= 10_000) | (F.col("vec_id") == 0), k=5).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    assert set(found) == {i for i, _ in rare}
    for i, v in rare[:-1]:
        wanted = _brute(rare, i, np.array(v, np.float32).astype(float), 5)
        assert [j for _, _, j in sorted(found[i])] == [j for _, j in wanted]


def _clustered(n, seed=4):
    """Vectors around centres, of which there are more the more vectors there are."""
    random_ = np.random.default_rng(seed)
    centres = random_.standard_normal((n // 40, 24)) * 4
    return [(i, (centres[i % len(centres)] + random_.standard_normal(24) * 0.3).tolist()) for i in range(n)]


def test_a_law_for_the_whole_table(spark):
    """Recall at two sizes of clustered vectors, and the vectors that a query is compared with grow more slowly than the table."""
    compared = {}
    for n in (2000, 16_000):
        rows = _clustered(n)
        df = spark.createDataFrame(rows, SCHEMA).repartition(4)
        hits = asked = 0
        queries = [i for i in range(0, n, n // 100)]
        found = {}
        for r in nearest_neighbours(df, F.col("vec_id").isin(queries)).collect():
            found.setdefault(r["query_id"], set()).add(r["vec_id"])
        x = np.array([v for _, v in rows], np.float32).astype(float)
        for q in queries:
            apart = ((x - x[q]) ** 2).sum(1)
            apart[q] = np.inf
            hits += len(found[q] & set(np.argsort(apart)[:10].tolist()))
            asked += 10
        assert hits / asked >= 0.9
        law = neighbours._learn(neighbours._usable(df), 10, neighbours.SUCCESS)[24]
        cells = [np.floor(law.slots(x, t)).astype(int) for t in range(neighbours.TABLES)]
        met = [sum(int((c[:, None] == neighbours.visits(law.slots(x[q : q + 1], t)[0], neighbours.SUCCESS)[None]).all(2).any(1).sum()) for t, c in enumerate(cells)) for q in queries[:30]]
        compared[n] = np.mean(met)
    # Eight times the vectors.
    assert compared[16_000] < 4 * compared[2000] and compared[16_000] < 16_000 / 20, compared


def test_width_is_the_true_distance_of_neighbours(spark):
    rows = _clustered(3000)
    law = neighbours._learn(neighbours._usable(spark.createDataFrame(rows, SCHEMA).repartition(5)), 10, 0.85)[24]
    x = np.array([v for _, v in rows], np.float32).astype(float)
    tenth = [np.sort(((x - x[i]) ** 2).sum(1))[10] ** 0.5 for i in range(0, 3000, 10)]
    assert abs(law.radius - np.quantile(tenth, 0.9)) < 0.1 * law.radius


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])]])
def test_too_few_vectors(spark, rows):
    assert nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.lit(True)).collect() == []


def test_visits_are_the_likeliest_cells():
    places = np.array([0.1, 2.6, -1.2, 0.5])
    cells = neighbours.visits(places, 0.5)
    assert tuple(cells[0]) in {(0, 2, -2, 0), (-1, 2, -2, 0)}
    assert len({tuple(c) for c in cells}) == len(cells)
    assert len(neighbours.visits(places, 0.9)) > len(cells)
