import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import language, quality
from tests.llm.conftest import MESSY, SF_DIR


def test_gram_counts_by_hand():
    buckets, counts = language.gram_counts("Ab, ab!")
    # " ab ab ": 3 kinds of one character, 3 of two, 3 of three.
    assert counts.sum() == 7 + 6 + 5 and sorted(counts.tolist()) == [1, 2, 2, 2, 2, 2, 2, 2, 3]
    assert language.gram_counts("12 !?")[0].size == 0 and language.gram_counts("")[0].size == 0
    assert np.array_equal(buckets, language.gram_counts("AB--aB")[0])
    assert language.gram_counts("\U00010400x")[1].sum() > 0


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/../sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    found = language.identify_languages(docs).collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == len(truth) and 100 < len(held) < 300
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found)


def test_a_prediction_sees_only_the_text(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.fit_languages(docs)
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None)})
    a, b = (sorted(map(tuple, language.identify_languages(d, model).collect())) for d in (docs, other))
    assert a == b


def test_messy_languages(messy, nothing):
    found = language.identify_languages(messy).collect()
    assert len(found) == len(MESSY)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (5, 6, 7))
    assert by_id[None]["held_out"] is None
    assert language.known_languages(messy).columns == messy.columns
    assert language.identify_languages(nothing).collect() == []
    unlabelled = messy.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify_languages(unlabelled).collect()} == {"und"}


def test_a_model_finds_an_interaction():
    random = np.random.default_rng(3)
    x = random.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit_additive(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_features_by_hand():
    rows = quality.text_features(pa.array(["AB ab ab\nab|ab 12", None, "", "x" * 5]))
    named = dict(zip(quality.FEATURES, rows[0]))
    assert np.isclose(named["upper_share"], 0.2) and np.isclose(named["digit_share"], 2 / 17)
    assert np.isclose(named["repeated_words"], 2 / 5) and np.isclose(named["bar_share"], 1 / 5)
    assert np.isfinite(rows).all() and np.array_equal(rows[1], rows[2])


def test_quality_of_held_out_documents(spark):
    folder = f"{SF_DIR}/../sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    marked = {r["doc_id"]: r["quality"] for r in labels.collect()}
    found = quality.score_quality(docs, labels).collect()
    held = [r for r in found if r["held_out"] and r["doc_id"] in marked]
    assert len(held) > 50
    assert sum(r["predicted"] == marked[r["doc_id"]] for r in held) / len(held) > 0.93
    good = [r for r in held if marked[r["doc_id"]] == 1]
    assert sum(r["predicted"] for r in good) / len(good) > 0.98


def test_messy_quality(spark, messy, nothing):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = quality.score_quality(messy, none).collect()
    assert len(found) == len(MESSY) and {r["score"] for r in found} == {0.5}
    some = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (8, 0, 0), (None, 0, 0), (10, None, 0), (77, 1, 0)], none.schema)
    found = quality.score_quality(messy, some).collect()
    assert len(found) == len(MESSY) and all(0 <= r["score"] <= 1 for r in found)
    assert quality.good_documents(messy, some).columns == messy.columns
    assert quality.score_quality(nothing, some).collect() == []


def _plain_ftrl(rows, classes, order):
    """Follow-the-regularised-leader as published, one weight after the other."""
    z, n = {}, {}

    def weight(key, l1):
        if abs(z.get(key, 0.0)) <= l1:
            return 0.0
        sign = 1.0 if z[key] > 0 else -1.0
        return -(z[key] - sign * l1) / ((language.BETA + n[key] ** 0.5) / language.ALPHA + language.L2)

    for at in order:
        buckets, values, own = rows[at]
        keys = [("bias", 1.0, 0.0)] + [(int(b), float(v), language.L1) for b, v in zip(buckets, values)]
        held = {(k, c): weight((k, c), l1) for k, _, l1 in keys for c in range(classes)}
        logits = [sum(v * held[k, c] for k, v, _ in keys) for c in range(classes)]
        top = max(logits)
        total = sum(np.exp(x - top) for x in logits)
        for k, v, _ in keys:
            for c in range(classes):
                g = v * (np.exp(logits[c] - top) / total - (c == own))
                before = n.get((k, c), 0.0)
                step = ((before + g * g) ** 0.5 - before**0.5) / language.ALPHA
                z[k, c] = z.get((k, c), 0.0) + g - step * held[k, c]
                n[k, c] = before + g * g
    return lambda key, c: weight((key, c), language.L1 if key != "bias" else 0.0)


def test_ftrl_is_the_published_rule():
    random = np.random.default_rng(2)
    rows = [(np.sort(random.choice(40, 6, replace=False)), random.uniform(0, 1, 6), int(random.integers(3))) for _ in range(12)]
    weights, bias = language.fit_ftrl(rows, 3)
    again = np.random.default_rng(7)
    order = [i for _ in range(language.EPOCHS) for i in again.permutation(len(rows))]
    plain = _plain_ftrl(rows, 3, order)
    wanted = np.array([[plain(b, c) for c in range(3)] for b in range(40)])
    assert np.allclose(weights[:40], wanted, atol=1e-12) and np.allclose(bias, [plain("bias", c) for c in range(3)], atol=1e-12)
    assert (wanted == 0).any() and (weights[40:] == 0).all()


def test_language_scores_by_hand(spark):
    """IDF over all texts that may be learnt from, and a score worked out n-gram by n-gram."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.fit_languages(docs)
    held = language._held_out(F.col("doc_id"))
    texts = [r["text"] for r in docs.where(~held & F.col("lang").isNotNull() & F.col("text").isNotNull()).collect()]
    having = np.zeros(language.BUCKETS)
    for text in texts:
        having[language.gram_counts(text)[0]] += 1
    assert np.allclose(model.idf, np.log((1 + len(texts)) / (1 + having)) + 1, rtol=1e-6)
    for text in texts[:20]:
        buckets, counts = language.gram_counts(text)
        values = [np.log1p(n) * float(model.idf[b]) for b, n in zip(buckets, counts)]
        norm = sum(v * v for v in values) ** 0.5
        logits = [sum(v / norm * float(model.weights[b, c]) for v, b in zip(values, buckets)) + model.bias[c] for c in range(len(model.languages))]
        shares = np.exp((np.array(logits) - max(logits)) / model.temperature)
        shares /= shares.sum()
        assert model.predict(text)[0] == model.languages[int(shares.argmax())]
        assert abs(model.predict(text)[1] - shares.max()) < 1e-5


def test_temperature_is_the_likeliest_of_those_tried():
    random = np.random.default_rng(5)
    own = random.integers(0, 3, 400)
    logits = random.normal(size=(400, 3))
    logits[np.arange(400), own] += 1.0
    sharp = language._temperature(logits * 4, own)

    def loss(t):
        x = logits * 4 / t
        return float((np.log(np.exp(x).sum(1)) - x[np.arange(400), own]).mean())

    assert all(loss(sharp) <= loss(t) + 1e-9 for t in (0.5, 1.0, 2.0, 3.0, sharp * 1.3, sharp / 1.3)) and sharp > 2


def test_a_column_of_other_things_teaches_its_commonest_values(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 3)
    rows = [(i, f"word{'abc'[i % 3] * 5} text {i}", "abc"[i % 3]) for i in range(300)] + [(1000 + i, "odd", f"http://{i}") for i in range(200)]
    model = language.fit_languages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.languages == ("a", "b", "c")


def test_quality_scores_by_hand(spark):
    """A score is the sum of one entry of every table, looked up bin by bin."""
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fit_quality(docs, labels)
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(60).collect()]
    features = quality.text_features(pa.array(texts))
    assert model.pairs
    for row, score in zip(features.tolist(), model.score(features)):
        total = model.base
        bin_of = lambda value, edges: sum(value >= e for e in edges.tolist())
        for value, edges, table in zip(row, model.edges, model.tables):
            total += table[bin_of(value, edges)]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[bin_of(row[a], model.pair_edges[a]), bin_of(row[b], model.pair_edges[b])]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9
