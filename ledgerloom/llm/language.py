"""Language of texts by sparse multinomial logistic regression on character n-grams.

A text is its letters in lower case with single blanks between words, weighted TF-IDF over hashed
n-grams of 1 to 3 characters. Document frequencies count every text that may be learnt from; the
weights are fitted on a bounded sample of them by follow-the-regularised-leader with elastic-net
penalties, and a temperature fitted on texts that the weights have not seen makes the scores
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.shipping import ship

BUCKETS = 1 << 15
GRAMS = (1, 2, 3)
#: Texts of one language in the sample, about; those of the smallest hashes of their ids.
SAMPLE_PER_LANGUAGE = 600
#: Languages that are learnt at most: those of the most texts, so that a column of other things is no danger.
LANGUAGES = 256
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
#: Share of the sample that only the temperature sees.
CALIBRATION = 5
UNKNOWN = "und"
#: Score from which the language of a text counts as known.
LEAST_SCORE = 0.5
_BMP = 1 << 16
_BLANK = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(_BMP)])


def _is_letter(points: np.ndarray) -> np.ndarray:
    table = _letters()
    if points.size and points.max() >= _BMP:
        high = points >= _BMP
        found = table[np.where(high, 0, points)]
        kinds, where = np.unique(points[high], return_inverse=True)
        found[high] = np.array([chr(c).isalpha() for c in kinds.tolist()])[where]
        return found
    return table[points]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a text, and how often each occurs; none if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _is_letter(points)
    if not letters.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    points = np.where(letters, points, np.uint32(_BLANK))
    kept = letters.copy()
    kept[1:] |= letters[:-1]
    points = points[kept]
    end = [_BLANK] if points[-1] != _BLANK else []
    points = np.concatenate([[_BLANK], points, end]).astype(np.uint32)
    hashed, found = np.zeros(len(points), np.uint32), []
    for n in range(1, max(GRAMS) + 1):
        if len(points) < n:
            break
        hashed = hashed[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1 :] + np.uint32(n)
        if n in GRAMS:
            mixed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            found.append((mixed ^ (mixed >> np.uint32(12))) % np.uint32(BUCKETS))
    counts = np.bincount(np.concatenate(found), minlength=BUCKETS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


def _weighted(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = np.log1p(counts) * idf[buckets]
    return values / max(float(np.sqrt((values**2).sum())), 1e-12)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _weighted(buckets, counts, self.idf) @ self.weights[buckets] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        buckets, counts = gram_counts(text or "")
        if not len(buckets) or not self.languages:
            return UNKNOWN, 0.0
        shares = _softmax(self.logits(buckets, counts) / self.temperature)
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best])


def _softmax(logits: np.ndarray) -> np.ndarray:
    shares = np.exp(logits - logits.max(-1, keepdims=True))
    return shares / shares.sum(-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by follow-the-regularised-leader; ``rows`` are (buckets, values, class)."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))
    bias_z, bias_n = np.zeros(classes), np.zeros(classes)

    def solve(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    random = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for at in random.permutation(len(rows)):
            buckets, values, own = rows[at]
            weights, bias = solve(z[buckets], n[buckets], L1), solve(bias_z, bias_n, 0.0)
            slope = _softmax(values @ weights + bias)
            slope[own] -= 1.0
            for zs, ns, where, g, w in (
                (z, n, buckets, values[:, None] * slope, weights),
                (bias_z, bias_n, slice(None), slope, bias),
            ):
                before = ns[where]
                after = before + g * g
                zs[where] += g - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
                ns[where] = after
    return solve(z, n, L1), solve(bias_z, bias_n, 0.0)


def _temperature(logits: np.ndarray, own: np.ndarray) -> float:
    """The temperature under which the calibration texts are likeliest."""
    tried = np.exp(np.linspace(np.log(0.05), np.log(5.0), 60))
    losses = [-np.log(_softmax(logits / t)[np.arange(len(own)), own] + 1e-12).mean() for t in tried]
    return float(tried[int(np.argmin(losses))])


def _held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of a task each bucket occurs."""
    found, texts = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            buckets, _ = gram_counts(text.as_py())
            found[buckets] += 1
            texts += 1
    filled = np.append(np.flatnonzero(found), BUCKETS)
    counts = np.append(found[filled[:-1]], texts)
    yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array(counts)], ["bucket", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [gram_counts(text.as_py()) for text in batch.column(1)]
        buckets = pa.array([b.astype("<u2").tobytes() for b, _ in found], pa.binary())
        counts = pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), buckets, counts], ["lang", "buckets", "counts"])


def fit_languages(docs: DataFrame) -> LanguageModel:
    """A model learnt from text and lang of the rows of ``docs`` (doc_id, text, lang) not held out.

    Rows with a null doc_id, text or lang teach nothing. Without any the model knows no language. Of
    more than ``LANGUAGES`` values of lang those of the most texts are learnt.
    """
    ship(docs.sparkSession)
    may = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    may = may.where(~_held_out(F.col("doc_id")))
    counts = may.select("text").mapInArrow(_frequencies, "bucket int, n bigint")
    # BUCKETS rows and one with the number of texts.
    frequency = np.zeros(BUCKETS + 1)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        frequency[row["bucket"]] = row["n"]
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1
    totals = may.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    languages = tuple(sorted(r["lang"] for r in totals))
    if not languages:
        return LanguageModel((), idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    # LANGUAGES rows at most.
    shares = [(r["lang"], min(1.0, SAMPLE_PER_LANGUAGE / r["n"])) for r in totals]
    quota = docs.sparkSession.createDataFrame(shares, "learnt string, share double")
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("languages")), F.lit(1 << 20)) < F.col("share") * (1 << 20)
    schema = "lang string, buckets binary, counts binary"
    sample = may.join(F.broadcast(quota), F.col("lang") == F.col("learnt")).where(drawn).select("lang", "text").mapInArrow(_features, schema).orderBy("lang", "buckets", "counts").toPandas()
    rows = []
    for lang, buckets, n in sample.itertuples(index=False):
        at, found = np.frombuffer(buckets, "<u2").astype(np.int64), np.frombuffer(n, "<u4")
        if len(at):
            rows.append((at, _weighted(at, found, idf), languages.index(lang)))
    random = np.random.default_rng(11).permutation(len(rows))
    kept = [rows[i] for i in random[len(rows) // CALIBRATION :]]
    unseen = [rows[i] for i in random[: len(rows) // CALIBRATION]] or kept
    if not kept:
        return LanguageModel((), idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    weights, bias = fit_ftrl(kept, len(languages))
    logits = np.array([values @ weights[at] + bias for at, values, _ in unseen])
    temperature = _temperature(logits, np.array([own for _, _, own in unseen]))
    return LanguageModel(languages, idf.astype(np.float32), weights.astype(np.float32), bias, temperature)


def language_of(spark: SparkSession, model: LanguageModel):
    """A column function: lang_pred and score of a text."""
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sent.value.predict(t) for t in text], columns=["lang_pred", "score"])

    return predict


def identify_languages(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    held_out is whether crc32 of the doc_id as text is divisible by 5, null for a null doc_id; such
    rows teach nothing. A text that is null or has no letter is ``und`` with score 0, as are all
    where there is nothing to learn from. Only the text is an input of a prediction. Repeated rows
    stay, further columns are ignored.
    """
    predict = language_of(docs.sparkSession, fit_languages(docs) if model is None else model)
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = known.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def known_languages(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is told with a score of ``least``, as they are.

    Where there is nothing to learn from, nothing is told about any row, and all stay.
    """
    model = fit_languages(docs)
    if not model.languages:
        return docs
    predict = language_of(docs.sparkSession, model)
    return docs.where(predict(F.col("text").cast("string"))["score"] >= least)
