"""Quality of texts by a generalised additive model with pairwise interactions.

The model is a lookup table over the bins of each feature and one over the bins of each of a few
pairs of features. Shallow trees, boosted on one feature after the other in turn, learn the tables on
a bounded sample of labelled texts; a score adds up the bins of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.shingles import word_hashes
from ledgerloom.llm.shipping import ship

#: Labelled texts that the model learns from, about; those of the smallest hashes of their ids.
SAMPLE = 30_000
BINS, PAIR_BINS = 32, 8
#: Flaws are rare, so the ends of a feature are cut finer.
_TAILS = np.array([0.002, 0.005, 0.01, 0.02, 0.05])
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 40, 6
RATE, LEAVES, LEAST_WEIGHT, SHRINK = 0.1, 4, 0.5, 1.0
THRESHOLD = 0.3
FEATURES = (
    "log_bytes",
    "log_words",
    "word_bytes",
    "upper_share",
    "symbol_share",
    "marked_words",
    "bar_share",
    "digit_share",
    "blank_share",
    "distinct_words",
    "top_word",
    "repeated_words",
    "repeated_lines",
    "line_bytes",
    "longest_line",
    "stop_share",
    "entropy",
    "foreign_share",
)
_BLOCK = 256 * 1024
_UPPER, _LOWER, _DIGIT = np.arange(65, 91), np.arange(97, 123), np.arange(48, 58)
_SYMBOL = np.array([c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-?!()|"])


def _share(part, whole) -> float:
    return float(part) / float(whole) if whole else 0.0


def _features_of(data: bytes, points: np.ndarray, words: np.ndarray) -> list[float]:
    counts = np.bincount(points, minlength=256)
    size, n = len(data), len(words)
    upper, lower = counts[_UPPER].sum(), counts[_LOWER].sum()
    kinds, often = np.unique(words, return_counts=True)
    lines = data.split(b"\n")
    shares = counts[counts > 0] / max(size, 1)
    # Symbols that end a word, such as in "word***".
    symbol = np.zeros(256, bool)
    symbol[_SYMBOL] = symbol[33] = True
    ends = symbol[points[:-1]] & ((points[1:] == 32) | (points[1:] == 10)) if size > 1 else np.zeros(0, bool)
    return [
        np.log1p(size),
        np.log1p(n),
        _share(size, n),
        _share(upper, upper + lower),
        _share(counts[_SYMBOL].sum(), size),
        _share(ends.sum(), n),
        _share(counts[124], n),
        _share(counts[_DIGIT].sum(), size),
        _share(counts[32] + counts[9] + counts[10], size),
        _share(len(kinds), n**0.8 if n else 0),
        _share(often.max() if n else 0, n),
        _share((words[1:] == words[:-1]).sum(), n),
        1.0 - _share(len(set(lines)), len(lines)),
        np.log1p(_share(size, len(lines))),
        np.log1p(max(map(len, lines))),
        _share(counts[46] + counts[33] + counts[63], n),
        float(-(shares * np.log2(shares)).sum()),
        _share(counts[128:].sum(), size),
    ]


def text_features(texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text; a null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buffer or b"", np.uint8)
    rows = np.empty((len(texts), len(FEATURES)))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _BLOCK, side="right")) - 1)
        block, places = data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        words, counts = word_hashes(block, places)
        ends = np.cumsum(counts)
        for i in range(to - at):
            points = block[places[i] : places[i + 1]]
            rows[at + i] = _features_of(points.tobytes(), points, words[ends[i] - counts[i] : ends[i]])
        at = to
    return rows


@dataclass(frozen=True)
class AdditiveModel:
    """Edges of the bins of each feature, and a table for each feature and each chosen pair."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(features), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], features[:, j], side="right")]
        if self.pairs:
            coarse = {j: _binned(features[:, j], self.pair_edges[j]) for pair in self.pairs for j in pair}
            for (a, b), table in zip(self.pairs, self.pair_tables):
                total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def _binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, values, side="right")


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Limits between bins of about equal numbers; a value that is common has a bin of its own."""
    shares = np.r_[np.linspace(0, 1, bins + 1)[1:-1], _TAILS, 1 - _TAILS]
    return np.unique(np.quantile(values, shares, method="higher"))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SHRINK)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values for the bins of a tree of ``LEAVES`` leaves, on sums of slope and weight per bin."""
    leaves = [(0, len(g))]
    sums_g, sums_h = np.r_[0.0, np.cumsum(g)], np.r_[0.0, np.cumsum(h)]

    def best_cut(a: int, b: int) -> tuple[float, int]:
        at = np.arange(a + 1, b)
        left_g, left_h = sums_g[at] - sums_g[a], sums_h[at] - sums_h[a]
        right_g, right_h = sums_g[b] - sums_g[at], sums_h[b] - sums_h[at]
        gains = _gain(left_g, left_h) + _gain(right_g, right_h) - _gain(sums_g[b] - sums_g[a], sums_h[b] - sums_h[a])
        gains[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
        i = int(np.argmax(gains)) if len(gains) else 0
        return (float(gains[i]), int(at[i])) if len(gains) else (0.0, a)

    while len(leaves) < LEAVES:
        gain, cut, leaf = max((*best_cut(a, b), (a, b)) for a, b in leaves)
        if gain <= 1e-9:
            break
        leaves.remove(leaf)
        leaves += [(leaf[0], cut), (cut, leaf[1])]
    values = np.zeros(len(g))
    for a, b in leaves:
        values[a:b] = (sums_g[b] - sums_g[a]) / (sums_h[b] - sums_h[a] + SHRINK)
    return values


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree of one cut along each side of a grid: its gain and its values."""
    sums = [np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h)]
    best, found = 0.0, np.zeros_like(g)
    rows, columns = g.shape
    whole = _gain(g.sum(), h.sum())
    for i in range(1, rows):
        for j in range(1, columns):
            parts = []
            for x in sums:
                a, b, c = x[i, j], x[i, -1] - x[i, j], x[-1, j] - x[i, j]
                parts.append(np.array([a, b, c, x[-1, -1] - a - b - c]))
            if (parts[1] < 1e-9).all():
                continue
            gain = _gain(*parts).sum() - whole
            if gain > best:
                best = gain
                v = parts[0] / (parts[1] + SHRINK)
                found = np.zeros_like(g)
                found[:i, :j], found[:i, j:], found[i:, :j], found[i:, j:] = v
    return best, found


def fit_additive(features: np.ndarray, labels: np.ndarray) -> AdditiveModel:
    """Tables by cyclic boosting, first of single features, then of the pairs that explain most of the rest."""
    rate = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    base = float(np.log(rate / (1 - rate)))
    width = features.shape[1]
    edges = [_edges(features[:, j], BINS) if len(labels) else np.empty(0) for j in range(width)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    pair_edges = [_edges(features[:, j], PAIR_BINS) if len(labels) else np.empty(0) for j in range(width)]
    model = AdditiveModel(base, edges, tables, [], pair_edges, [])
    if len(labels) == 0 or labels.min() == labels.max():
        return model
    bins = [_binned(features[:, j], edges[j]) for j in range(width)]
    total = np.full(len(labels), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-total))
        return labels - chance, np.maximum(chance * (1 - chance), 1e-6)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = slopes()
            n = len(tables[j])
            step = RATE * _tree(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n))
            tables[j] += step
            total += step[bins[j]]
    coarse = [_binned(features[:, j], pair_edges[j]) for j in range(width)]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        rows, columns = len(pair_edges[a]) + 1, len(pair_edges[b]) + 1
        return np.bincount(coarse[a] * columns + coarse[b], values, rows * columns).reshape(rows, columns)

    g, h = slopes()
    gains = {(a, b): _cross(grid(a, b, g), grid(a, b, h))[0] for a, b in combinations(range(width), 2)}
    for pair in sorted(gains, key=gains.get, reverse=True)[:PAIRS]:
        model.pairs.append(pair)
        model.pair_tables.append(np.zeros((len(pair_edges[pair[0]]) + 1, len(pair_edges[pair[1]]) + 1)))
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            step = RATE * _cross(grid(a, b, g), grid(a, b, h))[1]
            table += step
            total += step[coarse[a], coarse[b]]
    return model


def _held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = text_features(batch.column(1))
        listed = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), listed], ["doc_id", "features"])


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """A model of ``quality`` learnt from the texts of ``docs`` that have a label and are not held out.

    ``labels`` has doc_id and quality; rows with a null teach nothing. Only documents of the sample
    are measured, and about ``sample`` rows come to the driver.
    """
    ship(docs.sparkSession)
    label = F.col("quality").cast("int").alias("label")
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), label).where("label is not null")
    marked = marked.where(~_held_out())
    share = min(1.0, sample / max(marked.count(), 1))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) < F.lit(share * (1 << 20))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measured = texts.where(drawn & ~_held_out()).mapInArrow(_measured, "doc_id bigint, features array<double>")
    rows = marked.where(drawn).join(measured, "doc_id").orderBy("doc_id", "label", "features").toPandas()
    if not len(rows):
        return fit_additive(np.empty((0, len(FEATURES))), np.empty(0))
    return fit_additive(np.stack(rows["features"].to_numpy()), rows["label"].to_numpy(np.float64))


def quality_score(spark: SparkSession, model: AdditiveModel):
    """A column function: the probability of label 1 for a text."""
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(sent.value.score(text_features(pa.array(text, pa.large_string(), from_pandas=True))))

    return score


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    The score is the probability of label 1 from the text alone; predicted is 1 from ``THRESHOLD``
    on. Null texts are empty ones, which are scored too. held_out is whether crc32 of the doc_id as
    text is divisible by 5, null for a null doc_id; such rows teach nothing. Without labels every
    score is 0.5. Repeated rows stay, further columns are ignored.
    """
    score = quality_score(docs.sparkSession, fit_quality(docs, labels))
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = known.select("doc_id", _held_out().alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, as they are."""
    score = quality_score(docs.sparkSession, fit_quality(docs, labels))
    return docs.where(score(F.col("text").cast("string")) >= THRESHOLD)
