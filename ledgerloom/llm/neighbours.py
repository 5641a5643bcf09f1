"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by the slots in which random projections fall. Neighbours of a query fall near
its projections by a known law, so the probability that one lies in a cell is known, and a query visits
the cells in the order of that probability until they add up to the wanted success. The width of slots
is the distance of neighbours, which is measured: some sampled vectors are compared with all. How many
projections make a cell follows from that distance, from those of any two vectors, and from the
number of vectors, so that cells stay small in a table of any size. Every vector of a length with a law
is indexed. Queries of other lengths, of which the sample has too few, are compared with all vectors.
What the tables find is compared exactly and merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from ledgerloom.llm.shipping import ship
from ledgerloom.session import stage

TABLES = 2
#: Projections that make a cell: the least, and the most.
FUNCTIONS, MOST_FUNCTIONS = 4, 7
#: Vectors that a query should meet in all its cells, about, as far as projections can bring it about.
WANTED = 4096
#: Functions whose slots make the group that travels together; the others tell its cells apart.
GROUPED = 2
#: Estimated probability with which a neighbour is in the cells that one table visits.
SUCCESS = 0.85
#: Vectors from which the law of distances is learnt, those of the smallest hashes of their ids; the
#: first so many of a length are compared with all vectors, and a length has a law from so many on.
SAMPLE, MEASURED, LEAST_SAMPLED = 2000, 200, 32
#: Vectors and queries that meet in one task at once, about.
BLOCK, CHUNK = 2048, 2048
_REACH = 4
_WHOLE_GROUPS = 16
_CDF = NormalDist().cdf


@dataclass(frozen=True)
class _Law:
    """Distance within which neighbours lie, which also is the width of slots, and the projections."""

    radius: float
    dimension: int
    functions: int = FUNCTIONS

    def slots(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Projections in units of slots."""
        random = np.random.default_rng((table, self.dimension))
        directions = random.standard_normal((self.dimension, self.functions))
        return vectors @ directions / self.radius + random.uniform(0, 1, self.functions)


def _cell_keys(cells: np.ndarray, table: int, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for the groups and the cells at integer coordinates."""
    key = np.full(len(cells), table * 1_000_003 + dimension, np.uint64)
    groups = key
    for i in range(cells.shape[1]):
        key = (key ^ cells[:, i].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
        if i == GROUPED - 1:
            groups = key
    return groups.view(np.int64), key.view(np.int64)


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of one length at a time: their places and them as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(column.offsets.to_numpy())
    starts = column.offsets.to_numpy()[:-1] - column.offsets[0].as_py()
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, values[starts[rows][:, None] + np.arange(length)]


def _indexed(batches: Iterator[pa.RecordBatch], laws: dict[int, _Law]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, vectors in _vectors(batch.column(1)):
            if vectors.shape[1] not in laws:
                continue
            law = laws[vectors.shape[1]]
            own = batch.take(pa.array(rows))
            for table in range(TABLES):
                cells = np.floor(law.slots(vectors, table)).astype(np.int64)
                groups, keys = _cell_keys(cells, table, law.dimension)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(groups), pa.array(keys)], _INDEX)


def visits(places: np.ndarray, success: float) -> np.ndarray:
    """Cells that a query at ``places`` (in slots) visits in a table, the likeliest first."""
    home = np.floor(places).astype(np.int64)
    steps = range(-_REACH, _REACH + 1)
    shares = np.array([[_CDF(h + s + 1 - p) - _CDF(h + s - p) for s in steps] for h, p in zip(home, places)])
    # Slots too unlikely to be visited are not multiplied out.
    kept = [np.flatnonzero(row > (1 - success) / 100) for row in shares]
    offsets = np.array(list(product(*kept)))
    chance = np.prod([shares[i, offsets[:, i]] for i in range(len(home))], axis=0)
    order = np.argsort(-chance, kind="stable")
    enough = int(np.searchsorted(np.cumsum(chance[order]), success)) + 1
    return home + offsets[order[:enough]] - _REACH


def _probes(batches: Iterator[pa.RecordBatch], laws: dict[int, _Law], success: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, vectors in _vectors(batch.column(1)):
            if vectors.shape[1] not in laws:
                continue
            law = laws[vectors.shape[1]]
            at, groups, cells = [], [], []
            for table in range(TABLES):
                for row, places in zip(rows.tolist(), law.slots(vectors, table)):
                    group, key = _cell_keys(visits(places, success), table, law.dimension)
                    for g in np.unique(group):
                        at.append(row)
                        groups.append(g)
                        cells.append(key[group == g])
            own = batch.take(pa.array(at, pa.int64()))
            listed = pa.array(cells, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(groups, pa.int64()), listed], _PROBE)


_INDEX = ["vec_id", "embedding", "group", "cell"]
_PROBE = ["query_id", "query", "group", "cells"]


def _nearest(index: pa.Table, probes: pa.Table, k: int) -> pa.Table:
    """The nearest vectors of one block for each query of one chunk, among the cells it visits."""
    out_query, out_vec, out_score = [], [], []
    if len(index) and len(probes):
        index, probes = index.combine_chunks(), probes.combine_chunks()
        ids, cells = index["vec_id"].to_numpy(), index["cell"].to_numpy()
        parts = {x.shape[1]: (rows, x) for rows, x in _vectors(index["embedding"].chunk(0))}
        query_ids, visited = probes["query_id"].to_numpy(), probes["cells"].chunk(0)
        for at, queries in _vectors(probes["query"].chunk(0)):
            if queries.shape[1] not in parts:
                continue
            rows, vectors = parts[queries.shape[1]]
            squares = (vectors**2).sum(1)
            own_ids, own_cells = ids[rows], cells[rows]
            for i, query in zip(at.tolist(), queries):
                fits = own_ids != query_ids[i]
                if visited[i].is_valid:  # none: all cells
                    fits &= np.isin(own_cells, visited[i].values.to_numpy())
                near = np.flatnonzero(fits)
                if len(near) > 4 * k:
                    # By a formula that rounds more first; what it may have mistaken is kept.
                    rough = squares[near] - 2 * (vectors[near] @ query)
                    limit = np.partition(rough, k - 1)[k - 1] + 1e-9 * (1 + squares[near].max() + query @ query)
                    near = near[rough <= limit]
                score = np.sqrt(((vectors[near] - query) ** 2).sum(1))
                best = np.lexsort((own_ids[near], score))[:k]
                out_query.append(np.full(len(best), query_ids[i]))
                out_vec.append(own_ids[near][best])
                out_score.append(score[best])
    whole = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
    columns = [whole(out_query, pa.int64()), whole(out_vec, pa.int64()), whole(out_score, pa.float64())]
    return pa.table(columns, ["query_id", "vec_id", "score"])


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part: an id, and a vector that is finite, whole and not zero."""
    kind = vectors.schema["embedding"].dataType
    if not isinstance(kind, ArrayType) or not isinstance(kind.elementType, (FloatType, DoubleType)):
        vectors = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    flaw = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    sound = F.col("embedding").isNotNull() & ~F.exists("embedding", flaw) & F.exists("embedding", lambda x: x != 0)
    known = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return known.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))


def _distances(batches: Iterator[pa.RecordBatch], sample: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """Of a task's vectors the ``k`` nearest ones of each sampled vector: length, number of that, square of the distance."""
    least: dict[int, np.ndarray] = {}
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for rows, vectors in _vectors(batch.column(1)):
            if (length := vectors.shape[1]) not in sample:
                continue
            own_ids, asked = sample[length]
            apart = (asked**2).sum(1)[:, None] + (vectors**2).sum(1) - 2 * asked @ vectors.T
            apart[own_ids[:, None] == ids[rows]] = np.inf
            both = np.concatenate([least.get(length, np.empty((len(asked), 0))), np.maximum(apart, 0)], 1)
            least[length] = np.sort(both, axis=1)[:, :k]
    for length, found in least.items():
        at, _ = np.nonzero(np.isfinite(found))
        columns = [np.full(len(at), length, np.int32), at.astype(np.int32), found[np.isfinite(found)]]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["length", "asked", "square"])


def share_met(radius: float, apart: np.ndarray, functions: int, success: float) -> float:
    """Share of vectors, with distances ``apart`` from a query, that are in the cells which it visits.

    Along one projection a neighbour is off by a normal deviate in slots and another vector by as many
    times more as it is farther away. Cells are visited up to the deviates that give the success.
    """
    reach = NormalDist().inv_cdf((1 + success ** (1 / functions)) / 2) + 0.5
    one = np.array([2 * _CDF(reach * radius / max(d, 1e-300)) - 1 for d in apart.tolist()])
    return float((one**functions).mean())


def _learn(vectors: DataFrame, k: int, success: float) -> dict[int, _Law]:
    """For each length of vectors the distance within which neighbours lie, and the projections it wants.

    The distance is that of the ``k``-th neighbour, among all vectors, of the sampled ones. Lengths
    of which there are too few, in the sample or in all, have no law.
    """
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    sample: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    spread: dict[int, np.ndarray] = {}
    for length in {len(r["embedding"]) for r in rows}:
        own = [r for r in rows if len(r["embedding"]) == length]
        if len(own) < LEAST_SAMPLED:
            continue
        x = np.array([r["embedding"] for r in own], np.float64)
        sample[length] = np.array([r["vec_id"] for r in own[:MEASURED]]), x[:MEASURED]
        spread[length] = np.sqrt(((x[: len(x) // 2] - x[len(x) // 2 : 2 * (len(x) // 2)]) ** 2).sum(1))
    if not sample:
        return {}
    nearest = vectors.mapInArrow(lambda batches: _distances(batches, sample, k), "length int, asked int, square double")
    order = Window.partitionBy("length", "asked").orderBy("square")
    ranked = nearest.withColumn("n", F.row_number().over(order)).where(F.col("n") == k)
    found: dict[int, list[float]] = {}
    for r in ranked.collect():
        found.setdefault(r["length"], []).append(r["square"] ** 0.5)
    held = {r["length"]: r["n"] for r in vectors.groupBy(F.size("embedding").alias("length")).agg(F.count(F.lit(1)).alias("n")).where(F.col("length").isin(list(sample))).collect()}
    laws = {}
    for length, distances in found.items():
        radius = float(np.quantile(distances, 0.9))
        radius = radius if 0 < radius < float("inf") else 1.0
        fits = (m for m in range(FUNCTIONS, MOST_FUNCTIONS) if held[length] * share_met(radius, spread[length], m, success) <= WANTED)
        # Where vectors are not much farther apart than neighbours, more projections do not help.
        hopeless = share_met(radius, spread[length], MOST_FUNCTIONS, success) > 0.5 * share_met(radius, spread[length], FUNCTIONS, success)
        laws[length] = _Law(radius, length, FUNCTIONS if hopeless else next(fits, MOST_FUNCTIONS))
    return laws


def _meet(index: DataFrame, probes: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """Nearest vectors per query and block. A group of any size is cut into blocks, its queries into chunks."""
    asked = probes.groupBy("group").agg(F.count(F.lit(1)).alias("asked"))
    cut = sizes.join(asked, "group").select(
        F.col("group"),
        F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.col("asked") / CHUNK).cast("int").alias("chunks"),
    )
    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index.join(cut, "group").select(*_INDEX, part("vec_id", "blocks").alias("block"), every("chunks").alias("chunk"))
    right = probes.join(cut, "group").select(*_PROBE, part("query_id", "chunks").alias("chunk"), every("blocks").alias("block"))
    keys = ["group", "block", "chunk"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    return met.applyInArrow(lambda a, b: _nearest(a, b, k), "query_id bigint, vec_id bigint, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    merged = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, success: float = SUCCESS) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` (vec_id, embedding) found for each row where ``is_query`` holds.

    Nearness is the Euclidean distance in double precision, ties go to the smaller vec_id. Rows
    without an id and vectors that are null, zero, empty or hold a null or non-finite number take
    no part; only vectors of the same length are compared. Rows that share a vec_id are one
    candidate and one query at several places, of which the nearest counts. A query that finds fewer
    than ``k`` or whose length is rare is compared with all vectors, so it has fewer only if there are no more. Further
    columns are ignored; a table without queries gives no rows.

    Returns query_id, rank (from 1), vec_id, score.
    """
    ship(vectors.sparkSession)
    usable = _usable(vectors)
    laws = _learn(usable, k, success)
    index = stage(usable.mapInArrow(lambda batches: _indexed(batches, laws), _index_schema(usable)), "index")
    sizes = stage(index.groupBy("group").agg(F.count(F.lit(1)).alias("held")), "index-sizes")
    asked = _usable(vectors.where(is_query)).toDF("query_id", "query")
    probes = stage(asked.mapInArrow(lambda batches: _probes(batches, laws, success), _probe_schema(usable)), "probes")
    found = stage(_best(_meet(index, probes, sizes, k), k), "found")
    # Queries that came to sparse cells, those of a length without a law, or all of them where there
    # are few vectors.
    enough = found.groupBy("query_id").count().where(F.col("count") >= k).select("query_id")
    lawless = asked.where(~F.size("query").isin(list(laws))).select("query_id")
    enough = enough.join(lawless, "query_id", "left_anti")
    short = stage(asked.join(enough, "query_id", "left_anti"), "short")
    if short.isEmpty():
        return found.select("query_id", "rank", "vec_id", "score")
    first = stage(usable.select("vec_id", "embedding", _spread(usable).alias("group"), F.lit(0).cast("bigint").alias("cell")), "all")
    held = first.groupBy("group").agg(F.count(F.lit(1)).alias("held"))
    every_group = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(_WHOLE_GROUPS - 1).cast("bigint"))).alias("group")
    whole = short.select("query_id", "query", every_group, F.lit(None).cast("array<bigint>").alias("cells"))
    exact = _best(_meet(first, whole, held, k), k)
    kept = found.join(short.select("query_id").distinct(), "query_id", "left_anti")
    return kept.unionByName(exact).select("query_id", "rank", "vec_id", "score")


def _spread(vectors: DataFrame) -> Column:
    """One of a few groups; blocks cut them further."""
    return F.pmod(F.xxhash64("vec_id"), F.lit(_WHOLE_GROUPS)).cast("bigint")


def _index_schema(vectors: DataFrame) -> str:
    kind = vectors.schema["embedding"].dataType.simpleString()
    return f"vec_id bigint, embedding {kind}, group bigint, cell bigint"


def _probe_schema(vectors: DataFrame) -> str:
    kind = vectors.schema["embedding"].dataType.simpleString()
    return f"query_id bigint, query {kind}, group bigint, cells array<bigint>"
