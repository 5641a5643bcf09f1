"""Documents whose word shingles overlap, found by PartEnum signatures.

Two sets of similarity 0.85, or of the share that the caller wants, differ in few elements for their
sizes. Sizes fall into bands, each as wide as the similarity allows, so two such sets lie in the same
band or in neighbouring ones. For a band the domain of shingles is cut into parts, so many that in
one of them the sets differ in at most ``SPARE`` elements, and that part into cells: they agree on
all but ``SPARE`` of them. So they share the signature of some subset of cells of some part. No pair
is missed.

Pairs of sets that share a signature are compared by sketches first, which differ no more than the
sets do. What may be similar is brought together in blocks and compared exactly there, and only
links that connect something leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.filters import filter_words, may_hold
from ledgerloom.llm.shingles import WORDS, mix, shingle_sets
from ledgerloom.llm.shipping import ship
from ledgerloom.session import stage

# Similarity as a fraction: PART * |intersection| >= share * |union|; SHARE is that of operator 1.
SHARE, PART = 85, 100
SPARE = 1
# Cells of a part for sets of up to so many elements, and for larger ones, which have fewer chance neighbours.
SMALL_CELLS, LARGE_CELLS, LARGE = 3, 2, 400
# How far beyond their mean number parts with empty subsets are reckoned with in bands of larger sets, see ``_parts``.
DEVIATIONS = 1
# Sets of so many elements are signed by their first ones, and how many of these make a signature.
SMALL, TOGETHER = 36, 3
# Empty subsets that make a signature, by the number of parts: fewer where there are many to choose from.
_BARE_TOGETHER = ((128, 3), (1024, 2), (math.inf, 1))
# Sets and elements that one block of a comparison holds, about.
BLOCK_SETS, BLOCK_ELEMENTS = 2048, 1 << 21
# Sets that share a signature are paired with each other, and if they are more than that with the first;
# up to so many that have the same first one are compared by their sketches.
PAIRED, COMPARED = 32, 8192
# Bits of a sketch for each element, or down to half as many; and bits of the smallest and the largest.
SKETCHED, SKETCH_LEAST, SKETCH_MOST = 2, 128, 65536
# Bits of a signature: so few that chance neighbours are still rare among billions of them.
SIGNATURE_BITS = 48
# Where sketches are compared, which are so much smaller, blocks hold so many times the sets.
SKETCH_BLOCKS = 4
_LEAST = -(2**63)
_U = np.uint64


@lru_cache(maxsize=8)
def _subsets(cells: int) -> list[list[int]]:
    return [list(s) for s in combinations(range(cells), cells - SPARE)]


def _cells(band: int, share: int) -> int:
    return SMALL_CELLS if _high(band, share) <= LARGE else LARGE_CELLS


def similar(common: int, a: int, b: int, share: int = SHARE) -> bool:
    return PART * common >= share * (a + b - common)


def _most_different(total: int | np.ndarray, share: int = SHARE):
    """Most elements in which two linked sets of ``total`` elements in all can differ."""
    return (PART - share) * total // (PART + share)


@lru_cache(maxsize=4096)
def _band(size: int, share: int = SHARE) -> int:
    """Number of the band in which sets of ``size`` elements lie."""
    band, low = 0, 1
    while (high := low * PART // share) < size:
        band, low = band + 1, high + 1
    return band


@lru_cache(maxsize=1024)
def _high(band: int, share: int = SHARE) -> int:
    high = 1
    for _ in range(band):
        high = (high + 1) * PART // share
    return high


@lru_cache(maxsize=1024)
def _parts(band: int, share: int = SHARE) -> tuple[int, int]:
    """How many parts a band has, and how many of them are more than needed.

    The surplus is about what the smallest sets of the band have in parts with an empty subset, by
    the law of empty cells, and one: so linked sets share two signatures, or a sure one, see ``_sure``.
    """
    needed = -(-(_most_different(2 * _high(band, share), share) + 1) // (SPARE + 1))
    least = _high(band - 2, share) + 1 if band > 1 else 1
    cells = _cells(band, share)
    deviations = 0 if cells == SMALL_CELLS else DEVIATIONS
    for surplus in range(1, needed + 1):
        parts = needed + surplus
        empty = math.exp(-least / (parts * cells))
        lost = sum(math.comb(cells, n) * empty**n * (1 - empty) ** (cells - n) for n in range(cells - SPARE, cells + 1))
        if surplus >= parts * lost + deviations * math.sqrt(parts * lost * (1 - lost)):
            break
    return parts + 1, surplus


def set_key(elements: np.ndarray) -> int:
    """A number that stands for a whole set; equal sets are one node of the graph."""
    total = mix(elements).sum(dtype=np.uint64) + _U(len(elements))
    return int(mix(np.array([total]))[0].astype(np.int64))


def _of_parts(elements: np.ndarray, band: int, share: int) -> list[np.ndarray]:
    """Signatures in a band: of the subsets of cells of each part.

    Subsets without elements would bring unrelated sets together, so they give no signature. Two
    linked sets agree on ``surplus + 2`` parts or more. If one of them has no more parts with empty
    subsets than the surplus, they agree on two others. If both have more, and agree on fewer than two
    others, they have ``surplus + 1`` empty ones in common. So the first of these, a few at a time, are
    signed too, and such a signature is sure: sharing it is enough.
    """
    parts, surplus = _parts(band, share)
    width = _cells(band, share)
    subsets = _subsets(width)
    place = (mix(elements + _U(band + 1)) % _U(parts * width)).astype(np.int64)
    cells = np.zeros(parts * width, np.uint64)
    np.add.at(cells, place, elements)
    held = np.bincount(place, minlength=parts * width).reshape(parts, width)
    cells = cells.reshape(parts, width)
    empty = np.stack([held[:, s].sum(1) == 0 for s in subsets], 1)
    sums = np.stack([cells[:, s].sum(1) for s in subsets], 1)
    number = np.arange(parts * len(subsets), dtype=np.uint64).reshape(parts, -1)
    salt = mix(number + (_U(band) << _U(32)) + _U(0x51ED2701))
    found = [mix(sums + salt)[~empty] & ~_U(1)]
    bare = np.flatnonzero(empty.any(1))
    if len(bare) > surplus:
        together = min(next(n for most, n in _BARE_TOGETHER if parts <= most), surplus + 1)
        first = bare[: len(bare) - surplus - 1 + together].tolist()
        names = [salt[part][empty[part]].tolist() for part in first]
        sets = [sum(chosen) % 2**64 for some in combinations(names, together) for chosen in product(*some)]
        found.append(_sure(mix(np.array(sets, np.uint64) + _U(0x2545F4914F6CDD1D))))
    return found


def _sure(signatures: np.ndarray) -> np.ndarray:
    """Signatures of which sharing one is enough to be compared; of others it takes two. The last bit tells."""
    return signatures | _U(1)


@lru_cache(maxsize=256)
def _choices(n: int, k: int) -> np.ndarray:
    return np.array(list(combinations(range(n), k)), np.int64).reshape(-1, k)


def _of_first(elements: np.ndarray, share: int) -> np.ndarray:
    """Signatures of a small set, whose parts would be single elements.

    A set and one that it is linked with have ``common`` elements in common or more, so the first
    ``TOGETHER`` of these, in the order of hashes, are among the first of either.
    """
    common = -(-share * len(elements) // PART)
    together = min(TOGETHER, common)
    choices = _choices(len(elements) - common + together, together)
    return _sure(mix(elements[choices].sum(1) + _U(0x1B873593CC9E2D51)))


def _signatures(elements: np.ndarray, share: int = SHARE) -> np.ndarray:
    """Signatures of a set: two linked ones that are not equal share two of them, or a sure one.

    Sets are signed in the band of their size and in the next one, where they may be the smaller
    one, and small ones and those that can be linked with such by their first elements.
    """
    n = len(elements)
    if _most_different(n + n * PART // share, share) == 0:  # only equal sets are linked, and they are one node
        return np.empty(0, np.uint64)
    found = [_of_first(elements, share)] if share * n <= PART * SMALL else []
    if n > SMALL:
        own = _band(n, share)
        found += [signed for band in (own, own + 1) for signed in _of_parts(elements, band, share)]
    return np.concatenate(found) & _U((1 << SIGNATURE_BITS) - 1)


def sketch(elements: np.ndarray) -> bytes:
    """Whether an odd number of elements falls on each of a number of places that grows with the set.

    The sketches of two sets differ in no more bits than the sets do in elements, and in so many that
    sets with no more than a passage in common hardly ever pass for similar ones.
    """
    wanted = SKETCHED * len(elements)
    places = min(max(SKETCH_LEAST, 1 << max(0, wanted.bit_length() - 1)), SKETCH_MOST)
    at = (mix(elements + _U(3)) & _U(places - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=places) & 1).astype(bool)).tobytes()


def _folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Sketches, one a row, as they would be with ``width`` bytes; in words of 64 bits."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, width), axis=1).view(np.uint64)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many bits sketches, one a row, differ; the longer ones are folded to the length of the others."""
    width = min(a.shape[1], b.shape[1])
    return np.bitwise_count(_folded(a, width) ^ _folded(b, width)).sum(1, dtype=np.int64)


def _near(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b, size_a, sketch_a, size_b, sketch_b) that may be linked by sizes and sketches."""
    for batch in batches:
        sizes_a, sizes_b = batch.column(2).to_numpy(), batch.column(4).to_numpy()
        fits = PART * np.minimum(sizes_a, sizes_b) >= share * np.maximum(sizes_a, sizes_b)
        batch = batch.filter(pa.array(fits))
        most = _most_different((sizes_a + sizes_b)[fits], share)
        sketches = [[np.frombuffer(s, np.uint8) for s in batch.column(i).to_pylist()] for i in (3, 5)]
        widths = np.array([[len(s) for s in side] for side in sketches]).reshape(2, -1)
        near = np.zeros(len(most), bool)
        for kind in np.unique(widths, axis=1).T:
            at = np.flatnonzero((widths == kind[:, None]).all(0))
            near[at] = _apart(*(np.stack([side[i] for i in at]) for side in sketches)) <= most[at]
        yield batch.select(["a", "b"]).filter(pa.array(near))


def near_links(sizes: np.ndarray, sketches: list[np.ndarray], share: int) -> Iterator[tuple[int, int]]:
    """Pairs that connect sets as all pairs that may be linked, by sizes and sketches, do."""
    widths = np.array([len(s) for s in sketches])
    component = np.arange(len(sizes))
    # For each width the sets whose sketches are as wide or wider, folded to it.
    folded = {}
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths >= width)
        folded[width] = at, np.concatenate([_folded(sketches[i][None], width) for i in at])
    for i, width in enumerate(widths.tolist()):
        at, rows = folded[width]
        open_ = (component[at] != component[i]) & ((widths[at] > width) | (at > i))
        open_ &= PART * np.minimum(sizes[at], sizes[i]) >= share * np.maximum(sizes[at], sizes[i])
        if not open_.any():
            continue
        others = at[open_]
        apart = np.bitwise_count(rows[open_] ^ rows[np.searchsorted(at, i)]).sum(1, dtype=np.int64)
        for j in others[apart <= _most_different(sizes[others] + sizes[i], share)].tolist():
            if component[j] != component[i]:
                component[component == component[j]] = component[i]
                yield i, j


def _near_within(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """Edges between the nodes (b, size, sketch) of a group (a); rows come in order of a and b."""
    group, nodes, sizes, sketches = None, [], [], []

    def edges() -> pa.RecordBatch:
        found = list(near_links(np.array(sizes), sketches, share))
        columns = [pa.array([nodes[pair[i]] for pair in found], pa.int64()) for i in range(2)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b"])

    for batch in batches:
        for a, node, size, packed in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if a != group:
                if len(nodes) > 1:
                    yield edges()
                group, nodes, sizes, sketches = a, [], [], []
            if nodes and nodes[-1] == node:
                continue
            nodes.append(node)
            sizes.append(size)
            sketches.append(np.frombuffer(packed, np.uint8))
    if len(nodes) > 1:
        yield edges()


def _nodes(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, sketches = [], [], []
        for elements in shingle_sets(batch.column(1), words):
            sizes.append(len(elements))
            keys.append(set_key(elements) if len(elements) else None)
            sketches.append(sketch(elements) if len(elements) else None)
        columns = [pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(sketches, pa.binary())]
        names = ["doc_key", "n_shingles", "node", "sketch", *batch.schema.names[2:]]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *batch.columns[2:]], names)


def _signed(batches: Iterator[pa.RecordBatch], words: int, share: int, bits) -> Iterator[pa.RecordBatch]:
    """Signatures of the sets of (text, hash): of the documents that the filter lets pass."""
    for batch in batches:
        passed = np.flatnonzero(may_hold(bits.value, batch.column(1).to_numpy().view(np.uint64)))
        done, keys, held, count = set(), [], [], 0
        for elements in shingle_sets(batch.column(0).take(pa.array(passed)), words):
            if not len(elements) or (key := set_key(elements)) in done:
                continue
            done.add(key)
            held.append(_signatures(elements, share))
            keys.append(np.full(len(held[-1]), key, np.int64))
            count += len(held[-1])
            if count > 1 << 15:
                yield _signature_batch(held, keys)
                held, keys, count = [], [], 0
        if held:
            yield _signature_batch(held, keys)


def _signature_batch(signatures: list, keys: list) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(signatures).view(np.int64)), pa.array(np.concatenate(keys))]
    return pa.RecordBatch.from_arrays(columns, ["signature", "node"])


def _paired(signature: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b, whole, shared) of nodes of one signature; rows are whole groups in order of both.

    ``whole`` is 1 where a group is too large to pair all of it: its nodes are paired with the first.
    ``shared`` is how many signatures the two share, 2 for a sure one.
    """
    stays = np.r_[True, (signature[1:] != signature[:-1]) | (node[1:] != node[:-1])]
    signature, node = signature[stays], node[stays]
    first = np.flatnonzero(np.r_[True, signature[1:] != signature[:-1]])
    sizes = np.diff(np.r_[first, len(node)])
    size, start = np.repeat(sizes, sizes), np.repeat(first, sizes)
    place = np.arange(len(node)) - start
    weight = 1 + (signature & 1)
    found = [np.stack([node[start], node, np.ones(len(node), np.int64), weight], 1)[(size > PAIRED) & (place > 0)]]
    for step in range(1, min(int(sizes.max()), PAIRED)):
        at = np.flatnonzero((size[step:] <= PAIRED) & (place[step:] >= step))
        found.append(np.stack([node[at], node[at + step], np.zeros(len(at), np.int64), weight[at]], 1))
    rows = np.concatenate(found)
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(1)])
    return np.c_[rows[first, :3], np.add.reduceat(rows[:, 3], first)]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes that share a signature; rows come in order of signature and node."""

    def batch_of(found: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found[:, i].copy()) for i in range(4)], ["a", "b", "whole", "shared"])

    signature = node = np.empty(0, np.int64)
    for batch in batches:
        signature, node = (np.r_[h, batch.column(i).to_numpy()] for i, h in enumerate((signature, node)))
        if not len(signature):
            continue
        # The last group may go on in the next batch.
        last = int(np.searchsorted(signature, signature[-1]))
        if last:
            yield batch_of(_paired(signature[:last], node[:last]))
        signature, node = signature[last:], np.unique(node[last:])
        if len(node) > PAIRED + 1:
            # So many tell that it is large; the others are paired at once.
            yield batch_of(_paired(signature[: len(node)], node))
            node = node[: PAIRED + 1]
        signature = signature[: len(node)]
    if len(signature):
        yield batch_of(_paired(signature, node))


def _sets(batches: Iterator[pa.RecordBatch], words: int, bits) -> Iterator[pa.RecordBatch]:
    """The sets of documents that the filter lets pass; the last column has the hashes of their keys."""
    for batch in batches:
        passed = np.flatnonzero(may_hold(bits.value, batch.column(2).to_numpy().view(np.uint64)))
        chosen = batch.take(pa.array(passed))
        keys, rows, done, first = [], [], set(), []
        doc_keys = chosen.column(0).to_pylist()
        for at, elements in enumerate(shingle_sets(chosen.column(1), words)):
            if not len(elements) or (key := (doc_keys[at], set_key(elements))) in done:
                continue
            done.add(key)
            first.append(at)
            keys.append(key[1])
            rows.append(elements.tobytes())
        arrays = [chosen.column(0).take(pa.array(first, pa.int64())), pa.array(keys, pa.int64()), pa.array(rows, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_key", "node", "elements"])


class _Forest:
    """Which of a few sets are connected already."""

    def __init__(self, n: int) -> None:
        self._parent = list(range(n))

    def root(self, i: int) -> int:
        while self._parent[i] != i:
            self._parent[i] = i = self._parent[self._parent[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self._parent[self.root(i)] = self.root(j)


def spanning_links(sets: list[np.ndarray], side: np.ndarray, share: int = SHARE) -> Iterator[tuple[int, int]]:
    """Links that connect ``sets`` as all links between them do.

    ``side`` has 0 or 1 if only sets of different sides are compared, or all the same. Sets are
    compared by parity first: bits that tell whether an odd number of elements falls on them differ
    in no more places than the sets do. What passes is compared exactly.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sizes, side = sizes[order], side[order]
    across = side.min() != side.max()
    reach = np.searchsorted(sizes, sizes * PART // share, side="right")
    forest = _Forest(len(sets))
    parity = None
    if len(sets) > 8:
        bits = 1 << max(6, int(16 * _most_different(2 * int(sizes[-1]), share) - 1).bit_length())
        parity = np.empty((len(sets), bits // 64), np.uint64)
        for row, i in enumerate(order.tolist()):
            hits = np.bincount((mix(sets[i] + _U(5)) & _U(bits - 1)).astype(np.int64), minlength=bits)
            parity[row] = np.packbits((hits & 1).astype(bool)).view(np.uint64)
    for i in range(len(sets)):
        others = np.arange(i + 1, reach[i])
        if across:
            others = others[side[others] != side[i]]
        if parity is not None and len(others):
            apart = np.bitwise_count(parity[others] ^ parity[i]).sum(1)
            others = others[apart <= _most_different(sizes[others] + sizes[i], share)]
        for j in others.tolist():
            if forest.root(i) != forest.root(j):
                a, b = sets[order[i]], sets[order[j]]
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                if similar(int((b[at] == a).sum()), len(a), len(b), share):
                    forest.join(i, j)
                    yield int(order[i]), int(order[j])


_BLOCK_COLUMNS = ["cluster", "first", "second", "side", "node", "elements"]


def _compare(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """Links in every block; rows come in order of cluster and block."""
    held, nodes, sets, sides = None, [], [], []

    def links() -> pa.RecordBatch:
        found = spanning_links(sets, np.array(sides), share)
        pairs = [(nodes[i], nodes[j]) for i, j in found if nodes[i] != nodes[j]]
        columns = [pa.array([pair[i] for pair in pairs], pa.int64()) for i in range(2)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b"])

    for batch in batches:
        keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
        side, node = (batch.column(i).to_pylist() for i in (3, 4))
        for at, group in enumerate(keys):
            if group != held:
                if len(sets) > 1:
                    yield links()
                held, nodes, sets, sides = group, [], [], []
            if nodes and nodes[-1] == node[at] and sides[-1] == side[at]:
                continue
            nodes.append(node[at])
            sides.append(side[at])
            sets.append(np.frombuffer(batch.column(5)[at].as_buffer().to_pybytes(), np.uint64))
    if len(sets) > 1:
        yield links()


def _clusters(docs: DataFrame, nodes: DataFrame, words: int, share: int) -> DataFrame:
    """Nodes that may have links, and clusters (node, cluster) that no link leads out of.

    ``nodes`` has a row for each distinct set: node, doc_key, n_shingles, sketch.
    """
    bits = docs.sparkSession.sparkContext.broadcast(filter_words(nodes, "doc_key"))
    texts = docs.select("text", F.xxhash64("doc_key").alias("hash"))
    signed = texts.mapInArrow(lambda batches: _signed(batches, words, share, bits), "signature bigint, node bigint")
    sorted_ = signed.repartition("signature").sortWithinPartitions("signature", "node")
    shared = sorted_.mapInArrow(_candidates, "a bigint, b bigint, whole bigint, shared bigint")
    counted = shared.groupBy("a", "b", "whole").agg(F.sum("shared").alias("shared"))
    # Of two nodes that share a large signature, either is paired with its first one, whatever they share besides.
    pairs = stage(counted.where("whole = 1 or shared > 1").drop("shared"), "pairs")
    facts = [
        nodes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"size_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        for side in "ab"
    ]
    known = pairs.where("whole = 0").drop("whole").join(facts[0], "a").join(facts[1], "b")
    columns = ["a", "b", "size_a", "sketch_a", "size_b", "sketch_b"]
    # Staged, for what comes next has Python workers of its own.
    near = known.select(*columns).mapInArrow(lambda batches: _near(batches, share), "a bigint, b bigint")
    whole = pairs.where("whole = 1").select("a", "b")
    held = whole.groupBy("a").agg(F.count(F.lit(1)).alias("held"))
    sized = stage(whole.join(held, "a"), "whole")
    # Groups by their first node: every two nodes of a large signature are in one of them.
    compared = sized.where(F.col("held") < COMPARED).select("a", "b")
    with_first = compared.unionByName(compared.select("a", F.col("a").alias("b")).distinct())
    sketched = with_first.join(facts[1], "b").select("a", "b", "size_b", "sketch_b")
    within = sketched.repartition("a").sortWithinPartitions("a", "b")
    found = [
        stage(near, "near"),
        stage(within.mapInArrow(lambda batches: _near_within(batches, share), "a bigint, b bigint"), "near"),
        sized.where(F.col("held") >= COMPARED).select("a", "b"),
    ]
    return connected_components(found[0].unionByName(found[1]).unionByName(found[2]), "cluster")


def _links(docs: DataFrame, members: DataFrame, words: int, share: int) -> DataFrame:
    """Edges (a, b) between different sets, with the components that all links have.

    The sets of a cluster are dealt into blocks, and those of a block compared with each other and
    with one set of the cluster. If that leaves a cluster of several blocks in more than one
    component, the sketches of all sets but those of its largest are compared with all others. What
    this leaves together is dealt into blocks again, and only if one of these smaller clusters is left in
    more than one component, all its sets but those of the largest are compared with all others.
    """
    # A document with a doc_id, if the set has one, and the same for all its branches.
    row = F.struct((F.col("doc_key") == _LEAST).alias("nameless"), "doc_key", "n_shingles", "sketch")
    first = members.groupBy("node").agg(F.min(row).alias("least"))
    nodes = stage(first.select("node", "least.*").drop("nameless"), "nodes")
    clusters = _clusters(docs, nodes, words, share)
    picked = stage(nodes.drop("sketch").join(clusters, "node").select("node", "doc_key", "n_shingles", "cluster"), "clusters")
    links, unsettled = _within_blocks(docs, picked, words, share)
    if unsettled is None:
        return links
    narrowed = stage(_narrowed(unsettled, nodes.select("node", "sketch"), share), "clusters")
    further, unsettled = _within_blocks(docs, narrowed, words, share)
    links = links.unionByName(further)
    if unsettled is None:
        return links
    dealt = _across(unsettled, BLOCK_SETS, BLOCK_ELEMENTS)
    return links.unionByName(stage(_compared(docs, dealt, words, share), "links"))


def _blocks(rows: DataFrame, label: str, sets: int, elements: int) -> DataFrame:
    """How many blocks of about so many sets and elements the rows of each cluster make."""
    sizes = [F.ceil(F.count(F.lit(1)) / sets), F.ceil(F.sum("n_shingles") / elements)]
    return rows.groupBy("cluster").agg(F.greatest(*sizes).cast("int").alias(label))


def _within_blocks(docs: DataFrame, picked: DataFrame, words: int, share: int) -> tuple[DataFrame, DataFrame | None]:
    """Links within the blocks of clusters and with one set of each; and the sets of clusters that may have others.

    ``picked`` has node, doc_key, n_shingles, cluster. The sets of clusters that are left in more than one
    component come with their component and, as ``top``, the largest of the cluster; None if there are none.
    """
    totals = _blocks(picked, "blocks", BLOCK_SETS, BLOCK_ELEMENTS)
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = stage(picked.join(totals, "cluster").withColumn("block", block), "dealt")
    own = dealt.select("*", F.col("block").alias("first"), F.col("block").alias("second"), F.lit(0).alias("side"))
    # A cluster is named by one of its nodes; that one goes to all blocks.
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    centre = dealt.where("node = cluster and blocks > 1").select("*", F.explode(others).alias("first"))
    centre = centre.where("first <> block").withColumns({"second": F.col("first"), "side": F.lit(0)})
    links = stage(_compared(docs, own.unionByName(centre), words, share), "links")
    several = dealt.where("blocks > 1").drop("blocks", "block")
    if several.isEmpty():
        return links, None
    joined = several.join(connected_components(links).withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    found = stage(joined.withColumn("component", F.coalesce("component", "node")).drop("of"), "found")
    counts = found.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("sets"))
    largest = counts.groupBy("cluster").agg(F.max(F.struct("sets", "component")).alias("top"), F.count(F.lit(1)).alias("components"))
    open_ = largest.where("components > 1").select("cluster", F.col("top.component").alias("top"))
    unsettled = stage(found.join(open_, "cluster"), "unsettled")
    return links, None if unsettled.isEmpty() else unsettled


def _across(unsettled: DataFrame, sets: int, elements: int) -> DataFrame:
    """All sets but those of its cluster's largest component with all of the cluster, a block of either at a time."""
    rest = unsettled.where("component <> top")
    totals = _blocks(unsettled, "blocks", sets, elements).join(_blocks(rest, "rests", sets, elements), "cluster")
    to_blocks, to_rests = (F.explode(F.sequence(F.lit(0), F.col(n) - 1)) for n in ("blocks", "rests"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    of_rest = F.pmod(F.xxhash64("node", F.lit(1)), F.col("rests")).cast("int")
    left = rest.join(totals, "cluster").select("*", of_rest.alias("first"), to_blocks.alias("second"), F.lit(1).alias("side"))
    right = unsettled.join(totals, "cluster").select("*", to_rests.alias("first"), block.alias("second"), F.lit(0).alias("side"))
    return left.unionByName(right)


def _narrowed(unsettled: DataFrame, sketches: DataFrame, share: int) -> DataFrame:
    """Clusters as ``_within_blocks`` takes them, with all that may still be linked by sizes and sketches.

    Sketches go many times to other blocks where a cluster is large, a small part of the bytes of the sets.
    """
    dealt = _across(unsettled.join(sketches, "node"), SKETCH_BLOCKS * BLOCK_SETS, SKETCH_BLOCKS * BLOCK_ELEMENTS)
    rows = dealt.select(F.xxhash64("cluster", "first", "second").alias("a"), F.col("node").alias("b"), "n_shingles", "sketch")
    ordered = rows.repartition("a").sortWithinPartitions("a", "b")
    near = stage(ordered.mapInArrow(lambda batches: _near_within(batches, share), "a bigint, b bigint"), "near")
    known = unsettled.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    clusters = connected_components(near.unionByName(known), "narrow")
    found = stage(unsettled.drop("cluster", "top").join(clusters, "node"), "narrow")
    # Where one component is all of a cluster, nothing is left to find.
    several = found.groupBy("narrow").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    several = several.where("least < most").select(F.col("narrow").alias("cluster"))
    return found.withColumnRenamed("narrow", "cluster").join(several, "cluster").select("node", "doc_key", "n_shingles", "cluster")


def _compared(docs: DataFrame, dealt: DataFrame, words: int, share: int) -> DataFrame:
    """Links (a, b) within the blocks of ``dealt``: node, doc_key, cluster, first, second, side."""
    bits = docs.sparkSession.sparkContext.broadcast(filter_words(dealt, "doc_key"))
    # Filtered where it is hashed: a task has one Python worker, not two in a row.
    read = docs.select("doc_key", "text", F.xxhash64("doc_key").alias("hash"))
    sets = read.mapInArrow(lambda batches: _sets(batches, words, bits), "doc_key bigint, node bigint, elements binary")
    # Of rows that repeat a doc_key and its set one is enough.
    placed = dealt.select("node", "doc_key", *_BLOCK_COLUMNS[:4]).join(sets, ["doc_key", "node"])
    together = _BLOCK_COLUMNS[:3]
    ordered = placed.select(*_BLOCK_COLUMNS).repartition(*together).sortWithinPartitions(*together, "side", "node")
    return ordered.mapInArrow(lambda batches: _compare(batches, share), "a bigint, b bigint")


def jaccard_components(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Two documents are linked when their sets of ``words``-word shingles have ``share`` of 100
    elements in common. component_id is the smallest doc_id that links lead to. Null and empty texts and those
    without words have an empty set and no link. Copies, also of texts that differ in blanks or case
    only, are one node. A row without a doc_id takes part; it gets the component of its node, which
    is null if no other row of it has a doc_id. Further columns are ignored.
    """
    doc_id = F.when(F.col("doc_key") != _LEAST, F.col("doc_key"))
    found = _with_least(_known(docs), words, share, "", doc_id)
    return found.select(doc_id.alias("doc_id"), "n_shingles", F.col("least").alias("component_id"))


def _known(docs: DataFrame) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LEAST)).alias("doc_key")
    return docs.select(key, F.col("text").cast("string").alias("text"))


def _with_least(known: DataFrame, words: int, share: int, carried: str, value: Column) -> DataFrame:
    """Every row of ``known`` (doc_key, text, then ``carried``): doc_key, n_shingles, node, what is carried,
    and as ``least`` the smallest ``value`` of the rows that links lead to."""
    ship(known.sparkSession)
    schema = f"doc_key bigint, n_shingles bigint, node bigint, sketch binary{carried}"
    members = stage(known.mapInArrow(lambda batches: _nodes(batches, words), schema), "members")
    solid = members.where("node is not null")
    links = connected_components(_links(known.select("doc_key", "text"), solid, words, share))
    members, solid = members.drop("sketch"), solid.drop("sketch")
    least = solid.groupBy("node").agg(F.min(value).alias("own"))
    reached = links.join(least, "node").groupBy("component").agg(F.min("own").alias("reached"))
    moved = links.join(reached, "component").select(F.col("node").alias("linked"), "reached")
    named = least.join(moved, F.col("node") == F.col("linked"), "left").select(
        F.col("node").alias("of"), F.coalesce("reached", "own").alias("least")
    )
    found = solid.join(named, F.col("node") == F.col("of")).drop("of")
    return found.unionByName(members.where("node is null").withColumn("least", value))


def one_of_each_group(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """The rows of ``docs`` without linked ones: of each component that with the smallest doc_id stays.

    Where a doc_id has several texts, each is decided by itself; of those in one component one stays.
    Of rows that repeat a doc_id and its text one stays; rows without a doc_id all stay. Only
    documents that may go are shuffled, as a filter of fixed size tells.
    """
    text_hash = F.xxhash64(F.col("text").cast("string"))
    known = _known(docs.select("doc_id", "text")).withColumn("text_hash", text_hash)
    row = F.struct("doc_key", "text_hash")
    marked = _with_least(known, words, share, ", text_hash bigint", F.when(F.col("doc_key") != _LEAST, row))
    marked = marked.where(F.col("doc_key") != _LEAST).select("doc_key", "text_hash", (F.col("least") == row).alias("stays"))
    found = stage(marked, "components")
    named = found.groupBy("doc_key", "text_hash").agg(F.count(F.lit(1)).alias("rows"), F.bool_or("stays").alias("stays"))
    doubtful = named.where("rows > 1 or not stays").select(F.xxhash64("doc_key", "text_hash").alias("row"))
    bits = docs.sparkSession.sparkContext.broadcast(filter_words(doubtful, "row"))

    @F.pandas_udf("boolean")
    def may_go(hashed: pd.Series) -> pd.Series:
        return pd.Series(may_hold(bits.value, hashed.to_numpy().view(np.uint64)))

    doc_key = F.col("doc_id").cast("bigint")
    doubted = may_go(F.xxhash64(F.xxhash64(doc_key, text_hash)))
    kept = named.where("stays").select(F.col("doc_key").alias("_kept_key"), F.col("text_hash").alias("_kept_text"))
    same = (doc_key == kept["_kept_key"]) & (text_hash == kept["_kept_text"])
    looked_up = docs.where("doc_id is not null").where(doubted).join(kept, same, "left_semi")
    sure = docs.where(F.col("doc_id").isNull() | ~doubted)
    return sure.unionByName(looked_up.dropDuplicates(["doc_id", "text"]))
