"""Word shingles of texts as 64-bit hashes, worked out on the bytes of a whole Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 4
# Bytes of text that are hashed at once; a worker needs some hundred times as many.
_BLOCK = 256 * 1024
_U = np.uint64
_GAMMA = _U(0x9E3779B97F4A7C15)
# Fixed odd number, powers of which weigh the bytes of a word by their place.
_BASE = _U(0xD6E8FEB86659FD93)
_BASE_INVERSE = _U(pow(int(_BASE), -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers that leaves no order in them."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_values() -> np.ndarray:
    """A number for each byte, the same for A-Z and a-z; 0 for the blanks between words."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * _GAMMA)
    values[65:91] = values[97:123]
    values[[32, 9, 10, 11, 12, 13]] = 0
    return values


_VALUES = _byte_values()
_POWERS = np.multiply.accumulate(np.r_[_U(1), np.full(_BLOCK, _BASE)])
_INVERSES = np.multiply.accumulate(np.r_[_U(1), np.full(_BLOCK, _BASE_INVERSE)])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts ``data[offsets[i]:offsets[i + 1]]`` and how many each text has."""
    powers, inverses = _POWERS, _INVERSES
    if len(data) >= len(powers):  # one text longer than a block
        powers = np.multiply.accumulate(np.r_[_U(1), np.full(len(data), _BASE)])
        inverses = np.multiply.accumulate(np.r_[_U(1), np.full(len(data), _BASE_INVERSE)])
    values = _VALUES[data]
    solid = values != 0
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | first[1:]
    starts = np.flatnonzero(starts)
    values *= powers[: len(data)]
    summed = np.r_[_U(0), np.cumsum(values, dtype=np.uint64)]
    # Blanks add nothing, so a word may be summed up to the start of the next one.
    ends = np.r_[starts[1:], len(data)]
    words = mix((summed[ends] - summed[starts]) * inverses[starts])
    counts = np.diff(np.searchsorted(starts, offsets))
    return words, counts


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles.

    Words are what stands between blanks (space, tab to carriage return), A-Z like a-z. A text with
    fewer than ``words`` of them has all of them as its one shingle; without any it has none.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buffer or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _BLOCK, side="right")) - 1)
        block = data[offsets[at] : offsets[to]]
        hashes, counts = word_hashes(block, offsets[at : to + 1] - offsets[at])
        summed = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        weights = mix(np.arange(1, words + 1, dtype=np.uint64) * _GAMMA) | _U(1)
        for i, w in enumerate(weights):
            summed += hashes[i : i + len(summed)] * w
        shingles = mix(summed)
        start = 0
        for n in counts.tolist():
            if n >= words:
                yield np.unique(shingles[start : start + n - words + 1])
            elif n:
                short = hashes[start : start + n] * weights[:n]
                yield mix(np.array([short.sum(dtype=np.uint64) + _U(n)]))
            else:
                yield np.empty(0, np.uint64)
            start += n
        at = to
