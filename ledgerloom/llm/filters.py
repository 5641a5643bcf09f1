"""A filter over ids: a fixed number of bits, whatever the number of ids.

It lets all of its ids pass and few others, more of them the more ids it has; what passes is joined
exactly later on. So its size bounds what is broadcast and never what is found.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 25


def filter_words(ids: DataFrame, column: str) -> np.ndarray:
    """The bits at the ``xxhash64`` of a column, as words of 64; 4 MB come to the driver."""
    at = F.pmod(F.xxhash64(column), F.lit(1 << BITS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({column}), 64L) as int))")
    found = ids.select(F.shiftright(at, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    rows = found.toPandas()
    words = np.zeros(1 << (BITS - 6), np.int64)
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return words.view(np.uint64)


def may_hold(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (``xxhash64``, 64 bits) may be among the ids."""
    at = hashes.astype(np.uint64, copy=False) & np.uint64((1 << BITS) - 1)
    return (words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
