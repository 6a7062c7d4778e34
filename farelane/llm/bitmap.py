"""A bitmap of fixed size over 64-bit hashes, for skipping rows in a scan.

It holds the low ``BITS`` bits of the listed hashes: 2 MB, whatever the number
of rows.  A listed hash is always found; others are found by chance, more often
the fuller the bitmap, so whatever passes is joined exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24


def collect(hashes: DataFrame, column: str) -> np.ndarray:
    """The bitmap of a bigint column, as 64-bit words; at most 2**(BITS - 6) rows reach the driver."""
    bucket = F.col(column).bitwiseAND((1 << BITS) - 1)
    bit = F.expr(f"shiftleft(1L, cast(({column} & 63) as int))")
    rows = hashes.select(F.shiftright(bucket, 6).alias("w"), bit.alias("bit")).groupBy("w").agg(F.expr("bit_or(bit)").alias("bits")).collect()
    words = np.zeros(1 << (BITS - 6), np.uint64)
    for r in rows:
        words[r["w"]] = r["bits"] & ((1 << 64) - 1)
    return words


def listed(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True where the hash may be listed."""
    bucket = hashes.astype(np.uint64, copy=False) & np.uint64((1 << BITS) - 1)
    return (words[(bucket >> np.uint64(6)).astype(np.int64)] >> (bucket & np.uint64(63))) & np.uint64(1) == 1
