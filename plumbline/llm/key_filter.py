"""A set of hashes as one bitmap of fixed size, to leave most rows out before a join.

The bitmap has no false negatives. Its share of false positives is at most the
number of keys over its bits, so an exact join follows; with more keys than bits
it lets everything pass and the join alone does the work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

BITS = 26  # 8 MB, whatever the number of keys


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Bits of the 64-bit hashes in ``column``. At most 2**20 words reach the driver."""
    place = F.shiftrightunsigned(F.col(column), 64 - BITS)
    words = (
        keys.select(place.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
    )
    found = words.toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes.view(np.uint64) >> np.uint64(64 - BITS)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def flag(known, column: str) -> Column:
    """Whether a broadcast bitmap may hold the hash in ``column``; only that column goes to Python."""

    @arrow_udf("boolean")
    def check(hashes: pa.Array) -> pa.Array:
        return pa.array(may_hold(known.value, hashes.to_numpy(zero_copy_only=False)))

    return check(F.col(column))
