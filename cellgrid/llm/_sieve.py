"""A bit map of 64-bit keys with a fixed size, built in the cluster: it thins rows before an exact join.

It never loses a key.  With more keys than bits it lets more rows through, and the join behind it still
decides; so its size bounds what is sent to the tasks, whatever the input.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2 MB; the driver gets at most 2**18 rows.
BITS = 1 << 24


def sieve(keys: DataFrame, key: str) -> np.ndarray:
    """The bit map (64-bit words) of a long column."""
    bit = F.col(key).bitwiseAND(F.lit(BITS - 1))
    words = keys.where(F.col(key).isNotNull()).select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast(`{key}` & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(BITS // 64, dtype=np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out.view(np.uint64)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (int64) may be in the map."""
    at = keys & (BITS - 1)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
