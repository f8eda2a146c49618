"""A set of 64-bit keys as a bit set of fixed size: never misses a key, sometimes takes in another."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 27


def _slots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(37)).astype(np.int64), (mixed & np.uint64(BITS - 1)).astype(np.int64)


def bit_set(keys: DataFrame) -> np.ndarray:
    """The set of a table's only column, a long: BITS / 8 bytes at most reach the driver, whatever its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.concatenate(_slots(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(found)], names=["slot"])

    cells = keys.mapInArrow(run, "slot long").groupBy(F.shiftright("slot", 5).alias("cell"))
    found = cells.agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 31 AS INT))")).alias("bits")).toArrow()
    out = np.zeros(BITS // 32, dtype="<u4")
    out[found.column("cell").to_numpy()] = found.column("bits").to_numpy()
    return out


def contains(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Per key whether it may be in the set."""
    first, second = ((bits[s >> 5] >> (s & 31).astype(np.uint32)) & np.uint32(1) == 1 for s in _slots(keys))
    return first & second
