"""Positions, running totals and exact quantiles without a one-task window.

A window over a whole table moves all rows to one task. The operators here range
partition the rows instead, fix that layout with a checkpoint, and add per-partition
offsets from a table with one row per partition.
"""

from __future__ import annotations

import math
import struct
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanproof.functions.columns import ColumnLike, _col
from loanproof.session import materialize, packed, small_table, unpacked

# Bits that one pass of a radix selection resolves.
DIGIT = 16

_SLOT = "_slot"
_PLACE = "_place"
_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
_BEFORE_HERE = (Window.unboundedPreceding, -1)


def row_ordinal(df: DataFrame, order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Adds the 0-based position of each row in the total order of ``order``.

    One range shuffle and one local sort. The place inside a partition comes from the low
    bits of ``monotonically_increasing_id``; the partition sizes are at most one row per
    partition, so the offsets table is small by construction and is broadcast.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PLACE, F.monotonically_increasing_id())
    )
    fixed = materialize(ranged).withColumn(_SLOT, F.shiftright(_PLACE, 33))
    sizes = fixed.groupBy(_SLOT).agg(F.count("*").alias("_n"))
    offsets = sizes.select(
        _SLOT,
        F.coalesce(F.sum("_n").over(Window.orderBy(_SLOT).rowsBetween(*_BEFORE_HERE)), F.lit(0)).alias("_offset"),
    )
    inside = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        fixed.join(F.broadcast(offsets), _SLOT)
        .withColumn(name, F.col("_offset") + inside)
        .drop(_SLOT, _PLACE, "_offset")
    )


def running_totals(
    cells: DataFrame,
    order: str,
    totals: dict[str, str],
    groups: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Adds inclusive running totals per group, in the order of one column.

    ``totals`` maps new columns to summed columns; the sum over the whole group comes along
    as ``<new>_all``. The caller passes *cells* (one row per distinct order value), so equal
    values are one row and a hot value is no hot task. A group larger than a partition spans
    several partitions: the window works on (group, partition), and the offsets carry the
    sums of the partitions before it.
    """
    groups = list(groups)
    key = F.col(order).desc() if descending else F.col(order).asc()
    ranged = cells.repartitionByRange(*[F.col(g) for g in groups], key).withColumn(
        _SLOT, F.spark_partition_id()
    )
    fixed = materialize(ranged)
    slot_sums = fixed.groupBy(*groups, _SLOT).agg(
        *[F.sum(src).alias(f"_sum_{new}") for new, src in totals.items()]
    )
    whole = Window.partitionBy(*groups)
    earlier = whole.orderBy(_SLOT).rowsBetween(*_BEFORE_HERE)
    keys = [F.col(g).alias(f"_k{i}") for i, g in enumerate(groups)]
    offsets = slot_sums.select(
        *keys,
        F.col(_SLOT).alias("_kslot"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_off_{n}") for n in totals],
        *[F.sum(f"_sum_{n}").over(whole).alias(f"{n}_all") for n in totals],
    )
    match = F.col(_SLOT) == F.col("_kslot")
    for i, g in enumerate(groups):
        match = match & F.col(g).eqNullSafe(F.col(f"_k{i}"))
    within = Window.partitionBy(*groups, _SLOT).orderBy(key).rowsBetween(*_UP_TO_HERE)
    out = fixed.join(offsets, match)
    for new, src in totals.items():
        out = out.withColumn(new, F.sum(src).over(within) + F.col(f"_off_{new}"))
    return out.select(*cells.columns, *totals, *[f"{n}_all" for n in totals])


def keys_at_positions(
    df: DataFrame,
    coarse: ColumnLike,
    order: Sequence[str],
    positions: Callable[[int], Sequence[int]],
) -> list[tuple | None]:
    """The ``order`` keys of the rows at 0-based positions of the total order.

    ``positions`` gets the number of rows, which the histogram already tells.

    ``coarse`` must be monotone in the order and have few values (a date, a hash prefix).
    Its running histogram tells which cells hold the positions; only the rows of those cells are
    put in order. The table itself is never sorted. Positions at or past the end give None.
    """
    cell = _col(coarse)
    total, placed = _placed_cells(df.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")))
    spots = positions(total)
    found: list[tuple | None] = [None] * len(spots)
    held = _cells_at(placed, [p for p in spots if 0 <= p < total])
    hits: dict[object, list[tuple[int, int]]] = {}
    sizes = {}
    for value, start, n in held:
        sizes[value] = n
        for slot, p in enumerate(spots):
            if start <= p < start + n:
                hits.setdefault(value, []).append((slot, p - start))
    if not hits:
        return found
    rows = df.filter(cell.isin(*hits)).select(*order)
    wanted, offset = {}, 0
    for value in sorted(hits):
        for slot, p in hits[value]:
            wanted.setdefault(offset + p, []).append(slot)
        offset += sizes[value]
    placed = row_ordinal(rows, order).filter(F.col("ordinal").isin(*wanted))
    for row in placed.collect():
        for slot in wanted[row["ordinal"]]:
            found[slot] = tuple(row[c] for c in order)
    return found


def at_or_after(order: Sequence[str], key: tuple) -> Column:
    """Whether a row is at or after ``key`` in the order of the columns."""
    left = F.struct(*[F.col(c) for c in order])
    right = F.struct(*[F.lit(v).alias(c) for c, v in zip(order, key)])
    return left >= right


def date_at_quantiles(df: DataFrame, date: str, probs: Sequence[float], weight: str | None = None) -> list:
    """Dates at the quantiles, always an existing date: position ceil((n - 1) * q).

    Needs only the number of rows per day; the driver gets the days at the quantiles. ``weight``
    names a column of row counts when the input already holds sums.
    """
    size = F.count("*") if weight is None else F.sum(weight)
    days = df.filter(F.col(date).isNotNull()).groupBy(F.col(date).alias("cell")).agg(size.alias("n"))
    total, placed = _placed_cells(days)
    spots = [math.ceil((total - 1) * q) for q in probs]
    held = _cells_at(placed, spots) if total else []
    return [next((day for day, start, n in held if start <= p < start + n), None) for p in spots]


def _placed_cells(histogram: DataFrame) -> tuple[int, DataFrame]:
    """The rows of a histogram (cell, n) in all, and its cells with the running count ``cum``."""
    cells = materialize(histogram)
    total = cells.agg(F.sum("n")).first()[0] or 0
    return total, running_totals(cells, "cell", {"cum": "n"})


def _cells_at(placed: DataFrame, spots: Sequence[int]) -> list[tuple]:
    """(cell, first position, rows) of the cells that hold a position: at most one each."""
    if not spots:
        return []
    hit = F.exists(F.array(*[F.lit(int(p)) for p in sorted(set(spots))]), lambda p: (p < F.col("cum")) & (p >= F.col("cum") - F.col("n")))
    return sorted((r["cell"], r["cum"] - r["n"], r["n"]) for r in placed.filter(hit).select("cell", "cum", "n").collect())


def _ordered_keys(values: np.ndarray) -> np.ndarray:
    """64-bit keys in the order of the doubles: NaN last, both zeros alike."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, ~bits, bits | np.int64(-(2**63))).view(np.uint64)


def _key_value(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else ~key & (2**64 - 1)
    return struct.unpack("<d", struct.pack("<Q", bits))[0]


def _digit_counts(width: int, level: int, prefixes: list[np.ndarray]):
    """Counts of the next ``DIGIT`` bits below the wanted prefixes of each field, added up per task."""
    above, below = np.uint64(64 - DIGIT * level), np.uint64(64 - DIGIT * (level + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[Counter] = [Counter() for _ in range(width)]
        for batch in unpacked(batches):
            for k in range(width):
                keys = _ordered_keys(batch.column(k).drop_null().to_numpy(zero_copy_only=False))
                if level:
                    keys = keys[np.isin(keys >> above, prefixes[k])]
                codes, counts = np.unique(keys >> below, return_counts=True)
                sums[k].update(dict(zip(codes.tolist(), counts.tolist())))
        for k, held in enumerate(sums):
            codes = np.fromiter(held.keys(), dtype=np.uint64, count=len(held)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.repeat(k, len(held)).cast(pa.int32()), pa.array(codes), pa.array(held.values(), pa.int64())], names=["k", "code", "n"])

    return run


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: rows of (field, prob, value), none for an empty field.

    Spark's ``percentile`` merges all distinct values in one task. Here the positions are found by radix
    selection on order-preserving 64-bit keys: a pass counts the leading bits of all fields at once, keeps
    the buckets that hold a position, and the next pass counts the following bits of their values only.
    ``64 / DIGIT`` passes name each value to the last bit, at every size and with any ties; a pass sends
    at most 2^DIGIT counts per field and wanted bucket.
    """
    columns = list(columns)
    rows = materialize(packed(df.select(*[F.col(c).cast("double").alias(f"v{k}") for k, c in enumerate(columns)])))
    spots: dict[tuple[int, int], tuple[int, int]] = {}  # (field, position): prefix so far, position within it
    totals: list[int] = []
    for level in range(64 // DIGIT):
        wanted = [np.array(sorted({prefix for (f, _), (prefix, _) in spots.items() if f == k}), dtype=np.uint64) for k in range(len(columns))]
        counted = rows.mapInArrow(_digit_counts(len(columns), level, wanted), "k int, code long, n long")
        found = counted.groupBy("k", "code").agg(F.sum("n").alias("n")).toArrow()
        field, code, n = (found.column(c).to_numpy() for c in ("k", "code", "n"))
        code = code.astype(np.int64).view(np.uint64)
        order = np.lexsort((code, field))
        field, code, n = field[order], code[order], n[order]
        if not level:
            totals = [int(n[field == k].sum()) for k in range(len(columns))]
            for k, total in enumerate(totals):
                for p in probs if total else ():
                    spots[k, math.floor((total - 1) * p)] = spots[k, math.ceil((total - 1) * p)] = (0, 0)
            spots = {key: (0, key[1]) for key in spots}
        for (k, position), (prefix, rank) in spots.items():
            mine = field == k
            if level:
                mine &= (code >> np.uint64(DIGIT)) == np.uint64(prefix)
            ends = np.cumsum(n[mine])
            at = int(np.searchsorted(ends, rank, side="right"))
            spots[k, position] = int(code[mine][at]), rank - (int(ends[at - 1]) if at else 0)
    out = []
    for k, c in enumerate(columns):
        for p in probs if totals[k] else ():
            spot = (totals[k] - 1) * p
            low, high = (_key_value(spots[k, side(spot)][0]) for side in (math.floor, math.ceil))
            out.append((c, float(p), low if low == high else low + (high - low) * (spot - math.floor(spot))))
    return small_table(df.sparkSession, {"field": "string", "prob": "double", "value": "double"}, out)


def quantile_map(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict:
    """The quantiles as driver values: {field: {prob: value}}; a few numbers per column."""
    out: dict[str, dict[float, float | None]] = {c: {float(p): None for p in probs} for c in columns}
    for row in exact_quantiles(df, columns, probs).collect():
        out[row["field"]][row["prob"]] = row["value"]
    return out


def weighted_quantile(value: str, cum: str, prob: float) -> Column:
    """Aggregate: the linear quantile from values with running and whole counts."""
    spot = (F.col(f"{cum}_all") - 1) * F.lit(float(prob))
    low = F.min(F.when(F.col(cum) > F.floor(spot), F.col(value).cast("double")))
    high = F.min(F.when(F.col(cum) > F.ceil(spot), F.col(value).cast("double")))
    return low + (high - low) * F.max(spot - F.floor(spot))
