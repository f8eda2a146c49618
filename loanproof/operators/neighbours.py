"""Distance to the nearest other row, exact, without comparing all pairs.

Rows that agree on all fields collapse first; their distance is 0. The distinct points are
cut into regions along the quantiles of a sample, so that a region fits a task. Each point
finds its nearest other point in its own region, which bounds the distance, and then visits
only the regions that this bound reaches. Within a region the same is done once more with
boxes. What a bound does not reach cannot hold a nearer point, so nothing is missed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanproof.operators.ordering import quantile_map
from loanproof.operators.prep import scale_values
from loanproof.session import let_go, materialize, materialize_packed, small_table

# Points one box may hold, and visits one task answers at a time.
BOX_POINTS = 250
VISITS = 65_536
# Rounds that the visits of all points are dealt to; each looks anew for the points that visit its regions.
MOST_ROUNDS = 8
# Points of a region, the unit that one task holds; a table beyond the number of regions has larger ones.
REGION_POINTS = 16_384
MOST_REGIONS = 4_096
# Sampled points per region that place the cuts, and the coordinates that the sample may have in all.
SAMPLED = 64
SAMPLE_CELLS = 4_000_000

CUTOFFS = (0.01, 0.05, 0.10, 0.25)


def standardized(df: DataFrame, columns: Sequence[str], row_id: str, medians: dict | None = None) -> tuple[DataFrame, dict]:
    """Median-filled fields scaled to mean 0 and population deviation 1, and the medians."""
    if medians is None:
        medians = {c: q[0.5] for c, q in quantile_map(df, columns, [0.5]).items()}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in columns}
    scales = scale_values(df, filled)
    made = [((filled[c] - F.lit(scales[c][0])) / F.lit(scales[c][1])).alias(f"x{i}") for i, c in enumerate(columns)]
    return df.select(row_id, *made), medians


def _dims(points: DataFrame) -> list[str]:
    return [c for c in points.columns if c.startswith("x")]


def _halves(points: np.ndarray) -> tuple[int, float] | None:
    """The widest dimension and its cut, with points on both sides of it; None if all points agree."""
    low = points.min(axis=0)
    dim = int(np.argmax(points.max(axis=0) - low))
    values = points[:, dim]
    above = values[values > low[dim]]
    if not len(above):
        return None
    return dim, float(max(np.partition(values, len(values) // 2)[len(values) // 2], above.min()))


def _region_tree(sample: np.ndarray, regions: int) -> list[tuple[int, float, int, int]]:
    """Nodes (dim, cut, below, above) that cut the sample into regions; a child -1 - r is region r."""
    nodes: list[tuple[int, float, int, int]] = []
    made = 0

    def grow(points: np.ndarray, wanted: int) -> int:
        nonlocal made
        cut = _halves(points) if wanted > 1 and len(points) > 1 else None
        if cut is None:
            made += 1
            return -made
        at = len(nodes)
        nodes.append((*cut, 0, 0))
        right = points[:, cut[0]] >= cut[1]
        more = min(max(round(wanted * right.mean()), 1), wanted - 1)
        nodes[at] = (*cut, grow(points[~right], wanted - more), grow(points[right], more))
        return at

    grow(sample, regions)
    return nodes


def _reached(tree: Sequence[tuple[int, float, int, int]], x: np.ndarray, radius: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(region, numbers of the points within their radius of it); the radius 0 gives the own region alone.

    Going down, each point carries how far it lies outside the cell along each dimension.
    """
    open_cells = [(0 if tree else -1, np.arange(len(x)), np.zeros_like(x))]
    while open_cells:
        node, mine, gaps = open_cells.pop()
        if node < 0:
            yield -1 - node, mine
            continue
        dim, cut, below, above = tree[node]
        right = x[mine, dim] >= cut
        outside = np.maximum(gaps[:, dim], np.abs(x[mine, dim] - cut))
        square = (gaps * gaps).sum(axis=1) - gaps[:, dim] ** 2 + outside**2
        near = (radius[mine] > 0) & (square <= (radius[mine] * (1 + 1e-9)) ** 2)
        for child, home in ((below, ~right), (above, right)):
            keep = home | near
            if keep.any():
                held = gaps[keep]
                held[:, dim] = np.where(home[keep], held[:, dim], outside[keep])
                open_cells.append((child, mine[keep], held))


def _coordinates(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    x = table.column("x")
    flat = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, 0))


def _nearest(targets: np.ndarray, queries: np.ndarray, skip_same: bool) -> np.ndarray:
    """Distance of each query to its nearest target, a block of queries at a time.

    Matrix products find the nearest target around a common centre; its distance is then
    computed from the differences, which loses no digits for close points.
    """
    out = np.full(len(queries), np.inf)
    if len(targets) == 0 or (skip_same and len(targets) < 2):
        return out
    centre = targets.mean(axis=0)
    t, q = targets - centre, queries - centre
    t_sq = (t * t).sum(axis=1)
    step = max(1, 4_000_000 // len(t))
    for start in range(0, len(q), step):
        block = q[start : start + step]
        sq = t_sq[None, :] - 2.0 * (block @ t.T)
        if skip_same:
            sq[np.arange(len(block)), start + np.arange(len(block))] = np.inf
        best = sq.argmin(axis=1)
        out[start : start + step] = np.sqrt(((queries[start : start + step] - targets[best]) ** 2).sum(axis=1))
    return out


def _boxes(points: np.ndarray, limit: int) -> list[np.ndarray]:
    """Numbers of the points of each box of at most ``limit`` points, cut in half along the widest dimension."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        mine = todo.pop()
        cut = _halves(points[mine]) if len(mine) > limit else None
        if cut is None:
            done.append(mine)
            continue
        right = points[mine, cut[0]] >= cut[1]
        todo += [mine[~right], mine[right]]
    return done


def _search(targets: np.ndarray, queries: np.ndarray | None, radius: np.ndarray, limit: int) -> np.ndarray:
    """Distance of each query to its nearest target within its radius, else infinite.

    Without ``queries`` the targets seek each other.
    """
    boxes = _boxes(targets, limit)
    seek = targets if queries is None else queries
    best = np.full(len(seek), np.inf)
    home = np.full(len(seek), -1)
    if queries is None:
        for k, box in enumerate(boxes):
            best[box], home[box] = _nearest(targets[box], targets[box], True), k
    for k, box in enumerate(boxes):
        held = targets[box]
        outside = np.maximum(np.maximum(held.min(axis=0) - seek, seek - held.max(axis=0)), 0.0)
        reach = np.minimum(best, radius) * (1 + 1e-9)
        mine = np.flatnonzero((home != k) & ((outside * outside).sum(axis=1) <= reach * reach))
        if len(mine):
            best[mine] = np.minimum(best[mine], _nearest(held, seek[mine], False))
    return best


def _region_kernel(tree: Sequence[tuple[int, float, int, int]]) -> Callable:
    """Adds the region of each point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _coordinates(batch)
            region = np.zeros(len(x), dtype=np.int32)
            for r, mine in _reached(tree, x, np.zeros(len(x))):
                region[mine] = r
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region)], names=[*batch.schema.names, "region"])

    return run


def _visit_kernel(tree: Sequence[tuple[int, float, int, int]], counted: bool, turn: tuple[int, int] = (1, 0)) -> Callable:
    """The visits of each point to regions other than its own, or how many each region gets.

    ``turn`` names the regions that have visitors now: those whose number leaves the second on division by the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, home = _coordinates(batch), batch.column("region").to_numpy()
            for r, mine in _reached(tree, x, batch.column("radius").to_numpy()):
                if r % turn[0] != turn[1]:
                    continue
                mine = mine[home[mine] != r]
                if counted:
                    yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([len(mine)], pa.int64())], names=["region", "n"])
                elif len(mine):
                    got = batch.take(pa.array(mine))
                    columns = [pa.repeat(r, len(mine)).cast(pa.int32()), *[got.column(c) for c in ("point", "x", "radius")]]
                    yield pa.RecordBatch.from_arrays(columns, names=["region", "point", "x", "radius"])

    return run


def nearest_other_distance(
    points: DataFrame,
    row_id: str,
    reach: float | str | None = None,
    box_points: int = BOX_POINTS,
    visits: int = VISITS,
    region_points: int = REGION_POINTS,
) -> DataFrame:
    """(point, copies, distance) per distinct point: Euclidean distance to the nearest other row.

    ``points`` holds the id and the coordinates x0, x1, .. A point with copies has distance
    0; a table with a single row gives NULL, and so does a point with a missing coordinate,
    which is near to nothing. With ``reach`` only distances up to it are
    exact, and a larger one is known to be larger: that is all a count below a cutoff needs.
    ``reach='median'`` takes the median of the first bounds (at least 0.25), which the true
    median cannot exceed.
    """
    dims = _dims(points)
    grouped = points.groupBy(*dims).agg(F.count("*").alias("copies"), F.min(row_id).alias("point"))
    distinct = materialize_packed(grouped.select("point", "copies", F.array(*dims).alias("x")))
    del grouped
    let_go(points)  # the shuffle that collapsed the copies
    whole = F.forall("x", lambda e: e.isNotNull() & (F.abs(e) < math.inf))
    placed, unplaced = distinct.filter(whole), distinct.filter(~whole)
    size = placed.count()
    regions = min(MOST_REGIONS, math.ceil(size / region_points))
    tree: list[tuple[int, float, int, int]] = []
    if regions > 1:
        share = min(1.0, min(SAMPLED * regions, SAMPLE_CELLS // len(dims)) / size)
        sampled = placed.filter(F.pmod(F.xxhash64("x"), F.lit(1 << 40)) <= int(share * (1 << 40)))
        tree = _region_tree(_coordinates(sampled.select("x").toArrow()), regions)
    id_type = points.schema[row_id].dataType.simpleString()
    boxed = placed.mapInArrow(_region_kernel(tree), T.StructType([*placed.schema.fields, T.StructField("region", T.IntegerType())]))
    far = math.inf if reach in (None, "median") else float(reach)

    def own_region(table: pa.Table) -> pa.Table:
        x = _coordinates(table)
        return table.append_column("bound", pa.array(_search(x, None, np.full(len(x), far), box_points)))

    # Copies are at distance 0 already, but they stay as targets for other points.
    local = boxed.groupBy("region").applyInArrow(own_region, T.StructType([*boxed.schema.fields, T.StructField("bound", T.DoubleType())]))
    local = materialize_packed(local)
    let_go(points)
    own = local.select("point", F.when(F.col("copies") > 1, 0.0).otherwise(F.col("bound")).alias("distance"), "copies")
    lone = F.when(F.col("copies") > 1, 0.0).otherwise(math.inf)
    own = own.unionByName(unplaced.select("point", lone.alias("distance"), "copies"))
    if reach == "median":
        far = max(_median_ends(own.filter(F.col("distance") < math.inf))[1] or math.inf, max(CUTOFFS))
    both = own
    if tree:
        visiting = local.filter("copies = 1").select("region", "point", "x", F.least("bound", F.lit(far)).alias("radius"))
        # A region that many points visit answers them in shares; its own points go to each share.
        counts = visiting.select("region", "x", "radius").mapInArrow(_visit_kernel(tree, True), "region int, n long")
        counts = counts.groupBy("region").agg(F.sum("n").alias("n")).filter("n > 0")
        shares = materialize(counts.withColumn("shares", F.ceil(F.col("n") / F.lit(visits)).cast("int")))

        def answer(seek: pa.Table, held: pa.Table) -> pa.Table:
            got = np.zeros(0)
            if seek.num_rows:
                got = _search(_coordinates(held), _coordinates(seek), seek.column("radius").to_numpy(), box_points)
            return pa.table({"point": seek.column("point"), "distance": pa.array(got)})

        # A round of regions has about as many visits as there are points; its shuffles go before the next.
        rounds = min(MOST_ROUNDS, math.ceil((shares.agg(F.sum("n")).first()[0] or 0) / size))
        for turn in range(rounds):
            open_shares = F.broadcast(shares.filter(F.col("region") % rounds == turn).drop("n"))
            seekers = (
                visiting.mapInArrow(_visit_kernel(tree, False, (rounds, turn)), f"region int, point {id_type}, x array<double>, radius double")
                .join(open_shares, "region")
                .withColumn("share", F.pmod(F.xxhash64("x"), F.col("shares")).cast("int"))
            )
            members = local.join(open_shares, "region").select(
                "region", "x", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")
            )
            answers = (
                seekers.select("region", "share", "point", "x", "radius")
                .groupBy("region", "share")
                .cogroup(members.groupBy("region", "share"))
                .applyInArrow(answer, f"point {id_type}, distance double")
            )
            found = materialize(answers.filter(F.col("distance") < math.inf).groupBy("point").agg(F.min("distance").alias("distance")))
            both = both.unionByName(found.withColumn("copies", F.lit(None).cast("bigint")))
            del open_shares, seekers, members, answers, found
            let_go(points)
    best = both.groupBy("point").agg(F.min("distance").alias("d"), F.max("copies").alias("copies"))
    return best.select("point", "copies", F.when(F.col("d") < math.inf, F.col("d")).alias("distance"))


def near_duplicate_screen(
    raw: DataFrame, survivors: DataFrame, columns: Sequence[str], row_id: str, pairs: DataFrame,
    cutoffs: Sequence[float] = CUTOFFS, **limits,
) -> DataFrame:
    """The screen: exact pairs, median distance, rows with a neighbour within each cutoff,
    and the rows within 0.10 once exact copies are removed.

    The second pass fills with the medians of the first and scales anew, and looks no
    farther than its cutoff. Distances are counted per point with its number of copies.
    """
    spark = raw.sparkSession
    exact = pairs.select(F.col("pairs").cast("double")).first()[0]
    unique = materialize_packed(survivors.select(row_id, *columns))
    let_go(raw)
    points, medians = standardized(raw, columns, row_id)
    first = materialize(nearest_other_distance(points, row_id, "median", **limits))
    low, high = _median_ends(first)
    median = None if low is None else (low + high) / 2
    counts = first.agg(
        *[F.coalesce(F.sum(F.when(F.col("distance") < c, F.col("copies"))), F.lit(0)).cast("double").alias(_within(c)) for c in cutoffs]
    ).first()
    del points, first
    let_go(raw)  # each pass leaves its shuffles and tables before the next begins
    after, _ = standardized(unique, columns, row_id, medians)
    second = nearest_other_distance(after, row_id, 0.10, **limits)
    left = second.agg(F.coalesce(F.sum(F.when(F.col("distance") < 0.10, F.col("copies"))), F.lit(0)).cast("double")).first()[0]
    checks = [("exact_duplicate_pairs", exact), ("median_nearest_distance", median), *counts.asDict().items(), (f"{_within(0.10)}_after_removal", left)]
    del unique, after, second
    let_go(raw)
    return small_table(spark, {"check": "string", "value": "double"}, checks)


def _within(cutoff: float) -> str:
    return f"rows_within_{cutoff:.2f}".replace(".", "_")


def _median_ends(distances: DataFrame) -> tuple[float | None, float | None]:
    """The two middle distances over rows: zeros of copies are counted, the rest ranked."""
    seen = distances.filter(F.col("distance").isNotNull())
    row = seen.agg(
        F.sum(F.when(F.col("copies") > 1, F.col("copies"))).alias("zeros"), F.count_if(F.col("copies") == 1).alias("rest")
    ).first()
    zeros, rest = row["zeros"] or 0, row["rest"] or 0
    if not zeros + rest:
        return None, None
    spots = [math.floor((zeros + rest - 1) / 2), math.ceil((zeros + rest - 1) / 2)]
    probs = {k: (k - zeros) / max(rest - 1, 1) for k in spots if k >= zeros}
    found = {}
    if probs:
        singles = seen.filter("copies = 1").select("distance")
        found = quantile_map(singles, ["distance"], sorted(set(probs.values())))["distance"]
    low, high = (found[probs[k]] if k in probs else 0.0 for k in spots)
    return low, high
