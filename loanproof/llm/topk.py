"""Exact top-k search by inner product as a Voronoi join.

Vectors become integers, floor(256 x). At most ``PIVOTS`` pivots, centres of a bounded sample,
cut the table into cells; a summary per cell (its number of rows, its radius, its longest vector)
bounds every inner product from above: q.x <= min(q.p + |q| r, |q| longest). A first pass lets
each query search one chunk of its own cell and so gives it a lower bound; it is then sent
only to the cells whose bound reaches that. Cells are cut into chunks of about ``CHUNK`` rows by
a hash of the id, so a cell with a third of all rows (or one vector, repeated) spreads over
tasks. Within a task a chunk is held as one matrix and queries stream past it; each leaves
with its best k of that chunk, and a last aggregate keeps the best k of all.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part; a
shorter vector is padded with zeros; scores are exact at every size, beyond 64 bits in products
too, and a component of 2**62 or more or a result that is no long ends the query with an error
that names its row; a row is no candidate for queries of its own id; a repeated candidate row counts as often as it occurs,
a repeated query row once; ties go to the smaller id; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanproof.session import materialize, ship_package

K = 5
EVERY = 50
PIVOTS = 64
SAMPLE = 4_096
CHUNK = 4_096
_EDGE = 2.0**62
_LONG = 2**63 - 1


def quantised(rows: DataFrame) -> DataFrame:
    """vec_id and v (floor(256 x) as longs) of the vectors that take part."""
    x = F.col("embedding")
    good = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    wide = F.raise_error(F.concat(F.lit("vec_id "), F.col("vec_id").cast("string"), F.lit(": a component of 2^62 or more")))
    scaled = F.transform(x, lambda c: c.cast("double") * 256)
    whole = F.transform(scaled, lambda c: F.when(F.abs(c) < _EDGE, F.floor(c).cast("long")).otherwise(wide.cast("long")))
    return rows.filter(good & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a float matrix, padded with zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def choose_pivots(sample: np.ndarray, pivots: int = PIVOTS, rounds: int = 8) -> np.ndarray:
    """Centres of the sample by a few Lloyd rounds; a row count of the sample bounds their number."""
    count = max(1, min(pivots, len(sample) // 8))
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(sample, centres)[0]
        sizes = np.bincount(own, minlength=count)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row and the distance to it."""
    gaps = (x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1)
    own = gaps.argmin(axis=1)
    return own, np.sqrt(((x - centres[own]) ** 2).sum(axis=1))


def best_of(ids: np.ndarray, data: np.ndarray, asked: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position of the query, vec_id, score) of each query's best k rows; ids ascend, so ties keep the smaller."""
    # Python numbers: their product does not wrap around.
    largest = int(np.abs(data).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, data.shape[1])
    if largest < 2**53:
        scores = (queries @ data.T).astype(np.int64)
    elif largest <= _LONG:
        scores = queries.astype(np.int64) @ data.astype(np.int64).T
    else:
        scores = _wide_products(queries, data)
    lowest = np.iinfo(np.int64).min
    scores[asked[:, None] == ids[None, :]] = lowest
    if len(ids) > 4 * k:
        edge = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
    else:
        edge = np.full(len(scores), lowest)
    row, column = np.nonzero((scores >= edge[:, None]) & (scores > lowest))
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    found = rank < k
    row, column = row[found], column[found]
    beyond = np.abs(scores[row, column]) == _LONG
    if beyond.any():
        raise OverflowError(f"the score of vec_id {ids[column[beyond][0]]} for query {asked[row[beyond][0]]} is no long")
    return row, ids[column], scores[row, column]


def _wide_products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact inner products of components below 2**62, held at +-_LONG where they are larger."""
    held = data.astype(np.int64).astype(object).T
    scores = np.empty((len(queries), len(data)), dtype=np.int64)
    for s in range(0, len(queries), 16):  # Python numbers take room: few queries at a time
        block = queries[s : s + 16].astype(np.int64).astype(object) @ held
        scores[s : s + 16] = np.clip(block, -_LONG, _LONG).astype(np.int64)
    return scores


def _solve(width: int, k: int):
    """Streams a partition sorted by (cell, chunk, kind): rows of kind 0 are the chunk, kind 1 asks it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, data, ready = None, [], [], None
        for batch in batches:
            spot = batch.column("cell").to_numpy() * (1 << 32) + batch.column("chunk").to_numpy()
            kind = batch.column("kind").to_numpy()
            vec, matrix = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), width)
            edges = np.flatnonzero(np.concatenate(([True], (spot[1:] != spot[:-1]) | (kind[1:] != kind[:-1]), [True])))
            for a, b in zip(edges[:-1], edges[1:]):
                if spot[a] != key:
                    key, ids, data = spot[a], [], []
                if kind[a] == 0:
                    ids.append(vec[a:b])
                    data.append(matrix[a:b])
                    continue
                if not ids:
                    continue
                if ready != key:
                    all_ids, all_data = np.concatenate(ids), np.concatenate(data)
                    order = np.argsort(all_ids, kind="stable")
                    ids, data, ready = [all_ids[order]], [all_data[order]], key
                for s in range(a, b, 1024):
                    e = min(b, s + 1024)
                    row, got, score = best_of(ids[0], data[0], vec[s:e], matrix[s:e], k)
                    yield pa.RecordBatch.from_arrays([pa.array(vec[s:e][row]), pa.array(got), pa.array(score)], names=["query_id", "vec_id", "score"])

    return run


def top_k(rows: DataFrame, k: int = K, every: int = EVERY, pivots: int = PIVOTS, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows; queries are the ids divisible by ``every``."""
    spark = rows.sparkSession
    ship_package(spark)
    data = quantised(rows)
    sample = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow().sort_by("vec_id")  # a bounded sample for the pivots
    width = data.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    columns = sample["v"].combine_chunks()
    centres = choose_pivots(_matrix(columns.chunk(0) if isinstance(columns, pa.ChunkedArray) else columns, width), pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            own, gap = nearest(x, centres) if len(x) else (np.zeros(0, dtype=np.int64), np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(own), pa.array(gap), pa.array(np.sqrt((x**2).sum(axis=1)))], names=["vec_id", "v", "cell", "gap", "norm"])

    placed = materialize(data.mapInArrow(place, "vec_id long, v array<long>, cell long, gap double, norm double"))
    summary = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius"), F.max("norm").alias("longest")).toArrow()  # a row per pivot
    radius, longest, parts = np.full(len(centres), -np.inf), np.zeros(len(centres)), np.ones(len(centres), dtype=np.int64)
    at = summary["cell"].to_numpy()
    far = np.sqrt((centres**2).sum(axis=1))
    radius[at], longest[at] = summary["radius"].to_numpy(), summary["longest"].to_numpy()
    parts[at] = -(-summary["n"].to_numpy() // chunk)
    dealt = F.element_at(F.array(*[F.lit(int(p)) for p in parts]), F.col("cell").cast("int") + 1)
    chunk_of = F.pmod(F.xxhash64("vec_id"), dealt.cast("long")).alias("chunk")
    stored = placed.select("cell", chunk_of, F.lit(0).cast("long").alias("kind"), "vec_id", "v")
    queries = materialize(placed.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"]).select("cell", chunk_of, "vec_id", "v"))

    def answered(asked: DataFrame) -> DataFrame:
        spread = stored.unionByName(asked.select("cell", "chunk", F.lit(1).cast("long").alias("kind"), "vec_id", "v"))
        spread = spread.repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "kind")
        return spread.mapInArrow(_solve(width, k), "query_id long, vec_id long, score long")

    first = answered(queries).groupBy("query_id").agg(F.min("score").alias("bound"), F.count("*").alias("n"))
    bounded = queries.join(materialize(first).withColumnRenamed("query_id", "vec_id"), "vec_id", "left").select("vec_id", "v", F.when(F.col("n") >= k, F.col("bound")).alias("bound"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column("v"), width)
            bound = np.array([-np.inf if b is None else float(b) for b in batch.column("bound").to_pylist()])
            norm = np.sqrt((q**2).sum(axis=1))[:, None]
            reach = np.minimum(q @ centres.T + norm * radius, norm * longest)
            slack = 1 + 1e-6 * np.abs(reach) + 1e-9 * norm * (far + np.maximum(radius, 0))  # rounding of sums and of norms
            row, cell = np.nonzero((reach + slack >= bound[:, None]) & np.isfinite(radius))
            many = parts[cell]
            row, cell = np.repeat(row, many), np.repeat(cell, many)
            part = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(part), batch.column("vec_id").take(pa.array(row)), batch.column("v").take(pa.array(row))], names=["cell", "chunk", "vec_id", "v"])

    sent = bounded.mapInArrow(route, "cell long, chunk long, vec_id long, v array<long>")
    # Each query has at most k rows per chunk that it reached; one sort per query keeps the best k.
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("low"), "vec_id"))), 1, k)
    ranked = answered(sent).groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("at", "one"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"), (-F.col("one.low")).alias("score"))


#: The same rows by comparing all pairs in SQL.
ORACLE = f"""
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= {K}
"""
