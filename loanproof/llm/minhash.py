"""Near duplicates by one-permutation MinHash, banded buckets and star-shaped candidate edges.

1. Signature: a text's distinct shingles are hashed once and sorted; the top bits of a hash name one
   of ``BINS`` bins, each bin keeps its least hash. An empty bin takes the value of another bin by its
   own fixed sequence of tries (optimal densification). ``BANDS`` bands of ``ROWS`` bins name buckets:
   a pair at the limit of 0.85 misses all of them once in a million.
2. Documents of equal shingle sets are one class (by 128 bits of the set's hash); only classes go on.
3. Stars: each bucket sends edges from its members to one centre, the member that shares most buckets
   over all bands, so one bucket of m members makes m - 1 edges, less those too unequal in size.
4. Edges are confirmed on the full sets: the texts of classes in any bucket of two or more are fetched
   once, found by a bit set of fixed size, and travel compressed.
5. No link is lost by the star form: where the members of a bucket besides its centre are still in two
   or more components, the bucket is solved whole, in cells of at most two chunks of ``CHUNK`` members.
   A cell counts the overlaps of all its full sets as bit rows over their shared shingles and returns
   star links only, never pairs. So every pair of a bucket is confirmed or refuted on full sets, or
   connected by links that were.

Defined cases: null, empty and blank texts have an empty set, are linked with nothing and kept; equal
texts link; a null doc_id takes part, but is never a component's id and not kept; repeated rows give
repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanproof.llm.bits import bit_set, contains
from loanproof.llm.common import Memo, lower_words, texts
from loanproof.llm.simhash import smallest_reached, star_components
from loanproof.session import materialize

SHINGLE = 5
PERCENT = 85
BINS = 256
ROWS = 7
BANDS = BINS // ROWS
CHUNK = 512
_TRIES = 512
_COLUMNS = 1 << 14
_random = np.random.default_rng(12)
_FACTORS = _random.integers(0, 2**64, size=64, dtype=np.uint64) | np.uint64(1)
#: Where each empty bin looks: fixed tries, then every bin once.
_LOOKS = np.concatenate((_random.integers(0, BINS, size=(BINS, _TRIES)), np.tile(np.arange(BINS), (BINS, 1))), axis=1)
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted 64-bit hashes of the distinct shingles of a text."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    span = min(shingle, len(words))
    size = len(words) - span + 1
    keys = np.full(size, span, dtype=np.uint64)
    for k in range(span):
        keys += hashes[k : k + size] * _FACTORS[k]
    return np.unique(_mixed(keys))


def band_keys(found: np.ndarray) -> np.ndarray:
    """The bucket of each band, from a set that is not empty."""
    first = np.searchsorted(found, _EDGES)
    filled = np.diff(np.append(first, len(found))) > 0
    values = found[np.minimum(first, len(found) - 1)]
    empty = np.flatnonzero(~filled)
    if len(empty):
        looks = _LOOKS[empty]
        values[empty] = values[looks[np.arange(len(empty)), filled[looks].argmax(axis=1)]]
    table = values[: BANDS * ROWS].reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64) * _FACTORS[0]
    for k in range(ROWS):
        keys = _mixed(keys ^ table[:, k]) * _FACTORS[k + 1]
    return _mixed(keys)


def alike(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets overlap in at least ``percent`` per cent of their union."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, n (set size), set_hash (null for the empty set) and its buckets, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sets, buckets = [], [], []
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), shingle)
                sizes.append(len(found))
                sets.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                buckets.append(band_keys(found).view(np.int64) if len(found) else None)
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n", "set_hash", "buckets"])

    hashed = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    return hashed.mapInArrow(run, "doc_id long, text_hash long, n long, set_hash binary, buckets array<long>")


def _members(classes: DataFrame) -> DataFrame:
    """(bucket, node, n, weight) of all buckets with two classes or more; weight: members of the node's buckets."""
    rows = classes.select("node", "n", F.explode("buckets").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    shared = materialize(rows.join(sizes, "bucket"))
    weights = shared.groupBy("node").agg(F.sum("members").alias("weight"))
    return materialize(shared.drop("members").join(weights, "node"))


def _fetch(docs: DataFrame, prints: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, packed): the compressed text of one document of each wanted class (set_hash, node)."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    chosen = prints.join(wanted, "set_hash").groupBy("node").agg(first)
    chosen = materialize(chosen.select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash")))
    bits = docs.sparkSession.sparkContext.broadcast(bit_set(chosen.select("text_hash")))
    held = texts(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(_packer(bits), "doc_id long, text_hash long, packed binary")
    same = held["text_hash"].eqNullSafe(chosen["text_hash"]) & held["doc_id"].eqNullSafe(chosen["doc_id"])
    return materialize(held.dropDuplicates(["doc_id", "text_hash"]).join(chosen, same).select("node", "packed"))


def _packer(bits: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            hashes = batch.column("text_hash")
            kept = batch.filter(pa.array(contains(bits.value, hashes.to_numpy(zero_copy_only=False).view(np.uint64))))
            packed = [press.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in kept.column("text")]
            yield pa.RecordBatch.from_arrays([kept.column("doc_id"), kept.column("text_hash"), pa.array(packed, pa.binary())], names=["doc_id", "text_hash", "packed"])

    return run


def _confirm(pairs: DataFrame, held: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        sets = Memo(lambda packed: shingle_set(unpack.decompress(packed).decode("utf-8", "surrogatepass"), shingle), 16)
        for batch in batches:
            kept = [alike(sets[b.as_py()], shingle_set(unpack.decompress(a.as_py()).decode("utf-8", "surrogatepass"), shingle), percent) for a, b in zip(batch.column("a"), batch.column("b"))]
            yield batch.select(["u", "v"]).filter(pa.array(kept, pa.bool_()))

    left = held.select(F.col("node").alias("u"), F.col("packed").alias("a"))
    right = held.select(F.col("node").alias("v"), F.col("packed").alias("b"))
    return materialize(pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long"))


def _stars(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(bucket, node) of the centre of each bucket, and the edges (u, v) to it."""
    centres = materialize(members.groupBy("bucket").agg(F.max(F.struct("weight", "node", "n")).alias("c")))
    pairs = members.join(centres, "bucket").filter("node <> c.node")
    pairs = pairs.filter(F.lit(100) * F.least("n", "c.n") >= F.lit(percent) * F.greatest("n", "c.n"))
    return centres.select("bucket", F.col("c.node").alias("node")), pairs.select(F.col("node").alias("u"), F.col("c.node").alias("v")).distinct()


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of sorted sets, by bit rows over the hashes that two or more hold."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = counts[place] > 1
    column = (np.cumsum(counts > 1) - 1)[place[kept]]
    owner = owner[kept]
    width = int((counts > 1).sum())
    out = np.zeros((len(sets), len(sets)), dtype=np.int64)
    for start in range(0, width, _COLUMNS):
        inside = (column >= start) & (column < start + _COLUMNS)
        rows = np.zeros((len(sets), _COLUMNS), dtype=bool)
        rows[owner[inside], column[inside] - start] = True
        words = np.packbits(rows, axis=1).view(np.uint64)
        words = words[:, words.any(axis=0)]
        for k in range(len(sets)):
            out[k] += np.bitwise_count(words[k] & words).sum(axis=1, dtype=np.int64)
    return out


def _solve_cells(shingle: int, percent: int):
    """Star links of every cell of a partition sorted by cell."""

    def links(nodes: list[int], roots: list[int], packed: list[bytes]) -> pa.RecordBatch:
        unpack = zstandard.ZstdDecompressor()
        order = sorted({n: k for k, n in enumerate(nodes)}.values())
        if len({roots[k] for k in order}) < 2:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, names=["u", "v"])
        sets = [shingle_set(unpack.decompress(packed[k]).decode("utf-8", "surrogatepass"), shingle) for k in order]
        sizes = np.array([len(x) for x in sets])
        both = overlaps(sets)
        a, b = np.nonzero(np.triu(100 * both >= percent * (sizes[:, None] + sizes - both), 1))
        label = smallest_reached(len(sets), a, b)
        moved = np.flatnonzero(label != np.arange(len(sets)))
        ids = np.array([nodes[k] for k in order], dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[label[moved]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, ([], [], [])
        for batch in batches:
            for key, *row in zip(batch.column("cell").to_pylist(), batch.column("node").to_pylist(), batch.column("root").to_pylist(), batch.column("packed")):
                if key != cell:
                    if held[0]:
                        yield links(*held)
                    cell, held = key, ([], [], [])
                for column, value in zip(held, (row[0], row[1], row[2].as_py())):
                    column.append(value)
        if held[0]:
            yield links(*held)

    return run


def _cells(members: DataFrame, centres: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(cell, node, root) of the members, without the centres, of buckets that hold two or more components."""
    rest = members.select("bucket", "node").join(centres, ["bucket", "node"], "left_anti")
    if roots is None:
        rest = rest.withColumn("root", F.col("node"))
    else:
        rest = rest.join(roots.withColumnRenamed("u", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rest = materialize(rest)
    mixed = rest.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("m")).filter("low < high")
    rest = rest.join(mixed.select("bucket", F.ceil(F.col("m") / CHUNK).cast("int").alias("chunks")), "bucket")
    rest = rest.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: (k != F.col("mine")) | (F.col("chunks") == 1))
    rest = rest.withColumn("other", F.explode(others))
    return rest.select(F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"), "node", "root")


def linked(docs: DataFrame, prints: DataFrame, classes: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(u, root): the component of every class that is linked with another; ``classes`` has set_hash, n, buckets, node."""
    members = _members(classes)
    held = _fetch(docs, prints, classes.select("set_hash", "node").join(members.select("node").distinct(), "node"))
    centres, pairs = _stars(members, percent)
    links = _confirm(pairs, held, shingle, percent)
    roots = None if links.isEmpty() else star_components(links)
    cells = _cells(members, centres, roots).join(held, "node").repartition("cell").sortWithinPartitions("cell")
    more = materialize(cells.mapInArrow(_solve_cells(shingle, percent), "u long, v long"))
    if not more.isEmpty():
        roots = star_components(links.unionByName(more))
    return classes.select(F.col("node").alias("u"), F.col("node").alias("root")).limit(0) if roots is None else roots


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reached, itself included) and kept, for every document."""
    prints = materialize(signatures(docs, shingle))
    full = prints.filter("n > 0")
    classes = full.dropDuplicates(["set_hash"]).select("set_hash", "n", "buckets")
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()))
    roots = linked(docs, full.drop("buckets"), classes, shingle, percent)
    first = full.groupBy("set_hash").agg(F.min("doc_id").alias("first"))
    rooted = classes.select("set_hash", F.col("node").alias("u")).join(roots, "u", "left").join(first, "set_hash")
    rooted = materialize(rooted.select("set_hash", F.coalesce("root", "u").alias("root"), "first"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(ids, "root").select("set_hash", "component_id"))
    out = full.join(named, "set_hash").select("doc_id", "n", "component_id")
    out = out.unionByName(prints.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
