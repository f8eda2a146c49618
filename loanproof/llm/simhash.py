"""Near duplicates by SimHash and a hierarchical index in Gray order.

1. Fingerprints: whole texts in Arrow batches, one row per document out.
2. Equal fingerprints collapse before anything is compared (an aggregate with map-side combine).
3. The top of the index is spread over the cluster: two fingerprints at most three bits apart
   agree in one of four 16-bit patterns, so each fingerprint goes to the four top nodes that
   carry its patterns. A crowded node is dealt out further: as cells of two chunks each, and
   beyond ``DEEP`` members first by four 12-bit patterns of the bits that are left.
4. Within a task the members of each node are sorted by Gray rank, neighbours share their bit
   patterns, and groups of ``FAN`` form upper nodes that hold the bits all members share. A search
   walks down, adds up the differing bits of each level's own mask and drops a whole group as
   soon as the sum passes the limit. All nodes of a batch are walked at once.
5. A node returns each member's link to the smallest one it reaches there, never all pairs;
   components come from alternating star steps, which reach their fixed point in few rounds.

Defined cases: a null, empty or blank text has fingerprint zero and links like any other; equal
texts link; a component without any id has a null id; repeated rows give repeated results; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanproof.llm.common import lower_words, texts
from loanproof.session import materialize

SEED = 42
SHINGLE = 3
LIMIT = 3
FAN = 8
CHUNK = 1024
DEEP = 65_536
_STEP = 1 << 16


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint: bits set in over half of the shingles' hashes."""
    words = lower_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle, len(words))
    firsts, lasts = starts[: len(words) - span + 1], ends[span - 1 :]
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(firsts), _STEP):
        hashes = [xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in zip(firsts[k : k + _STEP].tolist(), lasts[k : k + _STEP].tolist())]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(firsts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (of the whole text, to tell rows of one id apart) and fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(t) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(found.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    return texts(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, fp long")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The position of each 64-bit pattern in Gray order."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _groups(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of at most ``width`` equal sorted keys, and the key of each run."""
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    starts = np.flatnonzero((np.arange(len(keys)) - first) % width == 0)
    return starts, keys[starts]


def links_within(cells: np.ndarray, values: np.ndarray, sides: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of linked members of one cell; sides 0 and 1 are compared with each other, side 2 with itself."""
    order = np.lexsort((gray_rank(values), cells))
    cell, value, side = cells[order], values[order], sides[order]
    levels = []  # from the leaves up: key, first child, number of children, shared mask, shared pattern
    key, mask, pattern = cell, np.full(len(cell), ~np.uint64(0)), value
    while True:
        starts, parent_key = _groups(key, FAN)
        sizes = np.diff(np.append(starts, len(key)))
        base = np.repeat(pattern[starts], sizes)
        own = np.bitwise_and.reduceat(mask & ~(pattern ^ base), starts)
        levels.append((starts, sizes, mask & ~np.repeat(own, sizes), pattern))
        key, mask, pattern = parent_key, own, pattern[starts] & own
        if len(key) == 1 or (key[1:] != key[:-1]).all():
            break
    roots = np.searchsorted(key, cell)
    crowd = max(1, int(np.bincount(roots).max()))
    ask = np.flatnonzero((side != 1) & (np.bincount(roots)[roots] > 1))
    found_a, found_b = [], []
    step = max(1, 4_000_000 // crowd)
    for k in range(0, len(ask), step):
        query = ask[k : k + step]
        node, near = roots[query], np.bitwise_count((value[query] ^ pattern[roots[query]]) & mask[roots[query]]).astype(np.int64)
        keep = near <= limit
        query, node, near = query[keep], node[keep], near[keep]
        for starts, sizes, rest, shared in reversed(levels):
            many = sizes[node]
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            child = np.repeat(starts[node], many) + at
            query, near = np.repeat(query, many), np.repeat(near, many)
            near = near + np.bitwise_count((value[query] ^ shared[child]) & rest[child])
            keep = near <= limit
            query, node, near = query[keep], child[keep], near[keep]
        keep = np.where(side[query] == 2, query < node, side[node] == 1)
        found_a.append(query[keep])
        found_b.append(node[keep])
    if not found_a:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return order[np.concatenate(found_a)], order[np.concatenate(found_b)]


def smallest_reached(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``size`` members, the smallest position that it reaches over links (a, b)."""
    label = np.arange(size)
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        changed = low < high
        if not changed.any():
            break
        np.minimum.at(label, high[changed], low[changed])
        while (label[label] != label).any():
            label = label[label]
    return label


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Star links of every cell of a partition sorted by cell; the last, open cell of a batch waits for the next."""

    def solve(cells, values, sides):
        a, b = links_within(cells, values, sides)
        label = smallest_reached(len(values), a, b)
        moved = np.flatnonzero(label != np.arange(len(values)))
        return pa.RecordBatch.from_arrays([pa.array(values[moved].view(np.int64)), pa.array(values[label[moved]].view(np.int64))], names=["u", "v"])

    kept = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)]
    for batch in batches:
        new = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("cell", "fp", "side")]
        new[1] = new[1].view(np.uint64)
        kept = [np.concatenate((old, fresh)) for old, fresh in zip(kept, new)]
        if len(kept[0]):
            whole = int(np.searchsorted(kept[0], kept[0][-1]))
            if whole:
                yield solve(*(x[:whole] for x in kept))
                kept = [x[whole:] for x in kept]
    if len(kept[0]):
        yield solve(*kept)


def _deal(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Cells (cell, side, fp) of rows (node, fp), and the rows of nodes beyond DEEP, if any."""
    crowded = materialize(rows.groupBy("node").agg(F.count("*").alias("members")).filter(F.col("members") > CHUNK))
    many = crowded.count()
    plain = lambda df: df.select((F.col("node") * F.lit(1 << 30)).alias("cell"), F.lit(2).cast("long").alias("side"), "fp")
    if not many:
        return plain(rows), None
    sized = rows.join(F.broadcast(crowded) if many <= 50_000 else crowded, "node", "left")
    chunks = F.least(F.ceil(F.col("members") / CHUNK), F.lit(1 << 15)).cast("int")
    split = (
        sized.filter(F.col("members") <= DEEP)
        .withColumn("chunks", chunks)
        .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            (F.col("node") * F.lit(1 << 30) + F.least("mine", "other") * F.lit(1 << 15) + F.greatest("mine", "other")).alias("cell"),
            F.when(F.col("mine") == F.col("other"), 2).otherwise((F.col("mine") > F.col("other")).cast("int")).cast("long").alias("side"),
            "fp",
        )
    )
    deep = sized.filter(F.col("members") > DEEP).drop("members")
    return plain(sized.filter("members IS NULL")).unionByName(split), deep


def _cells(distinct: DataFrame) -> DataFrame:
    """Every fingerprint with the cells in which it meets all that may link to it."""
    pattern = lambda k: F.shiftrightunsigned("fp", 48 - 16 * k).bitwiseAND(F.lit(0xFFFF))
    node = F.explode(F.array(*[pattern(k) + F.lit(k << 16) for k in range(4)]))
    cells, deep = _deal(distinct.select(node.alias("node"), "fp"))
    if deep is None or deep.isEmpty():
        return cells
    # The 48 bits left, the pattern's own bits closed up, in four patterns of 12 bits.
    low = "CAST(48 - 16 * (node >> 16) AS INT)"
    rest = F.expr(f"IF((node >> 16) = 0, fp & 281474976710655, (shiftrightunsigned(shiftrightunsigned(fp, {low}), 16) << {low}) | (fp & ((1L << {low}) - 1)))")
    finer = deep.withColumn("rest", rest).withColumn("sub", F.explode(F.array(*[F.shiftrightunsigned("rest", 36 - 12 * k).bitwiseAND(F.lit(0xFFF)) + F.lit(k << 12) for k in range(4)])))
    finer = finer.select((F.col("node") * F.lit(1 << 14) + F.col("sub") + F.lit(1 << 32)).alias("node"), "fp")
    again = finer.groupBy("node").agg(F.count("*").alias("members"))
    sized = finer.join(materialize(again.filter(F.col("members") > CHUNK)), "node", "left")
    sized = sized.withColumn("chunks", F.least(F.ceil(F.coalesce("members", F.lit(1)) / CHUNK), F.lit(1 << 12)).cast("int"))
    sized = sized.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = sized.select(
        (F.col("node") * F.lit(1 << 24) + F.least("mine", "other") * F.lit(1 << 12) + F.greatest("mine", "other")).alias("cell"),
        F.when(F.col("mine") == F.col("other"), 2).otherwise((F.col("mine") > F.col("other")).cast("int")).cast("long").alias("side"),
        "fp",
    )
    return cells.unionByName(dealt)


def star_components(edges: DataFrame) -> DataFrame:
    """(u, root) for every end of edges (u, v): root is the smallest key that u reaches.

    Alternates large-star and small-star steps. Minima are aggregates with map-side combine; the
    joins behind them read written tables on both sides, so adaptive execution can split a hub.
    """
    edges = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    sign = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low")))
        large = materialize(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())
        low = materialize(large.groupBy("u").agg(F.min("v").alias("low")))
        small = large.join(low, "u").select("u", "v", "low")
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(low.select("u", F.col("low").alias("v")))
        edges = materialize(small.filter("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == sign:
            return edges.select("u", F.col("v").alias("root"))
        sign = now


def components(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of a written table of ``fingerprints``."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    edges = _cells(distinct.select("fp")).repartition("cell").sortWithinPartitions("cell").mapInArrow(_link_batches, "u long, v long")
    roots = star_components(edges)
    rooted = distinct.join(roots, distinct["fp"] == roots["u"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    rooted = materialize(rooted)
    ids = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    return rooted.drop("first").join(ids, "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest id reached) of every document."""
    prints = materialize(fingerprints(docs))
    found = materialize(components(prints))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(found, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the smallest id, with all its columns.

    Of rows that repeat an id, the one whose text hashes lowest stays, once.
    """
    prints = materialize(fingerprints(docs))
    found = materialize(components(prints))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    chosen = prints.join(found.select("fp", "root"), "fp").groupBy("root").agg(first).select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    chosen = materialize(chosen)
    names = docs.columns
    held = docs.select("*", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text_hash"))
    kept = held.join(chosen, F.col("doc_id").cast("long").eqNullSafe(chosen["kept_id"]) & (F.col("_text_hash") == chosen["kept_hash"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "_text_hash"]).select(*names)
