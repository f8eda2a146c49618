"""Quality scores from a factorisation machine.

Features of a document: the statistics of ``textstats.STATS`` and its words, hashed into
``BUCKETS`` and weighted by the root of their share. Pairwise interactions have rank ``RANK``
and are summed in linear time: half of (sum of v x) squared less the sum of (v x) squared.
The model is fitted in numpy on at most ``max_rows`` labelled rows, those whose ids hash
lowest; what reaches the driver is their features. Scoring is one pass without a shuffle.

Defined cases: a null or empty text has no words and is scored by its statistics; labels of one
class only, or none, give every document the smoothed share of label 1; a null label trains
nothing; repeated rows give repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanproof.llm.common import fold, texts
from loanproof.llm.textstats import STATS, structure

FOLDS = 5
HELD_OUT = 0
THRESHOLD = 0.3
MAX_ROWS = 6_000
BUCKETS = 1 << 14
RANK = 8
DENSE = len(STATS)


def features(text: str) -> tuple[list[float], np.ndarray, np.ndarray]:
    """Statistics, distinct hashed words and their weights."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    counts = Counter(words)
    dense = structure(text, raw, words, counts)
    if not counts:
        return dense, np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
    slots = np.fromiter(map(zlib.crc32, counts), dtype=np.int64, count=len(counts)) & (BUCKETS - 1)
    shares = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
    sums = np.bincount(slots, weights=shares, minlength=BUCKETS)
    used = np.flatnonzero(sums)
    return dense, used.astype(np.int32), np.sqrt(sums[used] / len(words)).astype(np.float32)


class Machine(NamedTuple):
    """Weights over [statistics, hashed words]; ``flat`` is the answer when nothing could be learned."""

    center: np.ndarray
    scale: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    flat: float | None

    def inputs(self, dense: np.ndarray) -> np.ndarray:
        return np.clip((dense - self.center) / self.scale, -5, 5)

    def score(self, rows: list[tuple[list[float], np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows or self.flat is not None:
            return np.full(len(rows), 0.5 if self.flat is None else self.flat)
        z = self.inputs(np.array([r[0] for r in rows]))
        sums, squares = z @ self.factor[:DENSE], (z**2) @ (self.factor[:DENSE] ** 2)
        linear = self.bias + z @ self.weight[:DENSE]
        for k, (_, slots, shares) in enumerate(rows):
            if len(slots):
                held = self.factor[DENSE + slots] * shares[:, None]
                sums[k] += held.sum(axis=0)
                squares[k] += (held**2).sum(axis=0)
                linear[k] += self.weight[DENSE + slots] @ shares
        return 1 / (1 + np.exp(-np.clip(linear + 0.5 * (sums**2 - squares).sum(axis=1), -30, 30)))


def fit(rows: list[tuple[list[float], np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.05, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Logistic loss, Adagrad steps; the same rows give the same machine."""
    size = DENSE + BUCKETS
    rng = np.random.default_rng(seed)
    weight, factor = np.zeros(size), rng.normal(0, 0.02, (size, RANK))
    if len(set(labels.tolist())) < 2:
        return Machine(np.zeros(DENSE), np.ones(DENSE), 0.0, weight, factor, (float(labels.sum()) + 1) / (len(labels) + 2) if len(labels) else 0.5)
    dense = np.array([r[0] for r in rows])
    machine = Machine(dense.mean(axis=0), dense.std(axis=0) + 1e-6, 0.0, weight, factor, None)
    z = machine.inputs(dense)
    slots = [np.concatenate((np.arange(DENSE), DENSE + r[1])) for r in rows]
    values = [np.concatenate((z[k], r[2])) for k, r in enumerate(rows)]
    bias, seen_w, seen_v, seen_b = 0.0, np.full(size, 1e-2), np.full((size, RANK), 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), batch):
            chosen = order[k : k + batch]
            lengths = np.array([len(slots[i]) for i in chosen])
            at, x = np.concatenate([slots[i] for i in chosen]), np.concatenate([values[i] for i in chosen])
            starts, owner = np.cumsum(lengths) - lengths, np.repeat(np.arange(len(chosen)), lengths)
            held = factor[at] * x[:, None]
            sums = np.add.reduceat(held, starts)
            margin = bias + np.add.reduceat(weight[at] * x, starts) + 0.5 * (sums**2 - np.add.reduceat(held**2, starts)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]) / len(chosen)
            used, back = np.unique(at, return_inverse=True)
            step_w = np.bincount(back, weights=error[owner] * x) + decay * weight[used]
            pull = (error[owner] * x)[:, None] * (sums[owner] - held)
            step_v = np.stack([np.bincount(back, weights=pull[:, f]) for f in range(RANK)], axis=1) + decay * factor[used]
            seen_w[used] += step_w**2
            seen_v[used] += step_v**2
            weight[used] -= rate * step_w / np.sqrt(seen_w[used])
            factor[used] -= rate * step_v / np.sqrt(seen_v[used])
            seen_b += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(seen_b)
    return machine._replace(bias=bias, weight=weight.astype(np.float32), factor=factor.astype(np.float32))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, max_rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled documents outside the held-out fold, lowest id hashes first."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out)).groupBy("doc_id").agg(F.max("label").alias("label"))
    present = texts(docs).select("doc_id").join(known, "doc_id").distinct()
    chosen = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # At most max_rows pairs of numbers: small enough to send to every task.
    return texts(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Machine:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("label"), pa.array([r[0] for r in rows], pa.list_(pa.float64())), pa.array([r[1] for r in rows], pa.list_(pa.int32())), pa.array([r[2] for r in rows], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "dense", "slots", "shares"])

    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, max_rows)
    got = sample.mapInArrow(run, "doc_id long, label int, dense array<double>, slots array<int>, shares array<float>").toArrow().sort_by("doc_id")
    rows = [(d, np.array(s, dtype=np.int32), np.array(h, dtype=np.float32)) for d, s, h in zip(got["dense"].to_pylist(), got["slots"].to_pylist(), got["shares"].to_pylist())]
    return fit(rows, got["label"].to_numpy().astype(float))


def score_texts(docs: DataFrame, scorer: Callable[[list[str]], np.ndarray], folds: int, held_out: int, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = scorer(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = texts(docs).mapInArrow(run, "doc_id long, score double")
    held = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_rows(docs: DataFrame, keeps: Callable[[list[str]], list[bool]]) -> DataFrame:
    """The rows of a table whose text (null: empty) a test keeps, all columns as they are."""
    from loanproof.session import ship_package

    ship_package(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = keeps([t or "" for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _scorer(machine: Machine) -> Callable[[list[str]], np.ndarray]:
    return lambda found: machine.score([features(t) for t in found])


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    return score_texts(docs, _scorer(train(docs, labels, max_rows)), FOLDS, HELD_OUT, THRESHOLD)


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents the machine predicts as label 1, with all their columns."""
    scorer = _scorer(train(docs, labels, max_rows))
    return keep_rows(docs, lambda found: (scorer(found) >= THRESHOLD).tolist())
