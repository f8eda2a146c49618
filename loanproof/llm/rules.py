"""Quality rules: fixed base rules, then gradient-boosted trees over document statistics.

The trees are grown level by level on quantile bins in numpy, on at most ``max_rows`` labelled
rows (lowest id hashes). Features in ``FALLING`` may only lower the verdict as they grow: a
split that breaks the order is not taken, and the middle of the two sides bounds both
subtrees. The ensemble is flattened into node arrays, so a batch of documents walks all
trees with array indexing. Scoring is one pass without a shuffle.

Defined cases: a null or empty text has zero words and fails the base rules; labels of one
class, or none, leave the verdict to the base rules; repeated rows give repeated results; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loanproof.llm.common import texts
from loanproof.llm.quality import labelled_sample
from loanproof.llm.textstats import STATS, base_counts, structure

MAX_ROWS = 20_000
TREES = 60
DEPTH = 3
BINS = 64
THRESHOLD = 0.3
FEATURES = [*STATS, "repeat_share"]
#: More of these never speaks for a document.
FALLING = {"symbols", "bangs", "pipes", "stutter", "top_share", "dup_lines", "repeat_share"}
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


class Trees(NamedTuple):
    """Complete trees of one depth: node arrays (trees x inner nodes) and leaf values (trees x leaves)."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - len(feature)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, rate: float = 0.15, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Boosted trees for the logistic loss under the order constraints of ``FALLING``."""
    falls = np.array([name in FALLING for name in FEATURES])
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(x.shape[1])], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    all_feature, all_threshold, all_value = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        low, high = np.full(2 * inner + 1, -np.inf), np.full(2 * inner + 1, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for depth in range(DEPTH):
            for k in range(2**depth - 1, 2 ** (depth + 1) - 1):
                mine = np.flatnonzero(node == k)
                best = (1e-6, None)
                g, h = slope[mine], bend[mine]
                for f in range(x.shape[1]) if len(mine) else ():
                    gl = np.cumsum(np.bincount(binned[mine, f], weights=g, minlength=len(cuts[f]) + 1))
                    hl = np.cumsum(np.bincount(binned[mine, f], weights=h, minlength=len(cuts[f]) + 1))
                    gr, hr = gl[-1] - gl, hl[-1] - hl
                    left, right = np.clip(gl / (hl + ridge), low[k], high[k]), np.clip(gr / (hr + ridge), low[k], high[k])
                    whole = np.clip(gl[-1] / (hl[-1] + ridge), low[k], high[k])
                    worth = lambda v, g, h: g * v - 0.5 * (h + ridge) * v**2
                    gain = worth(left, gl, hl) + worth(right, gr, hr) - worth(whole, gl[-1], hl[-1])
                    gain[(hl < least) | (hr < least) | (falls[f] & (left < right))] = -1
                    at = int(np.argmax(gain[:-1])) if len(gain) > 1 else -1
                    if at >= 0 and gain[at] > best[0]:
                        best = (float(gain[at]), (f, at, float(left[at]), float(right[at])))
                sides = (2 * k + 1, 2 * k + 2)
                for s in sides:
                    low[s], high[s] = low[k], high[k]
                if best[1] is None:
                    node[mine] = sides[0]
                    continue
                f, at, left, right = best[1]
                feature[k], threshold[k] = f, cuts[f][at]
                if falls[f]:
                    middle = (left + right) / 2
                    low[sides[0]], high[sides[1]] = max(low[k], middle), min(high[k], middle)
                node[mine] = np.where(binned[mine, f] <= at, *sides)
        leaf = node - inner
        g = np.bincount(leaf, weights=slope, minlength=leaves)
        h = np.bincount(leaf, weights=bend, minlength=leaves)
        value = rate * np.clip(g / (h + ridge), low[inner:], high[inner:])
        margin += value[leaf]
        all_feature.append(feature)
        all_threshold.append(threshold)
        all_value.append(value)
    return Trees(np.array(all_feature), np.array(all_threshold), np.array(all_value), base)


def measure(text: str) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """Base counts and tree features of one whole text."""
    raw, words, counts = base_counts(text)
    return counts, [*structure(text, raw, words, Counter(words)), counts[4] / max(1, counts[0])]


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Trees | None:
    """Trees for labels.quality; None if the labels hold one class only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t)[1] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    sample = labelled_sample(docs, labels, "quality", 1, 1, max_rows)  # no held-out fold: remainder 1 of 1 never occurs
    got = sample.mapInArrow(run, "doc_id long, label int, x array<double>").toArrow().sort_by("doc_id")
    y = got["label"].to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return None
    return grow(np.array(got["x"].to_pylist()), y)


def quality_rules(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Base counts, base_failed, kept and the trees' score of every document."""
    trees = train(docs, labels, max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t) for t in batch.column("text").to_pylist()]
            counts = np.array([r[0] for r in rows], dtype=np.int64).reshape(-1, 5)
            x = np.array([r[1] for r in rows]).reshape(-1, len(FEATURES))
            failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])
            score = trees.score(x) if trees is not None else np.ones(len(rows))
            kept = ~failed & (score >= THRESHOLD)
            columns = [batch.column("doc_id"), *(pa.array(counts[:, k]) for k in range(5)), pa.array(failed), pa.array(kept), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"])

    kinds = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"
    return texts(docs).mapInArrow(run, kinds)
