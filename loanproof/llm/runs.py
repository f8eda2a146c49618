"""Periodic runs in word sequences, by a suffix automaton with link-cut access.

A run is a longest stretch of consecutive words with smallest period q, at least ``max(LEAST, 2q)``
words long. Each text is one row, and its work stays in one task:

1. Overlap filter. A run of length m >= max(LEAST, 2q) repeats m - q >= LEAST / 2 words at distance
   q, so each of its words lies in a window of LEAST / 2 words that occurs twice in the text. Windows
   are compared by hash (a collision only keeps more words); what lies outside of them cannot be part
   of a run, and the longest stretches inside hold every run whole.
2. The words of a stretch are appended to a suffix automaton one by one. Its suffix links form a tree
   in which every state has the last position where its strings ended. The tree is kept as a link-cut
   tree whose preferred paths are the segments of equal last position; a state that the automaton
   splits off joins the path of the state below it.
3. Appending word i accesses the path from the new state to the root: every segment it crosses gives
   the last end e before i of the suffixes down to length L, and the whole path is recoloured with i.
   If d = i - e <= L, the words i - L - d + 1 .. i have period d: a square, already extended to the
   left as far as it goes, and d is the smallest period, as no suffix of that length ended after e.
   The last i that reports the same (start, d) is the end of the run.

Every run is seen, since at its last word the suffix of q words ended last exactly q words before.
An access crosses O(log n) segments, amortised.

Defined cases: null and empty texts have no words and no runs; a null doc_id is never given a tail;
equal rows give equal results; an empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanproof.llm.common import texts

LEAST = 12

_rng = np.random.default_rng(13)
_ROUNDS = _rng.integers(0, 2**64, size=64, dtype=np.uint64) | np.uint64(1)


def stretches(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """(start, end) of the longest stretches covered by windows of ``least / 2`` words that occur twice."""
    width = min(64, max(1, (least + 1) // 2))
    size = len(ids) - width + 1
    if len(ids) < least:
        return []
    values = ids.astype(np.uint64)
    keys = values[:size] * _ROUNDS[0]
    for k in range(1, width):
        keys += values[k : k + size] * _ROUNDS[k]
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    if not same.any():
        return []
    twice = np.zeros(size, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    edge[:size] += twice
    edge[width:] -= twice
    inside = np.concatenate(([0], (np.cumsum(edge)[:-1] > 0).astype(np.int8), [0]))
    turns = np.flatnonzero(np.diff(inside))
    return [(int(a), int(b)) for a, b in zip(turns[::2], turns[1::2]) if b - a >= least]


class Automaton:
    """A suffix automaton over words whose link tree is a link-cut tree coloured by last end positions.

    ``left``, ``right`` and ``up`` are the splay trees of the preferred paths (``up`` of a top is the
    path's parent); ``seen`` of a top is the last position of its whole path. State 0 is none, 1 the root.
    """

    def __init__(self):
        self.next: list[dict] = [{}, {}]
        self.length, self.link = [0, 0], [0, 0]
        self.left, self.right, self.up, self.seen = [0, 0], [0, 0], [0, 0], [-1, -1]
        self.tip, self.size = 1, 0

    def _state(self, moves: dict, length: int, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.left.append(0)
        self.right.append(0)
        self.up.append(link)
        self.seen.append(-1)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        top, p = x, up[x]
        while left[p] == top or right[p] == top:
            top, p = p, up[p]
        if top == x:
            return
        self.seen[x] = self.seen[top]
        p = up[x]
        while left[p] == x or right[p] == x:
            g = up[p]
            turns = (x,)
            if left[g] == p or right[g] == p:
                turns = (p, x) if (left[g] == p) == (left[p] == x) else (x, x)
            for y in turns:
                p = up[y]
                g = up[p]
                if left[p] == y:
                    b = left[p] = right[y]
                    right[y] = p
                else:
                    b = right[p] = left[y]
                    left[y] = p
                if b:
                    up[b] = p
                up[p], up[y] = y, g
                if left[g] == p:
                    left[g] = y
                elif right[g] == p:
                    right[g] = y
            p = up[x]

    def _split(self, p: int, q: int, word: int) -> int:
        """A state for the strings of q up to length[p] + 1, put on q's path right above q."""
        new = self._state(dict(self.next[q]), self.length[p] + 1, self.link[q])
        self._splay(q)
        above = self.left[new] = self.left[q]
        if above:
            self.up[above] = new
        self.left[q], self.up[new], self.link[q] = new, q, new
        while p and self.next[p].get(word) == q:
            self.next[p][word] = new
            p = self.link[p]
        return new

    def append(self, word: int) -> list[tuple[int, int]]:
        """Adds a word; (last end, longest length) of every segment of suffixes that occurred before, longest first."""
        moves, length, link = self.next, self.length, self.link
        here, self.size = self.size, self.size + 1
        new = self._state({}, here + 1, 0)
        p, self.tip = self.tip, new
        while p and word not in moves[p]:
            moves[p][word] = new
            p = link[p]
        above = 1
        if p:
            above = moves[p][word]
            if length[above] != length[p] + 1:
                above = self._split(p, above, word)
        link[new] = self.up[new] = above
        return self._access(new, here)

    def _access(self, x: int, here: int) -> list[tuple[int, int]]:
        left, right, up, seen = self.left, self.right, self.up, self.seen
        found, below = [], 0
        while x:
            self._splay(x)
            if below and self.length[x] and seen[x] >= 0:
                found.append((seen[x], self.length[x]))
            cut = right[x]
            if cut:
                seen[cut] = seen[x]
            right[x] = below
            below, x = x, up[x]
        seen[below] = here
        return found


def runs_of(ids: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence, by start, then period."""
    ends: dict[tuple[int, int], int] = {}
    machine = Automaton()
    for i, word in enumerate(ids):
        for end, most in machine.append(word):
            if i - end <= most:
                ends[end - most + 1, i - end] = i
    return sorted((s, i - s + 1, d) for (s, d), i in ends.items() if i - s + 1 >= least)


def text_runs(words: list[bytes], least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs of a list of words; only stretches that may hold one go through the automaton."""
    if len(words) < least:
        return []
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    found = []
    for a, b in stretches(ids, least):
        found += [(a + s, m, q) for s, m, q in runs_of(ids[a:b].tolist(), least)]
    return found


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for s, m, q in runs:
        edge[s + q] += 1
        edge[s + m] -= 1
    kept = np.flatnonzero(np.cumsum(edge)[:-1] == 0)
    return [words[k] for k in kept.tolist()]


def with_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's words: a tenth of the documents, by crc32 of the id, get a periodic tail."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def periodic_runs(docs: DataFrame, least: int = LEAST, tails: bool = False) -> DataFrame:
    """doc_id, runs (array of start, length, period, by start, then period) and the collapsed text, words joined by a space.

    ``tails`` first gives a tenth of the documents a periodic tail (see ``with_tail``).
    """
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            all_runs, collapsed = [], []
            for doc_id, text in zip(ids.to_pylist(), batch.column("text").to_pylist()):
                words = text.encode("utf-8", "surrogatepass").split()
                if tails:
                    words = with_tail(words, doc_id)
                found = text_runs(words, least)
                all_runs.append([{"start": s, "length": m, "period": q} for s, m, q in found])
                collapsed.append(b" ".join(collapse(words, found)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(all_runs, run_type), pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"]
            )

    kind = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return texts(docs).mapInArrow(run, kind)


def run_digest(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per document: number of runs, the longest run, and hashes of all runs and of the collapsed text."""
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    first = F.try_element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shortness"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(1))
    digest = periodic_runs(docs, least, tails=True).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), first.alias("best"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")
    )
    return digest.selectExpr(
        "doc_id",
        "n_runs",
        "best.start AS start",
        "-best.shortness AS length",
        "best.period AS period",
        "(-1000 * best.shortness) DIV best.period AS exponent_milli",
        "runs_sha256",
        "collapsed_sha256",
    )
