"""Language-model scores from a causal self-attention model over subword ids.

A word is spelled in pieces of a public byte-level vocabulary. Its first piece has one of
``CLASSES`` classes (common pieces alone, the rest in groups of like mass, the end by itself). The
attention model reads the pieces of the words so far (class of the first, slot of the last) and
gives the chance of the next word's class:

    P(word | before) = P(class | before) * (1 - L) * c / c(class)    for a word of count c > 0
    P(word | before) = P(class | before) * L * P(spelling)           for a new word

L is the class's share of words seen once, which is what new words may claim; the spelling goes
piece by piece with discounted counts of triples, pairs and single pieces, each word counted once.
The counts of common pairs and triples (at most ``GRAMS`` each) and of their beginnings go out with
a broadcast; distinct new words ask for all others by a join, so no count is left out.

Everything counted covers every training document: words (one shuffle, combined in the tasks
first) and, from the table of words, pieces, pairs and triples. Training is spread out: every
task takes Adam steps from the same weights over windows of all its training documents, and Spark
averages the weights, ``ROUNDS`` times. A round takes every ``ROUNDS``-th window of ``SPAN`` words,
the next round the next ones, so each training word is a target once. For scoring, a text is
cut into windows of ``SPAN`` words that overlap by ``SPAN - STRIDE``; batched masked attention
runs over many windows at once, and every word is scored in one window only.

Counts of common words go out with a broadcast of at most ``COMMON`` words (a histogram of
counts finds the cut); all other words meet their counts in a join, where none of them is hot.

Defined cases: null and empty texts are the end token alone; a null id belongs to training;
without training documents base scores are zero and the score is the untrained model's;
repeated rows are scored alike; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanproof.llm.common import Memo, fold, texts
from loanproof.llm.packing import byte_encoder
from loanproof.session import shared_dir

FOLDS = 10
HELD_OUT = 0
PSEUDO = 0.1
DISCOUNT = 0.75
VOCABULARY = 50_257
_WIDE = VOCABULARY + 1  # the end of a word is one more piece
CLASSES = 128
LONE = 104
LASTS = 64
WIDTH = 16
SPAN = 32
STRIDE = 28
ROUNDS = 2
BATCH = 16
RATE = 0.02
COMMON = 1 << 17
GRAMS = 1 << 18
_FLUSH = 500_000
_PART = 1 << 22
_ABOUT = 1 << 12
_STOP = CLASSES - 1


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read again: a lineage cut that outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def _sums(held: Counter, names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), kind), pa.array(held.values(), pa.int64())], names=names)


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of some ``_PART`` bytes, one row at least."""
    rows = max(1, len(batch) * _PART // max(batch.nbytes, 1))
    for k in range(0, len(batch), rows):
        yield batch.slice(k, rows)


def plain(column: pa.Array) -> list[bytes]:
    """The values as Python objects; ``to_pylist`` makes a scalar of each first, at ten times the cost."""
    return column.to_numpy(zero_copy_only=False).tolist()


def laid_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as ``lower_words`` cuts them, end to end, and how many each text has."""
    raw = column.cast(pa.large_binary())
    bounds = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    inside = (data != 32) & (data - np.uint8(9) > 4)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]  # a text ends the last word of the text before
    begins[heads] = inside[heads]
    letters = data[inside]
    letters += (letters - np.uint8(65) < 26).view(np.uint8) << 5
    ends = np.append(np.flatnonzero(begins[inside]), len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    return words, np.diff(np.searchsorted(np.flatnonzero(begins), bounds))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over the words of all texts; each task adds up before the shuffle, in bounded space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part in parts(batch):
                words, counts = laid_words(part.column("text"))[0].value_counts().flatten()
                for word, c in zip(plain(words), counts.to_numpy().tolist()):
                    held[word] += c
                if len(held) > _FLUSH:
                    yield _sums(held, ["word", "c"], pa.binary())
                    held = Counter()
        yield _sums(held, ["word", "c"], pa.binary())

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def spell(path: str, word: bytes) -> list[int]:
    return byte_encoder(path).ordinary(" " + word.decode("utf-8", "replace"))


def added(slots: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and their sums."""
    order = np.argsort(slots)
    slots, n = slots[order], n[order]
    begins = np.flatnonzero(np.append(True, slots[1:] != slots[:-1]))[: len(slots)]
    return slots[begins], np.add.reduceat(n, begins) if len(n) else n


def spelling_slots(words: list[list[int]], c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What words of these pieces and counts add to which slots; later pieces, pairs and triples as ``steps`` says."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ids = np.fromiter(chain.from_iterable(words), dtype=np.int64, count=sizes.sum())
    ends = np.cumsum(sizes) - 1
    heads = ids[ends + 1 - sizes]
    after, before = np.append(ids, 0)[1:], np.append(0, ids)[:-1]
    after[ends], before[ends + 1 - sizes] = VOCABULARY, _WIDE
    pairs = (ids + 4) * _WIDE + after
    slots = [heads, _WIDE + heads, 2 * _WIDE + heads, 3 * _WIDE + after, pairs, (before + 1) * _WIDE * _WIDE + pairs]
    n = [c, np.ones_like(c), (c == 1).astype(np.int64), np.ones(3 * len(ids), dtype=np.int64)]
    return np.concatenate(slots), np.concatenate(n)


def piece_counts(counts: DataFrame, path: str) -> DataFrame:
    """(slot, n): per first piece tokens, words and words seen once; later pieces, pairs and triples once a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
        held, fresh, size = none, [], 0  # added up, not yet added, their number
        for batch in batches:
            for part in parts(batch):
                fresh.append(spelling_slots([spell(path, w) for w in plain(part.column("word"))], part.column("c").to_numpy()))
                size += len(fresh[-1][0])
                if size > 2 * _FLUSH:
                    held, fresh, size = added(*map(np.concatenate, zip(held, *fresh))), [], 0
                if len(held[0]) > _FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["slot", "n"])
                    held = none
        held = added(*map(np.concatenate, zip(held, *fresh)))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["slot", "n"])

    return counts.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))


def most_common(df: DataFrame, count: str, limit: int) -> pa.Table:
    """The rows of the highest counts, at most ``limit`` of them: a histogram on a log scale finds the cut."""
    level = F.floor(F.log2(count) * 8)
    least, room = None, limit
    for row in df.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():  # a few hundred levels
        room -= row["n"]
        if room < 0:
            break
        least = row["level"]
    return df.filter(level >= least if least is not None else F.lit(False)).toArrow()


class Speller(NamedTuple):
    """Classes of first pieces and chances of spellings."""

    path: str
    group: np.ndarray  # class of each first piece
    share: np.ndarray  # its share of the class, by words
    tokens: np.ndarray  # per class: tokens of training
    fresh: np.ndarray  # per class: share that goes to new words
    later: np.ndarray  # share of each later piece
    grams: dict[int, int]  # common pairs and triples
    rooms: dict[int, tuple[int, int]]  # per beginning of a pair, or common beginning of a triple: sum and number of its counts

    def asks(self, ids: list[int]) -> list[int]:
        """Keys of the counts of a spelling that may exist and were not sent out: slots, and ``~beginning``."""
        found = set()
        for _, *grams in steps(ids):
            if grams[0] // _WIDE in self.rooms:  # all beginnings of pairs are here
                found.update(g for g in grams if g not in self.grams)
                if grams[1] // _WIDE not in self.rooms:
                    found.add(~(grams[1] // _WIDE))
        return sorted(found)

    def new_word(self, ids: list[int], found: dict[int, tuple[int, int]]) -> float:
        """log10 of the chance of a new word's pieces, given its class; ``found`` answers ``asks``."""
        total = math.log10(self.fresh[self.group[ids[0]]] * self.share[ids[0]])
        for piece, *grams in steps(ids):
            chance = float(self.later[piece])
            for gram in grams:
                room = self.rooms.get(gram // _WIDE) or found.get(~(gram // _WIDE))
                if room is None:
                    break
                n = self.grams.get(gram) or found.get(gram, (0, 0))[0]
                chance = (max(n - DISCOUNT, 0) + DISCOUNT * room[1] * chance) / room[0]
            total += math.log10(chance)
        return total


def steps(ids: list[int]) -> Iterator[tuple[int, int, int]]:
    """After each piece of a word: the next piece (or the end), the slots of the pair and of the triple."""
    before = _WIDE
    for last, piece in zip(ids, [*ids[1:], VOCABULARY]):
        pair = (last + 4) * _WIDE + piece
        yield piece, pair, (before + 1) * _WIDE * _WIDE + pair
        before = last


def make_speller(path: str, singles: np.ndarray, grams: dict[int, int], rooms: dict[int, tuple[int, int]]) -> Speller:
    """singles: rows of tokens, words, words seen once (first pieces) and of later pieces."""
    tokens, words, once, later = singles + np.array([[0.0], [0.01], [0.0], [0.01]])
    order = np.argsort(-tokens, kind="stable")
    group = np.zeros(_WIDE, dtype=np.uint8)
    rest, groups = order[LONE:], _STOP - LONE
    below = np.cumsum(tokens[rest] + 1e-3)
    group[order[:LONE]] = np.arange(LONE)
    group[rest] = LONE + np.minimum((below / below[-1] * groups).astype(int), groups - 1)
    by_class = lambda x: np.bincount(group, weights=x, minlength=CLASSES)
    sums, mass = by_class(tokens), by_class(words)
    fresh = np.clip((by_class(once) + 0.5) / (sums + 1), 1e-5, 0.5)
    fresh[sums == 0] = 1.0
    return Speller(path, group, words / mass[group], sums, fresh, later / later.sum(), grams, rooms)


SHAPES = {"first": (CLASSES, WIDTH), "last": (LASTS, WIDTH), "place": (SPAN, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "o": (WIDTH, WIDTH), "out": (WIDTH, CLASSES), "bias": (CLASSES,)}
_PAST = np.tril(np.ones((SPAN, SPAN), dtype=np.float32))
_ONES = np.ones(CLASSES, dtype=np.float32)
_SCALE = np.float32(1 / math.sqrt(WIDTH))
_BITS = np.float32(1 / math.log(2))  # powers of two are faster than those of e
#: Windows that attention runs over at once: their logits stay in the processor's cache.
ABREAST = 64


def initial(prior: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    weights = {n: rng.normal(0, 0.25 if s[0] == WIDTH else 0.1, s).astype(np.float32) for n, s in SHAPES.items()}
    weights["bias"] = np.log(np.maximum(prior, 1e-9)).astype(np.float32)
    return weights


def flatten(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[n].ravel() for n in SHAPES])


def unflatten(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at, flat = {}, 0, flat.astype(np.float32)
    for name, shape in SHAPES.items():
        size = math.prod(shape)
        out[name], at = flat[at : at + size].reshape(shape), at + size
    return out


class Mixed(NamedTuple):
    """What attention makes of windows, one row a word; rows end with a one, so that sums and biases come with the products."""

    x: np.ndarray
    heads: np.ndarray  # from x to queries (scaled), keys, values and the one
    qkv: np.ndarray  # n x SPAN x (three widths and the one)
    past: np.ndarray  # exponentials of the scores, zero ahead of a word
    sums: np.ndarray  # their sums by row
    mixed: np.ndarray
    h: np.ndarray


def _wider(m: np.ndarray, corner: int, rows: int = 0) -> np.ndarray:
    """A matrix with one more column, and ``rows`` more rows, of zeros that end in ``corner``."""
    out = np.zeros((len(m) + rows, m.shape[1] + 1), dtype=m.dtype)
    out[: len(m), :-1] = m
    if rows:
        out[-1, -1] = corner
    else:
        out[:, -1] = corner
    return out


def _turned(m: np.ndarray) -> np.ndarray:
    """Each matrix transposed and laid out anew, which small products read faster."""
    return np.ascontiguousarray(m.transpose(0, 2, 1))


def mix(w: dict[str, np.ndarray], first: np.ndarray, last: np.ndarray) -> Mixed:
    """Masked attention over windows (n x SPAN words)."""
    x = _wider(w["first"], 1).take(first, axis=0)
    x += _wider(w["last"], 0).take(last, axis=0)
    x += _wider(w["place"], 0)
    x = x.reshape(-1, WIDTH + 1)
    heads = _wider(np.concatenate([w["q"] * _SCALE, w["k"], w["v"]], axis=1), 1, 1)
    qkv = (x @ heads).reshape(-1, SPAN, 3 * WIDTH + 1)
    past = qkv[:, :, :WIDTH] @ _turned(qkv[:, :, WIDTH : 2 * WIDTH])
    if past.max(initial=0) > 30:
        np.minimum(past, 30, out=past)
    np.exp(past, out=past)
    past *= _PAST
    mixed = (past @ qkv[:, :, 2 * WIDTH :]).reshape(-1, WIDTH + 1)
    sums = mixed[:, -1:].copy()
    mixed /= sums
    h = mixed @ _wider(w["o"], 0, 1)
    h += x
    return Mixed(x, heads, qkv, past, sums, mixed, h)


def classifier(w: dict[str, np.ndarray]) -> np.ndarray:
    """From ``Mixed.h`` to the logits of the next class."""
    return np.concatenate([w["out"], w["bias"][None]])


def attend(w: dict[str, np.ndarray], first: np.ndarray, last: np.ndarray) -> tuple:
    """Logits of the next class, and what the gradient needs."""
    held = mix(w, first, last)
    return (held.h @ classifier(w)).reshape(*first.shape, CLASSES), held


def gradient(w: dict[str, np.ndarray], first: np.ndarray, last: np.ndarray, target: np.ndarray, valid: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean cross entropy over valid places.

    Rows are scaled where they are narrow: neither the softmax over the classes nor the one of
    attention is divided out, and the slope through the latter comes from dm . mixed.
    """
    x, heads, qkv, past, sums, mixed, h = mix(w, first, last)
    logits = h @ (classifier(w) * _BITS)
    ones = _ONES.astype(logits.dtype, copy=False)
    with np.errstate(over="ignore"):
        p = np.exp2(logits)
        whole = p @ ones
    if not 1e-30 < whole.min() <= whole.max() < 1e30:
        p = np.exp2(logits - logits.max(axis=1, keepdims=True))
        whole = p @ ones
    p.reshape(-1)[np.arange(0, p.size, CLASSES) + target.ravel()] -= whole
    part = (valid.ravel() / max(1, valid.sum()) / whole).astype(p.dtype, copy=False)
    dh = p @ w["out"].T
    dh *= part[:, None]
    g = {"out": (p.T @ (h[:, :-1] * part[:, None])).T, "bias": part @ p, "o": (mixed.T @ dh)[:-1]}
    dm = dh @ _wider(w["o"].T, 0)
    dm /= sums
    dm[:, -1] = -np.einsum("ij,ij->i", dm, mixed)
    dm = dm.reshape(-1, SPAN, WIDTH + 1)
    ds = dm @ _turned(qkv[:, :, 2 * WIDTH :])
    ds *= past
    d = np.empty((len(first), SPAN, 3 * WIDTH), dtype=x.dtype)
    np.matmul(ds, qkv[:, :, WIDTH : 2 * WIDTH], out=d[:, :, :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), qkv[:, :, :WIDTH], out=d[:, :, WIDTH : 2 * WIDTH])
    np.matmul(past.transpose(0, 2, 1), dm[:, :, :-1], out=d[:, :, 2 * WIDTH :])
    d = d.reshape(-1, 3 * WIDTH)
    g["q"], g["k"], g["v"] = np.split((x.T @ d)[:-1], 3, axis=1)
    g["q"] = g["q"] * _SCALE
    dx = d @ heads[:-1, :-1].T
    dx += dh
    g["place"] = dx.reshape(-1, SPAN * WIDTH).sum(axis=0).reshape(SPAN, WIDTH)
    cells = np.concatenate([first.ravel().astype(np.intp), last.ravel() + np.intp(CLASSES)])[:, None] * WIDTH + np.arange(WIDTH)
    seen = np.bincount(cells.ravel(), np.concatenate([dx, dx]).ravel(), (CLASSES + LASTS) * WIDTH)
    g["first"], g["last"] = np.split(seen.reshape(-1, WIDTH), [CLASSES])
    return g


_FIELDS = np.dtype([("group", "u1"), ("last", "u1"), ("c", "<i8")])


def record(group: int, last: int, c: int) -> bytes:
    """One word as _FIELDS says."""
    return struct.pack("<BBq", group, last, c)


class Model(NamedTuple):
    speller: Speller
    weights: dict[str, np.ndarray]
    common: dict[bytes, int]
    total: int
    kinds: int
    ends: int

    def entry(self, word: bytes) -> bytes:
        """Class, slot of the last piece and count (-1: not common) as one record."""
        ids = spell(self.speller.path, word)
        return record(self.speller.group[ids[0]], ids[-1] % LASTS, self.common.get(word, -1))


def turns(words: int, shift: int, turn: int) -> range:
    """Beginnings of a round's windows: over all rounds, every word and the end lie in exactly one window."""
    return range((shift + turn) % ROUNDS * SPAN, words + 1, ROUNDS * SPAN)


def coded(docs: DataFrame, sent: Broadcast) -> DataFrame:
    """One row per text: what training and scoring read of its words, and what their counts alone make of it.

    ``marks`` holds two bytes for each word and the end, class and slot; ``rare`` the words whose counts were not
    sent out, with their classes; ``base`` and ``score`` the sums over all others, without the classes' chances.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part, row = sent.value, TaskContext.get().partitionId() << 40, 0
        memo = Memo(model.entry, 300_000)
        stop = record(_STOP, 0, model.ends)
        share = (1 - model.speller.fresh) / np.maximum(model.speller.tokens, 1)
        floor = model.total + PSEUDO * (model.kinds + 1)
        for batch in batches:
            for piece in parts(batch):
                words, sizes = laid_words(piece.column("text"))
                kinds = words.dictionary_encode()
                facts = np.frombuffer(b"".join([memo[w] for w in plain(kinds.dictionary)]) + stop, dtype=_FIELDS)
                group, c = facts["group"].copy(), facts["c"].copy()
                common = c >= 0
                base = np.where(common, np.log10((np.maximum(c, 0) + PSEUDO) / floor), 0.0)
                score = np.where(common & (group != _STOP), np.log10(np.maximum(c, 1) * share[group] + 1e-300), 0.0)
                begin = np.append(0, np.cumsum(sizes + 1))  # of each text, with its end
                line = np.insert(kinds.indices.to_numpy(), np.cumsum(sizes), len(facts) - 1)
                marks = (group + facts["last"].astype("<u2") * 256)[line]
                spots = np.flatnonzero(~common[line])
                kept = line[spots]
                rare = pa.StructArray.from_arrays([kinds.dictionary.take(pa.array(kept)), pa.array(group[kept], pa.int32())], names=["word", "class"])
                columns = [
                    pa.array(part + row + np.arange(len(piece))),
                    piece.column("doc_id"),
                    pa.array([zlib.crc32(x) for x in piece.column("text").cast(pa.binary()).to_pylist()], pa.int64()),
                    pa.Array.from_buffers(pa.binary(), len(piece), [None, pa.py_buffer((2 * begin).astype(np.int32)), pa.py_buffer(marks)]),
                    pa.array(sizes + 1),
                    pa.array(np.add.reduceat((c > 0).astype(np.int64)[line], begin[:-1])),
                    pa.array(np.add.reduceat(base[line], begin[:-1])),
                    pa.array(np.add.reduceat(score[line], begin[:-1])),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(spots, begin), pa.int32()), rare),
                ]
                row += len(piece)
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "shift", "marks", "n_tokens", "n_known", "base", "score", "rare"])

    return docs.mapInArrow(run, "row long, doc_id long, shift long, marks binary, n_tokens long, n_known long, base double, score double, rare array<struct<word:binary,class:int>>")


def laid_marks(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The marks (class, slot) of all texts, end to end, and where each text begins; the last bound is the end."""
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]]
    return data.reshape(-1, 2), (bounds - bounds[0]) // 2


def windows(marks: np.ndarray, bounds: np.ndarray, shifts: list[int], turn: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Marks of a round's windows, the word before the window first, and the number of targets in each; some at a time."""
    held = [turns(n - 1, shift, turn) for n, shift in zip(np.diff(bounds).tolist(), shifts)]
    many = [len(x) for x in held]
    begin = np.fromiter(chain.from_iterable(held), dtype=np.int64, count=sum(many))
    sizes = np.minimum(np.repeat(np.diff(bounds), many) - begin, SPAN)
    begin += np.repeat(bounds[:-1], many)
    line = np.concatenate([np.array([[_STOP, 0]], dtype=np.uint8), marks])  # before each text lies an end
    columns = np.arange(SPAN + 1)
    for k in range(0, len(begin), _ABOUT):
        size = sizes[k : k + _ABOUT]
        past = columns > size[:, None]
        at = begin[k : k + _ABOUT, None] + columns
        at[past] = 0
        yield line[at], size


def train_round(docs: DataFrame, model: Broadcast, weights: dict[str, np.ndarray], turn: int) -> dict[str, np.ndarray]:
    """One round over texts or what ``coded`` made of them: every task learns from its windows of all its
    documents, Spark averages the weights."""
    if "marks" not in docs.columns:
        docs = coded(docs.select(F.lit(None).cast("long").alias("doc_id"), "text"), model)
    start = flatten(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = start.astype(np.float64)
        first, second, steps, seen = np.zeros_like(flat), np.zeros_like(flat), 0, 0
        columns = np.arange(SPAN)

        def step(marks: np.ndarray, sizes: np.ndarray) -> None:
            nonlocal flat, first, second, steps, seen
            valid = (columns < sizes[:, None]).astype(np.float32)
            slope = flatten(gradient(unflatten(flat), marks[:, :-1, 0], marks[:, :-1, 1], marks[:, 1:, 0], valid)).astype(np.float64)
            steps += 1
            seen += len(marks)
            first *= 0.9
            first += 0.1 * slope
            second *= 0.99
            second += 0.01 * slope**2
            flat -= RATE / (1 - 0.9**steps) * first / (np.sqrt(second / (1 - 0.99**steps)) + 1e-8)

        marks, sizes = np.empty((0, SPAN + 1, 2), dtype=np.uint8), np.empty(0, dtype=np.int64)
        for batch in batches:
            for more, its in windows(*laid_marks(batch.column("marks")), batch.column("shift").to_pylist(), turn):
                marks, sizes = np.concatenate([marks, more]), np.concatenate([sizes, its])
                whole = len(marks) // BATCH * BATCH
                for k in range(0, whole, BATCH):
                    step(marks[k : k + BATCH], sizes[k : k + BATCH])
                marks, sizes = marks[whole:], sizes[whole:]
        if len(marks):
            step(marks, sizes)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([flat], pa.list_(pa.float64()))], names=["windows", "flat"])

    learned = docs.select("shift", "marks").mapInArrow(run, "windows long, flat array<double>")
    means = learned.select("windows", F.posexplode("flat").alias("at", "value")).groupBy("at").agg((F.sum(F.col("value") * F.col("windows")) / F.sum("windows")).alias("value"))
    got = means.toArrow().sort_by("at")  # one row per weight
    return unflatten(got["value"].to_numpy()) if len(got) else weights


def class_scores(w: dict[str, np.ndarray], groups: np.ndarray, lasts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 P(class | before) of every word of lines laid end to end."""
    starts = np.cumsum(sizes) - sizes
    many = 1 + np.maximum(0, -(-(sizes - SPAN) // STRIDE))
    line = np.repeat(np.arange(len(sizes)), many)
    number = np.arange(len(line)) - np.repeat(np.cumsum(many) - many, many)
    before, behind = np.empty_like(groups), np.empty_like(lasts)
    before[1:], behind[1:] = groups[:-1], lasts[:-1]
    before[starts], behind[starts] = _STOP, 0
    got, columns, last_layer = np.zeros(len(groups), dtype=np.float32), np.arange(SPAN), classifier(w) * _BITS
    for k in range(0, len(line), ABREAST):
        owner, step = line[k : k + ABREAST], number[k : k + ABREAST, None]
        place = step * STRIDE + columns
        valid = place < sizes[owner][:, None]
        at = np.where(valid, starts[owner][:, None] + place, 0)
        fresh = np.flatnonzero(valid & ((step == 0) | (columns >= SPAN - STRIDE)))
        spots = at.ravel()[fresh]
        logits = mix(w, before[at], behind[at]).h[fresh] @ last_layer
        target = logits[np.arange(len(spots)), groups[spots]]
        if logits.max() > 86:
            np.minimum(logits, 86, out=logits)
        np.exp2(logits, out=logits)
        got[spots] = (target - np.log2(logits @ _ONES)) * math.log10(2)
    return got


def spelled(new: DataFrame, facts: DataFrame, sent: Broadcast) -> DataFrame:
    """(word, spelled): log10 chances of distinct new words; the counts that were not sent out come from a join with ``facts``."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = sent.value.speller
        for batch in batches:
            words = batch.column("word")
            # A word that asks nothing gets a key of its own that no fact has, so these words are spread.
            asked = [speller.asks(spell(speller.path, w)) or [-(1 << 62) - zlib.crc32(w)] for w in words.to_pylist()]
            yield pa.RecordBatch.from_arrays([words, pa.array(asked, pa.list_(pa.int64()))], names=["word", "asked"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = sent.value.speller
        for batch in batches:
            words, found = batch.column("word"), batch.column("found").to_pylist()
            sums = [speller.new_word(spell(speller.path, w), {f["key"]: (f["n"], f["types"]) for f in fs}) for w, fs in zip(words.to_pylist(), found)]
            yield pa.RecordBatch.from_arrays([words, pa.array(sums, pa.float64())], names=["word", "spelled"])

    asked = new.select("word").mapInArrow(ask, "word binary, asked array<long>").select("word", F.explode("asked").alias("key"))
    found = F.collect_list(F.when(F.col("n").isNotNull(), F.struct("key", "n", "types")))  # of one word
    return asked.join(facts, "key", "left").groupBy("word").agg(found.alias("found")).mapInArrow(answer, "word binary, spelled double")


def corpus_scores(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every document."""
    spark = docs.sparkSession
    docs = texts(docs)
    is_held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    train = docs.filter(~is_held)
    counts = written(word_counts(train))
    ends = train.count()
    known, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, kinds = known + ends, types + (ends > 0)
    held = most_common(counts, "c", COMMON)
    common = dict(zip(held["word"].to_pylist(), held["c"].to_pylist()))

    slots = written(piece_counts(counts, path))
    got = slots.filter(F.col("slot") < 4 * _WIDE).toArrow()  # at most four rows per piece
    singles = np.zeros(4 * _WIDE)
    singles[got["slot"].to_numpy()] = got["n"].to_numpy()
    grams_of = slots.filter(F.col("slot") >= 4 * _WIDE)
    rooms_of = written(grams_of.groupBy(F.expr(f"-1 - slot div {_WIDE}").alias("key")).agg(F.sum("n").alias("n"), F.count("*").alias("types")))
    facts = grams_of.select(F.col("slot").alias("key"), "n", F.lit(0).cast("long").alias("types")).unionByName(rooms_of)
    edge, least = _WIDE * _WIDE + 4 * _WIDE, -(_WIDE + 4)
    grams: dict[int, int] = {}
    for kept in (grams_of.filter(F.col("slot") < edge), grams_of.filter(F.col("slot") >= edge)):
        sent_out = most_common(kept, "n", GRAMS)
        grams.update(zip(sent_out["slot"].to_pylist(), sent_out["n"].to_pylist()))
    rooms: dict[int, tuple[int, int]] = {}
    for sent_out in (rooms_of.filter(F.col("key") >= least).toArrow(), most_common(rooms_of.filter(F.col("key") < least), "n", GRAMS)):  # of pairs: one per piece
        rooms.update((~key, (n, types)) for key, n, types in zip(*(sent_out[x].to_pylist() for x in ("key", "n", "types"))))
    speller = make_speller(path, singles.reshape(4, _WIDE), grams, rooms)
    model = Model(speller, {}, common, total, kinds, ends)
    prior = speller.tokens + 1.0
    prior[_STOP] += ends
    sent = spark.sparkContext.broadcast(model)
    lines = written(coded(docs, sent))
    weights = initial(prior / prior.sum())
    for turn in range(ROUNDS):
        weights = train_round(lines.filter(~is_held), sent, weights, turn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in parts(batch):
                marks, bounds = laid_marks(piece.column("marks"))
                got = class_scores(weights, marks[:, 0].copy(), marks[:, 1].copy(), np.diff(bounds)).astype(np.float64)
                score = pa.array(piece.column("score").to_numpy() + np.add.reduceat(got, bounds[:-1]))
                names = [n for n in piece.schema.names if n not in ("marks", "score")]
                yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in names), score], names=[*names, "score"])

    kinds_of = "row long, doc_id long, n_tokens long, n_known long, base double, score double"
    scored = written(lines.select("row", "doc_id", "n_tokens", "n_known", "base", "score", "marks").mapInArrow(run, kinds_of))
    rare_words = lines.select("row", F.explode("rare").alias("one")).select("row", "one.*")
    # Only held-out texts hold new words: the words of all others were counted.
    unseen = lines.filter(is_held).select(F.explode("rare.word").alias("word")).distinct()
    new = spelled(unseen.join(counts, "word", "left_anti"), facts, sent)
    lexicon = counts.select("word", "c", F.lit(None).cast("double").alias("spelled")).unionByName(new.withColumn("c", F.lit(None).cast("long")))
    floor = total + PSEUDO * (kinds + 1)
    shares = F.array(*[F.lit(float(x)) for x in (1 - speller.fresh) / np.maximum(speller.tokens, 1)])
    rest = rare_words.join(lexicon, "word", "left").groupBy("row").agg(
        F.count("c").alias("more"),
        F.sum(F.log10((F.coalesce("c", F.lit(0)) + PSEUDO) / floor)).alias("rest_base"),
        F.sum(F.coalesce(F.log10(F.col("c") * F.element_at(shares, F.col("class") + 1)), "spelled")).alias("rest_score"),
    )
    none = F.lit(0.0)
    return scored.join(rest, "row", "left").select(
        "doc_id",
        is_held.alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_base", none)).alias("base_score"),
        (F.col("score") + F.coalesce("rest_score", none)).alias("score"),
    )
