"""Collocations per language: frequent phrases by Apriori levels over double-array tries.

Words are counted first (one shuffle, added up in the tasks before). Each further level k = 2 .. 5:

1. The frequent phrases of k - 1 words are dealt by hash into shards of about ``SHARD`` phrases. The
   driver lays each shard out as a double-array trie (a word is ``width`` bytes of its number in the
   shard) and broadcasts it: a shard's size is bounded, their number grows with the data.
2. Every task advances all text positions of a chunk through the trie at once, byte by byte and word
   by word; positions that fall out of it are gone. What is left stands on an accepting state, a
   frequent phrase of k - 1 words, and is extended by its next word in the same piece.
3. An extension is a candidate only if its last k - 1 words may be frequent too (Apriori). That test
   reads a bit set of fixed size over all frequent phrases of k - 1 words; a false hit is counted
   in vain and dropped by its count. So only candidates that occur are ever built: the trie of all
   joined candidates would hold every pair of a phrase ending and one beginning with the same words.
   Pairs pass a second safe test, as words alone leave most of them: an earlier pass counts all pairs
   by a 27-bit hash, in sorted and compressed pieces per range of slots, and only pairs whose slot
   reached the least count are candidates.
4. Accepting state and next word are bincounted per chunk, added up per task, and the sums of all
   tasks and shards meet in one shuffle.

A phrase inside a longer candidate of equal count is found one word longer: counts can only fall with
length, so the phrases between the two have that count as well. Ranks are cut twice, first within
hash salts of a language, so no task sees all candidates of one.

Defined cases: null and empty texts have no words; a null lang is ``und`` (with texts of that name);
repeated rows count again; ties go by the phrase's bytes; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanproof.llm.bits import BITS, bit_set, contains
from loanproof.llm.common import LOWER_AZ
from loanproof.session import materialize, ship_package

LEAST = 100
LONGEST = 5
FIRST = 2000
SHARD = 1 << 19
SALTS = 32
_CHUNK = 1_000_000  # bytes of text advanced at once
_FLUSH = 500_000
_RANGE = 15  # bits of a slot within its range
_BREAK = b"\xff"  # no UTF-8 text holds this byte
_TABLE = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else LOWER_AZ[b] for b in range(256))
_FACTORS = np.random.default_rng(11).integers(0, 2**64, size=LONGEST, dtype=np.uint64) | np.uint64(1)
_COUNTED = "lang string, phrase string, f long"


def split(raw: bytes) -> list[bytes]:
    """The words of a text, A-Z lowered, with a break mark wherever a piece ends."""
    return raw.translate(_TABLE).replace(_BREAK, b" \xff ").split()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, words) of about ``_CHUNK`` bytes each; texts of one language are joined by breaks."""
    held: dict[str, list[bytes]] = defaultdict(list)
    sizes: Counter = Counter()
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            key, raw = lang.as_py(), text.as_py().encode("utf-8", "surrogatepass")
            held[key].append(raw)
            sizes[key] += len(raw)
            if sizes[key] > _CHUNK:
                yield key, split(b"\n".join(held.pop(key)))
                del sizes[key]
    for key, raws in held.items():
        yield key, split(b"\n".join(raws))


class _Sums:
    """(lang, phrase) counts of a task, handed on in bounded batches."""

    def __init__(self):
        self.held: dict[str, Counter] = defaultdict(Counter)
        self.size = 0

    def batches(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if sum(map(len, self.held.values())) <= least:
            return
        for lang, counts in self.held.items():
            phrases = pa.array(counts.keys(), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(counts)), phrases, pa.array(counts.values(), pa.int64())], names=["lang", "phrase", "f"])
        self.held.clear()


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, f) of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for lang, words in _chunks(batches):
            counts = Counter(words)
            del counts[_BREAK]
            sums.held[lang].update(counts)
            yield from sums.batches(_FLUSH)
        yield from sums.batches()

    return _summed(docs.mapInArrow(run, _COUNTED))


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def phrase_keys(phrases: DataFrame) -> DataFrame:
    """The 64-bit key of each phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [sum(word_key(w) * int(m) for w, m in zip(p.encode("utf-8", "surrogatepass").split(b" "), _FACTORS)) % 2**64 for p in batch.column("phrase").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, dtype=np.uint64).view(np.int64))], names=["key"])

    return phrases.select("phrase").mapInArrow(run, "key long")


def _numbered(words: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Each word's number in the chunk (0: break), the distinct words by number, and their keys."""
    seen: dict[bytes, int] = defaultdict(itertools.count().__next__)
    seen[_BREAK]  # the first number
    ids = np.fromiter(map(seen.__getitem__, words), dtype=np.int64, count=len(words))
    return ids, list(seen), np.fromiter(map(word_key, seen), dtype=np.uint64, count=len(seen))


def _slot(keys: np.ndarray) -> np.ndarray:
    mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)


def _pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first * _FACTORS[0] + second * _FACTORS[1]


def heavy_pairs(docs: DataFrame, least: int) -> np.ndarray:
    """Bits of the slots whose pairs of neighbouring words occur ``least`` times in all: at most BITS / 8 bytes.

    Tasks send, per range of slots, sorted gaps and counts as compressed bytes; one task adds up a range.
    """
    shape = "part int, counts binary"

    def packed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        slots, counts = _added(held)
        starts = np.flatnonzero(np.diff(slots >> _RANGE, prepend=-1))
        press = zstandard.ZstdCompressor(level=1)
        blobs = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(slots)]):
            both = np.stack((np.diff(slots[a:b] & ((1 << _RANGE) - 1), prepend=0), counts[a:b])).astype("<i8")
            blobs.append(press.compress(both.view(np.uint8).reshape(-1, 8).T.tobytes()))
        return pa.RecordBatch.from_arrays([pa.array((slots[starts] >> _RANGE).astype(np.int32)), pa.array(blobs, pa.binary())], names=["part", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for _, words in _chunks(batches):
            ids, _, keys = _numbered(words)
            at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            held.append(np.unique(_slot(_pair_keys(keys[ids[at]], keys[ids[at + 1]])), return_counts=True))
            if sum(len(s) for s, _ in held) > 8 * _FLUSH:
                held = [_added(held)]
                if len(held[0][0]) > 4 * _FLUSH:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        now, sums = None, np.zeros(1 << _RANGE, dtype=np.int64)

        def bits() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(sums >= least, bitorder="little").tobytes()], pa.binary())], names=["part", "counts"])

        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("counts")):
                if part != now:
                    if now is not None:
                        yield bits()
                    now = part
                    sums[:] = 0
                gaps, counts = np.frombuffer(press.decompress(blob.as_py()), dtype=np.uint8).reshape(8, -1).T.copy().view("<i8").reshape(2, -1)
                sums[np.cumsum(gaps)] += counts
        if now is not None:
            yield bits()

    found = docs.mapInArrow(count, shape).repartition("part").sortWithinPartitions("part").mapInArrow(add, shape).toArrow()
    out = np.zeros((BITS >> _RANGE, (1 << _RANGE) // 8), dtype=np.uint8)
    for part, blob in zip(found.column("part").to_pylist(), found.column("counts").to_pylist()):
        out[part] = np.frombuffer(blob, dtype=np.uint8)
    return out.reshape(-1)


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and counts of several parts as one, in order."""
    slots, place = np.unique(np.concatenate([s for s, _ in held]), return_inverse=True)
    return slots, np.bincount(place, weights=np.concatenate([c for _, c in held]), minlength=len(slots)).astype(np.int64)


class Trie(NamedTuple):
    """A double-array trie: state s goes by byte c to base[s] + c if check[] there is s. State 0 is the root."""

    base: np.ndarray
    check: np.ndarray
    width: int  # bytes a word
    vocab: dict[str, dict[bytes, int]]  # per language, the numbers of the words
    phrase: dict[int, bytes]  # of the accepting states


def _place(children: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """A base for each node so that no two children share a slot; crowded nodes first, lone children fill the gaps."""
    sizes = np.array([len(c) for c in children])
    bases = np.zeros(len(children), dtype=np.int64)
    free = np.ones(int(sizes.sum()) * 2 + 4096, dtype=bool)
    free[0] = False  # the root's own slot
    start = 1
    for node in np.argsort(-sizes, kind="stable").tolist():
        if sizes[node] < 2:
            break
        kids, low = children[node], start
        while True:
            if low + 1024 > len(free):
                free = np.concatenate((free, np.ones(len(free), dtype=bool)))
            spots = low + np.flatnonzero(free[low : low + 512]) - kids[0]
            spots = spots[spots >= 0]
            fits = free[spots[:, None] + kids].all(axis=1)
            if fits.any():
                bases[node] = spots[int(fits.argmax())]
                free[bases[node] + kids] = False
                break
            low += 512
        if not free[start : start + 512].any() or low > start + 8192:
            start += 512
    lone = np.flatnonzero(sizes == 1)
    if len(lone):
        kids = np.concatenate([children[k] for k in lone.tolist()])
        if int(free.sum()) < len(lone) + 256:
            free = np.concatenate((free, np.ones(len(lone) + 256, dtype=bool)))
        open_slots = np.flatnonzero(free)
        open_slots = open_slots[open_slots >= 256][: len(lone)]
        if len(open_slots) < len(lone):
            open_slots = np.concatenate((open_slots, len(free) + np.arange(len(lone) - len(open_slots))))
        bases[lone] = open_slots - kids
    return bases, int(bases.max(initial=0)) + 512


def build_trie(langs: list[str], phrases: list[bytes], words: int) -> Trie:
    """The trie of phrases of ``words`` words each, every language with numbers of its own."""
    vocab: dict[str, dict[bytes, int]] = {}
    count = 0
    ids = np.zeros((len(phrases), words), dtype=np.int64)
    for row, (lang, phrase) in enumerate(zip(langs, phrases)):
        known = vocab.setdefault(lang, {})
        for col, word in enumerate(phrase.split(b" ")):
            if word not in known:
                known[word] = count
                count += 1
            ids[row, col] = known[word]
    width = max(1, (max(count - 1, 1).bit_length() + 7) // 8)
    digits = ((ids[:, :, None] >> (8 * np.arange(width - 1, -1, -1))) & 255).reshape(len(phrases), -1)
    order = np.lexsort(digits.T[::-1])
    sorted_digits = digits[order]
    new = np.zeros(len(phrases), dtype=bool)
    new[:1] = True
    node = np.zeros(len(phrases), dtype=np.int64)
    total, parents, labels = 1, [], []
    for depth in range(digits.shape[1]):
        new[1:] |= sorted_digits[1:, depth] != sorted_digits[:-1, depth]
        first = np.flatnonzero(new)
        parents.append(node[first])
        labels.append(sorted_digits[first, depth])
        node = total + np.cumsum(new) - 1
        total += len(first)
    parent, label = np.concatenate(parents), np.concatenate(labels)  # of nodes 1, 2, ...
    by_parent = np.argsort(parent, kind="stable")
    children = np.split(label[by_parent], np.cumsum(np.bincount(parent, minlength=total))[:-1])
    bases, size = _place(children)
    slot = np.zeros(total, dtype=np.int64)
    slot[1:] = bases[parent] + label
    base, check = np.zeros(size, dtype=np.int32), np.full(size, -1, dtype=np.int32)
    base[slot] = bases
    check[slot[1:]] = slot[parent]
    accepting = slot[node]
    return Trie(base, check, width, vocab, {int(s): phrases[k] for s, k in zip(accepting.tolist(), order.tolist())})


def extensions(lang: str, words: list[bytes], trie: Trie, bits: np.ndarray, size: int, heavy: np.ndarray | None = None) -> Counter:
    """Counts of the candidates of ``size`` words in a chunk: a phrase of the trie and the next word."""
    ids, distinct, keys = _numbered(words)
    ids = np.concatenate((ids, np.zeros(size, dtype=np.int64)))
    known = trie.vocab.get(lang, {})
    number = np.fromiter((known.get(w, -1) for w in distinct), dtype=np.int64, count=len(distinct))
    number[0] = -1
    numbers = number[ids]
    at = np.flatnonzero(numbers[: len(words)] >= 0)
    state = np.zeros(len(at), dtype=np.int64)
    for step in range(size - 1):
        here = numbers[at + step]
        alive = here >= 0
        at, state, here = at[alive], state[alive], here[alive]
        for shift in range(8 * (trie.width - 1), -1, -8):
            after = trie.base[state] + ((here >> shift) & 255)
            alive = trie.check[after] == state
            at, state, here = at[alive], after[alive], here[alive]
    last = ids[at + size - 1]
    alive = last > 0
    at, state, last = at[alive], state[alive], last[alive]
    keys = keys[ids]
    if heavy is not None:
        slots = _slot(_pair_keys(keys[at], keys[at + 1]))
        alive = (heavy[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1
        at, state, last = at[alive], state[alive], last[alive]
    tail = np.zeros(len(at), dtype=np.uint64)
    for step in range(1, size):
        tail += keys[at + step] * _FACTORS[step - 1]
    alive = contains(bits, tail)
    state, last = state[alive], last[alive]
    codes, place = np.unique(state * len(distinct) + last, return_inverse=True)
    counts = np.bincount(place, minlength=len(codes))
    phrase = trie.phrase
    return Counter({phrase[c // len(distinct)] + b" " + distinct[c % len(distinct)]: n for c, n in zip(codes.tolist(), counts.tolist())})


def _level(docs: DataFrame, frequent: DataFrame, size: int, least: int, shard: int) -> DataFrame:
    """(lang, phrase, f) of the candidates of ``size`` words, from the frequent phrases one word shorter."""
    context = docs.sparkSession.sparkContext
    bits = context.broadcast(bit_set(phrase_keys(frequent)))
    heavy = context.broadcast(heavy_pairs(docs, least) if size == 2 else None)
    many = frequent.count()
    shards = max(1, -(-many // shard))
    parts = None
    for k in range(shards):
        mine = frequent.filter(F.pmod(F.xxhash64("lang", "phrase"), F.lit(shards)) == k).select("lang", F.col("phrase").cast("binary").alias("phrase")).toArrow()
        if not mine.num_rows:
            continue
        trie = context.broadcast(build_trie(mine.column("lang").to_pylist(), mine.column("phrase").to_pylist(), size - 1))
        part = docs.mapInArrow(_counter(trie, bits, heavy, size), _COUNTED)
        parts = part if parts is None else parts.unionByName(part)
    return _summed(parts) if parts is not None else frequent.limit(0)


def _counter(trie: Broadcast, bits: Broadcast, heavy: Broadcast, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for lang, words in _chunks(batches):
            sums.held[lang].update(extensions(lang, words, trie.value, bits.value, size, heavy.value))
            yield from sums.batches(_FLUSH)
        yield from sums.batches()

    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """((lang, n) with all words counted, (lang, phrase, words, f) of all phrases that occur ``least`` times)."""
    ship_package(docs.sparkSession)
    held = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = materialize(word_counts(held))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    level = words.filter(F.col("f") >= least)
    found = level.withColumn("words", F.lit(1))
    for size in range(2, longest + 1):
        level = materialize(_level(held, level, size, least, shard).filter(F.col("f") >= least))
        found = found.unionByName(level.withColumn("words", F.lit(size)))
    return totals, found


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST, shard: int = SHARD) -> DataFrame:
    """The ``first`` phrases of each language by score: lang, rank, phrase, a, l, r, n, score."""
    totals, found = frequent_phrases(docs, least, longest, shard)
    named = found.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("parts")).filter(F.size("parts") > 1)
    inner = lambda lo, n: F.concat_ws(" ", F.slice("parts", lo, n))
    size = F.size("parts")
    shorter = named.filter(size > 2).select("lang", F.col("a").alias("longer"), F.explode(F.array(inner(F.lit(1), size - 1), inner(F.lit(2), size - 1))).alias("phrase"))
    shorter = shorter.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = named.join(shorter, ["lang", "phrase"], "left").filter("longer IS NULL OR longer < a").drop("longer")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", inner(F.lit(1), F.col("k")).alias("head"), inner(F.col("k") + 1, size - F.col("k")).alias("rest"))
    known = found.select("lang", "phrase", "f")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(totals, "lang")
    wide = lambda c: f"CAST({c} AS DECIMAL(19,0))"  # noqa: E731  products have 38 digits
    scored = cuts.withColumn("score", F.expr(f"CAST(FLOOR((CAST(1000 AS DECIMAL(4,0)) * {wide('a')} * CAST(n AS DECIMAL(15,0))) DIV ({wide('l')} * {wide('r')})) AS BIGINT)"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    rows = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= first)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= first)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same rows in SQL: every stretch of up to five words, counted.
ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, piece_no,
         list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') AS w
  FROM (SELECT lang, doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS piece_no
        FROM (SELECT lang, doc_id, regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\\n\\x0B\\f\\r]') AS p FROM documents))
), spots AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0
), totals AS (
  SELECT lang, count(*) AS n FROM spots GROUP BY lang
), sizes AS (
  SELECT unnest(range(1, 6)) AS k
), found AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM spots, sizes WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
), shorter AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:k - 1], ' '), array_to_string(string_split(phrase, ' ')[2:k], ' ')]) AS phrase
    FROM found WHERE k > 2) GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, j, h.f AS l, t.f AS r, n,
         CAST((1000::HUGEINT * c.f * n) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM found WHERE k > 1) AS c
  LEFT JOIN shorter AS s ON s.lang = c.lang AND s.phrase = c.phrase
  JOIN found AS h ON h.lang = c.lang AND h.phrase = array_to_string(string_split(c.phrase, ' ')[1:j], ' ')
  JOIN found AS t ON t.lang = c.lang AND t.phrase = array_to_string(string_split(c.phrase, ' ')[j + 1:], ' ')
  JOIN totals ON totals.lang = c.lang
  WHERE s.longer IS NULL OR s.longer < c.f
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score
FROM lowest QUALIFY rank <= 2000
"""
