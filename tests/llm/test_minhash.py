"""MinHash near duplicates against exact set overlaps of all pairs."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from loanproof.llm import minhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = (text or "").translate(LOWER).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def direct(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and top(i) != top(j):
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    label[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if sets[i]:
            known = least.get(top(i))
            least[top(i)] = known if doc_id is None else doc_id if known is None else min(known, doc_id)
    ids = [least[top(i)] if sets[i] else doc_id for i, (doc_id, _) in enumerate(rows)]
    return sorted(((d, len(s), c, d is not None and d == c) for (d, _), s, c in zip(rows, sets, ids)), key=str)


def got(frame, **kw):
    return sorted(map(tuple, minhash.near_duplicates(frame, **kw).collect()), key=str)


def test_families_of_copies(spark):
    """Originals with edited copies: many copies link to the original only, and chains reach far."""
    rng = random.Random(4)
    vocab = [f"w{k}" for k in range(500)]
    rows = []
    for family in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([4, 7, 12, 60, 200, 200, 400]))]
        current = base
        for copy in range(rng.choice([1, 6, 30])):
            source = base if family % 2 else current
            text = list(source)
            for _ in range(max(1, round(len(text) * rng.choice([0.004, 0.012, 0.016, 0.03])))):
                text[rng.randrange(len(text))] = rng.choice(vocab)
            current = text
            rows.append(" ".join(text))
        rows.append(" ".join(base).upper())
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    frame = spark.createDataFrame([(*r, 3, "x") for r in rows], "doc_id long, text string, n int, bucket string")
    want = direct(rows)
    assert got(frame) == want
    assert max(Counter(c for _, _, c, _ in want).values()) > 20
    assert sum(k for *_, k in want) > 20


@pytest.mark.parametrize("chunk", [512, 5])
def test_centre_hides_nothing(spark, monkeypatch, chunk):
    """Two copies alike only to each other share buckets with a centre that is like neither."""
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    rng = random.Random(9)
    vocab = [f"v{k}" for k in range(900)]
    base = [rng.choice(vocab) for _ in range(300)]
    rows = []
    for pair in range(25):
        text = list(base)
        for _ in range(8):
            text[rng.randrange(300)] = f"p{pair}"
        rows.append(" ".join(text))
        text[rng.randrange(300)] = "q"
        rows.append(" ".join(text))
    rows.append(" ".join(base))
    rows = list(enumerate(rows))
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == direct(rows)


@pytest.mark.parametrize("size", [1, 2, 5, 40, 127, 128, 5000])
def test_densified_bins_agree(size):
    rng = random.Random(size)
    words = [f"w{rng.randrange(10**6)}" for _ in range(size + 4)]
    found = minhash.shingle_set(" ".join(words))
    assert len(found) == len(shingles(" ".join(words)))
    same = minhash.band_keys(found)
    assert len(same) == minhash.BANDS and (same == minhash.band_keys(found.copy())).all()
    other = minhash.band_keys(minhash.shingle_set("else " * 3 + " ".join(words)))
    assert size < 100 or 0 < (same == other).sum()


def test_overlaps():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60_000, size=s).astype(np.uint64)) for s in (1, 5, 4000, 30_000, 50_000, 50_000)]
    both = minhash.overlaps(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert i == j or both[i, j] == len(np.intersect1d(a, b))


def test_odd_texts(odd, none):
    assert got(odd) == direct([(r.doc_id, r.text) for r in odd.collect()])
    assert got(none) == []


def test_whole_table(small):
    docs, held = small
    want = direct(sorted(held.items()))
    assert got(docs) == want and any(not k for *_, k in want)
