"""Periodic runs against a direct search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

from loanproof.llm import runs


def direct_runs(words, least):
    """Every period by itself: stretches with equal words q apart, kept if no smaller period fits."""
    out = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            m = i + q - s
            if i > s and m >= max(least, 2 * q) and not any(words[s : s + m - r] == words[s + r : s + m] for r in range(1, q)):
                out.append((s, m, q))
            i = max(i, s + 1)
    return sorted(out)


def direct_digest(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = direct_runs(words, 12)
    dropped = {k for s, m, q in found for k in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = b" ".join(w for k, w in enumerate(words) if k not in dropped)
    return (doc_id, len(found), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_automaton_finds_all_runs():
    rng = random.Random(7)
    for _ in range(800):
        n, k, least = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 5]), rng.choice([4, 5, 12])
        words = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 2))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want = direct_runs(words, least)
        assert runs.runs_of(words, least) == want
        assert runs.text_runs([b"%d" % w for w in words], least) == want


def test_long_repetitive_texts():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 1500:
        a, b = b, b + a
    assert runs.text_runs(b) == direct_runs(b, 12)
    assert runs.text_runs([b"x"] * 200_000) == [(0, 200_000, 1)]
    block = [b"w%d" % k for k in range(30_000)]
    assert runs.text_runs(block * 3) == [(0, 90_000, 30_000)]


def test_odd_texts(odd, none):
    got = list(map(tuple, runs.run_digest(odd).collect()))
    assert len(got) == odd.count()
    by_id = {g[0]: g for g in got}
    for row in odd.collect():
        if row.doc_id != 10:
            assert by_id[row.doc_id] == direct_digest(row.doc_id, row.text)
    assert by_id[10][2:5] == (0, 3000, 1) and by_id[10][1] >= 2
    assert runs.run_digest(none).count() == 0


def test_whole_table(small):
    docs, held = small
    got = sorted(map(tuple, runs.run_digest(docs).collect()))
    short = {i: t for i, t in held.items() if len(t) < 6000}
    assert len(got) == len(held) and len(short) > 150
    assert [g for g in got if g[0] in short] == sorted(direct_digest(i, t) for i, t in short.items())
    assert sum(g[1] > 0 for g in got) > 10
