"""Collocations against direct counts of every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from loanproof.llm import bits, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def direct(rows, least, first, longest=5):
    counts, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, longest + 1):
                    if i + k <= len(words):
                        counts[lang, tuple(words[i : i + k])] += 1
    held = {key: c for key, c in counts.items() if c >= least}
    inside = {}
    for (lang, p), c in held.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                key = lang, p[i : i + size]
                inside[key] = max(inside.get(key, 0), c)
    out = {}
    for (lang, p), a in held.items():
        if len(p) > 1 and 100 * inside.get((lang, p), 0) < 100 * a:
            cuts = []
            for k in range(1, len(p)):
                left, right = counts[lang, p[:k]], counts[lang, p[k:]]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, k, p.decode(), -a, left, right, n[lang], -score) for lang, ps in out.items() for k, (score, a, p, left, right) in enumerate(sorted(ps)[:first], 1))


@pytest.fixture(scope="module")
def crowd(spark):
    rng = random.Random(5)
    words = ["a", "B", "the", "É", "漢字", "of", "x\x00y", "in", "rare", "q" * 300] + [f"w{k}" for k in range(300)]
    rows = []
    for i in range(260):
        lang = rng.choice(["en", "en", "en", "fr", None, "und"])
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts.append(rng.choice(words[:6]) if rng.random() < 0.7 else rng.choice(words))
            parts.append(rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ! ", "\x0b"]))
        rows.append((i, lang, "".join(parts) + rng.choice(["", "The big of cat the", "the Big of cat the"])))
    rows += [(900, "en", None), (901, None, ""), (902, "zz", " .,; "), (903, "en", "one two three four five six " * 900)]
    rows += [rows[3]] * 4
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, lang string, text string, phrase string, f int"), [r[1:] for r in rows]


@pytest.mark.parametrize("least,first,shard", [(3, 2000, 1 << 19), (3, 7, 40), (6, 2000, 9)])
def test_against_direct_counts(crowd, least, first, shard):
    docs, rows = crowd
    got = sorted(map(tuple, phrases.collocations(docs, least=least, first=first, shard=shard).collect()))
    assert got == direct(rows, least, first)
    assert got


def test_trie_holds_its_phrases_only():
    rng = random.Random(3)
    vocab = [b"w%d" % k for k in range(3000)]
    held = {(rng.choice(["x", "y"]), b" ".join(rng.choice(vocab[: rng.choice([5, 3000])]) for _ in range(2))) for _ in range(5000)}
    trie = phrases.build_trie([x for x, _ in held], [p for _, p in held], 2)
    assert trie.width == 2 and sorted(trie.phrase.values()) == sorted(p for _, p in held)
    full = np.full(bits.BITS // 32, 2**32 - 1, dtype="<u4")
    for lang in ("x", "y"):
        words = [rng.choice(vocab[: rng.choice([5, 3000])]) for _ in range(20_000)]
        want = Counter()
        for a, b, c in zip(words, words[1:], words[2:]):
            if (lang, a + b" " + b) in held:
                want[a + b" " + b + b" " + c] += 1
        assert phrases.extensions(lang, words, trie, full, 3) == want


def test_odd_texts(odd, none, spark):
    assert phrases.collocations(none).count() == 0
    got = phrases.collocations(odd.withColumnRenamed("source", "rank")).collect()
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert sorted(map(tuple, got)) == direct(rows, 100, 2000) and got


def test_sql_twin(small, odd):
    docs, _ = small
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "lang", "text").toPandas())
    sql = phrases.ORACLE.replace(">= 100", ">= 20")
    want = sorted(map(tuple, con.execute(sql).fetchall()))
    assert sorted(map(tuple, phrases.collocations(docs, least=20).collect())) == want and len(want) > 20
