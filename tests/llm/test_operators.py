"""Every operator on odd rows and empty tables, and against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash

from loanproof.llm import bpe, licenses, lm, packing, quality, rules, secrets, simhash, topk, toxicity
from loanproof.llm.common import lower_words
from loanproof.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def rows(df):
    return df.collect()


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(name))


@pytest.fixture(params=["odd", "small"])
def docs(request, odd, small):
    return odd if request.param == "odd" else small[0]


def test_bpe_equals_library(docs):
    whole = tokenizer(WORD_BPE)
    want = Counter()
    for i, t in texts_of(docs):
        ids = whole.encode(t, add_special_tokens=False).ids
        want[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(whole.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in rows(bpe.bpe_digest(docs, tokenizer_path(WORD_BPE)))) == want


def test_bpe_round_trip(odd):
    coder = bpe.encoder(tokenizer_path(WORD_BPE))
    for r in rows(bpe.bpe_encode(odd, tokenizer_path(WORD_BPE))):
        assert coder.decode([int(i) for i in r.ids.split()]) == r.decoded


def test_packing_covers_every_id(docs):
    whole = tokenizer(BYTE_BPE)
    got = rows(packing.pack(docs, tokenizer_path(BYTE_BPE)))
    want = Counter()
    for i, t in texts_of(docs):
        want[(i, len(whole.encode(t, add_special_tokens=False).ids) + 1)] += 1
    tokens = Counter()
    for r in got:
        tokens[(r.doc_id, r.doc_tokens)] += r.length
    assert tokens == Counter({k: k[1] * n for k, n in want.items()})
    by_text = {i: np.array([*whole.encode(t, add_special_tokens=False).ids, 0], dtype="<u4") for i, t in texts_of(docs)}
    assert all(zlib.crc32(by_text[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in got if r.doc_id is not None)
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0 and at < 1024


def test_simhash_components(docs):
    def fingerprint(text):
        words = WORD.findall(lower(text))
        parts = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))

    held = [(i, fingerprint(t)) for i, t in texts_of(docs)]
    parent = list(range(len(held)))
    for a in range(len(held)):
        for b in range(a):
            if (held[a][1] ^ held[b][1]).bit_count() <= 3 and parent[a] != parent[b]:
                old, new = parent[a], parent[b]
                parent = [new if p == old else p for p in parent]
    least = {p: min((held[k][0] for k in range(len(held)) if parent[k] == p and held[k][0] is not None), default=None) for p in parent}
    want = Counter((i, f"{f:016x}", least[parent[k]]) for k, (i, f) in enumerate(held))
    assert Counter(tuple(r) for r in rows(simhash.near_duplicates(docs))) == want
    kept = rows(simhash.drop_near_duplicates(docs))
    assert len(kept) == len(set(parent)) and simhash.drop_near_duplicates(docs).columns == docs.columns


def test_index_finds_all_links_in_crowded_nodes(spark, monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (6, 60, 2)).astype(np.uint64)
    values = np.unique((centres[:, None] ^ np.bitwise_or.reduce(flips, axis=2)).ravel())
    a, b = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3)
    want = simhash.smallest_reached(len(values), a, b)
    table = spark.createDataFrame([(int(v), i) for i, v in enumerate(values.view(np.int64))], "fp long, doc_id long")
    for chunk, deep in ((1024, 65_536), (8, 65_536), (8, 20)):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        monkeypatch.setattr(simhash, "DEEP", deep)
        got = {r.fp: r.component_id for r in rows(simhash.components(table))}
        assert [got[int(v)] for v in values.view(np.int64)] == want.tolist()


def test_secrets_base_spans(docs):
    kinds = [("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6, re.I | re.A), ("access", "AKIA[A-Z0-9]+", 0, 20, 0), ("hex", "[0-9a-f]+", 0, 24, 0)]
    want, got = Counter(), Counter()
    for i, t in texts_of(docs):
        spans = sorted((m.start(), k, m.end()) for k, (_, p, g, least, flags) in enumerate(kinds) for m in re.finditer(p, t, flags) if len(m.group(g)) >= least)
        written = ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in spans)
        want[(i, *(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(written.encode()).hexdigest(), written)] += 1
    for r in rows(secrets.secret_scan(docs)):
        base = ",".join(s for s in r.spans.split(",") if not s.startswith("entropy"))
        got[(*tuple(r)[:-1], base)] += 1
    assert got == want


def test_secret_entropy_and_redaction(odd):
    got = {r.doc_id: r for r in rows(secrets.secret_scan(odd))}
    assert "entropy" in got[8].spans and "entropy" not in got[10].spans
    clean = {r.doc_id: r for r in rows(secrets.redact(odd))}
    assert clean[7].text == "[SECRET] and token:abc and [SECRET] and [SECRET]" and clean[7].n_chars == len(clean[7].text)
    assert clean[0].text is None and clean[10].text == dict(texts_of(odd))[10]


def test_secrets_beside_allowed_words_and_base_spans(spark):
    random = "q8Zk2Lm9Xw4Tn7Vb1Rc5"
    texts = [
        f"EXAMPLE_DB={random}",
        f"AKIA{'B7' * 8}/{random}",
        f"see {random}/AKIA{'B7' * 8}",
        "id=550e8400-e29b-41d4-a716-446655440000",
        "token=abcdefgh1234567890 and example/placeholder/0123456789abc",
    ]
    want = ["EXAMPLE_DB=[SECRET]", "[SECRET][SECRET]", "see [SECRET][SECRET]", texts[3], "[SECRET] and example/placeholder/0123456789abc"]
    named = [(i, t, "kept", "free", "a.b", [1]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(named, "doc_id long, text string, _text string, _found string, `base.x` string, spans array<int>")
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns
    for r, t in zip(sorted(rows(clean)), want):
        assert (r.text, r[2:]) == (t, ("kept", "free", "a.b", [1]))


def test_long_candidate(spark):
    rng = np.random.default_rng(3)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    block = "".join(letters[rng.integers(0, 64, 1_000_000)])
    docs = spark.createDataFrame([(1, f"head {block} tail {block}", "x")], "doc_id long, text string, lang string")
    assert rows(secrets.redact(docs))[0].text == "head [SECRET] tail [SECRET]"


def test_entropy_of_windows(spark):
    def best(text):
        return max(sum(-n / 20 * math.log2(n / 20) for n in Counter(text[k : k + 20]).values()) for k in range(len(text) - 19))

    held = ["aB3" * 9, "0123456789abcdef0123", "Xk9+Lw3Er7tY1uI8oPq2Zs4aaaaaaaaaaaaaaaa"]
    df = spark.createDataFrame([(t,) for t in held], "t string")
    from pyspark.sql import functions as F

    for r in rows(df.select("t", secrets.best_entropy(F.col("t")).alias("h"))):
        assert r.h == pytest.approx(best(r.t), abs=1e-9)


def test_language_model_base(docs):
    held = [(i, [*WORD.findall(lower(t)), None]) for i, t in texts_of(docs)]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter(w for i, words in held if not out(i) for w in words)
    total, kinds = sum(counts.values()), len(counts)
    want = Counter((i, out(i), len(w), sum(counts[x] > 0 for x in w), total, round(sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in w), 4)) for i, w in held)
    got = rows(lm.corpus_scores(docs, tokenizer_path(BYTE_BPE)))
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score <= 1e-3 for r in got)


def test_language_model_spells_by_all_counts(small, monkeypatch):
    path = tokenizer_path(BYTE_BPE)
    whole = {r.doc_id: r.score for r in rows(lm.corpus_scores(small[0], path))}
    monkeypatch.setattr(lm, "GRAMS", 16)
    assert {r.doc_id: r.score for r in rows(lm.corpus_scores(small[0], path))} == pytest.approx(whole, rel=1e-5)


def test_language_model_learns_from_every_word(spark):
    for words in (0, 1, 31, 32, 33, 240, 1000):
        for shift in (0, 7):
            seen = Counter(k for turn in range(lm.ROUNDS) for begin in lm.turns(words, shift, turn) for k in range(begin, min(begin + lm.SPAN, words + 1)))
            assert seen == Counter(range(words + 1))
    path = tokenizer_path(BYTE_BPE)
    speller = lm.make_speller(path, np.ones((4, lm._WIDE)), {}, {})
    sent = spark.sparkContext.broadcast(lm.Model(speller, {}, {}, 0, 0, 0))
    start = lm.initial(np.full(lm.CLASSES, 1 / lm.CLASSES))
    taught = []
    for k in (5, 100, 190):  # one other word, far from the others, is learnt wherever it is
        line = ["the"] * 200
        line[k] = "xylophone"
        docs = spark.createDataFrame([(" ".join(line),)], "text string").coalesce(1)
        weights = start
        for turn in range(lm.ROUNDS):
            weights = lm.train_round(docs, sent, weights, turn)
        taught.append(weights["bias"][speller.group[lm.spell(path, b"xylophone")[0]]] - start["bias"][0])
    assert min(taught) > 0


def test_language_model_windows_equal_one_by_one():
    rng = np.random.default_rng(1)
    w = lm.initial(np.full(lm.CLASSES, 1 / lm.CLASSES))
    groups, lasts, sizes = rng.integers(0, lm.CLASSES - 1, 150).astype(np.uint8), rng.integers(0, lm.LASTS, 150).astype(np.uint8), np.array([1, 32, 117])
    got = lm.class_scores(w, groups, lasts, sizes)
    for line, begin in zip(sizes, (0, 1, 33)):
        for t in range(line):
            start = 0 if t < lm.SPAN else lm.STRIDE * (1 + (t - lm.SPAN) // lm.STRIDE)
            place = np.arange(start, start + lm.SPAN)
            before = lambda x, first: np.where(place == 0, first, x[np.clip(begin + place - 1, 0, 149)])
            logits = lm.attend(w, before(groups, lm.CLASSES - 1)[None], before(lasts, 0)[None])[0][0, t - start].astype(float)
            assert got[begin + t] == pytest.approx((logits[groups[begin + t]] - np.log(np.exp(logits).sum())) / math.log(10), abs=1e-3)


def test_language_model_reads_a_text_once(spark, docs):
    path = tokenizer_path(BYTE_BPE)
    texts = [t for _, t in texts_of(docs)] + ["a\x0bB", " x", "y ", "Zz\x85[@`{ z", ""]
    column = pa.array(["skipped words", *texts])[1:]  # a slice, as parts of a batch are
    words, sizes = lm.laid_words(column)
    assert sizes.tolist() == [len(lower_words(t)) for t in texts]
    assert lm.plain(words) == [w for t in texts for w in lower_words(t)]

    speller = lm.make_speller(path, np.ones((4, lm._WIDE)), {}, {})
    model = lm.Model(speller, {}, {b"the": 7, b"words": 2}, 9, 2, 3)
    sent = spark.sparkContext.broadcast(model)
    plain = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    lines = lm.coded(plain, sent).persist()
    for r in lines.collect():
        own = lower_words(texts[r.doc_id])
        facts = [np.frombuffer(model.entry(w), dtype=lm._FIELDS)[0] for w in own]
        marks = [(f["group"], f["last"]) for f in facts] + [(lm._STOP, 0)]
        assert list(zip(*[iter(bytes(r.marks))] * 2)) == marks
        assert [(bytes(x["word"]), x["class"]) for x in r.rare] == [(w, f["group"]) for w, f in zip(own, facts) if f["c"] < 0]
        assert (r.n_tokens, r.n_known, r.shift) == (len(own) + 1, sum(f["c"] > 0 for f in facts) + 1, zlib.crc32(texts[r.doc_id].encode()))
        held, bounds = lm.laid_marks(pa.array([b"", bytes(r.marks)])[1:])
        for turn in range(lm.ROUNDS):
            got = [(m, n) for some, sizes in lm.windows(held, bounds, [r.shift], turn) for m, n in zip(some.tolist(), sizes.tolist())]
            line = [(lm._STOP, 0), *marks]
            want = [line[b : b + lm.SPAN + 1] for b in lm.turns(len(own), r.shift, turn)]
            assert [[tuple(x) for x in m[: n + 1]] for m, n in got] == want

    start = lm.initial(np.full(lm.CLASSES, 1 / lm.CLASSES))
    by_text, by_marks = (lm.flatten(lm.train_round(d, sent, start, 0)) for d in (plain, lines))
    assert (by_text == by_marks).all() and not (by_text == lm.flatten(start)).all()


def test_language_model_piece_slots():
    words, c = [[5, 9, 9], [5], [lm.VOCABULARY - 1, 5]], np.array([4, 1, 1])
    want = Counter()
    for ids, n in zip(words, c.tolist()):
        want.update({ids[0]: n, lm._WIDE + ids[0]: 1, 2 * lm._WIDE + ids[0]: int(n == 1)})
        for piece, pair, triple in lm.steps(ids):
            want.update([3 * lm._WIDE + piece, pair, triple])
    slots, n = lm.added(*lm.spelling_slots(words, c))
    assert dict(zip(slots.tolist(), n.tolist())) == dict(want)
    assert [len(x) for x in lm.added(*lm.spelling_slots([], c[:0]))] == [0, 0]


def test_language_model_gradient():
    rng = np.random.default_rng(2)
    w = {n: x.astype(np.float64) for n, x in lm.initial(np.full(lm.CLASSES, 1 / lm.CLASSES)).items()}
    first, last, target = rng.integers(0, lm.CLASSES, (2, lm.SPAN)), rng.integers(0, lm.LASTS, (2, lm.SPAN)), rng.integers(0, lm.CLASSES, (2, lm.SPAN))
    valid = np.ones((2, lm.SPAN))

    def loss():
        z = lm.attend(w, first, last)[0]
        z = z - np.log(np.exp(z).sum(axis=2, keepdims=True))
        return -z[np.arange(2)[:, None], np.arange(lm.SPAN), target].mean()

    slopes = lm.gradient(w, first, last, target, valid)
    for name in w:
        spot = tuple(0 if name != "first" else int(first[0, 3]) if k == 0 else 0 for k in range(w[name].ndim))
        w[name][spot] += 1e-5
        up = loss()
        w[name][spot] -= 2e-5
        assert (up - loss()) / 2e-5 == pytest.approx(float(slopes[name][spot]), abs=2e-6)
        w[name][spot] += 1e-5


def test_rules_base_counts(docs, labels):
    want = Counter()
    for i, t in texts_of(docs):
        words = WORD.findall(t)
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        often = Counter(windows)
        cover = {k + j for k, x in enumerate(windows) if often[x] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(words) < 10 or 100 * len(cover) > 20 * len(words)
        want[(i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover), failed)] += 1
    got = rows(rules.quality_rules(docs, labels))
    assert Counter(tuple(r)[:7] for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_trees_respect_order():
    rng = np.random.default_rng(3)
    x = rng.random((800, len(rules.FEATURES)))
    symbols = rules.FEATURES.index("symbols")
    y = (x[:, symbols] + 0.3 * rng.random(800) + 0.2 * np.sin(20 * x[:, symbols]) < 0.6).astype(float)
    trees = rules.grow(x, y, trees=20)
    line = np.repeat(x[:1], 50, axis=0)
    line[:, symbols] = np.linspace(0, 1, 50)
    assert (np.diff(trees.margin(line)) <= 1e-9).all() and ((trees.score(x) > 0.5) == y).mean() > 0.85


def test_machine_sum_of_squares():
    rng = np.random.default_rng(4)
    held = [quality.features("a few words here and there " * n) for n in range(1, 30)]
    machine = quality.fit(held, (rng.random(29) < 0.5).astype(float), epochs=2)
    for row, got in zip(held, machine.score(held)):
        x = np.concatenate((machine.inputs(np.array(row[0])), row[2]))
        v, w = np.concatenate((machine.factor[: quality.DENSE], machine.factor[quality.DENSE + row[1]])), np.concatenate((machine.weight[: quality.DENSE], machine.weight[quality.DENSE + row[1]]))
        pairs = sum(x[i] * x[j] * (v[i] @ v[j]) for i in range(len(x)) for j in range(i))
        assert got == pytest.approx(1 / (1 + math.exp(-(machine.bias + w @ x + pairs))), abs=1e-5)


def test_classifiers_hold_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, marks = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    for found, label, share in ((quality.quality_scores(docs, marks), "quality", 0.95), (toxicity.toxicity_scores(docs, marks), "toxic", 0.85)):
        held = rows(found.join(marks, "doc_id").filter("held_out").select("predicted", label))
        assert sum(r[0] == r[1] for r in held) >= share * len(held)


def test_classifiers_on_odd_rows(odd, labels):
    for found in (quality.quality_scores(odd, labels), toxicity.toxicity_scores(odd, labels), quality.quality_scores(odd, labels.limit(0)), toxicity.toxicity_scores(odd, labels.limit(0))):
        got = rows(found)
        assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert quality.keep_good(odd, labels.limit(0)).columns == odd.columns


def test_licenses(odd):
    got = {r.doc_id: r for r in rows(licenses.license_scan(odd))}
    assert got[11].license == "MIT" and got[11].spans == "MIT:0:0" and got[0].license is None
    shelf = licenses.Shelf(licenses.TEMPLATES)
    full = licenses.TEMPLATES[2][1]
    cut = full.split(" ")
    wrapped = "Code\n" + "\n".join(" ".join(cut[k : k + 8]) for k in range(0, len(cut), 8)) + "\nint main"
    assert [m[2] for m in shelf.scan(wrapped)] == ["MIT"]
    for text in (full, " ".join(cut[10:70]), "nothing of the kind is said in this line"):
        words = licenses.normal(text)
        every = [2 * sum((licenses.bigrams(words) & t.grams).values()) / (len(words) - 1 + t.size) for t in shelf.held]
        found = shelf.best(words)
        assert (found[0] if found else 0) == pytest.approx(max(every) if max(every) >= 0.8 else 0)


def test_licenses_inside_longer_units():
    shelf = licenses.Shelf(licenses.TEMPLATES)
    assert [m[2:] for m in shelf.scan("Some text first about ships. Licensed under the Apache License, Version 2.0.")] == [("Apache-2.0", 1.0)]
    prose = "\n".join(["the captain of the ship went to the port in the north and the crew", "for the night was the best of the year", "and the rest is said in the book"])
    cut = licenses.TEMPLATES[2][1].split(" ")
    wrapped = "\n".join(" ".join(cut[k : k + 8]) for k in range(0, len(cut), 8))
    assert [m[2:] for m in shelf.scan(f"{prose}\n{wrapped}\n{prose}")] == [("MIT", 1.0)]
    for name, text in licenses.TEMPLATES:
        assert [m[2:] for m in shelf.scan(f"Word. {text} Word.")] == [(name, 1.0)]
    assert shelf.scan(prose) == [] and shelf.scan("This project is licensed under the terms of the firm.") == []


def test_top_k_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    held = [(i, [float(x) for x in rng.normal(0, 1, 8)]) for i in range(400)]
    held += [(400 + i, held[7][1]) for i in range(120)] + [(600, None), (650, [1.0, None]), (700, [float("nan")] * 8), (750, [0.5, 0.25]), (800, []), (850, [float("inf")] * 8)]
    df = spark.createDataFrame(held, "vec_id long, embedding array<double>")
    good = {i: [math.floor(256 * x) for x in v] + [0] * (8 - len(v)) for i, v in held if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in good if i % 50 == 0):
        best = sorted(((-sum(a * b for a, b in zip(good[q], good[c])), c) for c in good if c != q))[:5]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    for chunk in (4096, 16):
        assert sorted(tuple(r) for r in rows(topk.top_k(df, pivots=6, chunk=chunk))) == sorted(want)
    assert rows(topk.top_k(df.limit(0))) == []
    assert len(rows(topk.top_k(df.filter("vec_id in (0, 3)")))) == 1


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 4)) * 10.0 ** rng.integers(0, 7, (300, 1))
    wholes = {i: [math.floor(256 * c) for c in v] for i, v in enumerate(x.tolist())}
    table = spark.createDataFrame([*enumerate(x.tolist()), (None, [1.0] * 4)], "vec_id long, embedding array<double>")
    want = []
    for q in range(0, 300, 50):
        scores = sorted((-sum(a * b for a, b in zip(wholes[q], v)), i) for i, v in wholes.items() if i != q)
        want += [(q, rank + 1, i, -score) for rank, (score, i) in enumerate(scores[:5])]
    assert sorted(tuple(r) for r in rows(topk.top_k(table, pivots=4, chunk=64))) == want
    # Products beyond 64 bits that cancel out stay exact; what does not fit ends with the row's name.
    big = np.array([[2.0**61, -(2.0**61), 3.0], [2.0**61, 2.0**61, 0.0]])
    assert topk._wide_products(np.array([[2.0**60, 2.0**60, 5.0]]), big).tolist() == [[15, topk._LONG]]
    with pytest.raises(OverflowError, match="vec_id 9"):
        topk.best_of(np.array([8, 9]), big, np.array([0]), np.array([[2.0**60, 2.0**60, 5.0]]), 1)
    with pytest.raises(Exception, match="vec_id 7: a component"):
        rows(topk.top_k(spark.createDataFrame([(7, [1e30]), (50, [1.0])], "vec_id long, embedding array<double>")))


def test_bpe_newer_letters_equal_library():
    whole, coder = tokenizer(WORD_BPE), bpe.encoder(tokenizer_path(WORD_BPE))
    odd = regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x110000)])))
    odd = [c for c in odd if unicodedata.category(c) == "Cn"]
    assert odd
    for c in odd:
        for text in (f"a{c}b", f"9{c}{c}!", f"{c} {c}x"):
            assert coder.encode_ids(text) == whole.encode(text, add_special_tokens=False).ids


def test_packing_long_white_space():
    whole, encode = tokenizer(BYTE_BPE), packing.byte_encoder(tokenizer_path(BYTE_BPE))
    wide = packing.LONG_SPACE
    texts = [" " * 1_000_000 + "a", "a" + "\t" * 1_000_000, "\n" * wide, "x" + " " * wide + "b" + " " * (wide - 1) + "c"]
    texts += [" \n" * wide + "<|endoftext|>" + " " * wide + " 's 7", "a" + "\u3000" * wide + "\x85" * 3 + "!" + " " * wide]
    for text in texts:
        assert encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_empty_tables(none, labels):
    path = tokenizer_path(BYTE_BPE)
    found = [bpe.bpe_digest(none, tokenizer_path(WORD_BPE)), packing.pack(none, path), simhash.near_duplicates(none), simhash.drop_near_duplicates(none), secrets.secret_scan(none), secrets.redact(none), quality.quality_scores(none, labels), toxicity.toxicity_scores(none, labels), rules.quality_rules(none, labels), licenses.license_scan(none), lm.corpus_scores(none, path)]
    assert [rows(f) for f in found] == [[]] * len(found)
