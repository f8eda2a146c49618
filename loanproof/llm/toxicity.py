"""Toxicity from class-conditional Kneser-Ney models.

Words (letters only, lower case) are spelled letter by letter between a start and an end sign.
From ``OWN`` letters on, the toxic and the ordinary class have discounted counts of their own.
Each order of a class backs off to the class's next lower order and, with the weight of
``PRIOR`` letters, to the same order over both classes, whose lower orders are Kneser-Ney
continuation counts. So the classes differ only where one has seen enough, and an inflection
never seen before is judged by its stem. A word counts once a document, a text once.

A document's evidence is the difference of the two log-likelihoods per distinct word: its mean
over the whole text, the mean of the strongest stretch of ``STRETCH`` words, the strongest
words, and the share of strong ones. A logistic curve, fitted on the quarter of the sample
that the counts do not see, turns them into a score.

Training takes at most ``max_rows`` labelled rows, those whose ids hash lowest; the driver gets
their texts. Scoring is one pass without a shuffle; the model goes out once per executor and
its size is bound by the sample.

Defined cases: texts without words have no evidence; labels of one class, or none, give every
document the smoothed share of label 1; repeated rows give repeated results; an empty table
gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import regex
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanproof.llm.common import Memo
from loanproof.llm.quality import keep_rows, labelled_sample, score_texts

FOLDS = 4
HELD_OUT = 2
THRESHOLD = 0.3
MAX_ROWS = 6_000
ORDER = 6
OWN = 4
DISCOUNT = 0.75
PRIOR = 20.0
STRETCH = 16
STRONG = 2.0
#: Stretches of letters beyond this length are spelled in parts.
SPELLED = 48
#: Entries each worker remembers; a window costs some 20 times a word's sum over known windows.
WINDOWS = 600_000
WORDS = 300_000
_WORDS = regex.compile(r"\p{L}+")
_LETTERS = bytes(b if chr(b).isalpha() else 32 for b in bytes(range(128)).lower()) + bytes([32]) * 128


def words_of(text: str) -> list[str]:
    """The distinct words of a text in order of their first use."""
    if text.isascii():
        return list(dict.fromkeys(text.encode().translate(_LETTERS).decode().split()))
    return list(dict.fromkeys(_WORDS.findall(text.lower())))


def spell(word: str) -> list[str]:
    return ["^^" + word[k : k + SPELLED] + "$" for k in range(0, len(word), SPELLED)]


class TwoModels:
    """Both classes' models; ``evidence`` of words is log P(toxic) - log P(ordinary), memoised in bounded space."""

    def __init__(self, counts: Iterable[tuple[str, int, int]]):
        grams: dict[str, list[int]] = {}
        for word, ordinary, toxic in counts:
            for spelled in spell(word):
                for size in range(2, ORDER + 1):
                    for start in range(max(0, 3 - size), len(spelled) - size + 1):
                        held = grams.setdefault(spelled[start : start + size], [0, 0])
                        held[0] += ordinary
                        held[1] += toxic
        # A context: count per class, kinds of letters behind it per class and in all.
        contexts: dict[str, list[int]] = {}
        for gram, (ordinary, toxic) in grams.items():
            held = contexts.setdefault(gram[:-1], [0, 0, 0, 0, 0])
            held[0] += ordinary
            held[1] += toxic
            held[2] += ordinary > 0
            held[3] += toxic > 0
            held[4] += 1
        # Kneser-Ney continuation counts: in how many contexts a shorter gram was seen.
        follows = Counter(gram[1:] for gram in grams if len(gram) > 2)
        rooms: dict[str, list[int]] = {}
        for gram, kinds in follows.items():
            held = rooms.setdefault(gram[:-1], [0, 0])
            held[0] += kinds
            held[1] += 1
        self.grams, self.contexts, self.follows, self.rooms = grams, contexts, follows, rooms
        self.letters = Counter(gram[-1] for gram in grams if len(gram) == 2)
        self.total = sum(self.letters.values())
        self.windows, self.words = Memo(self.ratio, WINDOWS), Memo(self.spelled, WORDS)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("windows", "words")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.windows, self.words = Memo(self.ratio, WINDOWS), Memo(self.spelled, WORDS)

    def ratio(self, window: str) -> float:
        """log P(toxic) - log P(ordinary) of the last letter of a window behind the letters before it."""
        lower = (self.letters.get(window[-1], 0) + 0.5) / (self.total + 0.5 * (len(self.letters) + 1))
        chance = [lower, lower]
        for size in range(2, len(window) + 1):
            gram = window[-size:]
            context = self.contexts.get(gram[:-1])
            if context is None:
                break
            seen = self.grams.get(gram, (0, 0))
            pooled = (max(seen[0] + seen[1] - DISCOUNT, 0) + DISCOUNT * context[4] * lower) / (context[0] + context[1])
            for c in (0, 1):
                if size < OWN:
                    chance[c] = pooled
                else:
                    own = max(seen[c] - DISCOUNT, 0) + DISCOUNT * context[2 + c] * chance[c]
                    chance[c] = (own + PRIOR * pooled) / (context[c] + PRIOR)
            room = self.rooms.get(gram[:-1])
            lower = (max(self.follows.get(gram, 0) - DISCOUNT, 0) + DISCOUNT * room[1] * lower) / room[0] if room else pooled
        return math.log(chance[1] / chance[0])

    def spelled(self, word: str) -> float:
        known = self.windows
        return sum([known[s[end - ORDER if end > ORDER else 0 : end]] for s in spell(word) for end in range(3, len(s) + 1)])

    def evidence(self, words: list[str]) -> np.ndarray:
        known = self.words
        return np.array([known[w] for w in words])


def inputs(evidence: np.ndarray) -> list[float]:
    """Mean, strongest stretch, log of the number of words, strongest five, share of strong ones."""
    if not len(evidence):
        return [0.0] * 5
    width = min(STRETCH, len(evidence))
    sums = np.concatenate(([0.0], np.cumsum(evidence)))
    strongest = np.clip(np.sort(evidence)[::-1][:5], 0, 6).sum() / 5
    strong = int((evidence > STRONG).sum()) / math.sqrt(len(evidence))
    return [float(evidence.mean()), float((sums[width:] - sums[:-width]).max()) / STRETCH, math.log(len(evidence)), float(strongest), strong]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Newton steps for a ridge-penalised logistic curve; the intercept comes last and is free."""
    x = np.column_stack((x, np.ones(len(x))))
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        size = float(np.abs(step).max())
        beta += step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return beta


class Scorer:
    """Texts to scores; the models come with a broadcast, once per executor."""

    def __init__(self, context: SparkContext, models: TwoModels, beta: np.ndarray):
        self.models, self.beta = context.broadcast(models), beta

    def __call__(self, found: list[str]) -> np.ndarray:
        evidence = self.models.value.evidence
        x = np.array([inputs(evidence(words_of(t))) for t in found]).reshape(len(found), 5)
        return 1 / (1 + np.exp(-np.clip(x @ self.beta[:-1] + self.beta[-1], -30, 30)))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Callable[[list[str]], np.ndarray]:
    """A function from texts to scores."""
    sample = labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, max_rows)
    # A quarter of the sample, by another hash, fits the curve; the rest gives the counts.
    got = sample.select("text", "label", "doc_id", (F.pmod(F.xxhash64("doc_id", F.lit("curve")), F.lit(4)) == 0).alias("curve")).toArrow().sort_by("doc_id")
    label = got["label"].to_numpy().astype(int)
    curve = np.array(got["curve"].to_pylist(), dtype=bool)
    flat = (float(label.sum()) + 1) / (len(label) + 2) if len(label) else 0.5
    if any(len(set(label[part].tolist())) < 2 for part in (curve, ~curve)):
        return lambda found: np.full(len(found), flat)
    counts, held, used = (Counter(), Counter()), [], set()
    for text, y, checks in zip(got["text"], label, curve):
        text = text.as_py()
        if checks:
            held.append((text, y))
        elif text not in used:
            used.add(text)
            counts[y].update(words_of(text))
    models = TwoModels((w, counts[0][w], counts[1][w]) for w in counts[0].keys() | counts[1].keys())
    x = np.array([inputs(models.evidence(words_of(t))) for t, _ in held])
    beta = logistic(x, np.array([y for _, y in held], dtype=float))
    return Scorer(docs.sparkSession.sparkContext, models, beta)


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    return score_texts(docs, train(docs, labels, max_rows), FOLDS, HELD_OUT, THRESHOLD)


def keep_civil(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents not predicted as toxic, with all their columns."""
    scorer = train(docs, labels, max_rows)
    return keep_rows(docs, lambda found: (scorer(found) < THRESHOLD).tolist())
