"""Counts over one whole text, shared by the quality operators. White space is space and 0x09-0x0D."""

from __future__ import annotations

import math
from collections import Counter
from operator import eq

import numpy as np

WINDOW = 5
_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_DIGITS = b"0123456789"
_STOPS = b".,;:?"


def _count(raw: bytes, chosen: bytes) -> int:
    return len(raw) - len(raw.translate(None, chosen))


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words covered by windows of ``width`` words that occur twice or more, the first one included."""
    size = len(words) - width + 1
    if size < 2:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    windows = [joined[i:j] for i, j in zip(starts[:size].tolist(), ends[width - 1 :].tolist())]
    counts = Counter(windows)
    if len(counts) == size:
        return 0
    hit = np.fromiter((counts[w] > 1 for w in windows), dtype=np.int64, count=size)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    cover[:size] += hit
    cover[width:] -= hit
    return int((np.cumsum(cover)[:-1] > 0).sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACE)]
    return len(lines) - len(set(lines))


def base_counts(text: str) -> tuple[bytes, list[bytes], tuple[int, int, int, int, int]]:
    """The text in UTF-8, its words, and (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    return raw, words, (len(words), len(text) - _count(raw, _SPACE), _count(raw, _SYMBOLS), duplicate_lines(raw), repeat_words(words))


#: Statistics per document, in this order.
STATS = ["log_words", "word_length", "symbols", "upper", "digits", "bangs", "pipes", "stops", "lines", "distinct", "stutter", "top_share", "letters", "dup_lines"]


def structure(text: str, raw: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """The statistics of ``STATS``; all finite, also for texts without words."""
    n = max(1, len(words))
    size = max(1, len(raw))
    letters = _count(raw, _LETTERS)
    lines = raw.count(b"\n") + 1
    return [
        math.log1p(len(words)),
        math.log1p((len(text) - _count(raw, _SPACE)) / n),
        _count(raw, _SYMBOLS) / size,
        _count(raw, _UPPER) / max(1, letters),
        _count(raw, _DIGITS) / size,
        raw.count(b"!") / n,
        raw.count(b"|") / n,
        _count(raw, _STOPS) / n,
        lines / n,
        len(counts) / n,
        sum(map(eq, words, words[1:])) / n,
        (max(counts.values()) if counts else 0) / n,
        letters / size,
        duplicate_lines(raw) / lines,
    ]
