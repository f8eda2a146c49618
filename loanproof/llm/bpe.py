"""BPE encoding and decoding by dynamic programming over prefixes.

Every prefix of a word has one last token in its BPE encoding. An automaton over the
vocabulary lists, for each position, the tokens that end there (suffixes of the prefix,
longest first). A token is the last one exactly if it may stand behind the last token of
the prefix before it; that pair test undoes the merges on both sides of the border, the
latest first, and looks for a merge across the border that would have come earlier.
Back-pointers from the end of the word then give the ids, without running any merge queue.

Words repeat, so a worker keeps a bounded memo from word to ids. Documents stay where they
are: no shuffle.

Defined cases: null and empty texts give no ids (0 tokens, hashes of the empty string);
strings of special tokens in a text become their ids, as the library does by default;
repeated rows give repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers, pre_tokenizers

from loanproof.llm.common import Memo, texts

#: Stands for the end of a word inside the automaton: no byte maps to it.
END = "\ue000"
#: How this vocabulary cuts words (fixed by the file): contractions, letters, one digit, other signs.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
#: The same with the characters of the class ``%s`` counted as other signs.
WORDS_BUT = r"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{L}--%s]+|[\p{N}--%s]|(?:[^\p{White_Space}\p{L}\p{N}]|%s)+"


@lru_cache(maxsize=1)
def newer_letters() -> str:
    """A character class of the letters and numbers that the public library's older Unicode tables do not have.

    Only code points unassigned in Python's tables can differ; the library's own pattern engine is asked about them.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    found = []
    for kind in (r"\p{L}", r"\p{N}"):
        asked = [c for c in regex.findall(kind, every) if unicodedata.category(c) == "Cn"]
        pieces = pre_tokenizers.Split(Regex(kind), "isolated").pre_tokenize_str("\n".join(asked))
        known = {c for c, _ in pieces if len(c) == 1}
        # Unknown ones stay glued to the line ends around them.
        found += [ord(c) for c in asked if c not in known]
    ranges: list[list[int]] = []
    for c in sorted(found):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]" if ranges else ""


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    spare = 0
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + spare)
            spare += 1
    return [letters[b] for b in range(256)]


@lru_cache(maxsize=1)
def newer_capitals() -> dict[int, str]:
    """Lower case of the capitals that the public library knows and Python's tables do not, asked of its normalizer."""
    unknown = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x110000)] if unicodedata.category(chr(c)) == "Cn"]
    lower = normalizers.Lowercase().normalize_str("\n".join(unknown)).split("\n")
    return {ord(c): small for c, small in zip(unknown, lower) if c != small}


class WordBpe:
    """Encoder and decoder of a BPE file with word ends, lower case and dropped white space."""

    def __init__(self, path: str, memo: int = 400_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.letters = byte_letters()
        self.join: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            whole = vocab[left + right]
            pair = (vocab[left], vocab[right])
            self.join[pair] = rank
            self.parts.setdefault(whole, (rank, *pair))
        self.automaton = ahocorasick.Automaton()
        for token, number in vocab.items():
            form = token[: -len(suffix)] + END if token.endswith(suffix) else token
            if form and form != END and (number in self.parts or len(form.rstrip(END)) == 1):
                self.automaton.add_word(form, (number, len(form)))
        self.automaton.make_automaton()
        self.fits = lru_cache(maxsize=1 << 18)(self._fits)
        self.memo = Memo(self._word, memo)
        self.words = regex.compile(WORDS)
        self.capitals = newer_capitals()
        self.capital = regex.compile("[" + "".join(map(chr, self.capitals)) + "]") if self.capitals else None
        newer = newer_letters()
        self.newer = regex.compile(newer) if newer else None
        self.words_but = regex.compile(WORDS_BUT.replace("%s", newer)) if newer else self.words

    def _fits(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border between two neighbouring tokens."""
        before = float("inf")  # merges across the border of a rank below this would have come first
        while True:
            if self.join.get((left, right), before) < before:
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is None and b is None:
                return True
            # Undo the later merge; of two equal ones the right one, as merges of a rank go from the left.
            if b is None or (a is not None and a[0] > b[0]):
                before, left = a[0], a[2]
            else:
                before, right = b[0] + 1, b[1]

    def _word(self, word: str) -> tuple[str, str]:
        """Ids and tokens of one word, each joined by spaces."""
        letters = "".join([self.letters[b] for b in word.encode("utf-8", "surrogatepass")]) + END
        size = len(letters)
        last: list[tuple[int, int] | None] = [None] * (size + 1)  # per prefix: last token, where it starts
        endings: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for at, (number, length) in self.automaton.iter(letters):
            endings[at].append((number, length))
        for at in range(size):
            if at == size - 2:
                continue  # the last letter only stands together with the word's end
            for number, length in endings[at]:
                start = at + 1 - length
                if start == 0 or (last[start] is not None and self.fits(last[start][0], number)):
                    last[at + 1] = (number, start)
                    break
        ids = []
        at = size
        while at:
            if last[at] is None:
                raise ValueError(f"the vocabulary has no token for a letter of {word!r}")
            number, at = last[at]
            ids.append(number)
        ids.reverse()
        return " ".join(map(str, ids)), " ".join([self.tokens[i] for i in ids])

    def _plain(self, text: str) -> list[tuple[str, str]]:
        words = self.words
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            if self.newer is not None and self.newer.search(text):
                words = self.words_but
            if self.capital is not None and self.capital.search(text):
                text = text.translate(self.capitals)
        memo = self.memo
        return [memo[w] for w in words.findall(text.lower())]

    def encode(self, text: str) -> tuple[str, str]:
        """Decimal ids of a whole text and its decoded text, both joined by one space."""
        if self.special_re is not None and any(s in text for s in self.special):
            found = []
            for part in self.special_re.split(text):
                found += [(str(self.special[part]), part)] if part in self.special else self._plain(part)
        else:
            found = self._plain(text)
        return " ".join([f[0] for f in found]), " ".join([f[1] for f in found])

    def encode_ids(self, text: str) -> list[int]:
        return [int(i) for i in self.encode(text)[0].split()]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the file names no decoder, so tokens are joined by spaces."""
        return " ".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordBpe:
    """One encoder a worker and file."""
    return WordBpe(path)


def bpe_encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (decimal, joined by spaces) and decoded text of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            pairs = [bpe.encode(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    return texts(docs).mapInArrow(run, "doc_id long, ids string, decoded string")


def bpe_digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256; ids and texts do not leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                ids, decoded = bpe.encode(text)
                rows.append((ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
            columns = [batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
