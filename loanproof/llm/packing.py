"""Packing documents into training sequences with a bounded number of open windows.

Each partition keeps ``OPEN`` windows. Whole windows of a long document go out directly; the
rest of a document goes to the open window that it fills best. When it fits in none and no
window may be opened, the fullest window is topped up with the head of the rest and goes out
full, so nothing is padded. What is left open at a partition's end is merged by groups of
``GROUP`` partitions: pieces in order, cut at the window size, the last stretch cut into powers
of two, which need no padding either. A group holds at most GROUP x OPEN windows, whatever the
size of the table.

Defined cases: a null or empty text is the closing id alone; repeated rows are packed as often
as they occur; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanproof.llm.bpe import byte_letters
from loanproof.llm.common import texts
from loanproof.session import materialize

WINDOW = 1024
OPEN = 16
GROUP = 16
CLOSING = 0
#: How byte-level vocabularies of this kind cut words (fixed by the file's pre-tokenizer).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space longer than this is cut off before the pattern runs: its lookahead keeps a stack entry per character.
LONG_SPACE = 4_096
PIECE_COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part", "ids"]


@lru_cache(maxsize=2)
def byte_encoder(path: str):
    """Text to ids of a byte-level BPE file; strings of special tokens become their ids."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if all(c in byte_of for c in token)}
    special = {a["content"]: a["id"] for a in spec["added_tokens"]}
    for content in special:
        ranks.pop(content.encode(), None)
    encoding = tiktoken.Encoding("byte-level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    one_piece = tiktoken.Encoding("byte-level-piece", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    spaces = regex.compile(r"\s{%d,}" % LONG_SPACE)

    def plain(text: str) -> np.ndarray:
        parts, at = [], 0
        for run in spaces.finditer(text):
            # The pattern takes such a run as one piece, but for its last character if more text follows.
            end = run.end() if run.end() == len(text) else run.end() - 1
            parts.append(encoding.encode_to_numpy(text[at : run.start()], disallowed_special=()))
            parts.append(one_piece.encode_to_numpy(text[run.start() : end], disallowed_special=()))
            at = end
        last = encoding.encode_to_numpy(text[at:], disallowed_special=())
        return np.concatenate([*parts, last]) if parts else last

    def encode(text: str) -> np.ndarray:
        if cut is None or not any(s in text for s in special):
            return plain(text)
        return np.concatenate([np.array([special[p]], dtype=np.uint32) if p in special else plain(p) for p in cut.split(text)])

    encode.ordinary = encoding.encode_ordinary  # for short strings, special ones as plain text
    return encode


def digest(ids: np.ndarray) -> int:
    """crc32 of little-endian unsigned 32-bit ids."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


class Packer:
    """Open windows of one partition; ``out`` gets finished pieces."""

    def __init__(self, first_sequence: int, window: int = WINDOW, limit: int = OPEN):
        self.next, self.window, self.limit = first_sequence, window, limit
        self.open: list[tuple[list, int]] = []  # pieces, fill
        self.out: list[tuple] = []

    def emit(self, pieces: list) -> None:
        at = 0
        for doc_id, start, ids, total in pieces:
            self.out.append((doc_id, start, len(ids), digest(ids), total, self.next, at, None, None))
            at += len(ids)
        self.next += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.window:
            self.emit([(doc_id, start, ids[start : start + self.window], total)])
            start += self.window
        while start < total:
            need = total - start
            fits = [(self.window - fill, k) for k, (_, fill) in enumerate(self.open) if fill + need <= self.window]
            if fits:
                _, k = min(fits)
            elif len(self.open) < self.limit:
                k = len(self.open)
                self.open.append(([], 0))
            else:
                k = max(range(len(self.open)), key=lambda i: (self.open[i][1], -i))
            pieces, fill = self.open[k]
            take = min(need, self.window - fill)
            pieces.append((doc_id, start, ids[start : start + take].copy(), total))  # a view would hold the whole document
            start += take
            if fill + take == self.window:
                self.emit(pieces)
                del self.open[k]
            else:
                self.open[k] = (pieces, fill + take)


def merge_rest(pieces: list[tuple], first_sequence: int, window: int = WINDOW) -> list[tuple]:
    """Leftover pieces (doc_id, start, ids, total), laid end to end and cut into full windows and powers of two."""
    packer = Packer(first_sequence, window)
    total = sum(len(p[2]) for p in pieces)
    sizes = [window] * (total // window) + [1 << k for k in range(window.bit_length(), -1, -1) if (total % window) >> k & 1]
    current: list[tuple] = []
    room = 0
    cuts = iter(sizes)
    for doc_id, start, ids, all_tokens in pieces:
        at = 0
        while at < len(ids):
            if not room:
                room = next(cuts)
            take = min(room, len(ids) - at)
            current.append((doc_id, start + at, ids[at : at + take], all_tokens))
            at, room = at + take, room - take
            if not room:
                packer.emit(current)
                current = []
    return packer.out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 8 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=_NAMES)


def pack(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece, as ``PIECE_COLUMNS`` says; sequences are full or a power of two long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, packer = byte_encoder(path), Packer(part << 36)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                packer.add(doc_id, np.append(encode(text), np.uint32(CLOSING)))
            yield _batch(packer.out)
            packer.out = []
        rest = []
        for window, (pieces, _) in enumerate(packer.open):
            for at, (doc_id, start, ids, total) in enumerate(pieces):
                rest.append((doc_id, start, len(ids), None, total, window, at, part, np.ascontiguousarray(ids, dtype="<u4").tobytes()))
        if rest:
            yield _batch(rest)

    def finish(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "sequence_id", "offset"], kind="stable")
        ids = [None if missing else int(i) for i, missing in zip(group["doc_id"], group["doc_id"].isna())]
        pieces = [(i, int(s), np.frombuffer(b, dtype="<u4"), int(t)) for i, s, b, t in zip(ids, group["start"], group["ids"], group["doc_tokens"])]
        rows = merge_rest(pieces, (1 << 62) | (int(key[0]) << 36))
        frame = pd.DataFrame([r[:7] for r in rows], columns=_NAMES[:7])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame

    packed = materialize(texts(docs).mapInArrow(run, PIECE_COLUMNS + ", part long, ids binary"))
    done = packed.filter("ids IS NULL").drop("part", "ids")
    rest = packed.filter("ids IS NOT NULL").withColumn("crew", F.expr(f"part div {GROUP}"))
    return done.unionByName(rest.groupBy("crew").applyInPandas(finish, PIECE_COLUMNS))
