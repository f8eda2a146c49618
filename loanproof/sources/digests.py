"""SHA-256 of files of any size, in links of bounded reads.

A SHA-256 depends on the state after all bytes before, so a file is read in order; but not by one task.
A task reads on from the state that the last task left and hands over its own: 112 bytes, the public
``SHA256_CTX`` of the OpenSSL library that Python's ``hashlib`` is linked to. Files go on side by side.
"""

from __future__ import annotations

import _hashlib
import ctypes
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanproof.session import materialize, ship_package

#: Bytes that one task reads at most, and at once.
LINK = 256 << 20
_PIECE = 4 << 20
_STATE = 112
_COLUMNS = "path string, length long, at long, state binary"


@lru_cache(maxsize=1)
def _library() -> ctypes.CDLL:
    library = ctypes.CDLL(_hashlib.__file__)  # names resolve in the libraries it is linked to
    if not all(hasattr(library, f"SHA256_{x}") for x in ("Init", "Update", "Final")):
        raise RuntimeError("Python's hashlib is not linked to an OpenSSL library with SHA256_Init, SHA256_Update and SHA256_Final")
    library.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
    return library


def begun() -> bytes:
    """The state before the first byte."""
    held = ctypes.create_string_buffer(_STATE)
    _library().SHA256_Init(held)
    return held.raw


def added(state: bytes, pieces: Iterator[bytes]) -> bytes:
    """The state after more bytes."""
    held = ctypes.create_string_buffer(state, _STATE)
    for piece in pieces:
        _library().SHA256_Update(held, piece, len(piece))
    return held.raw


def ended(state: bytes) -> str:
    """The digest of a state, in lowercase hex."""
    held, digest = ctypes.create_string_buffer(state, _STATE), ctypes.create_string_buffer(32)
    _library().SHA256_Final(digest, held)
    return digest.raw.hex()


def stretch(path: str, at: int, size: int) -> Iterator[bytes]:
    """``size`` bytes of a file from place ``at``."""
    if path.startswith("file:"):
        system, path = pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        system, path = pyarrow.fs.FileSystem.from_uri(path)
    with system.open_input_file(path) as file:
        file.seek(at)
        while size:
            piece = file.read(min(size, _PIECE))
            if not piece:
                raise EOFError(f"{path} is shorter than when it was listed")
            size -= len(piece)
            yield piece


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of every file; no task reads more than ``LINK`` bytes."""
    ship_package(spark)
    link = LINK

    def go_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        room = link
        for batch in batches:
            rows = []
            for name, length, at, state in batch.itertuples(index=False):
                size = min(room, length - at)
                rows.append((name, length, at + size, added(state, stretch(name, at, size)) if size else state))
                room -= size
            yield pd.DataFrame(rows, columns=batch.columns)

    def end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "length": batch["length"], "sha256": [ended(s) for s in batch["state"]]})

    files = spark.read.format("binaryFile").load(path).select("path", "length")
    states = materialize(files.withColumn("at", F.lit(0).cast("bigint")).withColumn("state", F.lit(begun())))
    while left := states.filter("at < length").count():
        read = states.filter("at < length").coalesce(1).repartition(left).mapInPandas(go_on, _COLUMNS)  # a row is a file
        states = materialize(states.filter("at = length").coalesce(1).unionByName(read))
    return states.mapInPandas(end, "path string, length long, sha256 string")
