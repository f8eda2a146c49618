"""Session settings, lineage cuts and small bounded reads."""

from __future__ import annotations

import gc
import io
import os
import tempfile
import threading
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_SHIPPING = threading.Lock()


def build_session(app: str = "loanproof", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on; a cluster may pass its own."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is used only
    by a local session that names none: it would not be shared between machines.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    folder = folder or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="loanproof-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once a session, so their Python workers can import it.

    The archive is code for Spark's own file server, not data; executors fetch their copy from the driver.
    """
    with _SHIPPING:  # fits run from several threads
        _ship_once(spark.sparkContext)


def _ship_once(context) -> None:
    if getattr(context, "_loanproof_shipped", False):
        return
    root = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    target = os.path.join(tempfile.mkdtemp(prefix="loanproof-code-"), "loanproof_code.zip")
    Path(target).write_bytes(held.getvalue())
    context.addPyFile(target)
    context._loanproof_shipped = True


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder, so lost executors lose no rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def let_go(of: DataFrame | SparkSession) -> None:
    """Spark deletes shuffles and checkpoints whose objects are gone."""
    gc.collect()
    spark = of if isinstance(of, SparkSession) else of.sparkSession
    spark.sparkContext._jvm.System.gc()


def packed(df: DataFrame) -> DataFrame:
    """(data): the rows of each Arrow batch as one compressed record, in place and in order."""
    ship_package(df.sparkSession)
    return df.mapInArrow(_pack, "data binary")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            held = pa.BufferOutputStream()
            with pa.ipc.new_stream(held, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([held.getvalue().to_pybytes()], pa.binary())], names=["data"])


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of the rows again."""
    for batch in batches:
        for record in batch.column("data"):
            with pa.ipc.open_stream(record.as_buffer()) as held:
                yield from held


def materialize_packed(df: DataFrame) -> DataFrame:
    """``materialize`` for wide tables: the same rows in the same partitions, a fraction of the bytes on disk."""
    return materialize(packed(df)).mapInArrow(unpacked, df.schema)


def collect_bounded(df: DataFrame, limit: int, what: str) -> list:
    """Collect a table whose size has a known bound, and fail when the bound is broken."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows, too many for the driver")
    return rows


def small_table(spark: SparkSession, names: dict[str, str], rows: list[tuple]) -> DataFrame:
    """A table from a few driver values, as literals of the plan: its size is known to the planner."""

    def literal(value, kind: str) -> str:
        if value is None:
            return f"CAST(NULL AS {kind})"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"CAST('{value!r}' AS {kind})"

    if not rows:
        return spark.createDataFrame([], ", ".join(f"{n} {k}" for n, k in names.items()))
    kinds = list(names.values())
    values = ", ".join("(" + ", ".join(literal(v, k) for v, k in zip(row, kinds)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(f'`{n}`' for n in names)})")
