"""Shared helpers: scratch tables, size-checked joins, columns with safe names, text buffers."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.session import scratch_path

#: A side of a join is broadcast only if its payload, measured after it was written, is
#: at most this many bytes; a larger one takes Spark's shuffled join.
BROADCAST_BYTES = 24 << 20
#: Text is worked on in slices of about this many bytes, so the arrays of one slice stay small.
SLICE_BYTES = 1 << 20
#: A null document id counts as the smallest id in every rule that orders documents.
NULL_ID = -(2 ** 63)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package's modules (once per application), so that workers
    need no installed copy."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="drover-code-"), "drover_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        sc.addPyFile(path)
        _shipped.add(sc.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts the lineage, and a
    lost executor costs a reread, not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def buckets(spark: SparkSession) -> int:
    """Number of hash buckets of an exchange: the session's shuffle partitions, so that it
    grows with the cluster settings the user chose for the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def sized(df: DataFrame, payload: str) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if its binary ``payload`` column and
    its row headers are proven to be under BROADCAST_BYTES, else unchanged."""
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(payload)), F.lit(0))).first()
    return F.broadcast(df) if size + 48 * n <= BROADCAST_BYTES else df


def narrow(df: DataFrame, row_bytes: int = 64) -> DataFrame:
    """``df`` (a written table of a few numbers a row) with a broadcast hint if its counted
    rows are proven to be under BROADCAST_BYTES, else unchanged."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def doc_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key_id, key_digest, text): the id (null: NULL_ID) and a 32-bit digest of the text
    that tells rows apart which share an id."""
    ship(df.sparkSession)
    return df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("key_id"),
        F.xxhash64(text_col).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("key_digest"),
        F.col(text_col).alias("text"))


# ------------------------------------------------------------------ workers' memory
#: Rows of an Arrow batch of whole texts; JVM and worker hold several of its copies.
TEXT_ROWS = 2_000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def short_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> Iterator[None]:
    """While a job over whole texts runs, its Arrow batches have at most ``rows`` rows."""
    old = spark.conf.get(_ROWS)
    if not 0 < int(old) <= rows:            # 0 or less: no limit
        spark.conf.set(_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_ROWS, old)


def give_back() -> None:
    """Return freed memory to the system; the allocators would keep it for the process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc's
    if trim is not None:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``task`` of a mapInArrow whose worker holds, once it is through, what it still needs:
    a worker waits for its next task beside the JVM, and its peak must not wait with it."""
    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()
    return run


def lean_group(task: Callable[[pa.Table], pa.Table]):
    """The same for a group of applyInArrow."""
    @functools.wraps(task)
    def run(t: pa.Table) -> pa.Table:
        try:
            return task(t)
        finally:
            give_back()
    return run


# ------------------------------------------------------------------ text buffers
def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    n = len(col)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def text_slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) over runs of rows of at most ``limit`` bytes (or one row)."""
    data, off = text_buffer(col)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def as_binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())
