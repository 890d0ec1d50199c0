"""Token ids in packed binary rows.

Each task tokenizes its documents, gathers pieces of up to ``buffer`` tokens and packs them
best-fit-decreasing: a segment tree over remaining capacities finds the fullest row that
still holds a piece. Documents longer than a row are split without loss. No ids are
shuffled, and a task's memory is bounded by its buffer; a lost task is packed anew.

A row holds ``capacity`` ids (unused places hold ``pad_id``), the cumulative segment
lengths, and for each segment the position at which it starts within its document: 0 where
position ids reset to the beginning of a document, more for the later pieces of a split one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.llm.common import lean, ship, short_batches, text_slices
from drover.llm.tokens import CALL_BYTES, CALL_ROWS, tokens

CAPACITY = 2048
#: Tokens that a task packs together.
BUFFER = 4 << 20

SCHEMA = ("ids binary, n_tokens int, segment_ends array<int>, position_starts array<long>, "
          "doc_ids array<long>, pieces array<int>")
_ARROW = pa.schema([("ids", pa.binary()), ("n_tokens", pa.int32()), ("segment_ends", pa.list_(pa.int32())),
                    ("position_starts", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int32()))])


class CapacityTree:
    """Rows by remaining capacity; ``smallest(n)`` finds the least remaining capacity of at
    least n in a number of steps that is logarithmic in the capacity."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, leaf: int, d: int) -> None:
        k = leaf + self.size
        while k:
            self.count[k] += d
            k >>= 1

    def put(self, remaining: int, row: int) -> None:
        self.rows[remaining].append(row)
        self._add(remaining, 1)

    def take(self, remaining: int) -> int:
        self._add(remaining, -1)
        return self.rows[remaining].pop()

    def smallest(self, n: int) -> int | None:
        k = n + self.size
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.size:
                k = 2 * k if self.count[2 * k] else 2 * k + 1
        return k - self.size


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """Row number of each piece; pieces of equal length in the order given."""
    tree, row_of, rows = CapacityTree(capacity), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.smallest(lengths[i])
        if room is None:
            room, row = capacity, rows
            rows += 1
        else:
            row = tree.take(room)
        row_of[i] = row
        if room > lengths[i]:
            tree.put(room - lengths[i], row)
    return row_of


def _rows(units: list[tuple], capacity: int, pad_id: int, dtype: str) -> Iterator[pa.RecordBatch]:
    """``units``: (doc_id, piece, position in the document, ids)."""
    row_of = best_fit_decreasing([len(u[3]) for u in units], capacity)
    rows: list[list[tuple]] = [[] for _ in range(max(row_of, default=-1) + 1)]
    for u, r in zip(units, row_of, strict=True):
        rows[r].append(u)
    for i in range(0, len(rows), 256):
        part = rows[i:i + 256]
        matrix = np.full((len(part), capacity), pad_id, dtype)
        ends = []
        for k, row in enumerate(part):
            ends.append(np.cumsum([len(u[3]) for u in row]).tolist())
            matrix[k, :ends[-1][-1]] = np.concatenate([u[3] for u in row])
        yield pa.RecordBatch.from_arrays([
            pa.array([m.tobytes() for m in matrix], pa.binary()), pa.array([e[-1] for e in ends], pa.int32()),
            pa.array(ends, pa.list_(pa.int32())),
            *(pa.array([[u[j] for u in row] for row in part], t) for j, t in (
                (2, pa.list_(pa.int64())), (0, pa.list_(pa.int64())), (1, pa.list_(pa.int32()))))], schema=_ARROW)


def _pack(path: str, capacity: int, end_id: int, pad_id: int, dtype: str, buffer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, units, held = tokens(path), [], 0
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for row, data, off in text_slices(b.column("text"), CALL_BYTES):
                for i, enc in enumerate(tok.encode([data[a:z].tobytes().decode() for a, z in zip(off, off[1:], strict=False)])):
                    own = np.append(np.frombuffer(enc, "<u4"), np.uint32(end_id)).astype(dtype)
                    for k, s in enumerate(range(0, len(own), capacity)):
                        units.append((ids[row + i], k, s, own[s:s + capacity]))
                    held += len(own)
                    if held >= buffer:
                        yield from _rows(units, capacity, pad_id, dtype)
                        units, held = [], 0
        if units:
            yield from _rows(units, capacity, pad_id, dtype)
    return run


def packed_rows(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, pad_id: int = 0,
                dtype: str = "<u2", buffer: int = BUFFER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per packed sequence (SCHEMA); ``ids`` are ``capacity`` numbers of ``dtype``.

    Defined cases: a null or empty text is the end id alone; a null id stays null in
    doc_ids; repeated rows are packed as often as they occur; equal lengths keep the order
    of their task; an empty table gives an empty result; only the two named columns are
    read. ``dtype`` must hold every id of the tokenizer.
    """
    spark = ship(docs.sparkSession)
    top = max(tokens(tokenizer).whole.get_vocab().values())
    if max(top, end_id, pad_id) > np.iinfo(np.dtype(dtype)).max:
        raise ValueError(f"{dtype} cannot hold the id {top}")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        lean(_pack(tokenizer, capacity, end_id, pad_id, dtype, buffer)), SCHEMA)


def write_packed(rows: DataFrame, path: str) -> None:
    with short_batches(rows.sparkSession, CALL_ROWS):
        rows.write.mode("errorifexists").parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """Written rows with ``cu_seqlens`` (0 and the segment ends) for attention kernels."""
    return spark.read.schema(SCHEMA).parquet(path).withColumn("cu_seqlens", F.concat(F.array(F.lit(0)), "segment_ends"))


def segments(rows: DataFrame) -> DataFrame:
    """(doc_id, piece, start, length, offset, ids_crc32 of the row) per segment of written rows."""
    return rows.select(F.crc32("ids").alias("row_crc32"), "n_tokens", F.posexplode(F.arrays_zip(
        "doc_ids", "pieces", "position_starts", "segment_ends", F.slice("cu_seqlens", F.lit(1), F.size("segment_ends")).alias("offsets")))).select(
        F.col("col.doc_ids").alias("doc_id"), F.col("col.pieces").alias("piece"), F.col("col.position_starts").alias("start"),
        (F.col("col.segment_ends") - F.col("col.offsets")).cast("long").alias("length"),
        F.col("col.offsets").cast("long").alias("offset"), "row_crc32", F.col("n_tokens").cast("long").alias("row_tokens"))
