"""Bulk-synchronous best-fit packing of documents into sequences.

State: items not yet placed (a length each) and sequences with a gap. One round:

1. items and gaps are ordered together by size (at equal size items first) and swept
   towards larger sizes: each gap takes the largest item below it that no smaller gap has
   taken. In the sweep an item opens a bracket and a gap closes one; an item and the gap
   that takes it are the neighbours of one bracket level. Levels come from the counts of
   each size class, so the sweep is a window over levels, distributed and without skew
   (a level meets a size class at most once);
2. conflicts do not arise between levels; equal sizes are told apart by rank;
3. gaps shrink by what they took;
4. of the items left over, the largest open new sequences: as many as the tokens that the
   gaps cannot hold.

Rounds repeat until nothing is left. Items above half the capacity all open a sequence in
the first round, as no two of them fit together.

The driver sees the counts per size class only: at most 2 x capacity x SALTS numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from drover.llm.common import lean, ship, short_batches, text_slices, written
from drover.llm.tokens import CALL_BYTES, CALL_ROWS, tokens

CAPACITY = 2048
#: A size class is ranked in this many parts.
SALTS = 16


def _pieces(path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens(path)
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for row, data, off in text_slices(b.column("text"), CALL_BYTES):
                for i, enc in enumerate(tok.encode([data[a:z].tobytes().decode() for a, z in zip(off, off[1:], strict=False)])):
                    enc += end
                    n = len(enc) // 4
                    rows.extend((ids[row + i], k, s, min(capacity, n - s), zlib.crc32(enc[4 * s:4 * (s + capacity)]))
                                for k, s in enumerate(range(0, n, capacity)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows, strict=True) if rows else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and ``end_id`` after
    them, cut into pieces of ``capacity`` (the last may be shorter)."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        lean(_pieces(tokenizer, capacity, end_id)), "doc_id long, piece int, start long, length long, ids_crc32 long")


def _bundles(width: int):
    """Short items go in bundles of about ``width`` tokens, so that a sequence is made of a
    bounded number of items and rounds stay few."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            unit, length = b.column("unit").to_numpy(), b.column("length").to_numpy()
            before = np.cumsum(length) - length
            number = before // width
            new = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
            first = np.repeat(new, np.diff(np.append(new, len(unit))))
            yield pa.RecordBatch.from_arrays([pa.array(unit), pa.array(length), pa.array(unit[first]), pa.array(before - before[first])],
                                             names=["unit", "length", "item", "at"])
    return run


def _sweep(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class totals (size x [items, gaps]) -> (level below each class, items left over of
    each class, gaps of each class afterwards): the sweep on counts."""
    level = np.concatenate(([0], np.cumsum(counts[:, 0] - counts[:, 1])))[:-1]
    left, gaps_after = np.zeros(len(counts), np.int64), counts[:, 1].copy()
    stack: list[list[int]] = []
    for s in range(len(counts)):
        items, gaps = int(counts[s, 0]), int(counts[s, 1])
        if items:
            stack.append([s, items])
        while gaps and stack:
            take = min(gaps, stack[-1][1])
            gaps -= take
            stack[-1][1] -= take
            gaps_after[s] -= take
            gaps_after[s - stack[-1][0]] += take
            if not stack[-1][1]:
                stack.pop()
    for s, n in stack:
        left[s] = n
    return level, left, gaps_after


def _to_open(left: np.ndarray, gaps: np.ndarray, capacity: int, partial: bool) -> np.ndarray:
    """How many of the items left over of each class open a sequence: as many as the tokens
    that the gaps cannot hold. Gaps below the smallest item hold nothing, but in a
    ``partial`` packing they do: its items can be taken apart."""
    size = np.arange(len(left))
    need = int((left * size).sum())
    if not need:
        return np.zeros_like(left)
    usable = int((gaps * size)[0 if partial else np.flatnonzero(left)[0]:].sum())
    want = max(0, -(-(need - usable) // capacity), int(left[capacity // 2 + 1:].sum()))
    above = np.cumsum(left[::-1])[::-1] - left       # items of larger classes
    return np.clip(want - above, 0, left)


def _rounds(items: DataFrame, gaps: DataFrame, capacity: int, partial: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pack ``items`` (size, id) into ``gaps`` (size, id) and new sequences: (item,
    sequence_id, offset), the gaps afterwards and, if ``partial``, the items that no gap can
    take and whose tokens the gaps could hold."""
    spark = items.sparkSession
    state = items.select("size", F.lit(0).alias("kind"), "id").union(gaps.select("size", F.lit(1).alias("kind"), "id"))
    placed = items.select(F.col("id").alias("item"), F.col("id").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).limit(0)
    aside = gaps.limit(0)
    while True:
        state = state.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
        parts = state.groupBy("size", "kind", "salt").count().toPandas()
        grid = np.zeros((capacity + 1, 2, SALTS), np.int64)
        grid[parts["size"], parts["kind"], parts["salt"]] = parts["count"]
        counts = grid.sum(axis=2)
        level, left, after = _sweep(counts)
        opens = _to_open(left, after, capacity, partial)
        if (left == counts[:, 0]).all() and not opens.any():
            break       # nothing is left, or nothing that a gap can take
        before = np.cumsum(grid, axis=2) - grid
        s, k, j = np.nonzero(grid)
        base = spark.createDataFrame(pd.DataFrame({
            "size": s.astype(np.int32), "kind": k.astype(np.int32), "salt": j.astype(np.int32), "before": before[s, k, j],
            "level": level[s], "items": counts[s, 0], "opens": opens[s]}))
        ranked = state.join(F.broadcast(base), ["size", "kind", "salt"]).withColumn(
            "rank", F.col("before") + F.row_number().over(Window.partitionBy("size", "kind", "salt").orderBy("id")))
        swept = ranked.withColumn("at", F.when(F.col("kind") == 0, F.col("level") + F.col("rank"))
                                  .otherwise(F.col("level") + F.col("items") - F.col("rank") + 1))
        w = Window.partitionBy("at").orderBy("size", "kind", "rank")
        done = written(swept.select(
            "size", "kind", "id", "rank", "opens",
            F.lead("id").over(w).alias("gap_id"), F.lead("size").over(w).alias("gap_size"),
            F.when(F.col("kind") == 1, F.lag("size").over(w)).alias("took")), "packing-round")
        item = F.col("kind") == 0
        opened = item & F.col("gap_id").isNull() & (F.col("rank") <= F.col("opens"))
        placed = placed.union(done.where(item & F.col("gap_id").isNotNull() | opened).select(
            F.col("id").alias("item"), F.coalesce("gap_id", "id").alias("sequence_id"),
            F.when(F.col("gap_id").isNotNull(), F.lit(capacity) - F.col("gap_size")).otherwise(F.lit(0)).cast("long").alias("offset")))
        rest = np.flatnonzero(left - opens)
        smallest = 1 if partial else int(rest[0]) if len(rest) else capacity + 1
        shrunk = done.where(~item | opened).select(
            F.when(item, F.lit(capacity) - F.col("size")).otherwise(F.col("size") - F.coalesce("took", F.lit(0))).cast("int").alias("size"), "id")
        aside = aside.union(shrunk.where((F.col("size") < smallest) & (F.col("size") > 0)))
        state = done.where(item & F.col("gap_id").isNull() & (F.col("rank") > F.col("opens"))).select("size", "kind", "id").union(
            shrunk.where(F.col("size") >= smallest).select("size", F.lit(1).alias("kind"), "id"))
    side = lambda k: state.where(F.col("kind") == k).select("size", "id")
    return placed, aside.union(side(1)), side(0)


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(item, sequence_id, offset) for ``items`` (item long, unique; length long, 1 to
    ``capacity``); a sequence has the id of the item that opened it."""
    sized = items.select(F.col("length").cast("int").alias("size"), F.col("item").alias("id"))
    return _rounds(sized, sized.limit(0), capacity)[0]


def packed_sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0,
                     id_col: str = "doc_id", text_col: str = "text", batch_rows: int = CALL_ROWS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece.
    Texts go to the workers in batches of ``batch_rows`` at most: fewer take less memory, more
    less time.

    Pieces are packed in decreasing order of size in three steps: those above a 32nd of the
    capacity; bundles of the shorter ones, so that a sequence of very short pieces does not
    take a round for each; then, one by one, the pieces of the bundles that no gap took.

    Defined cases: a null or empty text is the end id alone (one token); a null id stays
    null; repeated rows are packed as often as they occur; equal lengths are ranked by an
    internal number; an empty table gives an empty result; only the two named columns are
    read.
    """
    with short_batches(docs.sparkSession, batch_rows):
        units = written(pieces(docs, tokenizer, capacity, end_id, id_col, text_col).withColumn(
            "unit", F.monotonically_increasing_id()), "pieces")
    short = capacity // 32
    size = F.col("length").cast("int").alias("size")
    middle = units.where((F.col("length") > short) & (F.col("length") < capacity)).select(size, F.col("unit").alias("id"))
    of_middle, gaps, _ = _rounds(middle, middle.limit(0), capacity)
    small = written(units.where(F.col("length") <= short).select("unit", "length").mapInArrow(
        _bundles(capacity // 16), "unit long, length long, item long, at long"), "bundles")
    bundles = small.groupBy(F.col("item").alias("id")).agg(F.sum("length").cast("int").alias("size")).select("size", "id")
    of_bundles, gaps, apart = _rounds(bundles, written(gaps, "gaps"), capacity, partial=True)
    loose = small.join(written(apart, "apart"), F.col("item") == F.col("id"), "left_semi").select(size, F.col("unit").alias("id"))
    of_loose, _, _ = _rounds(written(loose, "loose"), written(gaps, "gaps"), capacity)
    in_bundles = small.join(of_bundles, "item").select("unit", "sequence_id", (F.col("offset") + F.col("at")).alias("offset"))
    places = of_middle.union(of_loose).select(F.col("item").alias("unit"), "sequence_id", "offset").union(in_bundles)
    full = units.where(F.col("length") == capacity).select("*", F.col("unit").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return units.where(F.col("length") < capacity).join(written(places, "places"), "unit").select(cols).union(full.select(cols))
