"""SimHash near-dedup with a segment-popcount embedding.

A fingerprint's 64 bits are cut into 32 segments of two bits; the bit count of each is a
coordinate (0, 1 or 2). Flipping one bit changes one coordinate by one, so the Manhattan
distance of two such vectors never exceeds the Hamming distance of the fingerprints. For
links at 4 bits or fewer, one half of the coordinates (16 of them) differs by 2 or less,
and then both half-vectors lie within one step of a common grid cell:

* each distinct fingerprint enters, for both halves, its own cell and the cells one step
  away (25 of a half on average);
* in a cell, pairs pass the Manhattan bound over all 32 coordinates, then the exact
  Hamming check. A cell yields a spanning forest of its links, never all pairs;
* links go through connected components.

Coordinates are kept in thermometer code (0: 00, 1: 01, 2: 11), where the Manhattan
distance is the number of differing code bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from drover.llm import exchange as X
from drover.llm.common import buckets, lean, lean_group, narrow, ship, short_batches, text_slices, written
from drover.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Groups of a cell up to this size are compared by shifting, larger ones by search.
SMALL_CELL = 24
#: Fingerprints whose cells (about 50 each) a task holds at once.
SPREAD = 5_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.uint64(0x5555555555555555)
_HALF = np.uint64(0xFFFFFFFF)


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """SimHash of the lower-cased text's ``k``-word shingles; 0 if it has no word."""
    joined = b" ".join(text.translate(_LOWER).split())
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    digest = xxhash.xxh64_intdigest
    if len(gaps) + 1 <= k:
        h = [digest(joined, SEED)]
    else:
        begin = [0, *(gaps[:len(gaps) - k + 1] + 1).tolist()]
        end = [*gaps[k - 1:].tolist(), len(joined)]
        h = [digest(joined[a:b], SEED) for a, b in zip(begin, end, strict=True)]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):
        part = np.array(h[i:i + 65536], np.uint64)
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)[0])


def _fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros(b.num_rows, np.uint64)
            for row, data, off in text_slices(b.column("text")):
                raw = data.tobytes()
                for i in range(len(off) - 1):
                    out[row + i] = fingerprint(raw[off[i]:off[i + 1]], k)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("digest"), pa.array(out.view(np.int64))],
                                             names=["doc_id", "digest", "fp"])
    return run


def text_digest(text_col: str = "text"):
    """64 bits that tell texts apart which share an id; a null text is not an empty one."""
    return F.xxhash64(F.col(text_col).isNull(), F.col(text_col))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """(doc_id, digest, fp) for every row; digest: :func:`text_digest`."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(text_col).alias("digest"),
                       F.col(text_col).alias("text")).mapInArrow(lean(_fingerprints(k)), "doc_id long, digest long, fp long")


def thermometer(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the two-bit segments, each in thermometer code."""
    return ((fp | fp >> np.uint64(1)) & _ODD) | ((fp & fp >> np.uint64(1)) & _ODD) << np.uint64(1)


def cells(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, cell) for the cells that each vector enters; a cell's lowest 32 bits are the
    half-vector's code, bit 32 tells the half."""
    index, out = [], []
    every = np.arange(len(code))
    for half in (0, 1):
        v = (code >> np.uint64(32 * half)) & _HALF
        tag = np.uint64(half << 32)
        index.append(every)
        out.append(v | tag)
        for s in range(0, 32, 2):
            low, high = np.uint64(1 << s), np.uint64(2 << s)
            ok = np.flatnonzero((v & high) == 0)     # 0 <-> 1
            index.append(ok)
            out.append((v[ok] ^ low) | tag)
            ok = np.flatnonzero((v & low) != 0)      # 1 <-> 2
            index.append(ok)
            out.append((v[ok] ^ high) | tag)
    return np.concatenate(index), np.concatenate(out)


def _spread(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(fp), SPREAD):
                part = fp[i:i + SPREAD]
                index, cell = cells(thermometer(part))
                where = ((cell * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(n)
                order = np.argsort(where, kind="stable")
                cut = np.searchsorted(where[order], np.arange(n + 1))
                rows = [(k, order[cut[k]:cut[k + 1]]) for k in range(n) if cut[k] < cut[k + 1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([k for k, _ in rows], pa.int32()),
                    pa.array([X.planes(cell[o]) for _, o in rows], pa.binary()),
                    pa.array([X.planes(part[index[o]]) for _, o in rows], pa.binary())], names=["bucket", "cells", "fps"])
    return run


def _linked(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Indices of the pairs within ``bits``: Manhattan bound first, then exact."""
    near = np.flatnonzero(np.bitwise_count(thermometer(a) ^ thermometer(b)) <= bits)
    return near[np.bitwise_count(a[near] ^ b[near]) <= bits]


def _forest(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among ``fp``."""
    left, queue, a, b = fp, [], [], []
    while len(left) or queue:
        if not queue:
            queue.append(left[:1])
            left = left[1:]
        for seed in queue.pop():
            hit = _linked(np.full(len(left), seed), left, bits)
            if len(hit):
                a.append(np.full(len(hit), seed))
                b.append(left[hit])
                queue.append(left[hit])
                left = np.delete(left, hit)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def links_in_cells(cell: np.ndarray, fp: np.ndarray, bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect, in each cell, what is connected there by links."""
    order = np.lexsort((fp, cell))
    cell, fp = cell[order], fp[order]
    new = np.concatenate(([True], cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(cell)))
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    small = np.repeat(size <= SMALL_CELL, size)
    at = np.flatnonzero(small)
    for lag in range(1, SMALL_CELL):
        at = at[at + lag < len(cell)]
        at = at[cell[at] == cell[at + lag]]
        hit = at[_linked(fp[at], fp[at + lag], bits)]
        a.append(fp[hit])
        b.append(fp[hit + lag])
    for k in np.flatnonzero(size > SMALL_CELL):
        x, y = _forest(fp[first[k]:first[k] + size[k]], bits)
        a.append(x)
        b.append(y)
    a, b = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links (a, b) a spanning forest needs."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x
    keep = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y:
            up[y] = x
            keep.append(i)
    return np.array(keep, np.int64)


def _join(bits: int):
    def run(t: pa.Table) -> pa.Table:
        cat = lambda n: np.concatenate([X.unplanes(r, np.uint64) for r in t.column(n).to_pylist()])
        a, b = links_in_cells(cat("cells"), cat("fps"), bits)
        need = _spanning(a, b)     # one forest over all cells of the bucket
        a, b = a[need], b[need]
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})
    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``), enough to connect all
    that links connect."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the grid's step covers up to {MAX_BITS} bits")
    ship(fps.sparkSession)
    n = buckets(fps.sparkSession)
    spread = fps.select("fp").mapInArrow(lean(_spread(n)), "bucket int, cells binary, fps binary")
    return spread.groupBy("bucket").applyInArrow(lean_group(_join(max_bits)), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, digest, fp, root, component_id, alone) for every row of ``docs``: component_id
    is the smallest id that links reach, root the smallest fingerprint, digest tells texts
    apart that share an id, and ``alone`` rows have no other row in their component.

    Fingerprints without a link take no part in the joins by component, and those of a
    single row without a link none in the join by fingerprint. Each of these joins ends a
    stage, so that Spark can split a fingerprint or component that many rows share.

    Defined cases: null and empty texts have fingerprint 0 and link like any other; a null
    id stays null and is never a component's id unless all of it are null; repeated rows
    and ids are all returned, in one component if their texts link; an empty table gives
    an empty result; only the two named columns are read.
    """
    with short_batches(docs.sparkSession):
        own = written(fingerprints(docs, id_col, text_col, k), "fingerprints")
    classes = written(own.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")), "fingerprint-classes")
    roots = written(components(written(links(classes, max_bits), "fingerprint-links")), "fingerprint-roots")
    linked = written(classes.join(narrow(roots), F.col("fp") == F.col("node")).select("fp", "least", "root"), "linked-classes")
    least = written(linked.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    named = written(linked.select("fp", "root").join(narrow(least), "root"), "named-classes")
    copies = classes.where("rows > 1").join(named.select("fp"), "fp", "left_anti").select(
        "fp", F.col("fp").alias("root"), F.col("least").alias("component_id"))
    shared = written(named.select("fp", "root", "component_id").union(copies).withColumn("alone", F.lit(False)), "shared-classes")
    found = F.col("alone").isNotNull()
    return own.join(narrow(shared), "fp", "left").select(
        "doc_id", "digest", "fp", F.when(found, F.col("root")).otherwise(F.col("fp")).alias("root"),
        F.when(found, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), (~found).alias("alone"))


def one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Marks for keeping one row of each component: the one with the smallest id (null last),
    then the smallest digest. (doc_id, digest, gone, rows) for the ids and texts of which no
    row stays (``gone``), and for those that stay with ``rows`` > 1 equal rows. What has no
    mark stays. No text is moved."""
    groups = written(near_duplicates(docs, id_col, text_col, **how), "near-duplicates").where(~F.col("alone"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    rows = written(groups.groupBy("root", "doc_id", "digest").agg(F.count(F.lit(1)).alias("rows")), "component-rows")
    first = written(rows.groupBy("root").agg(F.min(place).alias("first")), "component-first")
    marks = rows.join(narrow(first), "root").select("doc_id", "digest", (place != F.col("first")).alias("gone"), "rows")
    return marks.where(F.col("gone") | (F.col("rows") > 1))


def fingerprint_text(fp):
    """16 lower-case hexadecimal digits of a fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
