"""Compact exchange of (hash, document, position) entries through Spark's shuffle.

A map task gathers entries of many documents and sends one row per hash bucket, whose
binary columns hold the entries (a few bytes each instead of a Spark row each). Entries of
one bucket meet in one group; what the group finds goes back by document bucket.

Hot hashes do not gather in a bucket: each map task first settles its own entries (see
``local`` of the callers) and sends one entry per hash on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from drover.llm.common import lean_group, short_batches, sized, written

#: Columns of a packed row. ``ids``/``digests``/``counts``: documents and how many entries
#: of each follow, in order; ``hashes``/``pos``/``extra``/``bytes``: the entries.
SCHEMA = "bucket int, known boolean, ids binary, digests binary, counts binary, hashes binary, pos binary, extra binary, bytes binary"
#: Tells a hot hash from a document (whose digests are not negative).
HOT_DIGEST = -1
ARROW = pa.schema([("bucket", pa.int32()), ("known", pa.bool_())] + [
    (n, pa.binary()) for n in ("ids", "digests", "counts", "hashes", "pos", "extra", "bytes")])


def planes(a: np.ndarray) -> bytes:
    """Bytes of ``a`` by significance: the high bytes of small numbers become long runs of
    zeros, which the shuffle's compression removes."""
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""


def unplanes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(raw, np.uint8).reshape(size, -1).T.copy().view(dtype).ravel() if raw else np.zeros(0, dtype)


def _ranges(cut, n: int):
    return zip(cut, [*cut[1:], n], strict=True) if n else ()


def pack(ids: np.ndarray, digests: np.ndarray, hashes: np.ndarray, pos: np.ndarray,
         extra: np.ndarray | None, bucket: np.ndarray, known: bool, parts: list[np.ndarray] | None = None) -> pa.RecordBatch:
    """One row per bucket. Entries keep their order within a bucket; entries of one
    document are best adjacent. ``parts``: per entry a byte range (start, end, buffer)."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cut = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1]))) if len(b) else np.zeros(0, np.int64)
    rows: dict[str, list] = {n: [] for n in ARROW.names}
    for lo, hi in _ranges(cut, len(b)):
        o = order[lo:hi]
        i, g = ids[o], digests[o]
        new = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (g[1:] != g[:-1]))))
        rows["bucket"].append(int(b[lo]))
        rows["known"].append(known)
        rows["ids"].append(planes(i[new]))
        rows["digests"].append(planes(g[new]))
        rows["counts"].append(planes(np.diff(np.append(new, len(o))).astype(np.int32)))
        rows["hashes"].append(b"" if known else planes(hashes[o]))
        rows["pos"].append(planes(pos[o].astype(np.int32)))
        rows["extra"].append(b"" if extra is None else planes(extra[o].astype(np.int32)))
        rows["bytes"].append(b"" if parts is None else b"".join(parts[k] for k in o))
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in ARROW], schema=ARROW)


class Entries:
    """The entries of a bucket's rows (of one ``known`` kind) as flat arrays."""

    def __init__(self, t: pa.Table, known: bool):
        rows = [r for r in t.to_pylist() if r["known"] == known]
        cat = lambda n, d: np.concatenate([unplanes(r[n], d) for r in rows]) if rows else np.zeros(0, d)
        counts = cat("counts", np.int32)
        self.ids = np.repeat(cat("ids", np.int64), counts)
        self.digests = np.repeat(cat("digests", np.int32), counts)
        self.hashes = cat("hashes", np.uint64)
        self.pos = cat("pos", np.int32)
        self.extra = cat("extra", np.int32)
        self.bytes = b"".join(r["bytes"] for r in rows)

    def __len__(self) -> int:
        return len(self.ids)


def doc_bucket(ids: np.ndarray, n: int) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % np.uint64(n)).astype(np.int32)


def hash_bucket(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(20)) % np.uint64(n)).astype(np.int32)


def send_back(ids: np.ndarray, digests: np.ndarray, pos: np.ndarray, extra: np.ndarray | None, n: int) -> pa.RecordBatch:
    """Rows for the documents' buckets (nothing further to settle)."""
    o = np.lexsort((pos, digests, ids))
    return pack(ids[o], digests[o], np.zeros(0, np.uint64), pos[o], None if extra is None else extra[o],
                doc_bucket(ids[o], n), True)


def groups_of(h: np.ndarray, *later: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first index of each group) of entries sorted by h, then by ``later``."""
    o = np.lexsort((*later[::-1], h)) if later else np.argsort(h, kind="stable")
    s = h[o]
    return o, np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)


def by_document(t: pa.Table, finish) -> pa.Table:
    """Per-document rows (key_id, key_digest, spans): ``finish(pos, extra)`` gives the
    spans, an int array of [start, end) rows, of one document's entries."""
    e = Entries(t, True)
    o = np.lexsort((e.pos, e.digests, e.ids))
    i, g = e.ids[o], e.digests[o]
    cut = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (g[1:] != g[:-1])))) if len(i) else []
    out: list[tuple[int, int, bytes]] = []
    for lo, hi in _ranges(cut, len(i)):
        k = o[lo:hi]
        spans = finish(e.pos[k].astype(np.int64), e.extra[k].astype(np.int64) if len(e.extra) else None)
        if len(spans):
            out.append((int(i[lo]), int(g[lo]), spans.astype("<i4").tobytes()))
    return pa.table({"key_id": pa.array([x[0] for x in out], pa.int64()), "key_digest": pa.array([x[1] for x in out], pa.int32()),
                     "spans": pa.array([x[2] for x in out], pa.binary())})


class Gathered:
    """Arrays of many slices until ``flush_at`` entries are there; then ``settle`` them."""

    def __init__(self, settle, flush_at: int):
        self.settle, self.flush_at, self.parts, self.n = settle, flush_at, [], 0

    def add(self, *arrays) -> Iterator[pa.RecordBatch]:
        self.parts.append(arrays)
        self.n += len(arrays[0])
        if self.n >= self.flush_at:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            whole = [np.concatenate(x) for x in zip(*self.parts, strict=True)]
            self.parts, self.n = [], 0
            yield from self.settle(*whole)


def _shared(ids: np.ndarray, o: np.ndarray, first: np.ndarray, size: np.ndarray, within: bool) -> np.ndarray:
    return size > 1 if within else ids[o[first]] != ids[o[first + size - 1]]


def settle_shared(n: int, within: bool, counted: bool = False):
    """Within a task: hashes that several documents (``within``: several places) hold are
    known to be shared and go straight back; one entry for each (position -1, ``counted``:
    minus their number) tells the bucket."""
    def settle(ids, digests, hashes, pos):
        o, first = groups_of(hashes, ids)
        size = np.diff(np.append(first, len(o)))
        shared = _shared(ids, o, first, size, within)
        many = np.repeat(shared, size)
        known, tell = o[many], o[first[shared]]
        yield send_back(ids[known], digests[known], pos[known], None, n)
        keep = np.sort(np.concatenate((o[~many], tell)))
        marked = pos.copy()
        marked[tell] = -size[shared] if counted else -1
        yield pack(ids[keep], digests[keep], hashes[keep], marked[keep], None, hash_bucket(hashes[keep], n), False)
    return settle


def meet_shared(n: int, within: bool, hot: int | None = None):
    """In a bucket: the entries whose hash several documents (places) hold go back.
    ``hot`` (entries settled as ``counted``): a hash with more places than this goes back
    too, in the form of an entry of the document (hash as id, HOT_DIGEST)."""
    def run(t: pa.Table) -> pa.Table:
        e = Entries(t, False)
        out = known_rows(t)
        if len(e):
            o, first = groups_of(e.hashes, e.ids)
            size = np.diff(np.append(first, len(o)))
            shared = _shared(e.ids, o, first, size, within) | np.logical_or.reduceat(e.pos[o] < 0, first)
            back = o[np.repeat(shared, size)]
            back = back[e.pos[back] >= 0]
            out.append(send_back(e.ids[back], e.digests[back], e.pos[back], None, n))
            if hot is not None:
                places = np.add.reduceat(np.where(e.pos[o] < 0, -e.pos[o].astype(np.int64), 1), first)
                many = e.hashes[o[first[places > hot]]].view(np.int64)
                out.append(send_back(many, np.full(len(many), HOT_DIGEST, np.int32), np.zeros(len(many), np.int32), None, n))
        return pa.Table.from_batches(out, ARROW)
    return run


def known_rows(t: pa.Table) -> list[pa.RecordBatch]:
    return [b.filter(b.column("known")) for b in t.cast(ARROW).to_batches()]


def exchanged(df: DataFrame, meet, finish, name: str) -> DataFrame:
    """Hash buckets meet, then document buckets: (key_id, key_digest, spans), written."""
    met = df.groupBy("bucket").applyInArrow(lean_group(meet), SCHEMA)
    with short_batches(df.sparkSession):
        return written(met.groupBy("bucket").applyInArrow(lean_group(lambda t: by_document(t, finish)), SPANS), name)


def with_spans(keyed: DataFrame, spans: DataFrame) -> DataFrame:
    """Left join of the documents with their spans: broadcast if measured to be small
    (:func:`drover.llm.common.sized`), else shuffled."""
    return keyed.join(sized(spans, "spans"), ["key_id", "key_digest"], "left")


SPANS = "key_id long, key_digest int, spans binary"


def read_spans(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw, "<i4").reshape(-1, 2).astype(np.int64) if raw else np.zeros((0, 2), np.int64)
