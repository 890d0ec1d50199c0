"""Substring dedup by longest-previous-factor arrays.

A byte is removed if it lies in a 100-byte string that also starts earlier: in a document
with a smaller id, or earlier in the same document. Matches never cross documents.

1. Every 100-byte window has one anchor: the place of the smallest 32-gram hash inside it
   (the leftmost on ties), which depends on the window's bytes alone. Equal windows thus
   meet at anchors with equal hashes; anchors that occur once are left out.
2. The bytes around the shared anchors (all windows of one anchor: 168 bytes at most) meet
   by anchor hash. Equal contexts keep only the earliest. The contexts that remain with
   others of their anchor are laid out in corpus order and their windows sorted as
   suffixes (prefix doubling); the previous and next smaller positions in suffix order,
   with the minima of the common-prefix lengths on the way, give each window's longest
   previous factor. Windows whose factor has 100 bytes or more are repeated.
   An anchor hash with more than HOT places (a line that many documents share) would make
   a suffix array that grows with the input. Its distinct contexts are taken apart into
   windows, which meet by window hash in all buckets; each but the earliest is repeated.
3. The union of the repeated windows is cut; the earliest copy stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from drover.llm import exchange as X
from drover.llm.common import buckets, doc_key, ship, text_slices
from drover.llm.words import BYTES, in_spans, merge_spans, mix, prefix_hash, range_hash, runs

LENGTH = 100
GRAM = 32
#: Anchors that a map task gathers before it sends them on, and contexts likewise.
FLUSH, FLUSH_CONTEXTS = 2_000_000, 150_000
#: Bytes of contexts in one suffix array, at most.
SUFFIX_BYTES = 1 << 20
#: Places of an anchor hash whose contexts (168 bytes at most) fill half of that.
HOT = SUFFIX_BYTES // 2 // (2 * LENGTH - GRAM)
#: Contexts of hot anchors that a map task takes apart at once.
HOT_CONTEXTS = 20_000
_POSITION_BITS = 26


def anchors_of(data: np.ndarray, off: np.ndarray):
    """(prefix hash, anchor, first window, last window, hash) of the slice's documents: the
    windows that start at first..last have their anchor at that byte."""
    n = len(data)
    prefix = prefix_hash(BYTES[data])
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return prefix, none, none, none, np.zeros(0, np.uint64)
    at = np.arange(n - GRAM + 1)
    h = range_hash(prefix, at, at + GRAM)
    bits = np.uint64(max(_POSITION_BITS, n.bit_length()))
    low = (h >> bits << bits) | at.astype(np.uint64)
    width, step = LENGTH - GRAM + 1, 1
    while step * 2 <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < width:
        low = np.minimum(low[:n - LENGTH + 1], low[width - step:width - step + n - LENGTH + 1])
    ends = np.repeat(off[1:], np.diff(off))
    win = np.flatnonzero(np.arange(n - LENGTH + 1) + LENGTH <= ends[:n - LENGTH + 1])
    if not len(win):
        return prefix, none, none, none, np.zeros(0, np.uint64)
    a = (low[win] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (win[1:] != win[:-1] + 1))))
    last = np.append(new[1:], len(win)) - 1
    return prefix, a[new], win[new], win[last], h[a[new]]


def _anchors(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = X.Gathered(X.settle_shared(n, True, counted=True), FLUSH)
        for b in batches:
            ids, dig = b.column("key_id").to_numpy(), b.column("key_digest").to_numpy()
            for row, data, off in text_slices(b.column("text")):
                _, a, _, _, h = anchors_of(data, off)
                doc = np.searchsorted(off, a, side="right") - 1
                yield from g.add(ids[row + doc], dig[row + doc], h, (a - off[doc]).astype(np.int32))
        yield from g.flush()
    return run


def _near(pos: np.ndarray, _extra) -> np.ndarray:
    """Stretches of a document around its shared anchors."""
    return merge_spans(np.stack([np.maximum(pos - GRAM, 0), pos + GRAM], axis=1))


def _windows_of(raw: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, offset in it, hash) of every window of the contexts that ``raw`` holds."""
    count = size - LENGTH + 1
    which = np.repeat(np.arange(len(size)), count)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    at = (np.cumsum(size) - size)[which] + offset
    return which, offset, range_hash(prefix_hash(BYTES[np.frombuffer(raw, np.uint8)]), at, at + LENGTH)


def _settle_windows(ids, digests, hashes, pos, extra):
    """(entries that begin their run of equal windows, entries that are repeated)."""
    o = np.lexsort((pos, digests, ids, extra, hashes))
    h, x = hashes[o], extra[o]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (x[1:] != x[:-1])))
    again, other = _again(np.cumsum(new), ids[o], digests[o], pos[o])
    return o[~again], o[again & other]


def _windows_back(ids, digests, pos, n: int) -> pa.RecordBatch:
    """Repeated windows, for the documents' buckets: one entry per run of them."""
    o = np.lexsort((pos, digests, ids))
    i, g, p = ids[o], digests[o], pos[o]
    new = np.concatenate(([True], (i[1:] != i[:-1]) | (g[1:] != g[:-1]) | (p[1:] > p[:-1] + 1)))[:len(p)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p))[:len(first)] - 1
    return X.send_back(i[first], g[first], p[first], (p[last] - p[first] + LENGTH).astype(np.int32), n)


def _contexts(n: int, hot):
    """Map side of step 2: one entry per anchor context; equal contexts of the task keep
    the earliest, the later ones are known to be repeated whole. Of ``hot`` anchor hashes
    (a broadcast sorted array), one entry per window, settled likewise: the window's hash,
    and instead of lengths a negative number from the anchor's."""
    def take_apart(ids, digests, hashes, pos, parts, k):
        size = np.array([len(x) for x in parts[k]])
        which, offset, own = _windows_of(b"".join(parts[k]), size)
        k, at = k[which], pos[k[which]] + offset.astype(np.int32)
        tag = -1 - (hashes[k] >> np.uint64(33)).astype(np.int32)
        keep, again = _settle_windows(ids[k], digests[k], own, at, tag)
        yield _windows_back(ids[k[again]], digests[k[again]], at[again], n)
        keep = np.sort(keep)
        k = k[keep]
        yield X.pack(ids[k], digests[k], own[keep], at[keep], tag[keep], X.hash_bucket(own[keep], n), False)

    def settle(ids, digests, hashes, own, pos, extra, parts):
        o = np.lexsort((pos, digests, ids, own))
        again, other = _again(own[o], ids[o], digests[o], pos[o])
        known, keep = o[again & other], np.sort(o[~again])
        yield X.send_back(ids[known], digests[known], pos[known], extra[known] >> 8, n)
        many = _among(hashes[keep].view(np.int64), hot.value)
        apart, keep = keep[many], keep[~many]
        yield X.pack(ids[keep], digests[keep], hashes[keep], pos[keep], extra[keep],
                     X.hash_bucket(hashes[keep], n), False, parts[keep])
        for i in range(0, len(apart), HOT_CONTEXTS):
            yield from take_apart(ids, digests, hashes, pos, parts, apart[i:i + HOT_CONTEXTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = X.Gathered(settle, FLUSH_CONTEXTS)
        for b in batches:
            b = b.filter(b.column("spans").is_valid())
            ids, dig = b.column("key_id").to_numpy(), b.column("key_digest").to_numpy()
            spans = b.column("spans").to_pylist()
            for row, data, off in text_slices(b.column("text")):
                prefix, a, lo, hi, h = anchors_of(data, off)
                wanted = np.concatenate([X.read_spans(spans[row + k]) + off[k] for k in range(len(off) - 1)])
                m = in_spans(wanted, len(data))[a]
                a, lo, hi, h = a[m], lo[m], hi[m] + LENGTH, h[m]
                doc = np.searchsorted(off, lo, side="right") - 1
                extra = ((a - lo) | ((hi - lo) << 8)).astype(np.int32)
                raw = data.tobytes()
                parts = np.empty(len(a), object)
                parts[:] = [raw[x:y] for x, y in zip(lo.tolist(), hi.tolist(), strict=True)]
                yield from g.add(ids[row + doc], dig[row + doc], h, _own(prefix, lo, hi, extra, h),
                                 (lo - off[doc]).astype(np.int32), extra, parts)
        yield from g.flush()
    return run


def _among(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def _again(own: np.ndarray, *place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted contexts: which repeat the one that begins their run, and which of those
    lie elsewhere (a repeated row of the table has the same place)."""
    new = np.concatenate(([True], own[1:] != own[:-1]))
    begin = np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
    return ~new, np.logical_or.reduce([p != p[begin] for p in place])


def _own(prefix, lo, hi, extra, h) -> np.ndarray:
    """Hash of a whole context with its anchor's place in it."""
    return mix(range_hash(prefix, lo, hi) ^ (h * np.uint64(3)) ^ mix(extra.astype(np.uint64)))


def previous_factors(text: np.ndarray, win: np.ndarray) -> np.ndarray:
    """For the suffixes of ``text`` (uint8) that start at ``win`` (ascending): the longest
    common prefix with any earlier of them, in steps of 4 up to 124."""
    n = len(text) + 256
    t = np.zeros(n + 3, np.uint64)
    t[:len(text)] = text
    ranks = {4: t[:n] << np.uint64(24) | t[1:n + 1] << np.uint64(16) | t[2:n + 2] << np.uint64(8) | t[3:n + 3]}
    shifted = lambda r, s: np.concatenate((r[s:], np.zeros(s, r.dtype)))
    for k in (4, 8, 16, 32):
        ranks[2 * k] = np.unique(ranks[k] << np.uint64(32) | shifted(ranks[k], k), return_inverse=True)[1].astype(np.uint64)
    order = np.argsort((ranks[64] << np.uint64(32) | shifted(ranks[64], 64))[win], kind="stable")
    sa = win[order]
    common = np.zeros(len(sa), np.int64)
    x, y = sa[:-1].copy(), sa[1:].copy()
    for k in (64, 32, 16, 8, 4):
        same = (ranks[k][x] == ranks[k][y]) * k
        common[1:] += same
        x += same
        y += same
    back = _smaller(sa, common)
    ahead = _smaller(sa[::-1], np.concatenate(([0], common[1:][::-1])))[::-1]
    out = np.zeros(len(sa), np.int64)
    out[order] = np.maximum(back, ahead)
    return out


def _smaller(pos: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Common prefix of each entry with its previous entry of smaller position (0: none),
    by pointer doubling over candidates; all entries passed over have larger positions."""
    cand, least = np.arange(len(pos)) - 1, common.copy()
    while True:
        go = np.flatnonzero((cand >= 0) & (pos[cand] > pos))
        if not len(go):
            return np.where(cand >= 0, least, 0)
        j = cand[go]
        low, far = np.minimum(least[go], least[j]), cand[j]
        least[go], cand[go] = low, far


def _meet_contexts(n: int):
    def run(t: pa.Table) -> pa.Table:
        e = X.Entries(t, False)
        out = X.known_rows(t)
        w = np.flatnonzero(e.extra < 0)
        if len(w):
            _, again = _settle_windows(e.ids[w], e.digests[w], e.hashes[w], e.pos[w], e.extra[w])
            k = w[again]
            out.append(_windows_back(e.ids[k], e.digests[k], e.pos[k], n))
            c = np.flatnonzero(e.extra >= 0)
            e.ids, e.digests, e.hashes, e.pos, e.extra = e.ids[c], e.digests[c], e.hashes[c], e.pos[c], e.extra[c]
        if len(e):
            size = (e.extra >> 8).astype(np.int64)
            end = np.cumsum(size)
            lo = end - size
            data = np.frombuffer(e.bytes, np.uint8)
            own = np.zeros(len(e), np.uint64)
            for i in range(0, len(e), 10_000):
                j = min(i + 10_000, len(e))
                prefix = prefix_hash(BYTES[data[lo[i]:end[j - 1]]])
                own[i:j] = _own(prefix, lo[i:j] - lo[i], end[i:j] - lo[i], e.extra[i:j], e.hashes[i:j])
            o = np.lexsort((e.pos, e.digests, e.ids, own, e.hashes))
            again, other = _again(own[o] ^ mix(e.hashes[o]), e.ids[o], e.digests[o], e.pos[o])
            k = o[again & other]
            out.append(X.send_back(e.ids[k], e.digests[k], e.pos[k], size[k].astype(np.int32), n))
            o = o[~again]
            h = e.hashes[o]
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            group = np.diff(np.append(first, len(o)))
            o = o[np.repeat(group > 1, group)]
            found = [_repeated(e, data, lo, end, c) for c in _portions(o, e.hashes, size)]
            if found:
                k, pos, ln = (np.concatenate(x) for x in zip(*found, strict=True))
                out.append(X.send_back(e.ids[k], e.digests[k], pos.astype(np.int32), ln.astype(np.int32), n))
        return pa.Table.from_batches(out, X.ARROW)
    return run


def _portions(o: np.ndarray, hashes: np.ndarray, size: np.ndarray):
    """Whole groups of one anchor hash, together SUFFIX_BYTES at most (a group, of HOT
    contexts at most, has half of that)."""
    if not len(o):
        return
    h = hashes[o]
    group = np.cumsum(np.concatenate(([0], h[1:] != h[:-1])))
    before = np.cumsum(size[o]) - size[o]
    begin = before[np.searchsorted(group, group)] // (SUFFIX_BYTES // 2)
    yield from np.split(o, np.flatnonzero(np.diff(begin)) + 1)


def _repeated(e: X.Entries, data, lo, end, o):
    """(entry, first byte in its document, length) of the repeated stretches of the
    contexts ``o``."""
    o = o[np.lexsort((e.pos[o], e.digests[o], e.ids[o]))]
    text = np.concatenate([data[lo[k]:end[k]] for k in o])
    size = (end - lo)[o]
    start = np.cumsum(size) - size
    count = size - LENGTH + 1
    which = np.repeat(np.arange(len(o)), count)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    again = previous_factors(text, start[which] + offset) >= LENGTH
    at = np.flatnonzero(again)
    new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (which[at[1:]] != which[at[:-1]]))) if len(at) else np.zeros(0, bool)
    a = at[new]
    z = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] if len(at) else a
    k = o[which[a]]
    return k, e.pos[k] + offset[a], offset[z] - offset[a] + LENGTH


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """(key_id, key_digest, spans): merged byte spans to remove, for documents that have any."""
    n = buckets(keyed.sparkSession)
    near = X.exchanged(keyed.mapInArrow(_anchors(n), X.SCHEMA), X.meet_shared(n, True, HOT), _near, "factor-anchors")
    # hot hashes: one in HOT anchors at most, 8 bytes each
    hot = near.where(F.col("key_digest") == X.HOT_DIGEST).select("key_id").distinct().toArrow().column("key_id").to_numpy()
    hot = ship(keyed.sparkSession).sparkContext.broadcast(np.sort(hot))
    found = X.with_spans(keyed, near.where(F.col("key_digest") != X.HOT_DIGEST)).mapInArrow(_contexts(n, hot), X.SCHEMA)
    return X.exchanged(found, _meet_contexts(n), lambda pos, size: merge_spans(np.stack([pos, pos + size], axis=1)), "factor-spans")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        spans = b.column("spans").to_pylist()
        total, gone, pieces, kept, sha = [], [], [], [], []
        for row, data, off in text_slices(b.column("text")):
            for k in range(len(off) - 1):
                own, s = data[off[k]:off[k + 1]], X.read_spans(spans[row + k])
                drop = in_spans(s, len(own))
                left = own[~drop].tobytes()
                total.append(len(own))
                gone.append(int(drop.sum()))
                pieces.append(len(runs(drop)))
                kept.append(left if gone[-1] else None)
                sha.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column("key_id"), b.column("key_digest"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
             pa.array(pieces, pa.int64()), pa.array(kept, pa.binary()), pa.array(sha, pa.string())],
            names=["key_id", "key_digest", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (key_id, key_digest, n_bytes, n_removed, n_spans, kept,
    kept_sha256); kept holds the remaining bytes where any were removed, else null (the
    text stays as it is).

    Defined cases: a null text is empty; a null id counts as the smallest; rows that share
    an id count as documents in the order of their texts' digests, and equal rows get equal
    results (none is the other's earlier copy); texts under 100 bytes lose nothing; an
    empty table gives an empty result; only the two named columns are read.
    """
    keyed = doc_key(docs, id_col, text_col)
    return X.with_spans(keyed, repeated_spans(keyed)).mapInArrow(
        _cut, "key_id long, key_digest int, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
