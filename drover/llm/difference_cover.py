"""Substring dedup by difference-cover anchors.

A window of 13 words is removed where its word sequence also starts in a document with a
smaller id. With the difference cover {0, 1, 3} modulo 7, any two word positions i and j
have a shift d < 7 with i + d and j + d both at cover positions; hence two equal windows of
13 words share, at the same offset, a 7-word anchor that starts at a cover position in
both documents. Steps:

1. hash the 7-word anchors at cover positions only and find those that several documents
   hold (:func:`shared_anchors`);
2. extend: a window can be repeated only if a shared anchor lies in it; those windows are
   hashed whole (96 bits, of words hashed modulo a prime), and each stays only in its
   smallest document (:func:`repeated_spans`);
3. cut the spans from the texts (:func:`remove_repeats`).

Entries of a map task are settled among themselves first, so a passage that a third of all
documents hold reaches its bucket once per task, not once per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from drover.llm import exchange as X
from drover.llm.common import buckets, doc_key, lean, sized, text_slices, unused
from drover.llm.words import PLAIN, in_spans, merge_spans, runs, window_check, window_hash, words_of

WINDOW = 13
PERIOD = 7
COVER = np.array([0, 1, 3])
ANCHOR = WINDOW - (PERIOD - 1)
#: Entries that a map task gathers before it sends them on.
FLUSH = 500_000

_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def _anchors(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = X.Gathered(X.settle_shared(n, False), FLUSH)
        for b in batches:
            ids, dig = b.column("key_id").to_numpy(), b.column("key_digest").to_numpy()
            for row, data, off in text_slices(b.column("text")):
                w = words_of(data, off, PLAIN)
                doc = w.docs()
                pos = np.arange(len(doc)) - w.first[doc]
                at = np.flatnonzero(_IN_COVER[pos % PERIOD] & (pos + ANCHOR <= w.counts[doc]) & (w.counts[doc] >= WINDOW))
                yield from g.add(ids[row + doc[at]], dig[row + doc[at]], window_hash(w.hash, at, ANCHOR), pos[at].astype(np.int32))
        yield from g.flush()
    return run


def candidate_windows(pos: np.ndarray, _extra=None) -> np.ndarray:
    """[start, end) rows of window starts that hold a shared anchor; ``pos``: word
    positions of a document's shared anchors."""
    return merge_spans(np.stack([np.maximum(pos - (PERIOD - 1), 0), pos + 1], axis=1))


def shared_anchors(keyed: DataFrame) -> DataFrame:
    """(key_id, key_digest, spans): ranges of window starts that may be repeated."""
    n = buckets(keyed.sparkSession)
    return X.exchanged(keyed.mapInArrow(lean(_anchors(n)), X.SCHEMA), X.meet_shared(n, False), candidate_windows, "cover-anchors")


def same_windows(hashes: np.ndarray, checks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first index of each group): windows are equal if hash and check, 96 bits,
    are; the smallest document comes first."""
    o = np.lexsort((ids, checks, hashes))
    h, c = hashes[o], checks[o]
    return o, np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))) if len(o) else np.zeros(0, np.int64)


def first_only(n: int):
    """Within a task: a window is repeated if a smaller document of the task holds it;
    only the smallest document's entries go to the bucket."""
    def settle(ids, digests, hashes, pos, checks):
        o, first = same_windows(hashes, checks, ids)
        size = np.diff(np.append(first, len(o)))
        later = ids[o] > np.repeat(ids[o[first]], size)
        yield X.send_back(ids[o[later]], digests[o[later]], pos[o[later]], None, n)
        keep = np.sort(o[~later])
        yield X.pack(ids[keep], digests[keep], hashes[keep], pos[keep], checks[keep], X.hash_bucket(hashes[keep], n), False)
    return settle


def _windows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = X.Gathered(first_only(n), FLUSH)
        for b in batches:
            b = b.filter(b.column("spans").is_valid())
            ids, dig = b.column("key_id").to_numpy(), b.column("key_digest").to_numpy()
            spans = b.column("spans").to_pylist()
            for row, data, off in text_slices(b.column("text")):
                w = words_of(data, off, PLAIN)
                at, doc = [], []
                for k in range(len(off) - 1):
                    m = in_spans(X.read_spans(spans[row + k]), int(w.counts[k]) - WINDOW + 1 if w.counts[k] >= WINDOW else 0)
                    p = np.flatnonzero(m)
                    at.append(w.first[k] + p)
                    doc.append(np.full(len(p), k))
                at, doc = np.concatenate(at), np.concatenate(doc)
                yield from g.add(ids[row + doc], dig[row + doc], window_hash(w.hash, at, WINDOW), (at - w.first[doc]).astype(np.int32),
                                 window_check(w, at, WINDOW))
        yield from g.flush()
    return run


def _meet_windows(n: int):
    def run(t: pa.Table) -> pa.Table:
        e = X.Entries(t, False)
        out = X.known_rows(t)
        if len(e):
            o, first = same_windows(e.hashes, e.extra, e.ids)
            size = np.diff(np.append(first, len(o)))
            later = o[e.ids[o] > np.repeat(e.ids[o[first]], size)]
            out.append(X.send_back(e.ids[later], e.digests[later], e.pos[later], None, n))
        return pa.Table.from_batches(out, X.ARROW)
    return run


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """(key_id, key_digest, spans): word spans to remove, merged, for documents that have any."""
    n = buckets(keyed.sparkSession)
    found = X.with_spans(keyed, shared_anchors(keyed))
    return X.exchanged(found.mapInArrow(lean(_windows(n)), X.SCHEMA), _meet_windows(n),
                       lambda pos, _: merge_spans(np.stack([pos, pos + WINDOW], axis=1)), "cover-windows")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        spans = b.column("spans").to_pylist()
        total, gone, text, sha = [], [], [], []
        for row, data, off in text_slices(b.column("text")):
            w = words_of(data, off, PLAIN)
            raw = data.tobytes()
            for k in range(len(off) - 1):
                n = int(w.counts[k])
                drop = in_spans(X.read_spans(spans[row + k]), n)
                own = raw[off[k]:off[k + 1]]
                keep = []
                s, e = w.start[w.first[k]:w.first[k + 1]] - off[k], w.end[w.first[k]:w.first[k + 1]] - off[k]
                for lo, hi in runs(~drop):
                    keep.extend(own[s[lo]:e[hi - 1]].split())
                kept = b" ".join(keep)
                total.append(n)
                gone.append(int(drop.sum()))
                text.append(None if not gone[-1] else kept.decode())
                sha.append(hashlib.sha256(kept).hexdigest())
        names = [c for c in b.schema.names if c not in ("spans",)]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in names), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
             pa.array(text, pa.string()), pa.array(sha, pa.string())],
            names=[*names, "n_words", "n_removed", "kept_text", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (key_id, key_digest, n_words, n_removed, kept_text,
    kept_sha256), where key_id and key_digest are those of :func:`doc_key`.

    kept_text holds the kept words joined by one space; it is null where nothing was
    removed (the text stays as it is). Defined cases: a null text has no words; a null id
    counts as the smallest; rows that share an id do not make each other's windows
    repeated, and equal rows get equal results; an empty table gives an empty result; only
    the two named columns are read, so further columns and their names do not matter.
    """
    keyed = doc_key(docs, id_col, text_col)
    return X.with_spans(keyed, repeated_spans(keyed)).mapInArrow(
        lean(_cut), "key_id long, key_digest int, text string, n_words long, n_removed long, kept_text string, kept_sha256 string").drop("text")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated windows cut from ``text_col`` (kept words joined by one space);
    documents without a repeated window keep their text unchanged. All columns stay."""
    key, digest, found = unused(docs, "__key_id", "__key_digest", "__spans")
    keyed = docs.select("*", F.coalesce(F.col(id_col).cast("long"), F.lit(-(2 ** 63))).alias(key),
                        F.xxhash64(text_col).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias(digest))
    spans = sized(repeated_spans(doc_key(docs, id_col, text_col)), "spans").select(
        F.col("key_id").alias(key), F.col("key_digest").alias(digest), F.col("spans").alias(found))
    joined = keyed.join(spans, [key, digest], "left").drop(key, digest)
    at, place = docs.columns.index(text_col), joined.columns.index(found)
    kinds = docs.schema

    def cut(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            for k, raw in enumerate(b.column(place).to_pylist()):
                if raw and texts[k] is not None:
                    words = [x.decode() for x in texts[k].encode().split()]
                    drop = in_spans(X.read_spans(raw), len(words))
                    texts[k] = " ".join(x for x, d in zip(words, drop, strict=True) if not d)
            cols = [b.column(j) for j in range(b.num_columns) if j != place]
            cols[at] = pa.array(texts, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in kinds])
    return joined.mapInArrow(lean(cut), kinds)
