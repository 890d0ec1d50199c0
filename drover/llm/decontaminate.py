"""Benchmark decontamination as a prefix-filtered join of word windows.

An item's windows are its runs of ten words (an item of fewer words is one window). A text
contains a window only if it contains its rarest word, so that word alone is the window's
necessary prefix (containment of all its words). Steps:

1. count the items' words over all texts (:func:`word_frequencies`);
2. order each window's words by rarity; index windows by their rarest word, with its
   place in the window and the window's length;
3. join texts with the index on that word; the place bounds where the window would begin
   and end in the text (positional and length bounds);
4. verify the window word by word at that place. Words are compared by 64-bit hashes.

The index of a benchmark is split into blocks of at most BLOCK_BYTES; each block is
broadcast in turn against all texts, so a benchmark of any size has bounded broadcasts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from drover.llm.common import doc_key, lean, ship, text_slices, written
from drover.llm.words import ALNUM, merge_spans, words_of

WINDOW = 10
#: Windows per broadcast block: each has up to WINDOW hashes and three numbers.
BLOCK_BYTES = 24 << 20


def _windows(window: int):
    """Distinct words are counted later; here one row per item window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("item_id").to_pylist()
            out_id, out_words = [], []
            for row, data, off in text_slices(b.column("text")):
                w = words_of(data, off, ALNUM)
                for k in range(len(off) - 1):
                    h = w.hash[w.first[k]:w.first[k + 1]].view(np.int64)
                    if len(h):
                        for i in range(max(1, len(h) - window + 1)):
                            out_id.append(ids[row + k])
                            out_words.append(h[i:i + window])
            yield pa.RecordBatch.from_arrays([pa.array(out_id, pa.string()), pa.array(out_words, pa.list_(pa.int64()))], names=["item_id", "words"])
    return run


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id string, words array<long>): every window once per item, words as hashes."""
    ship(items.sparkSession)
    return items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text")).mapInArrow(
        _windows(window), "item_id string, words array<long>").distinct()


def word_frequencies(keyed: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """How often each of ``wanted`` (sorted hashes) occurs in all texts."""
    shared = keyed.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = shared.value, np.zeros(len(shared.value), np.int64)
        for b in batches:
            for _, data, off in text_slices(b.column("text")):
                _, number = _lookup(words, words_of(data, off, ALNUM).hash)
                total += np.bincount(number, minlength=len(words))
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["number", "n"])
    rows = keyed.select("text").mapInArrow(run, "number long, n long").groupBy("number").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(wanted), np.int64)
    out[rows["number"].to_numpy(np.int64)] = rows["n"]
    return out


def _lookup(table: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices into h, numbers in the sorted ``table``) of the hashes that it holds. A
    bit table over 16 hash bits passes over most words first."""
    seen = np.zeros(1 << 16, bool)
    seen[(table >> np.uint64(48)).astype(np.int64)] = True
    at = np.flatnonzero(seen[(h >> np.uint64(48)).astype(np.int64)])
    k = np.searchsorted(table, h[at])
    k[k == len(table)] = 0
    ok = table[k] == h[at] if len(table) else np.zeros(len(at), bool)
    return at[ok], k[ok]


class Block:
    """Index of some windows by their rarest word."""

    def __init__(self, items: list[str], words: list[np.ndarray], rare_at: np.ndarray):
        rare = np.array([w[p] for w, p in zip(words, rare_at, strict=True)], np.uint64)
        order = np.argsort(rare, kind="stable")
        self.items = [items[k] for k in order]
        self.length = np.array([len(words[k]) for k in order], np.int64)
        self.at = rare_at[order]
        self.words = np.zeros((len(words), max((len(w) for w in words), default=1)), np.uint64)
        for i, k in enumerate(order):
            self.words[i, :len(words[k])] = words[k]
        self.rare, first = np.unique(rare[order], return_index=True)
        self.first = np.append(first, len(order))

    def occurrences(self, h: np.ndarray, doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, window) of every occurrence; ``first``: where each
        document's words begin."""
        at, number = _lookup(self.rare, h)
        count = self.first[number + 1] - self.first[number]
        which = np.repeat(np.arange(len(at)), count)
        win = self.first[number][which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        begin = at[which] - self.at[win]
        d = doc[at[which]]
        ok = np.flatnonzero((begin >= first[d]) & (begin + self.length[win] <= first[d + 1]))
        for j in range(self.words.shape[1]):
            if not len(ok):
                break
            inside = j < self.length[win[ok]]
            w, b = win[ok], begin[ok]
            ok = ok[~inside | (self.words[w, j] == h[np.minimum(b + j, len(h) - 1)])]
        return begin[ok], win[ok]


def blocks(items: DataFrame, keyed: DataFrame, window: int = WINDOW) -> Iterator[Block]:
    """The benchmark's index in blocks. Item windows are numbered and read a block at a
    time; only one block is in the driver's memory."""
    rows = written(item_windows(items, window), "item-windows")
    size = max(1, BLOCK_BYTES // (8 * window + 64))
    n = -(-rows.count() // size)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(n)) == k).toPandas()
        if len(part):
            words = [np.asarray(w, np.int64).view(np.uint64) for w in part["words"]]
            wanted = np.unique(np.concatenate(words))
            freq = word_frequencies(keyed, wanted)
            # rarest word of each window; the hash breaks ties
            rare = np.array([min(range(len(w)), key=lambda i: (freq[np.searchsorted(wanted, w[i])], w[i])) for w in words])
            yield Block(part["item_id"].tolist(), words, rare)


def _hits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for b in batches:
            ids, dig = b.column("key_id").to_pylist(), b.column("key_digest").to_pylist()
            out: list[tuple] = []
            for row, data, off in text_slices(b.column("text")):
                w = words_of(data, off, ALNUM)
                doc = w.docs()
                begin, win = block.occurrences(w.hash, doc, w.first)
                d = doc[begin] if len(begin) else begin
                for k in range(len(off) - 1):
                    spans, names, n = b"", [], 0
                    mine = np.flatnonzero(d == k) if len(d) else ()
                    if len(mine):
                        lo = begin[mine] - w.first[k]
                        union = merge_spans(np.stack([lo, lo + block.length[win[mine]]], axis=1))
                        n, spans = int(np.diff(union, axis=1).sum()), union.astype("<i4").tobytes()
                        names = sorted({block.items[x] for x in win[mine]} - {None})
                    out.append((ids[row + k], dig[row + k], int(w.counts[k]), n, spans, names))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True) if out else [[]] * 6,
                (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string())), strict=True)],
                names=["key_id", "key_digest", "n_words", "n_hit", "spans", "items"])
    return run


SCHEMA = "key_id long, key_digest int, n_words long, n_hit long, spans binary, items array<string>"


def _covered(parts: pd.Series) -> pd.Series:
    """Words in the union of several blocks' spans."""
    def one(spans) -> int:
        s = np.concatenate([np.frombuffer(p, "<i4").reshape(-1, 2) for p in spans if p] or [np.zeros((0, 2), "<i4")])
        return int(np.diff(merge_spans(s.astype(np.int64)), axis=1).sum())
    return parts.map(one)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key_id, key_digest, n_words, n_hit, items) for every row of ``docs``; key_id and
    key_digest are those of :func:`doc_key`, items the sorted ids (as strings) of the
    items that occur.

    Defined cases: null texts have no words (documents: clean; items: no window); null
    item ids are left out of ``items`` but their windows count as hits; repeated items
    count once per id; equally rare words are ordered by hash; repeated documents are all
    returned; without documents the result is empty, without items all are clean; only the
    named columns are read.
    """
    keyed = doc_key(docs, id_col, text_col)
    spark = docs.sparkSession
    found = [keyed.mapInArrow(lean(_hits(spark.sparkContext.broadcast(b))), SCHEMA) for b in
             blocks(items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")), keyed, window)]
    if not found:
        found = [keyed.mapInArrow(_hits(spark.sparkContext.broadcast(Block([], [], np.zeros(0, np.int64)))), SCHEMA)]
    if len(found) == 1:
        return found[0].drop("spans")
    # several blocks: the blocks' finds of one document meet (repeated rows stay apart by number)
    each = None
    for f in found:
        w = written(f, "hits")
        each = w if each is None else each.unionByName(w)
    copies = keyed.groupBy("key_id", "key_digest").agg(F.count(F.lit(1)).alias("copies"))
    one = each.groupBy("key_id", "key_digest").agg(
        F.max("n_words").alias("n_words"), F.collect_set("spans").alias("spans"), F.flatten(F.collect_set("items")).alias("items"))
    return one.join(copies, ["key_id", "key_digest"]).select(
        "key_id", "key_digest", "n_words", F.pandas_udf(_covered, "long")("spans").alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
        F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")


def items_digest(items):
    """SHA-256 of the comma-joined sorted item ids."""
    return F.sha2(F.array_join(items, ","), 256)
