"""Fill-in-middle transformation: prefix, middle and suffix of a text, re-ordered with
sentinels, with cuts at unit boundaries.

A text's UTF-8 bytes are taken in blocks of BLOCK bytes. A Fenwick tree over the blocks
holds how many units end and how many code points begin in each. To cut after k units, a
binary-lifting descent of the tree gives the block where the k-th unit ends, and on the way
the code points before that block; only that block is then searched. The bytes of a text
are never decoded, and no list of its units is made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from drover.llm.common import ship, text_slices

BLOCK = 512
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
UNITS = ("lines", "characters")


class UnitTree:
    """Fenwick tree over the blocks of one text."""

    def __init__(self, text: np.ndarray, units: str = "lines", block: int = BLOCK):
        self.text, self.units, self.block = text, units, block
        begins = (text & 0xC0) != 0x80
        ends = text == 10 if units == "lines" else begins
        at = np.arange(0, len(text), block)
        self.blocks = len(at)
        count = lambda mask: np.concatenate(([0], np.cumsum(np.add.reduceat(mask, at, dtype=np.int64)))) if len(at) else np.zeros(1, np.int64)
        ended, points = count(ends), count(begins)
        self.n_chars = int(points[-1])
        #: units in the text; the last line may lack its line feed
        self.n_units = int(ended[-1]) + int(units == "lines" and len(text) > 0 and text[-1] != 10)
        self._ended = int(ended[-1])
        i = np.arange(self.blocks + 1)
        below = i - (i & -i)
        self._ends, self._points = (ended - ended[below]).tolist(), (points - points[below]).tolist()

    def descend(self, k: int) -> tuple[int, int, int]:
        """(block of the k-th unit's end, units that end before it, code points before it)."""
        at = seen = points = 0
        step = 1 << self.blocks.bit_length()
        while step:
            to = at + step
            if to <= self.blocks and seen + self._ends[to] < k:
                at, seen, points = to, seen + self._ends[to], points + self._points[to]
            step >>= 1
        return at, seen, points

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) of the first k units."""
        if k <= 0:
            return 0, 0
        if k >= self.n_units or k > self._ended:
            return len(self.text), self.n_chars
        at, seen, points = self.descend(k)
        lo = at * self.block
        if self.units == "characters":
            # the k-th code point ends where the next one begins, maybe in a later block
            part = self.text[lo:lo + self.block + 4]
            begins = np.flatnonzero((part & 0xC0) != 0x80)
            return lo + int(begins[k - seen]), k
        part = self.text[lo:lo + self.block]
        end = int(np.flatnonzero(part == 10)[k - seen - 1]) + 1
        return lo + end, points + int(np.count_nonzero((part[:end] & 0xC0) != 0x80))


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the SHA-256 of ``seed:doc_id`` (null id: nothing after the colon)."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return int(h[:8], 16), int(h[8:16], 16), int(h[16:24], 16), int(h[24:32], 16)


def transform(raw: bytes, doc_id: int | None, seed: int = 7, rate: int = 100, spm: int = 50,
              units: str = "lines") -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    tree = UnitTree(np.frombuffer(raw, np.uint8), units)
    n = tree.n_units
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not raw or any(s in raw for s in SENTINELS) or h3 % 100 >= rate:
        return n, "plain", None, None, raw
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    (i, prefix_chars), (j, upto) = tree.cut(a), tree.cut(b)
    prefix, middle, suffix = raw[:i], raw[i:j], raw[j:]
    if h4 % 100 < spm:
        return n, "spm", prefix_chars, upto - prefix_chars, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", prefix_chars, upto - prefix_chars, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                   ("middle_chars", pa.int64()), ("output", pa.binary())])


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, units: str = "lines",
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output string) for every row.

    ``rate`` per cent of the texts are transformed, ``spm`` per cent of those with the
    suffix first. ``units``: "lines" (with their line feeds) or "characters". One pass
    without a shuffle; a task holds one slice of its texts at a time.

    Defined cases: null and empty texts, and texts that contain a sentinel, are plain
    (output: the text, null as empty; no char counts); a null id draws from the seed alone;
    rows that share an id get the same draws; repeated rows get equal results; an empty
    table gives an empty result; only the two named columns are read.
    """
    if units not in UNITS:
        raise ValueError(f"units must be one of {UNITS}")
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for row, data, off in text_slices(b.column("text")):
                raw = data.tobytes()
                out = [(ids[row + i], *transform(raw[off[i]:off[i + 1]], ids[row + i], seed, rate, spm, units))
                       for i in range(len(off) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), ARROW, strict=True)], schema=ARROW).cast(TEXT)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


#: Output bytes are whole code points, so the column is valid text.
TEXT = ARROW.set(5, pa.field("output", pa.string()))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from; transformed texts hold no sentinel, so the
    three sentinels of an output are the only places to split at."""
    parts = F.split(output, "<P>|<S>|<M>", -1)
    return (F.when(form == "psm", F.concat(F.get(parts, 1), F.get(parts, 3), F.get(parts, 2)))
            .when(form == "spm", F.concat(F.get(parts, 2), F.get(parts, 3), F.get(parts, 1))).otherwise(output))
