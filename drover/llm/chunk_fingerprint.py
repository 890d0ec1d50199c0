"""Document fingerprints by content-defined chunking.

A gear hash over the last WINDOW bytes decides where a text is cut, so a boundary depends
on the bytes before it alone and survives insertions and deletions elsewhere. Chunking is
normalised: up to NORMAL bytes a boundary needs more zero bits, beyond that fewer, so chunk
lengths gather around NORMAL; a chunk ends at MOST bytes in any case and no chunk but the
last is shorter than LEAST.

A fingerprint is the set of a text's chunk digests with the chunks' lengths. The
containment of one fingerprint in another is the length of its chunks that the other holds
too, over the length of all its chunks.

:func:`neighbours` lines documents up in order of descending id, each beside the next, with
one shuffle of the texts: ranges of ids become partitions, and the first document of a
range goes to the range before it as well.
"""

from __future__ import annotations

import binascii
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from drover.llm.common import SLICE_BYTES, ship

LEAST, NORMAL, MOST = 16, 48, 192
#: Bytes that the gear hash looks back on.
WINDOW = 16
#: Zero bits that a boundary needs before and after NORMAL bytes (2**6 = 64 and 2**4 = 16
#: bytes on average).
STRICT, LOOSE = 6, 4
#: One 32-bit number for each byte value.
GEAR = np.random.default_rng(20).integers(0, 2 ** 32, 256, dtype=np.uint32)
#: A set's entry: eight bytes of digest, one of length.
ENTRY = 9


def gear_hash(data: np.ndarray) -> np.ndarray:
    """Hash at every byte of the WINDOW bytes that end there (fewer at the start): the sum
    of the bytes' numbers, each shifted by its distance, by doubling steps."""
    h = GEAR[data]
    step = 1
    while step < WINDOW:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


def boundaries(data: np.ndarray) -> list[int]:
    """Ends of the chunks of a text; the last is the text's length (an empty text has none)."""
    n = len(data)
    if not n:
        return []
    high = gear_hash(data) >> np.uint32(32 - STRICT)
    # a loose boundary needs zeros in the highest LOOSE bits only
    loose = np.flatnonzero(high >> np.uint32(STRICT - LOOSE) == 0) + 1
    strict = loose[high[loose - 1] == 0].tolist()
    loose = loose.tolist()
    strict.append(n + MOST)
    loose.append(n + MOST)
    out, at, i, j = [], 0, 0, 0
    while n - at > LEAST:
        i = bisect_left(strict, at + LEAST, i)
        end = strict[i]
        if end > at + NORMAL:
            j = bisect_left(loose, at + NORMAL + 1, j)
            end = min(loose[j], at + MOST)
        if end >= n:
            break
        out.append(end)
        at = end
    out.append(n)
    return out


def chunk_set(raw: bytes) -> dict[int, int]:
    """{digest: length} of a text's distinct chunks."""
    ends = boundaries(np.frombuffer(raw, np.uint8))
    digest = xxhash.xxh3_64_intdigest
    return {digest(raw[a:b]): b - a for a, b in zip([0, *ends[:-1]], ends)}


def encoded(chunks: dict[int, int]) -> str:
    """A fingerprint as text: base64 of the entries in order of digest ('' for no chunk)."""
    if not chunks:
        return ""
    digests = np.fromiter(chunks.keys(), np.uint64, len(chunks))
    order = np.argsort(digests)
    out = np.zeros((len(chunks), ENTRY), np.uint8)
    out[:, :8] = digests[order].astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 8] = np.fromiter(chunks.values(), np.uint8, len(chunks))[order]
    return binascii.b2a_base64(out.tobytes(), newline=False).decode()


def decoded(fingerprint: str | None) -> dict[int, int]:
    raw = np.frombuffer(binascii.a2b_base64(fingerprint or ""), np.uint8).reshape(-1, ENTRY)
    return dict(zip(raw[:, :8].copy().view(">u8").ravel().tolist(), raw[:, 8].tolist(), strict=True))


def containment_of(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of a's chunk length that lies in chunks of b; two empty sets are alike (1.0),
    an empty set and another are not (0.0)."""
    if not a:
        return 0.0 if b else 1.0
    return sum(a[d] for d in a.keys() & b.keys()) / sum(a.values())


def containment(a: Column, b: Column) -> Column:
    """:func:`containment_of` for two fingerprint columns."""
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([containment_of(decoded(s), decoded(t)) for s, t in zip(x, y, strict=True)], dtype="float64")
    return F.pandas_udf(run, "double")(a, b)


def _texts(col: pa.Array) -> Iterator[bytes]:
    """Texts one at a time (null: empty), not all of a batch at once."""
    for i in range(len(col)):
        v = col[i]
        yield v.as_buffer().to_pybytes() if v.is_valid else b""


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about SLICE_BYTES by ``weight`` of a row."""
    out, size = [], 0
    for r in rows:
        out.append(r)
        size += weight(r)
        if size >= SLICE_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) for every row, in one pass without a shuffle.

    Defined cases: null and empty texts have n_chars 0 and the fingerprint ''; equal texts
    have equal fingerprints; null ids stay null; repeated rows are all returned; an empty
    table gives an empty result; only the two named columns are read.
    """
    ship(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string())])

    def rows(batches):
        for b in batches:
            for i, raw in zip(b.column("doc_id").to_pylist(), _texts(b.column("text")), strict=True):
                yield i, len(raw.decode()), encoded(chunk_set(raw))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        lambda batches: _batches(rows(batches), schema, lambda r: 64 + len(r[2])), "doc_id long, n_chars long, fingerprint string")


# ------------------------------------------------------------------ neighbours by descending id
class Ranges:
    """Ranges of ids in order of descending id (null last), as buckets 0, 1, 2, ...

    Built from the id column alone: quantiles give up to ``n`` bounds. An id that fills
    several ranges gets as many buckets of its own, equal stretches of the texts' digests;
    null ids are treated alike."""

    def __init__(self, ids: DataFrame, n: int):
        total, known = ids.agg(F.count(F.lit(1)), F.count("id")).first()
        cuts = [int(c) for c in ids.where("id is not null").select(F.col("id").cast("double").alias("d")).approxQuantile(
            "d", [k / n for k in range(n)], 0.25 / n)] if known else []
        #: (id, buckets) of ids with buckets of their own; a null id is None
        self.own: dict[int | None, tuple[int, int]] = {}
        lows, numbers, at = [], [], 0
        for b in sorted(set(cuts), reverse=True):
            # quantiles are doubles, so an id beyond 2**53 is only near its bound and stays unsplit
            k = cuts.count(b)
            lows.append(b)
            numbers.append(at)
            at += 1
            if k > 1:
                self.own[b] = (at, k)
                at += k
        if total > known:
            self.own[None] = (at, max(1, round(n * (total - known) / total)))
            at += self.own[None][1]
        if lows:
            lows[-1] = -(2 ** 63)     # ids under the last bound
        self.lows, self.numbers, self.n = np.array(lows[::-1], np.int64), np.array(numbers[::-1], np.int64), at

    def bucket(self, ids: pd.Series, digests: pd.Series) -> np.ndarray:
        null = ids.isna().to_numpy()
        value = ids.fillna(0).astype("int64").to_numpy()
        out = self.numbers[np.searchsorted(self.lows, value, side="right") - 1] if len(self.lows) else np.zeros(len(value), np.int64)
        for i, (first, k) in self.own.items():
            mine = null if i is None else ~null & (value == i)
            if mine.any():
                share = (digests.to_numpy()[mine].astype(np.float64) / 2.0 ** 64 + 0.5) * k
                out[mine] = first + np.clip(share.astype(np.int64), 0, k - 1)
        return out


def _id_series(ids: pd.Series) -> pd.Series:
    return ids if ids.dtype == "Int64" else ids.astype("Int64")


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, extra, id, digest, text), a partition per bucket, sorted so that each row
    that is not ``extra`` is followed by its next document: in order of descending id (null
    last; rows that share an id: by digest of the text), and after the last the first again.
    ``extra`` rows end a partition and only serve as such a next document.

    The texts are shuffled once. What the driver sees is a few numbers per bucket."""
    spark = ship(docs.sparkSession)
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    ranges = Ranges(keyed.select("id"), max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    where = F.pandas_udf(lambda i, d: pd.Series(ranges.bucket(_id_series(i), d)).astype("int32"), "int")
    # the first document of each bucket: by id; among rows that share an id, by digest
    own = list(ranges.own)
    shared = F.lit(False)
    for i in own:
        shared = shared | F.col("id").eqNullSafe(F.lit(i))
    heads = {r.bucket: (r.id, None) for r in keyed.where(~shared).groupBy(where("id", F.lit(0).cast("long")).alias("bucket")).agg(
        F.max("id").alias("id")).collect()}
    if own:
        heads |= {r.bucket: (None, r.digest) for r in keyed.where(shared).groupBy(where("id", "digest").alias("bucket")).agg(
            F.min("digest").alias("digest")).collect()}
    order = sorted(heads)
    before = {b: order[k - 1] for k, b in enumerate(order)}

    def place(ids: pd.Series, digests: pd.Series) -> pd.DataFrame:
        ids = _id_series(ids)
        b = ranges.bucket(ids, digests)
        extra = [before[k] if (i == heads[k][0] if heads[k][1] is None else d == heads[k][1]) else None
                 for k, i, d in zip(b.tolist(), ids.tolist(), digests.tolist(), strict=True)]
        return pd.DataFrame({"bucket": b.astype("int32"), "before": pd.Series(extra, dtype="Int32")})
    placed = keyed.withColumn("at", F.pandas_udf(place, "bucket int, before int")("id", "digest"))
    row = lambda b, extra: F.struct(b.alias("bucket"), F.lit(extra).alias("extra"))
    return placed.select(
        F.explode(F.when(F.col("at.before").isNull(), F.array(row(F.col("at.bucket"), False)))
                  .otherwise(F.array(row(F.col("at.bucket"), False), row(F.col("at.before"), True)))).alias("to"), "id", "digest", "text"
    ).select("to.bucket", "to.extra", "id", "digest", "text").repartitionById(max(1, ranges.n), F.col("bucket")).sortWithinPartitions(
        "bucket", "extra", F.desc_nulls_last("id"), "digest")


def edited(text: str, other: str) -> str:
    """``text`` whose last half (rounded down) gives way to the first as many code points of ``other``."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def neighbour_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited,
    near_next) for every row: its fingerprint, that of the text with its last half replaced
    by the beginning of the next document (:func:`neighbours`), and the containment of its
    fingerprint in that of the edited text and in that of the next document.

    Defined cases: null and empty texts are empty, with the fingerprint '' and likeness 1.0
    to an empty text and 0.0 to others; null ids come last; rows that share an id are
    ordered by their texts' digests, and equal rows follow one another; an only document is
    its own next; an empty table gives an empty result; only the two named columns are read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_text", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def rows(batches):
        held = None         # the document that waits for its next one
        for b in batches:
            for i, extra, raw in zip(b.column("id").to_pylist(), b.column("extra").to_pylist(), _texts(b.column("text")), strict=True):
                if extra and held is None:
                    continue        # a further extra row
                text, chunks = raw.decode(), chunk_set(raw)
                if held is not None:
                    own_id, own_text, own = held
                    new = edited(own_text, text)
                    its = chunk_set(new.encode())
                    yield own_id, len(own_text), new, encoded(own), encoded(its), containment_of(own, its), containment_of(own, chunks)
                held = None if extra else (i, text, chunks)
    return neighbours(docs, id_col, text_col).mapInArrow(
        lambda batches: _batches(rows(batches), schema, lambda r: 200 + 4 * len(r[2])),
        "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
