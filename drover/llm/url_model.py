"""URL filter by the ratio of two character language models.

Rules on hosts and path prefixes decide some urls; those decisions are the labels. Two
variable-order Markov models, one of accepted and one of rejected urls, count every
character after contexts of up to ORDER characters. Their smoothed probabilities
(Witten-Bell: an order passes on weight by the number of its followers) give each url a
log-likelihood difference per character. A logistic calibration on labelled urls that the
models have not seen turns it into the probability of rejection; 0.5 and more is blocked.

All labelled urls are counted, by Spark, under exact keys: a gram of the highest order is
the character and the ORDER before it, nine bits each, and holds its lower orders and all
contexts. The counts stay a Spark table. If they are measured to be at most MODEL_BYTES,
their arrays are broadcast; else the urls' grams, distinct per block of urls, join them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from drover.llm.common import BROADCAST_BYTES, ship, text_slices, written

ORDER = 4
BITS = 9
#: A gram's count takes 24 bytes; up to this many bytes of them are broadcast.
MODEL_BYTES = BROADCAST_BYTES
#: Urls of one block, where the counts are joined.
BLOCK = 10_000
#: Of the labelled urls, the share (one in FOLD) that is kept from the models for calibration.
FOLD = 5
#: Fixed rules: (verdict, host, path prefix).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to / ? # or the end, A-Z lower-cased; then
    up to ? or #. Both are empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls: the longest host and path
    prefix together; of equal length the first listed."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


# ------------------------------------------------------------------ the models
def grams(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The gram of every character: the character plus one in the lowest bits, then those
    before it (0 before the begin of a url). A url's end (byte 0) is predicted too. The
    lowest (k + 1) * BITS bits are the gram of order k, its bits above BITS its context."""
    n = np.diff(off)
    text = np.insert(data.astype(np.int64), off[1:], 0) + 1
    place = np.arange(len(text)) - np.repeat(off[:-1] + np.arange(len(n)), n + 1)
    out = text.copy()
    for k in range(1, ORDER + 1):
        out[k:] |= np.where(place[k:] >= k, text[:-k], 0) << (k * BITS)
    return out


def order_mask(k: int) -> int:
    return (1 << (k + 1) * BITS) - 1


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each gram in accepted and in rejected urls, slice by slice."""
    for b in batches:
        label = np.asarray(b.column("rejected").to_pylist(), bool)
        for row, data, off in text_slices(b.column("url")):
            kind = np.repeat(label[row:row + len(off) - 1], np.diff(off) + 1)
            key, at = np.unique(grams(data, off), return_inverse=True)
            n1 = np.bincount(at, weights=kind, minlength=len(key)).astype(np.int64)
            n = np.bincount(at, minlength=len(key))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n - n1), pa.array(n1)], names=["gram", "n0", "n1"])


class Counts:
    """Exact counts as sorted arrays; those of the lower orders are summed up on first use
    (in each process: only the grams travel)."""

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        self.gram, self.n, self.orders = gram, n, None

    def __reduce__(self):
        return Counts, (self.gram, self.n)

    def _sum(self) -> list[tuple]:
        """Per order: grams, their counts [2, ...]; contexts, their counts and followers."""
        out = []
        for k in range(ORDER + 1):
            g, at = np.unique(self.gram & order_mask(k), return_inverse=True)
            n = np.stack([np.bincount(at, weights=x, minlength=len(g)) for x in self.n])
            c, at = np.unique(g >> BITS, return_inverse=True)
            total = np.stack([np.bincount(at, weights=x, minlength=len(c)) for x in n])
            out.append((g, n, c, total, np.stack([np.bincount(at, weights=x > 0, minlength=len(c)) for x in n])))
        return out

    def scores(self, gram: np.ndarray) -> np.ndarray:
        """log P(rejected) - log P(accepted) of each gram's character after its context."""
        if not len(self.gram):
            return np.zeros(len(gram))
        self.orders = self.orders or self._sum()
        p = np.full((2, len(gram)), 1 / 257)
        for k, (g, n, c, total, followers) in enumerate(self.orders):
            own = gram & order_mask(k)
            i, has = _find(g, own)
            j, known = _find(c, own >> BITS)
            m, t = total[:, j] * known, followers[:, j] * known
            p = np.where(m > 0, (n[:, i] * has + t * p) / np.maximum(m + t, 1), p)
        return np.log(p[1]) - np.log(p[0])


def _find(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return at, keys[at] == values


def _differences(key: np.ndarray, score: np.ndarray, own: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Per url: mean over its grams ``own`` of the scores of the sorted ``key``."""
    length = np.diff(off) + 1
    return np.add.reduceat(score[np.searchsorted(key, own)], off[:-1] + np.arange(len(length))) / length if len(length) else np.zeros(0)


@dataclass
class UrlModel:
    """The counts as a table (gram, n0, n1) and, if they are few, as arrays (also shared
    with the executors); then the calibration."""

    table: DataFrame
    counts: Counts | None = None
    shared: object = None
    weight: float = 1.0
    bias: float = 0.0

    def differences(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Per url: mean over characters of log P(rejected) - log P(accepted)."""
        own = grams(data, off)
        key = np.unique(own)
        return _differences(key, self.counts.scores(key), own, off)

    def rejection(self, differences: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weight * differences + self.bias, -60, 60)))

    def scored(self, d: DataFrame) -> DataFrame:
        """``d`` with :meth:`differences` of its column url, by broadcast or by join."""
        if self.shared is not None:
            return d.mapInArrow(_scored(self.shared), f"{_ddl(d)}, difference double")
        return _joined(d, self.table)


def _ddl(d: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema)


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros(b.num_rows)
            for row, data, off in text_slices(b.column("url")):
                own = grams(data, off)
                key = np.unique(own)
                out[row:row + len(off) - 1] = _differences(key, shared.value.scores(key), own, off)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], names=[*b.schema.names, "difference"])
    return run


def gram_scores(wanted: DataFrame, table: DataFrame) -> DataFrame:
    """(gram, score) of the distinct grams ``wanted``, as :meth:`Counts.scores`. Orders 0 and
    1 and the contexts of order 2 are bounded by the alphabet and broadcast; the rest joins."""
    d = wanted.withColumns({"p0": F.lit(1 / 257), "p1": F.lit(1 / 257)})
    for k in range(ORDER + 1):
        g = table.groupBy(F.col("gram").bitwiseAND(F.lit(order_mask(k))).alias("own")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        c = g.groupBy(F.shiftright("own", BITS).alias("context")).agg(
            F.sum("n0").alias("m0"), F.sum("n1").alias("m1"), F.count_if(F.col("n0") > 0).alias("t0"), F.count_if(F.col("n1") > 0).alias("t1"))
        d = d.withColumn("own", F.col("gram").bitwiseAND(F.lit(order_mask(k)))).withColumn("context", F.shiftright("own", BITS))
        d = d.join(F.broadcast(g) if k < 2 else g, "own", "left").join(F.broadcast(c) if k < 3 else c, "context", "left")
        p = {f"p{i}": F.when(F.col(f"m{i}") > 0, (F.coalesce(F.col(f"n{i}"), F.lit(0)) + F.col(f"t{i}") * F.col(f"p{i}")) / (F.col(f"m{i}") + F.col(f"t{i}")))
             .otherwise(F.col(f"p{i}")) for i in (0, 1)}
        d = d.withColumns(p).select("gram", "p0", "p1")
    return d.select("gram", (F.log("p1") - F.log("p0")).alias("score"))


def _joined(d: DataFrame, table: DataFrame) -> DataFrame:
    """Equal rows are scored once. Urls meet in blocks; a gram joins once per block, so that
    a common one is as rare among the joined rows as any other in its block."""
    rows = d.groupBy(*d.columns).agg(F.count(F.lit(1)).alias("__n"))
    blocks = rows.count() // BLOCK + 1
    rows = rows.withColumn("__block", F.pmod(F.xxhash64(*d.columns), F.lit(blocks)))
    wanted = rows.select("__block", "url").groupBy("__block").applyInArrow(_wanted, "__block long, gram long")
    wanted = written(wanted, "url-grams")
    scores = gram_scores(wanted.select("gram").distinct(), table)
    met = rows.groupBy("__block").cogroup(wanted.join(scores, "gram").groupBy("__block")).applyInArrow(_met, f"{_ddl(rows)}, difference double")
    return met.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__n"))).select(*d.columns, "difference")


def _wanted(t: pa.Table) -> pa.Table:
    key = np.unique(np.concatenate([np.unique(grams(data, off)) for _, data, off in text_slices(t.column("url"))]))
    return pa.table({"__block": pa.array(np.full(len(key), t.column("__block")[0].as_py())), "gram": pa.array(key)})


def _met(t: pa.Table, scores: pa.Table) -> pa.Table:
    key, score = scores.column("gram").to_numpy(), scores.column("score").to_numpy()
    o = np.argsort(key)
    key, score = key[o], score[o]
    out = np.zeros(t.num_rows)
    for row, data, off in text_slices(t.column("url")):
        out[row:row + len(off) - 1] = _differences(key, score, grams(data, off), off)
    return t.append_column("difference", pa.array(out))


def train(labelled: DataFrame) -> UrlModel:
    """``labelled``: (url string, rejected boolean), not null. Models from four fifths by
    url hash, calibration on the rest."""
    spark = ship(labelled.sparkSession)
    labelled = labelled.withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLD)))
    table = written(labelled.where("fold <> 0").select("url", "rejected").mapInArrow(_counts, "gram long, n0 long, n1 long")
                    .groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "url-counts")
    model = UrlModel(table)
    if 24 * table.count() <= MODEL_BYTES:
        t = table.toArrow().sort_by("gram")
        model.counts = Counts(t.column("gram").to_numpy(), np.stack([t.column(c).to_numpy() for c in ("n0", "n1")]))
        model.shared = spark.sparkContext.broadcast(model.counts)

    # Calibration: a logistic curve over the difference, from counts in fine steps (a
    # bounded number whatever the input).
    held = model.scored(labelled.where("fold = 0").select("url", "rejected"))
    step = F.round(F.greatest(F.least(F.col("difference"), F.lit(8.0)), F.lit(-8.0)) * 256)
    t = held.groupBy(step.cast("int").alias("s"), "rejected").count().toPandas()
    model.weight, model.bias = calibrate(t["s"].to_numpy(float) / 256, t["rejected"].to_numpy(bool), t["count"].to_numpy(float))
    return model


def calibrate(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Weight and bias of a logistic curve by Newton steps, with a weak pull to (1, 0)."""
    w = np.array([1.0, 0.0])
    f = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -60, 60)))
        g = f.T @ (n * (p - y)) + 0.1 * (w - np.array([1.0, 0.0]))
        h = (f * (n * p * (1 - p))[:, None]).T @ f + 0.1 * np.eye(2)
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, p_rejected) for every row of ``pages``.

    Defined cases: a null url, or one without ``://``, has an empty host and path, fits no
    rule and is judged by the model (null as the empty text); if the rules label no url, or
    only one way, the models have nothing to tell apart and p_rejected is the calibrated
    prior; ids may be null or repeated; an empty table gives an empty result; only the two
    named columns are read.
    """
    host, path = url_parts(F.col("url"))
    d = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    d = d.withColumns({"rule": rule, "rule_verdict": verdict})
    model = train(d.where("rule is not null").select("url", (F.col("rule_verdict") == "block").alias("rejected")))
    line = F.lit(model.weight) * F.col("difference") + F.lit(model.bias)
    p = 1 / (1 + F.exp(-F.greatest(F.least(line, F.lit(60.0)), F.lit(-60.0))))
    return model.scored(d).withColumn("p_rejected", p).select(
        "page_id", "host", "path", "rule",
        F.coalesce(F.col("rule_verdict"), F.when(F.col("p_rejected") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "p_rejected")
