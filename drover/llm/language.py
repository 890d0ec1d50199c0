"""Language identification: sparse multinomial logistic regression on TF-IDF character
n-grams, trained with follow-the-regularised-leader and elastic-net penalties, then
calibrated by a temperature.

Features are the 1- to 3-grams of the lower-cased whole text under exact keys (up to three
code points fit in 63 bits), with sublinear term frequency, inverse document frequency over
all labelled documents (counted by Spark) and unit length. The vocabulary is every n-gram of
the documents that the classifier is fitted on, a sample of at most SAMPLE labelled documents;
the temperature is chosen on at most SAMPLE / 4 further ones. Both bounds are parameters. Other
n-grams have no weight and do not count in a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from drover.llm.common import ship, text_buffer, written

ORDERS = (1, 2, 3)
SAMPLE = 4000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
#: Characters of which n-grams are formed together, and counters held at once.
_CHARS = 1 << 19
_COUNTERS = 1 << 22


def gram_keys(chars: np.ndarray, k: int) -> np.ndarray:
    """The k-grams of code points as exact keys: 21 bits a code point plus one, never 0."""
    n = len(chars) - k + 1
    key = np.zeros(max(n, 0), np.int64)
    for j in range(k if n > 0 else 0):
        key |= (chars[j:j + n].astype(np.int64) + 1) << (21 * j)
    return key


def _chars(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, key) of every n-gram occurrence, in pieces of bounded size. Lower-cased
    texts are joined up to the bound; a longer text is cut, its n-grams across a cut included."""
    run: list[tuple[int, str]] = []
    size = 0

    def together():
        n = np.array([len(t) for _, t in run])
        chars, doc = _chars("".join(t for _, t in run)), np.repeat(np.array([i for i, _ in run]), n)
        keys, docs = [], []
        for k in ORDERS:
            key = gram_keys(chars, k)
            same = doc[:len(key)] == doc[k - 1:] if k > 1 else slice(None)
            keys.append(key[same])
            docs.append(doc[:len(key)][same])
        return np.concatenate(docs), np.concatenate(keys)

    for i, t in enumerate(texts):
        t = t.lower()
        if size + len(t) > _CHARS and run:
            yield together()
            run, size = [], 0
        if len(t) <= _CHARS:
            run.append((i, t))
            size += len(t)
            continue
        for s in range(0, len(t), _CHARS):
            part = _chars(t[s:s + _CHARS + max(ORDERS) - 1])
            key = np.concatenate([gram_keys(part, k)[:_CHARS] for k in ORDERS])
            yield np.full(len(key), i), key
    if run:
        yield together()


class Vocabulary:
    """The places of known n-grams: an open-addressing table of their exact keys."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.bits = max(4, int(4 * len(self.keys)).bit_length())
        self.slots, self.at = np.zeros(1 << self.bits, np.int64), np.zeros(1 << self.bits, np.int32)
        todo = np.arange(len(self.keys))
        slot = self._slot(self.keys)
        while len(todo):
            free = self.slots[slot[todo]] == 0
            first = np.unique(slot[todo[free]], return_index=True)[1]     # one key a free slot
            put = todo[free][first]
            self.slots[slot[put]], self.at[slot[put]] = self.keys[put], put
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def __len__(self) -> int:
        return len(self.keys)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 for unknown ones."""
        slot = self._slot(keys)
        found = self.slots[slot]
        out = np.where(found == keys, self.at[slot], -1)
        todo = np.flatnonzero((found != keys) & (found != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.slots[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.at[slot[todo[hit]]]
            todo = todo[~hit & (found != 0)]
        return out

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, place, occurrences) of the known n-grams, sorted by document and place."""
        total = np.zeros(len(texts) * len(self), np.int64)
        for doc, key in pieces(texts):
            place = self.places(key)
            known = place >= 0
            total += np.bincount(doc[known] * len(self) + place[known], minlength=len(total))
        at = np.flatnonzero(total)
        return at // max(1, len(self)), at % max(1, len(self)), total[at]


def groups(col: pa.Array, size: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in groups of at most ``size`` texts and a bounded size (or one text)."""
    data, off = text_buffer(col)
    i = 0
    while i < len(off) - 1:
        j = max(i + 1, min(i + size, int(np.searchsorted(off, off[i] + 4 * _CHARS, side="right")) - 1))
        yield i, [data[a:b].tobytes().decode() for a, b in zip(off[i:j], off[i + 1:j + 1], strict=True)]
        i = j


def group_size(vocabulary: Vocabulary) -> int:
    return max(1, min(256, _COUNTERS // max(1, len(vocabulary))))


def _sample_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of a task's documents."""
    seen = np.zeros(0, np.int64)
    for b in batches:
        for _, texts in groups(b.column("text"), 256):
            for _, key in pieces(texts):
                seen = np.union1d(seen, key)
    yield pa.RecordBatch.from_arrays([pa.array(seen)], names=["key"])


def _frequencies(shared):
    """Documents that hold each known n-gram, and last the documents: a row per place and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        total = np.zeros(len(v) + 1, np.int64)
        for b in batches:
            for _, texts in groups(b.column("text"), group_size(v)):
                total[:-1] += np.bincount(v.counts(texts)[1], minlength=len(v))
                total[-1] += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "n"])
    return run


def weighted(n_docs: int, doc: np.ndarray, place: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of (document, place) entries; each document has unit length."""
    x = np.log1p(counts) * idf[place]
    return x / np.maximum(np.sqrt(np.bincount(doc, x * x, minlength=n_docs)), 1e-12)[doc]


@dataclass
class LanguageModel:
    langs: list[str]
    vocabulary: Vocabulary
    idf: np.ndarray
    weights: np.ndarray     # [n-grams + 1, languages]; the last row is the bias
    temperature: float = 1.0

    def logits(self, texts: list[str]) -> np.ndarray:
        doc, place, n = self.vocabulary.counts(texts)
        x = weighted(len(texts), doc, place, n, self.idf)
        return np.stack([np.bincount(doc, x * self.weights[place, c], minlength=len(texts)) + self.weights[-1, c]
                         for c in range(len(self.langs))], axis=1)

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, places: int) -> np.ndarray:
    """FTRL-proximal with per-coordinate rates over sparse rows (places, values): a
    coordinate's weight is zero until its gradients outweigh L1, and L2 shrinks it."""
    z, n = np.zeros((places + 1, classes)), np.zeros((places + 1, classes))
    rng = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, v = np.append(rows[i][0], places), np.append(rows[i][1], 1.0)[:, None]
            w = _proximal(z[at], n[at])
            s = (v * w).sum(axis=0)
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = v * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return _proximal(z, n)


def _proximal(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least cross-entropy among steps from 1/20 to 20."""
    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]).mean())
    return float(min(np.geomspace(0.05, 20, 121), key=loss)) if len(y) else 1.0


def train(labelled: DataFrame, sample: int = SAMPLE) -> LanguageModel | None:
    """``labelled``: (text, lang, pick), lang not null; ``pick`` (long) orders the documents
    for the sample, smallest first. None if there is no labelled document."""
    spark = ship(labelled.sparkSession)
    # the sample: the smallest picks, at most 5/4 x sample rows
    bound = sample + sample // 4
    cut = labelled.select("pick").orderBy("pick").limit(bound).agg(F.max("pick")).first()[0]
    if cut is None:
        return None
    chosen = written(labelled.where(F.col("pick") <= F.lit(cut)).orderBy("pick").limit(bound), "language-sample")
    keys = chosen.select("text").mapInArrow(_sample_keys, "key long").distinct().toPandas()["key"].to_numpy(np.int64)
    vocabulary = Vocabulary(keys)
    known = spark.sparkContext.broadcast(vocabulary)
    # one row per place and task at most; summed by Spark
    n = labelled.select("text").mapInArrow(_frequencies(known), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(len(vocabulary) + 1)
    df[n["place"].to_numpy(np.int64)] = n["n"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = known.value
        for b in batches:
            places, values = [], []
            for _, texts in groups(b.column("text"), group_size(v)):
                doc, place, counts = v.counts(texts)
                x, ends = weighted(len(texts), doc, place, counts, idf), np.searchsorted(doc, np.arange(1, len(texts)))
                places += [p.astype(np.int32).tobytes() for p in np.split(place, ends)]
                values += [p.tobytes() for p in np.split(x, ends)]
            yield pa.RecordBatch.from_arrays([b.column("pick"), b.column("lang"), pa.array(places, pa.binary()), pa.array(values, pa.binary())],
                                             names=["pick", "lang", "places", "values"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(tuple(r.values()) for b in batches for r in b.to_pylist())
        names = sorted({r[1] for r in rows})
        y = np.array([names.index(r[1]) for r in rows])
        x = [(np.frombuffer(p, np.int32), np.frombuffer(v)) for _, _, p, v in rows]
        fold = np.arange(len(x)) % 5 != 0 if len(x) >= 10 else np.ones(len(x), bool)
        w = ftrl([x[i] for i in np.flatnonzero(fold)], y[fold], len(names), len(idf))
        held = [x[i] for i in np.flatnonzero(~fold)]
        logits = np.array([v @ w[p] + w[-1] for p, v in held]).reshape(len(held), len(names))
        yield pa.RecordBatch.from_arrays([pa.array([names]), pa.array([w.tobytes()], pa.binary()), pa.array([best_temperature(logits, y[~fold])])],
                                         names=["langs", "weights", "temperature"])
    rows = chosen.mapInArrow(features, "pick long, lang string, places binary, values binary")
    one = rows.coalesce(1).mapInArrow(fit, "langs array<string>, weights binary, temperature double").first()
    return LanguageModel(one["langs"], vocabulary, idf, np.frombuffer(bytes(one["weights"])).reshape(len(idf) + 1, -1), one["temperature"])


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            lang: list[str] = ["und"] * b.num_rows
            score = np.zeros(b.num_rows)
            if m is not None:
                for row, texts in groups(b.column("text"), group_size(m.vocabulary)):
                    p = m.probabilities(m.logits(texts))
                    best = p.argmax(axis=1)
                    for i, t in enumerate(texts):
                        if any(map(str.isalpha, t)):
                            lang[row + i], score[row + i] = m.langs[best[i]], min(1.0, float(p[i, best[i]]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang), pa.array(score)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``; learned from rows
    that are not ``held_out`` and have a text and a language.

    Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is
    every text if nothing could be learned; null languages and held-out rows are never
    learned from; a null ``held_out`` counts as held out; repeated rows get equal results;
    an empty table gives an empty result; only the named columns are read.
    """
    spark = ship(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                    F.coalesce(held_out, F.lit(True)).alias("held_out"))
    labelled = d.where("not held_out and lang is not null and text is not null").select(
        "text", "lang", F.xxhash64("doc_id", F.lit("sample")).alias("pick"))
    shared = spark.sparkContext.broadcast(train(labelled, sample))
    return d.select("doc_id", "text", "held_out").mapInArrow(
        _predict(shared), f"doc_id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, lang_pred string, score double")
