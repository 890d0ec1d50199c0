"""Source divergence audit: how far the term frequencies of a language's sources lie apart,
and which terms a source over-uses against its language.

A group is a (language, source). Frequencies are whole numbers: with a group's counts over
the kept terms of its language, p = 1 + floor(10**9 * (count + 2) / (N + 2 V)); a term's
price between frequencies p and q is floor((p - q)**2 / (p + q)).

* Terms are counted where the texts lie, in one pass; only counts are shuffled.
* Kept terms get numbers where their counts meet; a group's counts become arrays of (term number, count), sorted by
  number and cut into blocks of about BLOCK kept terms, so an array never grows with the
  vocabulary.
* One task per unordered pair of groups and block: the two arrays are co-grouped and merged
  by a galloping intersection. That prices the terms both hold and those only one side
  holds; the terms that neither holds all have one price, and their number follows from the
  vocabulary. A price is the same from both ends, so a pair is worked out once and reported
  both ways.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from drover.llm.common import ship, written

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
SMOOTH = 2
#: Kept terms per block of a group's array (16 bytes each).
BLOCK = 65_536
#: Distinct terms a map task counts before it sends the counts on.
FLUSH = 400_000
#: Long texts are split into terms a piece at a time.
PIECE = 2 << 20
#: Keys of the shorter array that one gallop covers.
STRIDE = 64

#: Letters stay (upper case as lower), bytes of other characters stay, the rest separates.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


# ------------------------------------------------------------------ counting
def term_pieces(raw: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """Terms of a text, a piece at a time; no term is cut."""
    flat = raw.translate(_LETTERS)
    at = 0
    while len(flat) - at > piece:
        cut = flat.rfind(b" ", at + 1, at + piece)
        if cut < 0:
            cut = flat.find(b" ", at + piece)
            if cut < 0:
                break
        yield flat[at:cut].split()
        at = cut
    yield flat[at:].split()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def sent():
        for (lang, source), (n, docs) in found.items():
            k = len(n)
            # the null term tells of the group even if it has no term
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (k + 1), pa.string()), pa.array([source] * (k + 1), pa.string()),
                pa.array([None, *n], pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()),
                pa.array([0, *(docs[t] for t in n)], pa.int64())], names=["lang", "source", "term", "n", "docs"])

    for b in batches:
        langs, sources = b.column("lang").to_pylist(), b.column("source").to_pylist()
        texts = b.column("text")
        for i in range(b.num_rows):
            n, docs = found.setdefault((langs[i], sources[i]), (Counter(), Counter()))
            size -= len(n)
            own: set[bytes] = set()
            for terms in term_pieces(texts[i].as_buffer().to_pybytes()):
                n.update(terms)
                own.update(terms)
            docs.update(own)
            size += len(n)
            if size >= FLUSH:
                yield from sent()
                found, size = {}, 0
    yield from sent()


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term per group, and
    one row with a null term for every group. Null values are ''. All rows of a language's
    term lie in one partition."""
    ship(docs.sparkSession)
    text = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    rows = docs.select(text(lang_col, "lang"), text(source_col, "source"), text(text_col, "text")).mapInArrow(
        _counts, "lang string, source string, term string, n long, docs long")
    # the tasks have counted already; a second count before the shuffle would save little
    return rows.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows of :func:`term_counts` of the kept terms, and the groups' rows: (lang, source,
    term, n, lang_n, id, first). ``id`` numbers the terms of a language, ``lang_n`` is the
    language's count, ``first`` marks one row per term. No further shuffle."""
    term = Window.partitionBy("lang", "term")
    return (counts.withColumn("row", F.monotonically_increasing_id())
            .withColumns({"lang_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term), "id": F.min("row").over(term)})
            .where(F.col("term").isNull() | (F.col("lang_docs") >= min_docs))
            .select("lang", "source", "term", "n", "lang_n", "id", (F.col("row") == F.col("id")).alias("first")))


# ------------------------------------------------------------------ prices
def frequency(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / total), exactly: long division by three digits at a
    time, so nothing exceeds 64 bits while total is under 9 * 10**15."""
    rest = count.astype(np.int64) + SMOOTH
    out = np.zeros(len(rest), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def galloping_intersection(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b (both sorted, without repeats) of the values they share. For
    each run of the shorter array, steps of doubling length from the last match find the
    stretch of the longer one that the run can lie in; only that stretch is searched."""
    if len(a) > len(b):
        j, i = galloping_intersection(b, a)
        return i, j
    mine, other, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for lo in range(0, len(a), STRIDE):
        run = a[lo:lo + STRIDE]
        end, step = at, 1
        while end < len(b) and b[end] < run[-1]:
            end, step = end + step, step * 2
        part = b[at:end + 1]
        if not len(part):
            break
        k = np.searchsorted(part, run)
        ok = np.flatnonzero(k < len(part))
        ok = ok[part[k[ok]] == run[ok]]
        mine.append(lo + ok)
        other.append(at + k[ok])
        at += int(k[-1])
    return np.concatenate(mine), np.concatenate(other)


def merged_price(ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray, total_a: int, total_b: int) -> tuple[int, int]:
    """(sum of the prices of the terms that either array holds, number of those terms)."""
    i, j = galloping_intersection(ids_a, ids_b)
    p, q = frequency(n_a, total_a), frequency(n_b, total_b)
    none = np.zeros(1, np.int64)
    p0, q0 = frequency(none, total_a), frequency(none, total_b)
    only_a, only_b = np.delete(p, i), np.delete(q, j)
    value = price(p[i], q[j]).sum() + price(only_a, q0).sum() + price(only_b, p0).sum()
    return int(value), len(ids_a) + len(ids_b) - len(i)


def _side(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    if not t.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(t.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", "counts"))


def _pair_task(key, left: pa.Table, right: pa.Table) -> pa.Table:
    either = left if left.num_rows else right
    value, held = merged_price(*_side(left), *_side(right), either.column("total_a")[0].as_py(), either.column("total_b")[0].as_py())
    return pa.table({"lang": [key[0].as_py()], "a": [key[1].as_py()], "b": [key[2].as_py()], "value": pa.array([value], pa.int64()),
                     "held": pa.array([held], pa.int64())})


def _p(n: str, total: str) -> Column:
    """The same frequency, by the same long division, of columns."""
    rest, digits = f"({n} + {SMOOTH})", "0"
    for _ in range(3):
        digits = f"({digits} * 1000 + ({rest} * 1000) div {total})"
        rest = f"(({rest} * 1000) % {total})"
    return F.expr(f"1 + {digits}")


# ------------------------------------------------------------------ the audit
def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, lang_col: str = "lang", source_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank). Part ``pair``: the other sources of the
    language by divergence; part ``term``: the ``top`` terms that the group uses more often
    than its language, by price. Ranks go by value, then by item.

    Defined cases: null text, lang and source are ''; groups without a kept term take part
    in pairs with counts of zero; a language without kept terms has pairs of value 0 and no
    terms; a language's only source has no pair; repeated rows are documents like any
    other; an empty table gives an empty result; only the three named columns are read.
    """
    rows = written(kept_counts(term_counts(docs, lang_col, source_col, text_col), min_docs), "kept-counts")
    kept = rows.where("term is not null")
    per_lang = kept.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_sum"))
    groups = written(
        rows.where("term is null").select("lang", "source")
        .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
        .join(per_lang, "lang", "left")
        .select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"),
                (F.coalesce("n", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("total"),
                (F.coalesce("lang_sum", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("lang_total")), "groups")
    return pair_part(groups, kept).unionByName(term_part(groups, kept, top))


def pair_part(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """Every other source of each group's language with the value of the pair."""
    most = groups.agg(F.max("v")).first()[0] or 0
    blocks = -(-most // BLOCK) or 1
    arrays = written(
        kept.groupBy("lang", "source", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("e"))
        .select("lang", "source", "block", F.col("e.id").alias("ids"), F.col("e.n").alias("counts")), "term-arrays")
    side = lambda c: groups.select("lang", F.col("source").alias(c), F.col("total").alias(f"total_{c}"), "v")
    pairs = written(side("a").join(side("b").drop("v"), "lang").where("a < b"), "pairs")
    key = ["lang", "a", "b", "block"]
    # aliases: the two halves come from the same tables
    half = lambda c: pairs.join(arrays.withColumnRenamed("source", c), ["lang", c]).select(
        *(F.col(x).alias(x) for x in (*key, "total_a", "total_b", "ids", "counts"))).groupBy(*key)
    sums = half("a").cogroup(half("b")).applyInArrow(_pair_task, "lang string, a string, b string, value long, held long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("held").alias("held"))
    # terms that neither side holds all have the price between the two frequencies of a count of 0
    absent = (F.col("v") - F.coalesce("held", F.lit(0))) * F.expr("((p0 - q0) * (p0 - q0)) div (p0 + q0)")
    priced = (pairs.join(sums, ["lang", "a", "b"], "left")
              .withColumns({"p0": F.when(F.col("v") > 0, _p("0L", "total_a")), "q0": F.when(F.col("v") > 0, _p("0L", "total_b"))})
              .withColumn("value", F.when(F.col("v") > 0, F.coalesce("value", F.lit(0)) + absent).otherwise(F.lit(0)).cast("long")))
    both = priced.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    return _ranked(both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value"))


def term_part(groups: DataFrame, kept: DataFrame, top: int = TOP) -> DataFrame:
    """The terms that each group over-uses most."""
    at = (kept.where("n > 0").join(groups, ["lang", "source"])
          .withColumns({"p": _p("n", "total"), "q": _p("lang_n", "lang_total")}).where("p > q"))
    rows = at.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    return _ranked(rows).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order)).select("lang", "source", "part", "item", "value", "rank")
