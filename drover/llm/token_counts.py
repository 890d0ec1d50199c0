"""Delta-maintained token totals.

A store under one folder keeps, per committed batch, the signed changes of the additive
totals (documents and tokens by source, language and tokenizer version) and the changed
counts of documents. A batch holds inserts, deletes and revised counts; what it changes is
its new count less the one before, so totals are never recomputed from documents.

Folders: ``counts/batch=N`` (document, tokenizer -> count, or null after a delete; rows
without an id: source, language, tokenizer and count -> how many documents),
``deltas/batch=N`` (signed totals) and ``commits/batch=N``, written last. Readers see
committed batches only; a batch that is applied again does nothing, and one that stopped
half-way is written anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from drover.llm.common import lean, ship, text_slices
from drover.llm.tokens import CALL_BYTES, tokens

KEY = ["doc_id", "tokenizer"]
GROUP = ["source", "lang", "tokenizer"]
COUNTS = "doc_id long, tokenizer string, source string, lang string, n_tokens long, docs long"
DELTAS = "source string, lang string, tokenizer string, docs long, tokens long"


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens(path)
        for b in batches:
            n = np.zeros(b.num_rows, np.int64)
            for row, data, off in text_slices(b.column("text"), CALL_BYTES):
                n[row:row + len(off) - 1] = [len(e) // 4 for e in tok.encode(
                    [data[a:z].tobytes().decode() for a, z in zip(off, off[1:], strict=False)])]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "source", "lang")), pa.array(n)],
                                             names=["doc_id", "source", "lang", "n_tokens"])
    return run


def counted(docs: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """(doc_id, source, lang, n_tokens, tokenizer) of whole texts; a null text has none."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text").mapInArrow(
        lean(_counter(tokenizer)), "doc_id long, source string, lang string, n_tokens long").withColumn("tokenizer", F.lit(version))


class TokenTotals:
    """Totals under ``path`` (a folder that driver and executors share)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, name: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def committed(self) -> list[int]:
        fs, p = self._fs("commits")
        return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p)) if fs.exists(p) else []

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{kind}/batch={n}" for n in self.committed()]
        reader = self.spark.read.schema(f"{schema}, batch long").option("basePath", f"{self.path}/{kind}")
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], f"{schema}, batch long")

    def counts(self) -> DataFrame:
        """Current count of every document and tokenizer version; documents without an id
        as one row for equal ones, with their number."""
        latest = self._read("counts", COUNTS).where("doc_id is not null").groupBy(*KEY).agg(
            F.max_by(F.struct("source", "lang", "n_tokens", "docs"), "batch").alias("now"))
        return latest.where("now.n_tokens is not null").select(*KEY, "now.*").unionByName(self._without_id())

    def _without_id(self) -> DataFrame:
        latest = self._read("counts", COUNTS).where("doc_id is null").groupBy("doc_id", *GROUP, "n_tokens").agg(F.max_by("docs", "batch").alias("docs"))
        return latest.where("docs > 0")

    def _apply_without_id(self, changes: DataFrame) -> DataFrame:
        """(source, lang, tokenizer, n_tokens, before, docs): how many documents without an
        id there were and are, where ``changes`` alter it (see :meth:`apply`)."""
        op = F.coalesce(F.col("op"), F.lit(""))
        number = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
        n = F.col("n_tokens").cast("long")
        new = changes.where("doc_id is null").groupBy(*GROUP, F.coalesce(n, F.lit(0)).alias("n_tokens")).agg(
            number(op != "delete").alias("more"), number((op == "delete") & n.isNotNull()).alias("less"),
            number((op == "revise") | ((op == "delete") & n.isNull())).alias("taken"))
        zero = F.lit(0).cast("long")
        old = self._without_id().select(*GROUP, "n_tokens", zero.alias("more"), zero.alias("less"), zero.alias("taken"), F.col("docs").alias("before"))
        both = new.withColumn("before", zero).unionByName(old).groupBy(*GROUP, "n_tokens").agg(
            *(F.sum(c).alias(c) for c in ("more", "less", "taken", "before")))
        group = Window.partitionBy(*GROUP)
        left = F.greatest(F.col("before") - F.col("less"), zero)
        both = both.withColumn("left", left).withColumn("taken", F.sum("taken").over(group)).withColumn(
            "lower", F.sum("left").over(group.orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)) - F.col("left"))
        out = F.col("left") - F.greatest(F.least(F.col("left"), F.col("taken") - F.col("lower")), zero) + F.col("more")
        return both.select(*GROUP, "n_tokens", "before", out.alias("docs")).where("docs <> before")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) over committed batches."""
        return self._read("deltas", DELTAS).groupBy(*GROUP).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Commit ``changes`` (op insert/delete/revise, doc_id, tokenizer, source, lang,
        n_tokens) as batch number ``batch``; False if it was committed before.

        An insert or revision sets the document's count, whatever it was (so an insert of
        a known document counts as its revision); a delete takes the count away, and does
        nothing if there is none. Several changes of one document in a batch: a delete
        wins, else the largest count. Null sources, languages and tokenizers are groups of
        their own; a null count counts as zero. Batches are applied in ascending order; a
        lower number than the last committed one raises.

        Each row without an id is a document of its own, known by source, language,
        tokenizer and count alone: an insert adds one; a delete takes away one of its
        count (without a count: of the lowest there is), if there is one; a revision takes
        the place of the one with the lowest count that the batch's deletes leave, or is
        added if none is left.
        """
        done = self.committed()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after batch {done[-1]}")
        gone = F.max(F.col("op") == "delete").alias("gone")
        new = changes.where("doc_id is not null").groupBy(*KEY).agg(gone, F.max(F.when(F.col("op") != "delete", F.struct(
            F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens"), "source", "lang"))).alias("new"))
        fresh = new.select(*KEY, "gone", F.when(~F.col("gone"), F.col("new")).alias("new"))
        old = self.counts().where("doc_id is not null").select(F.col("doc_id").alias("o_id"), F.col("tokenizer").alias("o_tok"),
                                   F.struct("n_tokens", "source", "lang").alias("old"))
        both = fresh.join(old, (F.col("doc_id") == F.col("o_id")) & F.col("tokenizer").eqNullSafe(F.col("o_tok")), "left")
        changed = both.where(F.col("new").isNotNull() | F.col("old").isNotNull())
        own = self._apply_without_id(changes)
        changed.select(F.col("doc_id").cast("long").alias("doc_id"), "tokenizer", "new.source", "new.lang", "new.n_tokens", F.lit(1).cast("long").alias("docs")).unionByName(
            own.select(F.lit(None).cast("long").alias("doc_id"), *GROUP, "n_tokens", "docs")).write.mode("overwrite").parquet(f"{self.path}/counts/batch={batch}")
        signed = lambda c, sign: F.struct(F.col(f"{c}.source").alias("source"), F.col(f"{c}.lang").alias("lang"),
                                          F.lit(sign).cast("long").alias("docs"), (F.lit(sign) * F.col(f"{c}.n_tokens")).alias("tokens"))
        parts = changed.select("tokenizer", F.explode(F.filter(F.array(
            F.when(F.col("new").isNotNull(), signed("new", 1)), F.when(F.col("old").isNotNull(), signed("old", -1))),
            lambda x: x.isNotNull())).alias("d")).select("tokenizer", "d.*")
        more = F.col("docs") - F.col("before")
        parts = parts.unionByName(own.select(*GROUP, more.alias("docs"), (more * F.col("n_tokens")).alias("tokens")))
        parts.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where(
            "docs <> 0 or tokens <> 0").select("source", "lang", "tokenizer", "docs", "tokens").write.mode("overwrite").parquet(
            f"{self.path}/deltas/batch={batch}")
        fs, p = self._fs(f"commits/batch={batch}")
        fs.create(p, False).close()
        return True
