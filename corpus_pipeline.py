"""Corpus pipeline: quality rules, SimHash near-dedup, substring dedup, benchmark
decontamination and best-fit packing, each over what the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes each stage's rows as Parquet in the shared scratch
folder and reads them again, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.llm import best_fit, decontaminate, difference_cover, quality, simhash
from drover.llm.common import narrow, table, unused, written
from drover.llm.queries import tokenizer_path

#: Documents of a batch of the packing, whose workers run beside a JVM that the stages before filled.
PACKING_ROWS = 1_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base nor the cascade rejects."""
    return quality.quality(docs, prefix="__q_").where("__q_kept").select(docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id (null last),
    then the smallest digest of the text; of equal rows one (rows that differ in other
    columns alone: the smallest).

    The choice is made on ids and digests; the texts are filtered by a table of what goes,
    broadcast if measured to be small, else by one join. Rows that occur several times are
    the only ones to be aggregated."""
    cols = docs.columns
    key, digest, m_id, m_digest, gone, rows = unused(docs, "__id", "__digest", "__gone_id", "__gone_digest", "__gone", "__rows")
    marks = written(simhash.one_each(docs), "marks").toDF(m_id, m_digest, gone, rows)
    keyed = docs.withColumns({key: F.col("doc_id").cast("long"), digest: simhash.text_digest()})
    joined = keyed.join(narrow(marks), F.col(key).eqNullSafe(F.col(m_id)) & (F.col(digest) == F.col(m_digest)), "left")
    kept = joined.where(F.col(gone).isNull()).select(cols)
    several = marks.where(~F.col(gone))
    if several.isEmpty():
        return kept
    again = joined.where(~F.col(gone)).groupBy(key, digest).agg(F.min(F.struct(*cols)).alias(rows))
    return kept.unionByName(again.select(f"{rows}.*"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 13-word windows that a document with a smaller id holds; a
    document of which nothing is left goes. Null texts go; a null id counts as the smallest;
    rows that share an id do not make each other's windows repeated."""
    out = difference_cover.deduplicated(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).where("text <> ''").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item (null texts hold none; rows that share
    an id are told apart by their texts; without items all stay)."""
    key, digest = unused(docs, "__id", "__digest")
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2 ** 63))),
                              digest: F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")})
    hit = written(decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0").select(
        F.col("key_id").alias(key), F.col("key_digest").alias(digest)).distinct(), "contaminated")
    return keyed.join(narrow(hit), [key, digest], "left_anti").select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences (null texts: one piece of the id 0;
    null and repeated ids: a piece each; no documents: no pieces)."""
    return best_fit.packed_sequences(docs, tokenizer_path(), batch_rows=PACKING_ROWS)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: XXH64 fingerprints and token ids have no SQL form; tests hold stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
