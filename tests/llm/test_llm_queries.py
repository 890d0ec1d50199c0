"""Registered queries of the training-data operators against DuckDB, and the pipeline."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF001
from drover.llm import queries


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_all_are_registered():
    names = E.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, con, name):
    cur = con.execute(queries.ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, SF001)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(tuple(r) for r in df.select(cols).collect()) == sorted(cur.fetchall())


def test_packed_output_query(spark):
    got = queries.op5_packed_output(spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    per = got.groupBy("doc_id").agg(F.sum("length").alias("n"), F.min("start").alias("s"))
    counts = queries.token_counts.counted(docs, queries.tokenizer_path(), "v")
    assert per.join(counts, "doc_id").where("n = n_tokens + 1 and s = 0").count() == docs.count()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = spark.createDataFrame([(None, "a b " * 30, None, None, None), (None, None, None, None, None), (5, "again " + "x y z " * 9, "en", "s", 3)], docs.schema)
    for start, stages in ((docs.union(odd), corpus_pipeline.STAGES), (docs.limit(0), corpus_pipeline.STAGES[:4])):
        at = start
        for name, stage in stages:
            out = stage(spark, at, SF001)
            if name == "best_fit_packing":
                assert out.select("doc_id").distinct().count() == at.select("doc_id").distinct().count()
                continue
            assert out.columns == docs.columns
            rows = out.collect()
            if name != "substring_dedup":
                assert {(r.doc_id, r.text) for r in rows} <= {(r.doc_id, r.text) for r in at.collect()}
            at = spark.createDataFrame(rows, docs.schema)


def test_simhash_stage_keeps_one_of_each_group(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = corpus_pipeline.simhash_dedup(spark, docs, SF001)
    want = queries.op6_simhash(spark, SF001).agg(F.count_distinct("component_id")).first()[0]
    assert kept.count() == want
