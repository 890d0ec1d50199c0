"""Connected components of a link table by alternating star contraction: every round is
two aggregations and joins, state lives in written tables, and no component is gathered
in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drover.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    """Each node points its larger neighbours at its smallest neighbour (or itself)."""
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point at the smallest of them (e: a > b)."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    near = e.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root: the smallest node reached.
    Self-links and repeated links do no harm; no links give an empty result."""
    e = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or now[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now
        e = written(_small_star(_large_star(e).where("a <> b").distinct()).where("a <> b").distinct(), "links")
