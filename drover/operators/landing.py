"""Expense files by precedence: which file's row of a (vehicle, day) counts.

A file is known by its day and the digest of its rows. Its version is the time at which
that content was first delivered, so a correction is newer than the original, and a copy
delivered once more, under any name and at any time, is as old as it always was. The
manifest of deliveries (path, modification time, digest) lies beside the table; each stored
row carries the version it came from, and of the rows of one key the greatest (version,
path) stays. The result is the same in whatever order and triggers the files arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.operators.reconcile import upsert_days
from drover.session import path_exists, scratch_path

KEY = ["vehicle_id", "sim_day"]
VALUES = ["fuel_cost", "maintenance_cost", "distance_covered", "service_flag"]
#: Columns that :func:`drover.sources.expenses.stream_expense_feed` adds ``with_file``.
FILE = ["file_path", "file_modified"]
#: Columns of a stored row besides the expense columns.
VERSION = ["file_version", "file_path"]


def manifest_path(table_path: str) -> str:
    return table_path.rstrip("/") + ".manifest"


def deliveries(feed: DataFrame) -> DataFrame:
    """(sim_day, file_path, file_modified, rows, digest) per file of a feed. The digest does
    not depend on the order of rows: their number and the sum of two 64-bit hashes of each."""
    cols = ["vehicle_id", *VALUES]
    total = lambda h: F.sum(h.cast("decimal(20,0)"))
    return feed.groupBy("sim_day", *FILE).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), total(F.xxhash64(*cols)).cast("string"),
                           total(F.xxhash64(F.lit("again"), *cols)).cast("string")), 256).alias("digest"))


def versions(manifest: DataFrame) -> DataFrame:
    """(sim_day, digest, file_version, file_path): the first delivery of each content."""
    first = manifest.groupBy("sim_day", "digest").agg(F.min(F.struct("file_modified", "file_path")).alias("f"))
    return first.select("sim_day", "digest", F.col("f.file_modified").alias("file_version"), "f.file_path")


def read_manifest(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.parquet(manifest_path(table_path)).distinct()


def merge_landed(feed: DataFrame, table_path: str, on_duplicate: str = "raise") -> None:
    """Merge the rows of landed files (with FILE columns) into the table.

    A key listed twice in one file raises, or keeps one row (``on_duplicate="keep_one"``:
    the greatest). An empty feed changes nothing.
    """
    if on_duplicate not in ("raise", "keep_one"):
        raise ValueError("on_duplicate must be 'raise' or 'keep_one'")
    spark = feed.sparkSession
    feed = feed.persist()      # read for duplicates, the manifest and the rows
    try:
        twice = feed.groupBy(*KEY, *FILE).count().where("count > 1")
        if on_duplicate == "raise" and not twice.isEmpty():
            raise ValueError("duplicate (vehicle_id, sim_day) rows in an expense file")
        # an append: rows that a replayed batch adds again are the same deliveries
        mine = deliveries(feed)
        mine.write.mode("append").parquet(manifest_path(table_path))
        days = [r[0] for r in feed.select("sim_day").distinct().collect()]      # days in the batch
        if not days:
            return
        known = versions(read_manifest(spark, table_path).where(F.col("sim_day").isin(days)))
        # the version of each file of the batch: that of the first delivery of its content
        files = mine.withColumnRenamed("file_path", "own_path").join(known, ["sim_day", "digest"]).select(
            "sim_day", "own_path", "file_modified", "file_version", F.col("file_path").alias("first_path"))
        new = (feed.withColumnRenamed("file_path", "own_path").join(files, ["sim_day", "own_path", "file_modified"])
               .select(*KEY, *VALUES, "file_version", F.col("first_path").alias("file_path")))
        merge_versions(new, table_path)
    finally:
        feed.unpersist()


def stored(spark: SparkSession, table_path: str) -> DataFrame:
    """The table's rows with VERSION columns (null where a row was stored without a file)."""
    old = spark.read.parquet(table_path)
    for c, kind in zip(VERSION, ("timestamp", "string"), strict=True):
        if c not in old.columns:
            old = old.withColumn(c, F.lit(None).cast(kind))
    return old.select(*KEY, *VALUES, *VERSION)


def merge_versions(new: DataFrame, table_path: str) -> None:
    """Upsert rows with VERSION columns: of each key the greatest (version, path) stays, equal
    ones by their values. The touched days' rows are written to the scratch folder first (a
    table cannot be read and overwritten in one job), then replace those days."""
    spark = new.sparkSession
    both = new
    if path_exists(spark, table_path):
        old = stored(spark, table_path).join(new.select("sim_day").distinct(), "sim_day", "left_semi")
        both = new.unionByName(old.select(*new.columns))
    best = both.groupBy(*KEY).agg(F.max(F.struct(*VERSION, *VALUES)).alias("v")).select(
        *KEY, *(F.col(f"v.{c}").alias(c) for c in (*VALUES, *VERSION)))
    merged = scratch_path(spark, "expense-merge")
    best.write.parquet(merged)
    upsert_days(spark.read.schema(best.schema).parquet(merged), table_path)
