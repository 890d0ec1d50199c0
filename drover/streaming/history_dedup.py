"""Exact deduplication over the whole history of a stream.

A copy is an equal record: the same values in all columns, compared by SHA-256, so two
events of one vehicle and instant that differ in anything both stay, and records without an
event id need no key. Copies inside a micro-batch are removed by an aggregation (combined
map-side: a hot group of copies costs one row a task); what earlier batches have logged is
removed by an anti-join with the digests of the batch's own days. The event log itself is
the key store: it is partitioned by ``sim_day`` and a round reads its digest column only,
for the days that the batch touches, however old they are. A copy has its original's event
time and so its day, which makes this exact without a watermark.

A replayed batch compares with earlier batches only and writes the same rows again; a new
epoch after a lost checkpoint compares with everything older epochs have logged, so messages
that are read again are copies too. There is no streaming state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drover.session import path_exists
from drover.streaming import changelog as CL
from drover.streaming.epochs import fence

DIGEST = "record_digest"


def with_digest(events: DataFrame) -> DataFrame:
    """Add the SHA-256 of all columns (as JSON with nulls, in the order of their names)."""
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(events.columns)]), {"ignoreNullFields": "false"})
    return events.withColumn(DIGEST, F.unhex(F.sha2(record, 256)))


def apply_batch(events: DataFrame, path: str, run: int, batch_id: int) -> None:
    """Append the events of one micro-batch that the log at ``path`` does not have yet."""
    spark = events.sparkSession
    fence(spark, path, run)
    once = with_digest(events).dropDuplicates(["sim_day", DIGEST]).persist()
    try:
        days = [r[0] for r in once.select("sim_day").distinct().collect()]      # one per day in the batch
        if not days:
            return
        new = once
        if path_exists(spark, path):
            schema = once.select(DIGEST, "sim_day").schema.add("run", "long").add("batch_id", "long")
            earlier = ~CL.after(run, batch_id - 1)
            logged = spark.read.schema(schema).parquet(path).where(F.col("sim_day").isin(days) & earlier)
            new = once.join(logged.select("sim_day", DIGEST), ["sim_day", DIGEST], "left_anti")
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        salt = F.pmod(F.xxhash64(DIGEST), F.lit(max(1, 4 * n // len(days))))     # few files a day, many tasks for few days
        CL.write_batch(new.repartition(n, F.col("sim_day"), salt), path, run, batch_id, ("sim_day",))
    finally:
        once.unpersist()


def history_dedup_sink(path: str, run: int):
    """A ``foreachBatch`` function that keeps each record once at ``path``."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        apply_batch(batch_df, path, run, batch_id)
    return sink
