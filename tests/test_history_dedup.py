"""Copies are removed however far apart; different events of one instant stay."""

from pyspark.sql import functions as F

from drover.streaming import history_dedup as HD

SCHEMA = "vehicle_id string, status string, t long, event_id long, fare double"


def _events(spark, rows):
    e = spark.createDataFrame(rows, SCHEMA).withColumn("event_ts", F.timestamp_seconds("t"))
    return e.withColumn("sim_day", F.floor(F.col("t") / 100).cast("int")).drop("t")


def _kept(spark, path):
    rows = spark.read.parquet(path).select("vehicle_id", "status", F.unix_seconds("event_ts").alias("t"), "event_id", "fare")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


A, B = ("V1", "idle", 5, 1, 0.0), ("V1", "on_trip", 5, 2, 0.0)               # one vehicle, one instant
NINE, TWIN = ("V2", "idle", 250, None, 1.0), ("V2", "idle", 250, None, 2.0)  # no ids, another fare
LATER = ("V1", "idle", 950, 3, 0.0)


def test_copies_across_batches_replays_and_epochs(spark, tmp_path):
    path = str(tmp_path / "log")
    HD.apply_batch(_events(spark, []), path, 1, 0)
    HD.apply_batch(_events(spark, [A] * 500 + [B, NINE]), path, 1, 1)        # a hot group of copies
    assert _kept(spark, path) == sorted([A, B, NINE], key=repr)
    for _ in range(2):                                                       # a batch and its replay
        HD.apply_batch(_events(spark, [LATER, A, TWIN, NINE]), path, 1, 2)
        assert _kept(spark, path) == sorted([A, B, NINE, TWIN, LATER], key=repr)
    # the checkpoint is lost: a new epoch reads old messages again, and a new one
    new = ("V3", "offline", 20, 9, 0.0)
    HD.apply_batch(_events(spark, [A, B, NINE, LATER, new]), path, 2, 0)
    assert _kept(spark, path) == sorted([A, B, NINE, TWIN, LATER, new], key=repr)


def test_a_batch_of_copies_only(spark, tmp_path):
    path = str(tmp_path / "log")
    HD.apply_batch(_events(spark, [A, B]), path, 1, 0)
    HD.apply_batch(_events(spark, [B, A]), path, 1, 1)
    HD.apply_batch(_events(spark, [LATER]), path, 1, 2)
    assert _kept(spark, path) == sorted([A, B, LATER], key=repr)


def test_null_differs_from_an_absent_value(spark):
    rows = [("V1", None, 5, 1, None), (None, "V1", 5, 1, None), ("V1", "", 5, 1, None), ("V1", None, 5, 1, 0.0)]
    assert HD.with_digest(_events(spark, rows)).select(HD.DIGEST).distinct().count() == 4
