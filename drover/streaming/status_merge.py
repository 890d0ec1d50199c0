"""Latest status per vehicle without Python: each micro-batch is reduced with DataFrame
aggregations and merged into the status changelog in ``foreachBatch``.

Per vehicle and batch (events newer than the vehicle's stored latest event only):

* the newest event (``max_by`` over (event_ts, event_id)) gives the new status and fields;
* the newest event whose status differs from the new one marks the end of the previous run;
  the first event after it starts the current run;
* when every new event has the new status, the run continues from the stored
  ``status_since`` if the stored status is the same, else it starts at the batch's first event.

Every step is an aggregation (combined map-side) or a join on the vehicle key against one
row per vehicle, so a vehicle with a large share of a batch is spread over many tasks
(AQE splits the skewed join side). Same results as the immediate mode of the keyed-state
processor: an event older than the vehicle's stored latest event is ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.session import path_exists
from drover.streaming import changelog as CL
from drover.streaming.epochs import fence

FIELDS = ["driver_id", "lat", "lon", "speed", "zone", "fare", "sim_day"]


def _previous(spark: SparkSession, state_path: str, snapshots: str | None, run_id: int,
              batch_id: int) -> DataFrame | None:
    """Status before this batch: versions written by earlier batches only, so a replayed
    batch is recomputed from the same state as its first attempt."""
    if not path_exists(spark, state_path):
        return None
    if snapshots:
        return CL.resolve_compacted(spark, state_path, ["vehicle_id"], snapshots, before=(int(run_id), int(batch_id)))
    earlier = F.struct("run", "batch_id") < F.struct(F.lit(int(run_id)), F.lit(int(batch_id)))
    return CL.resolve(spark, state_path, ["vehicle_id"], where=earlier)


def merge_batch(spark: SparkSession, batch: DataFrame, previous: DataFrame | None) -> DataFrame:
    """New status rows for the vehicles in ``batch`` (one per vehicle with newer events)."""
    b = batch.select("vehicle_id", "event_ts", "event_id", "status", *FIELDS)
    if previous is not None:
        prev = previous.join(b.select("vehicle_id").distinct(), "vehicle_id", "left_semi").select(
            "vehicle_id", F.col("status").alias("prev_status"),
            F.timestamp_micros("status_since_us").alias("prev_since"),
            F.timestamp_micros("updated_at_us").alias("prev_ts"), F.col("last_event_id").alias("prev_id"))
        e = b.join(prev, "vehicle_id", "left").where(
            F.col("prev_ts").isNull()
            | (F.struct("event_ts", "event_id") > F.struct(F.col("prev_ts"), F.col("prev_id"))))
    else:
        e = b.select("*", F.lit(None).cast("string").alias("prev_status"),
                     F.lit(None).cast("timestamp").alias("prev_since"))
    order = F.struct("event_ts", "event_id")
    summary = e.groupBy("vehicle_id").agg(
        F.max_by(F.struct("status", "event_ts", "event_id", *FIELDS), order).alias("last"),
        F.min("event_ts").alias("first_ts"),
        F.max("prev_status").alias("prev_status"), F.max("prev_since").alias("prev_since"))
    new_status = summary.select("vehicle_id", F.col("last.status").alias("new_status"))
    other = (e.join(new_status, "vehicle_id").where(F.col("status") != F.col("new_status"))
             .groupBy("vehicle_id").agg(F.max(order).alias("last_other")))
    after = (e.join(other, "vehicle_id").where(order > F.col("last_other"))
             .groupBy("vehicle_id").agg(F.min("event_ts").alias("since_after")))
    s = summary.join(after, "vehicle_id", "left")
    since = F.coalesce(
        F.col("since_after"),
        F.when(F.col("prev_status") == F.col("last.status"), F.col("prev_since")),
        F.col("first_ts"))
    return s.select(
        "vehicle_id", *[F.col(f"last.{c}").alias(c) for c in ("driver_id", "lat", "lon", "speed")],
        F.col("last.status").alias("status"), F.col("last.zone").alias("zone"),
        F.col("last.fare").alias("last_fare"), F.col("last.sim_day").alias("sim_day"),
        F.unix_micros(since).alias("status_since_us"), F.unix_micros("last.event_ts").alias("updated_at_us"),
        F.col("last.event_id").alias("last_event_id"))


def status_merge_sink(spark: SparkSession, state_path: str, run_id: int, snapshots: str | None = None):
    """A ``foreachBatch`` function maintaining the status changelog at ``state_path``."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        fence(batch_df.sparkSession, state_path, run_id)
        batch_df = batch_df.persist()  # read by three aggregations
        if batch_df.isEmpty():         # all is held behind a watermark: no version to write
            batch_df.unpersist()
            return
        rows = merge_batch(spark, batch_df, _previous(spark, state_path, snapshots, run_id, batch_id))
        CL.write_batch(rows, state_path, run_id, batch_id)
        batch_df.unpersist()
    return sink
