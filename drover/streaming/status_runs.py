"""Latest status and idle time from summaries of time slices, kept by a stream.

Each micro-batch is appended to an event store; the slices (vehicle, time slice) that it
touches are folded anew from the stored events of those slices, the days of those slices
from their slices, the vehicles from their days (``operators.run_summary``). So

* the result does not depend on the order of arrival: an event that comes late rewrites its
  slice, its day and its vehicle, and both ``status_since`` and the idle time are corrected;
* the work of a batch is the slices it touches, not the history: the store is read by
  day partition and reduced by a semi-join on (vehicle, slice);
* there are no Python workers and no streaming state. A busy vehicle is spread over its
  slices; the widest group is one vehicle's events of one slice;
* a replayed batch reads the events up to itself and writes the same rows again, and after
  a lost checkpoint the events of older epochs stay valid (an event twice changes no run).

Layout beside the vehicle changelog ``path``: ``path.events`` and the changelog
``path.slices`` (partitioned by sim_day, run, batch_id) and the changelog ``path.days``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.operators import run_summary as RS
from drover.session import path_exists
from drover.streaming import changelog as CL
from drover.streaming.epochs import fence

SLICE_SECONDS = 3600


def _part(path: str, name: str) -> str:
    return f"{path.rstrip('/')}.{name}"


def _up_to(log: DataFrame, run: int, batch_id: int) -> DataFrame:
    return log.where(~CL.after(run, batch_id))


def _newest(log: DataFrame, keys: list[str]) -> DataFrame:
    v = F.struct(*RS.SUMMARY)
    newest = log.groupBy(*keys).agg(F.max_by(v, F.struct("run", "batch_id")).alias("v"))
    return newest.select(*keys, *[F.col(f"v.{c}").alias(c) for c in RS.SUMMARY])


def _dealt(df: DataFrame, days: list, by: list[str]) -> DataFrame:
    """Rows dealt so that a day goes to few files and a batch of few days to many tasks."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.col("sim_day"), F.pmod(F.xxhash64(*by), F.lit(max(1, 4 * n // len(days))))).sortWithinPartitions(
        "sim_day", *by)


def apply_batch(events: DataFrame, params, path: str, run: int, batch_id: int,
                slice_seconds: int = SLICE_SECONDS) -> None:
    """Add one micro-batch of enriched events to the summaries at ``path``."""
    spark = events.sparkSession
    fence(spark, path, run)
    store, slices, days = (_part(path, n) for n in ("events", "slices", "days"))
    batch = events.select("vehicle_id", "event_ts", "event_id", "status", *RS.FIELDS,
                          RS.slice_of("event_ts", params, slice_seconds).alias("slice")).persist()
    try:
        touched_days = [r[0] for r in batch.select("sim_day").distinct().collect()]     # one per day in the batch
        if not touched_days:
            return
        here = F.col("sim_day").isin(touched_days)
        CL.write_batch(_dealt(batch, touched_days, ["vehicle_id", "slice"]), store, run, batch_id, ("sim_day",))
        own = batch.select("vehicle_id", "slice").distinct()
        known = _up_to(spark.read.parquet(store).where(here), run, batch_id).join(own, ["vehicle_id", "slice"], "left_semi")
        keys = ["vehicle_id", "sim_day", "slice"]
        folded = RS.combine(RS.of_events(known, keys), keys)
        CL.write_batch(_dealt(folded, touched_days, ["vehicle_id"]), slices, run, batch_id, ("sim_day",))
        vehicle_days = batch.select("vehicle_id", "sim_day").distinct()
        parts = _newest(_up_to(spark.read.parquet(slices).where(here), run, batch_id)
                        .join(vehicle_days, ["vehicle_id", "sim_day"], "left_semi"), keys)
        CL.write_batch(RS.combine(parts, ["vehicle_id", "sim_day"]), days, run, batch_id)    # read by vehicle, all days
        vehicles = RS.combine(_newest(_up_to(spark.read.parquet(days), run, batch_id)
                                      .join(batch.select("vehicle_id").distinct(), "vehicle_id", "left_semi"),
                                      ["vehicle_id", "sim_day"]), ["vehicle_id"])
        CL.write_batch(status_rows(vehicles), path, run, batch_id)
    finally:
        batch.unpersist()


def status_rows(vehicles: DataFrame) -> DataFrame:
    """Rows of the vehicle changelog, with the columns of the other status modes."""
    return RS.latest_of(vehicles).select(
        "vehicle_id", "driver_id", "lat", "lon", "speed", "status", "zone", "last_fare", "sim_day",
        F.unix_micros("status_since").alias("status_since_us"), F.unix_micros("updated_at").alias("updated_at_us"))


def day_summaries(spark: SparkSession, path: str, where=None) -> DataFrame:
    """Newest summary per (vehicle, day); ``where`` (on vehicle and day) reaches the scan."""
    log = spark.read.parquet(_part(path, "days"))
    return _newest(log if where is None else log.where(where), ["vehicle_id", "sim_day"])


def idle_seconds_at(spark: SparkSession, path: str, params) -> DataFrame:
    """Idle seconds per (vehicle, day) of all events so far; nothing if there are none yet."""
    if not path_exists(spark, _part(path, "days")):
        return spark.createDataFrame([], "vehicle_id string, sim_day int, idle_seconds double")
    return RS.idle_seconds_of(day_summaries(spark, path), params)


def status_runs_sink(params, path: str, run: int, slice_seconds: int = SLICE_SECONDS):
    """A ``foreachBatch`` function maintaining the summaries and the changelog at ``path``."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        apply_batch(batch_df, params, path, run, batch_id, slice_seconds)
    return sink
