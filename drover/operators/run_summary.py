"""Mergeable summaries of status runs.

A summary describes a stretch of one vehicle's events that no other stretch interleaves:
its first and last event, how many runs of equal status it holds, when the last of them
began, and the idle time between its events. Two neighbouring summaries combine into the
summary of both: the runs at the seam are one run if their statuses are equal, and the gap
between them is idle if the earlier status is. The operation is associative, so events fold
into slices, slices into days and days into a vehicle's history with the same result as one
scan, and an event that comes late changes one summary on each level.

A level is one window over the members of a group (``combine``), whose size is the group's
fan-in: the events of a slice, the slices of a day, the days of a vehicle. Events are
ordered by (event_ts, event_id, status, the rest), null ids first; repeated events count in
``n_events`` only. Null statuses are not allowed (cleaning removes them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from drover.functions import day_start_us, epoch_us

FIELDS = ["driver_id", "lat", "lon", "speed", "zone", "fare", "sim_day"]
SUMMARY = ["first", "last", "n_runs", "n_events", "since", "idle_us"]


def slice_of(ts, params, slice_seconds: int) -> Column:
    """Number of the slice of an instant. Slices start with each day (the last of a day is
    shorter if the width does not divide the day), so a slice lies in one day."""
    since = epoch_us(ts) - F.lit(params.start_us)
    per_day = -(-params.day_us // (slice_seconds * 1_000_000))
    in_day = F.floor(F.pmod(since, F.lit(params.day_us)) / F.lit(slice_seconds * 1_000_000))
    return (F.floor(since / F.lit(params.day_us)) * F.lit(per_day) + in_day).cast("long")


def of_events(events: DataFrame, keys: list[str]) -> DataFrame:
    """Every event as the summary of itself."""
    place = F.struct("event_ts", "event_id", "status", *FIELDS)
    return events.select(*keys, place.alias("first"), place.alias("last"), F.lit(1).cast("long").alias("n_runs"),
                         F.lit(1).cast("long").alias("n_events"), F.col("event_ts").alias("since"),
                         F.lit(0).cast("long").alias("idle_us"))


def combine(summaries: DataFrame, keys: list[str]) -> DataFrame:
    """One summary per group of neighbouring summaries (``keys``); groups must not interleave."""
    before = F.lag("last").over(Window.partitionBy(*keys).orderBy("first", "last"))
    s = summaries.select(*keys, *SUMMARY, before.alias("before"))
    joined = F.col("before").isNotNull() & (F.col("before.status") == F.col("first.status"))
    gap = F.when(F.col("before.status") == "idle", epoch_us("first.event_ts") - epoch_us("before.event_ts")).otherwise(0)
    starts = F.when((F.col("n_runs") > 1) | ~joined, F.col("since"))
    return s.groupBy(*keys).agg(
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.sum(F.col("n_runs") - F.when(joined, 1).otherwise(0)).alias("n_runs"), F.sum("n_events").alias("n_events"),
        F.max(starts).alias("since"), F.sum(F.col("idle_us") + gap).alias("idle_us"))


def latest_of(vehicles: DataFrame) -> DataFrame:
    """Latest status from one summary per vehicle, as ``operators.status.latest_status`` gives it."""
    return vehicles.select(
        "vehicle_id", *[F.col(f"last.{c}").alias(c) for c in ("driver_id", "lat", "lon", "speed", "status", "zone")],
        F.col("last.fare").alias("last_fare"), F.col("last.sim_day").alias("sim_day"),
        F.col("since").alias("status_since"), F.col("last.event_ts").alias("updated_at"))


def idle_seconds_of(days: DataFrame, params) -> DataFrame:
    """Idle seconds per (vehicle, day) from day summaries (columns vehicle_id, sim_day and
    the summary): the idle time inside each day, and the gaps between days and up to
    ``as_of``, cut at day borders."""
    nxt = F.lead("first").over(Window.partitionBy("vehicle_id").orderBy("sim_day"))
    d = days.select("vehicle_id", "sim_day", "idle_us", "last", nxt["event_ts"].alias("next_ts"))
    s, e = epoch_us("last.event_ts"), epoch_us("next_ts")
    if params.as_of is not None:
        e = F.coalesce(e, F.lit(int(round(params.as_of * 1_000_000))))
    inside = d.where(F.col("idle_us") > 0).select("vehicle_id", "sim_day", "idle_us")
    gaps = d.where(F.col("last.status") == "idle").select("vehicle_id", "sim_day", s.alias("s"), e.alias("e")).where("e > s")
    last = F.floor((F.col("e") - F.lit(1) - F.lit(params.start_us)) / F.lit(params.day_us)).cast("int")
    gaps = gaps.select("vehicle_id", "s", "e", F.explode(F.sequence(F.col("sim_day"), last)).alias("sim_day"))
    cut = (F.least("e", day_start_us(F.col("sim_day") + 1, params)) - F.greatest("s", day_start_us("sim_day", params)))
    return (inside.unionByName(gaps.select("vehicle_id", "sim_day", cut.alias("idle_us")))
            .groupBy("vehicle_id", "sim_day").agg((F.sum("idle_us") / F.lit(1_000_000.0)).alias("idle_seconds")))
