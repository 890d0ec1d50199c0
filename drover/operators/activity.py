"""Distance driven per vehicle-day and its merge with trip counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drover import config as C
from drover.operators.sequence import with_prev


def day_distance(events: DataFrame, params) -> DataFrame:
    """km per (vehicle, day): straight-line degrees x 111 between consecutive positions of
    the same vehicle-day, counted when the current status is a moving one."""
    ev = events.select("vehicle_id", "sim_day", "event_ts", "event_id", "status", "lat", "lon")
    p = with_prev(ev, ["vehicle_id", "sim_day"], "event_ts", "event_id", ["lat", "lon"], params.bucket_seconds)
    step = F.when(F.col("status").isin(*C.MOVING_STATUSES) & F.col("prev_lat").isNotNull(),
                  F.hypot(F.col("lat") - F.col("prev_lat"), F.col("lon") - F.col("prev_lon"))
                  * F.lit(C.KM_PER_DEGREE))
    return (p.where(step.isNotNull()).groupBy("vehicle_id", "sim_day")
            .agg(F.sum(step).alias("distance_km")))


def vehicle_day_activity(earnings: DataFrame, distance: DataFrame) -> DataFrame:
    """Trip count and distance per vehicle-day; either side may be missing (then 0)."""
    e = earnings.select("vehicle_id", "sim_day", "trip_count")
    return e.join(distance, ["vehicle_id", "sim_day"], "full").select(
        "vehicle_id", "sim_day",
        F.coalesce("trip_count", F.lit(0)).cast("long").alias("trip_count"),
        F.coalesce("distance_km", F.lit(0.0)).alias("distance_km"))
