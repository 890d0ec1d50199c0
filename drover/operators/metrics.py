"""Zone metrics per time window and running earnings per vehicle-day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drover import config as C
from drover.functions import sim_day_of
from drover.streaming.member_deltas import Totals

_KIND_VEHICLE, _KIND_TRIP = 0, 1


def valid_trip(c="trip_id") -> F.Column:
    """Trip id, or null for the no-trip sentinel (nulls are excluded from counts)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c != F.lit(C.NO_TRIP), c)


def zone_metrics(events: DataFrame, params, window: str | None = None) -> DataFrame:
    """Distinct vehicles (all, idle, enroute, on trip), distinct trips, fare sum and mean
    speed per (tumbling window, zone).

    Exact distinct counts without buffering sets: level one groups by
    (window, zone, member), where a member is a vehicle or a trip, so every distinct
    member becomes one row; level two counts those rows per (window, zone). Both levels
    aggregate partially before their shuffle, so a crowded zone costs no more than a
    quiet one, and the plan is also a valid append-mode streaming plan.
    """
    window = window or params.window
    vehicle = F.struct(
        F.lit(_KIND_VEHICLE).alias("kind"), F.col("vehicle_id").alias("member"),
        (F.col("status") == "idle").alias("idle"), (F.col("status") == "enroute").alias("enroute"),
        (F.col("status") == "on_trip").alias("on_trip"),
        F.col("fare").alias("fare"), F.col("speed").alias("speed"))
    trip = F.struct(
        F.lit(_KIND_TRIP).alias("kind"), valid_trip().alias("member"),
        F.lit(None).cast("boolean").alias("idle"), F.lit(None).cast("boolean").alias("enroute"),
        F.lit(None).cast("boolean").alias("on_trip"),
        F.lit(None).cast("double").alias("fare"), F.lit(None).cast("double").alias("speed"))
    tagged = events.select(
        F.window("event_ts", window).alias("window"), "zone",
        F.inline(F.filter(F.array(vehicle, trip), lambda s: s["member"].isNotNull())))
    members = tagged.groupBy("window", "zone", "kind", "member").agg(
        F.max("idle").alias("idle"), F.max("enroute").alias("enroute"), F.max("on_trip").alias("on_trip"),
        F.sum("fare").alias("fare"), F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_n"))
    is_vehicle = F.col("kind") == _KIND_VEHICLE
    per_zone = members.groupBy("window", "zone").agg(
        F.count(F.when(is_vehicle, True)).alias("active_vehicles"),
        F.count(F.when(F.col("idle"), True)).alias("idle_count"),
        F.count(F.when(F.col("enroute"), True)).alias("enroute_count"),
        F.count(F.when(F.col("on_trip"), True)).alias("on_trip_count"),
        F.count(F.when(~is_vehicle, True)).alias("trip_count"),
        F.sum("fare").alias("total_earnings"),
        F.try_divide(F.sum("speed_sum"), F.sum("speed_n")).alias("avg_speed"))
    return _flatten_window(per_zone, params)


def zone_metrics_sketches(events: DataFrame, params, window: str | None = None, rsd: float = 0.01) -> DataFrame:
    """The same measures with HyperLogLog++ sketches of relative standard deviation ``rsd``:
    state of fixed size per window, in a form that streams in update mode."""
    status = F.col("status")
    of = {"active_vehicles": F.col("vehicle_id")}
    of |= {f"{s}_count": F.when(status == s, F.col("vehicle_id")) for s in C.VALID_STATUSES}
    of["trip_count"] = valid_trip()
    sketches = [F.approx_count_distinct(c, rsd=rsd).cast("long").alias(n) for n, c in of.items()]
    agg = events.groupBy(F.window("event_ts", window or params.window).alias("window"), "zone").agg(
        *sketches, F.sum("fare").alias("total_earnings"), F.avg("speed").alias("avg_speed"))
    return _flatten_window(agg, params)


def zone_keyed(events: DataFrame, params, window: str | None = None) -> DataFrame:
    """Events with the keys of their zone window; ``sim_day`` is the day of its start."""
    w = F.window("event_ts", window or params.window)
    keyed = events.drop("sim_day").withColumn("window", w)
    return keyed.select("*", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                        sim_day_of(F.col("window.start"), params).alias("sim_day")).drop("window")


def zone_totals() -> Totals:
    """Zone metrics as signed membership deltas (see ``streaming.member_deltas``)."""
    vehicle = {"active_vehicles": F.col("vehicle_id")}
    by_status = {f"{s}_count": F.when(F.col("status") == s, F.col("vehicle_id")) for s in C.VALID_STATUSES}
    return Totals(("zone", "window_start", "window_end", "sim_day"), "sim_day",
                  vehicle | by_status | {"trip_count": valid_trip()},
                  {"total_earnings": F.sum("fare"), "speed_sum": F.sum("speed"), "speed_n": F.count("speed")},
                  ends=F.col("window_end"))


def zone_metrics_of(totals: DataFrame) -> DataFrame:
    """Zone metrics from the sums of their deltas."""
    return totals.select(
        "zone", "window_start", "window_end", "active_vehicles", "idle_count", "enroute_count", "on_trip_count",
        "trip_count", "total_earnings", F.try_divide("speed_sum", "speed_n").alias("avg_speed"), "sim_day")


def _flatten_window(df: DataFrame, params) -> DataFrame:
    return df.select(
        "zone",
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "active_vehicles", "idle_count", "enroute_count", "on_trip_count", "trip_count",
        "total_earnings", "avg_speed",
        # the day of a window is the day of its start
        sim_day_of(F.col("window.start"), params).alias("sim_day"))


def daily_earnings(events: DataFrame) -> DataFrame:
    """Fare total (fares are per-event increments) and distinct trips per vehicle-day."""
    return events.groupBy("vehicle_id", "sim_day").agg(
        F.sum("fare").alias("total_fare"),
        F.count_distinct(valid_trip()).alias("trip_count"))


def earnings_totals() -> Totals:
    """Running earnings as signed membership deltas (see ``streaming.member_deltas``)."""
    return Totals(("vehicle_id", "sim_day"), "sim_day", {"trip_count": valid_trip()}, {"total_fare": F.sum("fare")})
