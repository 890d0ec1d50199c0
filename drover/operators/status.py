"""Vehicle status: latest state, runs of equal status ("spells"), idle time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drover.functions import day_start_us, epoch_us, known_at, lit_ts, newer_than, seconds_between, sim_day_of
from drover.operators.sequence import with_run_id


def as_of_filter(events: DataFrame, params) -> DataFrame:
    """Events known at ``params.as_of`` (all events when it is unset)."""
    if params.as_of is None:
        return events
    return known_at(events, params.as_of, params)


def status_spells(events: DataFrame, params, carry: list[str] | None = None) -> DataFrame:
    """Runs of equal status per vehicle in event-time order.

    ``spell_end`` is the start of the next run, or ``as_of`` for the current one
    (``is_current``); ``duration_s`` = end - start. One aggregation builds each run: the
    first event of run r+1 also contributes its time to run r as that run's end, so no
    join of runs with their successors is needed. ``carry`` names event columns whose
    values at the run's last event are kept (struct column ``last``).
    """
    carry = carry or []
    ev = as_of_filter(events, params).select(
        "vehicle_id", "status", "event_ts", "event_id", *[c for c in carry if c not in ("status", "event_ts")])
    runs = with_run_id(ev, ["vehicle_id"], "event_ts", "event_id", "status", params.bucket_seconds,
                       "run_id", start_flag="__start")
    payload = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("string")
    payload_type = runs.select(payload.alias("p")).schema["p"].dataType  # analysis only
    own = F.struct(F.col("run_id").alias("run_id"), F.col("status").alias("status"),
                   F.col("event_ts").alias("ts"), F.col("event_id").alias("event_id"),
                   F.lit(None).cast("timestamp").alias("next_start"), payload.alias("payload"))
    ends = F.struct((F.col("run_id") - 1).alias("run_id"), F.lit(None).cast("string").alias("status"),
                    F.lit(None).cast("timestamp").alias("ts"), F.lit(None).cast("long").alias("event_id"),
                    F.col("event_ts").alias("next_start"), F.lit(None).cast(payload_type).alias("payload"))
    rows = runs.select("vehicle_id", F.inline(F.filter(
        F.array(own, F.when(F.col("__start") & (F.col("run_id") > 1), ends)), lambda s: s.isNotNull())))
    aggs = [F.min("status").alias("status"),
            F.min("ts").alias("spell_start"),
            F.max("ts").alias("last_event_ts"),
            F.count("ts").alias("n_events"),
            F.min("next_start").alias("__next_start")]
    if carry:
        order = F.when(F.col("ts").isNotNull(), F.struct("ts", "event_id"))
        aggs.append(F.max_by("payload", order).alias("last"))
    spells = rows.groupBy("vehicle_id", "run_id").agg(*aggs)
    end = F.col("__next_start")
    if params.as_of is not None:
        end = F.coalesce(end, lit_ts(params.as_of))
    return spells.select(
        "vehicle_id", "run_id", "status", "spell_start", end.alias("spell_end"),
        "last_event_ts", "n_events",
        F.col("__next_start").isNull().alias("is_current"),
        seconds_between(end, F.col("spell_start")).alias("duration_s"),
        *(["last"] if carry else []))


def latest_status(events: DataFrame, params) -> DataFrame:
    """One row per vehicle: its latest event (greatest (event_ts, event_id)), and
    ``status_since`` = start of its current run of equal status. Both come from the
    current run of :func:`status_spells` (one pass over the events).

    Late events never regress the status: order is event time, not arrival.
    """
    fields = ["driver_id", "lat", "lon", "speed", "zone", "fare", "sim_day", "event_ts"]
    cur = status_spells(events, params, carry=fields).where("is_current")
    return cur.select(
        "vehicle_id", "last.driver_id", "last.lat", "last.lon", "last.speed", "status", "last.zone",
        F.col("last.fare").alias("last_fare"), "last.sim_day", F.col("spell_start").alias("status_since"),
        F.col("last.event_ts").alias("updated_at"))


def recent_status(events: DataFrame, params, recency_s: float) -> DataFrame:
    """(vehicle_id, status, updated_at) of vehicles with an event in the ``recency_s`` before
    ``as_of``, from those events alone (time predicates reach the scan; no run detection)."""
    recent = newer_than(as_of_filter(events, params), params.as_of - int(recency_s), params)
    last = recent.groupBy("vehicle_id").agg(
        F.max_by(F.struct("status", "event_ts"), F.struct("event_ts", "event_id")).alias("last"))
    return last.select("vehicle_id", "last.status", F.col("last.event_ts").alias("updated_at"))


def idle_spells(spells: DataFrame, threshold_s: float) -> DataFrame:
    """Idle runs longer than the threshold (strictly)."""
    return (spells.where((F.col("status") == "idle") & (F.col("duration_s") > F.lit(float(threshold_s))))
            .select("vehicle_id", "spell_start", "spell_end", F.col("duration_s").alias("idle_seconds")))


def idle_seconds_by_day(spells: DataFrame, params) -> DataFrame:
    """Idle seconds per (vehicle, day): idle runs cut at day boundaries."""
    idle = spells.where((F.col("status") == "idle") & (F.col("spell_end") > F.col("spell_start")))
    s_us, e_us = epoch_us("spell_start"), epoch_us("spell_end")
    first_day = sim_day_of(F.col("spell_start"), params)
    last_day = sim_day_of(F.timestamp_micros(e_us - F.lit(1)), params)
    days = idle.select("vehicle_id", s_us.alias("s"), e_us.alias("e"),
                       F.explode(F.sequence(first_day, last_day)).alias("sim_day"))
    overlap = (F.least(F.col("e"), day_start_us(F.col("sim_day") + 1, params))
               - F.greatest(F.col("s"), day_start_us(F.col("sim_day"), params)))
    return days.groupBy("vehicle_id", "sim_day").agg(
        (F.sum(overlap) / F.lit(1_000_000.0)).alias("idle_seconds"))
