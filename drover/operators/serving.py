"""Serving queries: live fleet state, reports, trends, listings (A4-A9, A11-A13, A15, A17,
W1, O1-O4, P16-P23). Every recency filter is relative to an explicit ``as_of``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from drover import config as C
from drover.functions import known_at, lit_ts, newer_than, seconds_between
from drover.operators.metrics import valid_trip
from drover.operators.reconcile import report_counts


def _recent(df: DataFrame, ts_col: str, params, recency_s: int) -> DataFrame:
    return newer_than(df, params.as_of - int(recency_s), params, ts_col)


def clamp_days(days: int | None) -> int:
    """Trend length clamped to [1, 500], default 200."""
    if days is None:
        return C.TREND_DAYS_DEFAULT
    return max(C.TREND_DAYS_MIN, min(int(days), C.TREND_DAYS_MAX))


def default_report_day(params) -> int:
    """The dashboard's default report day: the day that just closed, never below 0."""
    return max(0, params.current_day - 1)


def recent_vehicles(latest: DataFrame, params) -> DataFrame:
    return _recent(latest, "updated_at", params, params.status_recency_s)


def realtime_status(latest: DataFrame, params) -> DataFrame:
    """Status breakdown of vehicles seen recently."""
    return recent_vehicles(latest, params).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def realtime_summary(latest: DataFrame, events: DataFrame, params) -> DataFrame:
    """One row: current day, recently seen vehicles, idle ratio (3 decimals, 0 when none),
    distinct recent trips. Both inputs go through one aggregation (no join)."""
    v = recent_vehicles(latest, params).select(
        F.lit(0).alias("kind"), (F.col("status") == "idle").alias("idle"), F.lit(None).cast("string").alias("trip"))
    t = _recent(events, "event_ts", params, params.trip_recency_s).select(
        F.lit(1).alias("kind"), F.lit(None).cast("boolean").alias("idle"), valid_trip().alias("trip"))
    u = v.unionByName(t)
    agg = u.agg(
        F.count(F.when(F.col("kind") == 0, True)).alias("active_vehicles"),
        F.count(F.when(F.col("idle"), True)).alias("idle_n"),
        F.count_distinct(F.col("trip")).alias("trips_recent"))
    n = F.col("active_vehicles")
    return agg.select(
        F.lit(params.current_day).alias("sim_day"), "active_vehicles",
        F.bround(F.coalesce(F.try_divide(F.col("idle_n"), n), F.lit(0.0)), 3).alias("idle_ratio"),
        "trips_recent")


def realtime_zones(zone_metrics: DataFrame, params) -> DataFrame:
    """Per zone, its latest window among those ending recently, with the dashboard's
    "earning" flag (earnings > 0). ``max_by`` keeps it an aggregate (no per-zone sort)."""
    recent = _recent(zone_metrics, "window_end", params, params.zone_recency_s)
    cols = [c for c in zone_metrics.columns if c != "zone"]
    latest = recent.groupBy("zone").agg(F.max_by(F.struct(*cols), F.col("window_start")).alias("w"))
    return latest.select("zone", *[F.col(f"w.{c}").alias(c) for c in cols]).withColumn(
        "earning", F.col("total_earnings") > 0)


def daily_report(report: DataFrame, day: int, show_profitable: bool = True,
                 show_unprofitable: bool = True) -> DataFrame:
    """One day's report, worst net profit first, with the dashboard's row filter."""
    r = report.where(F.col("sim_day") == F.lit(int(day)))
    if not (show_profitable and show_unprofitable):
        r = r.where(F.col("profitable") if show_profitable else
                    (~F.col("profitable") if show_unprofitable else F.lit(False)))
    return r.orderBy(F.col("net_profit").asc(), F.col("vehicle_id").asc())


def daily_report_counts(report: DataFrame) -> DataFrame:
    return report_counts(report)


def worst_best(report: DataFrame, k: int = 4) -> DataFrame:
    """The k lowest and k highest net profits of every day (ties broken by vehicle id).
    Spark limits each group on the map side (WindowGroupLimit), so a crowded day ships
    at most k rows per task to its reducer."""
    r = report.select("sim_day", "vehicle_id", "net_profit")
    worst = r.withColumn("rank", F.row_number().over(
        Window.partitionBy("sim_day").orderBy(F.col("net_profit").asc(), F.col("vehicle_id").asc())))
    best = r.withColumn("rank", F.row_number().over(
        Window.partitionBy("sim_day").orderBy(F.col("net_profit").desc(), F.col("vehicle_id").asc())))
    return (worst.where(F.col("rank") <= k).withColumn("side", F.lit("worst"))
            .unionByName(best.where(F.col("rank") <= k).withColumn("side", F.lit("best")))
            .select("sim_day", "side", F.col("rank").cast("int").alias("rank"), "vehicle_id", "net_profit"))


def profitability_summary(report: DataFrame) -> DataFrame:
    """Profitable / unprofitable split of the latest reported day, zeros when there is none.
    Per-day counts first, then the latest day's row by ``max_by`` (no join)."""
    per_day = report.groupBy("sim_day").agg(
        F.count(F.lit(1)).alias("vehicle_count"),
        F.count(F.when(F.col("profitable"), True)).alias("profitable_count"),
        F.count(F.when(~F.col("profitable"), True)).alias("unprofitable_count"))
    last = per_day.agg(F.max_by(F.struct("sim_day", "vehicle_count", "profitable_count", "unprofitable_count"),
                                F.col("sim_day")).alias("s"))
    n = F.coalesce("s.vehicle_count", F.lit(0))
    p = F.coalesce("s.profitable_count", F.lit(0))
    return last.select(
        F.col("s.sim_day").alias("sim_day"), n.alias("vehicle_count"), p.alias("profitable_count"),
        F.coalesce("s.unprofitable_count", F.lit(0)).alias("unprofitable_count"),
        F.round(F.try_divide(F.lit(100.0) * p, n)).cast("int").alias("profitable_pct"))


def vehicles(latest: DataFrame) -> DataFrame:
    return latest.select("vehicle_id").distinct().orderBy("vehicle_id")


def _trend_join(earnings: DataFrame, report: DataFrame) -> DataFrame:
    r = report.select("vehicle_id", "sim_day", "net_profit", "profitable")
    return earnings.join(r, ["vehicle_id", "sim_day"], "left")


def income_trend_fleet(earnings: DataFrame, report: DataFrame, days: int | None = None) -> DataFrame:
    """Fleet income per day for the latest ``days`` days (clamped; None: all days),
    chronological. ``net_profit`` and ``profitable`` stay null for days with no reconciled
    vehicle."""
    g = _trend_join(earnings, report).groupBy("sim_day").agg(
        F.sum("total_fare").alias("total_fare"),
        F.sum("trip_count").cast("long").alias("trip_count"),
        F.sum("net_profit").alias("net_profit"))
    g = g.withColumn("profitable", F.when(F.col("net_profit").isNotNull(), F.col("net_profit") > 0))
    if days is not None:
        g = g.orderBy(F.col("sim_day").desc()).limit(clamp_days(days))
    return g.orderBy("sim_day")


def income_trend_vehicle(earnings: DataFrame, report: DataFrame, vehicle_id: str | None = None,
                         days: int | None = None) -> DataFrame:
    """Chronological per-vehicle income for each vehicle's latest ``days`` days (clamped;
    None: all days), of one vehicle when given."""
    e = earnings if vehicle_id is None else earnings.where(F.col("vehicle_id") == vehicle_id)
    j = _trend_join(e, report)
    if days is not None:
        w = Window.partitionBy("vehicle_id").orderBy(F.col("sim_day").desc())
        j = j.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= clamp_days(days))
    return (j.select("vehicle_id", "sim_day", "total_fare", "trip_count", "net_profit", "profitable")
            .orderBy("vehicle_id", "sim_day"))


def income_filter(trend: DataFrame, show_profitable: bool = True, show_unprofitable: bool = True) -> DataFrame:
    """Dashboard filter: unreconciled days (profitable null) are always kept."""
    p = F.col("profitable")
    keep = p.isNull() | (p & F.lit(show_profitable)) | (~p & F.lit(show_unprofitable))
    return trend.where(keep)


def income_by_month(trend: DataFrame) -> DataFrame:
    """30-day "month" buckets of already selected days; net profit and its flag come only
    from reconciled days (flag null when a month has none)."""
    has = F.col("net_profit").isNotNull()
    g = trend.groupBy(F.floor(F.col("sim_day") / F.lit(C.DAYS_PER_MONTH)).cast("int").alias("month")).agg(
        F.sum("total_fare").alias("total_fare"),
        F.sum("trip_count").cast("long").alias("trip_count"),
        F.coalesce(F.sum("net_profit"), F.lit(0.0)).alias("net_profit"),
        F.max(has).alias("__has"))
    return g.select("month", "total_fare", "trip_count", "net_profit",
                    F.when(F.col("__has"), F.col("net_profit") > 0).alias("profitable"))


def income_total(trend: DataFrame) -> DataFrame:
    """Total income over the shown range."""
    return trend.agg(F.coalesce(F.sum("total_fare"), F.lit(0.0)).alias("total_income"),
                     F.count(F.lit(1)).alias("n_points"))


def pipeline_health(events: DataFrame, params) -> DataFrame:
    """Last event time, telemetry lag at ``as_of``, overall status (degraded when there is
    no event or the lag exceeds the staleness threshold)."""
    last = known_at(events, params.as_of, params).agg(
        F.max("event_ts").alias("last_event_at"))
    lag = seconds_between(lit_ts(params.as_of), F.col("last_event_at"))
    degraded = F.col("last_event_at").isNull() | (lag > F.lit(float(params.staleness_threshold_s)))
    return last.select(
        F.lit(params.current_day).alias("sim_day"), "last_event_at", lag.alias("telemetry_lag_seconds"),
        F.when(degraded, "degraded").otherwise("healthy").alias("status"),
        F.lit(int(params.staleness_threshold_s)).alias("staleness_threshold_seconds"))


def gauges(events: DataFrame, alerts: DataFrame, params) -> DataFrame:
    """Monitoring gauges in one row: telemetry lag at ``as_of`` and unresolved alerts.
    Both inputs feed one aggregation (no join)."""
    e = known_at(events, params.as_of, params).select(
        F.col("event_ts").alias("t"), F.lit(None).cast("boolean").alias("open"))
    a = alerts.select(F.lit(None).cast("timestamp").alias("t"), (~F.col("resolved")).alias("open"))
    g = e.unionByName(a).agg(F.max("t").alias("last_event_at"),
                             F.count(F.when(F.col("open"), True)).alias("unresolved_alerts"))
    return g.select(seconds_between(lit_ts(params.as_of), F.col("last_event_at")).alias("telemetry_lag_seconds"),
                    "unresolved_alerts")


def alerts_recent(alerts: DataFrame, include_resolved: bool = False, limit: int = 200) -> DataFrame:
    """Newest alerts first (open only unless ``include_resolved``), at most ``limit``."""
    a = alerts if include_resolved else alerts.where(~F.col("resolved"))
    return a.orderBy(F.col("created_at").desc(), F.col("alert_type"), F.col("entity_id")).limit(limit)
