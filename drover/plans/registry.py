"""Named queries: each takes (spark, sf_dir) and returns a DataFrame in portable form
(see :func:`drover.plans.inputs.export`). The SQL oracle of each is in ``oracle.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.operators import activity as AC
from drover.operators import alert_log as AL
from drover.operators import alerts as A
from drover.operators import metrics as M
from drover.operators import reconcile as R
from drover.operators import serving as SV
from drover.operators import status as S
from drover.operators import trend_deltas as TD
from drover.operators.clean import clean, quarantine_counts
from drover.plans.inputs import Inputs, export

#: Rounds of the alert log, as seconds from ``as_of``.
ALERT_ROUNDS = (-2 * 86400, -86400, 0)

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return export(fn(Inputs(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return deco


# ---------------------------------------------------------------- batch layer
@query("profitability_report")
def _profitability_report(x: Inputs):
    """Expenses joined with daily earnings -> net profit, cost per km, profitable."""
    return x.report


@query("expense_feed")
def _expense_feed(x: Inputs):
    """Expenses landed as per-day CSV files, then read back through the landing reader."""
    from drover.session import scratch_path
    from drover.sources.expenses import read_expense_feed, write_landing
    path = scratch_path(x.spark, "landing")
    write_landing(x.expenses, path)
    return read_expense_feed(x.spark, path)


def _corrected_expenses(x: Inputs):
    """Write all expenses as a day-partitioned table, then upsert a corrected
    feed of day 3 by (vehicle_id, sim_day); returns the table path."""
    from drover.session import scratch_path
    from drover.sources.fixtures import expense_correction_rows
    path = scratch_path(x.spark, "expenses")
    R.merge_expenses(x.expenses, path)
    R.merge_expenses(expense_correction_rows(x.spark, x.sf_dir, 3), path)
    return path


@query("expense_correction")
def _expense_correction(x: Inputs):
    """The expenses table after a corrected file for one day: its vehicles are updated, the others stay."""
    return x.spark.read.parquet(_corrected_expenses(x)).select(
        "vehicle_id", F.col("sim_day").cast("int").alias("sim_day"),
        "fuel_cost", "maintenance_cost", "distance_covered", "service_flag")


@query("report_rerun")
def _report_rerun(x: Inputs):
    """Reconcile every day, then rerun day 3 after its expenses were corrected; only that
    day's report partition is replaced."""
    from drover.session import scratch_path
    from drover.sources.fixtures import expense_correction_rows
    exp_path = scratch_path(x.spark, "expenses")
    rep_path = scratch_path(x.spark, "report")
    R.merge_expenses(x.expenses, exp_path)
    R.reconcile(x.spark, exp_path, x.earnings, rep_path)
    R.merge_expenses(expense_correction_rows(x.spark, x.sf_dir, 3), exp_path)
    R.reconcile(x.spark, exp_path, x.earnings, rep_path, days=[3])
    rep = x.spark.read.parquet(rep_path)
    return rep.select(*[F.col(c).cast("int").alias(c) if c == "sim_day" else F.col(c) for c in R.REPORT_COLUMNS])


@query("unmatched_earnings")
def _unmatched_earnings(x: Inputs):
    return R.unmatched_earnings(x.earnings, x.expenses)


@query("closed_days")
def _closed_days(x: Inputs):
    return R.closed_days(x.earnings, x.expenses, x.report, x.params)


@query("batch_health")
def _batch_health(x: Inputs):
    """Health of every closed day on which the fleet was active."""
    days = x.earnings.where((F.col("sim_day") >= 0) & (F.col("sim_day") < x.params.current_day)).select("sim_day")
    return R.batch_health(x.report, days)


# ---------------------------------------------------------------- speed layer (batch form)
@query("clean_events")
def _clean_events(x: Inputs):
    """Broker messages decoded by the fixed schema, parsed and filtered."""
    c = clean(x.decoded)
    return c.select("event_id", "vehicle_id", "driver_id", "trip_id", "status",
                    "lat", "lon", "speed", "fare", "event_ts")


@query("quarantine_counts")
def _quarantine_counts(x: Inputs):
    return quarantine_counts(x.decoded)


@query("zone_enrichment")
def _zone_enrichment(x: Inputs):
    return x.events.select("event_id", "vehicle_id", "status", "event_ts", "zone", "sim_day")


@query("zone_metrics_1min")
def _zone_metrics_1min(x: Inputs):
    return x.zones_1min


@query("zone_metrics_hourly")
def _zone_metrics_hourly(x: Inputs):
    return M.zone_metrics(x.events, x.params, "1 hour")


@query("zone_metrics_daily")
def _zone_metrics_daily(x: Inputs):
    return M.zone_metrics(x.events, x.params, "1 day")


@query("daily_earnings")
def _daily_earnings(x: Inputs):
    return x.earnings


@query("vehicle_status_latest")
def _vehicle_status_latest(x: Inputs):
    return x.latest


@query("status_spells")
def _status_spells(x: Inputs):
    return x.spells


@query("vehicle_day_activity")
def _vehicle_day_activity(x: Inputs):
    return AC.vehicle_day_activity(x.earnings, AC.day_distance(x.events, x.params))


@query("vehicle_idle_seconds")
def _vehicle_idle_seconds(x: Inputs):
    return S.idle_seconds_by_day(x.spells, x.params)


# ---------------------------------------------------------------- serving
@query("realtime_summary")
def _realtime_summary(x: Inputs):
    return SV.realtime_summary(x.recent, x.events, x.params)


@query("realtime_status")
def _realtime_status(x: Inputs):
    return SV.realtime_status(x.recent, x.params)


@query("realtime_zones")
def _realtime_zones(x: Inputs):
    return SV.realtime_zones(x.zones_1min, x.params)


@query("daily_report")
def _daily_report(x: Inputs):
    """The report of the dashboard's default day (the day that just closed)."""
    return SV.daily_report(x.report, SV.default_report_day(x.params)).drop("sim_day")


@query("daily_report_counts")
def _daily_report_counts(x: Inputs):
    return SV.daily_report_counts(x.report)


@query("worst_best_k")
def _worst_best_k(x: Inputs):
    return SV.worst_best(x.report, 4)


@query("profitability_summary")
def _profitability_summary(x: Inputs):
    return SV.profitability_summary(x.report)


@query("income_trend_fleet")
def _income_trend_fleet(x: Inputs):
    return SV.income_trend_fleet(x.earnings, x.report)


@query("income_trend_vehicle")
def _income_trend_vehicle(x: Inputs):
    return SV.income_trend_vehicle(x.earnings, x.report)


@query("income_trend_month")
def _income_trend_month(x: Inputs):
    return SV.income_by_month(SV.income_filter(SV.income_trend_fleet(x.earnings, x.report)))


@query("income_total")
def _income_total(x: Inputs):
    return SV.income_total(SV.income_filter(SV.income_trend_fleet(x.earnings, x.report)))


@query("income_trend_incremental")
def _income_trend_incremental(x: Inputs):
    """Fleet income kept up by delta joins: first the earnings of events up to 10.5 days before
    ``as_of``, some rows that do not last, and a report with doubled fuel costs on every fifth
    day; then all of the later days' earnings, and the report of the days that change."""
    from drover.functions import lit_ts
    from drover.session import scratch_path
    store, cut = scratch_path(x.spark, "trend"), x.params.as_of - 10.5 * 86400
    from_day = x.params.day_at(cut)
    early = M.daily_earnings(x.events.where(F.col("event_ts") < lit_ts(cut)))
    doubled = x.expenses.withColumn("fuel_cost", F.col("fuel_cost") * F.when(F.col("sim_day") % 5 == 0, 2.0).otherwise(1.0))
    passing = early.where(F.col("sim_day") % 7 == 0).withColumn("vehicle_id", F.concat(F.lit("X"), "vehicle_id"))
    TD.apply(x.spark, store, 1, early.unionByName(passing), R.profitability(doubled, early))
    TD.apply(x.spark, store, 2, x.earnings.where(F.col("sim_day") >= from_day).withColumn("removed", F.lit(False)).unionByName(
        passing.withColumn("removed", F.lit(True))))
    fixed = x.report.where((F.col("sim_day") >= from_day) | (F.col("sim_day") % 5 == 0))
    TD.apply(x.spark, store, 3, report=fixed)
    TD.apply(x.spark, store, 3, report=fixed)       # applied before: changes nothing
    return TD.trend(x.spark, store)


@query("vehicles")
def _vehicles(x: Inputs):
    return SV.vehicles(S.as_of_filter(x.events, x.params))


@query("pipeline_health")
def _pipeline_health(x: Inputs):
    return SV.pipeline_health(x.events, x.params)


@query("alerts_recent")
def _alerts_recent(x: Inputs):
    return SV.alerts_recent(x.alert_state(), include_resolved=True)


@query("metrics_gauges")
def _metrics_gauges(x: Inputs):
    """Telemetry lag and unresolved alert count (the monitoring gauges)."""
    return SV.gauges(x.events, x.alert_state(), x.params)


# ---------------------------------------------------------------- alerts
@query("alert_conditions")
def _alert_conditions(x: Inputs):
    return A.alert_conditions(x.events, x.report, x.params, latest=x.latest)


@query("alert_lifecycle")
def _alert_lifecycle(x: Inputs):
    return x.alert_state()


@query("alert_lifecycle_as_of")
def _alert_lifecycle_as_of(x: Inputs):
    """The alert log after three rounds, folded as of each of them."""
    from functools import reduce
    store = x.alert_rounds(ALERT_ROUNDS)
    folds = [AL.alerts_as_of(x.spark, store, x.params.as_of + off).withColumn("days_before", F.lit(-off // 86400))
             for off in ALERT_ROUNDS]
    return reduce(lambda a, b: a.unionByName(b), folds)


@query("staleness_gaps")
def _staleness_gaps(x: Inputs):
    return A.staleness_gaps(x.events, x.params.staleness_threshold_s)


@query("idle_spells")
def _idle_spells(x: Inputs):
    return S.idle_spells(x.spells, x.params.idle_threshold_s)


def queries() -> dict[str, QueryFn]:
    from drover.streaming import registry as _streams  # noqa: F401  (registers stream queries)
    return dict(_REGISTRY)


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Flagship: the daily profitability report."""
    return _REGISTRY["profitability_report"](spark, sf_dir)
