"""The fleet API as DataFrames over one storage root.

``FleetStore`` binds the serving, reconciliation and alert operators to the layout that
``streaming.jobs.start_speed_layer`` and the batch jobs write under ``root``:

    raw_log/           cleaned events, partitioned by sim_day / run / batch_id
    zone_metrics/      membership deltas of window x zone metrics
    daily_earnings/    membership deltas of running (vehicle, day) totals
    vehicle_status/    changelog of latest status per vehicle
    recent/            members per minute (recent.folds/: per minute, hour and day)
    heartbeats/        heartbeat changelog per component
    expenses/          expenses table, partitioned by sim_day
    report/            profitability report, partitioned by sim_day
    trend/             income per day as deltas of commits
    alerts/            alert transitions and the open set, by round

Every method returns DataFrames (nothing is collected); times are explicit ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.schemas import EARNINGS_SCHEMA, EXPENSES_SCHEMA, RAW_LOG_SCHEMA, STATUS_SCHEMA, ZONE_METRICS_SCHEMA
from drover.session import path_exists
from drover.config import Params
from drover.operators import alert_log as AL
from drover.operators import alerts as A
from drover.operators import metrics as M
from drover.operators import reconcile as R
from drover.operators import serving as SV
from drover.operators import status as S
from drover.operators import trend_deltas as TD
from drover.operators.landing import merge_landed
from drover.sources.expenses import read_expense_feed
from drover.streaming import changelog as CL
from drover.streaming import jobs as J
from drover.streaming import member_deltas as MD
from drover.streaming import recent_rollups as RR


class FleetStore:
    def __init__(self, spark: SparkSession, root: str, params: Params):
        self.spark, self.root, self.params = spark, root.rstrip("/"), params

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _at(self, as_of: float | None) -> Params:
        return self.params if as_of is None else self.params.replace(as_of=as_of)

    # ---------------------------------------------------------------- stored state
    def _has(self, name: str) -> bool:
        return path_exists(self.spark, self.path(name))

    def _none(self, schema) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _snapshots(self, name: str) -> str:
        return self.path(f"snapshots/{name}")

    def compact(self) -> None:
        """Fold deltas and changelog into new snapshots (older batches can then be archived)."""
        for name, totals in (("zone_metrics", M.zone_totals()), ("daily_earnings", M.earnings_totals())):
            if self._has(name):
                MD.compact(self.spark, self.path(name), totals, self._snapshots(name))
        if self._has("vehicle_status"):
            CL.compact(self.spark, self.path("vehicle_status"), ["vehicle_id"], self._snapshots("vehicle_status"))
        if self._has("recent"):
            RR.fold(self.spark, self.path("recent"))

    def events(self) -> DataFrame:
        if not self._has("raw_log"):
            return self._none(RAW_LOG_SCHEMA).drop("run", "batch_id")
        return CL.read_raw_log(self.spark, self.path("raw_log"))

    def earnings(self) -> DataFrame:
        if not self._has("daily_earnings"):
            return self._none(EARNINGS_SCHEMA)
        return J.earnings_at(self.spark, self.path("daily_earnings"), snapshots=self._snapshots("daily_earnings"))

    def zone_metrics(self, where=None) -> DataFrame:
        if not self._has("zone_metrics"):
            return self._none(ZONE_METRICS_SCHEMA)
        return J.zone_metrics_at(self.spark, self.path("zone_metrics"), where, snapshots=self._snapshots("zone_metrics"))

    def latest_status(self, as_of: float | None = None) -> DataFrame:
        """Exact latest status as of a time, recomputed from the raw log (history queries)."""
        return S.latest_status(self.events(), self._at(as_of))

    def live_status(self) -> DataFrame:
        """Latest status per vehicle as maintained by the status stream (one row per vehicle;
        reads the small changelog, not the raw log)."""
        if self._has("vehicle_status"):
            s = CL.resolve_compacted(self.spark, self.path("vehicle_status"), ["vehicle_id"], self._snapshots("vehicle_status"))
        else:
            s = self._none(STATUS_SCHEMA)
        return s.select("vehicle_id", "driver_id", "lat", "lon", "speed", "status", "zone", "last_fare", "sim_day",
                        F.timestamp_micros("status_since_us").alias("status_since"),
                        F.timestamp_micros("updated_at_us").alias("updated_at"))

    def last_events(self) -> DataFrame:
        """Newest event time per stream micro-batch, from the heartbeats (a few rows per
        minute): what the staleness rule and the health check need, without a scan of the
        raw log."""
        if not self._has("heartbeats"):
            return self._none("event_ts timestamp")
        hb = CL.read_log(self.spark, self.path("heartbeats"))
        return hb.where(F.col("component") == "stream-processor").select(F.col("last_event_at").alias("event_ts"))

    def recent_zone_metrics(self, since: float) -> DataFrame:
        """Zone windows ending after ``since``; the time predicate is applied to the deltas and
        reaches the Parquet reader."""
        return self.zone_metrics(F.col("window_end") > F.timestamp_micros(F.lit(int(since * 1_000_000))))

    def report(self) -> DataFrame:
        if not self._has("report"):
            return R.profitability(self._none(EXPENSES_SCHEMA), self._none(EARNINGS_SCHEMA))
        return self.spark.read.parquet(self.path("report"))

    # ---------------------------------------------------------------- endpoints
    def health(self, as_of: float | None = None) -> dict[str, DataFrame]:
        components = CL.component_health(self.spark, self.path("heartbeats")) if self._has("heartbeats") else self._none(
            "component string, status string, last_event_at timestamp, updated_at timestamp")
        return {"pipeline": SV.pipeline_health(self.last_events(), self._at(as_of)), "components": components}

    def realtime(self, as_of: float | None = None) -> dict[str, DataFrame]:
        """Live state: the summary from the member rollups (the raw log for the ends of a range
        that are no whole minute; for all of it where no rollup has been started), status from
        the status stream, latest zone windows."""
        p = self._at(as_of)
        latest = self.live_status()
        if self._has("recent"):
            summary = RR.summary(self.spark, self.path("recent"), self.events(), p)
        else:
            summary = SV.realtime_summary(latest, self.events(), p)
        return {"summary": summary,
                "status": SV.realtime_status(latest, p),
                "zones": SV.realtime_zones(self.recent_zone_metrics(p.as_of - p.zone_recency_s), p)}

    def daily_report(self, day: int, show_profitable: bool = True, show_unprofitable: bool = True) -> DataFrame:
        return SV.daily_report(self.report(), day, show_profitable, show_unprofitable)

    def daily_report_counts(self) -> DataFrame:
        return SV.daily_report_counts(self.report())

    def profitability_summary(self) -> DataFrame:
        return SV.profitability_summary(self.report())

    def vehicles(self) -> DataFrame:
        return SV.vehicles(self.live_status())

    def income_trend(self, vehicle_id: str | None = None, days: int | None = None, by_month: bool = False,
                     show_profitable: bool = True, show_unprofitable: bool = True) -> DataFrame:
        """Income per day (fleet, or one vehicle) for the latest ``days`` days (1 to 500,
        default 200: the endpoint's own argument), optionally
        filtered like the dashboard (unreconciled days always kept) and bucketed into
        30-day months after the filter."""
        days = SV.clamp_days(days)
        if vehicle_id is not None:
            t = SV.income_trend_vehicle(self.earnings(), self.report(), vehicle_id, days)
        else:
            t = SV.income_trend_fleet(self.earnings(), self.report(), days)
        t = SV.income_filter(t, show_profitable, show_unprofitable)
        return SV.income_by_month(t) if by_month else t

    def refresh_trend(self, days: list[int]) -> None:
        """Bring the stored fleet trend up to date for days whose earnings or reports may have
        changed (those that closed, were corrected, or got late events); others are not read."""
        mine = [int(d) for d in days]
        n = max(TD.commits(self.spark, self.path("trend")), default=0) + 1
        TD.apply(self.spark, self.path("trend"), n, self.earnings().where(F.col("sim_day").isin(mine)),
                 self.report().where(F.col("sim_day").isin(mine)), whole_days=mine)

    def stored_trend(self) -> DataFrame:
        """Fleet income of all days as of the last ``refresh_trend``, without a join."""
        return TD.trend(self.spark, self.path("trend"))

    def alerts(self, include_resolved: bool = False, as_of: float | None = None) -> DataFrame:
        """The newest alerts, open ones only unless asked; ``as_of``: as they were then."""
        return SV.alerts_recent(AL.alerts_as_of(self.spark, self.path("alerts"), as_of), include_resolved)

    # ---------------------------------------------------------------- batch jobs
    def load_expenses(self, landing_path: str, days=None) -> None:
        """Load landed expense files (all, or the given days) into the expenses table, the
        newest file of a vehicle's day winning."""
        feed = read_expense_feed(self.spark, landing_path, with_file=True)
        if days is not None:
            feed = feed.where(F.col("sim_day").isin([int(d) for d in ([days] if isinstance(days, int) else days)]))
        merge_landed(feed, self.path("expenses"))

    def reconcile(self, days=None) -> None:
        R.reconcile(self.spark, self.path("expenses"), self.earnings(), self.path("report"), days,
                    heartbeat_path=self.path("heartbeats"))

    def catch_up(self, as_of: float | None = None) -> None:
        """Reconcile every closed day with expenses and no report yet, together."""
        R.reconcile_pending(self.spark, self.path("expenses"), self.earnings(), self.path("report"),
                            self._at(as_of), heartbeat_path=self.path("heartbeats"))

    def evaluate_alerts(self, as_of: float | None = None, live: bool = True) -> DataFrame:
        """One watchdog + batch-health round at ``as_of`` against the alert store.

        ``live=True`` (a running pipeline): staleness from the heartbeats, idle vehicles from
        the status stream. ``live=False`` (replaying history): both recomputed from the raw
        log as of ``as_of``.
        """
        p = self._at(as_of)
        if live:
            firing = A.alert_conditions(self.last_events(), self.report(), p, latest=self.live_status())
        else:
            firing = A.alert_conditions(self.events(), self.report(), p)
        AL.evaluate_round(self.spark, self.path("alerts"), firing, p)
        CL.record_heartbeat(self.spark, self.path("heartbeats"), "watchdog")
        return AL.alerts_as_of(self.spark, self.path("alerts"))
