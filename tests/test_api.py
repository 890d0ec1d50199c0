"""The API over a storage root filled by the speed layer and the batch jobs equals the
registered queries over the same fixture."""

from pyspark.sql import functions as F

from conftest import SF001
from drover.api import FleetStore
from drover.operators import serving as SV
from drover.plans.inputs import Inputs, export
from drover.sources.expenses import write_landing
from drover.sources.telemetry import file_telemetry, to_wire
from drover.streaming import jobs as J
from drover.streaming.staging import stage_in_order


def _rows(df):
    return sorted(tuple(r) for r in export(df).collect())


def test_api_end_to_end(spark, tmp_path):
    x = Inputs(spark, SF001)
    land = str(tmp_path / "land")
    stage_in_order(to_wire(x.raw, keep=("event_id",)), land, "event_id", 4)
    root = str(tmp_path / "fleet")
    once = {n: {"availableNow": True} for n in ("raw_log", "zone_metrics", "daily_earnings", "recent", "vehicle_status")}
    for q in J.start_speed_layer(spark, file_telemetry(spark, land, 2), x.params, root, run_id=1,
                                 triggers=once).values():
        J.run_to_end(q)
    store = FleetStore(spark, root, x.params)
    before = _rows(store.earnings())
    store.compact()  # reads now go through the snapshots
    assert _rows(store.earnings()) == before
    exp_land = str(tmp_path / "expenses_landing")
    write_landing(x.expenses, exp_land)
    store.load_expenses(exp_land)
    store.reconcile()

    cols = ["vehicle_id", "sim_day", "total_fare", "net_profit", "profitable"]
    assert _rows(store.report().select(*cols).withColumn("sim_day", F.col("sim_day").cast("int"))) == \
        _rows(x.report.select(*cols))
    assert _rows(store.profitability_summary()) == _rows(SV.profitability_summary(x.report))
    rt = store.realtime()
    assert rt["summary"].collect()[0].active_vehicles == 12
    assert _rows(rt["summary"]) == _rows(SV.realtime_summary(x.recent, x.events, x.params))
    assert store.vehicles().count() == 15
    assert store.income_trend().count() == 30
    store.refresh_trend(range(0, 20))
    store.refresh_trend(range(15, 30))
    assert _rows(store.stored_trend()) == _rows(store.income_trend().withColumn("sim_day", F.col("sim_day").cast("int")))
    assert store.income_trend(vehicle_id="V000001").count() > 0
    months = store.income_trend(by_month=True, show_unprofitable=False).collect()
    assert len(months) == 1 and months[0].profitable is not False
    assert store.daily_report(29).count() == x.report.where("sim_day = 29").count()
    # live status (from the stream) equals the exact batch form for in-order input
    cols = ["vehicle_id", "status", "status_since", "updated_at"]
    assert _rows(store.live_status().select(*cols)) == _rows(x.latest.select(*cols))
    # replaying history (raw log as of each time) gives the registered alert state
    a1 = store.evaluate_alerts(x.params.as_of - 86400, live=False)
    a2 = store.evaluate_alerts(live=False)
    assert a2.count() >= a1.count() > 0
    assert _rows(store.alerts(include_resolved=True)) == _rows(x.alert_state())
    # the live round reads heartbeats and the status stream: same conditions at as_of
    from drover.operators import alerts as A
    live = A.alert_conditions(store.last_events(), store.report(), x.params, latest=store.live_status())
    assert _rows(live) == _rows(A.alert_conditions(x.events, x.report, x.params))
    comps = {r.component for r in store.health()["components"].collect()}
    assert comps == {"stream-processor", "reconciliation", "watchdog"}
    assert _rows(store.health()["pipeline"]) == _rows(SV.pipeline_health(x.events, x.params))


def test_fresh_store(spark, tmp_path):
    """Before the first data every call answers, and the first round raises both alerts."""
    from drover.config import FIXTURE_PARAMS as P
    store = FleetStore(spark, str(tmp_path / "fresh"), P)
    assert store.vehicles().count() == store.report().count() == store.earnings().count() == store.events().count() == 0
    assert store.zone_metrics().count() == 0
    health = store.health()
    assert health["components"].count() == 0 and health["pipeline"].collect()[0] is not None
    now = store.realtime()
    s = now["summary"].collect()[0]
    assert s.active_vehicles == 0 and now["status"].count() == now["zones"].count() == 0
    store.reconcile()
    store.catch_up()
    store.compact()
    assert store.income_trend().count() == 0
    raised = {(r.alert_type, r.severity) for r in store.evaluate_alerts().collect()}
    assert raised == {("pipeline_staleness", "critical"), ("reconciliation_missing", "critical")}
    assert store.health()["components"].first().updated_at is not None
