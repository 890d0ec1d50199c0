"""Profitability report: golden rows, null and strict rules, reruns, empty days."""

import pytest
from pyspark.sql import functions as F

from drover.operators import reconcile as R
from drover.schemas import EARNINGS_SCHEMA, EXPENSES_SCHEMA

# Eight published rows of one reconciled day: vehicle, fare, fuel, maintenance, net.
GOLDEN = [
    ("V018", 3.42, 0.19, 45.86, -42.64),
    ("V003", 0.00, 0.03, 17.75, -17.78),
    ("V024", 0.00, 0.00, 4.12, -4.12),
    ("V006", 1.75, 0.11, 4.70, -3.06),
    ("V010", 3.80, 0.28, 2.83, 0.69),
    ("V009", 3.43, 0.16, 2.44, 0.83),
    ("V023", 3.84, 0.25, 2.25, 1.34),
    ("V022", 5.07, 0.27, 2.32, 2.48),
]


def _frames(spark, rows, day=164):
    exp = spark.createDataFrame([(v, day, fu, m, 1.0, False) for v, _, fu, m, _ in rows], EXPENSES_SCHEMA)
    earn = spark.createDataFrame([(v, day, f, 1) for v, f, _, _, _ in rows if f > 0], EARNINGS_SCHEMA)
    return exp, earn


def test_golden_rows(spark):
    exp, earn = _frames(spark, GOLDEN)
    got = {r.vehicle_id: r for r in R.profitability(exp, earn).collect()}
    for v, fare, fuel, maint, net in GOLDEN:
        r = got[v]
        assert r.total_fare == pytest.approx(fare)
        assert abs(r.net_profit - net) <= 0.0100001
        assert r.profitable is (r.net_profit > 0)


def test_null_cost_per_km_and_strict_profit(spark):
    exp = spark.createDataFrame([("A", 1, 1.0, 1.0, 0.0, False), ("B", 1, 1.0, 1.0, 4.0, True),
                                 ("C", 1, 0.0, 0.0, -1.0, False)], EXPENSES_SCHEMA)
    earn = spark.createDataFrame([("A", 1, 2.0, 1), ("B", 1, 3.0, 1), ("Z", 1, 9.0, 2)], EARNINGS_SCHEMA)
    got = {r.vehicle_id: r for r in R.profitability(exp, earn).collect()}
    assert got["A"].cost_per_km is None and got["A"].net_profit == 0.0 and got["A"].profitable is False
    assert got["B"].cost_per_km == pytest.approx(0.5) and got["B"].profitable is True
    assert got["C"].cost_per_km is None and got["C"].total_fare == 0.0
    assert "Z" not in got  # earnings without expenses are not in the report ...
    un = R.unmatched_earnings(earn, exp).collect()
    assert [r.vehicle_id for r in un] == ["Z"]  # ... but are reported here


def test_rerun_replaces_only_that_day_and_empty_changes_nothing(spark, tmp_path):
    exp_path, rep_path = str(tmp_path / "exp"), str(tmp_path / "rep")
    exp = spark.createDataFrame([("A", 1, 1.0, 1.0, 1.0, False), ("B", 1, 1.0, 1.0, 1.0, False),
                                 ("A", 2, 1.0, 1.0, 1.0, False)], EXPENSES_SCHEMA)
    earn = spark.createDataFrame([("A", 1, 5.0, 1), ("B", 1, 1.0, 1), ("A", 2, 0.5, 1)], EARNINGS_SCHEMA)
    R.upsert_days(exp, exp_path)
    R.reconcile(spark, exp_path, earn, rep_path)
    assert spark.read.parquet(rep_path).count() == 3
    # corrected day 1: B removed, A's maintenance doubled
    R.upsert_days(spark.createDataFrame([("A", 1, 1.0, 2.0, 1.0, False)], EXPENSES_SCHEMA), exp_path)
    R.reconcile(spark, exp_path, earn, rep_path, days=[1])
    rep = {(r.vehicle_id, r.sim_day): r for r in spark.read.parquet(rep_path).collect()}
    assert set(rep) == {("A", 1), ("A", 2)}
    assert rep[("A", 1)].net_profit == pytest.approx(2.0)
    # a day without expenses writes nothing and keeps the previous report
    R.reconcile(spark, exp_path, earn, rep_path, days=[7])
    assert spark.read.parquet(rep_path).count() == 2
    # rerunning the same day twice gives the same table
    R.reconcile(spark, exp_path, earn, rep_path, days=[1])
    assert spark.read.parquet(rep_path).count() == 2


def test_batch_health_rules(spark):
    exp = spark.createDataFrame([("A", 1, 9.0, 1.0, 1.0, False), ("B", 1, 9.0, 1.0, 1.0, False),
                                 ("A", 2, 9.0, 1.0, 1.0, False), ("B", 2, 0.0, 0.0, 1.0, False)], EXPENSES_SCHEMA)
    earn = spark.createDataFrame([("A", 1, 1.0, 1), ("B", 1, 20.0, 1), ("A", 2, 1.0, 1), ("B", 2, 1.0, 1)],
                                 EARNINGS_SCHEMA)
    report = R.profitability(exp, earn)
    days = spark.createDataFrame([(1,), (2,), (3,)], "sim_day int")
    got = {r.sim_day: r for r in R.batch_health(report, days).collect()}
    assert got[1].alert_type is None  # exactly half unprofitable is not "more than half"
    assert got[2].alert_type is None
    assert got[3].alert_type == "reconciliation_missing" and got[3].severity == "critical"
    exp3 = exp.where(F.col("sim_day") == 1).withColumn("fuel_cost", F.lit(50.0))
    got = R.batch_health(R.profitability(exp3, earn), days.where("sim_day = 1")).collect()[0]
    assert got.alert_type == "fleet_profitability" and got.message == "2/2 vehicles unprofitable on sim_day=1"


def test_fixture_report_totals(fixture_inputs):
    agg = fixture_inputs.report.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("profitable"), True)).alias("p"),
        F.count(F.when(F.col("cost_per_km").isNull(), True)).alias("nullkm"),
        F.round(F.sum("net_profit"), 2).alias("net"), F.round(F.sum("fuel_cost"), 2).alias("fuel"),
        F.round(F.sum("maintenance_cost"), 2).alias("maint")).collect()[0]
    assert (agg.n, agg.p, agg.nullkm) == (430, 123, 56)
    assert (agg.net, agg.fuel, agg.maint) == (3551.28, 4693.40, 1272.61)


def test_closed_days_and_target(spark):
    from drover.config import Params
    p = Params(start_epoch=0.0, day_seconds=100, as_of=350.0)  # current day 3
    assert R.target_day(p) == 2 and R.target_day(p.replace(as_of=50.0)) is None
    earn = spark.createDataFrame([("A", d, 1.0, 1) for d in (-1, 0, 1, 2, 3)], EARNINGS_SCHEMA)
    exp = spark.createDataFrame([("A", d, 0.0, 0.0, 1.0, False) for d in (0, 2)], EXPENSES_SCHEMA)
    report = R.profitability(exp.where("sim_day = 0"), earn)
    got = {r.sim_day: (r.has_expenses, r.reconciled, r.is_target) for r in R.closed_days(earn, exp, report, p).collect()}
    # day -1 is before the start, day 3 is still open
    assert got == {0: (True, True, False), 1: (False, False, False), 2: (True, False, True)}


def test_distance_only_for_moving_steps_within_a_day(spark):
    from pyspark.sql import functions as F
    from drover.config import Params
    from drover.operators.activity import day_distance, vehicle_day_activity
    p = Params(start_epoch=0.0, day_seconds=100, bucket_seconds=7)
    rows = [("A", 0, 1, "idle", 0.0, 0.0), ("A", 10, 2, "on_trip", 0.0, 0.01),   # 0.01 deg moving
            ("A", 20, 3, "idle", 0.0, 0.02),                                      # idle step: not counted
            ("A", 30, 4, "enroute", 0.03, 0.02),                                   # 0.03 deg moving
            ("A", 120, 5, "on_trip", 1.0, 1.0)]                                    # first of day 1: no previous
    ev = spark.createDataFrame(rows, "vehicle_id string, t long, event_id long, status string, lat double, lon double") \
        .withColumn("event_ts", F.timestamp_seconds("t")).withColumn("sim_day", (F.col("t") / 100).cast("int"))
    d = {(r.vehicle_id, r.sim_day): r.distance_km for r in day_distance(ev, p).collect()}
    assert list(d) == [("A", 0)] and abs(d[("A", 0)] - 0.04 * 111.0) < 1e-9
    earn = spark.createDataFrame([("A", 1, 2.0, 1), ("B", 0, 0.0, 0)], EARNINGS_SCHEMA)
    act = {(r.vehicle_id, r.sim_day): (r.trip_count, round(r.distance_km, 6))
           for r in vehicle_day_activity(earn, day_distance(ev, p)).collect()}
    assert act == {("A", 0): (0, 4.44), ("A", 1): (1, 0.0), ("B", 0): (0, 0.0)}


def test_reconcile_pending_days_together(spark, tmp_path):
    from drover.config import Params
    p = Params(start_epoch=0.0, day_seconds=100, as_of=350.0)  # days 0..2 closed, 3 open
    exp_path, rep_path = str(tmp_path / "exp"), str(tmp_path / "rep")
    exp = spark.createDataFrame([("A", d, 1.0, 1.0, 1.0, False) for d in (0, 1, 2, 3)], EXPENSES_SCHEMA)
    earn = spark.createDataFrame([("A", d, 5.0, 1) for d in (0, 1, 2, 3)], EARNINGS_SCHEMA)
    R.upsert_days(exp, exp_path)
    R.reconcile(spark, exp_path, earn, rep_path, days=[0])
    before = {r.sim_day: r.net_profit for r in spark.read.parquet(rep_path).collect()}
    R.reconcile_pending(spark, exp_path, earn, rep_path, p)
    after = {r.sim_day: r.net_profit for r in spark.read.parquet(rep_path).collect()}
    assert before == {0: 3.0} and after == {0: 3.0, 1: 3.0, 2: 3.0}   # day 3 is not closed yet
    R.reconcile_pending(spark, exp_path, earn, rep_path, p)              # nothing left: no change
    assert spark.read.parquet(rep_path).count() == 3
