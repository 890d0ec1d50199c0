"""Serving queries: empty inputs, three-valued flags, filters, limits."""

from pyspark.sql import functions as F

from drover.config import Params
from drover.operators import serving as SV
from drover.operators.reconcile import profitability
from drover.schemas import EARNINGS_SCHEMA, EXPENSES_SCHEMA

P = Params(start_epoch=0.0, day_seconds=100, as_of=1000.0)


def test_summary_of_empty_report_is_zeros(spark):
    exp = spark.createDataFrame([], EXPENSES_SCHEMA)
    earn = spark.createDataFrame([], EARNINGS_SCHEMA)
    r = SV.profitability_summary(profitability(exp, earn)).collect()
    assert len(r) == 1
    assert (r[0].sim_day, r[0].vehicle_count, r[0].profitable_count, r[0].unprofitable_count) == (None, 0, 0, 0)


def test_trend_and_months_three_valued(spark):
    earn = spark.createDataFrame([("A", d, 1.0 * d, 1) for d in range(0, 65)], EARNINGS_SCHEMA)
    # only days 0..9 are reconciled; day 5 is a loss
    exp = spark.createDataFrame([("A", d, 10.0 if d == 5 else 0.0, 0.0, 1.0, False) for d in range(10)],
                                EXPENSES_SCHEMA)
    rep = profitability(exp, earn)
    trend = SV.income_trend_fleet(earn, rep, days=1000)  # clamped to 500
    rows = {r.sim_day: r for r in trend.collect()}
    assert len(rows) == 65
    assert rows[5].profitable is False and rows[3].profitable is True and rows[40].profitable is None
    assert rows[0].profitable is False  # net 0 is not a profit
    months = {r.month: r for r in SV.income_by_month(trend).collect()}
    assert months[1].profitable is None and months[1].net_profit == 0.0  # nothing reconciled in days 30..59
    assert months[0].profitable is True
    assert SV.income_trend_fleet(earn, rep, days=3).count() == 3
    assert sorted(r.sim_day for r in SV.income_trend_fleet(earn, rep, days=3).collect()) == [62, 63, 64]
    assert SV.income_trend_fleet(earn, rep, days=0).count() == 1  # clamped to 1
    kept = SV.income_filter(trend, show_profitable=False, show_unprofitable=True)
    assert {r.profitable for r in kept.collect()} == {False, None}


def test_daily_report_filters_and_order(spark):
    exp = spark.createDataFrame([(v, 1, c, 0.0, 1.0, False) for v, c in [("A", 5.0), ("B", 1.0), ("C", 0.0)]],
                                EXPENSES_SCHEMA)
    earn = spark.createDataFrame([(v, 1, 2.0, 1) for v in "ABC"], EARNINGS_SCHEMA)
    rep = profitability(exp, earn)
    assert [r.vehicle_id for r in SV.daily_report(rep, 1).collect()] == ["A", "B", "C"]
    assert [r.vehicle_id for r in SV.daily_report(rep, 1, show_unprofitable=False).collect()] == ["B", "C"]
    assert [r.vehicle_id for r in SV.daily_report(rep, 1, show_profitable=False).collect()] == ["A"]
    assert SV.daily_report(rep, 1, False, False).count() == 0
    assert SV.default_report_day(P) == 9 and SV.default_report_day(P.replace(as_of=50.0)) == 0


def test_realtime_with_no_recent_vehicles(spark):
    latest = spark.createDataFrame([("A", "idle", 10.0)], "vehicle_id string, status string, t double") \
        .withColumn("updated_at", F.timestamp_seconds("t"))
    ev = spark.createDataFrame([("T1", 10.0)], "trip_id string, t double").withColumn("event_ts", F.timestamp_seconds("t"))
    p = P.replace(status_recency_s=60, trip_recency_s=60)
    r = SV.realtime_summary(latest, ev, p).collect()[0]
    assert (r.active_vehicles, r.idle_ratio, r.trips_recent, r.sim_day) == (0, 0.0, 0, 10)
