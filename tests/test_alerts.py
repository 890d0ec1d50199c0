"""Alert rules and lifecycle."""

import pytest
from pyspark.sql import functions as F

from drover.config import Params
from drover.operators import alerts as A
from drover.schemas import ALERT_SCHEMA

P = Params(start_epoch=0.0, day_seconds=86400, as_of=10_000.0, staleness_threshold_s=60, idle_threshold_s=120)


def _firing(spark, rows):
    return spark.createDataFrame(rows, "alert_type string, severity string, entity_id string, message string")


def _state(df):
    return sorted((r.alert_type, r.entity_id, r.message, r.resolved) for r in df.collect())


def test_raise_once_keep_message_and_resolve(spark):
    f1 = _firing(spark, [("vehicle_idle", "warning", "V1", "m1"), ("vehicle_idle", "warning", "V2", "m2"),
                         ("pipeline_staleness", "critical", None, "s")])
    s1 = A.apply_conditions(A.empty_alerts(spark), f1, P)
    assert len(_state(s1)) == 3 and not any(r[3] for r in _state(s1))
    # applying the same conditions again adds nothing (null entity too)
    p2 = P.replace(as_of=P.as_of + 30)
    assert _state(A.apply_conditions(s1, f1, p2)) == _state(s1)
    # V1 still idle (new message is not written), V2 recovered, staleness cleared, V3 new
    f2 = _firing(spark, [("vehicle_idle", "warning", "V1", "m1-newer"), ("vehicle_idle", "warning", "V3", "m3")])
    s2 = _state(A.apply_conditions(s1, f2, p2))
    assert s2 == sorted([("vehicle_idle", "V1", "m1", False), ("vehicle_idle", "V2", "m2", True),
                         ("pipeline_staleness", None, "s", True), ("vehicle_idle", "V3", "m3", False)])


def test_resolved_history_passes_through(spark):
    hist = spark.createDataFrame([("vehicle_idle", "warning", "V9", "old", None, True)], ALERT_SCHEMA)
    out = _state(A.apply_conditions(hist, _firing(spark, [("vehicle_idle", "warning", "V9", "again")]), P))
    assert out == sorted([("vehicle_idle", "V9", "old", True), ("vehicle_idle", "V9", "again", False)])


def test_staleness_rule_strict_and_empty(spark):
    ev = spark.createDataFrame([(P.as_of - 60.0,)], "t double").select(F.timestamp_seconds("t").alias("event_ts"))
    assert A.staleness_condition(ev, P).count() == 0  # exactly at the threshold: not stale
    ev2 = spark.createDataFrame([(P.as_of - 60.5,)], "t double").select(F.timestamp_seconds("t").alias("event_ts"))
    msg = A.staleness_condition(ev2, P).collect()[0].message
    assert msg == "No telemetry ingested in 60s (threshold 60s)"  # 60.5 rounds half to even
    empty = ev.where("false")
    assert A.staleness_condition(empty, P).collect()[0].message == "No telemetry events ingested yet"


@pytest.mark.parametrize("fan_in", [1024, 2, 3])
def test_gaps_equal_sorted_scan(spark, fan_in):
    import random
    rnd = random.Random(3)
    ts, t = [], 0.0
    for _ in range(400):
        t += rnd.choice([1.0, 5.0, 59.0, 60.0, 61.0, 200.0, 0.5])
        ts.append(t)
    rnd.shuffle(ts)
    ev = spark.createDataFrame([(x,) for x in ts], "t double").select(F.timestamp_seconds("t").alias("event_ts"))
    got = sorted((r.gap_seconds) for r in A.staleness_gaps(ev, 60, fan_in=fan_in).collect())
    s = sorted(ts)
    want = sorted(b - a for a, b in zip(s, s[1:]) if b - a > 60)
    assert got == want


def test_alert_store_rounds(spark, tmp_path):
    store = str(tmp_path / "alerts")
    assert A.latest_version(spark, store) is None and A.read_alerts(spark, store).count() == 0
    f1 = _firing(spark, [("vehicle_idle", "warning", "V1", "m1")])
    A.evaluate_alerts(spark, store, f1, P)
    A.evaluate_alerts(spark, store, f1, P.replace(as_of=P.as_of + 30))
    assert A.latest_version(spark, store) == 1
    assert _state(A.read_alerts(spark, store)) == [("vehicle_idle", "V1", "m1", False)]
    out = A.evaluate_alerts(spark, store, f1.where("false"), P.replace(as_of=P.as_of + 60))
    assert _state(out) == [("vehicle_idle", "V1", "m1", True)]
    # earlier versions stay readable
    assert spark.read.parquet(store).where("version = 0").count() == 1
