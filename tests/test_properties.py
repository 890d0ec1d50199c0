"""Property tests: bucketed sequence operators equal a plain sorted scan for generated
sequences and bucket sizes."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from drover.operators.sequence import with_prev, with_run_id

event = st.tuples(st.sampled_from(["V1", "V2", "V3"]), st.integers(0, 400), st.sampled_from(["a", "b", "c"]))
sequences = st.lists(event, min_size=1, max_size=60)


def _scan(rows):
    """(prev value, run number) per event id by a plain per-key scan in (t, id) order."""
    out, by_key = {}, {}
    for eid, (v, t, s) in enumerate(rows):
        by_key.setdefault(v, []).append((t, eid, s))
    for seq in by_key.values():
        prev, run = None, 0
        for t, eid, s in sorted(seq):
            run += 1 if s != prev else 0
            out[eid] = (prev, run)
            prev = s
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=sequences, bucket=st.integers(1, 500))
def test_bucketed_sequences_equal_scan(spark, rows, bucket):
    df = spark.createDataFrame([(v, t, eid, s) for eid, (v, t, s) in enumerate(rows)],
                               "vehicle_id string, t long, event_id long, status string") \
        .withColumn("event_ts", F.timestamp_seconds("t"))
    runs = with_run_id(df, ["vehicle_id"], "event_ts", "event_id", "status", bucket)
    both = with_prev(runs, ["vehicle_id"], "event_ts", "event_id", ["status"], bucket)
    got = {r.event_id: (r.prev_status, r.run_id) for r in both.collect()}
    assert got == _scan(rows)


keys = st.sets(st.tuples(st.sampled_from(["vehicle_idle", "pipeline_staleness", "fleet_profitability"]),
                         st.sampled_from(["V1", "V2", "V3", "telemetry", "7"])), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(before=keys, firing=keys)
def test_alert_rounds_invariants(spark, before, firing):
    from drover.config import Params
    from drover.operators import alerts as A

    p = Params(start_epoch=0.0, day_seconds=100, as_of=1000.0)

    def frame(ks, tag):
        rows = [(t, "warning", e, f"{tag}:{t}:{e}") for t, e in sorted(ks)]
        return spark.createDataFrame(rows, "alert_type string, severity string, entity_id string, message string")

    s1 = A.apply_conditions(A.empty_alerts(spark), frame(before, "old"), p.replace(as_of=900.0))
    s2 = A.apply_conditions(s1, frame(firing, "new"), p)
    rows = [(r.alert_type, r.entity_id, r.message, r.resolved) for r in s2.collect()]
    open_keys = [(t, e) for t, e, _, resolved in rows if not resolved]
    assert sorted(open_keys) == sorted(firing)                     # one open alert per firing key
    for t, e, msg, resolved in rows:                              # kept open alerts keep their message
        if not resolved and (t, e) in before:
            assert msg.startswith("old:")
    assert sorted((t, e) for t, e, _, r in rows if r) == sorted(before - firing)
    again = A.apply_conditions(s2, frame(firing, "newer"), p.replace(as_of=1100.0))
    assert sorted((r.alert_type, r.entity_id, r.message, r.resolved) for r in again.collect()) == sorted(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=sequences, day=st.integers(7, 300))
def test_idle_seconds_conserve_idle_time(spark, rows, day):
    from drover.config import Params
    from drover.operators import status as S

    p = Params(start_epoch=0.0, day_seconds=day, as_of=1000.0, bucket_seconds=37)
    status = {"a": "idle", "b": "on_trip", "c": "enroute"}
    df = spark.createDataFrame([(v, t, eid, status[s]) for eid, (v, t, s) in enumerate(rows)],
                               "vehicle_id string, t long, event_id long, status string") \
        .withColumn("event_ts", F.timestamp_seconds("t"))
    spells = S.status_spells(df, p)
    per_vehicle = {}
    for r in spells.where("status = 'idle'").collect():
        per_vehicle[r.vehicle_id] = per_vehicle.get(r.vehicle_id, 0.0) + r.duration_s
    by_day = S.idle_seconds_by_day(spells, p).collect()
    summed = {}
    for r in by_day:
        assert 0 < r.idle_seconds <= day
        summed[r.vehicle_id] = summed.get(r.vehicle_id, 0.0) + r.idle_seconds
    assert {k: round(v, 6) for k, v in summed.items()} == {k: round(v, 6) for k, v in per_vehicle.items() if v > 0}


zone_event = st.tuples(st.sampled_from(["V1", "V2", "V3", "V4"]), st.integers(0, 600),
                       st.sampled_from(["idle", "enroute", "on_trip"]), st.sampled_from(["-", "T1", "T2", "T3"]),
                       st.sampled_from([6.84, 6.9, 6.95]), st.floats(0, 50))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(zone_event, min_size=1, max_size=50))
def test_two_level_zone_metrics_equal_deltas(spark, rows):
    from drover.config import Params
    from drover.functions import zone_of
    from drover.operators import metrics as M
    from drover.session import scratch_path
    from drover.streaming import member_deltas as MD

    p = Params(start_epoch=0.0, day_seconds=300)
    df = spark.createDataFrame([(v, t, s, tr, lat, fare) for v, t, s, tr, lat, fare in rows],
                               "vehicle_id string, t long, status string, trip_id string, lat double, fare double") \
        .withColumn("event_ts", F.timestamp_seconds("t")).withColumn("speed", F.col("fare")) \
        .withColumn("zone", zone_of("lat", F.lit(79.88)))
    cols = ["zone", "window_start", "active_vehicles", "idle_count", "enroute_count", "on_trip_count", "trip_count",
            "sim_day"]
    a = M.zone_metrics(df, p, "1 minute")
    path, keyed = scratch_path(spark, "zone-deltas"), M.zone_keyed(df, p, "1 minute")
    for k in (0, 1):
        MD.apply_batch(keyed.where(F.col("t") % 2 == k), M.zone_totals(), path, 1, k)
    b = M.zone_metrics_of(MD.read(spark, path, M.zone_totals()))
    assert sorted(tuple(r) for r in a.select(*cols).collect()) == sorted(tuple(r) for r in b.select(*cols).collect())
    ra = {(r.zone, r.window_start): (round(r.total_earnings, 6), round(r.avg_speed, 6)) for r in a.collect()}
    rb = {(r.zone, r.window_start): (round(r.total_earnings, 6), round(r.avg_speed, 6)) for r in b.collect()}
    assert ra == rb
