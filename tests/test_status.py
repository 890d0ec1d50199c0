"""Bucketed sequence operators equal a plain per-key scan, for any bucket size."""

import random

import pytest
from pyspark.sql import functions as F

from drover.config import Params
from drover.operators import status as S
from drover.operators.sequence import with_prev, with_run_id


def _events(seed, n_vehicles=4, n=120):
    rnd = random.Random(seed)
    rows, eid = [], 0
    for v in range(n_vehicles):
        t = rnd.randint(0, 50)
        st = rnd.choice(["idle", "enroute", "on_trip"])
        for _ in range(n):
            t += rnd.choice([0, 1, 3, 8, 25, 60])          # ties and gaps across buckets
            if rnd.random() < 0.3:
                st = rnd.choice(["idle", "enroute", "on_trip"])
            eid += 1
            rows.append((f"V{v}", st, t, eid, rnd.random()))
    rnd.shuffle(rows)
    return rows


def _df(spark, rows):
    return spark.createDataFrame(rows, "vehicle_id string, status string, t long, event_id long, x double") \
        .withColumn("event_ts", F.timestamp_seconds("t"))


@pytest.mark.parametrize("seed,bucket", [(1, 7), (2, 60), (3, 1000000)])
def test_run_ids_match_scan(spark, seed, bucket):
    rows = _events(seed)
    got = {r.event_id: r.run_id for r in
           with_run_id(_df(spark, rows), ["vehicle_id"], "event_ts", "event_id", "status", bucket).collect()}
    by_v = {}
    for v, st, t, eid, x in rows:
        by_v.setdefault(v, []).append((t, eid, st))
    for v, seq in by_v.items():
        seq.sort()
        run, prev = 0, None
        for t, eid, st in seq:
            run += 1 if st != prev else 0
            assert got[eid] == run
            prev = st


@pytest.mark.parametrize("seed,bucket", [(4, 5), (5, 90)])
def test_prev_matches_scan(spark, seed, bucket):
    rows = _events(seed)
    got = {r.event_id: r.prev_x for r in
           with_prev(_df(spark, rows), ["vehicle_id"], "event_ts", "event_id", ["x"], bucket).collect()}
    by_v = {}
    for v, st, t, eid, x in rows:
        by_v.setdefault(v, []).append((t, eid, x))
    for v, seq in by_v.items():
        seq.sort()
        prev = None
        for t, eid, x in seq:
            assert got[eid] == prev
            prev = x


def test_spells_end_at_next_start_and_as_of(spark):
    p = Params(start_epoch=0.0, day_seconds=100, as_of=1000.0, bucket_seconds=30)
    rows = [("A", "idle", 10, 1, 0.0), ("A", "idle", 50, 2, 0.0), ("A", "on_trip", 70, 3, 0.0),
            ("A", "idle", 200, 4, 0.0), ("B", "idle", 5, 5, 0.0)]
    ev = _df(spark, rows)
    sp = sorted((r.vehicle_id, r.run_id, r.status, r.duration_s, r.is_current)
                for r in S.status_spells(ev, p).collect())
    assert sp == [("A", 1, "idle", 60.0, False), ("A", 2, "on_trip", 130.0, False),
                  ("A", 3, "idle", 800.0, True), ("B", 1, "idle", 995.0, True)]
    # idle time cut at day boundaries (days of 100 s)
    idle = {(r.vehicle_id, r.sim_day): r.idle_seconds for r in S.idle_seconds_by_day(S.status_spells(ev, p), p).collect()}
    assert idle[("A", 0)] == 60.0 and idle[("A", 2)] == 100.0 and idle[("A", 9)] == 100.0
    assert sum(v for (veh, _), v in idle.items() if veh == "B") == 995.0


def test_permutation_invariance(spark):
    p = Params(start_epoch=0.0, day_seconds=100, as_of=100000.0, bucket_seconds=20)
    rows = _events(9)
    a = sorted(tuple(r) for r in S.status_spells(_df(spark, rows), p).collect())
    rows.reverse()
    b = sorted(tuple(r) for r in S.status_spells(_df(spark, rows).repartition(5), p).collect())
    assert a == b


def test_fixture_numbers(fixture_inputs):
    sp = fixture_inputs.spells
    assert sp.count() == 471
    assert sp.where("status = 'idle'").count() == 184
    assert sp.where("status = 'idle' AND duration_s > 21600").count() == 152
    latest = fixture_inputs.latest
    assert latest.count() == 15
    assert latest.where("status = 'idle'").count() == 6
