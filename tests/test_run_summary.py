"""Slice summaries: any fold equals one scan, and the stream corrects late events."""

import random

import pytest
from pyspark.sql import functions as F

from drover.config import Params
from drover.operators import run_summary as RS
from drover.operators import status as S
from drover.streaming import changelog as CL
from drover.streaming import status_runs as SR

P = Params(start_epoch=0.0, day_seconds=1000, as_of=9000.0, bucket_seconds=70)
SCHEMA = ("vehicle_id string, driver_id string, status string, t double, event_id long, lat double, lon double, "
          "speed double, zone string, fare double")


def _rows(seed, vehicles=4, n=150):
    rnd = random.Random(seed)
    rows = []
    for v in range(vehicles):
        t, status = rnd.uniform(0, 400), "idle"
        for _ in range(n if v else 3 * n):                      # one vehicle holds half of all rows
            t += rnd.choice([0.0, 1.0, 5.0, 20.0, 20.0 if v else 5.0, 700.0 if rnd.random() < 0.01 else 3.0])
            if rnd.random() < 0.3:
                status = rnd.choice(["idle", "enroute", "on_trip", "offline"])
            rows.append((f"V{v}", f"D{v}", status, t, len(rows), 6.9, None, 1.0, "Centre", 0.0))
    return [r for r in rows if r[3] <= P.as_of]


def _events(spark, rows):
    e = spark.createDataFrame(rows, SCHEMA).withColumn("event_ts", F.timestamp_micros((F.col("t") * 1_000_000).cast("long")))
    return e.withColumn("sim_day", F.floor(F.col("t") / P.day_seconds).cast("int")).drop("t")


def _set(df):
    cols = sorted(df.columns)
    return sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect())))


@pytest.mark.parametrize("seed,width", [(1, 60), (2, 333), (3, 1000)])
def test_folds_of_any_slices_equal_one_scan(spark, seed, width):
    ev = _events(spark, _rows(seed)).withColumn("slice", RS.slice_of("event_ts", P, width))
    assert ev.select("slice", "sim_day").distinct().groupBy("slice").count().where("count > 1").count() == 0
    slices = RS.combine(RS.of_events(ev, ["vehicle_id", "sim_day", "slice"]), ["vehicle_id", "sim_day", "slice"])
    days = RS.combine(slices, ["vehicle_id", "sim_day"]).persist()
    tree = RS.combine(days, ["vehicle_id"])
    assert _set(tree) == _set(RS.combine(RS.of_events(ev, ["vehicle_id"]), ["vehicle_id"]))
    assert _set(RS.latest_of(tree)) == _set(S.latest_status(ev, P))
    spells = S.status_spells(ev, P)
    assert _set(tree.select("vehicle_id", "n_runs")) == _set(spells.groupBy("vehicle_id").agg(F.max("run_id").alias("n_runs")))
    got = {(r.vehicle_id, r.sim_day): r.idle_seconds for r in RS.idle_seconds_of(days, P).collect()}
    want = {(r.vehicle_id, r.sim_day): r.idle_seconds for r in S.idle_seconds_by_day(spells, P).collect()}
    assert got == pytest.approx(want)


def test_batches_in_any_order_replayed_and_after_a_lost_checkpoint(spark, tmp_path):
    rows = _rows(7, vehicles=3, n=60)
    want = _events(spark, rows)
    rnd = random.Random(8)
    rnd.shuffle(rows)
    path = str(tmp_path / "status")
    cut = len(rows) // 3
    parts = [rows[:cut], rows[cut:2 * cut], rows[2 * cut:]]
    SR.apply_batch(_events(spark, parts[0]), P, path, 1, 0, 120)
    SR.apply_batch(_events(spark, parts[1]), P, path, 1, 1, 120)
    SR.apply_batch(_events(spark, parts[1]), P, path, 1, 1, 120)             # a replay
    seen = _events(spark, parts[0] + parts[1])
    cols = ["vehicle_id", "status", F.timestamp_micros("status_since_us").alias("status_since"),
            F.timestamp_micros("updated_at_us").alias("updated_at")]
    names = ["vehicle_id", "status", "status_since", "updated_at"]
    assert _set(CL.resolve(spark, path, ["vehicle_id"]).select(*cols)) == _set(S.latest_status(seen, P).select(*names))
    SR.apply_batch(_events(spark, parts[1] + parts[2]), P, path, 2, 0, 120)  # a new epoch reads some messages again
    assert _set(CL.resolve(spark, path, ["vehicle_id"]).select(*cols)) == _set(S.latest_status(want, P).select(*names))
    got = {(r.vehicle_id, r.sim_day): r.idle_seconds for r in SR.idle_seconds_at(spark, path, P).collect()}
    exact = S.idle_seconds_by_day(S.status_spells(want, P), P)
    assert got == pytest.approx({(r.vehicle_id, r.sim_day): r.idle_seconds for r in exact.collect()})


def test_a_late_event_rewrites_one_slice(spark, tmp_path):
    path = str(tmp_path / "late")
    first = [("V1", "D1", "idle", float(t), t, None, None, 0.0, None, 0.0) for t in range(0, 900, 30)]
    SR.apply_batch(_events(spark, first), P, path, 1, 0, 100)
    SR.apply_batch(_events(spark, [("V1", "D1", "on_trip", 455.0, 1000, None, None, 0.0, None, 0.0)]), P, path, 1, 1, 100)
    slices = spark.read.parquet(path + ".slices")
    assert [r.slice for r in slices.where("batch_id = 1").collect()] == [4]
    row = CL.resolve(spark, path, ["vehicle_id"]).first()
    assert (row.status, row.status_since_us) == ("idle", 480_000_000)
    day = {r.sim_day: r.idle_seconds for r in SR.idle_seconds_at(spark, path, P.replace(as_of=1500.0)).collect()}
    assert day == {0: 975.0, 1: 500.0}                                       # 25 s on the trip


def test_empty_batches_and_records_without_ids(spark, tmp_path):
    path = str(tmp_path / "empty")
    SR.apply_batch(_events(spark, []), P, path, 1, 0)
    assert SR.idle_seconds_at(spark, path, P).count() == 0
    nine = [("V1", "D1", s, t, None, None, None, 0.0, None, 0.0) for s, t in (("idle", 5.0), ("idle", 5.0), ("enroute", 9.0))]
    SR.apply_batch(_events(spark, nine), P, path, 1, 1)
    row = CL.resolve(spark, path, ["vehicle_id"]).first()
    assert (row.status, row.status_since_us, row.updated_at_us) == ("enroute", 9_000_000, 9_000_000)
