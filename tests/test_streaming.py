"""Streams: late events behind the watermark, replay safety, stream = batch."""

import os

import pytest
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from drover.config import Params
from drover.operators import metrics as M
from drover.operators.clean import enrich
from drover.streaming import changelog as CL
from drover.streaming import epochs as E
from drover.streaming import jobs as J
from drover.streaming import member_deltas as MD

P = Params(start_epoch=0.0, day_seconds=86400, as_of=None, window="1 minute", watermark="2 minutes")
T0 = 1_699_999_980  # a whole minute; all events below are relative to it


def _msg(eid, vid, t, status="on_trip", fare=1.0, trip="T1"):
    import json
    from datetime import datetime, timezone
    iso = datetime.fromtimestamp(T0 + t, tz=timezone.utc).isoformat()
    v = {"trip_id": trip, "driver_id": "D" + vid, "vehicle_id": vid, "lat": 6.9, "lon": 79.9, "speed": 30.0,
         "status": status, "fare": fare, "event_ts": iso, "event_id": eid}
    return {"key": vid, "value": json.dumps(v)}


def _stage(path, files):
    os.makedirs(path, exist_ok=True)
    for i, rows in enumerate(files):
        f = os.path.join(path, f"part-{i:05d}.parquet")
        pq.write_table(pa.Table.from_pylist(rows, schema=pa.schema([("key", pa.string()), ("value", pa.string())])), f)
        os.utime(f, (1_000_000 + 10 * i, 1_000_000 + 10 * i))


def test_late_event_dropped_from_windows_kept_in_earnings(spark, tmp_path):
    files = [
        [_msg(1, "A", 0), _msg(2, "A", 30)],
        [_msg(3, "A", 600)],                           # moves the watermark to t=480
        [_msg(4, "A", 610)],
        [_msg(5, "A", 300, fare=5.0, trip="T2")],      # 5 minutes behind, two batches later
    ]
    land = str(tmp_path / "land")
    _stage(land, files)
    ev = J.file_event_stream(spark, land, P, max_files_per_trigger=1)
    z, e = str(tmp_path / "z"), str(tmp_path / "e")
    J.run_to_end(J.start_zone_metrics(ev, P, z, str(tmp_path / "zc"), 1, {"availableNow": True}))
    J.run_to_end(J.start_daily_earnings(ev, e, str(tmp_path / "ec"), 1, {"availableNow": True}))
    zones = J.zone_metrics_at(spark, z, late=False)      # what a watermarked aggregation counts
    starts = {int(r.ws) - T0 for r in zones.select(F.unix_seconds("window_start").alias("ws")).collect()}
    assert 300 not in starts and {0, 600} <= starts
    earn = J.earnings_at(spark, e).collect()
    assert sum(r.total_fare for r in earn) == 9.0 and sum(r.trip_count for r in earn) == 2
    # the batch form over the same events shows what the watermark dropped
    batch_events = J.event_stream(spark.read.parquet(land), P)
    lost = J.watermark_losses(zones, M.zone_metrics(batch_events, P), ["zone", "window_start"],
                              ["active_vehicles", "total_earnings"]).collect()
    assert len(lost) == 1 and lost[0].stream_active_vehicles is None and lost[0].batch_total_earnings == 5.0
    # with the late rows nothing is missing, and the repair tells which window they changed
    cols = ["zone", "window_start", "active_vehicles", "trip_count", "total_earnings", "avg_speed"]
    repaired = J.zone_metrics_at(spark, z)
    assert sorted(tuple(r) for r in repaired.select(*cols).collect()) == sorted(
        tuple(r) for r in M.zone_metrics(batch_events, P).select(*cols).collect())
    fix = J.late_repairs(spark, z).collect()
    assert [(r.published_total_earnings, r.repaired_total_earnings) for r in fix] == [(None, 5.0)]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0)], "vehicle_id string, sim_day int, total_fare double")
    CL.write_batch(df, path, 1, 0)
    CL.write_batch(df.withColumn("total_fare", F.col("total_fare") + 1), path, 1, 1)
    CL.write_batch(df.withColumn("total_fare", F.col("total_fare") + 1), path, 1, 1)  # replay
    assert CL.read_log(spark, path).count() == 4
    got = {r.vehicle_id: r.total_fare for r in CL.resolve(spark, path, ["vehicle_id", "sim_day"]).collect()}
    assert got == {"A": 2.0, "B": 3.0}
    # a new run (fresh checkpoint, batch ids restart) supersedes the old one
    CL.write_batch(df.where("vehicle_id = 'A'").withColumn("total_fare", F.lit(9.0)), path, 2, 0)
    got = {r.vehicle_id: r.total_fare for r in CL.resolve(spark, path, ["vehicle_id", "sim_day"]).collect()}
    assert got == {"A": 9.0, "B": 3.0}


COUNTS = ["zone", "window_start", "active_vehicles", "idle_count", "enroute_count", "on_trip_count", "trip_count"]


def _rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_deltas_in_any_batches_equal_the_batch_plan(spark, fixture_inputs, tmp_path):
    ev, p = fixture_inputs.events, fixture_inputs.params
    t, path, snaps = M.zone_totals(), str(tmp_path / "z"), str(tmp_path / "s")
    keyed = M.zone_keyed(ev, p, "1 hour")
    want = _rows(M.zone_metrics(ev, p, "1 hour"), *COUNTS)
    for k in (2, 0, 1):
        MD.apply_batch(keyed.where(F.col("event_id") % 3 == k), t, path, 1, [2, 0, 1].index(k))
        if k == 0:
            MD.compact(spark, path, t, snaps)
    assert _rows(M.zone_metrics_of(MD.read(spark, path, t)), *COUNTS) == want
    assert _rows(M.zone_metrics_of(MD.read(spark, path, t, snapshots=snaps)), *COUNTS) == want
    # batches replayed, also after a snapshot of them, change nothing; a snapshot of a snapshot neither
    MD.compact(spark, path, t, snaps)
    MD.apply_batch(keyed.where(F.col("event_id") % 3 == 0), t, path, 1, 1)
    MD.apply_batch(keyed.where(F.col("event_id") % 3 == 1), t, path, 1, 2)
    assert _rows(M.zone_metrics_of(MD.read(spark, path, t)), *COUNTS) == want
    assert _rows(M.zone_metrics_of(MD.read(spark, path, t, snapshots=snaps)), *COUNTS) == want
    # a newer epoch's value of a window replaces the older one's
    one = keyed.orderBy("window_start", "zone").limit(1)
    MD.apply_batch(one, t, path, 2, 0)
    got = M.zone_metrics_of(MD.read(spark, path, t))
    first = one.first()
    assert got.where((F.col("zone") == first.zone) & (F.col("window_start") == F.lit(first.window_start))).first().active_vehicles == 1
    assert got.count() == len(want)
    MD.apply_batch(keyed.limit(0), t, path, 2, 1)      # an empty batch
    assert MD.read(spark, path, t).count() == len(want)


def test_deltas_with_nine_tenths_in_one_zone(spark, tmp_path):
    n = 20_000
    ev = spark.range(n).select(
        F.when(F.col("id") % 10 > 0, "zone_N").otherwise("zone_S").alias("zone"), F.timestamp_seconds(F.lit(T0) + F.col("id") % 100).alias("event_ts"),
        F.concat(F.lit("V"), (F.col("id") % 7001).cast("string")).alias("vehicle_id"), F.lit("D").alias("driver_id"),
        F.concat(F.lit("T"), (F.col("id") % 5003).cast("string")).alias("trip_id"), F.lit(1.0).alias("fare"), F.lit(10.0).alias("speed"),
        F.element_at(F.array(F.lit("idle"), F.lit("enroute"), F.lit("on_trip")), (F.col("id") % 3 + 1).cast("int")).alias("status"),
        F.lit(0).alias("sim_day"), F.col("id").alias("event_id"))
    t, path = M.zone_totals(), str(tmp_path / "z")
    keyed = M.zone_keyed(ev, P)
    for k in range(2):
        MD.apply_batch(keyed.where(F.col("event_id") % 2 == k), t, path, 1, k)
    assert _rows(M.zone_metrics_of(MD.read(spark, path, t)), *COUNTS) == _rows(M.zone_metrics(ev, P), *COUNTS)
    # the hot zone's members of a batch lie in several files
    hot = spark.read.parquet(path + ".members").where("zone = 'zone_N' and batch_id = 0").groupBy(F.input_file_name()).count().collect()
    assert len(hot) >= 4 and max(r["count"] for r in hot) < sum(r["count"] for r in hot) / 3


def test_bounded_earnings_state_equals_unbounded(spark, tmp_path):
    files = [[_msg(i, "A" if i % 2 else "B", i * 400, trip=f"T{i % 3}") for i in range(k, k + 5)] for k in (0, 5, 10)]
    land = str(tmp_path / "land")
    _stage(land, files)
    p = P.replace(day_seconds=3600)
    ev = J.file_event_stream(spark, land, p, max_files_per_trigger=1)
    u, b = str(tmp_path / "u"), str(tmp_path / "b")
    J.run_to_end(J.start_daily_earnings(ev, u, str(tmp_path / "uc"), 1, {"availableNow": True}))
    J.run_to_end(J.start_daily_earnings(ev, b, str(tmp_path / "bc"), 1, {"availableNow": True}, params=p, bounded=True))
    ru = sorted(tuple(r) for r in J.earnings_at(spark, u).collect())
    rb = _rows(CL.resolve(spark, b, ["vehicle_id", "sim_day"]), "vehicle_id", "sim_day", "total_fare", "trip_count")
    assert ru == rb and len(ru) > 2


def test_rebuild_earnings_and_compaction(spark, fixture_inputs, tmp_path):
    from drover.streaming.jobs import rebuild_earnings
    raw = str(tmp_path / "raw")
    CL.write_batch(fixture_inputs.events.where("sim_day < 15"), raw, 1, 0, partition_by=("sim_day",))
    CL.write_batch(fixture_inputs.events.where("sim_day >= 15"), raw, 1, 1, partition_by=("sim_day",))
    got = sorted(tuple(r) for r in rebuild_earnings(spark, raw, [3, 20]).collect())
    want = sorted(tuple(r) for r in fixture_inputs.earnings.where("sim_day IN (3, 20)").collect())
    assert [g[:2] + (g[3],) for g in got] == [w[:2] + (w[3],) for w in want]
    # compaction keeps exactly the resolved state
    log = str(tmp_path / "log")
    e = fixture_inputs.earnings
    CL.write_batch(e, log, 1, 0)
    CL.write_batch(e.withColumn("total_fare", F.col("total_fare") * 2), log, 1, 1)
    keys = ["vehicle_id", "sim_day"]
    snap_root = str(tmp_path / "snap")
    out = CL.compact(spark, log, keys, snap_root)
    assert out.endswith("upto-1-1") and spark.read.parquet(out).count() == e.count()
    # more batches after the snapshot, then a second compaction on top of the first
    CL.write_batch(e.where("sim_day = 3").withColumn("total_fare", F.lit(-1.0)), log, 2, 0)
    full = sorted(tuple(r) for r in CL.resolve(spark, log, keys).collect())
    assert sorted(tuple(r) for r in CL.resolve_compacted(spark, log, keys, snap_root).collect()) == full
    CL.compact(spark, log, keys, snap_root)
    assert CL.latest_snapshot(spark, snap_root)[1:] == (2, 0)
    assert sorted(tuple(r) for r in CL.resolve_compacted(spark, log, keys, snap_root).collect()) == full


def test_heartbeats(spark, tmp_path):
    hb = str(tmp_path / "hb")
    CL.record_heartbeat(spark, hb, "reconciliation")
    CL.record_heartbeat(spark, hb, "watchdog", status="healthy")
    got = {r.component: r.status for r in CL.component_health(spark, hb).collect()}
    assert got == {"reconciliation": "healthy", "watchdog": "healthy"}


def test_downstream_query_reads_raw_log_stream(spark, tmp_path):
    files = [[_msg(i, "A" if i % 2 else "B", i * 30, trip=f"T{i % 4}") for i in range(k, k + 6)] for k in (0, 6, 12)]
    land = str(tmp_path / "land")
    _stage(land, files)
    ev = J.file_event_stream(spark, land, P, max_files_per_trigger=1)
    raw = str(tmp_path / "raw")
    J.run_to_end(J.start_raw_log(ev, raw, str(tmp_path / "rc"), 1, {"availableNow": True}))
    down = J.raw_log_events(spark, raw, max_files_per_trigger=1)
    e = str(tmp_path / "e")
    J.run_to_end(J.start_daily_earnings(down, e, str(tmp_path / "ec"), 1, {"availableNow": True}))
    got = sorted(tuple(r) for r in J.earnings_at(spark, e).collect())
    want = sorted(tuple(r) for r in M.daily_earnings(spark.read.parquet(raw)).collect())
    assert got == want and len(got) == 2


def test_custom_grid(spark):
    from drover.config import Grid
    from drover.functions import zone_of
    g = Grid(0.0, 3.0, 0.0, 3.0, tuple("abcdefghi"))
    r = spark.createDataFrame([(2.5, 0.5), (0.5, 2.5), (1.5, 1.5), (-5.0, 9.0)], "lat double, lon double") \
        .select(zone_of("lat", "lon", g).alias("z")).collect()
    assert [x.z for x in r] == ["a", "i", "e", "i"]


def test_speed_layer_all_queries_and_restart(spark, tmp_path):
    files = [[_msg(i, "A" if i % 3 else "B", i * 20, status="idle" if i % 4 else "on_trip", trip=f"T{i % 5}")
              for i in range(k, k + 8)] for k in (0, 8, 16)]
    land = str(tmp_path / "land")
    _stage(land, files[:2])
    from drover.sources.telemetry import file_telemetry
    root = str(tmp_path / "layer")
    once = {n: {"availableNow": True} for n in ("raw_log", "zone_metrics", "daily_earnings", "recent", "vehicle_status")}
    for q in J.start_speed_layer(spark, file_telemetry(spark, land, 1), P, root, run_id=1, triggers=once,
                                 status_mode="merge").values():
        J.run_to_end(q)
    # more files land; the same checkpoints continue where they stopped
    _stage(land, files)
    for q in J.start_speed_layer(spark, file_telemetry(spark, land, 1), P, root, run_id=1, triggers=once,
                                 status_mode="merge").values():
        J.run_to_end(q)
    raw = spark.read.parquet(f"{root}/raw_log")
    assert raw.count() == 24
    earn = J.earnings_at(spark, f"{root}/daily_earnings")
    want = M.daily_earnings(raw)
    assert sorted(tuple(r) for r in earn.collect()) == sorted(tuple(r) for r in want.collect())
    from drover.operators.status import latest_status
    st = {r.vehicle_id: (r.status, r.status_since_us) for r in
          CL.resolve(spark, f"{root}/vehicle_status", ["vehicle_id"]).collect()}
    want = {r.vehicle_id: (r.status, r.s) for r in
            latest_status(raw, P).select("vehicle_id", "status", F.unix_micros("status_since").alias("s")).collect()}
    assert st == want and len(st) == 2
    assert CL.component_health(spark, f"{root}/heartbeats").collect()[0].status == "healthy"


def test_approx_distinct_zone_metrics(fixture_inputs):
    ev, p = fixture_inputs.events, fixture_inputs.params
    cols = ["zone", "window_start", "active_vehicles", "trip_count"]
    exact = sorted(tuple(r) for r in M.zone_metrics(ev, p, "1 hour").select(*cols).collect())
    approx = sorted(tuple(r) for r in M.zone_metrics_sketches(ev, p, "1 hour", rsd=0.01).select(*cols).collect())
    assert exact == approx  # sketches are exact at these small cardinalities


def test_ordered_status_places_out_of_order_events(spark, tmp_path):
    files = [
        [_msg(1, "A", 0, status="idle"), _msg(2, "A", 100, status="idle")],
        [_msg(3, "A", 50, status="on_trip")],               # 50 s out of order, inside 2 min
        [_msg(4, "A", 400, status="idle")],                  # watermark -> 280: applies 0, 50, 100
        [_msg(5, "A", 1000, status="enroute")],              # watermark -> 880: applies 400
    ]
    land = str(tmp_path / "land")
    _stage(land, files)

    def run(name, ordered):
        ev = J.file_event_stream(spark, land, P, max_files_per_trigger=1)
        out = str(tmp_path / name)
        J.run_to_end(J.start_vehicle_status(ev, out, str(tmp_path / (name + "c")), 1, {"availableNow": True},
                                            ordered_within=ordered))
        r = CL.resolve(spark, out, ["vehicle_id"]).collect()[0]
        return r.status, (r.status_since_us // 1_000_000) - T0, (r.updated_at_us // 1_000_000) - T0

    # exact: runs idle@0, on_trip@50, idle@100..400; the event at 1000 is still behind the watermark
    assert run("ordered", "2 minutes") == ("idle", 100, 400)
    # immediate mode ignores the older event: idle since 0, and shows the newest event
    assert run("immediate", None) == ("enroute", 1000, 1000)


def test_sequential_staging_for_non_local_paths(spark, fixture_inputs, tmp_path):
    from drover.sources.telemetry import to_wire
    from drover.streaming.staging import stage_in_order
    path = str(tmp_path / "staged")
    stage_in_order(to_wire(fixture_inputs.raw, keep=("event_id",)), path, "event_id", 4, sequential=True)
    import glob
    files = sorted(glob.glob(str(tmp_path / "staged" / "*.parquet")), key=os.path.getmtime)
    ranges = [spark.read.parquet(f).agg(F.min("event_id"), F.max("event_id")).first() for f in files]
    assert len(files) == 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert spark.read.parquet(path).count() == fixture_inputs.raw.count()


def test_two_stage_dedup_with_hot_copies(spark, tmp_path):
    # one message delivered 40 times, others once or twice
    files = [[_msg(1, "A", 0)] * 20 + [_msg(2, "B", 5), _msg(3, "B", 6)],
             [_msg(1, "A", 0)] * 20 + [_msg(3, "B", 6), _msg(4, "A", 30)]]
    land = str(tmp_path / "land")
    _stage(land, files)
    for spread in (None, 8):
        ev = J.file_event_stream(spark, land, P, max_files_per_trigger=1)
        out = str(tmp_path / f"d{spread}")
        J.run_to_end(J.start_dedup(ev, P, out, str(tmp_path / f"c{spread}"), 1, {"availableNow": True},
                                   spread=spread))
        assert sorted(r.event_id for r in CL.read_log(spark, out).collect()) == [1, 2, 3, 4]


def test_merge_status_equals_keyed_state_and_replays(spark, tmp_path):
    from drover.streaming.status_merge import status_merge_sink
    files = [
        [_msg(1, "A", 0, status="idle"), _msg(2, "A", 100, status="idle"), _msg(6, "B", 10, status="on_trip")],
        [_msg(3, "A", 50, status="on_trip"), _msg(7, "B", 20, status="on_trip")],   # A's is older: ignored
        [_msg(4, "A", 400, status="enroute"), _msg(5, "A", 410, status="enroute"), _msg(8, "B", 30, status="idle")],
    ]
    land = str(tmp_path / "land")
    _stage(land, files)
    got = {}
    for mode in ("keyed", "merge"):
        ev = J.file_event_stream(spark, land, P, max_files_per_trigger=1)
        out = str(tmp_path / mode)
        start = J.start_vehicle_status if mode == "keyed" else J.start_vehicle_status_merge
        J.run_to_end(start(ev, out, str(tmp_path / (mode + "c")), 1, {"availableNow": True}))
        got[mode] = sorted((r.vehicle_id, r.status, (r.status_since_us // 1_000_000) - T0,
                            (r.updated_at_us // 1_000_000) - T0) for r in CL.resolve(spark, out, ["vehicle_id"]).collect())
    assert got["merge"] == got["keyed"] == [("A", "enroute", 400, 410), ("B", "idle", 30, 30)]
    # replaying the last batch gives the same state
    out = str(tmp_path / "merge")
    last = J.event_stream(spark.read.parquet(land), P).where(F.col("event_id").isin(4, 5, 8))
    status_merge_sink(spark, out, 1, None)(last, 2)
    again = sorted((r.vehicle_id, r.status, (r.status_since_us // 1_000_000) - T0) for r in
                   CL.resolve(spark, out, ["vehicle_id"]).collect())
    assert again == [("A", "enroute", 400), ("B", "idle", 30)]


def test_epochs(spark, tmp_path):
    sink = str(tmp_path / "sink")
    assert E.epoch_of(spark, str(tmp_path / "ck1"), sink) == 1
    assert E.epoch_of(spark, str(tmp_path / "ck1"), sink) == 1          # a restart
    df = spark.createDataFrame([("A", 1)], "vehicle_id string, x int")
    write = CL.changelog_sink(sink, 1)
    write(df, 0)
    assert E.epoch_of(spark, str(tmp_path / "ck2"), sink) == 2          # a lost checkpoint
    with pytest.raises(E.StaleEpoch):                                   # the old query is still alive
        write(df, 1)
    assert E.claimed(spark, sink) == [1, 2] and CL.read_log(spark, sink).count() == 1
    # a sink and a checkpoint from before epochs were kept
    old = str(tmp_path / "old")
    CL.write_batch(df, old, 1_700_000_000_000, 0)
    (tmp_path / "ck3" / "offsets").mkdir(parents=True)
    assert E.epoch_of(spark, str(tmp_path / "ck3"), old) == 1_700_000_000_000
    assert E.epoch_of(spark, str(tmp_path / "ck4"), old) == 1_700_000_000_001


def test_speed_layer_survives_one_lost_checkpoint(spark, tmp_path):
    """The raw log loses its checkpoint, the broker has dropped the first file; the log
    keeps every row once, also two equal messages of one epoch."""
    from drover.sources.telemetry import file_telemetry
    files = [[_msg(i, "A" if i % 3 else "B", i * 20, status="idle" if i % 4 else "on_trip", trip=f"T{i % 5}")
              for i in range(k, k + 8)] for k in (0, 8, 16)]
    files[1].append(files[1][0])
    land, late = str(tmp_path / "land"), str(tmp_path / "late")
    _stage(land, files[:2])
    root = str(tmp_path / "layer")
    once = {n: {"availableNow": True} for n in ("raw_log", "zone_metrics", "daily_earnings", "recent", "vehicle_status")}

    def run(source, **kw):
        for q in J.start_speed_layer(spark, source, P, root, triggers=once, status_mode="merge", **kw).values():
            J.run_to_end(q)
    run(file_telemetry(spark, land, 1))
    before = [E.claimed(spark, f"{root}/{n}") for n in once]
    assert before == [[1]] * 5
    _stage(land, files)
    _stage(late, files[1:])
    events = J.event_stream(file_telemetry(spark, late, 1), P)
    J.run_to_end(J.start_raw_log(events, f"{root}/raw_log", str(tmp_path / "newck"), None, {"availableNow": True}, f"{root}/heartbeats"))
    run(file_telemetry(spark, land, 1), checkpoints={"raw_log": str(tmp_path / "newck2")})
    assert E.claimed(spark, f"{root}/raw_log") == [1, 2, 3] and E.claimed(spark, f"{root}/daily_earnings") == [1]
    whole = J.event_stream(spark.read.parquet(land), P)
    log = CL.read_raw_log(spark, f"{root}/raw_log")
    cols = ["event_id", "vehicle_id", "event_ts", "fare", "zone"]
    assert _rows(log, *cols) == _rows(whole, *cols) and log.count() == 25
    assert _rows(J.earnings_at(spark, f"{root}/daily_earnings")) == _rows(M.daily_earnings(whole))
    assert _rows(J.zone_metrics_at(spark, f"{root}/zone_metrics"), *COUNTS) == _rows(M.zone_metrics(whole, P), *COUNTS)


def test_status_batch_replayed_after_compaction(spark, tmp_path):
    from drover.streaming.status_merge import status_merge_sink
    out, snaps = str(tmp_path / "status"), str(tmp_path / "snaps")
    sink = status_merge_sink(spark, out, 1, snaps)
    land = str(tmp_path / "land")
    _stage(land, [[_msg(1, "A", 0, status="idle")], [_msg(2, "A", 50, status="idle")]])
    ev = J.event_stream(spark.read.parquet(land), P)
    sink(ev.where("event_id = 1"), 0)
    sink(ev.where("event_id = 2"), 1)
    CL.compact(spark, out, ["vehicle_id"], snaps)
    sink(ev.where("event_id = 2"), 1)       # written, folded, not committed: comes again
    got = CL.resolve(spark, out, ["vehicle_id"]).first()
    assert got.status_since_us // 1_000_000 - T0 == 0 and got.updated_at_us // 1_000_000 - T0 == 50
    assert CL.resolve_compacted(spark, out, ["vehicle_id"], snaps).first() == got


@pytest.mark.parametrize("mode", ["keyed", "ordered", "merge"])
def test_status_of_nine_field_records(spark, tmp_path, mode):
    import json
    rows = [_msg(0, "A", t, status=s) for t, s in ((0, "idle"), (60, "idle"), (100, "on_trip"), (100, "on_trip"), (900, "idle"))]
    for r in rows:
        v = json.loads(r["value"])
        del v["event_id"]
        r["value"] = json.dumps(v)
    land, out = str(tmp_path / "land"), str(tmp_path / "out")
    _stage(land, [rows[:2], rows[2:4], rows[4:]])
    ev = J.file_event_stream(spark, land, P, max_files_per_trigger=1)
    start = J.start_vehicle_status_merge if mode == "merge" else J.start_vehicle_status
    kw = {"ordered_within": "2 minutes"} if mode == "ordered" else {}
    J.run_to_end(start(ev, out, str(tmp_path / "ck"), None, {"availableNow": True}, **kw))
    got = CL.resolve(spark, out, ["vehicle_id"]).first()
    # in order, the last event is still behind the watermark
    want = ("on_trip", 100) if mode == "ordered" else ("idle", 900)
    assert (got.status, got.status_since_us // 1_000_000 - T0) == want


def test_ordered_status_holds_a_row_per_instant(spark, tmp_path):
    # one vehicle sends all; what waits for the watermark is rows of the state store, not
    # one value of the vehicle that a Python worker must hold whole
    land, out = str(tmp_path / "land"), str(tmp_path / "out")
    statuses = ["idle", "enroute", "on_trip"]
    first = [_msg(i, "A", i / 4, status=statuses[i // 100 % 3]) for i in range(400)]
    twins = [_msg(1000, "A", 99.75, status="on_trip"), _msg(999, "A", 99.75, status="idle")]      # one instant, ids decide
    _stage(land, [first, twins, [_msg(2000, "A", 220, status="idle")], [_msg(2001, "A", 2000, status="idle")]])
    ev = J.file_event_stream(spark, land, P, max_files_per_trigger=1)
    q = J.start_vehicle_status(ev, out, str(tmp_path / "ck"), 1, {"availableNow": True}, ordered_within="2 minutes")
    J.run_to_end(q)
    ops = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert max(o["numRowsTotal"] for o in ops) >= 400
    rows = CL.read_log(spark, out).orderBy("run", "batch_id").collect()
    got = [(r.status, r.status_since_us / 1e6 - T0, r.updated_at_us / 1e6 - T0) for r in rows]
    # watermark 100 after the third file: the instant 99.75 is passed, 100 is not
    assert got == [("on_trip", 99.75, 99.75), ("idle", 220, 220)]
