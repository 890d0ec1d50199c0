"""Sliding distincts from rollups and sketches equal plain sets over the events."""

import random
from datetime import datetime, timedelta, timezone

import pytest

from drover.config import Params
from drover.streaming import recent_rollups as RR

T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)
P = Params(start_epoch=T0.timestamp(), day_seconds=86400, as_of=T0.timestamp() + 3 * 86400 + 4_000.5,
           status_recency_s=5_000, trip_recency_s=100_000)
SCHEMA = "event_id long, vehicle_id string, trip_id string, status string, event_ts timestamp, sim_day int"


def _events(n, seed, hours=76.0, vehicles=40):
    r = random.Random(seed)
    out = []
    for i in range(n):
        s = r.random() ** 0.5 * hours * 3600
        ts = T0 + timedelta(seconds=round(s, 3))
        out.append((seed * 1_000_000 + i, f"V{r.randrange(vehicles)}", r.choice(["-", None, f"T{r.randrange(300)}"]),
                    r.choice(["idle", "on_trip"]), ts, int(s // 86400)))
    return out


def _plain(rows, ranges):
    out = {}
    for i, (a, b) in enumerate(ranges):
        mine = [e for e in rows if a < round(e[4].timestamp() * 1e6) <= b]
        newest = {}
        for e in sorted(mine, key=lambda e: (e[4], e[0])):
            newest[e[1]] = e[3]
        trips = {e[2] for e in mine if e[2] not in ("-", None)}
        if mine:
            out[i] = (len(newest), sum(s == "idle" for s in newest.values()), len(trips))
    return out


def _counted(spark, path, log, ranges):
    return {r["range"]: (r.active_vehicles, r.idle_n, r.trips)
            for r in RR.counts(RR.members_in(spark, path, log, P, ranges)).collect()}


def _ranges(seed, n=14):
    r, end = random.Random(seed), int(T0.timestamp() * 1e6) + int(76 * 3.6e9)
    out = [(end - int(s * 1e6), end) for s in (0, 0.4, 59, 61, 3_600, 86_400, 90_001.25)]
    while len(out) < n:
        a, b = sorted(r.randrange(end - int(80 * 3.6e9), end + 10) for _ in range(2))
        out.append((a, b))
    return out


def test_ranges_are_cut_without_gap_or_overlap():
    for a, b in _ranges(1, 200) + [(59_999_999, 60_000_000), (5, 5), (9, 3), (-200_000_000, 100_000_000)]:
        whole, edges = RR.cut(a, b)
        spans = sorted([(f * u * 1_000_000, e * u * 1_000_000) for u, f, e in whole] + edges)
        assert all(x < y for x, y in spans) and all(p[1] == q[0] for p, q in zip(spans, spans[1:]))
        assert (spans[0][0], spans[-1][1]) == (a + 1, b + 1) if spans else b <= a
        assert sum(y - x for x, y in edges) < 120_000_000 and len(whole) <= 5


def test_generations_late_events_and_replays(spark, tmp_path):
    path, parts = str(tmp_path / "recent"), [_events(400, k) for k in range(5)]
    ranges, seen = _ranges(2), []
    assert _counted(spark, path, spark.createDataFrame([], SCHEMA), ranges) == {}
    for k, rows in enumerate(parts):        # every batch spans all hours: what comes later is late
        seen += rows
        RR.apply_batch(spark.createDataFrame(rows, SCHEMA), path, 1, k)
        if k in (1, 2):
            assert RR.fold(spark, path).endswith(f"generation=g1-{k}")
            assert RR.fold(spark, path) is None
    log = spark.createDataFrame(seen, SCHEMA)
    want = _plain(seen, ranges)
    assert _counted(spark, path, log, ranges) == want
    # a replayed batch, a folded batch once more, and all messages again in a newer epoch
    RR.apply_batch(spark.createDataFrame(parts[4], SCHEMA), path, 1, 4)
    RR.apply_batch(spark.createDataFrame(parts[2], SCHEMA), path, 1, 2)
    RR.apply_batch(log, path, 2, 0)
    assert _counted(spark, path, log, ranges) == want
    RR.fold(spark, path)
    assert _counted(spark, path, log, ranges) == want
    exact = {(i, k): n for i, (v, _, t) in want.items() for k, n in ((RR.VEHICLE, v), (RR.TRIP, t)) if n}
    est = {(r["range"], r.kind): (r.estimate, r.error) for r in RR.estimates(spark, path, log, P, ranges).collect()}
    assert est == {k: (n, 0.0) for k, n in exact.items()}      # fewer members than a sketch holds


def test_an_unfinished_fold_does_not_count(spark, tmp_path):
    path, rows = str(tmp_path / "recent"), _events(300, 7)
    RR.apply_batch(spark.createDataFrame(rows, SCHEMA), path, 1, 0)
    out = RR.fold(spark, path)
    (tmp_path / "recent.folds" / "sketches" / out.rsplit("/", 1)[1] / "_SUCCESS").unlink()
    log, ranges = spark.createDataFrame(rows, SCHEMA), _ranges(3)
    assert RR._generations(spark, path) == [] and _counted(spark, path, log, ranges) == _plain(rows, ranges)
    assert RR.fold(spark, path) == out and len(RR._generations(spark, path)) == 1
    assert _counted(spark, path, log, ranges) == _plain(rows, ranges)


def test_sketches_of_many_members_stay_within_their_error(spark, tmp_path):
    path = str(tmp_path / "recent")
    rows = _events(30_000, 11, vehicles=20_000)
    df = spark.createDataFrame(rows, SCHEMA)
    for k in range(2):
        RR.apply_batch(df.where(f"event_id % 2 = {k}"), path, 1, k)
        RR.fold(spark, path)
    ranges = [(int(T0.timestamp() * 1e6), int(T0.timestamp() * 1e6) + int(d * 8.64e10)) for d in (3, 4)]
    want = _plain(rows, ranges)
    est = {(r["range"], r.kind): r for r in RR.estimates(spark, path, df, P, ranges).collect()}
    for i in want:
        e = est[(i, RR.VEHICLE)]
        assert want[i][0] > 2 ** RR.LG_ENTRIES < e.estimate and 0 < e.error < 0.05 * e.estimate
        assert abs(e.estimate - want[i][0]) <= e.error


def test_whole_units_do_not_read_the_events(spark, tmp_path):
    path, rows = str(tmp_path / "recent"), _events(500, 5)
    RR.apply_batch(spark.createDataFrame(rows, SCHEMA), path, 1, 0)
    RR.fold(spark, path)
    p = P.replace(as_of=T0.timestamp() + 2 * 86400 - 1e-6, trip_recency_s=86400, status_recency_s=3600)
    nothing = spark.createDataFrame([], SCHEMA)
    got = RR.summary(spark, path, nothing, p).first()
    want = _plain(rows, RR.ranges_before(p, (3600, 86400)))
    assert (got.active_vehicles, got.trips_recent) == (want[0][0], want[1][2])
    assert got.idle_ratio == pytest.approx(want[0][1] / want[0][0], abs=5e-4)
    empty = RR.summary(spark, str(tmp_path / "none"), nothing, p).first()
    assert tuple(empty) == (1, 0, 0.0, 0)
