"""The trend kept up by delta joins equals the full join after every commit."""

import random

import pytest

from drover.operators import serving as SV
from drover.operators import trend_deltas as TD

E = "vehicle_id string, sim_day int, total_fare double, trip_count long, removed boolean"
R = "vehicle_id string, sim_day int, net_profit double, profitable boolean, removed boolean"


def _full(spark, e, r):
    e = spark.createDataFrame([(*k, *v, False) for k, v in e.items()], E)
    r = spark.createDataFrame([(*k, *v, False) for k, v in r.items()], R)
    return [tuple(x) for x in SV.income_trend_fleet(e, r).collect()]


def _rounded(rows):
    return [(d, round(f, 6), t, None if n is None else round(n, 6), p) for d, f, t, n, p in rows]


def test_random_commits(spark, tmp_path):
    rnd, store, e, r = random.Random(4), str(tmp_path / "trend"), {}, {}
    assert TD.trend(spark, store).count() == 0
    for number in range(1, 8):
        de, dr = [], []
        for k in {(f"V{rnd.randrange(6)}", rnd.randrange(5)) for _ in range(12)}:
            if k in e and rnd.random() < 0.3:
                de.append((*k, None, None, True))
                del e[k]
            else:
                e[k] = (round(rnd.random() * 50, 2), rnd.randrange(9))
                de.append((*k, *e[k], False))
        for k in {(f"V{rnd.randrange(8)}", rnd.randrange(6)) for _ in range(12)}:
            if k in r and rnd.random() < 0.3:
                dr.append((*k, None, None, True))
                del r[k]
            else:
                n = round(rnd.random() * 40 - 20, 2)
                r[k] = (n, n > 0)
                dr.append((*k, *r[k], False))
        sides = {"earnings": spark.createDataFrame(de, E)} if number != 5 else {}
        if number == 5:         # undo: this commit changes the report only
            for k in [d[:2] for d in de]:
                e.pop(k, None)
            for row in TD.state(spark, store, "earnings", TD.commits(spark, store)).collect():
                e[(row.vehicle_id, row.sim_day)] = (float(row.total_fare), row.trip_count)
        if number != 6:
            sides["report"] = spark.createDataFrame(dr, R)
        else:
            r = {(x.vehicle_id, x.sim_day): (float(x.net_profit), x.net_profit > 0)
                 for x in TD.state(spark, store, "report", TD.commits(spark, store)).collect()}
        assert TD.apply(spark, store, number, **sides)
        assert _rounded(tuple(x) for x in TD.trend(spark, store).collect()) == _rounded(_full(spark, e, r))
    assert not TD.apply(spark, store, 7, earnings=spark.createDataFrame([("V1", 0, 1e6, 1, False)], E))
    with pytest.raises(ValueError):
        TD.apply(spark, store, 0)


def test_broken_commit_and_whole_days(spark, tmp_path):
    store = str(tmp_path / "trend")
    rows = [("A", 0, 1.5, 1, False), ("B", 0, 2.0, 2, False), ("A", 1, 4.0, 1, False), (None, 1, 8.0, 1, False)]
    TD.apply(spark, store, 1, spark.createDataFrame(rows, E), spark.createDataFrame([("A", 0, -1.0, False, False)], R))
    first = [tuple(x) for x in TD.trend(spark, store).collect()]
    assert first == [(0, 3.5, 3, -1.0, False), (1, 12.0, 2, None, None)]
    # commit 2 breaks off before its deltas are valid: nothing of it counts, its next attempt replaces it
    TD.apply(spark, store, 2, spark.createDataFrame([("C", 0, 100.0, 9, False)], E))
    (tmp_path / "trend" / "deltas" / "commit=2" / "_SUCCESS").unlink()
    assert [tuple(x) for x in TD.trend(spark, store).collect()] == first
    assert TD.apply(spark, store, 2, spark.createDataFrame([("B", 0, 5.0, 3, False), ("A", 1, 9.0, 9, False)], E), whole_days=[0])
    assert [tuple(x) for x in TD.trend(spark, store).collect()] == [(0, 5.0, 3, None, None), first[1]]
    # the same rows again change nothing; a row that joins the report brings its net profit back
    TD.apply(spark, store, 3, spark.createDataFrame([("B", 0, 5.0, 3, False)], E))
    TD.apply(spark, store, 4, spark.createDataFrame([("A", 0, 0.5, 1, False), ("B", 0, 5.0, 3, True)], E))
    assert [tuple(x) for x in TD.trend(spark, store).collect()] == [(0, 0.5, 1, -1.0, False), first[1]]


def test_a_change_reads_its_days_alone(spark, tmp_path):
    store = str(tmp_path / "trend")
    every = [(f"V{v}", d, 1.0, 1, False) for v in range(3) for d in range(20)]
    TD.apply(spark, store, 1, spark.createDataFrame(every, E), spark.createDataFrame([(v, d, f, True, False) for v, d, f, _, _ in every], R))
    for side in ("earnings", "report"):         # files of other days cannot be read any more
        for d in (tmp_path / "trend" / side / "commit=1").glob("sim_day=*"):
            for f in d.iterdir() if d.name != "sim_day=7" else ():
                f.write_bytes(b"not a parquet file")
    TD.apply(spark, store, 2, spark.createDataFrame([("V0", 7, 5.0, 4, False)], E),
             spark.createDataFrame([("V1", 7, -2.0, False, False)], R))
    got = {r.sim_day: (r.total_fare, r.trip_count, r.net_profit) for r in TD.trend(spark, store).collect()}
    assert got[7] == (7.0, 6, 0.0) and got[3] == (3.0, 3, 3.0) and len(got) == 20
