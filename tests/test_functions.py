"""Zone grid, simulated day, flag parsing: edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from drover import config as C
from drover.config import Params
from drover.functions import sim_day_of, zone_of
from drover.sources.expenses import parse_flag


def _zone_py(lat, lon):
    # direct statement of the grid rule, for comparison
    lf = (lat - C.CITY_MIN_LAT) / (C.CITY_MAX_LAT - C.CITY_MIN_LAT)
    of = (lon - C.CITY_MIN_LON) / (C.CITY_MAX_LON - C.CITY_MIN_LON)
    lf = min(max(lf, 0.0), C.GRID_FRACTION_CEILING)
    of = min(max(of, 0.0), C.GRID_FRACTION_CEILING)
    return C.ZONE_NAMES[(2 - int(lf * 3)) * 3 + int(of * 3)]


def test_zone_corners_thirds_and_outside(spark):
    lats = [C.CITY_MIN_LAT, C.CITY_MAX_LAT, 6.83 + 0.13 / 3, 6.83 + 2 * 0.13 / 3, 0.0, 90.0, -90.0, 6.9]
    lons = [C.CITY_MIN_LON, C.CITY_MAX_LON, 79.83 + 0.1 / 3, 79.83 + 0.2 / 3, -180.0, 180.0, 79.88, 79.9]
    pts = [(a, b) for a in lats for b in lons]
    df = spark.createDataFrame(pts, "lat double, lon double").select("lat", "lon", zone_of("lat", "lon").alias("z"))
    for r in df.collect():
        assert r.z == _zone_py(r.lat, r.lon), (r.lat, r.lon)
    assert {r.z for r in df.collect()} <= set(C.ZONE_NAMES)


def test_zone_north_row_first(spark):
    r = spark.createDataFrame([(6.959, 79.831), (6.831, 79.929)], "lat double, lon double") \
        .select(zone_of("lat", "lon").alias("z")).collect()
    assert [x.z for x in r] == ["zone_NW", "zone_SE"]


def test_zone_null_in_null_out(spark):
    r = spark.createDataFrame([(None, 79.9), (6.9, None)], "lat double, lon double") \
        .select(zone_of("lat", "lon").alias("z")).collect()
    assert all(x.z is None for x in r)


def test_sim_day_floor_and_negative(spark):
    p = Params(start_epoch=1000.0, day_seconds=300)
    rows = [(999.0,), (1000.0,), (1299.999999,), (1300.0,), (400.0,)]
    df = spark.createDataFrame(rows, "t double").select(
        "t", sim_day_of(F.timestamp_seconds("t"), p).alias("d"))
    got = {r.t: r.d for r in df.collect()}
    assert got == {999.0: -1, 1000.0: 0, 1299.999999: 0, 1300.0: 1, 400.0: -2}
    for t, d in got.items():
        assert d == math.floor((t - 1000.0) / 300)


@pytest.mark.parametrize("text,expected", [("True", True), (" true ", True), ("TRUE", True), ("False", False),
                                           ("yes", False), ("1", False), (None, False)])
def test_service_flag(spark, text, expected):
    r = spark.createDataFrame([(text,)], "s string").select(parse_flag("s").alias("b")).collect()[0]
    assert r.b is expected


def test_random_points_always_in_grid(spark):
    import random
    rnd = random.Random(11)
    pts = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(1000)]
    pts += [(rnd.uniform(6.8, 7.0), rnd.uniform(79.8, 80.0)) for _ in range(1000)]
    df = spark.createDataFrame(pts, "lat double, lon double").select("lat", "lon", zone_of("lat", "lon").alias("z"))
    for r in df.collect():
        assert r.z == _zone_py(r.lat, r.lon)
