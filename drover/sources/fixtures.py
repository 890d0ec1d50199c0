"""Adapters from the shared test tables to this domain's inputs.

``events`` becomes raw telemetry and ``orders`` joined with ``lineitem`` becomes the daily
expense feed. Dirty rows are planted by modulus so that every cleaning rule rejects
something. The same formulas are written as SQL in ``drover.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.config import FIXTURE_PARAMS
from drover.sources.telemetry import to_wire


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pad6(c) -> F.Column:
    return F.lpad(c.cast("string"), 6, "0")


def _round2(x) -> F.Column:
    # Round half up to cents, written the same way in the SQL oracle.
    return F.floor(x * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)


def telemetry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw telemetry rows (wire field types: ``event_ts`` is still text)."""
    ev = _read(spark, sf_dir, "events")
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("long")
    day = F.floor((F.unix_micros(ts) - F.lit(FIXTURE_PARAMS.start_us)) / F.lit(86_400_000_000)).cast("long")
    moving = etype.isin("click", "purchase")
    status = (F.when(etype == "click", "enroute").when(etype == "purchase", "on_trip")
              .when(etype.isin("view", "signup"), "idle").when(etype == "error", "offline"))
    trip = F.when(moving, F.concat(F.lit("T"), uid.cast("string"), F.lit("_"), day.cast("string"),
                                   F.lit("_"), (k % 2).cast("string"))).otherwise(F.lit("-"))
    lat = F.when(eid % 101 == 0, F.lit(95.0)).otherwise(
        F.lit(6.83) + F.lit(0.13) * (((uid * 37 + eid * 11) % 1100) - 50) / F.lit(1000.0))
    lon = F.lit(79.83) + F.lit(0.10) * (((uid * 53 + eid * 17) % 1100) - 50) / F.lit(1000.0)
    speed = (F.when(eid % 103 == 0, F.lit(250.0))
             .when(moving, F.lit(25.0) + (k % 31).cast("double")).otherwise(F.lit(0.0)))
    fare = (F.when(eid % 107 == 0, F.lit(-1.0))
            .when(etype == "purchase", F.col("value")).otherwise(F.lit(0.0)))
    iso = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    event_ts = F.when(eid % 109 == 0, F.lit("not-a-timestamp")).otherwise(iso)
    vehicle = F.when(eid % 113 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("V"), _pad6(uid)))
    return ev.select(
        trip.alias("trip_id"),
        F.concat(F.lit("D"), _pad6(uid)).alias("driver_id"),
        vehicle.alias("vehicle_id"),
        lat.alias("lat"), lon.alias("lon"), speed.alias("speed"),
        status.alias("status"), fare.alias("fare"),
        event_ts.alias("event_ts"), eid.alias("event_id"),
    )


def telemetry_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as broker messages (key, JSON value)."""
    return to_wire(telemetry_rows(spark, sf_dir))


def expense_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed expense rows, one per (vehicle, day)."""
    li = _read(spark, sf_dir, "lineitem")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # Reduce lineitem to one row per order before the join (4x fewer rows shuffled).
    per_order = li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("q"),
        F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("m"),
        F.max(F.col("l_returnflag") == "R").alias("svc"),
    )
    j = per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
    u = F.floor(F.col("o_custkey") / F.lit(10)).cast("long")
    g = j.groupBy(u.alias("u"), (F.col("o_orderkey") % 30).cast("int").alias("sim_day")).agg(
        F.sum("q").alias("q"), F.sum("m").alias("m"), F.max("svc").alias("svc"))
    no_distance = F.col("u") % 13 == 0
    return g.select(
        F.concat(F.lit("V"), _pad6(F.col("u"))).alias("vehicle_id"),
        "sim_day",
        F.when(no_distance, F.lit(0.0)).otherwise(_round2(F.col("q") * F.lit(0.035))).alias("fuel_cost"),
        _round2(F.col("m") / F.lit(10000.0)).alias("maintenance_cost"),
        F.when(no_distance, F.lit(0.0)).otherwise(F.col("q") * F.lit(0.1)).alias("distance_covered"),
        F.col("svc").alias("service_flag"),
    )


def expense_correction_rows(spark: SparkSession, sf_dir: str, day: int = 3) -> DataFrame:
    """A corrected feed for one day: maintenance doubled, every tenth vehicle not listed (it stays)."""
    e = expense_rows(spark, sf_dir).where(F.col("sim_day") == day)
    u = F.substring("vehicle_id", 2, 6).cast("long")
    return (e.where(u % 10 != 0)
            .withColumn("maintenance_cost", F.col("maintenance_cost") * F.lit(2.0)))
