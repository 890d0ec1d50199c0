"""Cleaning rules, enrichment and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from drover import config as C
from drover.functions import parse_event_time, sim_day_of, zone_of


def rules() -> list[tuple[str, Column]]:
    """(name, condition) pairs an event must satisfy; a null condition counts as failed.

    The first six are the original filters; ``trip_id_missing`` and ``driver_id_missing``
    catch rows the original let through and then failed on in its sink.
    """
    lat_lo, lat_hi = C.LAT_RANGE
    lon_lo, lon_hi = C.LON_RANGE
    return [
        ("vehicle_id_missing", F.col("vehicle_id").isNotNull()),
        ("event_ts_invalid", F.col("event_ts").isNotNull()),
        ("status_invalid", F.col("status").isin(*C.VALID_STATUSES)),
        ("position_out_of_range", F.col("lat").between(lat_lo, lat_hi) & F.col("lon").between(lon_lo, lon_hi)),
        ("speed_out_of_range", (F.col("speed") >= C.SPEED_RANGE[0]) & (F.col("speed") <= C.SPEED_RANGE[1])),
        ("fare_out_of_range", (F.col("fare") >= C.FARE_RANGE[0]) & (F.col("fare") <= C.FARE_RANGE[1])),
        ("trip_id_missing", F.col("trip_id").isNotNull()),
        ("driver_id_missing", F.col("driver_id").isNotNull()),
    ]


def parse(decoded: DataFrame) -> DataFrame:
    """Wire-typed rows with ``event_ts`` parsed; unparsable text becomes null."""
    return decoded.withColumn("event_ts", parse_event_time("event_ts"))


def _passes(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def clean(decoded: DataFrame) -> DataFrame:
    """Events that pass every rule, with ``event_ts`` as a timestamp."""
    parsed = parse(decoded)
    ok = None
    for _, cond in rules():
        ok = _passes(cond) if ok is None else ok & _passes(cond)
    return parsed.where(ok)


def quarantine(decoded: DataFrame) -> DataFrame:
    """Rejected events with the list of rules each one failed (``reasons``)."""
    parsed = parse(decoded)
    failed = F.array_compact(F.array(*[F.when(~_passes(c), F.lit(n)) for n, c in rules()]))
    return parsed.withColumn("reasons", failed).where(F.size("reasons") > 0)


def quarantine_counts(decoded: DataFrame) -> DataFrame:
    """Rows failing each rule (a row failing several rules counts for each)."""
    return (quarantine(decoded).select(F.explode("reasons").alias("rule"))
            .groupBy("rule").agg(F.count(F.lit(1)).alias("rejected")))


def enrich(events: DataFrame, params, grid: C.Grid = C.CITY_GRID) -> DataFrame:
    """Add the grid zone and the simulated day of each event."""
    return (events.withColumn("zone", zone_of("lat", "lon", grid))
            .withColumn("sim_day", sim_day_of("event_ts", params)))


def clean_enriched(decoded: DataFrame, params) -> DataFrame:
    return enrich(clean(decoded), params)
