"""Fixed, explicit schemas (nothing is inferred).

Fixed values that must equal the reference for identical results: the names and types of
the wire record, the landing file's header and the stored tables' columns.
"""

from pyspark.sql import types as T

# Wire form of one telemetry event (JSON text).
EVENT_SCHEMA = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("driver_id", T.StringType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("fare", T.DoubleType()),
    T.StructField("event_ts", T.StringType()),
    # Tie-break for events of one vehicle at the same instant (arrival order).
    T.StructField("event_id", T.LongType()),
])

# Daily expense landing file (CSV with header); the flag stays text until parsed.
EXPENSE_CSV_SCHEMA = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("fuel_cost", T.DoubleType()),
    T.StructField("maintenance_cost", T.DoubleType()),
    T.StructField("distance_covered", T.DoubleType()),
    T.StructField("service_flag", T.StringType()),
])

EXPENSES_SCHEMA = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("sim_day", T.IntegerType()),
    T.StructField("fuel_cost", T.DoubleType()),
    T.StructField("maintenance_cost", T.DoubleType()),
    T.StructField("distance_covered", T.DoubleType()),
    T.StructField("service_flag", T.BooleanType()),
])

EARNINGS_SCHEMA = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("sim_day", T.IntegerType()),
    T.StructField("total_fare", T.DoubleType()),
    T.StructField("trip_count", T.LongType()),
])

ZONE_METRICS_SCHEMA = T.StructType([
    T.StructField("zone", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("active_vehicles", T.LongType()),
    T.StructField("idle_count", T.LongType()),
    T.StructField("enroute_count", T.LongType()),
    T.StructField("on_trip_count", T.LongType()),
    T.StructField("trip_count", T.LongType()),
    T.StructField("total_earnings", T.DoubleType()),
    T.StructField("avg_speed", T.DoubleType()),
    T.StructField("sim_day", T.IntegerType()),
])

# Latest status per vehicle as the status streams store it (times in microseconds).
STATUS_SCHEMA = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("driver_id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("last_fare", T.DoubleType()),
    T.StructField("sim_day", T.IntegerType()),
    T.StructField("status_since_us", T.LongType()),
    T.StructField("updated_at_us", T.LongType()),
])

ALERT_SCHEMA = T.StructType([
    T.StructField("alert_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("resolved", T.BooleanType()),
])

# Cleaned, enriched events as stored in the raw log (partition columns last).
RAW_LOG_SCHEMA = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("driver_id", T.StringType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("fare", T.DoubleType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("zone", T.StringType()),
    T.StructField("sim_day", T.IntegerType()),
    T.StructField("run", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])
