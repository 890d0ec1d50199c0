"""Telemetry ingestion: the (key, value) wire frame and its decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from drover.schemas import EVENT_SCHEMA

# What a message broker hands over: key = vehicle id, value = JSON text.
WIRE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])


def to_wire(events: DataFrame, keep=()) -> DataFrame:
    """Encode typed event rows as broker messages (vehicle id key, JSON value); ``keep``
    carries extra columns along (e.g. an ordering column for staging)."""
    cols = [F.col(f.name) for f in EVENT_SCHEMA.fields]
    return events.select(*keep, F.col("vehicle_id").alias("key"), F.to_json(F.struct(*cols)).alias("value"))


def decode_wire(wire: DataFrame) -> DataFrame:
    """JSON value to the fixed event columns; a bad field becomes null, a bad record all null.

    The parsed struct goes through a one-element ``inline``: filters on its fields cannot
    be pushed below a generator, so each message is parsed once. Selecting ``data.*`` from
    a plain projection would let every filter condition inline its own ``from_json`` and
    parse the message again per rule.
    """
    parsed = F.from_json(F.col("value").cast("string"), EVENT_SCHEMA)
    return wire.select(F.inline(F.array(parsed)))


def kafka_telemetry(spark: SparkSession, brokers: str, topic: str,
                    starting_offsets: str = "latest") -> DataFrame:
    """Streaming (key, value) frame from a Kafka topic; tolerates data loss like the original
    job. Needs the Kafka connector on the classpath of the deployment."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", brokers)
           .option("subscribe", topic)
           .option("startingOffsets", starting_offsets)
           .option("failOnDataLoss", "false")
           .load())
    return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def file_telemetry(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (key, value) frame from Parquet files landing in ``path`` (same shape as Kafka)."""
    r = spark.readStream.schema(WIRE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)
