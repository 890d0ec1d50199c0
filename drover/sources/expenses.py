"""Daily expense landing files (CSV with header, one file or folder per day)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from drover.schemas import EXPENSE_CSV_SCHEMA

# Day number in a landing path: ``expenses_day12.csv`` or a ``sim_day=12`` folder.
_DAY_IN_PATH = r"(?:expenses_day|sim_day=)(-?\d+)"


def parse_flag(c) -> F.Column:
    """Text flag to boolean: ``strip().lower() == "true"``; anything else (null too) is false."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.lower(F.trim(c)) == F.lit("true"), F.lit(False))


def _typed(raw: DataFrame, with_file: bool = False) -> DataFrame:
    day = F.regexp_extract(F.col("_metadata.file_path"), _DAY_IN_PATH, 1).cast("int")
    file = [F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_modification_time").alias("file_modified")] if with_file else []
    return raw.select(
        "vehicle_id", day.alias("sim_day"), "fuel_cost", "maintenance_cost", "distance_covered",
        parse_flag("service_flag").alias("service_flag"), *file,
    )


def read_expense_feed(spark: SparkSession, path: str, mode: str = "FAILFAST", with_file: bool = False) -> DataFrame:
    """Typed expense rows with ``sim_day`` taken from each file's path.

    ``mode=FAILFAST`` (default) fails the load on any unparsable number, as the original
    loader does; ``PERMISSIVE`` keeps such rows with nulls for quarantine. ``with_file`` adds
    each row's file (``file_path``, ``file_modified``).
    """
    raw = (spark.read.schema(EXPENSE_CSV_SCHEMA)
           .option("header", "true").option("mode", mode)
           .option("recursiveFileLookup", "true")
           .csv(path))
    return _typed(raw, with_file)


def expense_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Landing lines that do not parse (wrong number of fields, text in a number), with
    their file and day, read in PERMISSIVE mode through Spark's corrupt-record column:
    the quarantine side of :func:`read_expense_feed`."""
    schema = T.StructType(EXPENSE_CSV_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
    raw = (spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record").option("recursiveFileLookup", "true")
           .csv(path))
    day = F.regexp_extract(F.col("_metadata.file_path"), _DAY_IN_PATH, 1).cast("int")
    # Every field is selected: the CSV reader parses only the columns a query uses, so a
    # bad value in an unused column would not be detected (and Spark refuses a scan of
    # the corrupt-record column alone).
    fields = [f.name for f in EXPENSE_CSV_SCHEMA.fields]
    return raw.where(F.col("_corrupt_record").isNotNull()).select(
        F.col("_metadata.file_path").alias("file_path"), day.alias("sim_day"), *fields,
        F.col("_corrupt_record").alias("line"))


def stream_expense_feed(spark: SparkSession, path: str, mode: str = "FAILFAST",
                        max_files_per_trigger: int | None = None, with_file: bool = False) -> DataFrame:
    """Streaming form of :func:`read_expense_feed`: each newly landed file is read once
    (replaces polling for "is day N's file there?")."""
    r = (spark.readStream.schema(EXPENSE_CSV_SCHEMA).option("header", "true").option("mode", mode)
         .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return _typed(r.csv(path), with_file)


def landed_days(spark: SparkSession, path: str) -> DataFrame:
    """Which days have a landing file (distinct ``sim_day``), read from file paths only."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.csv").load(path).select("path"))
    return (files.select(F.regexp_extract("path", _DAY_IN_PATH, 1).cast("int").alias("sim_day"))
            .where(F.col("sim_day").isNotNull()).distinct())


def duplicate_keys(expenses: DataFrame) -> DataFrame:
    """(vehicle_id, sim_day) keys that occur more than once in a feed; the original upsert
    fails on them, here they are reported."""
    return (expenses.groupBy("vehicle_id", "sim_day").count()
            .where(F.col("count") > 1).withColumnRenamed("count", "copies"))


def write_landing(expenses: DataFrame, path: str, one_file_per_day: bool = False) -> None:
    """Land typed expenses as per-day CSV folders (``sim_day=N``), flags as ``True``/``False``.

    ``one_file_per_day`` mimics the source system's contract (a day arrives as one complete
    file); otherwise a day may be split over several files."""
    out = expenses.select(
        "vehicle_id", "fuel_cost", "maintenance_cost", "distance_covered",
        F.when(F.col("service_flag"), F.lit("True")).otherwise(F.lit("False")).alias("service_flag"),
        "sim_day",
    )
    # range on (day, vehicle): each writer task holds a contiguous slice, so a day becomes a
    # few files instead of one file per task
    out = out.repartition("sim_day") if one_file_per_day else out.repartitionByRange("sim_day", "vehicle_id")
    (out.sortWithinPartitions("sim_day", "vehicle_id")
     .write.mode("overwrite").partitionBy("sim_day").option("header", "true").csv(path))
