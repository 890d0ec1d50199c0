"""Batch layer: profitability reconciliation, reruns, closed days, batch health
(J1, P10-P15, P25, S5, S11-S13, A8, A10, L3, L4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.session import path_exists
from drover.sources.expenses import duplicate_keys

from drover import config as C
from drover.sources.tables import scan_days

REPORT_COLUMNS = ["vehicle_id", "sim_day", "total_fare", "fuel_cost", "maintenance_cost",
                  "net_profit", "distance_covered", "cost_per_km", "profitable"]


def profitability(expenses: DataFrame, earnings: DataFrame) -> DataFrame:
    """Expenses LEFT JOIN earnings on (vehicle, day).

    Starts from expenses: a vehicle-day with earnings but no expense row is not in the
    report (see :func:`unmatched_earnings`); missing earnings count as 0.
    ``cost_per_km`` is null unless distance > 0; ``profitable`` is strictly net > 0.
    """
    e = earnings.select("vehicle_id", "sim_day", "total_fare")
    j = expenses.join(e, ["vehicle_id", "sim_day"], "left")
    fare = F.coalesce(F.col("total_fare"), F.lit(0.0))
    net = fare - F.col("fuel_cost") - F.col("maintenance_cost")
    per_km = F.when(F.col("distance_covered") > 0,
                    (F.col("fuel_cost") + F.col("maintenance_cost")) / F.col("distance_covered"))
    return j.select(
        "vehicle_id", "sim_day", fare.alias("total_fare"), "fuel_cost", "maintenance_cost",
        net.alias("net_profit"), "distance_covered", per_km.alias("cost_per_km"),
        (net > 0).alias("profitable"))


def unmatched_earnings(earnings: DataFrame, expenses: DataFrame) -> DataFrame:
    """Vehicle-days that earned but have no expense row (absent from the report)."""
    return earnings.join(expenses.select("vehicle_id", "sim_day"), ["vehicle_id", "sim_day"], "left_anti")


def merge_expenses(df: DataFrame, path: str) -> None:
    """Upsert expenses by (vehicle_id, sim_day): rows of ``df`` win over all that is stored,
    vehicles of its days that it does not list stay. A key listed twice in ``df`` raises.

    For landed files, whose order of arrival must not matter, see ``operators.landing``;
    rows merged here count as delivered now.
    """
    from drover.operators.landing import KEY, VALUES, merge_versions
    if not duplicate_keys(df).isEmpty():
        raise ValueError("duplicate (vehicle_id, sim_day) rows in an expense load")
    merge_versions(df.select(*KEY, *VALUES, F.current_timestamp().alias("file_version"),
                             F.lit(None).cast("string").alias("file_path")), path)


def upsert_days(df: DataFrame, path: str, sort_within: str | None = "vehicle_id") -> None:
    """Replace exactly the ``sim_day`` partitions present in ``df`` (dynamic overwrite);
    days not in ``df`` are untouched, and an empty ``df`` changes nothing.

    Rows are range-partitioned on (sim_day, vehicle): a large day is spread over several
    writer tasks instead of one, each writing a few files sorted by vehicle (tight
    Parquet min/max statistics for vehicle lookups).
    """
    order = ["sim_day"] + ([sort_within] if sort_within else [])
    out = df.repartitionByRange(*order).sortWithinPartitions(*order)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("sim_day").parquet(path))


def reconcile(spark: SparkSession, expenses_path: str, earnings: DataFrame, report_path: str,
              days=None, heartbeat_path: str | None = None) -> None:
    """Reconcile the given days (all when None) and replace their report partitions.

    Days without expense rows produce no rows and so keep their previous report, and a
    store without expenses has nothing to do (the original job returns without writing). With ``heartbeat_path`` a
    heartbeat row of component ``reconciliation`` is appended after the write.
    """
    if not path_exists(spark, expenses_path):
        return
    expenses = scan_days(spark, expenses_path, days)
    e = earnings if days is None else earnings.where(
        F.col("sim_day").isin([int(d) for d in ([days] if isinstance(days, int) else days)]))
    upsert_days(profitability(expenses, e), report_path)
    if heartbeat_path:
        from drover.streaming.changelog import record_heartbeat
        record_heartbeat(spark, heartbeat_path, "reconciliation")


def target_day(params) -> int | None:
    """The day the daily job reconciles: the last closed day, none before day 1."""
    d = params.current_day - 1
    return d if d >= 0 else None


def closed_days(earnings: DataFrame, expenses: DataFrame, report: DataFrame, params) -> DataFrame:
    """Every closed day (0 <= day < current day) with activity or expenses, whether it has
    expenses and a report yet, and which one is the daily target. Unlike the original
    schedule, days that were missed show up here to be reconciled together."""
    cur = params.current_day
    days = (earnings.select("sim_day", F.lit(False).alias("has_expenses"))
            .unionByName(expenses.select("sim_day", F.lit(True).alias("has_expenses")))
            .where((F.col("sim_day") >= 0) & (F.col("sim_day") < cur))
            .groupBy("sim_day").agg(F.max("has_expenses").alias("has_expenses")))
    done = report.select("sim_day").distinct().withColumn("reconciled", F.lit(True))
    return days.join(done, "sim_day", "left").select(
        "sim_day", "has_expenses", F.coalesce("reconciled", F.lit(False)).alias("reconciled"),
        (F.col("sim_day") == F.lit(cur - 1)).alias("is_target"))


def reconcile_pending(spark: SparkSession, expenses_path: str, earnings: DataFrame, report_path: str,
                      params, heartbeat_path: str | None = None) -> None:
    """Reconcile, in one job, every closed day that has expenses but no report yet (days
    the daily schedule missed). The pending days stay a DataFrame: expenses are restricted
    to them by a semi-join and dynamic overwrite replaces exactly those partitions."""
    if not path_exists(spark, expenses_path):
        return
    expenses = spark.read.parquet(expenses_path)
    report = (spark.read.parquet(report_path) if path_exists(spark, report_path)
              else spark.createDataFrame([], "sim_day int"))
    pending = (closed_days(earnings, expenses, report, params)
               .where(F.col("has_expenses") & ~F.col("reconciled")).select("sim_day"))
    todo = expenses.join(pending, "sim_day", "left_semi")
    upsert_days(profitability(todo, earnings.join(pending, "sim_day", "left_semi")), report_path)
    if heartbeat_path:
        from drover.streaming.changelog import record_heartbeat
        record_heartbeat(spark, heartbeat_path, "reconciliation")


def report_counts(report: DataFrame) -> DataFrame:
    """Vehicles and unprofitable vehicles per reported day."""
    return report.groupBy("sim_day").agg(
        F.count(F.lit(1)).alias("vehicle_count"),
        F.count(F.when(~F.col("profitable"), True)).alias("unprofitable_count"))


def batch_health(report: DataFrame, days: DataFrame) -> DataFrame:
    """Health of each day in ``days``: no report rows -> critical; more than half of the
    vehicles unprofitable -> warning; otherwise no alert."""
    j = days.select("sim_day").distinct().join(report_counts(report), "sim_day", "left")
    total = F.coalesce("vehicle_count", F.lit(0)).cast("long")
    bad = F.coalesce("unprofitable_count", F.lit(0)).cast("long")
    d = F.col("sim_day").cast("string")
    missing = total == 0
    share_bad = F.try_divide(bad, total)  # null when there is no row
    unprofitable = share_bad > F.lit(0.5)
    from drover.functions import render
    return j.select(
        "sim_day", total.alias("vehicle_count"), bad.alias("unprofitable_count"),
        F.when(missing, C.ALERT_REPORT_MISSING).when(unprofitable, C.ALERT_PROFITABILITY).alias("alert_type"),
        F.when(missing, C.SEVERITY_CRITICAL).when(unprofitable, C.SEVERITY_WARNING).alias("severity"),
        F.when(missing, render(C.MSG_REPORT_MISSING, day=d))
        .when(unprofitable, render(C.MSG_UNPROFITABLE, bad=bad, total=total, day=d)).alias("message"))
