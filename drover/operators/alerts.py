"""Alert rules and their open/resolve lifecycle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from drover import config as C
from drover.functions import known_at, lit_ts, render, seconds_between, time_bucket
from drover.operators.reconcile import target_day
from drover.operators.status import latest_status
from drover.schemas import ALERT_SCHEMA

CONDITION_COLUMNS = ["alert_type", "severity", "entity_id", "message"]


def _whole_seconds(x) -> F.Column:
    # whole seconds, half to even (as Python's "{:.0f}" formats them)
    return F.bround(x, 0).cast("long")


def staleness_condition(events: DataFrame, params) -> DataFrame:
    """Critical when no event is known at ``as_of`` or the newest is older than the threshold."""
    last = known_at(events, params.as_of, params).agg(F.max("event_ts").alias("t"))
    age = seconds_between(lit_ts(params.as_of), F.col("t"))
    thr = int(params.staleness_threshold_s)
    msg = (F.when(F.col("t").isNull(), F.lit(C.MSG_NO_EVENTS))
           .otherwise(render(C.MSG_STALE, age=_whole_seconds(age), threshold=thr)))
    return last.where(F.col("t").isNull() | (age > F.lit(float(thr)))).select(
        F.lit(C.ALERT_STALENESS).alias("alert_type"), F.lit(C.SEVERITY_CRITICAL).alias("severity"),
        F.lit(C.STALENESS_ENTITY).alias("entity_id"), msg.alias("message"))


def idle_condition(latest: DataFrame, params) -> DataFrame:
    """Warning per vehicle whose latest status is idle for longer than the threshold
    (regardless of how recently it reported)."""
    secs = seconds_between(lit_ts(params.as_of), F.col("status_since"))
    thr = int(params.idle_threshold_s)
    return latest.where((F.col("status") == "idle") & (secs > F.lit(float(thr)))).select(
        F.lit(C.ALERT_IDLE).alias("alert_type"), F.lit(C.SEVERITY_WARNING).alias("severity"),
        F.col("vehicle_id").alias("entity_id"),
        render(C.MSG_IDLE, vehicle=F.col("vehicle_id"), seconds=_whole_seconds(secs), threshold=thr)
        .alias("message"))


def batch_conditions(report: DataFrame, params) -> DataFrame:
    """Health of the last closed day's report: missing -> critical, more than half of the
    vehicles unprofitable -> warning."""
    day = target_day(params)
    if day is None:
        return report.sparkSession.createDataFrame([], ALERT_SCHEMA).select(*CONDITION_COLUMNS)
    c = report.where(F.col("sim_day") == F.lit(day)).agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(~F.col("profitable"), True)).alias("bad"))
    missing = F.col("total") == 0
    unprofitable = (F.col("total") > 0) & (F.try_divide(F.col("bad"), F.col("total")) > F.lit(0.5))
    return c.where(missing | unprofitable).select(
        F.when(missing, C.ALERT_REPORT_MISSING).otherwise(C.ALERT_PROFITABILITY).alias("alert_type"),
        F.when(missing, C.SEVERITY_CRITICAL).otherwise(C.SEVERITY_WARNING).alias("severity"),
        F.lit(str(day)).alias("entity_id"),
        F.when(missing, render(C.MSG_REPORT_MISSING, day=day))
        .otherwise(render(C.MSG_UNPROFITABLE, bad=F.col("bad"), total=F.col("total"), day=day)).alias("message"))


def alert_conditions(events: DataFrame, report: DataFrame, params, latest: DataFrame | None = None) -> DataFrame:
    """Everything firing at ``as_of``: staleness, idle vehicles, last closed day's health."""
    latest = latest if latest is not None else latest_status(events, params)
    return (staleness_condition(events, params)
            .unionByName(idle_condition(latest, params))
            .unionByName(batch_conditions(report, params)))


def empty_alerts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ALERT_SCHEMA)


def apply_conditions(alerts: DataFrame, firing: DataFrame, params) -> DataFrame:
    """One evaluation of the alert rules at ``as_of``.

    Open alerts still firing stay as they are (their message is not refreshed); open
    alerts no longer firing are resolved (including a batch alert of the same day when a
    rerun made it healthy); firing conditions without an open alert are raised once.
    Resolved history passes through unchanged. One full outer join on
    (alert_type, entity_id), null-safe.
    """
    history = alerts.where(F.col("resolved"))
    open_ = alerts.where(~F.col("resolved")).alias("o")
    f = firing.alias("f")
    cond = ((F.col("o.alert_type") == F.col("f.alert_type"))
            & F.col("o.entity_id").eqNullSafe(F.col("f.entity_id")))
    j = open_.join(f, cond, "full")
    is_open = F.col("o.alert_type").isNotNull()
    fires = F.col("f.alert_type").isNotNull()
    updated = j.select(
        F.coalesce("o.alert_type", "f.alert_type").alias("alert_type"),
        F.when(is_open, F.col("o.severity")).otherwise(F.col("f.severity")).alias("severity"),
        F.when(is_open, F.col("o.entity_id")).otherwise(F.col("f.entity_id")).alias("entity_id"),
        F.when(is_open, F.col("o.message")).otherwise(F.col("f.message")).alias("message"),
        F.when(is_open, F.col("o.created_at")).otherwise(lit_ts(params.as_of)).alias("created_at"),
        (is_open & ~fires).alias("resolved"))
    return history.unionByName(updated)


def latest_version(spark: SparkSession, store_path: str) -> int | None:
    """Highest committed version of an alert store (None when empty), from a listing of
    its ``version=N`` folders (no data is read). A dynamic-overwrite job moves a partition
    folder into place only when it commits, so a listed folder is complete."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(store_path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    found = [st.getPath().getName() for st in fs.listStatus(path) if st.isDirectory()]
    versions = [int(n.split("=", 1)[1]) for n in found if n.startswith("version=")]
    return max(versions) if versions else None


def read_alerts(spark: SparkSession, store_path: str) -> DataFrame:
    """The current alerts table (latest version), or an empty one."""
    v = latest_version(spark, store_path)
    if v is None:
        return empty_alerts(spark)
    return spark.read.parquet(store_path).where(F.col("version") == v).drop("version")


def evaluate_alerts(spark: SparkSession, store_path: str, firing: DataFrame, params) -> DataFrame:
    """One evaluation round against a persisted alert store: read the current version,
    apply the conditions firing at ``as_of``, write the result as the next version and
    return it read back (the written table is the lineage cut between rounds). A failed
    round leaves the previous version current; versions are never rewritten."""
    v = latest_version(spark, store_path)
    nxt = 0 if v is None else v + 1
    out = apply_conditions(read_alerts(spark, store_path), firing, params)
    (out.withColumn("version", F.lit(nxt)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(store_path))
    return spark.read.parquet(store_path).where(F.col("version") == nxt).drop("version")


def staleness_gaps(events: DataFrame, threshold_s: int, fan_in: int = 1024) -> DataFrame:
    """Every interval between consecutive events longer than the threshold (the history of
    the staleness rule).

    With time buckets no wider than the threshold, such a gap always crosses a bucket
    border, so per-bucket (first, last) suffice: no sort of events. The next non-empty
    bucket is found in two levels: within groups of ``fan_in`` buckets, then across
    groups from one summary row per group, so no task sees more than ``fan_in`` buckets
    or the number of groups.
    """
    b = events.select(time_bucket("event_ts", threshold_s).alias("b"), "event_ts").groupBy("b").agg(
        F.min("event_ts").alias("first_ts"), F.max("event_ts").alias("last_ts"))
    b = b.withColumn("g", F.floor(F.col("b") / F.lit(fan_in)))
    nxt_in_group = F.lead("first_ts").over(Window.partitionBy("g").orderBy("b"))
    groups = b.groupBy("g").agg(F.min("first_ts").alias("g_first"))
    # first event of the next non-empty group; groups are few (span / (threshold x fan_in))
    carry = groups.select("g", F.lead("g_first").over(Window.partitionBy(F.floor(F.col("g") / F.lit(fan_in)))
                                                       .orderBy("g")).alias("g_next"))
    top = groups.groupBy(F.floor(F.col("g") / F.lit(fan_in)).alias("h")).agg(F.min("g_first").alias("h_first"))
    top_next = top.select("h", F.lead("h_first").over(Window.orderBy("h")).alias("h_next"))
    carry = (carry.withColumn("h", F.floor(F.col("g") / F.lit(fan_in))).join(top_next, "h", "left")
             .select("g", F.coalesce("g_next", "h_next").alias("g_next")))
    g = b.select("g", F.col("last_ts").alias("gap_start"), nxt_in_group.alias("in_group")).join(carry, "g", "left")
    g = g.select("gap_start", F.coalesce("in_group", "g_next").alias("gap_end"))
    gap = seconds_between(F.col("gap_end"), F.col("gap_start"))
    return g.where(F.col("gap_end").isNotNull() & (gap > F.lit(float(threshold_s)))).select(
        "gap_start", "gap_end", gap.alias("gap_seconds"))
