"""Alert transitions as an append-only log.

A round compares the conditions that fire with the alerts that are open, and nothing else:

* the open set is a small table, one folder per round; the newest is the only table that
  a round reads;
* what changes is appended as transitions (``open`` or ``resolve``) under the round's
  folder, so a round costs the open and the firing alerts, however long the history;
* the alerts as of any time are a fold of the transitions up to it: an aggregation by
  (type, entity, opening time).

The open set is written after the transitions and makes the round valid: transitions of a
round without its open set are not read, and the next attempt at the round replaces them.
Folding a null entity is null-safe (grouping treats nulls as equal). Rounds run one at a
time; an ``as_of`` may repeat but should not go back, because a fold goes by time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.functions import lit_ts
from drover.operators.alerts import empty_alerts
from drover.schemas import ALERT_SCHEMA

KEYS = ["alert_type", "entity_id"]
OPEN_COLUMNS = ["alert_type", "severity", "entity_id", "message", "created_at"]
TRANSITION_SCHEMA = ("alert_type string, severity string, entity_id string, message string, created_at timestamp, "
                     "transition string, at timestamp")


def _rounds(spark: SparkSession, folder: str) -> list[int]:
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    done = [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("round=")]
    path = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(d.getName().split("=")[1]) for d in done if fs.exists(path(d, "_SUCCESS")))


def last_round(spark: SparkSession, store: str) -> int | None:
    """The newest complete round (None: there was none); a listing, no data is read."""
    return max(_rounds(spark, f"{store}/open"), default=None)


def open_alerts(spark: SparkSession, store: str) -> DataFrame:
    """Alerts that are open after the last round."""
    n = last_round(spark, store)
    if n is None:
        return empty_alerts(spark).select(*OPEN_COLUMNS)
    return spark.read.schema(empty_alerts(spark).select(*OPEN_COLUMNS).schema).parquet(f"{store}/open/round={n}")


def transitions_of(open_: DataFrame, firing: DataFrame, params) -> DataFrame:
    """One row per alert that is open or fires: ``transition`` is ``open`` (raised now),
    ``resolve`` (fires no more) or null (stays open; its message is not refreshed). A
    condition that fires several times for an entity raises one alert (the least row)."""
    f = firing.groupBy(*KEYS).agg(F.min(F.struct("severity", "message")).alias("f"))
    cond = (F.col("o.alert_type") == F.col("f.alert_type")) & F.col("o.entity_id").eqNullSafe(F.col("f.entity_id"))
    j = open_.alias("o").join(f.alias("f"), cond, "full")
    is_open, fires = F.col("o.alert_type").isNotNull(), F.col("f.alert_type").isNotNull()
    return j.select(
        F.coalesce("o.alert_type", "f.alert_type").alias("alert_type"),
        F.when(is_open, F.col("o.severity")).otherwise(F.col("f.f.severity")).alias("severity"),
        F.when(is_open, F.col("o.entity_id")).otherwise(F.col("f.entity_id")).alias("entity_id"),
        F.when(is_open, F.col("o.message")).otherwise(F.col("f.f.message")).alias("message"),
        F.when(is_open, F.col("o.created_at")).otherwise(lit_ts(params.as_of)).alias("created_at"),
        F.when(is_open & ~fires, "resolve").when(~is_open, "open").alias("transition"),
        lit_ts(params.as_of).alias("at"))


def evaluate_round(spark: SparkSession, store: str, firing: DataFrame, params) -> int:
    """One round at ``as_of`` with the conditions that fire then; returns its number."""
    last = last_round(spark, store)
    n = 0 if last is None else last + 1
    decided = transitions_of(open_alerts(spark, store), firing, params).persist()
    try:
        (decided.where(F.col("transition").isNotNull()).write.mode("overwrite").parquet(f"{store}/transitions/round={n}"))
        (decided.where(F.coalesce(F.col("transition") != "resolve", F.lit(True))).select(*OPEN_COLUMNS)
         .write.mode("overwrite").parquet(f"{store}/open/round={n}"))
    finally:
        decided.unpersist()
    return n


def alerts_as_of(spark: SparkSession, store: str, as_of: float | None = None) -> DataFrame:
    """The alerts table (``schemas.ALERT_SCHEMA``) as it was after the rounds up to ``as_of``
    (None: after the last round): a fold of the transitions of complete rounds."""
    n = last_round(spark, store)
    if n is None:
        return empty_alerts(spark)
    log = spark.read.schema(TRANSITION_SCHEMA + ", round int").parquet(f"{store}/transitions").where(F.col("round") <= F.lit(n))
    if as_of is not None:
        log = log.where(F.col("at") <= lit_ts(as_of))
    folded = log.groupBy(*OPEN_COLUMNS).agg(
        F.count(F.when(F.col("transition") == "open", True)).alias("opens"),
        F.count(F.when(F.col("transition") == "resolve", True)).alias("resolves"))
    # an alert opened, resolved and opened again at one as_of is several alerts, the last one perhaps open
    each = folded.select("*", F.explode(F.sequence(F.lit(1), F.col("opens").cast("int"))).alias("k"))
    return each.select(*OPEN_COLUMNS, (F.col("k") <= F.col("resolves")).alias("resolved")).select(
        *[f.name for f in ALERT_SCHEMA.fields])
