"""Per-key sequence operators split into bounded time buckets.

A window partitioned only by a key puts all of that key's rows into one sort task, so a
key holding a large share of the data would stall the job. Here rows are sorted within
(key, time bucket) groups, and only one summary row per group crosses bucket borders:
the carry from bucket to bucket is a window over those summaries, which number
``time span / bucket`` per key whatever the event volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from drover.functions import time_bucket

_B = "__bucket"


def with_prev(df: DataFrame, keys: list[str], ts: str, tie: str, cols: list[str],
              bucket_seconds: int, prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<c>``: the value of ``c`` on the previous row of the same key in
    (ts, tie) order; null on the key's first row."""
    d = df.withColumn(_B, time_bucket(ts, bucket_seconds))
    w = Window.partitionBy(*keys, _B).orderBy(ts, tie)
    d = d.withColumn("__rn", F.row_number().over(w))
    for c in cols:
        d = d.withColumn(prefix + c, F.lag(c).over(w))
    last = d.groupBy(*keys, _B).agg(F.max_by(F.struct(*cols), F.struct(ts, tie)).alias("__last"))
    carry = last.select(*keys, _B, F.lag("__last").over(Window.partitionBy(*keys).orderBy(_B)).alias("__carry"))
    d = d.join(carry, [*keys, _B], "left")
    first = F.col("__rn") == 1
    for c in cols:
        d = d.withColumn(prefix + c, F.when(first, F.col("__carry")[c]).otherwise(F.col(prefix + c)))
    return d.drop(_B, "__rn", "__carry")


def with_run_id(df: DataFrame, keys: list[str], ts: str, tie: str, value: str,
                bucket_seconds: int, out: str = "run_id", start_flag: str | None = None) -> DataFrame:
    """Number the runs of equal ``value`` (non-null) per key in (ts, tie) order (gaps and
    islands): ``out`` starts at 1 and grows by one whenever the value changes.
    ``start_flag`` names an optional boolean column marking the first row of every run.

    Per bucket: local change count; per bucket summary: its first and last value and its
    inner changes; across buckets: whether a bucket opens with a change (its first value
    differs from the previous bucket's last) and the running count of earlier changes."""
    d = df.withColumn(_B, time_bucket(ts, bucket_seconds))
    w = Window.partitionBy(*keys, _B).orderBy(ts, tie)
    d = d.withColumn("__first", F.row_number().over(w) == 1)
    prev = F.lag(value).over(w)
    d = d.withColumn("__chg", F.when(prev.isNotNull() & (prev != F.col(value)), 1).otherwise(0))
    d = d.withColumn("__local", F.sum("__chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    order = F.struct(ts, tie)
    summary = d.groupBy(*keys, _B).agg(
        F.min_by(value, order).alias("__head"), F.max_by(value, order).alias("__tail"),
        F.sum("__chg").alias("__inner"))
    wb = Window.partitionBy(*keys).orderBy(_B)
    prev_tail = F.lag("__tail").over(wb)
    summary = summary.withColumn(
        "__fc", F.when(prev_tail.isNull() | (prev_tail != F.col("__head")), 1).otherwise(0))
    summary = summary.withColumn(
        "__off", F.coalesce(F.sum(F.col("__inner") + F.col("__fc")).over(
            wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    d = d.join(summary.select(*keys, _B, "__fc", "__off"), [*keys, _B], "left")
    d = d.withColumn(out, (F.col("__off") + F.col("__fc") + F.col("__local")).cast("long"))
    if start_flag:
        d = d.withColumn(start_flag, (F.col("__chg") == 1) | (F.col("__first") & (F.col("__fc") == 1)))
    return d.drop(_B, "__first", "__chg", "__local", "__fc", "__off")
