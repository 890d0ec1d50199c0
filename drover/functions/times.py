"""Time expressions. Instants are TimestampType in UTC; arithmetic is done on
epoch microseconds (bigint), which keeps it exact and inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(ts) -> Column:
    """Epoch microseconds of a timestamp (NTZ input is read as UTC)."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def ts_from_us(us) -> Column:
    return F.timestamp_micros(_c(us))


def lit_ts(epoch_s: float) -> Column:
    return F.timestamp_micros(F.lit(int(round(epoch_s * 1_000_000))))


def seconds_between(later, earlier) -> Column:
    """``later - earlier`` in (fractional) seconds."""
    return (epoch_us(later) - epoch_us(earlier)) / F.lit(1_000_000.0)


def parse_event_time(s) -> Column:
    """ISO-8601 text to timestamp; unparsable text gives null instead of an error."""
    return F.try_to_timestamp(_c(s))


def time_bucket(ts, bucket_seconds: int) -> Column:
    """Index of the fixed-size time bucket of an instant (floor division)."""
    return F.floor(epoch_us(ts) / F.lit(bucket_seconds * 1_000_000)).cast("long")


def known_at(df, as_of_s: float, params=None, ts_col: str = "event_ts"):
    """Rows with ``ts_col <= as_of``. The comparison is against a timestamp literal, so it
    reaches the Parquet reader (row-group skipping); when ``df`` has a ``sim_day`` column
    the implied day bound is added for partition pruning."""
    out = df.where(F.col(ts_col) <= lit_ts(as_of_s))
    if params is not None and "sim_day" in df.columns:
        out = out.where(F.col("sim_day") <= F.lit(params.day_at(as_of_s)))
    return out


def newer_than(df, since_s: float, params=None, ts_col: str = "event_ts"):
    """Rows with ``ts_col > since`` (pushable, plus the ``sim_day`` lower bound when the
    column exists): a recent-activity query reads only the latest partitions."""
    out = df.where(F.col(ts_col) > lit_ts(since_s))
    if params is not None and "sim_day" in df.columns and ts_col == "event_ts":
        out = out.where(F.col("sim_day") >= F.lit(params.day_at(since_s)))
    return out
