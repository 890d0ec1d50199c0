"""Stream queries in the registry.

Each replays the fixture telemetry through a file stream: broker messages are staged in
event order as several files in a fresh folder under the shared checkpoint directory,
the query runs with ``availableNow`` (several micro-batches), and the resolved sink is
returned -- so the batch SQL oracle applies.
"""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from drover.plans.inputs import Inputs
from drover.plans.registry import query
from drover.session import scratch_path
from drover.sources.telemetry import to_wire
from drover.streaming import changelog as CL
from drover.streaming import jobs as J
from drover.streaming import recent_rollups as RR
from drover.streaming import status_runs as SR
from drover.streaming.staging import stage_in_order

#: Files a replay is staged as at least; a larger table has one per input split.
LEAST_FILES = 6
TRIGGERS = 3
AVAILABLE_NOW = {"availableNow": True}


class _replay_partitions:
    """While a replay query starts, size its state partitions to the cluster's parallelism
    (the replayed input is one table, not a firehose); the session value is restored.
    A stateful query keeps the partition count it started with in its checkpoint."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        key = "spark.sql.shuffle.partitions"
        self.old = self.spark.conf.get(key)
        par = max(1, int(self.spark.sparkContext.defaultParallelism))
        if int(self.old) > par:
            self.spark.conf.set(key, str(par))
        return self

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.shuffle.partitions", self.old)
        return False


def stage_messages(x: Inputs, rows, path: str, order="event_id") -> int:
    """Stage telemetry rows as message files in the order of a column; returns how many
    files a trigger takes so that a replay has several micro-batches."""
    files = max(LEAST_FILES, rows.rdd.getNumPartitions())
    rows = rows.withColumn("__order", F.col(order) if isinstance(order, str) else order)
    stage_in_order(to_wire(rows, keep=("__order",)), path, "__order", files)
    return -(-files // TRIGGERS)


class Replay:
    """Staged input and fresh sink/checkpoint folders for one run."""

    def __init__(self, x: Inputs, name: str, redeliver_every: int | None = None, order="event_id", rows=None):
        self.root = scratch_path(x.spark, name)
        rows = x.raw if rows is None else rows
        if redeliver_every:
            # at-least-once delivery: some messages arrive twice
            rows = rows.unionByName(rows.where(F.col("event_id") % redeliver_every == 0))
        per_trigger = stage_messages(x, rows, f"{self.root}/landing", order)
        J.use_rocksdb(x.spark)
        self.events = J.file_event_stream(x.spark, f"{self.root}/landing", x.params, per_trigger)
        self.sink = f"{self.root}/sink"
        self.checkpoint = f"{self.root}/checkpoint"
        self.run_id = None      # the commit epoch of the checkpoint


EVENT_COLUMNS = ["event_id", "vehicle_id", "driver_id", "trip_id", "status", "lat", "lon", "speed",
                 "fare", "event_ts", "zone", "sim_day"]
ZONE_COLUMNS = ["zone", "window_start", "window_end", "active_vehicles", "idle_count", "enroute_count",
                "on_trip_count", "trip_count", "total_earnings", "avg_speed", "sim_day"]


def _raw_log_run(x: Inputs, heartbeat: bool):
    r = Replay(x, "raw-log")
    hb = f"{r.root}/heartbeat" if heartbeat else None
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_raw_log(r.events, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW, heartbeat_path=hb))
    return r, hb


@query("raw_log_stream")
def _raw_log_stream(x: Inputs):
    """Cleaned events appended to the day-partitioned raw log by a stream."""
    r, _ = _raw_log_run(x, heartbeat=False)
    log = CL.read_log(x.spark, r.sink)
    return log.select(*[F.col(c).cast("int").alias(c) if c == "sim_day" else F.col(c) for c in EVENT_COLUMNS])


@query("component_health")
def _component_health(x: Inputs):
    """Latest heartbeat per component of the streams this process ran."""
    r, hb = _raw_log_run(x, heartbeat=True)
    return CL.component_health(x.spark, hb).drop("updated_at")     # the wall clock


@query("zone_metrics_stream")
def _zone_metrics_stream(x: Inputs):
    """1-minute zone metrics as membership deltas, summed per window."""
    r = Replay(x, "zones")
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_zone_metrics(r.events, x.params, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW))
    return J.zone_metrics_at(x.spark, r.sink).select(*ZONE_COLUMNS)


@query("zone_metrics_late_repair")
def _zone_metrics_late_repair(x: Inputs):
    """1-minute zone metrics when every seventh message comes five minutes late and every
    eleventh three days: windows published before are repaired, none is missing."""
    delay = (F.when(F.col("event_id") % 11 == 0, F.lit(3 * 86400)).when(F.col("event_id") % 7 == 0, F.lit(300)).otherwise(F.lit(0)))
    valid = F.when(F.col("event_ts") != "not-a-timestamp", F.col("event_ts"))
    rows = x.raw.withColumn("__due", F.unix_micros(valid.cast("timestamp")) + delay.cast("long") * 1_000_000)
    r = Replay(x, "zones-late", order="__due", rows=rows)
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_zone_metrics(r.events, x.params, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW))
    return J.zone_metrics_at(x.spark, r.sink).select(*ZONE_COLUMNS)


@query("lost_checkpoint_recovery")
def _lost_checkpoint_recovery(x: Inputs):
    """Messages in three parts; after the second, the raw log's checkpoint is lost and the
    broker has dropped the first part, while the earnings go on from their checkpoint. Per
    day: events and fares of the raw log, and the earnings' fares."""
    root = scratch_path(x.spark, "lost-checkpoint")
    last = x.raw.agg(F.max("event_id")).first()[0]
    J.use_rocksdb(x.spark)

    def land(part: int) -> None:
        lo, hi = (int(last * k / 3) for k in (part, part + 1))
        own = x.raw.where((F.col("event_id") > lo) & (F.col("event_id") <= hi) if part else (F.col("event_id") <= hi))
        stage_messages(x, own, f"{root}/landing/part{part}")

    def events(parts: str):
        return J.file_event_stream(x.spark, f"{root}/landing/part{parts}", x.params, 2 * LEAST_FILES)

    with _replay_partitions(x.spark):
        for parts, ck in (("[01]", "first"), ("[12]", "second")):
            for k in (0, 1) if ck == "first" else (2,):
                land(k)
            J.run_to_end(J.start_raw_log(events(parts), f"{root}/raw_log", f"{root}/checkpoints/raw_log-{ck}", None, AVAILABLE_NOW))
            J.run_to_end(J.start_daily_earnings(events("*"), f"{root}/daily_earnings", f"{root}/checkpoints/daily_earnings", None, AVAILABLE_NOW))
    log = CL.read_raw_log(x.spark, f"{root}/raw_log").groupBy(F.col("sim_day").cast("int").alias("sim_day")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("fare").alias("log_fare"))
    earned = J.earnings_at(x.spark, f"{root}/daily_earnings").groupBy(F.col("sim_day").cast("int").alias("sim_day")).agg(
        F.sum("total_fare").alias("earned"), F.sum("trip_count").alias("trips"))
    return log.join(earned, "sim_day", "full")


@query("zone_metrics_two_level")
def _zone_metrics_two_level(x: Inputs):
    """1-minute zone metrics in append mode via two-level aggregation: every window the
    watermark has passed, written once."""
    r = Replay(x, "zones2")
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_zone_metrics(r.events, x.params, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW,
                                          two_level=True))
    return CL.read_log(x.spark, r.sink).select(*ZONE_COLUMNS)


@query("daily_earnings_stream")
def _daily_earnings_stream(x: Inputs):
    r = Replay(x, "earnings")
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_daily_earnings(r.events, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW))
    return J.earnings_at(x.spark, r.sink)


@query("daily_earnings_bounded_stream")
def _daily_earnings_bounded_stream(x: Inputs):
    """Running earnings with bounded state: day windows behind a two-day watermark, so
    finished days leave the state store; equal to the unbounded form for on-time data."""
    r = Replay(x, "earnings-bounded")
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_daily_earnings(r.events, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW,
                                            params=x.params, bounded=True))
    return CL.resolve(x.spark, r.sink, ["vehicle_id", "sim_day"]).select(
        "vehicle_id", "sim_day", "total_fare", "trip_count")


@query("vehicle_status_stream")
def _vehicle_status_stream(x: Inputs):
    """Latest status and start of the current run, kept in keyed state."""
    r = Replay(x, "status")
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_vehicle_status(r.events, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW))
    s = CL.resolve(x.spark, r.sink, ["vehicle_id"])
    return s.select("vehicle_id", "driver_id", "lat", "lon", "speed", "status", "zone", "last_fare", "sim_day",
                    F.timestamp_micros("status_since_us").alias("status_since"),
                    F.timestamp_micros("updated_at_us").alias("updated_at"))


@query("vehicle_status_merge_stream")
def _vehicle_status_merge_stream(x: Inputs):
    """Latest status maintained without Python: per-batch aggregations merged into the
    status changelog."""
    r = Replay(x, "status-merge")
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_vehicle_status_merge(r.events, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW))
    s = CL.resolve(x.spark, r.sink, ["vehicle_id"])
    return s.select("vehicle_id", "driver_id", "lat", "lon", "speed", "status", "zone", "last_fare", "sim_day",
                    F.timestamp_micros("status_since_us").alias("status_since"),
                    F.timestamp_micros("updated_at_us").alias("updated_at"))


def _shuffled_runs(x: Inputs) -> Replay:
    """The telemetry in an order that has nothing to do with event time, through the stream
    of slice summaries."""
    r = Replay(x, "status-runs", order=F.xxhash64("event_id"))
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_vehicle_status_runs(r.events, x.params, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW))
    return r


@query("vehicle_status_runs_stream")
def _vehicle_status_runs_stream(x: Inputs):
    """Latest status and start of the current run from slice summaries, for messages that
    arrive in shuffled order over several micro-batches."""
    s = CL.resolve(x.spark, _shuffled_runs(x).sink, ["vehicle_id"])
    return s.select("vehicle_id", "driver_id", "lat", "lon", "speed", "status", "zone", "last_fare", "sim_day",
                    F.timestamp_micros("status_since_us").alias("status_since"),
                    F.timestamp_micros("updated_at_us").alias("updated_at"))


@query("vehicle_idle_seconds_stream")
def _vehicle_idle_seconds_stream(x: Inputs):
    """Idle seconds per vehicle and day from the same summaries, for shuffled arrival."""
    return SR.idle_seconds_at(x.spark, _shuffled_runs(x).sink, x.params)


@query("vehicle_status_ordered_stream")
def _vehicle_status_ordered_stream(x: Inputs):
    """Latest status with events applied in event-time order once the watermark (newest
    event - 2 minutes) passes them: the exact status as of the final watermark."""
    r = Replay(x, "status-ordered")
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_vehicle_status(r.events, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW,
                                            ordered_within=x.params.watermark))
    s = CL.resolve(x.spark, r.sink, ["vehicle_id"])
    return s.select("vehicle_id", "driver_id", "lat", "lon", "speed", "status", "zone", "last_fare", "sim_day",
                    F.timestamp_micros("status_since_us").alias("status_since"),
                    F.timestamp_micros("updated_at_us").alias("updated_at"))


@query("vehicle_status_nine_fields")
def _vehicle_status_nine_fields(x: Inputs):
    """Latest status in keyed state from records of the original nine fields (no event id)."""
    r = Replay(x, "status-nine")
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_vehicle_status(r.events.withColumn("event_id", F.lit(None).cast("long")), r.sink, r.checkpoint,
                                            r.run_id, AVAILABLE_NOW))
    s = CL.resolve(x.spark, r.sink, ["vehicle_id"])
    return s.select("vehicle_id", "status", "zone", "sim_day", F.timestamp_micros("status_since_us").alias("status_since"),
                    F.timestamp_micros("updated_at_us").alias("updated_at"))


@query("dedup_events_stream")
def _dedup_events_stream(x: Inputs):
    """Re-delivered messages removed within the watermark (two-stage, copies spread over
    4 tasks first)."""
    r = Replay(x, "dedup", redeliver_every=50)
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_dedup(r.events, x.params, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW, spread=4))
    log = CL.read_log(x.spark, r.sink)
    return log.select("event_id", "vehicle_id", "status", "event_ts", F.col("sim_day").cast("int").alias("sim_day"),
                      "zone")


#: Added to the id of an event that shares another one's vehicle and instant.
TWIN = 1_000_000_000


@query("dedup_history_stream")
def _dedup_history_stream(x: Inputs):
    """Every third message is delivered again a week later, and every fortieth has a second
    event of the same vehicle and instant: copies are removed, second events stay."""
    valid = F.when(F.col("event_ts") != "not-a-timestamp", F.col("event_ts"))
    due = F.unix_micros(valid.cast("timestamp"))
    raw = x.raw.unionByName(x.raw.where(F.col("event_id") % 40 == 0).withColumn("event_id", F.col("event_id") + F.lit(TWIN)))
    again = raw.where(F.col("event_id") % 3 == 0).withColumn("__due", due + F.lit(7 * 86400 * 1_000_000))
    r = Replay(x, "dedup-history", order="__due", rows=raw.withColumn("__due", due).unionByName(again))
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_history_dedup(r.events, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW))
    log = CL.read_log(x.spark, r.sink)
    return log.select("event_id", "vehicle_id", "status", "event_ts", F.col("sim_day").cast("int").alias("sim_day"), "zone")


#: Lengths of the ranges of ``sliding_distincts`` in seconds; none but the day is a whole unit.
SLIDING = (90, 3_700, 21_605, 86_400, 7 * 86_400 + 1_234, 40 * 86_400 + 59)
#: Ranges end this many seconds before ``as_of``, inside a minute.
SLIDING_LAG = 7 * 3600 + 1_027


def _rollups(x: Inputs):
    """Raw log and member rollups of the telemetry in event order, with every ninth message
    delivered twice, folded into a generation."""
    r = Replay(x, "recent", redeliver_every=9)
    rollup = f"{r.root}/recent"
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_raw_log(r.events, r.sink, r.checkpoint, r.run_id, AVAILABLE_NOW))
        J.run_to_end(J.start_recent_rollups(r.events, rollup, f"{r.root}/checkpoint-recent", None, AVAILABLE_NOW))
    RR.fold(x.spark, rollup)
    return rollup, CL.read_raw_log(x.spark, r.sink)


@query("realtime_summary_rollups")
def _realtime_summary_rollups(x: Inputs):
    """The live summary from members per day, hour and minute instead of the events."""
    rollup, log = _rollups(x)
    return RR.summary(x.spark, rollup, log, x.params)


@query("sliding_distincts")
def _sliding_distincts(x: Inputs):
    """Distinct vehicles and trips of ranges from 90 seconds to 40 days that end inside a
    minute, exact from the member rollups, and whether the merged sketches agree within
    three standard errors."""
    rollup, log = _rollups(x)
    p = x.params.replace(as_of=x.params.as_of - SLIDING_LAG)
    ranges = RR.ranges_before(p, SLIDING)
    exact = RR.members_in(x.spark, rollup, log, p, ranges).groupBy("range", "kind").agg(F.count(F.lit(1)).alias("n"))
    both = exact.join(RR.estimates(x.spark, rollup, log, p, ranges), ["range", "kind"], "full")
    seconds = F.element_at(F.array(*(F.lit(s) for s in SLIDING)), F.col("range") + 1)
    return both.select(seconds.alias("seconds"), F.when(F.col("kind") == RR.VEHICLE, "vehicle").otherwise("trip").alias("kind"), "n",
                       (F.abs(F.col("estimate") - F.col("n")) <= F.col("error")).alias("sketch_within"))


@query("expense_landing_stream")
def _expense_landing_stream(x: Inputs):
    """Expense files picked up incrementally as they land (a day per file) and loaded
    into the day-partitioned expenses table, over several micro-batches."""
    from drover.sources.expenses import write_landing
    root = scratch_path(x.spark, "expense-loader")
    write_landing(x.expenses, f"{root}/landing", one_file_per_day=True)
    with _replay_partitions(x.spark):
        J.run_to_end(J.start_expense_loader(x.spark, f"{root}/landing", f"{root}/table", f"{root}/checkpoint",
                                            AVAILABLE_NOW, max_files_per_trigger=10))
    t = x.spark.read.parquet(f"{root}/table")
    return t.select("vehicle_id", F.col("sim_day").cast("int").alias("sim_day"), "fuel_cost", "maintenance_cost",
                    "distance_covered", "service_flag")


@query("expense_file_precedence")
def _expense_file_precedence(x: Inputs):
    """Expense files and, in the same trigger, a corrected file of day 3; then the original
    of day 3 is delivered once more. The correction's vehicles stay corrected."""
    from drover.sources.expenses import write_landing
    from drover.sources.fixtures import expense_correction_rows
    root = scratch_path(x.spark, "expense-precedence")
    table, checkpoint = f"{root}/table", f"{root}/checkpoint"

    def load():
        with _replay_partitions(x.spark):
            J.run_to_end(J.start_expense_loader(x.spark, f"{root}/landing", table, checkpoint, AVAILABLE_NOW))
    write_landing(x.expenses, f"{root}/landing/original", one_file_per_day=True)
    settle()
    write_landing(expense_correction_rows(x.spark, x.sf_dir, 3), f"{root}/landing/corrected", one_file_per_day=True)
    load()
    settle()
    write_landing(x.expenses.where("sim_day = 3"), f"{root}/landing/again", one_file_per_day=True)
    load()
    t = x.spark.read.parquet(table)
    return t.select("vehicle_id", F.col("sim_day").cast("int").alias("sim_day"), "fuel_cost", "maintenance_cost",
                    "distance_covered", "service_flag")


def settle() -> None:
    """Let the file system's clock move on, so that the next file is newer."""
    time.sleep(1.1)


def _r(e, n):
    from drover.plans.oracle import _r as r6
    return r6(e, n)


_EV_COLS = ("event_id, vehicle_id, driver_id, trip_id, status, " + ", ".join(_r(c, c) for c in ("lat", "lon", "speed", "fare"))
            + ", epoch_us(event_ts) AS event_ts, zone, sim_day")


def stream_oracles() -> dict[str, str]:
    from drover.plans import oracle as O
    wm_us = 2 * 60 * 1_000_000
    return {
        "raw_log_stream": f"SELECT {_EV_COLS} FROM ev",
        "component_health": ("SELECT 'stream-processor' AS component, 'healthy' AS status, "
                             "max(epoch_us(event_ts)) AS last_event_at FROM ev"),
        "zone_metrics_stream": O._Q["zone_metrics_1min"],
        # append mode emits a window once the watermark (newest event - 2 min) passes its end
        "zone_metrics_two_level": (f"SELECT * FROM ({O._Q['zone_metrics_1min']}) "
                                   f"WHERE window_end <= (SELECT max(epoch_us(event_ts)) FROM ev) - {wm_us}"),
        "daily_earnings_stream": O._Q["daily_earnings"],
        "daily_earnings_bounded_stream": O._Q["daily_earnings"],
        "vehicle_status_stream": O._Q["vehicle_status_latest"],
        "vehicle_status_merge_stream": O._Q["vehicle_status_latest"],
        "vehicle_status_runs_stream": O._Q["vehicle_status_latest"],
        "vehicle_idle_seconds_stream": O._Q["vehicle_idle_seconds"],
        # events strictly older (in ms) than the final watermark, newest event - 2 min
        "vehicle_status_ordered_stream": O._Q["vehicle_status_latest"].replace("FROM latest", "FROM latestw"),
        "dedup_events_stream": "SELECT event_id, vehicle_id, status, epoch_us(event_ts) AS event_ts, sim_day, zone FROM ev",
        "dedup_history_stream": ("SELECT event_id, vehicle_id, status, epoch_us(event_ts) AS event_ts, sim_day, zone FROM ev "
                                 f"UNION ALL SELECT event_id + {TWIN}, vehicle_id, status, epoch_us(event_ts), sim_day, zone "
                                 "FROM ev WHERE event_id % 40 = 0"),
        "realtime_summary_rollups": O._Q["realtime_summary"],
        "sliding_distincts": " UNION ALL ".join(
            f"SELECT CAST({s} AS INTEGER) AS seconds, '{kind}' AS kind, n, true AS sketch_within FROM (SELECT count(DISTINCT {m}) AS n FROM ev "
            f"WHERE epoch_us(event_ts) > {O.AS_OF_US - (SLIDING_LAG + s) * 1_000_000} "
            f"AND epoch_us(event_ts) <= {O.AS_OF_US - SLIDING_LAG * 1_000_000}) WHERE n > 0"
            for s in SLIDING for kind, m in (("vehicle", "vehicle_id"), ("trip", "CASE WHEN trip_id <> '-' THEN trip_id END"))),
        "expense_landing_stream": O._Q["expense_feed"],
        "expense_file_precedence": O._Q["expense_correction"],
        "zone_metrics_late_repair": O._Q["zone_metrics_1min"],
        "lost_checkpoint_recovery": (
            "SELECT e.sim_day, e.events, e.log_fare, earned, trips FROM (SELECT sim_day, count(*) AS events, "
            f"{_r('sum(fare)', 'log_fare')} FROM ev GROUP BY sim_day) e JOIN (SELECT sim_day, {_r('sum(fare)', 'earned')}, "
            "CAST(count(DISTINCT CASE WHEN trip_id <> '-' THEN vehicle_id || '/' || trip_id END) AS BIGINT) AS trips "
            "FROM ev GROUP BY sim_day) d ON e.sim_day = d.sim_day"),
        "vehicle_status_nine_fields": ("SELECT vehicle_id, status, zone, sim_day, status_since, updated_at FROM ("
                                       + O._Q["vehicle_status_latest"] + ")"),
    }

