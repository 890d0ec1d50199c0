"""The speed layer as Structured Streaming queries.

One decoded, cleaned, enriched event stream feeds independent queries, each with its own
checkpoint and a changelog sink written from ``foreachBatch`` on the executors
(``start_speed_layer`` starts them together):

* raw log         -- append, partitioned by ``sim_day`` (replay-safe by batch id), heartbeats;
                     downstream queries may read it back typed (``raw_log_events``)
* zone metrics    -- window x zone: membership deltas (exact, any lateness, no state), the
                     two-level plan in append mode, or HyperLogLog sketches in update mode
* daily earnings  -- running (vehicle, day) totals: membership deltas, or day-bounded state
* latest status   -- summaries of time slices (exact whatever the order of arrival), keyed
                     state per vehicle (immediate or event-time ordered), or a per-batch merge
* deduplicated    -- ``dropDuplicatesWithinWatermark``, optionally two-stage for hot copies
* expense loader  -- landing files picked up incrementally into the expenses table

plus ``rebuild_earnings`` (batch recompute from the raw log after a checkpoint loss) and
``watermark_losses`` (what late events changed, stream vs batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.operators import metrics as M
from drover.operators.clean import clean, enrich
from drover.sources.telemetry import decode_wire, file_telemetry
from drover.streaming import changelog as CL
from drover.streaming import member_deltas as MD
from drover.streaming.epochs import epoch_of, fence
from drover.streaming.status_state import held_events, latest_status_stream

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep large streaming state off the JVM heap (set before a query first starts)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    cur = spark.conf.get(key, None)
    if not cur or "HDFSBackedStateStoreProvider" in cur:
        spark.conf.set(key, STATE_PROVIDER)


def event_stream(wire: DataFrame, params) -> DataFrame:
    """Broker messages -> cleaned, enriched events (same operators as the batch form)."""
    return enrich(clean(decode_wire(wire)), params)


def file_event_stream(spark: SparkSession, path: str, params, max_files_per_trigger: int = 1) -> DataFrame:
    return event_stream(file_telemetry(spark, path, max_files_per_trigger), params)


def raw_log_events(spark: SparkSession, raw_log_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the cleaned events back out of the raw log (typed Parquet).

    With this, one query decodes and cleans the broker messages (``start_raw_log``) and
    the other queries read typed columns instead of parsing every message again.
    """
    from drover.schemas import RAW_LOG_SCHEMA
    r = spark.readStream.schema(RAW_LOG_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(raw_log_path).drop("run", "batch_id")


def _start(df: DataFrame, sink, checkpoint: str, mode: str, trigger: dict, name: str):
    w = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    return w.trigger(**trigger).queryName(name).start()


def heartbeat(batch_df: DataFrame, component: str) -> DataFrame:
    """One row per non-empty micro-batch: component, newest event seen, row count, status."""
    return (batch_df.agg(F.max("event_ts").alias("last_event_at"), F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > 0)
            .select(F.lit(component).alias("component"), "last_event_at", "rows",
                    F.lit("healthy").alias("status")))


def _run(events: DataFrame, checkpoint: str, sink_path: str, run_id: int | None) -> int:
    """The run that a query's batches are written under: the commit epoch of its checkpoint,
    unless the caller numbers runs itself."""
    return epoch_of(events.sparkSession, checkpoint, sink_path) if run_id is None else run_id


def start_raw_log(events: DataFrame, sink_path: str, checkpoint: str, run_id: int | None = None,
                  trigger: dict | None = None, heartbeat_path: str | None = None,
                  component: str = "stream-processor"):
    """Append cleaned events to the raw log (partitioned by day), plus a heartbeat row.
    Read it back with ``changelog.read_raw_log``."""
    run = _run(events, checkpoint, sink_path, run_id)

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        fence(batch_df.sparkSession, sink_path, run)
        batch_df = batch_df.persist()
        CL.write_batch(batch_df, sink_path, run, batch_id, partition_by=("sim_day",))
        if heartbeat_path:
            CL.write_batch(heartbeat(batch_df, component), heartbeat_path, run, batch_id,
                           partition_by=("component",))
        batch_df.unpersist()
    return _start(events, sink, checkpoint, "append", trigger or {"processingTime": "5 seconds"}, "raw_log")


def _start_totals(keyed: DataFrame, totals: MD.Totals, sink_path: str, checkpoint: str, run_id: int | None,
                  trigger: dict | None, name: str, delay: str | None = None):
    run = _run(keyed, checkpoint, sink_path, run_id)

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        MD.apply_batch(batch_df, totals, sink_path, run, batch_id, delay)
    return _start(keyed, sink, checkpoint, "append", trigger or {"processingTime": "15 seconds"}, name)


def start_zone_metrics(events: DataFrame, params, sink_path: str, checkpoint: str, run_id: int | None = None,
                       trigger: dict | None = None, two_level: bool = False, approx_rsd: float | None = None):
    """Window x zone metrics.

    Default: exact counts and sums as membership deltas, without streaming state; read them
    with :func:`zone_metrics_at`, with or without what came behind the watermark.
    ``two_level=True``: the batch plan (distinct members first, then counts) in append
    mode; state holds one row per member, and each window is written once, when final.
    ``approx_rsd``: update mode with HyperLogLog++ sketches. These two write a changelog of
    whole rows (``changelog.resolve``) and drop what comes behind the watermark.
    """
    if not two_level and approx_rsd is None:
        return _start_totals(M.zone_keyed(events, params), M.zone_totals(), sink_path, checkpoint, run_id, trigger,
                             "zone_metrics", params.watermark)
    run = _run(events, checkpoint, sink_path, run_id)
    wm = events.withWatermark("event_ts", params.watermark)
    agg, mode = (M.zone_metrics(wm, params), "append") if two_level else (
        M.zone_metrics_sketches(wm, params, rsd=approx_rsd), "update")
    return _start(agg, CL.changelog_sink(sink_path, run), checkpoint, mode,
                  trigger or {"processingTime": "15 seconds"}, "zone_metrics")


def zone_metrics_at(spark: SparkSession, path: str, where=None, late: bool = True, snapshots: str | None = None) -> DataFrame:
    """Zone metrics from the deltas at ``path``: of all events so far, or (``late=False``) of
    those only that a watermarked aggregation counts. ``where`` (on zone and window)
    reaches the scan."""
    return M.zone_metrics_of(MD.read(spark, path, M.zone_totals(), where, late, snapshots))


def late_repairs(spark: SparkSession, path: str) -> DataFrame:
    """Zone windows that late events changed after the watermark had passed them: the
    published and the repaired metrics side by side (published nulls: the window had none)."""
    t = M.zone_totals()
    log = spark.read.parquet(path)
    touched = log.where("late").select(*t.keys).distinct()
    repaired = M.zone_metrics_of(MD.totals(log.join(touched, list(t.keys), "left_semi"), t))
    published = M.zone_metrics_of(MD.totals(log.join(touched, list(t.keys), "left_semi"), t, late=False))
    values = [c for c in repaired.columns if c not in t.keys]
    return repaired.select(*t.keys, *(F.col(c).alias(f"repaired_{c}") for c in values)).join(
        published.select(*t.keys, *(F.col(c).alias(f"published_{c}") for c in values)), list(t.keys), "left")


def start_daily_earnings(events: DataFrame, sink_path: str, checkpoint: str, run_id: int | None = None,
                         trigger: dict | None = None, params=None, bounded: bool = False):
    """Running fare and distinct trips per (vehicle, day).

    Default: membership deltas, without streaming state; late events always merge, as in
    the original. Read them with :func:`earnings_at`. ``bounded=True``: update mode, grouped
    by a day-long event-time window behind a two-day watermark, so that finished days leave
    the state store; a changelog of whole rows (``changelog.resolve``).
    """
    if not bounded:
        return _start_totals(events, M.earnings_totals(), sink_path, checkpoint, run_id, trigger, "daily_earnings")
    run = _run(events, checkpoint, sink_path, run_id)
    ev = events.withWatermark("event_ts", f"{2 * params.day_seconds} seconds")
    ev = ev.withColumn("__day", F.window("event_ts", f"{params.day_seconds} seconds",
                                         startTime=f"{int(params.start_epoch) % params.day_seconds} seconds"))
    agg = ev.groupBy("vehicle_id", "sim_day", "__day").agg(
        F.sum("fare").alias("total_fare"),
        F.size(F.collect_set(M.valid_trip())).cast("long").alias("trip_count")).drop("__day")
    return _start(agg, CL.changelog_sink(sink_path, run), checkpoint, "update",
                  trigger or {"processingTime": "15 seconds"}, "daily_earnings")


def earnings_at(spark: SparkSession, path: str, where=None, snapshots: str | None = None) -> DataFrame:
    """Running earnings from the deltas at ``path``."""
    return MD.read(spark, path, M.earnings_totals(), where, snapshots=snapshots).select(
        "vehicle_id", "sim_day", "total_fare", "trip_count")


def start_vehicle_status(events: DataFrame, sink_path: str, checkpoint: str, run_id: int | None = None,
                         trigger: dict | None = None, ordered_within: str | None = None):
    """Latest status per vehicle in keyed state; ``ordered_within`` (a watermark delay)
    trades latency for exact event-time order: events are held until the watermark passes
    them (``held_events``), and what it releases is merged in order (``streaming.status_merge``)."""
    run = _run(events, checkpoint, sink_path, run_id)
    trigger = trigger or {"processingTime": "5 seconds"}
    if ordered_within is None:
        return _start(latest_status_stream(events), CL.changelog_sink(sink_path, run), checkpoint, "update", trigger, "vehicle_status")
    from drover.streaming.status_merge import status_merge_sink
    return _start(held_events(events, ordered_within), status_merge_sink(events.sparkSession, sink_path, run), checkpoint,
                  "append", trigger, "vehicle_status")


def start_vehicle_status_runs(events: DataFrame, params, sink_path: str, checkpoint: str, run_id: int | None = None,
                              trigger: dict | None = None, slice_seconds: int | None = None):
    """Latest status per vehicle, and idle time per day, from summaries of time slices: exact
    whatever the order of arrival, without Python workers or streaming state; see
    ``streaming.status_runs``."""
    from drover.streaming.status_runs import SLICE_SECONDS, status_runs_sink
    sink = status_runs_sink(params, sink_path, _run(events, checkpoint, sink_path, run_id), slice_seconds or SLICE_SECONDS)
    return _start(events, sink, checkpoint, "append", trigger or {"processingTime": "5 seconds"}, "vehicle_status")


def dedup_stream(events: DataFrame, params, spread: int | None = None) -> DataFrame:
    """Drop re-delivered events: same (vehicle_id, event_ts) within the watermark delay.

    Streaming deduplication has no map-side stage, so all copies of a key meet in one
    task. ``spread`` adds a first stage keyed by (key, seeded random salt): copies of a hot
    key are first thinned out over ``spread`` tasks, and the second stage sees at most
    ``spread`` survivors per key. The result is the same set of events.
    """
    keys = ["vehicle_id", "event_ts"]
    d = events.withWatermark("event_ts", params.watermark)
    if spread and spread > 1:
        d = (d.withColumn("__salt", (F.rand(17) * F.lit(int(spread))).cast("int"))
             .dropDuplicatesWithinWatermark([*keys, "__salt"]).drop("__salt"))
    return d.dropDuplicatesWithinWatermark(keys)


def start_vehicle_status_merge(events: DataFrame, sink_path: str, checkpoint: str, run_id: int | None = None,
                               trigger: dict | None = None, snapshots: str | None = None):
    """Latest status per vehicle kept by DataFrame aggregations merged into the status
    changelog in ``foreachBatch`` (no Python workers); see ``streaming.status_merge``."""
    from drover.streaming.status_merge import status_merge_sink
    sink = status_merge_sink(events.sparkSession, sink_path, _run(events, checkpoint, sink_path, run_id), snapshots)
    return _start(events, sink, checkpoint, "append", trigger or {"processingTime": "5 seconds"}, "vehicle_status")


def start_dedup(events: DataFrame, params, sink_path: str, checkpoint: str, run_id: int | None = None,
                trigger: dict | None = None, spread: int | None = None):
    """Deduplicated events appended to a day-partitioned log (see :func:`dedup_stream`)."""
    d = dedup_stream(events, params, spread)
    run = _run(events, checkpoint, sink_path, run_id)
    return _start(d, CL.changelog_sink(sink_path, run, partition_by=("sim_day",)), checkpoint,
                  "append", trigger or {"processingTime": "5 seconds"}, "dedup_events")


def start_history_dedup(events: DataFrame, sink_path: str, checkpoint: str, run_id: int | None = None,
                        trigger: dict | None = None):
    """Each record once in a day-partitioned log, however far apart its copies arrive; events
    that differ in any column stay (see ``streaming.history_dedup``)."""
    from drover.streaming.history_dedup import history_dedup_sink
    sink = history_dedup_sink(sink_path, _run(events, checkpoint, sink_path, run_id))
    return _start(events, sink, checkpoint, "append", trigger or {"processingTime": "5 seconds"}, "history_dedup")


def start_recent_rollups(events: DataFrame, sink_path: str, checkpoint: str, run_id: int | None = None,
                         trigger: dict | None = None):
    """Members per minute, for exact and sketched distincts of any recent range (see
    ``streaming.recent_rollups``)."""
    from drover.streaming.recent_rollups import rollup_sink
    sink = rollup_sink(sink_path, _run(events, checkpoint, sink_path, run_id))
    return _start(events, sink, checkpoint, "append", trigger or {"processingTime": "5 seconds"}, "recent_rollups")


def start_expense_loader(spark: SparkSession, landing_path: str, table_path: str, checkpoint: str,
                         trigger: dict | None = None, max_files_per_trigger: int | None = None,
                         on_duplicate: str = "raise"):
    """Load newly landed expense files into the day-partitioned expenses table.

    Rows are upserted by (vehicle_id, sim_day), and of several files that list a vehicle's
    day the newest wins (see ``operators.landing``), so the table depends neither on how a
    day is spread over files nor on which trigger picks a file up; a replayed batch or a
    file delivered again changes nothing. A vehicle listed twice for one day in one file
    fails the batch (``on_duplicate="raise"``) or keeps one row (``"keep_one"``).
    """
    from drover.operators.landing import merge_landed
    from drover.sources.expenses import stream_expense_feed

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        merge_landed(batch_df, table_path, on_duplicate)

    src = stream_expense_feed(spark, landing_path, max_files_per_trigger=max_files_per_trigger, with_file=True)
    return _start(src, sink, checkpoint, "append", trigger or {"processingTime": "60 seconds"}, "expense_loader")


def start_speed_layer(spark: SparkSession, wire: DataFrame, params, root: str, run_id: int | None = None,
                      triggers: dict | None = None, with_status: bool = True, status_mode: str = "runs",
                      checkpoints: dict | None = None) -> dict:
    """Start the speed layer from one broker stream: raw log (+ heartbeats), zone metrics,
    daily earnings, members of recent ranges and, optionally, latest status -- independent queries, each with its
    own checkpoint and changelog under ``root``. Returns the started queries by name.

    ``triggers`` maps a query name to its trigger (defaults: 5 s events and status, 15 s
    zones and earnings). ``status_mode``: "runs" (summaries of
    time slices, exact for any order of arrival), "keyed" (immediate keyed state), "ordered"
    (event-time order behind the watermark) or "merge" (per-batch merge). Each query
    writes under the commit epoch of its own checkpoint (``streaming.epochs``) unless
    ``run_id`` is given; ``checkpoints`` maps a query name to another checkpoint folder.
    """
    use_rocksdb(spark)
    kept = {n: f"{root}/checkpoints/{n}" for n in ("raw_log", "zone_metrics", "daily_earnings", "recent", "vehicle_status")}
    kept |= checkpoints or {}
    t = {"raw_log": {"processingTime": "5 seconds"}, "zone_metrics": {"processingTime": "15 seconds"},
         "daily_earnings": {"processingTime": "15 seconds"}, "recent": {"processingTime": "15 seconds"},
         "vehicle_status": {"processingTime": "5 seconds"}}
    t.update(triggers or {})
    events = event_stream(wire, params)
    qs = {
        "raw_log": start_raw_log(events, f"{root}/raw_log", kept["raw_log"], run_id,
                                 t["raw_log"], heartbeat_path=f"{root}/heartbeats"),
        "zone_metrics": start_zone_metrics(events, params, f"{root}/zone_metrics", kept["zone_metrics"],
                                           run_id, t["zone_metrics"]),
        "daily_earnings": start_daily_earnings(events, f"{root}/daily_earnings",
                                               kept["daily_earnings"], run_id, t["daily_earnings"]),
        "recent": start_recent_rollups(events, f"{root}/recent", kept["recent"], run_id, t["recent"]),
    }
    if with_status:
        sp, ck = f"{root}/vehicle_status", kept["vehicle_status"]
        if status_mode == "runs":
            qs["vehicle_status"] = start_vehicle_status_runs(events, params, sp, ck, run_id, t["vehicle_status"])
        elif status_mode == "merge":
            qs["vehicle_status"] = start_vehicle_status_merge(events, sp, ck, run_id, t["vehicle_status"],
                                                              snapshots=f"{root}/snapshots/vehicle_status")
        else:
            qs["vehicle_status"] = start_vehicle_status(
                events, sp, ck, run_id, t["vehicle_status"],
                ordered_within=params.watermark if status_mode == "ordered" else None)
    return qs


def run_to_end(query) -> None:
    """Wait for an ``availableNow`` query and surface its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def rebuild_earnings(spark: SparkSession, raw_log_path: str, days) -> DataFrame:
    """Daily earnings of ``days`` recomputed from the raw log (batch form). After a stream
    restarts without its checkpoint, its running totals start from zero; publish these
    instead for the days the new run touched."""
    from drover.sources.tables import scan_days
    return M.daily_earnings(scan_days(spark, raw_log_path, days))


def watermark_losses(stream_result: DataFrame, batch_result: DataFrame, keys: list[str],
                     measures: list[str]) -> DataFrame:
    """Where a streamed aggregate differs from the batch aggregate over the same events:
    keys missing from the stream or with different measures, i.e. what late events behind
    the watermark changed. One full outer join on the keys."""
    s = stream_result.select(*keys, *[F.col(m).alias(f"stream_{m}") for m in measures])
    b = batch_result.select(*keys, *[F.col(m).alias(f"batch_{m}") for m in measures])
    j = s.join(b, keys, "full")
    differs = None
    for m in measures:
        d = ~F.col(f"stream_{m}").eqNullSafe(F.col(f"batch_{m}"))
        differs = d if differs is None else differs | d
    return j.where(differs)
