"""Changelog sinks for ``foreachBatch``: upserts without a table format.

Each micro-batch writes its rows under ``run=R/batch_id=N`` with dynamic partition
overwrite, so a replayed batch rewrites the same folder (idempotent) and the writes stay
on the executors. ``run`` is the query's commit epoch (``streaming.epochs``): it grows with
every new checkpoint, because batch ids restart there. Readers resolve the newest row per key; ``compact`` folds the log into a snapshot.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.streaming.epochs import claimed, fence

def new_run_id() -> int:
    """A run number larger than any earlier one (milliseconds since the epoch)."""
    return int(time.time() * 1000)


def write_batch(df: DataFrame, path: str, run_id: int, batch_id: int, partition_by=()) -> None:
    (df.withColumn("run", F.lit(int(run_id))).withColumn("batch_id", F.lit(int(batch_id)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by, "run", "batch_id").parquet(path))


def changelog_sink(path: str, run_id: int, partition_by=()):
    """A ``foreachBatch`` function appending each batch to the changelog at ``path``."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        fence(batch_df.sparkSession, path, run_id)
        write_batch(batch_df, path, run_id, batch_id, partition_by)
    return sink


def after(run: int, batch_id: int):
    """Rows of later batches than (run, batch_id); prunes partitions."""
    return (F.col("run") > F.lit(int(run))) | ((F.col("run") == F.lit(int(run))) & (F.col("batch_id") > F.lit(int(batch_id))))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def resolve(spark: SparkSession, path: str, keys: list[str], where=None) -> DataFrame:
    """Newest version of every key: greatest (run, batch_id). An aggregate, so it combines
    map-side and a busy key costs one row per task. ``where`` (a Column on the logged
    columns) is applied before resolving, so it reaches the Parquet reader; it must only
    depend on the key (e.g. a window start), or older versions could win."""
    log = read_log(spark, path)
    if where is not None:
        log = log.where(where)
    vals = [c for c in log.columns if c not in keys and c not in ("run", "batch_id")]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.struct("run", "batch_id")).alias("v"))
    return latest.select(*keys, *[F.col(f"v.{c}").alias(c) for c in vals])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def latest_snapshot(spark: SparkSession, snapshot_root: str,
                    before: tuple[int, int] | None = None) -> tuple[str, int, int] | None:
    """(path, run, batch_id) of the newest complete snapshot (one with ``_SUCCESS``);
    ``before``: that holds only batches before this (run, batch_id)."""
    jvm, root, fs = _fs(spark, snapshot_root)
    if not fs.exists(root):
        return None
    best = None
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith("upto-")):
            continue
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            continue  # still being written, or failed
        run, batch = (int(v) for v in name[len("upto-"):].split("-"))
        if before is not None and (run, batch) >= before:
            continue
        if best is None or (run, batch) > best[1:]:
            best = (f"{snapshot_root.rstrip('/')}/{name}", run, batch)
    return best


def compact(spark: SparkSession, path: str, keys: list[str], snapshot_root: str) -> str | None:
    """Fold the changelog into a snapshot of the newest row per key, published under
    ``snapshot_root/upto-<run>-<batch_id>`` (the log's high-water mark). Readers use the
    newest complete snapshot plus later log batches (:func:`resolve_compacted`), so the
    batches folded in can be archived. Returns the snapshot path (None for an empty log)."""
    log = read_log(spark, path)
    hw = log.agg(F.max(F.struct("run", "batch_id")).alias("hw")).first().hw  # one row
    if hw is None:
        return None
    bounded = log.where(F.struct("run", "batch_id") <= F.struct(F.lit(hw.run), F.lit(hw.batch_id)))
    out = f"{snapshot_root.rstrip('/')}/upto-{hw.run}-{hw.batch_id}"
    prev = latest_snapshot(spark, snapshot_root)
    if prev is not None:
        bounded = spark.read.parquet(prev[0]).unionByName(
            bounded.where(F.struct("run", "batch_id") > F.struct(F.lit(prev[1]), F.lit(prev[2]))))
    _newest(bounded, keys, keep_version=True).write.mode("overwrite").parquet(out)
    return out


def _newest(log: DataFrame, keys: list[str], keep_version: bool = False) -> DataFrame:
    vals = [c for c in log.columns if c not in keys and c not in ("run", "batch_id")]
    order = F.struct("run", "batch_id")
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*vals, "run", "batch_id"), order).alias("v"))
    cols = vals + (["run", "batch_id"] if keep_version else [])
    return latest.select(*keys, *[F.col(f"v.{c}").alias(c) for c in cols])


def resolve_compacted(spark: SparkSession, path: str, keys: list[str], snapshot_root: str,
                      where=None, before: tuple[int, int] | None = None) -> DataFrame:
    """Same result as :func:`resolve`, reading the newest snapshot and only the log batches
    after its high-water mark (pruned on the ``run`` / ``batch_id`` partition columns).
    ``where`` as in :func:`resolve`. ``before``: the state before that (run, batch_id), from
    the newest snapshot that holds no later batch; a replayed batch needs it, because a
    newer snapshot keeps only what the batch itself once wrote."""
    snap = latest_snapshot(spark, snapshot_root, before)
    log = read_log(spark, path)
    if before is not None:
        log = log.where(F.struct("run", "batch_id") < F.struct(*(F.lit(int(v)) for v in before)))
    if snap is not None:
        log = spark.read.parquet(snap[0]).unionByName(log.where(after(snap[1], snap[2])))
    return _newest(log if where is None else log.where(where), keys)


def read_raw_log(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an append-only event log, each message once although epochs overlap.

    After a lost checkpoint the new epoch reads messages again that an older epoch has
    logged. In days that several epochs wrote, equal rows are one message, and the number
    of copies that the newest epoch with that message logged counts. Days of one epoch are
    read as they are.
    """
    log = read_log(spark, path)
    if len(claimed(spark, path)) < 2:
        return log.drop("run", "batch_id")
    several = [r[0] for r in log.groupBy("sim_day").agg(F.count_distinct("run").alias("n")).where("n > 1").collect()]  # days
    shared = F.col("sim_day").isin(several)
    cols = [c for c in log.columns if c not in ("run", "batch_id")]
    copies = log.where(shared).groupBy(*cols, "run").agg(F.count(F.lit(1)).alias("copies"))
    newest = copies.groupBy(*cols).agg(F.max_by("copies", "run").alias("copies"))
    again = newest.select(*cols, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
    return log.where(~shared).select(*cols).unionByName(again)


def record_heartbeat(spark: SparkSession, path: str, component: str, last_event_at=None,
                     status: str = "healthy") -> None:
    """Append one heartbeat row for a batch component (reconciliation, alert evaluation)."""
    run = new_run_id()
    row = spark.createDataFrame(
        [(component, last_event_at, 0, status)],
        "component string, last_event_at timestamp, rows long, status string")
    write_batch(row.withColumn("updated_at", F.current_timestamp()), path, run, 0, partition_by=("component",))


def component_health(spark: SparkSession, path: str) -> DataFrame:
    """Per component: status and time of its latest heartbeat, and the newest event it reported."""
    beats = read_log(spark, path)
    if "updated_at" not in beats.columns:       # heartbeats from before their time was kept
        beats = beats.withColumn("updated_at", F.lit(None).cast("timestamp"))
    return beats.groupBy("component").agg(
        F.max_by("status", F.struct("run", "batch_id")).alias("status"),
        F.max("last_event_at").alias("last_event_at"), F.max("updated_at").alias("updated_at"))
