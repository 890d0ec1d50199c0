"""Exact distinct counts and sums of a stream, kept as additive deltas in tables.

A micro-batch is reduced to its members (key, kind, member). Those that an earlier batch of
the epoch has not seen yet, found by an anti-join with the member table, are first
sightings: each counts +1, once and for ever. The counts of first sightings and the batch's
sums per key are one delta row, appended under the batch's (run, batch_id); a key's value
is the sum of its deltas. So

* no set of members is ever held for a key, in state or in a row: a key with most of the
  rows costs its members, spread over the tasks by member;
* there is no streaming state to evict, and rows of any lateness still count;
* a replayed batch sees the same earlier batches and writes the same rows again.

Rows behind the watermark (the newest event of earlier batches minus a delay) are split off
by key: a key whose time range had ended is ``late`` in that batch, and its delta is
marked. Sums without the marked rows are what a watermarked aggregation publishes; sums
with them are the repaired values.

Layout beside the delta table ``path``: ``path.members`` (partitioned by the partition
column, run and batch) and ``path.marks`` (newest event per batch).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from drover.session import path_exists
from drover.streaming import changelog as CL
from drover.streaming import epochs as E


@dataclass(frozen=True)
class Totals:
    """What is counted. ``keys`` are columns of the keyed events, ``partition`` one of them
    (the day); ``members`` maps a count to the member expression (null: none); ``sums`` maps
    a sum to its aggregate over a batch; ``ends``: the end of a key's time range."""

    keys: tuple[str, ...]
    partition: str
    members: dict[str, Column]
    sums: dict[str, Column]
    ends: Column | None = field(default=None)

    @property
    def columns(self) -> list[str]:
        return [*self.members, *self.sums]


def sightings(keyed: DataFrame, t: Totals) -> DataFrame:
    """(keys, kind, member): every member of the batch once; ``kind`` numbers the counts."""
    each = [F.struct(F.lit(i).alias("kind"), m.cast("string").alias("member")) for i, m in enumerate(t.members.values())]
    return keyed.select(*t.keys, F.inline(F.filter(F.array(*each), lambda s: s["member"].isNotNull()))).distinct()


def _dealt(df: DataFrame, t: Totals, days: list, by) -> DataFrame:
    """Rows dealt so that a day goes to few files and a batch of few days to many tasks (a
    stream's batches run without adaptive execution)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.col(t.partition), F.pmod(F.xxhash64(*by), F.lit(max(1, 4 * n // len(days)))))


def _earlier(df: DataFrame, run: int, batch_id: int) -> DataFrame:
    return df.where((F.col("run") == F.lit(run)) & (F.col("batch_id") < F.lit(batch_id)))


def _watermark(spark: SparkSession, path: str, run: int, batch_id: int, delay: str):
    """Newest event of earlier batches minus ``delay`` as epoch microseconds (None: none yet)."""
    if not path_exists(spark, path):
        return None
    newest = _earlier(spark.read.parquet(path), run, batch_id).agg(F.max("event_ts").alias("t"))
    return newest.select(F.unix_micros(F.col("t") - F.expr(f"interval {delay}"))).first()[0]


def apply_batch(keyed: DataFrame, t: Totals, path: str, run: int, batch_id: int, delay: str | None = None) -> None:
    """Add one micro-batch of keyed events (columns: keys, what members and sums read, and
    ``event_ts``) to the deltas at ``path``."""
    spark = keyed.sparkSession
    E.fence(spark, path, run)
    keyed = keyed.persist()
    try:
        days = [r[0] for r in keyed.select(t.partition).distinct().collect()]    # one per day in the batch
        if not days:
            return
        first = sightings(keyed, t)
        members = path.rstrip("/") + ".members"
        if path_exists(spark, members):
            known = _earlier(spark.read.parquet(members).where(F.col(t.partition).isin(days)), run, batch_id)
            first = first.join(known, [*t.keys, "kind", "member"], "left_anti")
        CL.write_batch(_dealt(first, t, days, ["member"]), members, run, batch_id, (t.partition,))
        mine = (F.col("run") == F.lit(run)) & (F.col("batch_id") == F.lit(batch_id)) & F.col(t.partition).isin(days)
        new = spark.read.schema(first.schema.add("run", "long").add("batch_id", "long")).parquet(members).where(mine)
        counts = new.groupBy(*t.keys).agg(
            *(F.count(F.when(F.col("kind") == i, True)).alias(n) for i, n in enumerate(t.members)))
        sums = keyed.groupBy(*t.keys).agg(*(s.alias(n) for n, s in t.sums.items()))
        late = F.lit(False)
        if delay is not None and t.ends is not None:
            marks = path.rstrip("/") + ".marks"
            mark = _watermark(spark, marks, run, batch_id, delay)
            if mark is not None:
                late = F.unix_micros(t.ends) <= F.lit(mark)
            CL.write_batch(keyed.agg(F.max("event_ts").alias("event_ts")), marks, run, batch_id)
        delta = sums.join(counts, list(t.keys), "left").select(
            *t.keys, *(F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in t.members), *t.sums, late.alias("late"))
        CL.write_batch(_dealt(delta, t, days, t.keys), path, run, batch_id, (t.partition,))
    finally:
        keyed.unpersist()


def totals(log: DataFrame, t: Totals, late: bool = True) -> DataFrame:
    """Values per key from delta rows: the sums of the newest epoch that has the key.
    ``late=False`` leaves the rows behind the watermark out, and keys that only they have."""
    if not late:
        log = log.where(~F.col("late"))
    per_run = log.groupBy(*t.keys, "run").agg(*(F.sum(c).alias(c) for c in t.columns))
    newest = per_run.groupBy(*t.keys).agg(F.max_by(F.struct(*t.columns), "run").alias("v"))
    return newest.select(*t.keys, *(F.col(f"v.{c}").alias(c) for c in t.columns))


def read(spark: SparkSession, path: str, t: Totals, where: Column | None = None, late: bool = True,
         snapshots: str | None = None) -> DataFrame:
    """Values per key; ``where`` (on key columns) reaches the scan. With ``snapshots``, the
    newest snapshot and the deltas after it."""
    log = spark.read.parquet(path)
    snap = CL.latest_snapshot(spark, snapshots) if snapshots else None
    if snap is not None:
        _, run, batch = snap
        log = spark.read.parquet(snap[0]).unionByName(log.where(CL.after(run, batch)), allowMissingColumns=True)
    return totals(log if where is None else log.where(where), t, late)


def compact(spark: SparkSession, path: str, t: Totals, snapshots: str) -> str | None:
    """Fold the deltas into a snapshot: one row per key, epoch and lateness. Deltas up to its
    high-water mark can then be archived."""
    log = spark.read.parquet(path)
    hw = log.agg(F.max(F.struct("run", "batch_id")).alias("hw")).first().hw
    if hw is None:
        return None
    old = CL.latest_snapshot(spark, snapshots)
    rows = log.where(~CL.after(hw.run, hw.batch_id))
    if old is not None:
        rows = spark.read.parquet(old[0]).unionByName(rows.where(CL.after(old[1], old[2])), allowMissingColumns=True)
    out = f"{snapshots.rstrip('/')}/upto-{hw.run}-{hw.batch_id}"
    rows.groupBy(*t.keys, "late", "run").agg(*(F.sum(c).alias(c) for c in t.columns)).write.mode("overwrite").parquet(out)
    return out
