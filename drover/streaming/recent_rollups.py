"""Sliding distincts from mergeable rollups and sketches.

"Distinct trips of the last hour" over a sliding range is a union, not a sum, so it needs
summaries that merge. Two are kept, both idempotent (merging a summary with itself changes
nothing, so messages delivered or read twice do not count twice):

* members: per (unit of time, kind, member) the member's newest event in the unit, where a
  member is a vehicle or a trip and a unit a minute, an hour or a day. Exact.
* theta sketches of the members per (unit, kind): a few KB each, whatever the traffic, with
  a relative standard error of ``1 / sqrt(2 ** LG_ENTRIES)`` (exact up to that many members).

A micro-batch appends the members of its minutes and nothing else. ``fold`` takes the
batches since the last fold and writes their members and sketches for all three units as
one more generation, so a late event lands in the next generation of its own units. A
reader merges the generations with the batches after the last one.

A range is cut into whole days, hours at its ends, minutes at theirs (at most two spans a
unit), and two pieces shorter than a minute, which come from the event log by a time filter
that reaches the scan. So a range of any length reads some hundred units, not its events.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from drover.functions import epoch_us, ts_from_us
from drover.operators.metrics import valid_trip
from drover.session import path_exists
from drover.streaming import changelog as CL
from drover.streaming.epochs import fence

#: Units in seconds, finest first; each divides the next.
UNITS = (60, 3600, 86400)
#: Sketches keep 2 ** LG_ENTRIES members, so their relative standard error is 1/64.
LG_ENTRIES = 12
VEHICLE, TRIP = 0, 1
_DAY_US = 86400 * 1_000_000
_KEY = ["unit", "kind", "member"]


def _number(us: Column, unit: int) -> Column:
    return F.floor(us / F.lit(unit * 1_000_000)).cast("long")


def members(events: DataFrame, *keep) -> DataFrame:
    """(keep, kind, member, last): the members of each event; ``last`` orders events by
    (event_ts, event_id). The no-trip sentinel and nulls are no members."""
    last = F.struct("event_ts", F.col("event_id").cast("long").alias("event_id"), "status")
    each = [F.struct(F.lit(k).alias("kind"), m.cast("string").alias("member"))
            for k, m in ((VEHICLE, F.col("vehicle_id")), (TRIP, valid_trip()))]
    return events.select(*keep, last.alias("last"), F.inline(F.filter(F.array(*each), lambda s: s["member"].isNotNull())))


def by_minute(events: DataFrame) -> DataFrame:
    """(unit, kind, member, last) of every minute; combined map-side."""
    m = members(events, _number(epoch_us("event_ts"), UNITS[0]).alias("unit"))
    return m.groupBy(*_KEY).agg(F.max("last").alias("last"))


def apply_batch(events: DataFrame, path: str, run: int, batch_id: int) -> None:
    """Append the members of one micro-batch, partitioned by calendar day."""
    fence(events.sparkSession, path, run)
    rows = by_minute(events).withColumn("day", F.floor(F.col("unit") * UNITS[0] / F.lit(86400)).cast("int"))
    CL.write_batch(rows, path, run, batch_id, ("day",))


def rollup_sink(path: str, run: int):
    """A ``foreachBatch`` function that keeps the members at ``path``."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        apply_batch(batch_df, path, run, batch_id)
    return sink


# ------------------------------------------------------------------ generations
def _folds(path: str, what: str) -> str:
    return f"{path.rstrip('/')}.folds/{what}"


def _generations(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(run, batch) up to which each complete generation goes, oldest first; a listing."""
    jvm, root, fs = CL._fs(spark, _folds(path, "sketches"))
    if not fs.exists(root):
        return []
    folders = [st.getPath() for st in fs.listStatus(root) if st.getPath().getName().startswith("generation=g")]
    return sorted(tuple(int(v) for v in f.getName()[len("generation=g"):].split("-"))
                  for f in folders if fs.exists(jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS")))


def _read_folds(spark: SparkSession, path: str, what: str, gens: list[tuple[int, int]]) -> DataFrame:
    root = _folds(path, what)
    return spark.read.option("basePath", root).parquet(*(f"{root}/generation=g{r}-{b}" for r, b in gens))


def _tail(spark: SparkSession, path: str, gens: list[tuple[int, int]]) -> DataFrame:
    """Members of the batches after the newest generation."""
    log = CL.read_log(spark, path)
    return log.where(CL.after(*gens[-1])) if gens else log


def fold(spark: SparkSession, path: str) -> str | None:
    """Write the batches since the last fold as one more generation of members and sketches
    per minute, hour and day; returns the folder of its sketches (None: there were none). They
    are written last and make it valid; the folded batches can then be archived."""
    gens = _generations(spark, path)
    rest = _tail(spark, path, gens)
    hw = rest.agg(F.max(F.struct("run", "batch_id")).alias("hw")).first().hw
    if hw is None:
        return None
    own, out = (f"{_folds(path, what)}/generation=g{hw.run}-{hw.batch_id}" for what in ("members", "sketches"))
    minutes = rest.where(~CL.after(hw.run, hw.batch_id)).groupBy(*_KEY).agg(F.max("last").alias("last"))
    level = F.explode(F.array(*(F.struct(F.lit(u).alias("level"), F.floor(F.col("unit") * UNITS[0] / F.lit(u)).cast("long").alias("of"))
                                for u in UNITS)))
    m = minutes.select(level.alias("l"), "kind", "member", "last").groupBy("l.level", F.col("l.of").alias("unit"), "kind", "member").agg(
        F.max("last").alias("last"))
    m = m.withColumn("day", F.floor(F.col("unit") * F.col("level") / F.lit(86400)).cast("int"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = {"partitionOverwriteMode": "static"}    # a generation is replaced as a whole, and marked by _SUCCESS
    m.repartitionByRange(n, "level", "unit", "member").write.mode("overwrite").options(**whole).partitionBy("level", "day").parquet(own)
    s = spark.read.schema(m.schema).parquet(own).groupBy("level", "unit", "day", "kind").agg(
        F.theta_sketch_agg("member", LG_ENTRIES).alias("sketch"))
    s.repartitionByRange(n, "level", "unit").write.mode("overwrite").options(**whole).partitionBy("level", "day").parquet(out)
    return out


# ------------------------------------------------------------------ ranges
def cut(since_us: int, until_us: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """The instants after ``since_us`` up to ``until_us`` as whole units [(unit length, first,
    end)] and pieces shorter than a minute [(from, before)] in microseconds."""
    lo, hi = since_us + 1, until_us + 1
    if hi <= lo:
        return [], []
    whole, edges = [], []

    def span(a: int, b: int, level: int) -> None:
        if a >= b:
            return
        if level < 0:
            edges.append((a, b))
            return
        w = UNITS[level] * 1_000_000
        first, end = -(-a // w), b // w
        if first >= end:
            span(a, b, level - 1)
            return
        whole.append((UNITS[level], first, end))
        span(a, first * w, level - 1)
        span(end * w, b, level - 1)
    span(lo, hi, len(UNITS) - 1)
    return whole, edges


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def _tagged(df: DataFrame, conds: list[Column]) -> DataFrame:
    """The rows that lie in some range, once per range (column ``range``), from one scan."""
    hits = F.filter(F.array(*(F.when(c, F.lit(i)) for i, c in enumerate(conds))), lambda i: i.isNotNull())
    return df.where(_any(conds)).withColumn("range", F.explode(hits))


def _of_units(ranges: list) -> list[Column]:
    return [_any([(F.col("level") == u) & F.col("day").between(a * u // 86400, (b * u - 1) // 86400) & F.col("unit").between(a, b - 1)
                  for u, a, b in cut(*r)[0]]) for r in ranges]


def _of_minutes(ranges: list) -> list[Column]:
    """The same ranges over rows of minutes: all whole units as spans of minutes."""
    return [_any([F.col("day").between(a * u // 86400, (b * u - 1) // 86400) & F.col("unit").between(a * u // 60, b * u // 60 - 1)
                  for u, a, b in cut(*r)[0]]) for r in ranges]


def _of_events(events: DataFrame, params, ranges: list) -> list[Column]:
    """The pieces shorter than a minute over events, with the days they imply."""
    def piece(a: int, b: int) -> Column:
        at = (F.col("event_ts") >= ts_from_us(F.lit(a))) & (F.col("event_ts") < ts_from_us(F.lit(b)))
        days = F.col("sim_day").between(params.day_at(a / 1e6), params.day_at((b - 1) / 1e6))
        return at & days if "sim_day" in events.columns else at
    return [_any([piece(a, b) for a, b in cut(*r)[1]]) for r in ranges]


def ranges_before(params, seconds) -> list[tuple[int, int]]:
    """The last so many seconds before ``as_of``, for each of ``seconds``."""
    return [(params.as_of_us - int(s) * 1_000_000, params.as_of_us) for s in seconds]


def members_in(spark: SparkSession, path: str, events: DataFrame, params, ranges: list[tuple[int, int]]) -> DataFrame:
    """(range, kind, member, last): the members of each range (since, until] in microseconds
    (number of the range in the list), each once. ``events`` is the event log."""
    parts = [members(_tagged(events, _of_events(events, params, ranges)), "range")]
    if path_exists(spark, path):
        gens = _generations(spark, path)
        parts.append(_tagged(_tail(spark, path, gens), _of_minutes(ranges)))
        if gens:
            parts.append(_tagged(_read_folds(spark, path, "members", gens), _of_units(ranges)))
    rows = reduce(lambda a, b: a.unionByName(b), (p.select("range", "kind", "member", "last") for p in parts))
    return rows.groupBy("range", "kind", "member").agg(F.max("last").alias("last"))


def counts(found: DataFrame) -> DataFrame:
    """(range, active_vehicles, idle_n, trips) of ``members_in``; ranges without members have
    no row. A vehicle is idle if its newest event in the range is."""
    is_vehicle = F.col("kind") == VEHICLE
    return found.groupBy("range").agg(
        F.count(F.when(is_vehicle, True)).alias("active_vehicles"),
        F.count(F.when(is_vehicle & (F.col("last.status") == "idle"), True)).alias("idle_n"),
        F.count(F.when(F.col("kind") == TRIP, True)).alias("trips"))


def estimates(spark: SparkSession, path: str, events: DataFrame, params, ranges: list[tuple[int, int]]) -> DataFrame:
    """(range, kind, estimate, error): distinct members of each range by merged sketches, and
    three standard errors of the estimate (0 where the sketch holds every member)."""
    fresh = members(_tagged(events, _of_events(events, params, ranges)), "range").select("range", "kind", "member")
    sketches = []
    if path_exists(spark, path):
        gens = _generations(spark, path)
        fresh = fresh.unionByName(_tagged(_tail(spark, path, gens), _of_minutes(ranges)).select("range", "kind", "member"))
        if gens:
            folds = _read_folds(spark, path, "sketches", gens)
            sketches.append(_tagged(folds, _of_units(ranges)).select("range", "kind", "sketch"))
    sketches.append(fresh.groupBy("range", "kind").agg(F.theta_sketch_agg("member", LG_ENTRIES).alias("sketch")))
    rows = reduce(lambda a, b: a.unionByName(b), sketches)
    est = rows.groupBy("range", "kind").agg(F.theta_sketch_estimate(F.theta_union_agg("sketch", LG_ENTRIES)).alias("estimate"))
    error = F.when(F.col("estimate") < 2 ** LG_ENTRIES, 0.0).otherwise(3.0 * F.col("estimate") / 2 ** (LG_ENTRIES / 2))
    return est.withColumn("error", error)


def summary(spark: SparkSession, path: str, events: DataFrame, params) -> DataFrame:
    """``serving.realtime_summary`` from the rollups: one row, zeros when nothing is recent."""
    ranges = ranges_before(params, (params.status_recency_s, params.trip_recency_s))
    c = counts(members_in(spark, path, events, params, ranges)).agg(
        *(F.coalesce(F.max(F.when(F.col("range") == i, F.col(n))), F.lit(0)).alias(n)
          for i, n in ((0, "active_vehicles"), (0, "idle_n"), (1, "trips"))))
    ratio = F.coalesce(F.try_divide(F.col("idle_n"), F.col("active_vehicles")), F.lit(0.0))
    return c.select(F.lit(params.current_day).alias("sim_day"), "active_vehicles", F.bround(ratio, 3).alias("idle_ratio"),
                    F.col("trips").alias("trips_recent"))
