"""Fleet income per day, kept up by delta joins.

The trend is an aggregation over earnings LEFT JOIN report on (vehicle, day). When rows of
either side change, only their share of the join changes: with dE and dR as signed rows (an
old version counts -1, a new one +1) the earnings and trips of a day change by the sum of dE,
and its net profit by

    dE join R(new)  +  E(old) join dR

Both joins read the days that the change touches and no others. A commit appends its new row
versions (partitioned by day) and one delta row per touched day; the trend is the sum of the
deltas by day, whatever the history of the fleet. Amounts are added as decimals of nine
places, so that the sum of the changes is exactly the sum of a full recompute.

Commits are numbered. The deltas are written last and make a commit valid; a commit that is
valid is not applied again, one that broke off is overwritten by its next attempt. Commits
run one at a time. ``sim_day`` is never null; a null vehicle is a key like any other, but
joins no report row. Of rows that share a key in one commit the greatest counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from drover.streaming import changelog as CL

KEY = ["vehicle_id", "sim_day"]
AMOUNT = "decimal(28,9)"
SIDES = {"earnings": f"vehicle_id string, total_fare {AMOUNT}, trip_count long, removed boolean, commit long, sim_day int",
         "report": f"vehicle_id string, net_profit {AMOUNT}, removed boolean, commit long, sim_day int"}
VALUES = {"earnings": ["total_fare", "trip_count"], "report": ["net_profit"]}
DELTA = "sim_day int, vehicles long, total_fare decimal(38,9), trip_count long, net_profit decimal(38,9), reconciled long"


def commits(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the valid commits in order; a listing, no data is read."""
    jvm, root, fs = CL._fs(spark, f"{store}/deltas")
    if not fs.exists(root):
        return []
    folders = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("commit=")]
    return sorted(int(f.getName().split("=")[1]) for f in folders if fs.exists(jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS")))


def _versions(spark: SparkSession, store: str, side: str, numbers: list[int]) -> DataFrame:
    root = f"{store}/{side}"
    jvm, _, fs = CL._fs(spark, root)
    paths = [p for p in (f"{root}/commit={n}" for n in numbers) if fs.exists(jvm.org.apache.hadoop.fs.Path(p))]
    if not paths:
        return spark.createDataFrame([], SIDES[side])
    return spark.read.schema(SIDES[side]).option("basePath", root).parquet(*paths)


def state(spark: SparkSession, store: str, side: str, numbers: list[int], days: list[int] | None = None) -> DataFrame:
    """(key, values) of one side after the given commits, of the given days: the newest
    version of each key, unless it was removed. ``max_by`` combines map-side."""
    v = _versions(spark, store, side, numbers)
    if days is not None:
        v = v.where(F.col("sim_day").isin(days))
    newest = v.groupBy(*KEY).agg(F.max_by(F.struct(*VALUES[side], "removed"), "commit").alias("v"))
    return newest.where(~F.col("v.removed")).select(*KEY, *(F.col(f"v.{c}").alias(c) for c in VALUES[side]))


def _same_key(a: str, b: str) -> Column:
    return F.col(f"{a}.vehicle_id").eqNullSafe(F.col(f"{b}.vehicle_id")) & (F.col(f"{a}.sim_day") == F.col(f"{b}.sim_day"))


def _record(spark: SparkSession, store: str, side: str, number: int, rows: DataFrame | None, whole_days, done: list[int]) -> list[int]:
    """Write the new versions of one side; returns the days they touch."""
    if rows is None:
        return []
    names = VALUES[side]
    types = {"total_fare": AMOUNT, "net_profit": AMOUNT, "trip_count": "long"}
    removed = F.coalesce(F.col("removed"), F.lit(False)) if "removed" in rows.columns else F.lit(False)
    new = rows.select("vehicle_id", F.col("sim_day").cast("int").alias("sim_day"), *(F.col(c).cast(types[c]).alias(c) for c in names),
                      removed.alias("removed"))
    new = new.groupBy(*KEY).agg(F.max(F.struct(*names, "removed")).alias("v")).select(*KEY, "v.*")
    if whole_days is not None:
        old = state(spark, store, side, done, whole_days)
        gone = old.alias("o").join(new.alias("n"), _same_key("o", "n"), "left_anti")
        new = new.where(F.col("sim_day").isin(whole_days)).unionByName(gone.withColumn("removed", F.lit(True)))
    out = f"{store}/{side}/commit={number}"
    (new.repartitionByRange(*KEY).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("sim_day").parquet(out))
    return [r[0] for r in _versions(spark, store, side, [number]).select("sim_day").distinct().collect()]   # one per touched day


def signed(old: DataFrame, new: DataFrame, names: list[str]) -> DataFrame:
    """(key, values, sign) of what changes when the versions ``new`` (with ``removed``) meet
    the rows ``old``: -1 for an old row that goes, +1 for a new one; equal rows cancel."""
    j = new.alias("n").join(old.withColumn("__there", F.lit(True)).alias("o"), _same_key("n", "o"), "left")
    there, stays = F.coalesce(F.col("o.__there"), F.lit(False)), ~F.col("n.removed")
    same = there & stays
    for c in names:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    both = F.array(*(F.struct(F.lit(s).alias("sign"), c.alias("counts"), *(F.col(f"{t}.{v}").alias(v) for v in names))
                     for t, s, c in (("o", -1, there), ("n", 1, stays))))
    return j.where(~same).select("n.vehicle_id", "n.sim_day", F.inline(F.filter(both, lambda s: s["counts"]))).drop("counts")


def _sum(c: str, sign: str = "sign") -> Column:
    return F.sum(F.when(F.col(sign) < 0, -F.col(c)).otherwise(F.col(c)))


def day_deltas(de: DataFrame, dr: DataFrame, e_old: DataFrame, r_new: DataFrame) -> DataFrame:
    """Change of each day's totals from signed rows of both sides, earnings before the change
    and report rows after it (the touched days are enough)."""
    own = de.groupBy("sim_day").agg(F.sum("sign").cast("long").alias("vehicles"), _sum("total_fare").alias("total_fare"),
                                    F.sum(F.col("sign") * F.col("trip_count")).cast("long").alias("trip_count"))
    pairs = (de.select(*KEY, "sign").join(r_new, KEY)
             .unionByName(e_old.select(*KEY).join(dr, KEY).select(*KEY, "sign", "net_profit")))
    joined = pairs.groupBy("sim_day").agg(_sum("net_profit").alias("net_profit"), F.sum("sign").cast("long").alias("reconciled"))
    rows = own.unionByName(joined, allowMissingColumns=True)
    return rows.groupBy("sim_day").agg(*(F.coalesce(F.sum(c), F.lit(0)).cast(t).alias(c) for c, t in (
        ("vehicles", "long"), ("total_fare", "decimal(38,9)"), ("trip_count", "long"), ("net_profit", "decimal(38,9)"),
        ("reconciled", "long"))))


def apply(spark: SparkSession, store: str, number: int, earnings: DataFrame | None = None, report: DataFrame | None = None,
          whole_days: list[int] | None = None) -> bool:
    """Apply new versions of earnings and report rows as commit ``number`` (a boolean column
    ``removed`` takes a key away). ``whole_days``: the rows are everything these days have,
    so stored keys that are not among them go. False if the commit was applied before."""
    store, done = store.rstrip("/"), commits(spark, store.rstrip("/"))
    if number in done:
        return False
    if done and number < done[-1]:
        raise ValueError(f"commit {number} comes after commit {done[-1]}")
    e_days = _record(spark, store, "earnings", number, earnings, whole_days, done)
    r_days = _record(spark, store, "report", number, report, whole_days, done)
    mine = [*done, number]
    new = {s: _versions(spark, store, s, [number] if d else []) for s, d in (("earnings", e_days), ("report", r_days))}
    de = signed(state(spark, store, "earnings", done, e_days), new["earnings"], VALUES["earnings"])
    dr = signed(state(spark, store, "report", done, r_days), new["report"], VALUES["report"])
    with_report = mine if r_days else done
    deltas = day_deltas(de, dr, state(spark, store, "earnings", done, r_days), state(spark, store, "report", with_report, e_days))
    deltas.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{store}/deltas/commit={number}")
    return True


def trend(spark: SparkSession, store: str) -> DataFrame:
    """``serving.income_trend_fleet`` of all days, from the deltas alone."""
    store = store.rstrip("/")
    numbers = commits(spark, store)
    log = (spark.read.schema(DELTA).parquet(*(f"{store}/deltas/commit={n}" for n in numbers)) if numbers
           else spark.createDataFrame([], DELTA))
    g = log.groupBy("sim_day").agg(*(F.sum(c).alias(c) for c in ("vehicles", "total_fare", "trip_count", "net_profit", "reconciled")))
    net = F.when(F.col("reconciled") > 0, F.col("net_profit").cast("double"))
    return g.where(F.col("vehicles") > 0).select(
        "sim_day", F.col("total_fare").cast("double").alias("total_fare"), "trip_count", net.alias("net_profit"),
        (net > 0).alias("profitable")).orderBy("sim_day")
