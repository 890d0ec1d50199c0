"""Landing files: discovery of days, typed read, duplicates, failure on bad numbers."""

import pytest
from pyspark.sql import functions as F

from drover.sources.expenses import duplicate_keys, landed_days, read_expense_feed, write_landing
from drover.sources.tables import scan_days


def test_reference_style_file_names(spark, tmp_path):
    d = tmp_path / "landing"
    d.mkdir()
    (d / "expenses_day4.csv").write_text(
        "vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\n"
        "V001,1.5,2.25,10.0,True\nV002,0.0,1.0,0.0,False\n")
    (d / "expenses_day5.csv").write_text(
        "vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\nV001,1.0,1.0,1.0, true \n")
    df = read_expense_feed(spark, str(d))
    rows = sorted((r.vehicle_id, r.sim_day, r.fuel_cost, r.service_flag) for r in df.collect())
    assert rows == [("V001", 4, 1.5, True), ("V001", 5, 1.0, True), ("V002", 4, 0.0, False)]
    assert sorted(r.sim_day for r in landed_days(spark, str(d)).collect()) == [4, 5]
    assert duplicate_keys(df).count() == 0
    assert duplicate_keys(df.unionByName(df.where("sim_day = 5"))).collect()[0].copies == 2


def test_unparsable_number_fails_the_load(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    (d / "expenses_day1.csv").write_text(
        "vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\nV001,abc,1.0,1.0,False\n")
    with pytest.raises(Exception):
        read_expense_feed(spark, str(d)).collect()
    assert read_expense_feed(spark, str(d), mode="PERMISSIVE").collect()[0].fuel_cost is None
    from drover.sources.expenses import expense_rejects
    rej = expense_rejects(spark, str(d)).collect()
    assert len(rej) == 1 and rej[0].sim_day == 1 and rej[0].line == "V001,abc,1.0,1.0,False"


def test_landing_round_trip_and_pruned_scan(spark, fixture_inputs, tmp_path):
    path = str(tmp_path / "land")
    write_landing(fixture_inputs.expenses, path)
    back = read_expense_feed(spark, path)
    assert back.count() == 430 and back.where("service_flag").count() == 410
    assert landed_days(spark, path).count() == 30
    t = str(tmp_path / "table")
    fixture_inputs.expenses.write.partitionBy("sim_day").parquet(t)
    day3 = scan_days(spark, t, 3)
    assert "PartitionFilters: [isnotnull(sim_day" in day3._jdf.queryExecution().executedPlan().toString() \
        or day3.where(F.col("sim_day") != 3).count() == 0
    assert day3.count() == fixture_inputs.expenses.where("sim_day = 3").count()


def _csv(path, rows):
    path.write_text("vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\n"
                    + "".join(",".join(map(str, r)) + "\n" for r in rows))


def test_loader_stream_correction_and_duplicates(spark, tmp_path):
    import os
    from drover.streaming import jobs as J
    land, table = tmp_path / "land", str(tmp_path / "table")
    land.mkdir()
    _csv(land / "expenses_day1.csv", [("V1", 1.0, 1.0, 1.0, "True"), ("V2", 2.0, 2.0, 2.0, "False")])
    _csv(land / "expenses_day2.csv", [("V1", 3.0, 3.0, 3.0, "False")])
    os.utime(land / "expenses_day1.csv", (1_000_000, 1_000_000))
    os.utime(land / "expenses_day2.csv", (1_000_010, 1_000_010))
    ck = str(tmp_path / "ck")
    J.run_to_end(J.start_expense_loader(spark, str(land), table, ck, {"availableNow": True}, max_files_per_trigger=1))
    assert spark.read.parquet(table).count() == 3
    # a corrected day-1 file lands later: V1 changed; V2, which it does not list, and day 2 stay
    (land / "fix").mkdir()
    _csv(land / "fix" / "expenses_day1.csv", [("V1", 9.0, 1.0, 1.0, "True")])
    J.run_to_end(J.start_expense_loader(spark, str(land), table, ck, {"availableNow": True}))
    got = sorted((r.vehicle_id, r.sim_day, r.fuel_cost) for r in spark.read.parquet(table).collect())
    assert got == [("V1", 1, 9.0), ("V1", 2, 3.0), ("V2", 1, 2.0)]
    # a file listing a vehicle twice fails its batch
    _csv(land / "expenses_day3.csv", [("V1", 1.0, 1.0, 1.0, "True"), ("V1", 1.0, 1.0, 1.0, "True")])
    with pytest.raises(Exception):
        J.run_to_end(J.start_expense_loader(spark, str(land), table, ck, {"availableNow": True}))


def _landed(spark, tmp_path, name, triggers):
    """The expenses table after files land in the given triggers: (folder, mtime, rows)."""
    import os
    from drover.streaming import jobs as J
    land, table = tmp_path / name, str(tmp_path / f"{name}-table")
    for files in triggers:
        for folder, mtime, rows in files:
            (land / folder).mkdir(parents=True, exist_ok=True)
            f = land / folder / "expenses_day1.csv"
            _csv(f, rows)
            os.utime(f, (mtime, mtime))
        J.run_to_end(J.start_expense_loader(spark, str(land), table, str(tmp_path / f"{name}-ck"), {"availableNow": True}))
    return sorted((r.vehicle_id, r.sim_day, r.fuel_cost) for r in spark.read.parquet(table).collect())


def test_newest_file_wins_in_any_triggers(spark, tmp_path):
    first = ("a", 1_000_000, [("V1", 1.0, 1.0, 1.0, "True"), ("V2", 2.0, 2.0, 2.0, "False")])
    fix = ("b", 1_000_100, [("V1", 9.0, 1.0, 1.0, "True"), ("V3", 5.0, 1.0, 1.0, "True")])
    again = ("c", 1_000_200, first[2])
    want = [("V1", 1, 9.0), ("V2", 1, 2.0), ("V3", 1, 5.0)]
    for name, triggers in (("one", [[first, fix]]), ("two", [[first], [fix]]), ("late", [[fix], [first]]),
                           ("again", [[first], [fix], [again]]), ("all", [[again, fix, first]])):
        assert _landed(spark, tmp_path, name, triggers) == want, name


def test_merge_landed_cases(spark, tmp_path):
    import pytest
    from drover.operators.landing import merge_landed, read_manifest
    from drover.operators.reconcile import merge_expenses
    from drover.schemas import EXPENSES_SCHEMA
    cols = "vehicle_id string, sim_day int, fuel_cost double, maintenance_cost double, distance_covered double, service_flag boolean"
    table = str(tmp_path / "table")

    def feed(*rows):
        df = spark.createDataFrame([(*r[:2], r[2], 1.0, 1.0, True, r[3], r[4]) for r in rows], cols + ", file_path string, t long")
        return df.withColumn("file_modified", F.timestamp_seconds("t")).drop("t")
    merge_landed(feed(), table)                                  # nothing has landed
    twice = feed(("V1", 1, 1.0, "f", 5), ("V1", 1, 2.0, "f", 5))
    with pytest.raises(ValueError):
        merge_landed(twice, table)
    merge_landed(twice, table, "keep_one")
    assert [r.fuel_cost for r in spark.read.parquet(table).collect()] == [2.0]
    merge_landed(feed(("V1", 1, 7.0, "g", 5)), table)            # equally old: the later path
    merge_landed(feed(("V1", 1, 3.0, "e", 5)), table)
    assert [r.fuel_cost for r in spark.read.parquet(table).collect()] == [7.0]
    merge_landed(feed(("V1", 1, 3.0, "e", 5)), table)            # a replay
    assert read_manifest(spark, table).count() == 3
    # rows without a file win over what has landed so far
    merge_expenses(spark.createDataFrame([("V1", 1, 4.0, 1.0, 1.0, False)], EXPENSES_SCHEMA), table)
    merge_landed(feed(("V1", 1, 8.0, "h", 6), ("V2", 2, 1.0, "h", 6)), table)
    assert sorted((r.vehicle_id, r.fuel_cost) for r in spark.read.parquet(table).collect()) == [("V1", 4.0), ("V2", 1.0)]
    # a table stored without versions
    old = str(tmp_path / "old")
    spark.createDataFrame([("V1", 1, 4.0, 1.0, 1.0, False)], EXPENSES_SCHEMA).write.partitionBy("sim_day").parquet(old)
    merge_landed(feed(("V1", 1, 8.0, "h", 6)), old)
    assert [r.fuel_cost for r in spark.read.parquet(old).collect()] == [8.0]
