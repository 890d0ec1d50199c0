"""The alert log: rounds read the open set only, folds give the table of any time."""

import pytest

from drover.config import Params
from drover.operators import alert_log as AL
from drover.operators import alerts as A

P = Params(start_epoch=0.0, day_seconds=86400, as_of=10_000.0, staleness_threshold_s=60, idle_threshold_s=120)


def _firing(spark, rows):
    return spark.createDataFrame(rows, "alert_type string, severity string, entity_id string, message string")


def _state(df):
    return sorted(((r.alert_type, r.entity_id, r.message, r.created_at.timestamp() if r.created_at else None, r.resolved)
                   for r in df.collect()), key=repr)


V1, V2, NONE = (("vehicle_idle", "warning", "V1", "m1"), ("vehicle_idle", "warning", "V2", "m2"),
                ("pipeline_staleness", "critical", None, "s"))
ROUNDS = [[V1, V2, NONE], [V1, NONE], [V2], [], [V1, V2]]


def test_folds_equal_the_rewritten_table(spark, tmp_path):
    store, table, states = str(tmp_path / "log"), A.empty_alerts(spark), []
    assert AL.last_round(spark, store) is None and AL.alerts_as_of(spark, store).count() == 0
    for i, rows in enumerate(ROUNDS):
        p = P.replace(as_of=P.as_of + 30 * i)
        assert AL.evaluate_round(spark, store, _firing(spark, rows), p) == i
        table = spark.createDataFrame(A.apply_conditions(table, _firing(spark, rows), p).collect(), A.ALERT_SCHEMA)
        states.append(_state(table))
        assert _state(AL.alerts_as_of(spark, store)) == states[-1]
    for i, want in enumerate(states):
        assert _state(AL.alerts_as_of(spark, store, P.as_of + 30 * i)) == want
    assert AL.alerts_as_of(spark, store, P.as_of - 1).count() == 0


def test_a_round_reads_the_open_set_alone(spark, tmp_path):
    store = str(tmp_path / "log")
    for i in range(3):
        AL.evaluate_round(spark, store, _firing(spark, [V1] if i % 2 == 0 else []), P.replace(as_of=P.as_of + i))
    read = AL.open_alerts(spark, store).inputFiles()
    assert read and all("/open/round=2/" in f for f in read)
    AL.evaluate_round(spark, store, _firing(spark, [V1]), P.replace(as_of=P.as_of + 9))     # nothing changes
    assert spark.read.parquet(f"{store}/transitions").where("round = 3").count() == 0
    assert AL.open_alerts(spark, store).count() == 1


def test_a_failed_round_leaves_no_trace(spark, tmp_path):
    store = str(tmp_path / "log")
    AL.evaluate_round(spark, store, _firing(spark, [V1]), P)
    before = _state(AL.alerts_as_of(spark, store))
    # transitions of a round that stopped before its open set was written
    half = AL.transitions_of(AL.open_alerts(spark, store), _firing(spark, [V2]), P.replace(as_of=P.as_of + 5))
    half.where("transition is not null").write.parquet(f"{store}/transitions/round=1")
    assert AL.last_round(spark, store) == 0 and _state(AL.alerts_as_of(spark, store)) == before
    assert AL.evaluate_round(spark, store, _firing(spark, [V1]), P.replace(as_of=P.as_of + 6)) == 1
    assert _state(AL.alerts_as_of(spark, store)) == before


@pytest.mark.parametrize("copies", [2, 3])
def test_a_condition_given_twice_raises_one_alert(spark, tmp_path, copies):
    store = str(tmp_path / "log")
    AL.evaluate_round(spark, store, _firing(spark, [V1, NONE] * copies), P)
    assert AL.open_alerts(spark, store).count() == 2
