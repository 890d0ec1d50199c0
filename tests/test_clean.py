"""Cleaning rules and quarantine reasons."""

from drover.operators.clean import clean, quarantine, quarantine_counts
from drover.schemas import EVENT_SCHEMA
from drover.sources.telemetry import decode_wire


def _rows(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)


GOOD = ("T1", "D1", "V1", 6.9, 79.9, 10.0, "idle", 0.0, "2024-01-01T00:00:00+00:00", 1)


def test_each_rule(spark):
    bad = [
        GOOD,
        ("T1", "D1", None, 6.9, 79.9, 10.0, "idle", 0.0, "2024-01-01T00:00:00+00:00", 2),
        ("T1", "D1", "V1", 6.9, 79.9, 10.0, "idle", 0.0, "yesterday", 3),
        ("T1", "D1", "V1", 6.9, 79.9, 10.0, "parked", 0.0, "2024-01-01T00:00:00+00:00", 4),
        ("T1", "D1", "V1", float("nan"), 79.9, 10.0, "idle", 0.0, "2024-01-01T00:00:00+00:00", 5),
        ("T1", "D1", "V1", None, 79.9, 10.0, "idle", 0.0, "2024-01-01T00:00:00+00:00", 6),
        ("T1", "D1", "V1", 90.0, 180.0, 200.0, "idle", 1000.0, "2024-01-01T00:00:00+00:00", 7),
        ("T1", "D1", "V1", 6.9, 79.9, 200.5, "idle", -0.01, "2024-01-01T00:00:00+00:00", 8),
        (None, None, "V1", 6.9, 79.9, 10.0, "idle", 0.0, "2024-01-01T00:00:00+00:00", 9),
    ]
    df = _rows(spark, bad)
    assert sorted(r.event_id for r in clean(df).collect()) == [1, 7]  # bounds are inclusive
    reasons = {r.event_id: sorted(r.reasons) for r in quarantine(df).collect()}
    assert reasons[2] == ["vehicle_id_missing"]
    assert reasons[3] == ["event_ts_invalid"]
    assert reasons[4] == ["status_invalid"]
    assert reasons[5] == ["position_out_of_range"] and reasons[6] == ["position_out_of_range"]
    assert reasons[8] == ["fare_out_of_range", "speed_out_of_range"]
    assert reasons[9] == ["driver_id_missing", "trip_id_missing"]


def test_malformed_json_record_is_quarantined(spark):
    wire = spark.createDataFrame([("V1", '{"vehicle_id": "V1", "lat": "north"}'), ("V2", "not json")],
                                 "key string, value string")
    dec = decode_wire(wire)
    assert clean(dec).count() == 0
    counts = {r.rule: r.rejected for r in quarantine_counts(dec).collect()}
    assert counts["vehicle_id_missing"] == 1 and counts["event_ts_invalid"] == 2


def test_fixture_counts(fixture_inputs):
    counts = {r.rule: r.rejected for r in quarantine_counts(fixture_inputs.decoded).collect()}
    assert counts == {"vehicle_id_missing": 9, "event_ts_invalid": 10, "status_invalid": 201,
                      "position_out_of_range": 10, "speed_out_of_range": 10, "fare_out_of_range": 10}
    assert clean(fixture_inputs.decoded).count() == 759
