"""Keyed streaming state for the latest status of every vehicle and the start of its
current run of equal status (T10).

Per micro-batch a vehicle's new events are ordered by (event_ts, event_id) and compared
with the state's last status; ``status_since`` moves to the first event of the newest run.
Events older than the state's last event cannot change the present status (a late event
never regresses it) and are ignored here; the batch form recomputes runs exactly.

``held_events`` is the first half of the ordered mode: events in the state store until the
watermark passes them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Tie-break of a record without an event id.
NO_ID = -(2 ** 63)

STATE_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("since_us", T.LongType()),
    T.StructField("last_us", T.LongType()),
    T.StructField("last_id", T.LongType()),
])

OUTPUT_SCHEMA = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("driver_id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("last_fare", T.DoubleType()),
    T.StructField("sim_day", T.IntegerType()),
    T.StructField("status_since_us", T.LongType()),
    T.StructField("updated_at_us", T.LongType()),
])

INPUT_COLUMNS = ["vehicle_id", "driver_id", "lat", "lon", "speed", "status", "zone", "fare",
                 "sim_day", "event_id"]


def _update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    parts = list(batches)
    pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    ts = pdf["ts_us"].to_numpy()
    ids = pdf["event_id"].to_numpy()
    if state.exists:
        st_status, st_since, st_last, st_id = state.get
        keep = (ts > st_last) | ((ts == st_last) & (ids > st_id))
        if not keep.all():
            pdf, ts, ids = pdf[keep], ts[keep], ids[keep]
    else:
        st_status, st_since = None, None
    if len(ts) == 0:
        return
    order = np.lexsort((ids, ts))
    status = pdf["status"].to_numpy(dtype=object)[order]
    ts = ts[order]
    prev = np.empty_like(status)
    prev[0] = st_status
    prev[1:] = status[:-1]
    changed = np.flatnonzero(status != prev)
    since = int(ts[changed[-1]]) if len(changed) else int(st_since)
    last = pdf.iloc[int(order[-1])]
    state.update((str(last["status"]), since, int(ts[-1]), int(ids[order[-1]])))
    yield pd.DataFrame({
        "vehicle_id": [key[0]], "driver_id": [last["driver_id"]], "lat": [last["lat"]], "lon": [last["lon"]],
        "speed": [last["speed"]], "status": [last["status"]], "zone": [last["zone"]],
        "last_fare": [last["fare"]], "sim_day": [int(last["sim_day"])], "status_since_us": [since],
        "updated_at_us": [int(ts[-1])],
    })


def _ship_by_value() -> None:
    # The state function runs in Python workers; pickle this module by value so that the
    # workers need numpy/pandas/pyspark only, not this package on their path.
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def latest_status_stream(events: DataFrame) -> DataFrame:
    """Streaming latest status per vehicle (output mode update). Every event is applied as it
    arrives (immediate; an event older than the vehicle's latest applied one is ignored, so
    status never regresses)."""
    _ship_by_value()
    # records without an event id come before those with one at the same instant
    events = events.withColumn("event_id", F.coalesce("event_id", F.lit(NO_ID)))
    inp = events.select(*INPUT_COLUMNS, F.unix_micros("event_ts").alias("ts_us"))
    return inp.groupBy("vehicle_id").applyInPandasWithState(
        _update, OUTPUT_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)


def held_events(events: DataFrame, delay: str) -> DataFrame:
    """The events, each once the watermark (``delay`` behind the newest event) has passed its
    instant (output mode append); what arrives behind the watermark is dropped.

    State is a row per vehicle and instant that is still to be passed, in the state store
    and without Python workers, so neither a busy vehicle nor a large trigger is gathered
    in one task's memory. Merged in the order of release, the events give exact runs for
    input that is out of order by less than the delay; output lags event time by it.
    """
    event = F.struct("event_ts", *[c for c in INPUT_COLUMNS if c != "vehicle_id"])
    held = events.withWatermark("event_ts", delay).groupBy("vehicle_id", F.window("event_ts", "1 microsecond")).agg(
        F.collect_list(event).alias("at_once"))
    return held.select("vehicle_id", F.inline("at_once"))
