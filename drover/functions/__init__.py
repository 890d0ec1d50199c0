from drover.functions.geo import zone_of, sim_day_of, day_start_us
from drover.functions.text import render
from drover.functions.times import (
    epoch_us, seconds_between, ts_from_us, lit_ts, parse_event_time, time_bucket, known_at, newer_than,
)

__all__ = [
    "render", "zone_of", "sim_day_of", "day_start_us", "epoch_us", "seconds_between", "ts_from_us",
    "lit_ts", "parse_event_time", "time_bucket", "known_at", "newer_than",
]
