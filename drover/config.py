"""Parameters of the fleet model.

Everything the reference reads from the environment or from its database at boot
(start of the simulated clock, day length, thresholds, "now") is an explicit
parameter here, so that every result is reproducible for a given ``as_of``.
"""

from __future__ import annotations

import dataclasses
from datetime import datetime, timezone

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results:
# the city bounding box, the 3x3 zone names (north row first, west to east),
# the clamp ceiling of a grid fraction, the valid statuses, the statuses that
# count as moving, and the degree-to-km factor of the distance estimate.
# ---------------------------------------------------------------------------
CITY_MIN_LAT = 6.83
CITY_MAX_LAT = 6.96
CITY_MIN_LON = 79.83
CITY_MAX_LON = 79.93
ZONE_NAMES = (
    "zone_NW", "zone_N", "zone_NE",
    "zone_W", "zone_CENTRAL", "zone_E",
    "zone_SW", "zone_S", "zone_SE",
)
GRID_FRACTION_CEILING = 0.999999
VALID_STATUSES = ("idle", "enroute", "on_trip")
MOVING_STATUSES = ("enroute", "on_trip")
KM_PER_DEGREE = 111.0
NO_TRIP = "-"
# Value ranges an event must satisfy (inclusive).
LAT_RANGE = (-90.0, 90.0)
LON_RANGE = (-180.0, 180.0)
SPEED_RANGE = (0.0, 200.0)
FARE_RANGE = (0.0, 1000.0)
# Alert vocabulary: types, severities, the staleness entity and the message formats
# ({name} marks a value filled in per alert).
ALERT_STALENESS = "pipeline_staleness"
ALERT_IDLE = "vehicle_idle"
ALERT_REPORT_MISSING = "reconciliation_missing"
ALERT_PROFITABILITY = "fleet_profitability"
SEVERITY_CRITICAL = "critical"
SEVERITY_WARNING = "warning"
STALENESS_ENTITY = "telemetry"
MSG_NO_EVENTS = "No telemetry events ingested yet"
MSG_STALE = "No telemetry ingested in {age}s (threshold {threshold}s)"
MSG_IDLE = "{vehicle} has been idle for {seconds}s (threshold {threshold}s)"
MSG_REPORT_MISSING = "No profitability report rows produced for sim_day={day}"
MSG_UNPROFITABLE = "{bad}/{total} vehicles unprofitable on sim_day={day}"
# Days per dashboard "month" bucket and the clamp of the trend length.
DAYS_PER_MONTH = 30
TREND_DAYS_MIN, TREND_DAYS_MAX, TREND_DAYS_DEFAULT = 1, 500, 200


@dataclasses.dataclass(frozen=True)
class Grid:
    """A rectangular box cut into 3x3 named cells, north row first, west to east."""

    min_lat: float = CITY_MIN_LAT
    max_lat: float = CITY_MAX_LAT
    min_lon: float = CITY_MIN_LON
    max_lon: float = CITY_MAX_LON
    names: tuple = ZONE_NAMES

    def __post_init__(self):
        if len(self.names) != 9 or not (self.min_lat < self.max_lat and self.min_lon < self.max_lon):
            raise ValueError("a grid needs 9 names and a non-empty box")


CITY_GRID = Grid()


def _epoch(iso: str) -> float:
    return datetime.fromisoformat(iso).replace(tzinfo=timezone.utc).timestamp()


@dataclasses.dataclass(frozen=True)
class Params:
    """Model parameters; all times are epoch seconds (UTC)."""

    start_epoch: float
    day_seconds: int = 300
    as_of: float | None = None
    window: str = "1 minute"
    watermark: str = "2 minutes"
    status_recency_s: int = 300
    zone_recency_s: int = 300
    trip_recency_s: int = 3600
    staleness_threshold_s: int = 60
    idle_threshold_s: int = 120
    # Time bucket used to split per-vehicle sequences (lag, status runs) into
    # bounded sort groups; results do not depend on it.
    bucket_seconds: int = 3600

    @property
    def start_us(self) -> int:
        return int(round(self.start_epoch * 1_000_000))

    @property
    def day_us(self) -> int:
        return int(self.day_seconds) * 1_000_000

    @property
    def as_of_us(self) -> int:
        if self.as_of is None:
            raise ValueError("as_of is required for this operator")
        return int(round(self.as_of * 1_000_000))

    def day_at(self, epoch_s: float) -> int:
        """Simulated day of an instant; floor, so instants before the start are negative."""
        return int((epoch_s - self.start_epoch) // self.day_seconds)

    @property
    def current_day(self) -> int:
        return self.day_at(self.as_of)

    def replace(self, **kw) -> "Params":
        return dataclasses.replace(self, **kw)


# Parameters used with the shared test tables (events span 30 days of 2024-01).
FIXTURE_PARAMS = Params(
    start_epoch=_epoch("2024-01-01T00:00:00"),
    day_seconds=86400,
    as_of=_epoch("2024-01-31T00:00:00"),
    window="1 minute",
    watermark="2 minutes",
    status_recency_s=86400,
    zone_recency_s=86400,
    trip_recency_s=86400,
    staleness_threshold_s=1800,
    idle_threshold_s=21600,
)
