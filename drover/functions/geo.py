"""Zone grid and simulated-day expressions (native replacements of row UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from drover import config as C
from drover.functions.times import epoch_us


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _grid_index(value: Column, lo: float, hi: float) -> Column:
    # Fraction of the way across the box, clamped so that points outside the box
    # fall into the nearest edge cell; three cells per axis.
    frac = (value - F.lit(lo)) / (F.lit(hi) - F.lit(lo))
    frac = F.least(F.greatest(frac, F.lit(0.0)), F.lit(C.GRID_FRACTION_CEILING))
    return F.floor(frac * F.lit(3)).cast("int")


def zone_of(lat, lon, grid: C.Grid = C.CITY_GRID) -> Column:
    """Name of the 3x3 grid cell of a point; north row first. Null in, null out.
    Points outside the box fall into the nearest edge cell."""
    lat, lon = _c(lat), _c(lon)
    row = F.lit(2) - _grid_index(lat, grid.min_lat, grid.max_lat)
    col = _grid_index(lon, grid.min_lon, grid.max_lon)
    names = F.array(*[F.lit(n) for n in grid.names])
    zone = F.element_at(names, row * F.lit(3) + col + F.lit(1))
    return F.when(lat.isNotNull() & lon.isNotNull(), zone)


def sim_day_of(ts, params) -> Column:
    """``floor((t - start) / day_seconds)``; negative before the start."""
    return F.floor((epoch_us(ts) - F.lit(params.start_us)) / F.lit(params.day_us)).cast("int")


def day_start_us(day, params) -> Column:
    """Epoch microseconds at which simulated day ``day`` begins."""
    return F.lit(params.start_us) + _c(day).cast("long") * F.lit(params.day_us)
