"""drover: fleet-operations analytics as Spark DataFrame and Structured Streaming plans.

Sub-packages:

* ``functions`` -- Column expressions (zone grid, simulated day, time helpers).
* ``sources``   -- telemetry wire decoding, expense landing files, day scans,
                   fixture adapters from the shared test tables.
* ``operators`` -- cleaning, metrics, status runs, reconciliation, serving, alerts.
* ``streaming`` -- streaming jobs, changelog sinks, keyed status state.
* ``plans``     -- the registry of named queries and their SQL oracles.
"""

from drover.config import Params, FIXTURE_PARAMS

__all__ = ["Params", "FIXTURE_PARAMS"]
