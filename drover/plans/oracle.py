"""DuckDB SQL oracles for the registered queries.

The same fixture formulas as ``drover.sources.fixtures`` are written as common table
expressions over the shared tables; every query body then states its semantics
directly (plain windows over whole partitions -- the oracle does not need to scale).
Output conventions match ``export``: timestamps as epoch microseconds, doubles rounded half
up to 6 decimals by ``floor(x * 1e6 + 0.5) / 1e6``.
"""

from __future__ import annotations

from drover import config as C
from drover.config import FIXTURE_PARAMS as P

START_US = P.start_us
DAY_US = P.day_us
AS_OF_US = P.as_of_us
CUR_DAY = P.current_day


def _r(expr: str, name: str) -> str:
    # half up to 6 decimals with the same floating-point operations as ``export``
    return f"floor(({expr}) * 1000000e0 + 0.5e0) / 1000000e0 AS {name}"


def _msg(template: str, **exprs) -> str:
    """A message template (``drover.config``) as a SQL string concatenation."""
    import re
    out, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            out.append("'" + template[pos:m.start()].replace("'", "''") + "'")
        out.append(f"CAST({exprs[m.group(1)]} AS VARCHAR)")
        pos = m.end()
    if pos < len(template):
        out.append("'" + template[pos:].replace("'", "''") + "'")
    return "(" + " || ".join(out) + ")"


def _zone(lat: str, lon: str) -> str:
    names = ", ".join(f"'{n}'" for n in C.ZONE_NAMES)

    def idx(v, lo, hi):
        return (f"CAST(floor(least(greatest(({v} - {lo}e0) / ({hi}e0 - {lo}e0), 0e0), "
                f"{C.GRID_FRACTION_CEILING}e0) * 3) AS INTEGER)")
    return (f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN [{names}]"
            f"[(2 - {idx(lat, C.CITY_MIN_LAT, C.CITY_MAX_LAT)}) * 3 + {idx(lon, C.CITY_MIN_LON, C.CITY_MAX_LON)} + 1] END")


def _day(us_expr: str) -> str:
    return f"CAST(floor(({us_expr} - {START_US}) / {DAY_US}) AS INTEGER)"


_STATUSES = ", ".join(f"'{s}'" for s in C.VALID_STATUSES)

RAW = f"""
raw AS (
  SELECT
    CASE WHEN event_type IN ('click', 'purchase')
         THEN 'T' || CAST(user_id AS VARCHAR) || '_' ||
              CAST(CAST(floor((epoch_us(ts) - {START_US}) / 86400000000) AS BIGINT) AS VARCHAR) || '_' ||
              CAST(k % 2 AS VARCHAR)
         ELSE '-' END AS trip_id,
    'D' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS driver_id,
    CASE WHEN event_id % 113 = 0 THEN NULL ELSE 'V' || lpad(CAST(user_id AS VARCHAR), 6, '0') END AS vehicle_id,
    CASE WHEN event_id % 101 = 0 THEN 95e0
         ELSE 6.83e0 + 0.13e0 * (((user_id * 37 + event_id * 11) % 1100) - 50) / 1000e0 END AS lat,
    79.83e0 + 0.10e0 * (((user_id * 53 + event_id * 17) % 1100) - 50) / 1000e0 AS lon,
    CASE WHEN event_id % 103 = 0 THEN 250e0
         WHEN event_type IN ('click', 'purchase') THEN 25e0 + CAST(k % 31 AS DOUBLE)
         ELSE 0e0 END AS speed,
    CASE event_type WHEN 'click' THEN 'enroute' WHEN 'purchase' THEN 'on_trip'
         WHEN 'view' THEN 'idle' WHEN 'signup' THEN 'idle' WHEN 'error' THEN 'offline' END AS status,
    CASE WHEN event_id % 107 = 0 THEN -1e0 WHEN event_type = 'purchase' THEN value ELSE 0e0 END AS fare,
    CASE WHEN event_id % 109 = 0 THEN NULL ELSE ts END AS event_ts,
    event_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
)"""

RULES = [
    ("vehicle_id_missing", "vehicle_id IS NOT NULL"),
    ("event_ts_invalid", "event_ts IS NOT NULL"),
    ("status_invalid", f"status IN ({_STATUSES})"),
    ("position_out_of_range", "lat BETWEEN -90e0 AND 90e0 AND lon BETWEEN -180e0 AND 180e0"),
    ("speed_out_of_range", "speed >= 0e0 AND speed <= 200e0"),
    ("fare_out_of_range", "fare >= 0e0 AND fare <= 1000e0"),
    ("trip_id_missing", "trip_id IS NOT NULL"),
    ("driver_id_missing", "driver_id IS NOT NULL"),
]

CLEAN = "clean AS (SELECT * FROM raw WHERE " + " AND ".join(f"coalesce({c}, false)" for _, c in RULES) + ")"

EV = f"""
ev AS (
  SELECT *, {_zone('lat', 'lon')} AS zone, {_day('epoch_us(event_ts)')} AS sim_day FROM clean
)"""

EXPENSES = """
per_order AS (
  SELECT l_orderkey, sum(l_quantity) AS q, sum(l_extendedprice * l_tax) AS m,
         bool_or(l_returnflag = 'R') AS svc
  FROM lineitem GROUP BY l_orderkey
),
exp_g AS (
  SELECT CAST(floor(o_custkey / 10) AS BIGINT) AS u, CAST(o_orderkey % 30 AS INTEGER) AS sim_day,
         sum(q) AS q, sum(m) AS m, bool_or(svc) AS svc
  FROM per_order JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
),
expenses AS (
  SELECT 'V' || lpad(CAST(u AS VARCHAR), 6, '0') AS vehicle_id, sim_day,
         CASE WHEN u % 13 = 0 THEN 0e0 ELSE floor(q * 0.035e0 * 100e0 + 0.5e0) / 100e0 END AS fuel_cost,
         floor(m / 10000e0 * 100e0 + 0.5e0) / 100e0 AS maintenance_cost,
         CASE WHEN u % 13 = 0 THEN 0e0 ELSE q * 0.1e0 END AS distance_covered,
         svc AS service_flag
  FROM exp_g
),
expenses_fixed AS (
  SELECT vehicle_id, sim_day, fuel_cost,
         CASE WHEN sim_day = 3 AND CAST(substr(vehicle_id, 2, 6) AS BIGINT) % 10 <> 0
              THEN maintenance_cost * 2e0 ELSE maintenance_cost END AS maintenance_cost, distance_covered, service_flag
  FROM expenses
)"""

EARNINGS = """
earnings AS (
  SELECT vehicle_id, sim_day, sum(fare) AS total_fare,
         count(DISTINCT CASE WHEN trip_id <> '-' THEN trip_id END) AS trip_count
  FROM ev GROUP BY vehicle_id, sim_day
)"""


def _report(name: str, exp: str) -> str:
    return f"""
{name} AS (
  SELECT x.vehicle_id, x.sim_day, coalesce(e.total_fare, 0e0) AS total_fare, x.fuel_cost, x.maintenance_cost,
         coalesce(e.total_fare, 0e0) - x.fuel_cost - x.maintenance_cost AS net_profit, x.distance_covered,
         CASE WHEN x.distance_covered > 0 THEN (x.fuel_cost + x.maintenance_cost) / x.distance_covered END AS cost_per_km,
         (coalesce(e.total_fare, 0e0) - x.fuel_cost - x.maintenance_cost) > 0 AS profitable
  FROM {exp} x LEFT JOIN earnings e ON e.vehicle_id = x.vehicle_id AND e.sim_day = x.sim_day
)"""


def _spells(suffix: str, as_of_us: int) -> str:
    return f"""
seq{suffix} AS (
  SELECT vehicle_id, status, event_ts, event_id,
         CASE WHEN lag(status) OVER w IS NOT NULL AND lag(status) OVER w <> status THEN 1 ELSE 0 END AS chg
  FROM ev WHERE epoch_us(event_ts) <= {as_of_us}
  WINDOW w AS (PARTITION BY vehicle_id ORDER BY event_ts, event_id)
),
runs{suffix} AS (
  SELECT *, 1 + sum(chg) OVER (PARTITION BY vehicle_id ORDER BY event_ts, event_id ROWS UNBOUNDED PRECEDING) AS run_id
  FROM seq{suffix}
),
sp{suffix} AS (
  SELECT vehicle_id, CAST(run_id AS BIGINT) AS run_id, min(status) AS status, min(event_ts) AS spell_start,
         max(event_ts) AS last_event_ts, count(*) AS n_events
  FROM runs{suffix} GROUP BY vehicle_id, run_id
),
spells{suffix} AS (
  SELECT s.vehicle_id, s.run_id, s.status, epoch_us(s.spell_start) AS start_us,
         coalesce(epoch_us(n.spell_start), {as_of_us}) AS end_us, epoch_us(s.last_event_ts) AS last_us,
         s.n_events, n.spell_start IS NULL AS is_current,
         (coalesce(epoch_us(n.spell_start), {as_of_us}) - epoch_us(s.spell_start)) / 1000000e0 AS duration_s
  FROM sp{suffix} s LEFT JOIN sp{suffix} n ON n.vehicle_id = s.vehicle_id AND n.run_id = s.run_id + 1
),
latest{suffix} AS (
  SELECT l.vehicle_id, l.driver_id, l.lat, l.lon, l.speed, l.status, l.zone, l.fare AS last_fare, l.sim_day,
         s.start_us AS status_since, epoch_us(l.event_ts) AS updated_at
  FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY event_ts DESC, event_id DESC) AS rn
        FROM ev WHERE epoch_us(event_ts) <= {as_of_us}) l
  LEFT JOIN spells{suffix} s ON s.vehicle_id = l.vehicle_id AND s.is_current
  WHERE l.rn = 1
)"""


def _conditions(suffix: str, as_of_us: int) -> str:
    day = P.day_at(as_of_us / 1e6) - 1
    thr, idle = P.staleness_threshold_s, P.idle_threshold_s
    crit, warn = C.SEVERITY_CRITICAL, C.SEVERITY_WARNING
    batch = f"""
  UNION ALL
  SELECT CASE WHEN total = 0 THEN '{C.ALERT_REPORT_MISSING}' ELSE '{C.ALERT_PROFITABILITY}' END,
         CASE WHEN total = 0 THEN '{crit}' ELSE '{warn}' END, '{day}',
         CASE WHEN total = 0 THEN {_msg(C.MSG_REPORT_MISSING, day=day)}
              ELSE {_msg(C.MSG_UNPROFITABLE, bad='bad', total='total', day=day)} END
  FROM (SELECT count(*) AS total, count(*) FILTER (WHERE NOT profitable) AS bad FROM report WHERE sim_day = {day}) c
  WHERE total = 0 OR bad / total > 0.5e0""" if day >= 0 else ""
    age = f"CAST(round_even(({as_of_us} - t) / 1000000e0, 0) AS BIGINT)"
    idle_s = f"CAST(round_even(({as_of_us} - status_since) / 1000000e0, 0) AS BIGINT)"
    return f"""
cond{suffix} AS (
  SELECT '{C.ALERT_STALENESS}' AS alert_type, '{crit}' AS severity, '{C.STALENESS_ENTITY}' AS entity_id,
         CASE WHEN t IS NULL THEN '{C.MSG_NO_EVENTS}'
              ELSE {_msg(C.MSG_STALE, age=age, threshold=thr)} END AS message
  FROM (SELECT max(epoch_us(event_ts)) AS t FROM ev WHERE epoch_us(event_ts) <= {as_of_us}) s
  WHERE t IS NULL OR ({as_of_us} - t) / 1000000e0 > {thr}e0
  UNION ALL
  SELECT '{C.ALERT_IDLE}', '{warn}', vehicle_id, {_msg(C.MSG_IDLE, vehicle='vehicle_id', seconds=idle_s, threshold=idle)}
  FROM latest{suffix} WHERE status = 'idle' AND ({as_of_us} - status_since) / 1000000e0 > {idle}e0{batch}
)"""


PREV_US = AS_OF_US - 86400 * 1_000_000
# last microsecond before the final watermark of a replay (newest event in ms - 2 minutes)
WM_LAST_US = "(((SELECT max(epoch_us(event_ts)) FROM ev) // 1000 - 120000) * 1000 - 1)"

BASE = ("WITH " + ",".join([RAW, CLEAN, EV, EXPENSES, EARNINGS, _report("report", "expenses"),
                            _report("report_fixed", "expenses_fixed"),
                            _spells("", AS_OF_US), _spells("0", PREV_US), _spells("w", WM_LAST_US),
                            _conditions("", AS_OF_US), _conditions("0", PREV_US)]) + """,
alerts AS (
  SELECT o.alert_type, o.severity, o.entity_id, o.message, """ + str(PREV_US) + """ AS created_at,
         n.alert_type IS NULL AS resolved
  FROM cond0 o LEFT JOIN cond n ON n.alert_type = o.alert_type AND n.entity_id IS NOT DISTINCT FROM o.entity_id
  UNION ALL
  SELECT n.alert_type, n.severity, n.entity_id, n.message, """ + str(AS_OF_US) + """ AS created_at, false AS resolved
  FROM cond n LEFT JOIN cond0 o ON n.alert_type = o.alert_type AND n.entity_id IS NOT DISTINCT FROM o.entity_id
  WHERE o.alert_type IS NULL
)
""")

REPORT_COLS = ("vehicle_id, sim_day, " + _r("total_fare", "total_fare") + ", " + _r("fuel_cost", "fuel_cost")
               + ", " + _r("maintenance_cost", "maintenance_cost") + ", " + _r("net_profit", "net_profit") + ", "
               + _r("distance_covered", "distance_covered") + ", " + _r("cost_per_km", "cost_per_km") + ", profitable")
EXPENSE_COLS = ("vehicle_id, sim_day, " + _r("fuel_cost", "fuel_cost") + ", " + _r("maintenance_cost", "maintenance_cost")
                + ", " + _r("distance_covered", "distance_covered") + ", service_flag")
ZONE_COLS = ("zone, window_start, window_end, active_vehicles, idle_count, enroute_count, on_trip_count, trip_count, "
             + _r("total_earnings", "total_earnings") + ", " + _r("avg_speed", "avg_speed") + ", sim_day")


def _zone_metrics(width_us: int) -> str:
    return f"""
SELECT zone, ws AS window_start, ws + {width_us} AS window_end,
       count(DISTINCT vehicle_id) AS active_vehicles,
       count(DISTINCT CASE WHEN status = 'idle' THEN vehicle_id END) AS idle_count,
       count(DISTINCT CASE WHEN status = 'enroute' THEN vehicle_id END) AS enroute_count,
       count(DISTINCT CASE WHEN status = 'on_trip' THEN vehicle_id END) AS on_trip_count,
       count(DISTINCT CASE WHEN trip_id <> '-' THEN trip_id END) AS trip_count,
       sum(fare) AS total_earnings, avg(speed) AS avg_speed, {_day('ws')} AS sim_day
FROM (SELECT *, (epoch_us(event_ts) // {width_us}) * {width_us} AS ws FROM ev) GROUP BY zone, ws"""


TREND_FLEET = f"""
SELECT * FROM (
  SELECT e.sim_day, sum(e.total_fare) AS total_fare, CAST(sum(e.trip_count) AS BIGINT) AS trip_count,
         sum(r.net_profit) AS net_profit,
         CASE WHEN sum(r.net_profit) IS NULL THEN NULL ELSE sum(r.net_profit) > 0 END AS profitable
  FROM earnings e LEFT JOIN report r ON r.vehicle_id = e.vehicle_id AND r.sim_day = e.sim_day
  GROUP BY e.sim_day)"""

_Q: dict[str, str] = {}

_Q["profitability_report"] = f"SELECT {REPORT_COLS} FROM report"
_Q["expense_feed"] = f"SELECT {EXPENSE_COLS} FROM expenses"
_Q["expense_correction"] = f"SELECT {EXPENSE_COLS} FROM expenses_fixed"
_Q["report_rerun"] = f"SELECT {REPORT_COLS} FROM report_fixed"
_Q["unmatched_earnings"] = f"""
SELECT e.vehicle_id, e.sim_day, {_r('e.total_fare', 'total_fare')}, e.trip_count FROM earnings e
WHERE NOT EXISTS (SELECT 1 FROM expenses x WHERE x.vehicle_id = e.vehicle_id AND x.sim_day = e.sim_day)"""
_Q["closed_days"] = f"""
SELECT d.sim_day, d.has_expenses, r.sim_day IS NOT NULL AS reconciled, d.sim_day = {CUR_DAY - 1} AS is_target
FROM (SELECT sim_day, bool_or(has_expenses) AS has_expenses FROM (
        SELECT sim_day, false AS has_expenses FROM earnings UNION ALL SELECT sim_day, true FROM expenses)
      WHERE sim_day >= 0 AND sim_day < {CUR_DAY} GROUP BY sim_day) d
LEFT JOIN (SELECT DISTINCT sim_day FROM report) r ON r.sim_day = d.sim_day"""
_Q["batch_health"] = f"""
SELECT d.sim_day, coalesce(c.n, 0) AS vehicle_count, coalesce(c.bad, 0) AS unprofitable_count,
       CASE WHEN coalesce(c.n, 0) = 0 THEN '{C.ALERT_REPORT_MISSING}'
            WHEN c.bad / c.n > 0.5e0 THEN '{C.ALERT_PROFITABILITY}' END AS alert_type,
       CASE WHEN coalesce(c.n, 0) = 0 THEN '{C.SEVERITY_CRITICAL}'
            WHEN c.bad / c.n > 0.5e0 THEN '{C.SEVERITY_WARNING}' END AS severity,
       CASE WHEN coalesce(c.n, 0) = 0 THEN {_msg(C.MSG_REPORT_MISSING, day='d.sim_day')}
            WHEN c.bad / c.n > 0.5e0 THEN {_msg(C.MSG_UNPROFITABLE, bad='c.bad', total='c.n', day='d.sim_day')}
       END AS message
FROM (SELECT DISTINCT sim_day FROM earnings WHERE sim_day >= 0 AND sim_day < {CUR_DAY}) d
LEFT JOIN (SELECT sim_day, count(*) AS n, count(*) FILTER (WHERE NOT profitable) AS bad FROM report GROUP BY sim_day) c
  ON c.sim_day = d.sim_day"""

_Q["clean_events"] = f"""
SELECT event_id, vehicle_id, driver_id, trip_id, status, {_r('lat', 'lat')}, {_r('lon', 'lon')},
       {_r('speed', 'speed')}, {_r('fare', 'fare')}, epoch_us(event_ts) AS event_ts FROM clean"""
_Q["quarantine_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS rule, count(*) AS rejected FROM raw WHERE NOT coalesce({c}, false) HAVING count(*) > 0"
    for n, c in RULES)
_Q["zone_enrichment"] = "SELECT event_id, vehicle_id, status, epoch_us(event_ts) AS event_ts, zone, sim_day FROM ev"
_Q["zone_metrics_1min"] = f"SELECT {ZONE_COLS} FROM ({_zone_metrics(60_000_000)})"
_Q["zone_metrics_hourly"] = f"SELECT {ZONE_COLS} FROM ({_zone_metrics(3_600_000_000)})"
_Q["zone_metrics_daily"] = f"SELECT {ZONE_COLS} FROM ({_zone_metrics(86_400_000_000)})"
_Q["daily_earnings"] = f"SELECT vehicle_id, sim_day, {_r('total_fare', 'total_fare')}, trip_count FROM earnings"
_Q["vehicle_status_latest"] = f"""
SELECT vehicle_id, driver_id, {_r('lat', 'lat')}, {_r('lon', 'lon')}, {_r('speed', 'speed')}, status, zone,
       {_r('last_fare', 'last_fare')}, sim_day, status_since, updated_at FROM latest"""
_Q["status_spells"] = f"""
SELECT vehicle_id, run_id, status, start_us AS spell_start, end_us AS spell_end, last_us AS last_event_ts,
       n_events, is_current, {_r('duration_s', 'duration_s')} FROM spells"""
_Q["vehicle_day_activity"] = f"""
SELECT coalesce(e.vehicle_id, d.vehicle_id) AS vehicle_id, coalesce(e.sim_day, d.sim_day) AS sim_day,
       coalesce(e.trip_count, 0) AS trip_count, {_r('coalesce(d.km, 0e0)', 'distance_km')}
FROM earnings e FULL OUTER JOIN (
  SELECT vehicle_id, sim_day, sum(sqrt((lat - plat) * (lat - plat) + (lon - plon) * (lon - plon)) * {C.KM_PER_DEGREE}e0) AS km
  FROM (SELECT vehicle_id, sim_day, status, lat, lon,
               lag(lat) OVER w AS plat, lag(lon) OVER w AS plon
        FROM ev WINDOW w AS (PARTITION BY vehicle_id, sim_day ORDER BY event_ts, event_id))
  WHERE status IN ('enroute', 'on_trip') AND plat IS NOT NULL
  GROUP BY vehicle_id, sim_day) d
ON d.vehicle_id = e.vehicle_id AND d.sim_day = e.sim_day"""
_Q["vehicle_idle_seconds"] = f"""
SELECT vehicle_id, CAST(sim_day AS INTEGER) AS sim_day,
       {_r(f"sum(least(end_us, {START_US} + (CAST(sim_day AS BIGINT) + 1) * {DAY_US}) - greatest(start_us, {START_US} + CAST(sim_day AS BIGINT) * {DAY_US})) / 1000000e0", 'idle_seconds')}
FROM (SELECT vehicle_id, start_us, end_us,
             unnest(generate_series({_day('start_us')}, {_day('(end_us - 1)')})) AS sim_day
      FROM spells WHERE status = 'idle' AND end_us > start_us)
GROUP BY vehicle_id, sim_day"""

_Q["realtime_summary"] = f"""
SELECT CAST({CUR_DAY} AS INTEGER) AS sim_day, v.n AS active_vehicles,
       {_r(f"CASE WHEN v.n > 0 THEN round_even(v.idle / v.n, 3) ELSE 0e0 END", 'idle_ratio')}, t.n AS trips_recent
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE status = 'idle') AS idle FROM latest
      WHERE updated_at > {AS_OF_US - P.status_recency_s * 1_000_000}) v,
     (SELECT count(DISTINCT CASE WHEN trip_id <> '-' THEN trip_id END) AS n FROM ev
      WHERE epoch_us(event_ts) > {AS_OF_US - P.trip_recency_s * 1_000_000}) t"""
_Q["realtime_status"] = f"""
SELECT status, count(*) AS n FROM latest WHERE updated_at > {AS_OF_US - P.status_recency_s * 1_000_000} GROUP BY status"""
_Q["realtime_zones"] = f"""
SELECT {ZONE_COLS}, total_earnings > 0 AS earning FROM (
  SELECT *, row_number() OVER (PARTITION BY zone ORDER BY window_start DESC) AS rn
  FROM ({_zone_metrics(60_000_000)}) WHERE window_end > {AS_OF_US - P.zone_recency_s * 1_000_000}) WHERE rn = 1"""
_Q["daily_report"] = (f"SELECT vehicle_id, " + REPORT_COLS.split("sim_day, ", 1)[1]
                      + f" FROM report WHERE sim_day = {max(0, CUR_DAY - 1)} ORDER BY net_profit, vehicle_id")
_Q["daily_report_counts"] = """
SELECT sim_day, count(*) AS vehicle_count, count(*) FILTER (WHERE NOT profitable) AS unprofitable_count
FROM report GROUP BY sim_day"""
_Q["worst_best_k"] = f"""
SELECT sim_day, side, CAST(rank AS INTEGER) AS rank, vehicle_id, {_r('net_profit', 'net_profit')} FROM (
  SELECT sim_day, 'worst' AS side, row_number() OVER (PARTITION BY sim_day ORDER BY net_profit ASC, vehicle_id) AS rank,
         vehicle_id, net_profit FROM report
  UNION ALL
  SELECT sim_day, 'best', row_number() OVER (PARTITION BY sim_day ORDER BY net_profit DESC, vehicle_id),
         vehicle_id, net_profit FROM report) WHERE rank <= 4"""
_Q["profitability_summary"] = """
SELECT s.sim_day, coalesce(s.n, 0) AS vehicle_count, coalesce(s.p, 0) AS profitable_count,
       coalesce(s.u, 0) AS unprofitable_count,
       CASE WHEN coalesce(s.n, 0) > 0 THEN CAST(round(100e0 * s.p / s.n) AS INTEGER) END AS profitable_pct
FROM (SELECT 1) one LEFT JOIN (
  SELECT sim_day, count(*) AS n, count(*) FILTER (WHERE profitable) AS p, count(*) FILTER (WHERE NOT profitable) AS u
  FROM report WHERE sim_day = (SELECT max(sim_day) FROM report) GROUP BY sim_day) s ON true"""
_Q["income_trend_fleet"] = f"""
SELECT sim_day, {_r('total_fare', 'total_fare')}, trip_count, {_r('net_profit', 'net_profit')}, profitable
FROM ({TREND_FLEET})"""
_Q["income_trend_incremental"] = _Q["income_trend_fleet"]
_Q["income_trend_vehicle"] = f"""
SELECT vehicle_id, sim_day, {_r('total_fare', 'total_fare')}, trip_count, {_r('net_profit', 'net_profit')}, profitable
FROM (SELECT e.vehicle_id, e.sim_day, e.total_fare, e.trip_count, r.net_profit, r.profitable
      FROM earnings e LEFT JOIN report r ON r.vehicle_id = e.vehicle_id AND r.sim_day = e.sim_day)"""
_Q["income_trend_month"] = f"""
SELECT CAST(floor(sim_day / {C.DAYS_PER_MONTH}) AS INTEGER) AS month, {_r('sum(total_fare)', 'total_fare')},
       CAST(sum(trip_count) AS BIGINT) AS trip_count, {_r('coalesce(sum(net_profit), 0e0)', 'net_profit')},
       CASE WHEN bool_or(net_profit IS NOT NULL) THEN coalesce(sum(net_profit), 0e0) > 0 END AS profitable
FROM ({TREND_FLEET}) GROUP BY 1"""
_Q["income_total"] = f"""
SELECT {_r('coalesce(sum(total_fare), 0e0)', 'total_income')}, count(*) AS n_points FROM ({TREND_FLEET})"""
_Q["vehicles"] = "SELECT DISTINCT vehicle_id FROM latest ORDER BY vehicle_id"
_Q["pipeline_health"] = f"""
SELECT CAST({CUR_DAY} AS INTEGER) AS sim_day, t AS last_event_at, {_r(f'({AS_OF_US} - t) / 1000000e0', 'telemetry_lag_seconds')},
       CASE WHEN t IS NULL OR ({AS_OF_US} - t) / 1000000e0 > {P.staleness_threshold_s}e0 THEN 'degraded' ELSE 'healthy' END AS status,
       CAST({P.staleness_threshold_s} AS INTEGER) AS staleness_threshold_seconds
FROM (SELECT max(epoch_us(event_ts)) AS t FROM ev WHERE epoch_us(event_ts) <= {AS_OF_US})"""
_Q["alerts_recent"] = """
SELECT * FROM alerts ORDER BY created_at DESC, alert_type, entity_id LIMIT 200"""
_Q["alert_conditions"] = "SELECT * FROM cond"
_Q["metrics_gauges"] = f"""
SELECT {_r(f'({AS_OF_US} - (SELECT max(epoch_us(event_ts)) FROM ev WHERE epoch_us(event_ts) <= {AS_OF_US})) / 1000000e0',
           'telemetry_lag_seconds')},
       (SELECT count(*) FROM alerts WHERE NOT resolved) AS unresolved_alerts"""
_Q["alert_lifecycle"] = "SELECT * FROM alerts"
_ROUNDS = ("2", "1", "0")       # days before as_of; rounds of the alert log
_SAME = "{b}.alert_type = {a}.alert_type AND {b}.entity_id IS NOT DISTINCT FROM {a}.entity_id"


def _alert_rounds() -> str:
    """The alert table after each of three rounds, by recursion written out: an open alert
    that still fires stays as it is, one that fires no more is resolved, others are raised."""
    ctes, before = [], None
    for d in _ROUNDS:
        us = AS_OF_US - int(d) * DAY_REAL_US
        if d not in ("0", "1"):
            ctes += [_spells("d" + d, us), _conditions("d" + d, us)]
        cond = {"0": "cond", "1": "cond0"}.get(d, f"condd{d}")
        new = f"SELECT alert_type, severity, entity_id, message, {us} AS created_at, false AS resolved FROM {cond} c"
        if before is None:
            ctes.append(f"round{d} AS ({new})")
        else:
            ctes.append(f"""round{d} AS (
  SELECT alert_type, severity, entity_id, message, created_at,
         resolved OR NOT EXISTS (SELECT 1 FROM {cond} c WHERE {_SAME.format(a='p', b='c')}) AS resolved
  FROM {before} p
  UNION ALL {new} WHERE NOT EXISTS (SELECT 1 FROM {before} p WHERE NOT p.resolved AND {_SAME.format(a='c', b='p')}))""")
        before = f"round{d}"
    return ", " + ",".join(ctes) + " " + " UNION ALL ".join(
        f"SELECT *, CAST({d} AS INTEGER) AS days_before FROM round{d}" for d in _ROUNDS)


DAY_REAL_US = 86400 * 1_000_000
_Q["alert_lifecycle_as_of"] = _alert_rounds()
_Q["staleness_gaps"] = f"""
SELECT gap_start, gap_end, {_r('(gap_end - gap_start) / 1000000e0', 'gap_seconds')} FROM (
  SELECT epoch_us(event_ts) AS gap_start, lead(epoch_us(event_ts)) OVER (ORDER BY event_ts, event_id) AS gap_end FROM ev)
WHERE gap_end IS NOT NULL AND (gap_end - gap_start) / 1000000e0 > {P.staleness_threshold_s}e0"""
_Q["idle_spells"] = f"""
SELECT vehicle_id, start_us AS spell_start, end_us AS spell_end, {_r('duration_s', 'idle_seconds')}
FROM spells WHERE status = 'idle' AND duration_s > {P.idle_threshold_s}e0"""


def oracle_sql() -> dict[str, str]:
    from drover.streaming.registry import stream_oracles
    out = {k: BASE + v for k, v in _Q.items()}
    out.update({k: BASE + v for k, v in stream_oracles().items()})
    return out
