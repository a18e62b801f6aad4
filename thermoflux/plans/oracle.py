"""DuckDB oracle SQL for every registered query.

Written directly from the operator definitions (window functions, ASOF JOIN,
EXISTS, correlated subqueries) — deliberately a different formulation from the
Spark plans, so agreement is evidence.  Tables are the pre-registered views of
the fixture parquet files.  Epoch ms are ``epoch_us(ts) // 1000`` (truncating,
as Spark), not ``epoch_ms`` (which rounds).
"""

from __future__ import annotations

from thermoflux.sources import fixtures as fx

K = fx.K_MS
DELAY = 5 * K
LATENESS = 5 * K
STEP = 1 * K

READINGS = f"""readings AS (
  SELECT event_id, 'sensor_' || CAST(user_id AS VARCHAR) AS id,
         epoch_us(ts) // 1000 AS "timestamp", value * 2 AS temperature, event_type
  FROM events)"""

ARRIVAL = f"""arr AS (
  SELECT *, arrival // {K} AS tick FROM (
    SELECT *, "timestamp" + {K} * (CASE WHEN event_id % {fx.LATE_MODULUS} = 0
                                        THEN (event_id * {fx.LATE_MULTIPLIER}) % {fx.LATE_SPREAD}
                                        ELSE event_id % {fx.SMALL_DELAY_MODULUS} END) AS arrival
    FROM readings)),
ticks AS (SELECT tick, max("timestamp") AS tmax FROM arr GROUP BY tick),
wmt AS (SELECT tick, max(tmax) OVER (ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {DELAY} AS wm
        FROM ticks),
x AS (SELECT arr.*, wmt.wm FROM arr JOIN wmt USING (tick))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


READING_COLS = 'event_id, id, "timestamp", temperature'


def _on_time_counts(size: int) -> str:
    return _with(READINGS, ARRIVAL) + f"""
SELECT id, window_end, count(*) AS cnt FROM (
  SELECT id, "timestamp" - "timestamp" % {size} + {size} AS window_end, wm FROM x) t
WHERE wm IS NULL OR window_end > wm
GROUP BY id, window_end"""


UPDATING = _with(READINGS, ARRIVAL) + f"""
, s AS (
  SELECT id, event_id, arrival, e,
         CASE WHEN wm IS NULL OR e > wm THEN 0 WHEN wm < e + {LATENESS} THEN 1 ELSE 2 END AS st
  FROM (SELECT *, "timestamp" - "timestamp" % {10 * K} + {10 * K} AS e FROM x) t),
n0 AS (SELECT id, e, count(*) FILTER (WHERE st = 0) AS n0 FROM s GROUP BY id, e),
lt AS (SELECT id, e, row_number() OVER (PARTITION BY id, e ORDER BY arrival, event_id) AS i FROM s WHERE st = 1)
SELECT id, e AS window_end, n0 AS cnt, 'first' AS kind FROM n0 WHERE n0 > 0
UNION ALL
SELECT lt.id, lt.e AS window_end, CAST(n0.n0 + lt.i AS BIGINT) AS cnt,
       CASE WHEN n0.n0 = 0 AND lt.i = 1 THEN 'first' ELSE 'update' END AS kind
FROM lt JOIN n0 USING (id, e)"""

EARLY_FIRING = _with(READINGS, ARRIVAL) + f"""
, tw2 AS (SELECT tick, wm, lag(wm) OVER (ORDER BY tick) AS pwm FROM wmt),
crossing AS (SELECT tick AS k, wm AS wm_k FROM tw2
             WHERE wm IS NOT NULL AND (pwm IS NULL OR wm // {STEP} > pwm // {STEP})),
ot AS (SELECT id, tick, e FROM (SELECT *, "timestamp" - "timestamp" % {30 * K} + {30 * K} AS e FROM x) t
       WHERE wm IS NULL OR e > wm),
win AS (SELECT id, e, min(tick) AS f, count(*) AS total FROM ot GROUP BY id, e),
early AS (SELECT w.id, w.e, c.k, c.wm_k FROM win w JOIN crossing c ON c.k > w.f AND c.wm_k < w.e),
early_cnt AS (
  SELECT ea.id, ea.e AS window_end, ea.wm_k AS eval_time, count(ot.tick) AS cnt
  FROM early ea LEFT JOIN ot ON ot.id = ea.id AND ot.e = ea.e AND ot.tick < ea.k
  GROUP BY ea.id, ea.e, ea.k, ea.wm_k),
fin AS (
  SELECT w.id, w.e AS window_end,
         coalesce((SELECT min(wm) FROM wmt WHERE wm >= w.e), w.e) AS eval_time, w.total AS cnt
  FROM win w)
SELECT * FROM early_cnt UNION ALL SELECT * FROM fin"""

FIRE_ALERTS = _with(READINGS) + f"""
, sm AS (SELECT "timestamp" AS sts, arg_max(level, event_id) AS level FROM (
         SELECT event_id, "timestamp", CASE WHEN temperature > {fx.SMOKE_HIGH_ABOVE} THEN 'HIGH' ELSE 'LOW' END AS level
         FROM readings WHERE event_type = 'error') t GROUP BY "timestamp"),
r AS (SELECT * FROM readings WHERE event_type <> 'error' AND temperature > 100.0)
SELECT r.event_id,
       'Risk of fire!(' || r.id || ', ' || CAST(r."timestamp" AS VARCHAR) || ', '
         || CAST(r.temperature AS VARCHAR) || ')' AS message,
       r."timestamp", r.temperature
FROM r ASOF JOIN sm ON r."timestamp" >= sm.sts
WHERE sm.level = 'HIGH'"""

FORWARD_SWITCH = _with(READINGS) + f"""
, sw AS (SELECT id, "timestamp" AS sts,
                {K} * ({fx.SWITCH_BASE_UNITS} + (event_id % {fx.SWITCH_MODULUS}) * {fx.SWITCH_STEP_UNITS}) AS d
         FROM readings WHERE event_type = 'signup')
SELECT {READING_COLS} FROM readings r
WHERE event_type <> 'signup'
  AND EXISTS (SELECT 1 FROM sw WHERE sw.id = r.id AND sw.sts <= r."timestamp" AND sw.sts + sw.d > r."timestamp")"""

ORACLE_SQL: dict[str, str] = {
    "src_readings": _with(READINGS) + f"SELECT {READING_COLS} FROM readings",
    "src_smoke": f"""SELECT event_id, CASE WHEN value * 2 > {fx.SMOKE_HIGH_ABOVE} THEN 'HIGH' ELSE 'LOW' END AS level,
                            epoch_us(ts) // 1000 AS "timestamp" FROM events WHERE event_type = 'error'""",
    "filter_temp": _with(READINGS) + f"SELECT {READING_COLS} FROM readings WHERE temperature >= 25.0",
    "map_id": _with(READINGS) + "SELECT id FROM readings",
    "f_to_c": _with(READINGS) + """SELECT event_id, id, "timestamp",
        (temperature - 32) * (CAST(5.0 AS DOUBLE) / CAST(9.0 AS DOUBLE)) AS temperature FROM readings""",
    "split_id": _with(READINGS) + "SELECT unnest(string_split(id, '_')) AS part FROM readings",
    "freezing_main": _with(READINGS) + f"SELECT {READING_COLS} FROM readings",
    "freezing_alarms": _with(READINGS) + """SELECT event_id, 'Freezing Alarm for ' || id AS message
        FROM readings WHERE temperature < 32.0""",
    "avg_tumbling": _with(READINGS) + f"""SELECT id, window_end AS "timestamp", round(avg(c), 6) AS temperature FROM (
        SELECT id, "timestamp" - "timestamp" % {K} + {K} AS window_end,
               (temperature - 32) * (CAST(5.0 AS DOUBLE) / CAST(9.0 AS DOUBLE)) AS c FROM readings) t
        GROUP BY id, window_end""",
    "minmax_tumbling": _with(READINGS) + f"""SELECT id, min(temperature) AS "min", max(temperature) AS "max",
        endTs AS "endTs" FROM (SELECT id, temperature, "timestamp" - "timestamp" % {5 * K} + {5 * K} AS endTs
        FROM readings) t GROUP BY id, endTs""",
    "count_tumbling": _on_time_counts(10 * K),
    "late_side_output": _with(READINGS, ARRIVAL) + f"""SELECT {READING_COLS} FROM x
        WHERE "timestamp" - "timestamp" % {10 * K} + {10 * K} <= wm""",
    "late_filter_main": _with(READINGS, ARRIVAL) + f"""SELECT {READING_COLS} FROM x
        WHERE wm IS NULL OR NOT ("timestamp" < wm - 1)""",
    "late_filter_late": _with(READINGS, ARRIVAL) + f"""SELECT {READING_COLS} FROM x
        WHERE wm IS NOT NULL AND "timestamp" < wm - 1""",
    "updating_count": UPDATING,
    "custom_window_count": _on_time_counts(30 * K),
    "early_firing_count": EARLY_FIRING,
    "rolling_sum": """SELECT event_id, user_id AS k, CAST(sum(event_id % 100) OVER w AS BIGINT) AS v,
        first_value(event_id % 7) OVER w AS c FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "rolling_max": _with(READINGS) + """SELECT event_id, id, best.ts AS "timestamp", best.t AS temperature FROM (
        SELECT event_id, id, max({'t': temperature, 's': event_id, 'ts': "timestamp"}) OVER (
            PARTITION BY id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best
        FROM readings) t""",
    "fire_alerts": FIRE_ALERTS,
    "forward_switch": FORWARD_SWITCH,
}
