"""The SQL twin of each batch query, for the same parquet tables."""

from __future__ import annotations


_STATE = """CASE WHEN event_type IN ('view', 'click') THEN 'OPEN'
                 WHEN event_type IN ('signup', 'purchase') THEN 'CLOSE' ELSE 'OBSTRUCTED' END"""
_READING = "SELECT ts, user_id AS sensor_id, 'CELSIUS' AS units, value, event_id AS seq FROM events"
_TIED = ("SELECT ts, user_id AS sensor_id, 'CELSIUS' AS units, CAST(floor(value / 50) AS DOUBLE) AS value, "
         "event_id AS seq FROM events")
_DAY = 86_400_000_000


def _start(width: int, shift: str = "0") -> str:
    return f"make_timestamp((epoch_us(ts) // {width} - {shift}) * {width})"


def _rounded(expression: str) -> str:
    return f"round(({expression}) + 1e-9::DOUBLE, 6)"


SQL: dict[str, str] = {}

SQL["word_count"] = r"""
SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM documents)
WHERE word <> '' GROUP BY word
"""
SQL["word_count_changelog"] = r"""
WITH texts AS (
    SELECT doc_id AS seq,
           list_filter(regexp_split_to_array(lower(text), '\W+'), lambda word: word <> '') AS words
    FROM documents),
placed AS (SELECT seq, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM texts)
SELECT seq, pos, word, row_number() OVER (PARTITION BY word ORDER BY seq, pos) AS count FROM placed
"""
SQL["to_fahrenheit"] = f"""
SELECT ts, sensor_id, 'FAHRENHEIT' AS units, value * 1.8::DOUBLE + 32.0::DOUBLE AS value, seq
FROM ({_READING})
"""
SQL["fahrenheit_and_celsius"] = f"""
SELECT ts, sensor_id, units, value, seq FROM ({_READING})
UNION ALL {SQL['to_fahrenheit']}
"""
SQL["heat_alerts"] = f"SELECT ts, sensor_id, units, value, 2 AS level, seq FROM ({_READING}) WHERE value > 150"
SQL["tag_readings"] = f"""
SELECT CASE WHEN seq % 2 = 0 THEN 'PRIMARY' ELSE 'SECONDARY' END AS type, * FROM ({_READING})
"""
SQL["vehicle_activity"] = "SELECT user_id // 10 AS vehicle_id, 1 AS moving, ts FROM events"


def _best(source: str, order: str) -> str:
    return f"""
SELECT ts, sensor_id, units, value, seq
FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY {order}) AS place FROM ({source}))
WHERE place = 1
"""


SQL["latest_observation"] = _best(_READING, "ts DESC, seq")
SQL["latest_observation_of_sensor"] = f"SELECT * FROM ({SQL['latest_observation']}) WHERE sensor_id = 7"
SQL["max_reading_last"] = _best(_TIED, "value DESC, seq DESC")
SQL["max_reading_first"] = _best(_TIED, "value DESC, seq")


def _changelog(source: str, first: str, second: str) -> str:
    """For each record the best of the records up to it."""
    return f"""
WITH readings AS ({source}),
marked AS (
    SELECT *, arg_max(seq, struct_pack(a := {first}, b := {second})) OVER (
        PARTITION BY sensor_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS best_seq
    FROM readings)
SELECT m.seq AS at_seq, r.ts, r.sensor_id, r.units, r.value, r.seq
FROM marked m JOIN readings r ON r.sensor_id = m.sensor_id AND r.seq = m.best_seq
"""


SQL["max_changelog_last"] = _changelog(_TIED, "value", "seq")
SQL["max_changelog_first"] = _changelog(_TIED, "value", "-seq")
SQL["max_changelog_first_sliced"] = SQL["max_changelog_first"]
SQL["latest_changelog"] = _changelog(_READING, "ts", "-seq")


def _running(partition: str, extra: str = "") -> str:
    over = f"OVER ({partition} ORDER BY seq ROWS UNBOUNDED PRECEDING)"
    return f"""
SELECT seq, sensor_id, last_ts AS ts, {_rounded('total / n')} AS mean
FROM (SELECT *, max(ts) {over} AS last_ts, sum(value) {over} AS total, count(*) {over} AS n
      FROM ({_READING})) {extra}
"""


SQL["running_mean"] = _running("PARTITION BY sensor_id")
SQL["running_mean_sliced"] = SQL["running_mean"]
SQL["running_mean_every_third"] = _running("PARTITION BY sensor_id", "WHERE n % 3 = 0")
SQL["running_mean_all_sensors"] = _running("")

SQL["sliding_mean"] = f"""
SELECT user_id AS sensor_id, max(ts) AS ts, {_rounded('avg(value)')} AS mean,
       window_start, window_start + INTERVAL 2 DAY AS window_end
FROM (SELECT *, {_start(_DAY)} AS window_start FROM events
      UNION ALL SELECT *, {_start(_DAY, '1')} FROM events)
GROUP BY user_id, window_start
"""


def _deviation(first: str) -> str:
    return f"""
SELECT window_start + INTERVAL 3 DAY AS ts, sensor_id, 'SENSOR DIFF CELSIUS' AS units,
       {_rounded('deviation')} AS value, 2 AS level
FROM (SELECT user_id AS sensor_id, {_start(3 * _DAY)} AS window_start,
             abs({first} - avg(value) FILTER (event_id % 2 = 1)) AS deviation
      FROM events GROUP BY ALL)
WHERE deviation > 20
"""


SQL["sensor_deviation"] = _deviation("avg(value) FILTER (event_id % 2 = 0)")
SQL["sensor_deviation_compat"] = _deviation("avg(value)")
SQL["valve_performance"] = f"""
WITH grouped AS (
    SELECT user_id AS sensor_id, {_start(5 * _DAY)} AS window_start,
           count(*) FILTER (event_id % 2 = 1)::DOUBLE AS states,
           count(*) FILTER (event_id % 2 = 1 AND event_type IN ('view', 'click')) AS opened,
           count(*) FILTER (event_id % 2 = 1 AND event_type IN ('signup', 'purchase')) AS closed,
           count(*) FILTER (event_id % 2 = 1 AND event_type = 'error') AS obstructed,
           count(*) FILTER (event_id % 2 = 0) AS readings,
           avg(value) FILTER (event_id % 2 = 0) AS mean_temperature
    FROM events GROUP BY ALL)
SELECT sensor_id, window_start, window_start + INTERVAL 5 DAY AS window_end,
       {_rounded('opened / states')} AS pct_open, {_rounded('closed / states')} AS pct_closed,
       {_rounded('obstructed / states')} AS pct_obstructed, {_rounded('mean_temperature')} AS mean_temperature
FROM grouped WHERE states > 0 AND readings > 0
"""
SQL["edit_bytes_per_user"] = f"""
SELECT CAST(user_id AS VARCHAR) AS "user", CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS bytes,
       {_start(_DAY)} AS window_start, {_start(_DAY)} + INTERVAL 1 DAY AS window_end
FROM events GROUP BY user_id, window_start
"""

_PAIRS = f"""
SELECT m.ts, m.user_id AS sensor_id, 'CELSIUS' AS units, m.value, m.event_id AS seq,
       v.ts AS state_ts, v.state, v.event_id AS state_seq
FROM (SELECT * FROM events WHERE event_id % 2 = 0) m
JOIN (SELECT *, {_STATE} AS state FROM events WHERE event_id % 2 = 1) v
  ON m.user_id = v.user_id AND epoch_us(m.ts) // {_DAY} = epoch_us(v.ts) // {_DAY}
 AND m.ts > v.ts AND epoch_us(m.ts) - epoch_us(v.ts) < {_DAY // 2}
"""
SQL["state_at_reading"] = _PAIRS
_HOT_PAIRS = (f"SELECT * FROM ({_PAIRS}) WHERE (value > 60 AND state = 'OPEN') "
              "OR (value > 80 AND state = 'CLOSE')")
_BLOCKED_PAIRS = f"SELECT * FROM ({_PAIRS}) WHERE state = 'OBSTRUCTED'"


def _pair_alerts(source: str, units: str, level: int) -> str:
    return (f"SELECT ts, sensor_id, 'MALFUNCTIONING {units}' AS units, value, {level} AS level, seq, state_seq "
            f"FROM ({source})")


SQL["obstructed_alerts"] = _pair_alerts(_BLOCKED_PAIRS, "OBSTRUCTED", 3)
SQL["state_alerts"] = _pair_alerts(_HOT_PAIRS, "TEMPERATURE", 2) + " UNION ALL " + SQL["obstructed_alerts"]
SQL["state_alerts_compat"] = (
    _pair_alerts(_HOT_PAIRS, "TEMPERATURE", 2) + " UNION ALL " + _pair_alerts(_HOT_PAIRS, "OBSTRUCTED", 3))

SQL["with_owner"] = """
SELECT e.user_id // 10 AS vehicle_id, 1 AS moving, e.ts, c.c_name AS owner_name,
       c.c_custkey % 5 = 0 AS reported_stolen
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id // 10
"""
SQL["stolen_vehicles"] = f"""
SELECT vehicle_id, ts, owner_name, reported_stolen FROM ({SQL['with_owner']}) WHERE reported_stolen
"""


SQL["owner_names"] = """
SELECT c_custkey AS vehicle_id, c_name AS owner_name, c_custkey % 5 = 0 AS reported_stolen FROM customer
"""
_REPORTS = """
SELECT ts, user_id // 10 AS vehicle_id, 'user ' || user_id AS customer_name,
       CASE event_type WHEN 'error' THEN 'BROKEN_DOWN' WHEN 'signup' THEN 'DISSATISFIED'
            ELSE 'SATISFIED' END AS value, event_id AS seq
FROM events
"""
SQL["with_owner_name"] = f"""
SELECT r.ts, r.vehicle_id, c.c_name AS customer_name, r.value, r.seq
FROM ({_REPORTS}) r LEFT JOIN customer c ON c.c_custkey = r.vehicle_id
"""
SQL["with_sensor_reference"] = f"""
SELECT r.*, s.s_acctbal AS lon, CAST(s.s_nationkey AS DOUBLE) AS lat, s.s_name AS important_metadata,
       lower(s.s_name) AS more_important_metadata
FROM ({_READING}) r LEFT JOIN supplier s ON s.s_suppkey = r.sensor_id
"""


def _valves(observed: str, hot: float, times: int, longest: bool = False, order: str = "ts, seq", ttl: str = "") -> str:
    """Gaps and islands: number the runs by the rows outside the closure states."""
    pick = """
    QUALIFY row_number() OVER (PARTITION BY sensor_id, run_end ORDER BY times DESC) = 1""" if longest else ""
    return f"""
WITH observed AS ({observed}),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY {order}) AS pos,
           state IN ('CLOSE', 'OBSTRUCTED') AS closed
    FROM observed),
ends AS (
    SELECT *, min(CASE WHEN NOT closed THEN pos END) OVER (
        PARTITION BY sensor_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS run_end
    FROM placed),
heats AS (
    SELECT sensor_id, pos, min(CASE WHEN value > {hot} THEN pos END) OVER (
        PARTITION BY sensor_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heat_pos
    FROM placed),
starts AS (
    SELECT sensor_id, ts, seq, run_end, run_end - pos - 1 AS times
    FROM ends WHERE state IN ('OPEN', 'CLOSE') AND run_end - pos - 1 >= {times}{pick})
SELECT h.ts, s.sensor_id, 'MALFUNCTIONING NOT OPENING TIMES ' || s.times AS units, h.value, 5 AS level, s.seq
FROM starts s
JOIN heats t ON t.sensor_id = s.sensor_id AND t.pos = s.run_end
JOIN placed h ON h.sensor_id = s.sensor_id AND h.pos = t.heat_pos {ttl}
"""


def _loose_valves(observed: str, hot: float, times: int) -> str:
    """Number the closures of a sensor: the one a start needs has the start's number and ``times`` more."""
    over = "OVER (PARTITION BY sensor_id ORDER BY ts, seq"
    return f"""
WITH observed AS ({observed}),
placed AS (
    SELECT *, row_number() {over}) AS pos, state IN ('CLOSE', 'OBSTRUCTED') AS closed,
           count(*) FILTER (state IN ('CLOSE', 'OBSTRUCTED')) {over} ROWS UNBOUNDED PRECEDING) AS n,
           lead(state) {over}) IN ('CLOSE', 'OBSTRUCTED') AS led
    FROM observed),
heats AS (
    SELECT *, min(CASE WHEN value > {hot} AND NOT closed THEN pos END) OVER (
        PARTITION BY sensor_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS heat_pos
    FROM placed)
SELECT h.ts, s.sensor_id, 'MALFUNCTIONING NOT OPENING TIMES ' || (h.n - s.n) AS units, h.value, 5 AS level, s.seq
FROM placed s
JOIN heats k ON k.sensor_id = s.sensor_id AND k.closed AND k.n = s.n + {times}
JOIN placed h ON h.sensor_id = s.sensor_id AND h.pos = k.heat_pos
WHERE s.state IN ('OPEN', 'CLOSE') AND s.led
"""


_OBSERVED = f"SELECT ts, user_id AS sensor_id, value, {_STATE} AS state, event_id AS seq FROM events"
SQL["dangerous_valves"] = _valves(_OBSERVED, 60, 5)
SQL["dangerous_valves_sliced"] = SQL["dangerous_valves"]
SQL["dangerous_valves_ttl"] = _valves(_OBSERVED, 60, 5, ttl="WHERE h.ts < s.ts + INTERVAL 4 DAY")
SQL["dangerous_valves_compat"] = _loose_valves(_OBSERVED, 60, 5)
SQL["dangerous_valves_compat_sliced"] = SQL["dangerous_valves_compat"]
SQL["dangerous_valves_longest"] = _valves(_OBSERVED, 60, 5, longest=True)

_ALERTS = f"SELECT ts, sensor_id, units, value, 2 AS level, seq FROM ({_READING}) WHERE value > 100"


def _causes(alerts: str) -> str:
    over = "OVER (PARTITION BY vehicle_id ORDER BY ts, kind, seq, tie ROWS UNBOUNDED PRECEDING)"
    return f"""
WITH tagged AS (
    SELECT vehicle_id, ts, 0 AS kind, seq, '' AS tie,
           struct_pack(ts := ts, name := customer_name, value := value) AS report, NULL AS alert
    FROM ({_REPORTS}) WHERE value IN ('BROKEN_DOWN', 'DISSATISFIED')
    UNION ALL
    SELECT sensor_id // 10, ts, 1, seq, units, NULL,
           struct_pack(ts := ts, sensor_id := sensor_id, units := units, value := value, level := level)
    FROM ({alerts})),
seen AS (
    SELECT vehicle_id, last_value(report IGNORE NULLS) {over} AS r, last_value(alert IGNORE NULLS) {over} AS a
    FROM tagged)
SELECT vehicle_id, r.ts AS report_ts, r.name AS customer_name, r.value AS report_value, a.ts AS alert_ts,
       a.sensor_id AS sensor_id, a.units AS units, a.value AS alert_value, a.level AS level
FROM seen WHERE abs(epoch_us(r.ts) - epoch_us(a.ts)) < {2 * _DAY}
"""


SQL["potential_causes"] = _causes(_ALERTS)
SQL["potential_causes_sliced"] = SQL["potential_causes"]
SQL["potential_causes_sql"] = f"""
SELECT c.vehicle_id, c.customer_name, c.value AS report_value, c.ts AS report_time,
       a.sensor_id, a.units, a.value AS alert_value, a.level
FROM ({_REPORTS}) c, ({_ALERTS}) a
WHERE c.vehicle_id = a.sensor_id // 10 AND c.value IN ('BROKEN_DOWN', 'DISSATISFIED')
  AND a.ts BETWEEN c.ts - INTERVAL 1 DAY AND c.ts + INTERVAL 1 DAY
"""
SQL["latest_per_vehicle"] = f"""
WITH r AS (SELECT * FROM ({_REPORTS}) WHERE value IN ('BROKEN_DOWN', 'DISSATISFIED')
           QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC, seq DESC) = 1),
a AS (SELECT *, sensor_id // 10 AS vehicle_id FROM ({_ALERTS})
      QUALIFY row_number() OVER (PARTITION BY sensor_id // 10 ORDER BY ts DESC, seq DESC) = 1)
SELECT vehicle_id, r.ts AS report_ts, r.customer_name, r.value AS report_value, a.ts AS alert_ts,
       a.sensor_id, a.units, a.value AS alert_value, a.level
FROM r FULL JOIN a USING (vehicle_id)
"""
SQL["pattern_alerts"] = _valves(_PAIRS, 60, 2, order="ts, seq, state_seq")
SQL["customer_service"] = _causes(SQL["pattern_alerts"])


def turn(turns: int) -> str:
    """The part of the arrival order that an event is in."""
    return ("(event_id - (SELECT min(event_id) FROM events)) * %d // "
            "((SELECT max(event_id) - min(event_id) FROM events) + 1)" % turns)


def of_turn(text: str, number: int, turns: int) -> str:
    """A query over the events of one part only."""
    return text.replace("FROM events", f"FROM (SELECT * FROM events WHERE {turn(turns)} = {number})")


PROCESSING_TIME_WINDOWS = f"""
WITH clocked AS (
    SELECT *, TIMESTAMP '2026-01-01 00:00:00' + INTERVAL 7 SECOND * ({{turn}}) AS now FROM events),
placed AS (
    SELECT *, make_timestamp(epoch_us(now) // 5000000 * 5000000) - INTERVAL 5 SECOND * k AS window_start
    FROM clocked, range(2) t(k))
SELECT user_id AS sensor_id, max(ts) AS ts, {_rounded('avg(value)')} AS mean, window_start,
       window_start + INTERVAL 10 SECOND AS window_end
FROM placed GROUP BY user_id, window_start
"""


_BACKWARDS = f"""
SELECT ts, sensor_id, units, value,
       low + (block * room + 8) // 9 + ((block + 1) * room + 8) // 9 - 1 - (seq - low) AS seq
FROM (SELECT *, (seq - low) * 9 // room AS block FROM ({_READING}),
             (SELECT min(event_id) AS low, max(event_id) - min(event_id) + 1 AS room FROM events))
"""


def late(which: str) -> str:
    return f"""
SELECT ts, sensor_id, units, value, seq FROM (
    SELECT *, coalesce((epoch_us(ts) // {_DAY} + 1) * {_DAY} <= max(epoch_us(ts)) OVER (
        ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {_DAY}, false) AS late
    FROM ({_BACKWARDS}))
WHERE {which}
"""


SQL["late_records"] = late("late")
SQL["late_records_sliced"] = SQL["late_records"]
