"""The registered queries as plain SQL over the same tables, for checking results with another engine."""

from __future__ import annotations


def r6(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38, 12)), 6) AS DOUBLE)"


def r2(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38, 8)), 2) AS DOUBLE)"


def half_even3(expr: str) -> str:
    return f"CAST(round_even(CAST({expr} AS DECIMAL(38, 9)), 3) AS DOUBLE)"


def quadrant(time: str) -> str:
    return (
        f"CASE WHEN hour({time}) BETWEEN 8 AND 11 THEN 1 WHEN hour({time}) BETWEEN 12 AND 15 THEN 2 "
        f"WHEN hour({time}) BETWEEN 16 AND 19 THEN 3 ELSE 4 END"
    )


def window_start(time: str) -> str:
    return (
        f"(date_trunc('day', {time}) + to_hours(CASE WHEN hour({time}) < 8 THEN -4 WHEN hour({time}) < 12 THEN 8 "
        f"WHEN hour({time}) < 16 THEN 12 WHEN hour({time}) < 20 THEN 16 ELSE 20 END))"
    )


READINGS = """
readings AS MATERIALIZED (
  SELECT round_id || '|' || observable_name || '|' || CAST(CAST(time AS DATE) AS VARCHAR) AS file_id, *,
         observable_name AS observable_id,
         CASE WHEN observable_name IN ('good_droppings', 'bad_droppings') THEN 'anomaly' ELSE 'ambient_condition' END AS obs_type
  FROM (SELECT 'pc' || CAST(user_id % 3 AS VARCHAR) AS round_id, 'rb' || CAST(user_id % 3 AS VARCHAR) AS robot_id,
               CASE event_type WHEN 'view' THEN 'temperature' WHEN 'click' THEN 'humidity' WHEN 'purchase' THEN 'airspeed'
                               WHEN 'signup' THEN 'good_droppings' ELSE 'bad_droppings' END AS observable_name,
               CAST(ts AS TIMESTAMP) AS time, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 5 - 1 AS x,
               CAST(user_id % 4 AS INT) AS y, 0 AS z, CASE event_type WHEN 'purchase' THEN value / 100.0 ELSE value END AS value,
               3 AS x_dim, 3 AS y_dim
        FROM events)
),
spans AS (SELECT round_id, min(time) AS lo, max(time) AS hi FROM readings GROUP BY round_id),
lap_starts AS (
  SELECT round_id, CAST(i AS INT) AS i, date_trunc('day', lo) + to_hours(CAST(8 * i AS INT)) AS time
  FROM (SELECT *, unnest(generate_series(0, (epoch_us(hi) - epoch_us(date_trunc('day', lo))) // 28800000000)) AS i FROM spans)
),
round_counter AS MATERIALIZED (
  SELECT round_id, time, i + 1 AS round_number, CASE WHEN i % 7 = 3 THEN 0 ELSE 1 END AS is_valid_round FROM lap_starts
  UNION ALL SELECT round_id, time + INTERVAL 2 HOUR, i + 1, 0 FROM lap_starts WHERE i % 5 = 4
),
dim_cycle AS (SELECT round_id AS id, CAST(lo AS DATE) + 2 AS "from" FROM spans),
robot_observable AS (
  SELECT DISTINCT robot_id, observable_id FROM readings WHERE NOT (robot_id = 'rb2' AND observable_id = 'airspeed')
),
halves AS (
  SELECT round_id, date_trunc('day', make_timestamp((epoch_us(lo) // 1000000 + epoch_us(hi) // 1000000) // 2 * 1000000)) AS split FROM spans
)
"""

FILE_ID = "round_id || '|' || observable_name || '|' || CAST(CAST(time AS DATE) AS VARCHAR)"
SHORT_FILE_ID = f"{FILE_ID} || '|' || CAST(hour(time) // 4 AS VARCHAR)"
SHORT_READINGS = READINGS.replace(FILE_ID, SHORT_FILE_ID)

LAPS = """
counter_minute AS (
  SELECT round_id, minute, c.t AS lap_time, c.n AS round_number, c.v AS is_valid_round
  FROM (SELECT round_id, date_trunc('minute', time) AS minute, max({'t': time, 'n': round_number, 'v': is_valid_round}) AS c
        FROM round_counter GROUP BY ALL)
),
row_laps AS MATERIALIZED (
  SELECT r.*, c.round_number AS row_lap, c.is_valid_round AS row_valid, c.lap_time
  FROM (SELECT *, date_trunc('minute', time) AS minute FROM readings) r
  ASOF LEFT JOIN counter_minute c ON r.round_id = c.round_id AND r.minute >= c.minute
),
files AS MATERIALIZED (
  SELECT file_id, round_id, robot_id, observable_name, observable_id, obs_type, count(*) AS readings, min(time) AS first_time,
         max(time) AS last_time, (epoch_us(max(time)) - epoch_us(min(time))) // 1000000 AS span_seconds,
         stddev_samp(value) AS value_sd, stddev_samp(x) AS x_sd, stddev_samp(y) AS y_sd
  FROM readings GROUP BY ALL
),
suspects AS (
  SELECT file_id FROM files
  WHERE readings < 2 OR ((coalesce(value_sd < 0.01, FALSE) OR coalesce(x_sd = 0 AND y_sd = 0, FALSE)) AND span_seconds >= 600)
),
file_ends AS (
  SELECT f.*, s.round_number AS first_lap, e.round_number AS last_lap, e.is_valid_round AS last_valid
  FROM files f ASOF LEFT JOIN round_counter s ON f.round_id = s.round_id AND f.first_time >= s.time
  ASOF LEFT JOIN round_counter e ON f.round_id = e.round_id AND f.last_time >= e.time
),
checked AS MATERIALIZED (
  SELECT f.*, CASE WHEN first_lap = last_lap THEN last_lap END AS file_round_number,
         CASE WHEN p.robot_id IS NULL THEN 'observable_not_available' WHEN f.file_id IN (FROM suspects) THEN 'suspicious_data'
              WHEN first_lap IS NULL OR last_lap IS NULL THEN 'round_not_in_range'
              WHEN first_lap = last_lap AND last_valid = 0 THEN 'round_not_valid' END AS verdict,
         CAST(date_diff('day', c."from", CAST(last_time AS DATE)) AS INT) AS day_of_production
  FROM file_ends f LEFT JOIN robot_observable p USING (robot_id, observable_id) LEFT JOIN dim_cycle c ON c.id = f.round_id
),
assigned AS MATERIALIZED (
  SELECT r.*, coalesce(f.file_round_number, r.row_lap) AS round_number, f.day_of_production
  FROM row_laps r JOIN checked f USING (file_id)
  WHERE f.verdict IS NULL AND (f.file_round_number IS NOT NULL OR r.row_valid = 1)
)
"""

CELLS = """
cells AS MATERIALIZED (
  SELECT x, y, z, round_number, CASE obs_type WHEN 'anomaly' THEN coalesce(sum(value), 0) ELSE sum(value) / count(value) END AS value,
         make_timestamp(CAST(sum(epoch_us(time)) // count(*) // 1000000 * 1000000 AS BIGINT)) AS time, round_id,
         (min({'t': date_trunc('second', time), 'd': day_of_production})).d AS day_of_production, observable_name, obs_type
  FROM assigned GROUP BY round_id, observable_name, obs_type, round_number, x, y, z
),
earlier AS MATERIALIZED (SELECT c.* FROM cells c JOIN halves USING (round_id) WHERE time < split)
"""


def last_rows(cells: str) -> str:
    return (
        "SELECT round_id, observable_name, max({'t': time, 'n': round_number}).n AS last_round_number, "
        f"max({{'t': time, 'n': day_of_production}}).n AS last_day, max(time) AS last_time FROM {cells} GROUP BY ALL"
    )


def space(source: str, keys: str, extra: str) -> str:
    return (
        "SELECT CASE obs_type WHEN 'ambient_condition' THEN avg(value) END AS mean, stddev_samp(value) AS sd, "
        f"CASE obs_type WHEN 'anomaly' THEN sum(value) END AS total, {extra}, {keys} FROM {source} GROUP BY {keys}"
    )


def rollup_ctes(cells: str, p: str) -> str:
    """Roll-ups of ``cells`` from their start; table names get the prefix ``p``."""
    value = f"CASE obs_type WHEN 'ambient_condition' THEN {r2('sum(value) / count(value)')} ELSE max(value) END"
    key = "round_id, observable_name, obs_type"
    return f"""
{p}last AS ({last_rows(cells)}),
{p}rounds AS (
  SELECT value, time, x, y, z, round_id, round_number, observable_name, obs_type FROM {cells} JOIN {p}last USING (round_id, observable_name)
  WHERE day_of_production >= 0 AND round_number >= 0 AND round_number < last_round_number
),
{p}rounds_space AS ({rounds_space(f'{p}rounds')}),
{p}days AS (
  SELECT {value} AS value, date_trunc('day', min(time)) + INTERVAL 12 HOUR AS time, x, y, min(z) AS z, round_id,
         day_of_production AS day, observable_name, obs_type
  FROM {cells} JOIN {p}last USING (round_id, observable_name)
  WHERE day_of_production >= 0 AND day_of_production < last_day AND x <> -1 GROUP BY {key}, day_of_production, x, y
),
{p}days_space AS ({space(f'{p}days', f'{key}, day', 'max(time) AS time')}),
{p}windows AS (
  SELECT *, {window_start('time')} AS window_start FROM {cells} JOIN {p}last USING (round_id, observable_name)
  WHERE day_of_production >= 0 AND {window_start('time')} < {window_start('last_time')}
),
{p}tods AS (
  SELECT {value} AS value, window_start + to_hours(CASE WHEN hour(window_start) = 20 THEN 6 ELSE 2 END) AS time, x, y, min(z) AS z,
         round_id, max(day_of_production) AS day, {quadrant('window_start')} AS time_of_day, observable_name, obs_type, window_start
  FROM {p}windows WHERE x <> -1 GROUP BY {key}, window_start, x, y
),
{p}tods_space AS ({space(f'{p}tods', f'{key}, time_of_day, window_start', 'max(time) AS time, max(day) AS day')}),
{p}hours AS ({hours(cells, 'TRUE')})
"""


def rounds_space(rounds: str) -> str:
    units = space(rounds, "round_id, observable_name, obs_type, round_number", "min(time) AS lo, max(time) AS hi")
    return (
        "SELECT mean, sd, total, coalesce(lap_time, make_timestamp((epoch_us(lo) // 1000000 + epoch_us(hi) // 1000000) // 2 * 1000000)) AS time, "
        f"round_number, round_id, observable_name, obs_type FROM ({units}) LEFT JOIN "
        "(SELECT round_id, round_number, max(time) AS lap_time FROM round_counter WHERE is_valid_round = 1 GROUP BY ALL) "
        "USING (round_id, round_number)"
    )


def hours(cells: str, condition: str) -> str:
    return f"""
  SELECT {r2('avg(value)')} AS mean, CASE obs_type WHEN 'ambient_condition' THEN {r2('stddev_pop(value)')} END AS sd,
         CASE obs_type WHEN 'anomaly' THEN {r2('sum(value)')} END AS total, date_trunc('hour', time) AS time,
         max(round_number) AS round_number, max(day_of_production) AS day, round_id, observable_name, obs_type
  FROM {cells} WHERE day_of_production >= 0 AND {condition} GROUP BY round_id, observable_name, obs_type, date_trunc('hour', time)
"""


LATEST = """
latest AS (
  SELECT arg_max(value, {'t': time, 'n': round_number}) AS value, max(time) AS time, x, y, z, round_id, observable_name, obs_type
  FROM cells WHERE day_of_production >= 0 GROUP BY round_id, observable_name, obs_type, x, y, z
)
"""

ROLLUPS = rollup_ctes("cells", "")
EARLIER = rollup_ctes("earlier", "e_")
STATS = f"{r6('mean')} AS mean, {r6('sd')} AS sd, {r6('total')} AS total"
KEY = "round_id, observable_name, obs_type"
SHOWN = "CASE obs_type WHEN 'ambient_condition' THEN mean ELSE total END"


def with_ctes(body: str, *ctes: str) -> str:
    return f"WITH {','.join(ctes)} {body}"


def over(body: str, *more: str) -> str:
    return with_ctes(body, READINGS, LAPS, CELLS, *more)


def points(source: str, event: str, time: str, pattern: str, unit: str) -> str:
    return over(
        f"SELECT {KEY}, '{event}' AS event_type, {time} AS time, strftime({time}, '{pattern}') AS date, "
        f"{r6(f'arg_min({SHOWN}, {unit})')} AS value FROM {source} GROUP BY {KEY}, {time}",
        ROLLUPS,
    )


def calendar(unit: str, expr: str) -> str:
    return over(
        f"SELECT {KEY}, '{unit}' AS event_type, min(time) AS time, strftime(min(time), '%Y-%m-%d') AS date, "
        f"{r6(f'arg_min({SHOWN}, time)')} AS value FROM hours GROUP BY {KEY}, year(time), {expr}",
        ROLLUPS,
    )


def matrix(cells: str, units: str, unit: str, label: str, day: str, zero_is_missing: bool = False, *more: str) -> str:
    value = "nullif(value, 0)" if zero_is_missing else "value"
    unit = f"{unit}, " if unit else ""
    grid = (
        f"SELECT u.*, gx.x, gy.y FROM (SELECT {KEY}, {unit}time, {day} AS day, {label} AS label FROM {units}) u, "
        "(SELECT CAST(unnest(range(4)) AS INT) AS x) gx, (SELECT CAST(unnest(range(4)) AS INT) AS y) gy"
    )
    return over(
        f"SELECT g.*, p.value FROM ({grid}) g "
        f"LEFT JOIN (SELECT {KEY}, {unit}x, y, {r6(half_even3(f'CASE WHEN {value} < 0 THEN 0 ELSE {value} END'))} AS value "
        f"FROM (SELECT {KEY}, {unit}x, y, arg_max(value, {{'t': time, 'z': z}}) AS value FROM {cells} "
        f"WHERE x >= 0 AND y >= 0 GROUP BY ALL)) p USING ({KEY}, {unit}x, y)",
        LATEST,
        ROLLUPS,
        *more,
    )


DAY_OF = "(SELECT CAST(date_diff('day', \"from\", CAST(time AS DATE)) AS INT) FROM dim_cycle WHERE id = round_id)"
ALIGNED = "aligned AS MATERIALIZED (SELECT * REPLACE (date_trunc('day', time) AS time) FROM cells)"

# Coefficients of the formulas.
FORMULAS = {
    "humidex": (
        ["temperature", "humidity"],
        "temperature + ((6.112 * pow(7.5 * temperature / (237.7 + temperature), 10) * (humidity / 100.0)) - 10) * (5.0 / 9.0)",
    ),
    "heat_stress_index": (["temperature", "humidity"], "temperature + humidity"),
    "effective_temperature": (
        ["temperature", "humidity", "airspeed"],
        "0.94 * temperature + 0.25 * (temperature * atan(0.1515977 * sqrt(humidity + 8.31659)) + atan(temperature + humidity) "
        "- atan(humidity - 1.676331) + 0.00391838 * pow(humidity, 1.5) * atan(0.023101 * humidity) - 4.686035) + 0.7 "
        "- 0.15 * (41 - temperature) * (exp(airspeed) - exp(0.2))",
    ),
    "digestion_index": (
        ["good_droppings", "bad_droppings"],
        "CASE WHEN bad_droppings + good_droppings = 0 THEN NULL ELSE good_droppings / (bad_droppings + good_droppings) * 100 END",
    ),
}


def derive(name: str, source: str, condition: str = "TRUE") -> str:
    inputs, formula = FORMULAS[name]
    first, *others = inputs
    sides = " ".join(
        f"JOIN (SELECT round_id, round_number, time, x, y, arg_min(value, z) AS {o} FROM {source} "
        f"WHERE observable_name = '{o}' AND {condition} GROUP BY ALL) USING (round_id, round_number, time, x, y)"
        for o in others
    )
    return (
        f"SELECT x, y, z, round_number, coalesce({formula}, 0) AS value, time, round_id, day_of_production, '{name}' AS observable_name, "
        f"obs_type FROM (SELECT * EXCLUDE (value, observable_name), value AS {first} FROM {source} "
        f"WHERE observable_name = '{first}' AND {condition}) {sides}"
    )


SPLIT_OF = "(SELECT split FROM halves h WHERE h.round_id = a.round_id)"
DERIVED_STORED = f"""
{ALIGNED},
aligned_earlier AS (SELECT a.* FROM aligned a JOIN halves USING (round_id) WHERE time < split),
stored AS ({derive('humidex', 'aligned_earlier')}),
done AS (SELECT round_id, max(time) AS done, max({{'t': time, 'n': round_number}}).n AS done_round FROM stored GROUP BY round_id),
fresh AS (SELECT a.* FROM aligned a LEFT JOIN done USING (round_id) WHERE time > coalesce(done, TIMESTAMP '1970-01-01 00:00:01')),
ready AS (
  SELECT round_id, count(DISTINCT observable_name) = 2 AS ready FROM fresh
  WHERE observable_name IN ('temperature', 'humidity') GROUP BY round_id
),
laps AS (
  SELECT round_id, count(*) FILTER (is_fresh) AS n, (min({{'t': time, 'n': round_number}}) FILTER (is_fresh)).n AS first_fresh,
         max({{'t': time, 'n': round_number}}).n AS last_valid, max(coalesce(done_round, 0)) AS done_round
  FROM (SELECT *, time > coalesce(done, TIMESTAMP '1970-01-01 00:00:01') AS is_fresh
        FROM round_counter LEFT JOIN done USING (round_id) WHERE is_valid_round = 1) GROUP BY round_id
),
lap_range AS (
  SELECT round_id, CASE WHEN n >= 2 THEN first_fresh ELSE done_round END AS first_round, last_valid AS last_round
  FROM laps WHERE round_id IN (SELECT round_id FROM aligned)
)
"""

BOUNDS = """
lap_starts_valid AS (
  SELECT round_id, round_number, count(*) AS starts, max(time) FILTER (is_valid_round = 1) AS valid_time FROM round_counter GROUP BY ALL
),
invalid AS (
  SELECT c.round_id, c.round_number, c.time, valid_time FROM round_counter c JOIN lap_starts_valid USING (round_id, round_number)
  WHERE is_valid_round = 0 AND starts >= 2
),
bounds AS (
  SELECT round_id, round_number, max(valid_time) AS valid_time, min(time) FILTER (time <= valid_time) AS first_before,
         min(time) FILTER (time > valid_time) AS first_after
  FROM invalid GROUP BY ALL
)
"""

FLAGS = f"""
batch AS (
  SELECT round_id, observable_name, max({{'t': time, 'n': round_number}}).n AS lap, max({{'t': time, 'n': day_of_production}}).n AS day,
         max(time) AS time
  FROM (SELECT c.* FROM cells c JOIN halves USING (round_id) WHERE c.time >= split) GROUP BY ALL
),
tod_mark AS (SELECT round_id, observable_name, max(time) AS mark FROM e_tods_space GROUP BY ALL),
flags AS (
  SELECT round_id, observable_name, lap, day, time, lap <> coalesce(last_round_number, 0) AS is_new_round,
         day <> coalesce(last_day, 0) AS is_new_day,
         mark IS NULL OR {quadrant('time')} <> {quadrant('mark')} OR date_diff('day', CAST(mark AS DATE), CAST(time AS DATE)) > 1
           AS is_new_time_of_day,
         (epoch_us(time) - epoch_us(coalesce(last_time, TIMESTAMP '1970-01-01 00:00:01'))) // 3600000000 >= 1 AS is_new_hourly_overview
  FROM batch LEFT JOIN e_last USING (round_id, observable_name) LEFT JOIN tod_mark USING (round_id, observable_name)
),
context AS (
  SELECT round_id, observable_name, max(robot_id) AS robot_id, max(x_dim) AS x_dim, max(y_dim) AS y_dim, max(obs_type) AS obs_type
  FROM readings JOIN halves USING (round_id) WHERE time >= split GROUP BY ALL
),
events_due AS (
  SELECT *, unnest(list_filter([
    {{'e': 'LATEST', 'o': observable_name, 'k': 'latest.event'}},
    CASE WHEN is_new_round THEN {{'e': 'NEW_ROUND', 'o': observable_name, 'k': 'round.event'}} END,
    CASE WHEN is_new_day THEN {{'e': 'NEW_NEW_DAY', 'o': observable_name, 'k': 'new_day.event'}} END,
    CASE WHEN is_new_time_of_day THEN {{'e': 'NEW_TIME_OF_DAY', 'o': observable_name, 'k': 'time_of_day.event'}} END,
    CASE WHEN is_new_hourly_overview THEN {{'e': 'NEW_HOURLY_OVERVIEW', 'o': observable_name, 'k': 'hourly.event'}} END,
    CASE WHEN observable_name IN ('temperature', 'humidity') THEN {{'e': 'DERIVED_OBSERVABLE', 'o': 'humidex', 'k': 'derived_observable.event'}} END,
    CASE WHEN observable_name IN ('temperature', 'humidity') THEN {{'e': 'DERIVED_OBSERVABLE', 'o': 'heat_stress_index', 'k': 'derived_observable.event'}} END,
    CASE WHEN observable_name IN ('temperature', 'humidity', 'airspeed') THEN {{'e': 'DERIVED_OBSERVABLE', 'o': 'effective_temperature', 'k': 'derived_observable.event'}} END,
    CASE WHEN observable_name IN ('good_droppings', 'bad_droppings') THEN {{'e': 'DERIVED_OBSERVABLE', 'o': 'digestion_index', 'k': 'derived_observable.event'}} END
  ], lambda v: v IS NOT NULL)) AS t
  FROM flags JOIN context USING (round_id, observable_name)
)
"""

ASSIGNED_COLUMNS = "round_id, observable_name, time, x, y, value"
FILE_COLUMNS = "file_id, round_id, robot_id, observable_name, observable_id, obs_type"


def after_mark(rows: str, mark: str, condition: str) -> str:
    return f"SELECT r.* FROM {rows} r LEFT JOIN ({mark}) USING (round_id, observable_name) WHERE {condition}"


def mark_of(table: str, expr: str) -> str:
    return f"SELECT round_id, observable_name, {expr} AS mark FROM {table} GROUP BY ALL"


def oracle_queries() -> dict[str, str]:
    sql: dict[str, str] = {}
    # Sources
    wire = "date_trunc('second', time) AS time"
    sql["parse_csv_lines"] = with_ctes(
        f"SELECT file_id, {wire}, y AS x, x AS y, z, value, FALSE AS is_bad FROM readings", READINGS
    )
    sql["parse_json_lines"] = with_ctes(
        f"SELECT file_id, {wire}, CAST(trunc(x + 0.5) AS INT) AS x, CAST(trunc(y + 0.5) AS INT) AS y, z, value, FALSE AS is_bad FROM readings",
        READINGS,
    )
    sql["parse_envelopes"] = with_ctes(
        "SELECT file_id || '/' || strftime(time, '%Y%m%d%H%M%S%f') || '/' || x || '/' || y || '/' || CAST(round(value * 10000) AS BIGINT) AS file_id, round_id, "
        f"robot_id, observable_name, observable_id, obs_type, x_dim, y_dim, {wire}, y AS x, x AS y, z, value, FALSE AS is_bad "
        "FROM (SELECT DISTINCT * FROM readings)",
        READINGS,
    )
    # Files and laps
    sql["asof_round_assign"] = with_ctes(
        f"SELECT {ASSIGNED_COLUMNS}, row_lap AS round_number, row_valid AS is_valid_round, lap_time FROM row_laps", READINGS, LAPS
    )
    sql["asof_exact_assign"] = with_ctes(
        "SELECT r.round_id, observable_name, r.time, x, y, value, round_number, is_valid_round, c.time AS lap_time FROM readings r "
        "ASOF LEFT JOIN round_counter c ON r.round_id = c.round_id AND r.time >= c.time",
        READINGS,
    )
    sql["file_statistics"] = with_ctes(
        f"SELECT * REPLACE ({r6('value_sd')} AS value_sd, {r6('x_sd')} AS x_sd, {r6('y_sd')} AS y_sd) FROM files", SHORT_READINGS, LAPS
    )
    sql["suspicious_files"] = with_ctes(
        "SELECT file_id, readings, span_seconds FROM files WHERE file_id IN (FROM suspects)", SHORT_READINGS, LAPS
    )
    known = "(SELECT 1 FROM robot_observable p WHERE p.robot_id = f.robot_id AND p.observable_id = f.observable_id)"
    sql["robot_allow_list"] = with_ctes(f"SELECT {FILE_COLUMNS}, readings FROM files f WHERE EXISTS {known}", READINGS, LAPS)
    sql["robot_not_allowed"] = with_ctes(f"SELECT {FILE_COLUMNS}, readings FROM files f WHERE NOT EXISTS {known}", READINGS, LAPS)
    sql["day_of_production"] = with_ctes(
        "SELECT file_id, round_id, time, value, CAST(date_diff('day', \"from\", CAST(time AS DATE)) AS INT) AS day_of_production "
        "FROM readings JOIN dim_cycle ON id = round_id",
        READINGS,
    )
    sql["file_verdicts"] = with_ctes(
        "SELECT file_id, round_id, observable_name, verdict, file_round_number, day_of_production FROM checked", SHORT_READINGS, LAPS
    )
    sql["file_round_shortcut"] = with_ctes(
        "SELECT file_id, time, x, y, z, value, round_number, day_of_production FROM assigned", SHORT_READINGS, LAPS
    )
    subjects = (
        "CASE verdict WHEN 'suspicious_data' THEN 'Suspicious data error' WHEN 'round_not_in_range' THEN 'Round not in range and is discarded' "
        "WHEN 'round_not_valid' THEN 'Round is not valid' ELSE 'Observable is not available for this robot' END"
    )
    sql["file_rejections"] = with_ctes(
        f"SELECT verdict AS kind, round_id, robot_id, observable_name, file_id, {subjects} AS subject, "
        "CASE verdict WHEN 'suspicious_data' THEN 'Robot with id ' || robot_id || ' is sending suspicious data for round id ' || round_id "
        "ELSE observable_name || ' of robot with id ' || robot_id || ' was rejected for round id ' || round_id END AS body, "
        "verdict = 'suspicious_data' AND observable_name = 'temperature' AS notify FROM checked WHERE verdict IS NOT NULL",
        SHORT_READINGS,
        LAPS,
    )
    sql["ingest_audit"] = with_ctes(
        "SELECT sha256('measurement|' || file_id) AS id, robot_id, round_id, file_id AS url, last_time AS \"from\", last_time AS \"to\", "
        "observable_id, '0000000' AS created_by FROM files",
        READINGS,
        LAPS,
    )
    # Cells
    cells = f"SELECT * REPLACE ({r6('value')} AS value) FROM cells"
    sql["cells_ambient"] = over(f"{cells} WHERE obs_type = 'ambient_condition'")
    sql["cells_anomaly"] = over(f"{cells} WHERE obs_type = 'anomaly'")
    sql["cells_incremental_merge"] = over(cells)
    sql["cells_with_precision"] = over(
        f"SELECT * REPLACE ({r6('floor(' + r6('value') + ' * pow(10, length(observable_name) % 3) + 0.5) / pow(10, length(observable_name) % 3)')} "
        "AS value) FROM cells"
    )
    sql["last_main_rows"] = over(last_rows("cells"))
    sql["first_main_rows"] = over(
        "SELECT round_id, observable_name, min({'t': time, 'n': round_number}).n AS first_round_number, "
        "min({'t': time, 'n': day_of_production}).n AS first_day, min(time) AS first_time FROM cells GROUP BY ALL"
    )
    # Roll-ups
    sql["latest_over_time"] = over(f"SELECT * REPLACE ({r6('value')} AS value) FROM latest", LATEST)
    since_start = "(SELECT * FROM cells WHERE day_of_production >= 0)"
    sql["latest_over_space"] = over(
        f"SELECT {STATS}, latest_time, old_time, {KEY} FROM "
        f"({space(since_start, KEY, 'max(time) AS latest_time, CAST(NULL AS TIMESTAMP) AS old_time')})"
    )
    earlier_latest = "SELECT round_id, observable_name, max(time) AS mark FROM earlier WHERE day_of_production >= 0 GROUP BY ALL"
    newer = (
        f"(SELECT c.*, mark FROM cells c LEFT JOIN ({earlier_latest}) USING (round_id, observable_name) "
        "WHERE day_of_production >= 0 AND time > coalesce(mark, TIMESTAMP '1970-01-01 00:00:01'))"
    )
    sql["latest_incremental"] = over(
        f"SELECT {STATS}, latest_time, old_time, {KEY} FROM ({space(newer, KEY, 'max(time) AS latest_time, max(mark) AS old_time')})"
    )
    for name, table in (("round", "rounds"), ("day", "days"), ("tod", "tods")):
        sql[f"{name}_over_time"] = over(f"SELECT * REPLACE ({r6('value')} AS value) FROM {table}", ROLLUPS)
        sql[f"{name}_over_space"] = over(f"SELECT * REPLACE ({STATS}) FROM {table}_space", ROLLUPS)
    newest = "max({'t': time, 'n': %s}).n"
    fresh_rounds = after_mark("rounds", mark_of("e_rounds_space", newest % "round_number"), "round_number >= coalesce(mark, 0)")
    sql["round_incremental"] = over(
        f"SELECT * REPLACE ({STATS}) FROM fresh_space", ROLLUPS, EARLIER, f"fresh AS ({fresh_rounds})", f"fresh_space AS ({rounds_space('fresh')})"
    )
    fresh_days = after_mark("days", mark_of("e_days_space", newest % "day"), "day >= coalesce(mark, 0)")
    sql["day_incremental"] = over(
        f"SELECT * REPLACE ({STATS}) FROM ({space('fresh', KEY + ', day', 'max(time) AS time')})", ROLLUPS, EARLIER, f"fresh AS ({fresh_days})"
    )
    fresh_tods = after_mark(
        "tods", mark_of("e_tods_space", "max(time)"), f"mark IS NULL OR window_start > {window_start('mark')}"
    )
    tod_space = space("fresh", KEY + ", time_of_day, window_start", "max(time) AS time, max(day) AS day")
    sql["tod_incremental"] = over(f"SELECT * REPLACE ({STATS}) FROM ({tod_space})", ROLLUPS, EARLIER, f"fresh AS ({fresh_tods})")
    sql["quadrant_windows"] = with_ctes(
        f"SELECT round_id, start, newest, CAST(row_number() OVER (PARTITION BY round_id ORDER BY window_start) - 1 AS INT) AS n, "
        "window_start, window_start + to_hours(CASE WHEN hour(window_start) = 20 THEN 12 ELSE 4 END) - INTERVAL 1 SECOND AS window_end, "
        f"{quadrant('window_start')} AS quadrant FROM (SELECT round_id, start, newest, d + to_hours(h) AS window_start FROM "
        "(SELECT round_id, lo AS start, hi AS newest, unnest(generate_series(date_trunc('day', lo), date_trunc('day', hi), INTERVAL 1 DAY)) AS d FROM spans) "
        f"CROSS JOIN (VALUES (8), (12), (16), (20)) t(h)) WHERE window_start > {window_start('start')} AND window_start < {window_start('newest')}",
        READINGS,
    )
    sql["hourly_overview"] = over(f"SELECT * REPLACE ({STATS}) FROM hours", ROLLUPS)
    sql["hourly_incremental"] = over(
        f"SELECT * REPLACE ({STATS}) FROM ({after_mark('hours', mark_of('e_hours', 'max(time)'), 'r.time >= coalesce(mark, TIMESTAMP $$1970-01-01$$)')})",
        ROLLUPS,
        EARLIER,
    )
    # Retraction
    sql["invalid_round_filter"] = over(
        f"SELECT c.* REPLACE ({r6('value')} AS value) FROM cells c LEFT JOIN bounds b USING (round_id, round_number) "
        "WHERE NOT (coalesce(c.time >= first_before AND c.time < b.valid_time, FALSE) OR coalesce(c.time >= first_after, FALSE))",
        BOUNDS,
    )
    shown = "strftime(time, '%Y-%m-%d %H:%M:%S')"
    sql["invalid_round_alerts"] = with_ctes(
        f"SELECT sha256('round_invalidation|' || round_id || '|' || round_number || '|' || {shown}) AS id, round_id AS robot_id, "
        "'0000000' AS alert_id, 'none' AS notification_method_id, '0000000' AS user_id, time, "
        "CASE WHEN valid_time IS NULL THEN 'No valid start of robot round' ELSE 'Discarded robot round' END AS subject, "
        f"'Round with id ' || round_id || ', at time - ' || {shown} || ' and number ' || round_number || "
        "CASE WHEN valid_time IS NULL THEN ' has no valid start and was kept.' ELSE ' has been discarded.' END AS message, "
        "'high' AS level, '0000000' AS created_by, 'robot round discarded' AS event_type "
        "FROM (SELECT i.*, first_after FROM invalid i JOIN bounds USING (round_id, round_number)) "
        "WHERE time <= valid_time OR time = first_after OR valid_time IS NULL",
        READINGS,
        BOUNDS,
    )
    # Derived observables
    for name in FORMULAS:
        sql[f"derived_{name}"] = over(f"SELECT * REPLACE ({r6('value')} AS value) FROM ({derive(name, 'aligned')})", ALIGNED)
    sql["derived_ready"] = over("SELECT * FROM ready", DERIVED_STORED)
    sql["derived_range"] = over("SELECT * FROM lap_range", DERIVED_STORED)
    in_range = (
        "in_range AS (SELECT f.* FROM fresh f JOIN lap_range USING (round_id) WHERE round_id IN (SELECT round_id FROM ready WHERE ready) "
        "AND round_number BETWEEN first_round AND last_round)"
    )
    sql["derived_incremental"] = over(
        f"SELECT * REPLACE ({r6('value')} AS value) FROM ({derive('humidex', 'in_range')})", DERIVED_STORED, in_range
    )
    # Triggers
    sql["trigger_flags"] = over("SELECT * FROM flags", EARLIER, FLAGS)
    due = "SELECT t.e AS event_type, round_id, robot_id, t.o AS observable_name, x_dim, y_dim, obs_type"
    sql["trigger_rows"] = over(f"{due}, t.k AS routing_key FROM events_due", EARLIER, FLAGS)
    sql["frontend_trigger_rows"] = over(
        f"{due}, CASE t.e WHEN 'LATEST' THEN 'frontend.latest' WHEN 'NEW_ROUND' THEN 'frontend.round' WHEN 'NEW_NEW_DAY' THEN 'frontend.new_day' "
        "WHEN 'NEW_TIME_OF_DAY' THEN 'frontend.time_of_day' ELSE 'frontend.hourly' END AS routing_key FROM events_due "
        "WHERE t.e <> 'DERIVED_OBSERVABLE'",
        EARLIER,
        FLAGS,
    )
    # Display
    sql["series_latest"] = over(
        f"SELECT {KEY}, 'latest' AS event_type, time, strftime(time, '%Y-%m-%d %H:00:00') AS date, {r6(SHOWN)} AS value "
        f"FROM ({space(since_start, KEY, 'max(time) AS time')})"
    )
    sql["series_round"] = points("rounds_space", "round", "time", "%Y-%m-%d %H:%M:00", "round_number")
    sql["series_day"] = points("days_space", "new_day", "time", "%Y-%m-%d 00:00:00", "day")
    sql["series_tod"] = points("tods_space", "time_of_day", "time", "%Y-%m-%d %H:%M:00", "time_of_day")
    sql["series_hour"] = over(
        f"SELECT {KEY}, 'hour' AS event_type, time, strftime(time, '%Y-%m-%d %H') AS date, {r6(SHOWN)} AS value FROM hours", ROLLUPS
    )
    sql["series_calendar_day"] = calendar("day", "dayofyear(time)")
    sql["series_calendar_week"] = calendar("week", "CAST(strftime(time, '%U') AS INT)")
    sql["series_calendar_month"] = calendar("month", "month(time)")
    latest_units = f"(SELECT {KEY}, max(time) AS time FROM latest WHERE x >= 0 AND y >= 0 GROUP BY ALL)"
    sql["matrix_latest"] = matrix("latest", latest_units, "", "strftime(time, '%d-%m-%y')", DAY_OF)
    placed = "(SELECT * FROM %s_space s WHERE EXISTS (SELECT 1 FROM %s r WHERE r.round_id = s.round_id AND r.observable_name = s.observable_name AND x >= 0 AND y >= 0))"
    sql["matrix_round"] = matrix(
        "rounds", placed % ("rounds", "rounds"), "round_number",
        "'Round ' || round_number || ' (' || strftime(time, '%d-%m %H:%M') || ')'", DAY_OF,
    )
    sql["matrix_day"] = matrix(
        "days", placed % ("days", "days"), "day", "'Day ' || day || ' (' || strftime(time, '%d-%m-%y') || ')'", "day"
    ).replace(", day AS day, 'Day", ", 'Day")  # the unit column is the day itself
    tod_units = f"(SELECT {KEY}, window_start, max(time) AS time, max(day) AS day FROM tods WHERE x >= 0 AND y >= 0 GROUP BY ALL)"
    sql["matrix_tod"] = matrix("tods", tod_units, "window_start", "strftime(time, '%d-%m %H:%M')", "day", True)
    sql["matrix_hourly"] = over(
        f"SELECT g.*, v.value FROM (SELECT u.*, gh.hour, CAST(unnest(range(last_day + 1)) AS INT) AS day FROM "
        f"(SELECT DISTINCT {KEY}, last_day FROM hours JOIN last USING (round_id, observable_name)) u, "
        "(SELECT CAST(unnest(range(24)) AS INT) AS hour) gh) g "
        f"LEFT JOIN (SELECT {KEY}, CAST(hour(time) AS INT) AS hour, day, {r6(f'greatest(arg_max({SHOWN}, time), 0)')} AS value FROM hours GROUP BY ALL) v "
        f"USING ({KEY}, hour, day)",
        ROLLUPS,
    )
    sql["coordinate_alerts"] = over(
        "SELECT 'wrong_coordinates' AS kind, round_id, CAST(NULL AS VARCHAR) AS robot_id, observable_name, CAST(NULL AS VARCHAR) AS file_id, "
        "'Wrong cordinates exception' AS subject, 'Round with id ' || round_id || ' has sent data with wrong cordinates and frontend data can''t be "
        "plotted. X cordinates = ' || max(x) || ', Y cordinates = ' || max(y) AS body, TRUE AS notify FROM latest WHERE x > 2 OR y > 2 "
        "GROUP BY round_id, observable_name",
        LATEST,
    )
    # Insert or update: continuing from a mark ends where one run over everything does
    for name, whole in {
        "upsert_latest": "latest_over_time",
        "upsert_rounds": "round_over_space",
        "upsert_round_places": "round_over_time",
        "upsert_days": "day_over_space",
        "upsert_quadrants": "tod_over_space",
        "upsert_hours": "hourly_overview",
    }.items():
        sql[name] = sql[whole]
    # Documents
    graphs = " UNION ALL ".join(
        f"SELECT round_id, observable_name, event_type, time, date, value FROM ({sql[name]})"
        for name in (
            "series_latest", "series_round", "series_day", "series_tod", "series_hour", "series_calendar_day", "series_calendar_week",
            "series_calendar_month",
        )
    )
    sql["graph_documents"] = (
        "SELECT round_id, observable_name, event_type, date, value, CAST(row_number() OVER "
        f"(PARTITION BY round_id, observable_name, event_type ORDER BY time) - 1 AS INT) AS n FROM ({graphs})"
    )
    sql["heatmap_documents"] = " UNION ALL ".join(
        f"SELECT round_id, observable_name, '{event}' AS event_type, label, CAST(day AS VARCHAR) AS day, x, y, value FROM ({sql[name]})"
        for name, event in {
            "matrix_latest": "latest", "matrix_round": "round", "matrix_day": "new_day", "matrix_tod": "time_of_day",
        }.items()
    )
    return sql | stored_queries()


RESTARTS = "\n  UNION ALL SELECT round_id, time + INTERVAL 2 HOUR, i + 1, 0 FROM lap_starts WHERE i % 5 = 4"


def kept(cells: str, name: str) -> str:
    """Cells after the retraction of closed laps: all but the newest one of each cycle."""
    return f"""
{name}_newest AS (SELECT round_id, max(round_number) AS newest FROM {cells} GROUP BY ALL),
{name} AS MATERIALIZED (
  SELECT c.* FROM {cells} c JOIN {name}_newest USING (round_id) LEFT JOIN bounds b USING (round_id, round_number)
  WHERE NOT (round_number < newest
             AND (coalesce(c.time >= first_before AND c.time < b.valid_time, FALSE) OR coalesce(c.time >= first_after, FALSE)))
)
"""


def stored_queries() -> dict[str, str]:
    """Twins of the queries that run batches against a store."""
    sql: dict[str, str] = {}
    two = [BOUNDS, kept("cells", "kept"), kept("earlier", "e_kept")]
    tables = {
        "round_over_space": ("rounds_space", "round_number"), "day_over_space": ("days_space", "day"),
        "tod_over_space": ("tods_space", "time_of_day"), "hourly_overview": ("hours", "CAST(NULL AS INT)"),
    }
    sql["triggered_outputs"] = over(
        " UNION ALL ".join(
            f"SELECT '{kind}' AS kind, {KEY}, {unit} AS unit, time, {STATS} FROM {prefix}{table} WHERE {condition}"
            for kind, (table, unit) in tables.items()
            for prefix, condition in (("k_", "observable_name <> 'humidity'"), ("f_", "observable_name = 'humidity'"))
        ),
        *two,
        rollup_ctes("kept", "k_"),
        rollup_ctes("e_kept", "f_"),
    )
    sql["triggered_places"] = over(f"SELECT * REPLACE ({r6('value')} AS value) FROM latest", *two, LATEST.replace("FROM cells", "FROM kept"))
    early = READINGS.replace(RESTARTS, "")
    assert early != READINGS
    final = f"final_counter AS (SELECT * FROM round_counter{RESTARTS})"
    every = " UNION ALL BY NAME ".join(["SELECT * FROM kept", *(derive(name, "kept") for name in FORMULAS)])
    sql["late_invalidation"] = with_ctes(
        f"SELECT * REPLACE ({r6('value')} AS value) FROM ({every})", early, final, LAPS, CELLS, BOUNDS.replace("round_counter", "final_counter"), kept("cells", "kept")
    )
    start = window_start("time")
    sql["stored_marks"] = over(
        "SELECT l.*, newest_window, closed_window FROM k_last l LEFT JOIN (SELECT round_id, observable_name, "
        f"max({start}) AS newest_window, max({start}) FILTER ({start} < {window_start('last_time')}) AS closed_window "
        "FROM kept JOIN k_last USING (round_id, observable_name) WHERE x <> -1 AND day_of_production >= 0 GROUP BY ALL) USING (round_id, observable_name)",
        *two,
        f"k_last AS ({last_rows('kept')})",
    )
    whole_seconds = READINGS.replace("CAST(ts AS TIMESTAMP) AS time", "date_trunc('second', CAST(ts AS TIMESTAMP)) AS time")
    assert whole_seconds != READINGS
    sql["cells_repeated_files"] = with_ctes(f"SELECT * REPLACE ({r6('value')} AS value) FROM cells", whole_seconds, LAPS, CELLS)
    wire = "strftime(time, '%Y-%m-%dT%H:%M:%SZ')"
    number = "CAST(CAST(value AS DECIMAL(20, 4)) AS VARCHAR)"
    sql["quarantine_rows"] = with_ctes(
        "SELECT file_id, round_id, robot_id, observable_name, line_number, CASE spoil "
        f"WHEN 0 THEN {wire} || ',' || x || ',' || y || ',0,n/a' WHEN 5 THEN 'yesterday,' || x || ',' || y || ',0,' || {number} "
        f"WHEN 10 THEN {wire} || ',left,' || y || ',0,' || {number} ELSE {wire} || ',' || x || ',' || y || ',0,' || {number} || ',more' END AS line, "
        "CASE spoil WHEN 0 THEN 'value is not a number' WHEN 5 THEN 'no time' WHEN 10 THEN 'no place' ELSE 'too many fields' END AS reason "
        "FROM (SELECT *, CAST(row_number() OVER (PARTITION BY file_id ORDER BY time, x, y, value) + 1 AS INT) AS line_number, "
        "epoch_us(time) // 1000000 % 20 AS spoil FROM readings) WHERE spoil IN (0, 5, 10, 15)",
        READINGS,
    )
    derived_cells = " UNION ALL BY NAME ".join(derive(name, "aligned") for name in FORMULAS)
    inputs = ", ".join(f"('{i}', '{name}')" for name, (needed, _) in FORMULAS.items() for i in needed)
    flags = FLAGS.replace("FROM cells c", "FROM d_cells c").replace("e_tods_space", "d_tods_space").replace("e_last", "d_last")
    assert flags.count("d_") >= 3
    flags = flags.replace("JOIN context USING", "JOIN d_context USING").replace(
        "events_due AS (",
        "d_context AS (SELECT round_id, m.d AS observable_name, max(robot_id) AS robot_id, max(x_dim) AS x_dim, max(y_dim) AS y_dim, "
        f"max(obs_type) AS obs_type FROM context JOIN (VALUES {inputs}) m(o, d) ON observable_name = m.o GROUP BY ALL),\nevents_due AS (",
    )
    sql["derived_trigger_rows"] = over(
        "SELECT t.e AS event_type, round_id, robot_id, t.o AS observable_name, x_dim, y_dim, obs_type, t.k AS routing_key FROM events_due",
        ALIGNED,
        f"d_cells AS MATERIALIZED ({derived_cells})",
        "d_earlier AS (SELECT d.* FROM d_cells d JOIN halves USING (round_id) WHERE time < split)",
        rollup_ctes("d_earlier", "d_"),
        flags,
    )
    sql["empty_outputs"] = over(
        "SELECT 'empty_output' AS kind, round_id, CAST(NULL AS VARCHAR) AS robot_id, observable_name, CAST(NULL AS VARCHAR) AS file_id, "
        "'There is no data for this output' AS subject, 'There is no ' || event_type || ' data for graph of round_id=' || round_id || "
        "', observable name = ' || observable_name AS body, FALSE AS notify FROM (SELECT DISTINCT round_id, observable_name FROM readings) "
        "CROSS JOIN (VALUES ('latest'), ('round'), ('new_day'), ('time_of_day')) k(event_type) "
        "WHERE (round_id, observable_name, event_type) NOT IN (SELECT (round_id, observable_name, 'latest') FROM g_cells WHERE day_of_production >= 0 "
        "UNION ALL SELECT (round_id, observable_name, 'round') FROM g_rounds UNION ALL SELECT (round_id, observable_name, 'new_day') FROM g_days "
        "UNION ALL SELECT (round_id, observable_name, 'time_of_day') FROM g_tods)",
        "g_cells AS (SELECT c.* FROM cells c JOIN spans USING (round_id) WHERE time < lo + INTERVAL 60 HOUR)",
        rollup_ctes("g_cells", "g_"),
    )
    # Scans
    one = "round_id = 'pc1' AND observable_name = 'temperature'"
    since = "time > TIMESTAMP '2024-01-08 12:00:00'"
    value = f"{r6('value')} AS value"
    sql["scan_cells_since"] = over(f"SELECT * REPLACE ({value}) FROM cells WHERE {one} AND {since}")
    sql["scan_round_cells"] = over(
        f"SELECT {value}, time, x, y, z, round_id, round_number, observable_name FROM cells WHERE {one} AND round_number = 12 AND day_of_production >= 0"
    )
    sql["scan_latest_cells"] = over(f"SELECT {value}, time, x, y, z, round_id, observable_name FROM cells WHERE {one} AND {since} AND day_of_production >= 0")
    sql["scan_placed_rows"] = over(f"SELECT {value}, time, x, y, z, round_number FROM rounds WHERE {one} AND x >= 0 AND y >= 0", ROLLUPS)
    sql["scan_unit_times"] = over(f"SELECT DISTINCT round_number, time FROM rounds_space WHERE {one}", ROLLUPS)
    return sql
