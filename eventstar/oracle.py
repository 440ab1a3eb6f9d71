"""Reference SQL (DuckDB dialect) for every registered query.

Each statement recomputes its answer from the ``events`` view with the same
fixture rule the Spark side uses, written the plain way (window functions for
first-wins, natural-key joins, exact integer rounding), so a match checks the
distributed plan against an independent formulation.
"""

from __future__ import annotations

from eventstar.functions.classify import (
    DEPTH_INTERMEDIATE_BELOW,
    DEPTH_SHALLOW_BELOW,
    MAGNITUDE_OTHER,
    MAGNITUDE_TYPES,
    REGION_BOXES,
    REGION_OTHER,
)
from eventstar.operators import checks
from eventstar.schemas import STRING_BOUNDS
from eventstar.sources.fixture import FIXTURE_SQL

BATCH_1, BATCH_2 = "batch-1", "batch-2"
SPLIT_LOW = "2024-01-10 00:00:00"   # batch 2 starts here
SPLIT_HIGH = "2024-01-17 00:00:00"  # batch 1 ends before here
AS_OF = "2024-02-05"
WINDOW = ("2024-01-08 00:00:00", "2024-01-15 00:00:00")
WINDOW_MIN_MAG, WINDOW_CAP = 2.5, 500
RANGE_MAGNITUDE, RANGE_DEPTH = (0.0, 10.0), (-10.0, 800.0)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def depth_case(col: str) -> str:
    return (f"CASE WHEN {col} < {DEPTH_SHALLOW_BELOW} THEN 'Shallow' "
            f"WHEN {col} < {DEPTH_INTERMEDIATE_BELOW} THEN 'Intermediate' ELSE 'Deep' END")


def region_case(lat: str, lon: str) -> str:
    arms = []
    for name, (a, b), lon_box in REGION_BOXES:
        cond = f"{lat} BETWEEN {a} AND {b}"
        if lon_box:
            cond += f" AND {lon} BETWEEN {lon_box[0]} AND {lon_box[1]}"
        arms.append(f"WHEN {cond} THEN {_q(name)}")
    return f"CASE {' '.join(arms)} ELSE {_q(REGION_OTHER)} END"


def type_case(col: str, pick: int) -> str:
    arms = [f"WHEN {col} IN ({', '.join(_q(t) for t in e[0])}) THEN {_q(e[pick])}"
            for e in MAGNITUDE_TYPES]
    return f"CASE {' '.join(arms)} ELSE {_q(MAGNITUDE_OTHER[pick - 1])} END"


def avg2(col: str) -> str:
    """Exact mean of a DECIMAL(3,2) column rounded half away from zero to 2."""
    s = f"sum(CAST({col} * 100 AS BIGINT))"
    n = f"count({col})"
    return (f"CASE WHEN {n} > 0 THEN CAST(sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})) AS DOUBLE)"
            f" / CAST(100 AS DOUBLE) END")


def avg0(col: str) -> str:
    s = f"sum(CAST({col} AS BIGINT))"
    n = f"count({col})"
    return f"CASE WHEN {n} > 0 THEN CAST(sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})) AS DOUBLE) END"


def stddev2(col: str) -> str:
    k = f"CAST({col} * 100 AS BIGINT)"
    n = f"CAST(count({col}) AS HUGEINT)"
    s1 = f"CAST(sum({k}) AS HUGEINT)"
    s2 = f"CAST(sum(CAST({k} AS HUGEINT) * {k}) AS HUGEINT)"
    var = f"CAST({n} * {s2} - {s1} * {s1} AS DOUBLE) / CAST({n} * ({n} - 1) AS DOUBLE)"
    sd = f"sqrt({var}) * CAST(0.01 AS DOUBLE)"
    return (f"CASE WHEN count({col}) > 1 THEN floor(({sd}) * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE))"
            f" / CAST(100 AS DOUBLE) END")


FIXTURE = FIXTURE_SQL.format(STR="varchar", MS="epoch_us(ts)//1000", SRC="events",
                             EXTRA=", ts AS source_ts, event_id AS seq")

VALIDATED = """
v AS (
  SELECT *, CASE WHEN event_id IS NULL OR event_id = '' THEN 'Missing required field: id'
                 WHEN time_ms = 0 THEN 'Missing required field: properties.time'
                 WHEN short_coords THEN 'Invalid coordinates format' END AS error_message
  FROM fx)"""


def _stg(where: str, batch_expr: str) -> str:
    return f"""
  SELECT event_id, magnitude, magnitude_type, place, make_timestamp(time_ms * 1000) AS event_time,
         CAST(NULL AS TIMESTAMP) AS updated_time, latitude, longitude, depth,
         CAST(NULL AS VARCHAR) AS status, tsunami, significance, {batch_expr} AS source_batch_id
  FROM v WHERE error_message IS NULL AND magnitude IS NOT NULL AND ({where})"""


STAR = f"""
WITH fx AS ({FIXTURE}),
{VALIDATED},
stg AS ({_stg('TRUE', _q(BATCH_1))}),
days AS (SELECT DISTINCT CAST(event_time AS DATE) AS d FROM stg),
dim_time AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_key, d AS date_actual,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, rpad(monthname(d), 9, ' ') AS month_name,
         CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
         rpad(dayname(d), 9, ' ') AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
         dayofweek(d) IN (0, 6) AS is_weekend
  FROM days),
loc AS (
  SELECT * FROM (
    SELECT latitude, longitude, place, depth,
           row_number() OVER (PARTITION BY latitude, longitude, coalesce(place, '')
                              ORDER BY event_time, event_id) AS rn
    FROM stg WHERE latitude IS NOT NULL AND longitude IS NOT NULL) WHERE rn = 1),
dim_location AS (
  SELECT concat_ws('|', latitude, longitude, coalesce(place, '')) AS location_key,
         latitude, longitude, {depth_case('depth')} AS depth_category,
         {region_case('latitude', 'longitude')} AS region, place
  FROM loc),
dim_event_type AS (
  SELECT DISTINCT magnitude_type AS event_type_key, magnitude_type,
         {type_case('magnitude_type', 1)} AS magnitude_category,
         {type_case('magnitude_type', 2)} AS description
  FROM stg WHERE magnitude_type IS NOT NULL),
fact AS (
  SELECT event_id AS fact_key, event_id,
         CAST(strftime(CAST(event_time AS DATE), '%Y%m%d') AS INTEGER) AS time_key,
         CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL
              THEN concat_ws('|', latitude, longitude, coalesce(place, '')) END AS location_key,
         magnitude_type AS event_type_key,
         magnitude, depth, significance, tsunami, status, event_time
  FROM stg),
raw AS (SELECT {_q(BATCH_1)} AS batch_id, event_id, 'x' AS raw_data, now() AS ingested_at
        FROM v WHERE error_message IS NULL)
"""

TWO_BATCHES = f"""
WITH fx AS ({FIXTURE}),
{VALIDATED},
b1 AS ({_stg(f"source_ts < TIMESTAMP '{SPLIT_HIGH}'", _q(BATCH_1))}),
b2 AS ({_stg(f"source_ts >= TIMESTAMP '{SPLIT_LOW}'", _q(BATCH_2))})
"""

STG_COLS = ("event_id, magnitude, magnitude_type, place, event_time, updated_time, latitude, "
            "longitude, depth, status, tsunami, significance, source_batch_id")


def _integrity_sql() -> str:
    parts = []
    names = {"raw_events": "raw", "stg_events": "stg", "dim_time": "dim_time",
             "dim_location": "dim_location", "dim_event_type": "dim_event_type",
             "fact_events": "fact"}
    for table, keys in checks.UNIQUE:
        if table not in names:
            continue
        src = names[table]
        cols = ", ".join("coalesce(place, '')" if k == "place_key" else k for k in keys)
        parts.append(f"SELECT 'unique:{table}({','.join(keys)})' AS \"check\", "
                     f"CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS violations FROM "
                     f"(SELECT count(*) AS c FROM {src} GROUP BY {cols})")
    for table, cols in checks.NOT_NULL.items():
        if table not in names:
            continue
        cond = " OR ".join(f"{c} IS NULL" for c in cols)
        parts.append(f"SELECT 'not_null:{table}', CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"
                     f" FROM {names[table]}")
    for key, dim in checks.FOREIGN:
        parts.append(f"SELECT 'foreign_key:fact_events.{key}', CAST(count(*) AS BIGINT) FROM "
                     f"(SELECT DISTINCT {key} FROM fact WHERE {key} IS NOT NULL) k "
                     f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = k.{key})")
    for table, bounds in STRING_BOUNDS.items():
        if table not in names:
            continue
        cond = " OR ".join(f"coalesce(length({c}) > {n}, false)" for c, n in bounds.items())
        parts.append(f"SELECT 'string_bounds:{table}', CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"
                     f" FROM {names[table]}")
    return STAR + "\n" + "\nUNION ALL\n".join(parts)


def _loc_join(f: str = "f", l: str = "l") -> str:
    return (f"{l}.latitude = {f}.latitude AND {l}.longitude = {f}.longitude "
            f"AND coalesce({l}.place, '') = coalesce({f}.place, '')")


# Result columns holding DECIMAL / DATE values, per query: they are handed
# over as DOUBLE / TIMESTAMP, as the Spark side does (see registry._comparable).
_DEC = {
    "catalog_window": ["magnitude"],
    "staging_load": ["magnitude", "latitude", "longitude", "depth"],
    "staging_increment": ["magnitude", "latitude", "longitude", "depth"],
    "staging_overlap": ["magnitude", "latitude", "longitude", "depth"],
    "stream_increment": ["magnitude", "latitude", "longitude", "depth"],
    "dim_location_load": ["latitude", "longitude"],
    "fact_load": ["latitude", "longitude", "magnitude", "depth"],
    "q1_region": ["max_magnitude", "min_magnitude"],
    "q1b_region_short": ["max_magnitude"],
    "q4_month": ["max_magnitude"],
    "q6_high_impact": ["magnitude", "depth"],
}
_DATE = {
    "dim_time_load": ["date_actual"],
    "fact_load": ["date_actual"],
    "q6_high_impact": ["date_actual"],
}


def _comparable(name: str, sql: str) -> str:
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in _DEC.get(name, [])]
    casts += [f"CAST({c} AS TIMESTAMP) AS {c}" for c in _DATE.get(name, [])]
    if not casts:
        return sql
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{sql}\n) AS result"


def oracle_sql() -> dict[str, str]:
    from eventstar import layer_queries                  # it builds on the texts of this module

    found = statements() | layer_queries.statements()
    return {name: _comparable(name, sql) for name, sql in found.items()}


def statements() -> dict[str, str]:
    q = {}
    q["landed_features"] = f"""
WITH fx AS ({FIXTURE}),
{VALIDATED}
SELECT CAST(seq // 100 AS BIGINT) AS page_id, event_id FROM v WHERE error_message IS NULL"""

    q["catalog_window"] = f"""
WITH fx AS ({FIXTURE})
SELECT event_id, time_ms, magnitude FROM fx
WHERE time_ms BETWEEN epoch_us(TIMESTAMP '{WINDOW[0]}') // 1000
                  AND epoch_us(TIMESTAMP '{WINDOW[1]}') // 1000
  AND CAST(magnitude AS DOUBLE) >= {WINDOW_MIN_MAG}
ORDER BY time_ms DESC, event_id ASC NULLS FIRST
LIMIT {WINDOW_CAP}"""

    q["page_count_check"] = f"""
WITH fx AS ({FIXTURE})
SELECT CAST(seq // 100 AS BIGINT) AS page_id, count(*) AS declared_count,
       count(*) AS feature_count, TRUE AS readable, TRUE AS complete
FROM fx GROUP BY 1"""

    early = f"source_ts < TIMESTAMP '{SPLIT_HIGH}' AND seq % 11 <> 9 AND seq % 701 % 5 <> 3"
    late = f"source_ts >= TIMESTAMP '{SPLIT_LOW}' OR seq % 11 = 9 OR seq % 701 % 5 = 3"
    increment = f"""
WITH fx AS ({FIXTURE}),
{VALIDATED},
old AS ({_stg(early, _q(BATCH_1))}),
new AS (SELECT * FROM ({_stg(late, _q(BATCH_2))}) WHERE event_id NOT IN (SELECT event_id FROM old))
"""
    q["dim_time_increment"] = increment + """
SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_key, CAST(d AS TIMESTAMP) AS date_actual,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year
FROM (SELECT CAST(event_time AS DATE) AS d FROM new)
WHERE d NOT IN (SELECT CAST(event_time AS DATE) FROM old)"""
    q["dim_location_increment"] = increment + f"""
SELECT CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, place,
       {depth_case('depth')} AS depth_category, {region_case('latitude', 'longitude')} AS region
FROM (SELECT *, row_number() OVER (PARTITION BY latitude, longitude, coalesce(place, '')
                                   ORDER BY event_time, event_id) AS rn FROM new) n
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM old o WHERE o.latitude = n.latitude
  AND o.longitude = n.longitude AND coalesce(o.place, '') = coalesce(n.place, ''))"""
    q["dim_event_type_increment"] = increment + f"""
SELECT DISTINCT magnitude_type, {type_case('magnitude_type', 1)} AS magnitude_category,
       {type_case('magnitude_type', 2)} AS description
FROM new WHERE magnitude_type NOT IN (SELECT magnitude_type FROM old WHERE magnitude_type IS NOT NULL)"""
    q["fact_increment"] = increment + """
SELECT event_id, CAST(strftime(CAST(event_time AS DATE), '%Y%m%d') AS INTEGER) AS time_key,
       CAST(magnitude AS DOUBLE) AS magnitude, event_time FROM new"""
    q["retry_batch"] = STAR + """
SELECT event_id, time_key, CAST(magnitude AS DOUBLE) AS magnitude FROM fact"""
    q["retry_empties_errors"] = f"""
WITH fx AS ({FIXTURE}),
{VALIDATED}
SELECT 'b0' AS batch_id, error_message, count(*) AS n_errors
FROM v WHERE error_message IS NOT NULL AND seq % 2 = 0 GROUP BY error_message"""
    q["window_ingestion"] = f"""
WITH fx AS ({FIXTURE}),
{VALIDATED},
w AS (SELECT * FROM v WHERE time_ms = 0 OR time_ms BETWEEN epoch_us(TIMESTAMP '{WINDOW[0]}') // 1000
                                                       AND epoch_us(TIMESTAMP '{WINDOW[1]}') // 1000)
SELECT count(*) AS events_fetched, count(error_message) AS events_invalid,
       count(*) - count(error_message) AS records_fetched,
       count(*) - count(error_message) AS records_inserted FROM w"""
    q["page_error_rows"] = f"""
WITH fx AS ({FIXTURE}),
p AS (SELECT CAST(seq // 100 AS BIGINT) AS page_id, count(*) AS n FROM fx GROUP BY 1)
SELECT 'page_error' AS error_type,
       CASE page_id % 4 WHEN 1 THEN concat('Page declares 7777 features, has ', n, ': ', page_id)
                        ELSE concat('Unreadable page: ', page_id) END AS error_message
FROM p WHERE page_id % 4 IN (1, 2)"""

    q["validate_valid"] = f"""
WITH fx AS ({FIXTURE}),
{VALIDATED}
SELECT event_id FROM v WHERE error_message IS NULL"""

    q["validate_errors"] = f"""
WITH fx AS ({FIXTURE}),
{VALIDATED}
SELECT coalesce(event_id, 'unknown') AS event_id, 'validation_error' AS error_type, error_message
FROM v WHERE error_message IS NOT NULL"""

    (m_lo, m_hi), (d_lo, d_hi) = RANGE_MAGNITUDE, RANGE_DEPTH
    q["validate_ranges"] = f"""
WITH fx AS ({FIXTURE}),
{VALIDATED},
r AS (
  SELECT event_id, coalesce(error_message,
    CASE WHEN magnitude IS NOT NULL AND NOT (magnitude BETWEEN {m_lo} AND {m_hi})
           THEN 'Validation error: magnitude out of range [{m_lo}, {m_hi}]'
         WHEN NOT (latitude BETWEEN -90.0 AND 90.0)
           THEN 'Validation error: latitude out of range [-90.0, 90.0]'
         WHEN NOT (longitude BETWEEN -180.0 AND 180.0)
           THEN 'Validation error: longitude out of range [-180.0, 180.0]'
         WHEN depth IS NOT NULL AND NOT (depth BETWEEN {d_lo} AND {d_hi})
           THEN 'Validation error: depth out of range [{d_lo}, {d_hi}]' END) AS error_message
  FROM v)
SELECT coalesce(event_id, 'unknown') AS event_id, error_message FROM r
WHERE error_message IS NOT NULL"""

    q["error_threshold"] = f"""
WITH fx AS ({FIXTURE}),
{VALIDATED},
c AS (SELECT count(error_message) AS bad, count(*) - count(error_message) AS good FROM v)
SELECT 'default' AS run, bad AS invalid_count, 500 AS max_errors, bad >= 500 AS exceeded,
       CASE WHEN bad >= 500 THEN 0 ELSE good END AS raw_rows FROM c
UNION ALL SELECT 'reached', bad, bad, TRUE, 0 FROM c
UNION ALL SELECT 'missed', bad, bad + 1, FALSE, good FROM c"""

    q["batch_audit"] = f"""
WITH fx AS ({FIXTURE}),
{VALIDATED},
c AS (SELECT count(*) AS n FROM v WHERE error_message IS NULL)
SELECT {_q(BATCH_1)} AS batch_id, n AS records_fetched, n AS records_inserted, 'success' AS status,
       CAST(NULL AS VARCHAR) AS error_message, TRUE AS in_time FROM c
UNION ALL SELECT {_q(BATCH_2)}, 2 * n, 0, 'failed',
                 concat(n, ' duplicated event ids in batch ', {_q(BATCH_2)}), TRUE FROM c"""

    q["staging_load"] = STAR + f"SELECT {STG_COLS} FROM stg"

    q["staging_increment"] = TWO_BATCHES + f"""
SELECT {STG_COLS} FROM b2 WHERE event_id NOT IN (SELECT event_id FROM b1)"""

    q["staging_overlap"] = TWO_BATCHES + f"""
SELECT {STG_COLS} FROM b1
UNION ALL
SELECT {STG_COLS} FROM b2 WHERE event_id NOT IN (SELECT event_id FROM b1)"""

    q["dim_time_load"] = STAR + "SELECT * FROM dim_time"

    q["dim_location_load"] = STAR + """
SELECT latitude, longitude, depth_category, region, place FROM dim_location"""

    q["dim_event_type_load"] = STAR + """
SELECT magnitude_type, magnitude_category, description FROM dim_event_type"""

    q["fact_load"] = STAR + """
SELECT f.event_id, t.date_actual, l.latitude, l.longitude, l.place, e.magnitude_type,
       f.magnitude, f.depth, f.significance, f.tsunami, f.status, f.event_time
FROM fact f
LEFT JOIN dim_time t ON t.time_key = f.time_key
LEFT JOIN dim_location l ON l.location_key = f.location_key
LEFT JOIN dim_event_type e ON e.event_type_key = f.event_type_key"""

    q["layer_counts"] = STAR + """
SELECT 'raw_events' AS layer, count(*) AS row_count FROM raw
UNION ALL SELECT 'staging_events', count(*) FROM stg
UNION ALL SELECT 'fact_events', count(*) FROM fact
UNION ALL SELECT 'dim_time', count(*) FROM dim_time
UNION ALL SELECT 'dim_location', count(*) FROM dim_location
UNION ALL SELECT 'dim_event_type', count(*) FROM dim_event_type"""

    q["q1_region"] = STAR + f"""
SELECT l.region, count(*) AS event_count, {avg2('f.magnitude')} AS avg_magnitude,
       max(f.magnitude) AS max_magnitude, min(f.magnitude) AS min_magnitude,
       CAST(sum(CASE WHEN f.tsunami THEN 1 ELSE 0 END) AS BIGINT) AS tsunami_events
FROM fact f JOIN dim_location l ON l.location_key = f.location_key
GROUP BY l.region"""

    q["q1b_region_short"] = STAR + f"""
SELECT l.region, count(*) AS event_count, {avg2('f.magnitude')} AS avg_magnitude,
       max(f.magnitude) AS max_magnitude
FROM fact f JOIN dim_location l ON l.location_key = f.location_key
GROUP BY l.region"""

    q["q2_weekday"] = STAR + f"""
SELECT t.day_name, t.is_weekend, count(*) AS event_count, {avg2('f.magnitude')} AS avg_magnitude,
       CAST(sum(CASE WHEN f.magnitude >= 5.0 THEN 1 ELSE 0 END) AS BIGINT) AS major_events
FROM fact f JOIN dim_time t ON t.time_key = f.time_key
GROUP BY t.day_name, t.is_weekend, t.day_of_week"""

    q["q3_depth"] = STAR + f"""
SELECT l.depth_category, count(*) AS event_count, {avg2('f.magnitude')} AS avg_magnitude,
       {avg0('f.significance')} AS avg_significance,
       count(CASE WHEN f.magnitude >= 6.0 THEN 1 END) AS strong_events
FROM fact f JOIN dim_location l ON l.location_key = f.location_key
WHERE f.significance > 100
GROUP BY l.depth_category"""

    q["q4_month"] = STAR + f"""
SELECT t.year, t.month, t.month_name, count(*) AS event_count,
       {avg2('f.magnitude')} AS avg_magnitude, max(f.magnitude) AS max_magnitude,
       CAST(sum(f.significance) AS BIGINT) AS total_significance
FROM fact f JOIN dim_time t ON t.time_key = f.time_key
GROUP BY t.year, t.month, t.month_name"""

    q["q5_magtype"] = STAR + f"""
SELECT e.magnitude_type, e.magnitude_category, count(*) AS event_count,
       {avg2('f.magnitude')} AS avg_magnitude, {stddev2('f.magnitude')} AS stddev_magnitude,
       quantile_cont(CAST(f.magnitude AS DOUBLE), 0.5) AS median_magnitude
FROM fact f JOIN dim_event_type e ON e.event_type_key = f.event_type_key
GROUP BY e.magnitude_type, e.magnitude_category"""

    q["q6_high_impact"] = STAR + f"""
SELECT f.event_id, t.date_actual, l.place, l.region, f.magnitude, f.depth, l.depth_category,
       f.tsunami, f.significance, e.magnitude_type
FROM fact f
JOIN dim_time t ON t.time_key = f.time_key
JOIN dim_location l ON l.location_key = f.location_key
JOIN dim_event_type e ON e.event_type_key = f.event_type_key
WHERE f.magnitude >= 5.0
  AND f.event_time >= CAST(DATE '{AS_OF}' AS TIMESTAMP) - INTERVAL 30 DAY
ORDER BY f.magnitude DESC NULLS FIRST, f.significance DESC NULLS FIRST, f.event_id
LIMIT 20"""

    q["q7_recent_errors"] = f"""
WITH fx AS ({FIXTURE}),
{VALIDATED}
SELECT {_q(BATCH_1)} AS batch_id, coalesce(event_id, 'unknown') AS event_id,
       'validation_error' AS error_type, error_message
FROM v WHERE error_message IS NOT NULL
ORDER BY coalesce(event_id, 'unknown') DESC, error_message DESC
LIMIT 10"""

    q["integrity_checks"] = _integrity_sql()

    q["stream_increment"] = STAR + """
SELECT event_id, magnitude, magnitude_type, place, event_time, updated_time, latitude,
       longitude, depth, status, tsunami, significance FROM stg"""
    return q
