"""DuckDB SQL for the registered queries, written straight from the meaning.

Joins here are plain row-level joins and aggregates read the rows themselves,
so the SQL shares no plan with the queries it checks.
"""

from __future__ import annotations

_M = """m AS (
  SELECT event_id AS arrival, user_id AS sensor_id,
         CASE event_type WHEN 'click' THEN 'pm25' WHEN 'signup' THEN 'PM25'
              WHEN 'view' THEN 'PM2.5' WHEN 'error' THEN 'pm_10' ELSE 'o3' END AS parameter,
         ts AS datetime_utc, CAST(ts AS DATE) AS date,
         CASE WHEN event_id % 41 <> 0 THEN value END AS value
  FROM events)"""

_PLACES = """smap AS (
  SELECT c_custkey AS sensor_id, CAST(c_nationkey AS BIGINT) AS location_id
  FROM customer WHERE c_custkey % 7 <> 0),
loc AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id, r_name AS state, n_name AS city
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 11 <> 10),
xy AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id,
         CAST(25.0 + n_nationkey AS DOUBLE) AS latitude,
         CAST(-120.0 + 2.5 * n_nationkey AS DOUBLE) AS longitude
  FROM nation WHERE n_nationkey % 9 <> 8)"""

_E = f"""WITH {_M}, {_PLACES},
e0 AS (
  SELECT m.*, coalesce(smap.location_id, m.sensor_id) AS location_id
  FROM m LEFT JOIN smap USING (sensor_id)),
e1 AS (
  SELECT e0.*, coalesce(loc.state, 'Unknown') AS state,
         coalesce(loc.city, 'Location ' || e0.location_id) AS city,
         xy.latitude, xy.longitude
  FROM e0 LEFT JOIN loc ON e0.location_id = loc.location_id
          LEFT JOIN xy ON e0.location_id = xy.location_id),
allrows AS (
  SELECT *, CASE WHEN state <> 'Unknown' THEN city || ', ' || state ELSE city END
            AS location_name FROM e1),
e AS (SELECT * FROM allrows WHERE lower(parameter) = 'pm25')"""

_SELECTED = """
  date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
  AND state IN ('ASIA', 'EUROPE', 'Unknown')
  AND city IN ('NATION_2', 'NATION_3', 'NATION_7', 'NATION_8', 'Location 21', 'Location 49')
  AND value >= 35"""

_ROW = "arrival, sensor_id, parameter, datetime_utc, value"
_PLACED = "arrival, sensor_id, location_id, state, city, value"


# Results show means to six places; what is derived from a mean uses all of it.
_MEAN = "round(avg(value), 6)"

_SITES = f""", sites AS (
  SELECT location_id, location_name, latitude, longitude, avg(value) AS avg_pm25,
         max(value) AS max_pm25, count(value) AS measurements, count(*) AS n_rows
  FROM e GROUP BY ALL),
located AS (SELECT * FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL)"""


def _band(value: str, labels: list[str], missing: str) -> str:
    limits = [12, 35, 55, 150]
    cases = " ".join(f"WHEN {value} < {at} THEN '{t}'" for at, t in zip(limits, labels))
    return f"CASE WHEN {value} IS NULL THEN '{missing}' {cases} ELSE '{labels[-1]}' END"


# Labels, limits and colours of the concentration bands.
_SHORT = [
    "🟢 Good",
    "🟡 Moderate",
    "🟠 Unhealthy (Sensitive)",
    "🔴 Unhealthy",
    "🟣 Very Unhealthy",
]
_LONG = [
    "Good (0-12)",
    "Moderate (12-35)",
    "Unhealthy for Sensitive (35-55)",
    "Unhealthy (55-150)",
    "Very Unhealthy (150+)",
]
_RGB = ["0,228,0", "255,255,0", "255,126,0", "255,0,0", "143,63,151"]


def _distribution(source: str, where: str = "true") -> str:
    return f""", cats AS (
  SELECT {_band('value', _LONG, 'Unknown')} AS category FROM {source} WHERE {where}),
dist AS (
  SELECT category, count(*) AS n,
         round_even(count(*) / (SELECT count(*) FROM cats) * 100, 1) AS percentage
  FROM cats GROUP BY category)"""


def _weekdays(where: str = "true") -> str:
    return f"""{_E}
SELECT CASE WHEN isodow(date) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       {_MEAN} AS mean, median(value) AS median, max(value) AS max, count(value) AS count
FROM e WHERE {where} GROUP BY 1"""


def _kpis(where: str = "true", average: str = _MEAN) -> str:
    return f"""{_E}
SELECT count(DISTINCT location_id) AS locations, {average} AS avg_pm25,
       max(value) AS peak_pm25, count(*) AS rows FROM e WHERE {where}"""


_SEASONS = f"""WITH s AS (
  SELECT month(l_shipdate) AS month, monthname(l_shipdate) AS month_name,
         avg(l_quantity) AS mean, min(l_quantity) AS min, max(l_quantity) AS max
  FROM lineitem GROUP BY 1, 2)"""

_FIRST_DAILY = "row_number() OVER (PARTITION BY sensor_id, parameter, date ORDER BY arrival)"

# Sensors as both listings of the landing have them.
_LISTED = """listed AS (
  SELECT 1 AS listing, c_custkey AS sensor_id, CAST((c_nationkey + 1) % 25 AS BIGINT) AS location_id,
         CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 7 + 10.5 AS DOUBLE) END AS lat,
         CASE WHEN c_custkey % 7 <> 0 THEN CAST(-(c_custkey % 9) - 0.5 AS DOUBLE) END AS lon
  FROM customer WHERE c_custkey % 3 <> 1
  UNION ALL
  SELECT 2, c_custkey, CAST(c_nationkey AS BIGINT),
         CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 50 + 0.5 AS DOUBLE) END,
         CASE WHEN c_custkey % 7 <> 0 THEN CAST(-(c_custkey % 100) - 0.25 AS DOUBLE) END
  FROM customer WHERE c_custkey % 3 <> 0)"""

# Rows as the JSON landing gives them; fallback coordinates as the jobs do.
_LANDED = f"""{_M}, {_PLACES}, {_LISTED},
landed AS (
  SELECT event_id, user_id AS sensor_id, m.parameter, m.date,
         CAST(m.date AS TIMESTAMP) AS datetime_utc, CAST(m.date AS TIMESTAMP) AS datetime_local,
         m.value, 'µg/m³' AS units,
         CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 100 AS DOUBLE) END AS coverage_percent,
         CASE WHEN event_id % 4 <> 0 THEN events.value * 0.5::DOUBLE END AS min,
         CASE WHEN event_id % 4 <> 0 THEN events.value * 2.0::DOUBLE END AS max,
         CASE WHEN event_id % 4 <> 0 THEN events.value END AS median,
         CASE WHEN event_id % 2 = 0 THEN 10.5::DOUBLE END AS latitude,
         CASE WHEN event_id % 2 = 0 THEN -20.5::DOUBLE END AS longitude
  FROM events JOIN m ON m.arrival = events.event_id),
own AS (SELECT * EXCLUDE (listing) FROM listed
        QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY listing DESC) = 1)"""

_FACT = """sensor_id, parameter, datetime_utc, datetime_local, value, units,
       coverage_percent, min, max, median, latitude, longitude"""

ORACLE = {
    "ingest_flatten": f"WITH {_LANDED} SELECT {_FACT} FROM landed",
    "json_props_extract": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "dim_location_last_wins": """
SELECT c_custkey AS location_id, 'State ' || c_nationkey AS state,
       CASE WHEN c_custkey % 3 = 0 OR c_custkey % 13 = 0 THEN 'Old' ELSE c_name END AS city
FROM customer WHERE c_custkey % 11 <> 0 AND NOT (c_custkey % 3 = 1 AND c_custkey % 13 = 0)""",
    "dim_sensor_map": """
SELECT c_custkey AS sensor_id,
       CAST(CASE WHEN c_custkey % 3 = 0 OR c_custkey % 13 = 0 THEN 99 ELSE c_nationkey END AS BIGINT)
         AS location_id
FROM customer WHERE c_custkey % 11 <> 0 AND NOT (c_custkey % 3 = 1 AND c_custkey % 13 = 0)""",
    "dim_coords_nonnull": """
WITH c AS (SELECT c_custkey AS k, c_custkey % 7 = 0 OR c_custkey % 5 = 0 AS bad FROM customer)
SELECT k AS location_id,
       CASE WHEN k % 3 = 0 OR bad THEN 0.5 ELSE CAST(k % 50 + 0.5 AS DOUBLE) END AS latitude,
       CASE WHEN k % 3 = 0 OR bad THEN 0.25 ELSE CAST(-(k % 90) - 0.25 AS DOUBLE) END AS longitude
FROM c WHERE NOT (k % 3 = 1 AND bad)""",
    "scan_parameter": f"""WITH {_M}
SELECT sensor_id, parameter, datetime_utc, value FROM m WHERE parameter = 'pm25'""",
    "export_counts": f"""WITH {_M}, {_PLACES},
seen AS (SELECT DISTINCT sensor_id FROM m WHERE lower(parameter) = 'pm25')
SELECT count(seen.sensor_id) AS successful, count(*) - count(seen.sensor_id) AS failed,
       count(*) AS total
FROM smap LEFT JOIN seen USING (sensor_id)""",
    "sensor_map_build": f"""WITH {_LANDED}
SELECT sensor_id, location_id FROM own WHERE sensor_id % 5 <> 0""",
    "unnest_sensors": f"""WITH {_LISTED}
SELECT location_id, sensor_id, 'sensor ' || sensor_id AS sensor_name,
       CASE WHEN sensor_id % 5 = 1 THEN 'PM25' ELSE 'pm25' END AS parameter,
       lat AS latitude, lon AS longitude
FROM listed WHERE sensor_id % 5 <> 0""",
    "coerce_numeric": """
SELECT event_id, TRY_CAST(CASE WHEN event_id % 41 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END
                          AS DOUBLE) AS value FROM events""",
    "coerce_times": """
SELECT event_id,
       CASE WHEN event_id % 41 <> 0 THEN date_trunc('second', ts) + INTERVAL 5 HOUR END
         AS datetime_utc,
       CASE WHEN event_id % 41 <> 0 THEN date_trunc('second', ts) END AS datetime_local
FROM events""",
    "ingest_date_range": f"""WITH {_M} SELECT {_ROW} FROM m
WHERE datetime_utc >= TIMESTAMP '2024-01-10' AND datetime_utc <= TIMESTAMP '2024-01-16 12:00:00'""",
    "param_exact": f"WITH {_M} SELECT {_ROW} FROM m WHERE lower(parameter) = 'pm25'",
    "param_fuzzy": f"""WITH {_M} SELECT {_ROW} FROM m
WHERE replace(replace(lower(parameter), '.', ''), '_', '') LIKE '%pm2%'""",
    "filter_date": f"""WITH {_M} SELECT {_ROW} FROM m
WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'""",
    "filter_state": f"{_E} SELECT {_PLACED} FROM e WHERE state IN ('ASIA', 'Unknown')",
    "filter_city": f"""{_E} SELECT {_PLACED} FROM e
WHERE city IN ('NATION_7', 'NATION_1', 'Location 49', 'NATION_3', 'NATION_9', 'NATION_5')""",
    "scenario_watch": f"WITH {_M} SELECT {_ROW} FROM m WHERE value >= 35",
    "scenario_severe": f"WITH {_M} SELECT {_ROW} FROM m WHERE value >= 55",
    "coord_coverage": f"""{_E}{_SITES}
SELECT (SELECT count(*) FROM e) AS rows,
       (SELECT count(*) FROM e WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
         AS rows_with_coords,
       (SELECT count(*) FROM sites) AS groups,
       (SELECT count(*) FROM located) AS groups_with_coords""",
    "date_bounds": f"WITH {_M} SELECT min(date) AS min_date, max(date) AS max_date FROM m",
    "options_state": f"{_E} SELECT DISTINCT state FROM e ORDER BY state",
    "options_city": f"""{_E}
SELECT DISTINCT city FROM e WHERE state IN ('ASIA', 'Unknown') ORDER BY city""",
    "enrich": f"""{_E}
SELECT {_ROW}, date, location_id, state, city, location_name FROM e""",
    "load_parameter_enriched": f"""{_E}
SELECT sensor_id, parameter, datetime_utc, value, date, location_id, state, city, location_name
FROM allrows WHERE parameter = 'pm25'""",
    "coords_priority": f"""WITH {_LANDED}
SELECT event_id, sensor_id, coalesce(xy.latitude, lat, landed.latitude) AS latitude,
       coalesce(xy.longitude, lon, landed.longitude) AS longitude
FROM landed LEFT JOIN own USING (sensor_id) LEFT JOIN xy USING (location_id)""",
    "location_semi": f"""WITH {_PLACES}
SELECT sensor_id, location_id FROM smap WHERE location_id IN (3, 7, 11, 24)""",
    "assign_region": f"""{_E}, s AS (
  SELECT DISTINCT sensor_id, longitude FROM allrows)
SELECT sensor_id, longitude,
       CASE WHEN sensor_id = 3 THEN 'Coast' WHEN sensor_id = 8 THEN 'South'
            WHEN sensor_id = 12 THEN '' WHEN longitude IS NULL THEN 'Unknown'
            WHEN longitude <= -105 THEN 'West' WHEN longitude <= -90 THEN 'Midwest'
            ELSE 'East' END AS region
FROM s""",
    "kpi": _kpis(),
    "kpi_selected": _kpis(_SELECTED),
    "kpi_display": f"""WITH k AS ({_kpis(average="avg(value)")})
SELECT coalesce(format('{{:,}}', locations), '—') AS locations,
       coalesce(format('{{:,.1f}}', avg_pm25), '—') AS avg_pm25,
       coalesce(format('{{:,.1f}}', peak_pm25), '—') AS peak_pm25,
       coalesce(format('{{:,}}', rows), '—') AS rows FROM k""",
    "map_agg": f"""{_E}{_SITES}
SELECT location_id, location_name, latitude, longitude, round(avg_pm25, 6) AS avg_pm25, max_pm25,
       measurements, round(CASE WHEN avg_pm25 < 5 THEN 5.0 ELSE avg_pm25 END * 2000, 6) AS radius
FROM located""",
    "map_display": f"""{_E}{_SITES}
SELECT location_id, location_name, latitude, longitude,
       coalesce(format('{{:.1f}}', avg_pm25), 'N/A') AS avg_pm25_display,
       coalesce(format('{{:.1f}}', max_pm25), 'N/A') AS max_pm25_display,
       {_band('avg_pm25', _RGB, '128,128,128')} AS colour FROM located""",
    "map_center": f"""{_E}{_SITES}
SELECT round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude
FROM located""",
    "top_locations": f"""{_E}{_SITES}, ranked AS (
  SELECT *, row_number() OVER (
    ORDER BY avg_pm25 DESC NULLS LAST, location_id, latitude, longitude) AS rank FROM located)
SELECT CAST(rank AS INTEGER) AS rank, location_id, location_name,
       round_even(avg_pm25, 1) AS avg_pm25, round_even(max_pm25, 1) AS max_pm25,
       {_band('avg_pm25', _SHORT, 'Unknown')} AS category, measurements
FROM ranked WHERE rank <= 10""",
    "trend_top_cities": f"""{_E}
SELECT city, {_MEAN} AS avg_pm25 FROM e GROUP BY city
ORDER BY avg(value) DESC NULLS LAST, city LIMIT 5""",
    "trend_daily": f"""{_E}, top AS (
  SELECT city FROM e GROUP BY city ORDER BY avg(value) DESC NULLS LAST, city LIMIT 5)
SELECT date, location_name, {_MEAN} AS avg_pm25 FROM e
WHERE city IN (SELECT city FROM top) GROUP BY 1, 2""",
    "trend_daily_selected": f"""{_E}
SELECT date, location_name, {_MEAN} AS avg_pm25 FROM e
WHERE city IN ('NATION_7', 'NATION_1', 'Location 49', 'NATION_3', 'NATION_9') GROUP BY 1, 2""",
    "aqi_distribution": f"{_E}{_distribution('e')} SELECT * FROM dist",
    "distribution_selected": f"{_E}{_distribution('e', _SELECTED)} SELECT * FROM dist",
    "aqi_rollup": f"""{_E}{_distribution('e')}
SELECT round(coalesce(sum(percentage) FILTER (category LIKE 'Good%'), 0), 1) AS good_pct,
       round(coalesce(sum(percentage) FILTER (category LIKE 'Moderate%'), 0), 1)
         AS moderate_pct,
       round(coalesce(sum(percentage) FILTER (category LIKE '%Unhealthy%'), 0), 1)
         AS unhealthy_pct
FROM dist""",
    "extreme_summary": f"""{_E}
SELECT count(DISTINCT location_id) AS num_locations, count(DISTINCT date) AS num_days,
       max(value) AS max_value FROM e WHERE value >= 150""",
    "extreme_top10": f"""{_E}, x AS (
  SELECT * FROM e WHERE value >= 150 ORDER BY value DESC, datetime_utc, sensor_id LIMIT 10)
SELECT CASE WHEN round_even(value, 1) >= 200 THEN '🔴 SEVERE' ELSE '🟠 HIGH' END AS severity,
       date, location_name, round_even(value, 1) AS value, latitude, longitude FROM x""",
    "weekday_weekend": _weekdays(),
    "weekday_weekend_selected": _weekdays(_SELECTED),
    "weekday_diff": f"""{_E}, d AS (
  SELECT avg(value) FILTER (isodow(date) < 6) AS weekday_mean,
         avg(value) FILTER (isodow(date) >= 6) AS weekend_mean FROM e),
p AS (SELECT *, (weekday_mean - weekend_mean) / weekend_mean * 100 AS diff_pct FROM d)
SELECT round(weekday_mean, 6) AS weekday_mean, round(weekend_mean, 6) AS weekend_mean,
       round(diff_pct, 6) AS diff_pct,
       CASE WHEN abs(diff_pct) <= 5 THEN 'similar' WHEN diff_pct > 5 THEN 'weekday higher'
               WHEN diff_pct < -5 THEN 'weekend higher' END AS verdict FROM p""",
    "seasonal": f"""{_SEASONS}
SELECT CAST(month AS INTEGER) AS month, round(mean, 6) AS mean, * EXCLUDE (month, mean) FROM s""",
    "season_extremes": f"""{_SEASONS},
w AS (SELECT * FROM s ORDER BY mean DESC, month LIMIT 1),
b AS (SELECT * FROM s ORDER BY mean, month LIMIT 1)
SELECT w.month_name AS worst_month, round(w.mean, 6) AS worst_mean, b.month_name AS best_month,
       round(b.mean, 6) AS best_mean FROM w, b""",
    "report_cube": f"""{_E}
SELECT location_id, location_name, state, city, latitude, longitude,
       CAST(month(date) AS INTEGER) AS calendar_month,
       CASE WHEN isodow(date) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       {_band('value', _LONG, 'Unknown')} AS category,
       count(*) AS n_rows, count(value) AS n_values, {_MEAN} AS mean,
       min(value) AS value_min, max(value) AS value_max
FROM e GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""",
    "filter_all": f"""{_E}
SELECT {_PLACED}, location_name, date FROM e WHERE {_SELECTED}""",
    "sensor_metadata": f"""{_E}
SELECT sensor_id, parameter,
       round(avg(sensor_id % 25 + (arrival % 4) / 4), 6) AS latitude,
       round(avg(-(sensor_id % 50) - (arrival % 4) / 4), 6) AS longitude,
       max(datetime_utc) AS last_seen, location_id, state, city, location_name
FROM allrows GROUP BY sensor_id, parameter, location_id, state, city, location_name""",
    "latest_per_sensor": """
SELECT user_id AS sensor_id, max(ts) AS last_data_datetime_utc FROM events GROUP BY 1""",
    "daily_summary": f"""WITH {_M}
SELECT sensor_id, parameter, date, {_MEAN} AS value, min(value) AS min, max(value) AS max,
       median(value) AS median,
       round(count(DISTINCT hour(datetime_utc)) * 100 / 24, 6) AS coverage_percent,
       count(value) AS n
FROM m GROUP BY 1, 2, 3""",
    "aqi_category": f"""WITH {_M}
SELECT arrival, {_band('value', _SHORT, 'Unknown')} AS short_label,
       {_band('value', _LONG, 'Unknown')} AS long_label,
       {_band('value', _RGB, '128,128,128')} AS colour,
       CASE WHEN round_even(value, 1) >= 200 THEN '🔴 SEVERE' ELSE '🟠 HIGH' END AS severity
FROM m""",
    "parse_dates": """
SELECT o_orderkey, CASE o_orderkey % 8 WHEN 7 THEN NULL
       WHEN 6 THEN strftime(o_orderdate, '%Y-%m-%dT06:30:00Z')
       ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') END AS parsed FROM orders""",
    "dedup_first": f"""WITH {_M}
SELECT {_ROW}, date FROM (SELECT *, {_FIRST_DAILY} AS rn FROM m) WHERE rn = 1""",
    "insert_ignore": f"""WITH {_M},
stored AS (SELECT * FROM (SELECT *, {_FIRST_DAILY} AS rn FROM m
           WHERE datetime_utc < TIMESTAMP '2024-01-16') WHERE rn = 1),
batch AS (SELECT * FROM (SELECT *, {_FIRST_DAILY} AS rn FROM m
          WHERE datetime_utc >= TIMESTAMP '2024-01-10') WHERE rn = 1)
SELECT {_ROW}, date FROM stored
UNION ALL
SELECT {_ROW}, date FROM batch WHERE NOT EXISTS (
  SELECT 1 FROM stored s WHERE s.sensor_id = batch.sensor_id
    AND s.parameter = batch.parameter AND s.date = batch.date)""",
    "ingest_stats": f"""WITH {_M},
stored AS (SELECT DISTINCT sensor_id, parameter, date FROM m
           WHERE datetime_utc < TIMESTAMP '2024-01-16'),
batch AS (SELECT DISTINCT sensor_id, parameter, date FROM m
          WHERE datetime_utc >= TIMESTAMP '2024-01-10')
SELECT (SELECT count(*) FROM batch) AS attempted,
       (SELECT count(*) FROM (FROM batch EXCEPT FROM stored)) AS inserted,
       (SELECT count(*) FROM (FROM batch INTERSECT FROM stored)) AS duplicates""",
    "metadata_upsert": f"""WITH {_M},
b AS (
  SELECT sensor_id, 'sensor ' || sensor_id AS sensor_name, arg_max(parameter, arrival) AS parameter,
         arg_max(CASE WHEN arrival % 2 = 0 THEN CAST(arrival % 40 + 0.25 AS DOUBLE) END,
                 CASE WHEN arrival % 2 = 0 THEN arrival END) AS latitude,
         arg_max(CASE WHEN arrival % 2 = 0 THEN CAST(-(arrival % 90) - 0.25 AS DOUBLE) END,
                 CASE WHEN arrival % 2 = 0 THEN arrival END) AS longitude,
         arg_max(CASE WHEN arrival % 5 = 0 THEN datetime_utc END,
                 CASE WHEN arrival % 5 = 0 THEN arrival END) AS last_seen
  FROM m GROUP BY sensor_id),
o AS (
  SELECT s_suppkey AS sensor_id, s_name AS sensor_name,
         CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey % 40 + 0.5 AS DOUBLE) END AS latitude,
         CASE WHEN s_suppkey % 3 <> 0 THEN CAST(-(s_suppkey % 90) - 0.5 AS DOUBLE) END AS longitude
  FROM supplier)
SELECT coalesce(b.sensor_id, o.sensor_id) AS sensor_id,
       coalesce(b.sensor_name, o.sensor_name) AS sensor_name,
       coalesce(b.parameter, 'pm25') AS parameter,
       coalesce(b.latitude, o.latitude) AS latitude,
       coalesce(b.longitude, o.longitude) AS longitude,
       CASE WHEN b.sensor_id IS NULL THEN 'East' ELSE 'Unknown' END AS region,
       coalesce(b.last_seen, CASE WHEN o.sensor_id IS NOT NULL THEN TIMESTAMP '2023-12-01' END)
         AS last_seen,
       CASE WHEN b.sensor_id IS NULL THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-02-01' END
         AS updated_at
FROM b FULL JOIN o ON b.sensor_id = o.sensor_id""",
    "signal_upsert": f"""WITH {_M},
b AS (SELECT sensor_id, max(datetime_utc) AS mark FROM m WHERE lower(parameter) = 'pm25'
      GROUP BY 1)
SELECT coalesce(b.sensor_id, s_suppkey) AS sensor_id,
       coalesce(mark, TIMESTAMP '2024-01-20') AS last_data_datetime_utc,
       CASE WHEN b.sensor_id IS NULL THEN TIMESTAMP '2024-01-21' ELSE TIMESTAMP '2024-02-01' END
         AS last_run_time
FROM b FULL JOIN supplier ON b.sensor_id = s_suppkey""",
    "signal_windows": f"""WITH {_M}, {_PLACES},
marks AS (SELECT sensor_id, max(datetime_utc) AS mark FROM m
          WHERE lower(parameter) = 'pm25' GROUP BY 1)
SELECT smap.sensor_id, coalesce(mark, TIMESTAMP '2024-01-01') AS start
FROM smap LEFT JOIN marks USING (sensor_id)""",
    "sensor_metadata_record": """
WITH s AS (
  SELECT c_custkey AS sensor_id, c_name AS sensor_name,
         CASE WHEN c_custkey % 6 <> 0 THEN 'pm25' END AS parameter,
         CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 60 + 0.5 AS DOUBLE) END AS latitude,
         CASE WHEN c_custkey % 7 <> 0 THEN CAST(-(c_custkey % 130) - 0.25 AS DOUBLE) END
           AS longitude,
         CASE WHEN c_custkey % 4 <> 0 THEN
           make_timestamp(2024, 1, c_custkey % 28 + 1, 6, 0, 0) END AS last_seen
  FROM customer)
SELECT *, CASE WHEN sensor_id = 3 THEN 'Coast' WHEN sensor_id = 8 THEN 'South'
               WHEN sensor_id = 12 THEN '' WHEN longitude IS NULL THEN 'Unknown'
               WHEN longitude <= -105 THEN 'West' WHEN longitude <= -90 THEN 'Midwest'
               ELSE 'East' END AS region
FROM s""",
    "union_batches": f"WITH {_M} SELECT {_ROW} FROM m",
    "run_summary": f"""WITH {_M}, {_PLACES},
seen AS (SELECT DISTINCT sensor_id FROM m WHERE lower(parameter) = 'pm25')
SELECT (SELECT count(*) FROM smap WHERE sensor_id IN (FROM seen)) AS successful_sensors,
       (SELECT count(*) FROM smap WHERE sensor_id NOT IN (FROM seen)) AS failed_sensors,
       (SELECT count(*) FROM nation WHERE n_nationkey NOT IN (SELECT location_id FROM smap))
         AS skipped_locations,
       (SELECT count(*) FROM nation) AS total_locations,
       (SELECT count(*) FROM smap) AS sensor_mappings""",
    "ingest_batch": f"""WITH {_LANDED},
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY sensor_id, date ORDER BY event_id) AS rn FROM landed)
SELECT sensor_id, 'pm25' AS parameter, datetime_utc, datetime_local, value, units,
       coverage_percent, min, max, median,
       coalesce(xy.latitude, lat, firsts.latitude) AS latitude,
       coalesce(xy.longitude, lon, firsts.longitude) AS longitude
FROM firsts JOIN own USING (sensor_id) LEFT JOIN xy USING (location_id)
WHERE rn = 1 AND sensor_id % 5 <> 0""",
    "ingest_backfill": f"""WITH {_LANDED},
asked AS (SELECT * FROM generate_series(0, 29) t(location_id)),
found AS (SELECT DISTINCT location_id, sensor_id FROM listed WHERE sensor_id % 5 <> 0),
known AS (SELECT DISTINCT sensor_id FROM found),
first AS (SELECT DISTINCT sensor_id, parameter, date FROM landed JOIN known USING (sensor_id)
          WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-15'),
second AS (SELECT DISTINCT sensor_id, parameter, date FROM landed JOIN known USING (sensor_id)
           WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'),
seen AS (SELECT DISTINCT sensor_id FROM second)
SELECT (SELECT count(*) FROM found WHERE sensor_id IN (FROM seen)) AS successful_sensors,
       (SELECT count(*) FROM found WHERE sensor_id NOT IN (FROM seen)) AS failed_sensors,
       (SELECT count(*) FROM asked WHERE location_id NOT IN (SELECT location_id FROM found))
         AS skipped_locations,
       (SELECT count(*) FROM asked) AS total_locations,
       (SELECT count(*) FROM known) AS sensor_mappings,
       (SELECT count(*) FROM second) AS total_rows_attempted,
       (SELECT count(*) FROM (FROM second EXCEPT FROM first)) AS total_rows_inserted,
       (SELECT count(*) FROM (FROM second INTERSECT FROM first)) AS total_duplicates""",
    "backfill_facts": f"""WITH {_LANDED},
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY sensor_id, parameter, date ORDER BY event_id) AS rn
  FROM landed WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20')
SELECT sensor_id, parameter, datetime_utc, datetime_local, value, units,
       coverage_percent, min, max, median,
       coalesce(xy.latitude, lat) AS latitude, coalesce(xy.longitude, lon) AS longitude
FROM firsts JOIN own USING (sensor_id) LEFT JOIN xy USING (location_id)
WHERE rn = 1 AND sensor_id % 5 <> 0""",
    "stream_ingest": f"""WITH {_LANDED},
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY sensor_id, date ORDER BY event_id) AS rn FROM landed)
SELECT sensor_id, 'pm25' AS parameter, datetime_utc, datetime_local, value, units,
       coverage_percent, min, max, median, latitude, longitude
FROM firsts WHERE rn = 1""",
    "stream_dedup": f"WITH {_M} SELECT {_ROW} FROM m",
    "stream_first": f"""WITH {_M},
sent AS (
  SELECT {_ROW} FROM m
  UNION ALL
  SELECT arrival + CASE WHEN arrival % 2 = 1 THEN -1000000000 ELSE 1000000000 END, sensor_id, parameter, datetime_utc, value + 1
  FROM m)
SELECT {_ROW} FROM sent
QUALIFY row_number() OVER (PARTITION BY sensor_id, parameter, datetime_utc ORDER BY arrival) = 1""",
    "stream_signal": """
SELECT user_id AS sensor_id, max(ts) AS last_data_datetime_utc FROM events GROUP BY 1""",
    "stream_alerts": f"WITH {_M} SELECT {_ROW} FROM m WHERE value >= 150",
}
ORACLE["distribution_from_cube"] = ORACLE["distribution_selected"]
ORACLE["map_from_cube"] = ORACLE["map_agg"]
ORACLE["stream_daily"] = ORACLE["daily_summary"]
# Reports from the partials of one reading have the results of those from rows.
for _name, _from_rows in {
    "trend_from_parts": "trend_daily",
    "extreme_from_parts": "extreme_summary",
    "extreme_top_from_parts": "extreme_top10",
    "weekday_from_parts": "weekday_weekend",
    "weekday_selected_from_parts": "weekday_weekend_selected",
    "map_from_parts": "map_agg",
}.items():
    ORACLE[_name] = ORACLE[_from_rows]


# Reports of the suite: their SQL, the columns that are numbers, and those that are text.
_SUITE = {
    "kpis": ("kpi", "locations avg_pm25 peak_pm25 rows", ""),
    "kpi_display": ("kpi_display", "", "locations avg_pm25 peak_pm25 rows"),
    "map_sites": (
        "map_agg",
        "location_id latitude longitude avg_pm25 max_pm25 measurements radius",
        "location_name",
    ),
    "map_display": (
        "map_display",
        "location_id latitude longitude",
        "location_name avg_pm25_display max_pm25_display",
    ),
    "map_center": ("map_center", "latitude longitude", ""),
    "coord_coverage": ("coord_coverage", "rows rows_with_coords groups groups_with_coords", ""),
    "extreme_summary": ("extreme_summary", "num_locations num_days max_value", ""),
    "extreme_top": ("extreme_top10", "value latitude longitude", "severity date location_name"),
    "top_locations": (
        "top_locations",
        "rank location_id avg_pm25 max_pm25 measurements",
        "location_name category",
    ),
    "trend_daily": ("trend_daily_selected", "avg_pm25", "date location_name"),
    "aqi_distribution": ("aqi_distribution", "n percentage", "category"),
    "aqi_rollup": ("aqi_rollup", "good_pct moderate_pct unhealthy_pct", ""),
    "weekday_weekend": ("weekday_weekend", "mean median max count", "day_type"),
    "weekday_diff": ("weekday_diff", "weekday_mean weekend_mean diff_pct", "verdict"),
    "seasonal": ("", "month mean min max", "month_name"),
    "season_extremes": ("", "worst_mean best_mean", "worst_month best_month"),
}


def _suite() -> str:
    """What each column of each report adds up to, over the suite's selection."""
    chosen = _E.replace(
        "FROM allrows WHERE", "FROM allrows WHERE date >= DATE '2024-01-05' AND value >= 35 AND"
    )
    months = f"""{chosen}, s AS (
  SELECT month(date) AS month, monthname(date) AS month_name, avg(value) AS mean,
         min(value) AS min, max(value) AS max FROM e GROUP BY 1, 2)"""
    made, parts = [], []
    for report, (name, numbers, texts) in _SUITE.items():
        sql = ORACLE[name or report].replace(_SEASONS, months).replace(_E, chosen)
        made.append(f"r_{report} AS ({sql})")
        for column in numbers.split():
            parts.append(
                f"SELECT '{report}' AS report, '{column}' AS column, count(*) AS n,"
                f" round(sum(round(CAST({column} AS DOUBLE), 6)), 4) AS total,"
                f" CAST(NULL AS VARCHAR) AS low, CAST(NULL AS VARCHAR) AS high FROM r_{report}"
            )
        for column in texts.split():
            value = f"CAST({column} AS VARCHAR)"
            parts.append(
                f"SELECT '{report}', '{column}', count(*), NULL, min({value}), max({value}) FROM r_{report}"
            )
    return "WITH " + ",\n".join(made) + "\n" + "\nUNION ALL ".join(parts)


ORACLE["report_suite"] = _suite()
