"""DuckDB SQL equivalent of every registered query (the correctness oracle).

Tables ``region nation customer supplier part orders lineitem events ...`` are
views over the same parquet files. Numeric literals are cast to DOUBLE where
DuckDB would otherwise use DECIMAL arithmetic.
"""

from __future__ import annotations

from envlake.plans.ingest_bindings import ORACLE_SQL as INGEST_SQL
from envlake.plans.body_bindings import ORACLE_SQL as BODY_SQL
from envlake.plans.openaq_bindings import ORACLE_SQL as OPENAQ_SQL
from envlake.operators.quality import MODEL_CHECKS
from envlake.plans.suite_bindings import ORACLE_SQL as SUITE_SQL
from envlake.plans.suite_bindings import checks_sql

# Coordinates from keys (same integer arithmetic as driver_tables.py).
C_LAT = "(40.0::DOUBLE + CAST((c_custkey * 7919) % 5000 AS DOUBLE) / 10000.0::DOUBLE)"
C_LON = "(-90.0::DOUBLE + CAST((c_custkey * 104729) % 5000 AS DOUBLE) / 10000.0::DOUBLE)"
S_LAT = "(40.0::DOUBLE + CAST((s_suppkey * 7907) % 5000 AS DOUBLE) / 10000.0::DOUBLE)"
S_LON = "(-90.0::DOUBLE + CAST((s_suppkey * 15485863) % 5000 AS DOUBLE) / 10000.0::DOUBLE)"


def _iso(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN strftime({x}, '%f') <> '000000' "
            f"THEN strftime({x}, '%Y-%m-%dT%H:%M:%S.%fZ') ELSE strftime({x}, '%Y-%m-%dT%H:%M:%SZ') END")


def _gc(lat1, lon1, lat2, lon2) -> str:
    a1, o1, a2, o2 = (f"radians({x})" for x in (lat1, lon1, lat2, lon2))
    cosv = f"cos({a1}) * cos({a2}) * cos({o2} - {o1}) + sin({a1}) * sin({a2})"
    return f"(6371.0::DOUBLE * acos(least(1.0::DOUBLE, greatest(-1.0::DOUBLE, {cosv}))))"


O1_CTES = f"""
p AS (SELECT max(ts) AS now FROM events),
m AS (
  SELECT user_id AS openaq_locations_id, event_type AS openaq_sensors_id,
         date_trunc('hour', ts) AS datetime_utc, value,
         CASE WHEN event_type = 'error' THEN 'events.error' ELSE 'events.latest' END AS mtype
  FROM events),
m2 AS (
  SELECT concat_ws(':', CAST(openaq_locations_id AS VARCHAR), openaq_sensors_id, mtype,
                   strftime(datetime_utc, '%Y-%m-%dT%H:%M:%SZ')) AS event_id,
         openaq_locations_id, openaq_sensors_id, datetime_utc, value,
         CASE WHEN value >= 0 THEN value END AS value_clean, COALESCE(value >= 0, FALSE) AS is_valid,
         max(datetime_utc) OVER (PARTITION BY openaq_locations_id, openaq_sensors_id) AS latest_datetime
  FROM m WHERE mtype = 'events.latest'),
lm AS (SELECT m2.* FROM m2, p WHERE datetime_utc = latest_datetime AND datetime_utc >= p.now - INTERVAL 1 DAY),
loc AS (SELECT c_custkey AS openaq_locations_id, c_custkey AS locations_id_sk, c_name AS location_name,
               CAST(n_nationkey AS VARCHAR) AS country_code, n_name AS country_name, c_mktsegment AS owner_name,
               'tpch' AS provider_name, {C_LAT} AS latitude, {C_LON} AS longitude
        FROM customer JOIN nation ON c_nationkey = n_nationkey),
sen AS (SELECT DISTINCT event_type AS openaq_sensors_id, event_type AS parameter_name,
               upper(event_type) AS parameter_display_name, 'count' AS parameter_units FROM events),
br AS (SELECT c_custkey AS locations_id_sk, n_regionkey AS license_id_sk, n_name AS license_attribution_name,
              'attr:' || n_name AS license_attribution_url, TIMESTAMP '2020-01-01 00:00:00' AS license_date_from_dtz,
              CAST(NULL AS TIMESTAMP) AS license_date_to_dtz
       FROM customer JOIN nation ON c_nationkey = n_nationkey),
lic AS (SELECT r_regionkey AS license_id_sk, r_name AS license_name,
               r_regionkey % 2 = 0 AS license_commercial_use_allowed, r_regionkey % 3 = 0 AS license_attribution_required,
               r_regionkey < 2 AS license_share_alike_required, TRUE AS license_modification_allowed,
               r_regionkey <> 4 AS license_redistribution_allowed, 'license:' || lower(r_name) AS license_source_url
        FROM region),
o1 AS (
  SELECT lm.event_id, lm.openaq_locations_id, lm.openaq_sensors_id, lm.datetime_utc AS measurement_datetime_utc,
         lm.value_clean AS measurement_value, lm.value AS measurement_value_raw, sen.parameter_name,
         sen.parameter_display_name, sen.parameter_units, loc.location_name, loc.country_code, loc.country_name,
         loc.owner_name, loc.provider_name, loc.latitude, loc.longitude, lic.license_name,
         br.license_attribution_name, br.license_attribution_url, br.license_date_from_dtz, br.license_date_to_dtz,
         lic.license_commercial_use_allowed, lic.license_attribution_required, lic.license_share_alike_required,
         lic.license_modification_allowed, lic.license_redistribution_allowed, lic.license_source_url
  FROM lm JOIN loc ON loc.openaq_locations_id = lm.openaq_locations_id
          JOIN sen ON sen.openaq_sensors_id = lm.openaq_sensors_id
          JOIN br ON br.locations_id_sk = loc.locations_id_sk
          JOIN lic ON lic.license_id_sk = br.license_id_sk
  WHERE lm.is_valid = TRUE)"""

LATEST_BY_LOCATION = f"WITH {O1_CTES} SELECT * FROM o1"


def _pivot_cols(params: dict) -> str:
    out = []
    for pval, prefix in params.items():
        out += [f"max(measurement_value) FILTER (WHERE parameter_name = '{pval}') AS {prefix}",
                f"max(parameter_units) FILTER (WHERE parameter_name = '{pval}') AS {prefix}_units",
                f"max(openaq_sensors_id) FILTER (WHERE parameter_name = '{pval}') AS {prefix}_sensor_id"]
    return ",\n       ".join(out)


PIVOT_PARAMS = {"click": "latest_click", "view": "latest_view", "purchase": "latest_purchase"}
PIVOT_CTE = f"""
piv AS (
  SELECT openaq_locations_id, measurement_datetime_utc,
       {_pivot_cols(PIVOT_PARAMS)},
       CAST(round((epoch_us(measurement_datetime_utc) - epoch_us(any_value(p.now)))::DOUBLE / 1000000.0::DOUBLE)
            AS BIGINT) AS latest_measurement_age_in_seconds,
       date_trunc('hour', measurement_datetime_utc) AS measurement_datetime_utc_hour
  FROM o1, p
  WHERE measurement_datetime_utc >= date_trunc('hour', p.now) - INTERVAL 2 HOUR
    AND date_trunc('hour', measurement_datetime_utc) > date_trunc('hour', p.now) - INTERVAL 2 HOUR
  GROUP BY openaq_locations_id, measurement_datetime_utc)"""

LATEST_PIVOT = f"WITH {O1_CTES}, {PIVOT_CTE} SELECT * FROM piv"


def _om(kind: str, rtype: str) -> str:
    return f"""SELECT '{kind}:' || CAST(e.event_id AS VARCHAR) AS event_id, '{rtype}' AS record_type,
           date_trunc('hour', e.ts) AS open_meteo_start_time,
           date_trunc('hour', e.ts) + INTERVAL 1 HOUR * (e.event_id % 2 + 1) AS open_meteo_end_time,
           CAST(n.n_regionkey AS DOUBLE) AS latitude, 0.0::DOUBLE AS longitude, e.ts AS ingested_at_dtz,
           e.value AS temperature, 'C' AS temperature_unit, e.value AS pm2_5, 'ug/m3' AS pm2_5_unit
    FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE e.event_type = '{kind}'"""


PAIR_SELECT = """SELECT w.event_id AS weather_event_id, a.event_id AS air_event_id, w.open_meteo_start_time,
       w.open_meteo_end_time, w.latitude, w.longitude, w.temperature, w.temperature_unit, a.pm2_5, a.pm2_5_unit"""

CURRENT_SNAPSHOT = f"""
WITH w AS ({_om('view', 'current')} AND n.n_regionkey = 0 ORDER BY ingested_at_dtz DESC NULLS FIRST, event_id DESC LIMIT 1),
     a AS ({_om('click', 'current')} AND n.n_regionkey = 0 ORDER BY ingested_at_dtz DESC NULLS FIRST, event_id DESC LIMIT 1)
{PAIR_SELECT}
FROM w JOIN a ON w.latitude = a.latitude AND w.longitude = a.longitude"""

CURRENT_BY_LOCATION = f"""
WITH w0 AS ({_om('view', 'current')}), a0 AS ({_om('click', 'current')}),
w AS (SELECT DISTINCT ON (latitude, longitude) * FROM w0
      ORDER BY latitude, longitude, ingested_at_dtz DESC NULLS FIRST, event_id DESC NULLS FIRST),
a AS (SELECT DISTINCT ON (latitude, longitude) * FROM a0
      ORDER BY latitude, longitude, ingested_at_dtz DESC NULLS FIRST, event_id DESC NULLS FIRST)
{PAIR_SELECT}
FROM w JOIN a ON w.latitude = a.latitude AND w.longitude = a.longitude"""

LATEST_FORECAST = f"""
WITH w0 AS ({_om('view', 'forecast')}), a0 AS ({_om('click', 'forecast')}),
w AS (SELECT DISTINCT ON (open_meteo_start_time, open_meteo_end_time) * FROM w0
      ORDER BY open_meteo_start_time, open_meteo_end_time, ingested_at_dtz ASC NULLS LAST, event_id ASC NULLS LAST),
a AS (SELECT DISTINCT ON (open_meteo_start_time, open_meteo_end_time) * FROM a0
      ORDER BY open_meteo_start_time, open_meteo_end_time, ingested_at_dtz ASC NULLS LAST, event_id ASC NULLS LAST)
{PAIR_SELECT}
FROM w JOIN a ON w.latitude = a.latitude AND w.longitude = a.longitude
             AND w.open_meteo_start_time = a.open_meteo_start_time
             AND w.open_meteo_end_time = a.open_meteo_end_time"""

DISTINCT_ON_FIRST = """
SELECT DISTINCT ON (o_custkey, o_orderpriority)
       o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders ORDER BY o_custkey, o_orderpriority, o_orderdate ASC NULLS LAST, o_orderkey ASC NULLS LAST"""

DISTINCT_ON_LAST = """
SELECT DISTINCT ON (o_custkey, o_orderpriority)
       o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders ORDER BY o_custkey, o_orderpriority, o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST"""

_MID = "CASE category_number WHEN 1 THEN 25 WHEN 2 THEN 75 WHEN 3 THEN 125 WHEN 4 THEN 175 WHEN 5 THEN 250 WHEN 6 THEN 400 END"
_ADJ = "CASE category_number WHEN 1 THEN 25 WHEN 2 THEN 75 WHEN 3 THEN 125 WHEN 4 THEN 175 WHEN 5 THEN 150 WHEN 6 THEN 301 END"

DAILY_HOURLY_JOIN = f"""
WITH {O1_CTES}, {PIVOT_CTE},
a0 AS (SELECT date_trunc('day', (SELECT now FROM p)) + INTERVAL 1 DAY * (o_orderkey % 3) AS date_forecast_dtz,
              o_custkey AS location_id, o_orderstatus AS parameter_name,
              CAST(floor(o_totalprice / 800.0::DOUBLE) AS INTEGER) - 25 AS aqi,
              CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS category_number, o_orderpriority AS category_name,
              o_orderstatus = 'F' AS action_day, o_orderpriority AS discussion
       FROM orders WHERE o_orderkey % 7 <> 0),
a1 AS (SELECT *, CASE WHEN aqi BETWEEN 0 AND 500 THEN aqi ELSE {_MID} END AS aqi_clean FROM a0),
a AS (SELECT date_forecast_dtz, location_id, parameter_name, aqi_clean AS aqi,
             CASE WHEN aqi_clean = -1 THEN {_ADJ} ELSE aqi_clean END AS adjusted_aqi,
             category_name, action_day, discussion
      FROM a1, p
      WHERE (CASE WHEN aqi_clean IS NOT NULL AND (aqi_clean < 0 OR aqi_clean > 500) THEN FALSE ELSE TRUE END) = TRUE
        AND (date_forecast_dtz = date_trunc('day', p.now) OR date_forecast_dtz = date_trunc('day', p.now) + INTERVAL 1 DAY)),
w0 AS (SELECT user_id AS location_id, (SELECT now FROM p) + INTERVAL 1 HOUR * (event_id % 64 - 4) AS start_time,
              (SELECT now FROM p) + INTERVAL 1 HOUR * (event_id % 64 - 3) AS end_time,
              value * 2 - 60 AS temperature, 'wmoUnit:degC' AS temperature_unit, event_type AS temperature_trend,
              value AS relative_humidity, 'wmoUnit:percent' AS relative_humidity_unit, value / 2 AS dewpoint,
              'wmoUnit:degC' AS dewpoint_unit, value * 4 AS wind_speed, 'wmoUnit:km_h-1' AS wind_speed_unit,
              'NW' AS wind_direction, value * 5 AS wind_gust, 'wmoUnit:km_h-1' AS wind_gust_unit,
              CAST(user_id % 101 AS DOUBLE) AS probability_of_precipitation,
              'wmoUnit:percent' AS probability_of_precipitation_unit, event_type AS short_forecast,
              props AS detailed_forecast
       FROM events),
w AS (SELECT location_id, start_time, end_time,
             CASE WHEN temperature BETWEEN -80 AND 80 THEN temperature END AS temperature, temperature_unit,
             temperature_trend,
             CASE WHEN relative_humidity BETWEEN 0 AND 100 THEN relative_humidity END AS relative_humidity,
             relative_humidity_unit, dewpoint, dewpoint_unit,
             CASE WHEN wind_speed >= 0 AND wind_speed <= 300 THEN wind_speed END AS wind_speed, wind_speed_unit,
             wind_direction, wind_gust, wind_gust_unit,
             CASE WHEN probability_of_precipitation BETWEEN 0 AND 100 THEN probability_of_precipitation END
                  AS probability_of_precipitation,
             probability_of_precipitation_unit, short_forecast, detailed_forecast,
             date_trunc('day', start_time) AS forecast_day_dtz
      FROM w0, p
      WHERE start_time >= p.now
        AND NOT ((temperature IS NOT NULL AND (temperature < -80 OR temperature > 80))
              OR (relative_humidity IS NOT NULL AND (relative_humidity < 0 OR relative_humidity > 100))
              OR (probability_of_precipitation IS NOT NULL AND (probability_of_precipitation < 0 OR probability_of_precipitation > 100))
              OR (wind_speed IS NOT NULL AND (wind_speed < 0 OR wind_speed > 300)))),
orow AS (SELECT openaq_locations_id, measurement_datetime_utc, latest_click AS latest_temperature, latest_click_units AS latest_temperature_units,
                latest_view AS latest_pm25, latest_view_units AS latest_pm25_units,
                latest_purchase AS latest_relative_humidity, latest_purchase_units AS latest_relative_humidity_units
         FROM piv)
SELECT p.now AS current_datetime_utc, w.start_time AS forecast_start_time_utc, w.end_time AS forecast_end_time_utc,
       orow.measurement_datetime_utc AS latest_measurement_datetime_utc, 'latest' AS openaq_measurement_scope,
       'daily' AS air_quality_forecast_scope, 'hourly' AS weather_forecast_scope,
       orow.latest_temperature AS latest_measured_temperature, orow.latest_temperature_units,
       orow.latest_pm25 AS latest_measured_pm25, orow.latest_pm25_units,
       orow.latest_relative_humidity AS latest_measured_relative_humidity, orow.latest_relative_humidity_units,
       a.parameter_name AS air_quality_parameter, a.aqi, a.adjusted_aqi, a.category_name AS air_quality_category,
       w.temperature, w.temperature_unit, w.temperature_trend, w.relative_humidity, w.relative_humidity_unit,
       w.dewpoint, w.dewpoint_unit, w.wind_speed, w.wind_speed_unit, w.wind_direction, w.wind_gust,
       w.wind_gust_unit, w.probability_of_precipitation, w.probability_of_precipitation_unit,
       a.action_day AS air_quality_action_day, a.discussion AS air_quality_discussion, w.short_forecast,
       w.detailed_forecast, w.forecast_day_dtz
FROM a JOIN w ON a.location_id = w.location_id AND a.date_forecast_dtz = w.forecast_day_dtz
     JOIN orow ON orow.openaq_locations_id = a.location_id CROSS JOIN p"""

NEAREST_TIME_GLOBAL = """
WITH lp AS (SELECT ts, value FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, event_id DESC LIMIT 1)
SELECT v.event_id, v.user_id, v.ts, lp.ts AS aq_datetime_utc, lp.value AS aq_value,
       round(abs(epoch_us(v.ts) - epoch_us(lp.ts))::DOUBLE / 1000000.0::DOUBLE, 6) AS time_diff_seconds
FROM events v LEFT JOIN lp ON TRUE WHERE v.event_type = 'view'"""

NEAREST_TIME_PER_KEY = """
WITH v AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'),
pu AS (SELECT event_id AS p_event_id, user_id, ts AS p_ts, value AS p_value FROM events WHERE event_type = 'purchase'),
pr AS (SELECT v.event_id, v.user_id, v.ts, pu.p_event_id, pu.p_ts, pu.p_value
       FROM v ASOF LEFT JOIN pu ON v.user_id = pu.user_id AND v.ts >= pu.p_ts),
nx AS (SELECT v.event_id, pu.p_event_id AS n_event_id, pu.p_ts AS n_ts, pu.p_value AS n_value
       FROM v ASOF LEFT JOIN pu ON v.user_id = pu.user_id AND v.ts <= pu.p_ts),
j AS (SELECT pr.*, nx.n_event_id, nx.n_ts, nx.n_value,
             CASE WHEN pr.p_ts IS NULL THEN 'n' WHEN nx.n_ts IS NULL THEN 'p'
                  WHEN abs(epoch_us(pr.ts) - epoch_us(nx.n_ts)) < abs(epoch_us(pr.ts) - epoch_us(pr.p_ts)) THEN 'n'
                  ELSE 'p' END AS pick
      FROM pr JOIN nx ON pr.event_id = nx.event_id),
r AS (SELECT event_id, user_id, ts,
             CASE WHEN pick = 'p' THEN p_event_id ELSE n_event_id END AS r_event_id,
             CASE WHEN pick = 'p' THEN p_value ELSE n_value END AS r_value,
             CASE WHEN pick = 'p' THEN p_ts ELSE n_ts END AS r_ts
      FROM j)
SELECT event_id, user_id, ts, r_event_id, r_value, r_ts,
       round(abs(epoch_us(ts) - epoch_us(r_ts))::DOUBLE / 1000000.0::DOUBLE, 6) AS diff_seconds
FROM r"""

RANGE_CLEAN_FLAGS = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity >= 1 AND l_quantity <= 45 THEN l_quantity END + 0.0::DOUBLE AS quantity_clean,
       CASE WHEN l_discount >= 0 AND l_discount <= 0.08::DOUBLE THEN l_discount END + 0.0::DOUBLE AS discount_clean,
       CASE WHEN l_tax >= 0 AND l_tax <= 0.06::DOUBLE THEN l_tax END + 0.0::DOUBLE AS tax_clean,
       CASE WHEN l_quantity IS NOT NULL AND (l_quantity < 1 OR l_quantity > 45) THEN 'quantity_out_of_range'
            WHEN l_discount IS NOT NULL AND (l_discount < 0 OR l_discount > 0.08::DOUBLE) THEN 'discount_out_of_range'
            WHEN l_tax IS NOT NULL AND (l_tax < 0 OR l_tax > 0.06::DOUBLE) THEN 'tax_out_of_range' END AS quality_status,
       CASE WHEN (l_quantity IS NOT NULL AND (l_quantity < 1 OR l_quantity > 45))
              OR (l_discount IS NOT NULL AND (l_discount < 0 OR l_discount > 0.08::DOUBLE))
              OR (l_tax IS NOT NULL AND (l_tax < 0 OR l_tax > 0.06::DOUBLE)) THEN FALSE ELSE TRUE END AS is_valid
FROM lineitem"""

CATEGORY_REPAIR = f"""
WITH b AS (SELECT p_partkey, p_size * 12 - 50 AS aqi,
                  CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) % 7 AS category_number FROM part),
c AS (SELECT *, CASE WHEN aqi BETWEEN 0 AND 500 THEN aqi ELSE {_MID} END AS aqi_clean FROM b)
SELECT p_partkey, aqi, category_number, aqi_clean,
       CASE WHEN aqi_clean IS NOT NULL AND (aqi_clean < 0 OR aqi_clean > 500) THEN 'aqi_out_of_range' END AS quality_status,
       CASE WHEN aqi_clean IS NOT NULL AND (aqi_clean < 0 OR aqi_clean > 500) THEN FALSE ELSE TRUE END AS is_valid,
       CASE WHEN aqi_clean = -1 THEN {_ADJ} ELSE aqi_clean END AS adjusted_aqi,
       {_ADJ} AS adjusted_minus_one
FROM c"""

MEASUREMENT_NORMALIZE = """
WITH e AS (SELECT event_id,
                  CASE WHEN event_id % 7 = 0 THEN CAST(-value AS VARCHAR) WHEN event_id % 11 = 0 THEN 'n/a'
                       WHEN event_id % 13 = 0 THEN NULL ELSE json_extract_string(props, '$.k') END AS raw,
                  json_extract_string(props, '$.k') AS k
           FROM events),
v AS (SELECT *, TRY_CAST(trim(raw) AS DOUBLE) AS v FROM e)
SELECT event_id,
       CASE WHEN raw IS NOT NULL AND v IS NOT NULL AND v >= 0 THEN v END AS value_normalized,
       COALESCE(raw IS NOT NULL AND v IS NOT NULL AND v >= 0, FALSE) AS is_valid,
       CASE WHEN raw IS NULL THEN 'missing_value' WHEN v IS NULL THEN 'non_numeric_value'
            WHEN v < 0 THEN 'negative_value' END AS quality_status,
       TRY_CAST(trim(k) AS BIGINT) <> 0 AS k_flag,
       TRY_CAST(raw AS DOUBLE) AS lenient_value,
       CASE WHEN v = 0 THEN NULL ELSE v END AS strict_value
FROM v"""

TIME_PARSE_MIXED = f"""
WITH e AS (SELECT event_id,
                  CASE event_id % 5
                       WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
                       WHEN 1 THEN strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+02:00'
                       WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                       WHEN 3 THEN strftime(ts, '%Y-%m-%d')
                       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS s,
                  CASE user_id % 3 WHEN 0 THEN 'UTC' WHEN 1 THEN 'America/Chicago' ELSE 'Europe/Berlin' END AS zone,
                  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS local_text
           FROM events),
p AS (SELECT *, CAST(TRY_CAST(s AS TIMESTAMPTZ) AS TIMESTAMP) AS parsed_utc FROM e)
SELECT event_id, s, parsed_utc, (s IS NOT NULL AND parsed_utc IS NULL) AS parse_error, {_iso('parsed_utc')} AS iso,
       CAST(timezone(zone, CAST(local_text AS TIMESTAMP)) AS TIMESTAMP) AS local_utc
FROM p"""

EVENT_IDS = f"""
WITH j AS (SELECT e.*, c.*, n.*, date_trunc('hour', e.ts) AS hr,
                  e.event_type || upper(left(c.c_mktsegment, 1)) || lower(substr(c.c_mktsegment, 2)) AS camel
           FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT event_id,
       'open-meteo:weather:forecast:' || printf('%.4f', {C_LAT}) || ':' || printf('%.4f', {C_LON}) || ':'
           || {_iso('hr')} AS om_id,
       'airnow:' || replace(n_name || ' ' || c_mktsegment, ' ', '') || ':' || CAST(CAST(ts AS DATE) AS VARCHAR)
           || ':' || CAST(CAST(ts AS DATE) + 1 AS VARCHAR) AS airnow_id,
       n_name || ':' || CAST(c_nationkey AS VARCHAR) || ',' || CAST(user_id % 100 AS VARCHAR) || ':'
           || {_iso('hr')} || '-' || {_iso('hr + INTERVAL 1 HOUR')} AS nws_id,
       lower(regexp_replace(camel, '([A-Z])', '_\\1', 'g')) AS snake,
       array_to_string(list_filter([trim(c_name), trim('  '), trim(n_name)], lambda x: x <> ''), ' - ') AS joined,
       array_to_string(list_filter([trim(c_name), trim(''),
                                    trim(CASE WHEN c_nationkey % 2 = 0 THEN n_name ELSE CAST(c_nationkey AS VARCHAR) END)],
                                   lambda x: x <> ''), ' - ') AS canonical,
       'NWS ' || n_name || ' ' || CAST(c_nationkey AS VARCHAR) || ',' || CAST(user_id % 100 AS VARCHAR) AS grid_name
FROM j"""

PARALLEL_ARRAYS = """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS v1,
       CASE WHEN i <= 40 THEN CAST(embedding[i] AS DOUBLE) END AS v2
FROM (SELECT vec_id, embedding, generate_subscripts(embedding, 1) AS i FROM embeddings)"""

_START = "(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 HOUR * (p_partkey % 1000))"
FLATTEN_QUANTITIES = f"""
SELECT p_partkey,
       p_brand || ':' || CAST(p_partkey % 50 AS VARCHAR) || ',' || CAST(p_size AS VARCHAR) || ':'
           || {_iso(_START)} || '-' || {_iso(_START + " + INTERVAL 1 HOUR")} AS event_id,
       {_iso(_START)} AS start_time,
       CAST(p_size AS DOUBLE) AS temperature, CAST(p_size - 1 AS DOUBLE) AS temperature_min,
       CAST(NULL AS DOUBLE) AS temperature_max, 'wmoUnit:degC' AS temperature_unit,
       CAST(p_partkey % 100 AS DOUBLE) AS probability_of_precipitation,
       CASE WHEN p_size % 3 <> 0 THEN CAST(p_size * 2 AS DOUBLE) END AS relative_humidity,
       CASE WHEN p_size % 3 <> 0 THEN 100.0::DOUBLE END AS relative_humidity_max,
       CAST(NULL AS DOUBLE) AS dewpoint, CAST(p_size % 7 AS DOUBLE) AS wind_speed,
       CAST(p_size % 7 + 2 AS DOUBLE) AS wind_speed_max, 'wmoUnit:km_h-1' AS wind_speed_unit,
       CAST(NULL AS DOUBLE) AS wind_gust, p_size % 2 = 0 AS is_daytime, '2024-01-01T12:00:00Z' AS ingested_at
FROM part"""

SENSOR_MAP_DEDUPE = """
SELECT l_orderkey, l_returnflag, l_partkey, l_quantity, first_linenumber
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag
                                   ORDER BY l_linenumber DESC, l_partkey DESC, l_quantity DESC) AS rn,
             min(l_linenumber) OVER (PARTITION BY l_orderkey, l_returnflag) AS first_linenumber
      FROM lineitem WHERE l_returnflag IS NOT NULL AND l_returnflag <> '')
WHERE rn = 1"""

NEAREST_TOP1 = """
WITH c AS (SELECT n_nationkey, s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN abs(s_acctbal - n_nationkey * 400.0::DOUBLE) END AS distance
           FROM nation JOIN supplier ON n_nationkey = s_nationkey)
SELECT n_nationkey, s_suppkey, distance
FROM (SELECT *, row_number() OVER (PARTITION BY n_nationkey ORDER BY distance NULLS LAST, s_suppkey) AS rn FROM c)
WHERE rn = 1"""

MESSAGES_CTE = """
g AS (SELECT event_id AS "offset", user_id, event_id, concat('{"event_id": "e', event_id, '", "source": "events"',
        CASE WHEN event_id % 89 = 0 THEN '' WHEN event_id % 79 = 0 THEN ', "reporting_area": 7'
             WHEN event_id % 73 = 0 THEN ', "reporting_area": null' WHEN event_id % 71 = 0 THEN ', "reporting_area": ["u"]'
             ELSE concat(', "reporting_area": "u', user_id, '"') END,
        ', "aqi": ', CASE WHEN event_id % 83 = 0 THEN '"abc"' WHEN event_id % 67 = 0 THEN concat(CAST(floor(value) AS BIGINT), '.5')
             WHEN event_id % 61 = 0 THEN concat('"', CAST(floor(value) AS BIGINT), '"') ELSE concat(CAST(floor(value) AS BIGINT), '') END,
        ', "category_number": ', user_id % 6 + 1,
        ', "action_day": ', CASE WHEN event_id % 59 = 0 THEN '2' WHEN event_id % 7 = 0 THEN '"Yes"' WHEN event_id % 5 = 0 THEN '0' ELSE 'true' END,
        ', "raw_data": ', CASE WHEN event_id % 53 = 0 THEN '"text"' ELSE '{"a":1}' END, ', "extra": 1}') AS good FROM events),
msg AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'not json {' WHEN event_id % 101 = 0 THEN concat(good, ' x')
             WHEN event_id % 103 = 0 THEN left(good, 30) WHEN event_id % 107 = 0 THEN '5' WHEN event_id % 109 = 0 THEN '["e"]'
             ELSE good END AS value FROM g),
pj AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS j FROM msg),
pf AS (SELECT *, json_type(j) AS t, json_type(j, '$.event_id') AS t_id, json_type(j, '$.source') AS t_source,
        json_type(j, '$.reporting_area') AS t_area, json_type(j, '$.aqi') AS t_aqi, json_type(j, '$.category_number') AS t_cat,
        json_type(j, '$.action_day') AS t_day, json_type(j, '$.raw_data') AS t_raw,
        TRY_CAST(json_extract_string(j, '$.aqi') AS DOUBLE) AS aqi, TRY_CAST(json_extract_string(j, '$.category_number') AS DOUBLE) AS cat,
        lower(json_extract_string(j, '$.action_day')) AS day FROM pj),
pe AS (SELECT *, CASE WHEN j IS NULL THEN 'malformed_json' WHEN t <> 'OBJECT' THEN 'not_an_object'
        WHEN coalesce(t_id, 'NULL') = 'NULL' THEN 'missing:event_id' WHEN coalesce(t_source, 'NULL') = 'NULL' THEN 'missing:source'
        WHEN coalesce(t_area, 'NULL') = 'NULL' THEN 'missing:reporting_area'
        WHEN t_id <> 'VARCHAR' THEN 'type:event_id' WHEN t_source <> 'VARCHAR' THEN 'type:source'
        WHEN t_area <> 'VARCHAR' THEN 'type:reporting_area'
        WHEN t_aqi <> 'NULL' AND (aqi IS NULL OR aqi <> floor(aqi)) THEN 'type:aqi'
        WHEN t_cat <> 'NULL' AND (cat IS NULL OR cat <> floor(cat)) THEN 'type:category_number'
        WHEN t_day <> 'NULL' AND day NOT IN ('true', 'false', '0', '1', 'yes', 'no', 'on', 'off', 't', 'f', 'y', 'n') THEN 'type:action_day'
        WHEN t_raw <> 'NULL' AND t_raw <> 'OBJECT' THEN 'type:raw_data' END AS error FROM pf)"""

VALIDATE_SPLIT = f"""
WITH {MESSAGES_CTE}
SELECT "offset", json_extract_string(j, '$.event_id') AS event_id, json_extract_string(j, '$.source') AS source,
       json_extract_string(j, '$.reporting_area') AS reporting_area, CAST(aqi AS BIGINT) AS aqi, CAST(cat AS BIGINT) AS category_number,
       day IN ('true', '1', 'yes', 'on', 't', 'y') AS action_day, CAST(json_extract(j, '$.raw_data') AS VARCHAR) AS raw_data
FROM pe WHERE error IS NULL"""

MALFORMED_MESSAGES = f"""WITH {MESSAGES_CTE} SELECT "offset", value AS raw_value FROM pe WHERE error = 'malformed_json'"""

_DLQ = """SELECT CAST(user_id AS VARCHAR) AS key, 'events.airnow' AS original_topic, CAST(user_id % 4 AS INTEGER) AS "partition",
       "offset", error, value AS raw_value, '2024-01-01T00:00:00Z' AS ts_utc FROM pe WHERE error <> 'malformed_json'"""
DEAD_LETTERS = f"WITH {MESSAGES_CTE} {_DLQ}"

DEAD_LETTER_TOPIC = f"""WITH {MESSAGES_CTE}, dlq AS ({_DLQ})
SELECT key, CAST(to_json({{'original_topic': original_topic, 'partition': "partition", 'offset': "offset", 'error': error,
       'raw_value': raw_value, 'ts_utc': ts_utc}}) AS VARCHAR) AS value, 'events.airnow.dlq' AS topic FROM dlq"""

PUBLISH_PAYLOAD = """
SELECT CAST(n_nationkey AS VARCHAR) AS key,
       to_json({'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey})::VARCHAR AS value,
       'nation' AS topic FROM nation
UNION ALL
SELECT CAST(NULL AS VARCHAR) AS key, to_json({'r_regionkey': r_regionkey, 'r_name': r_name})::VARCHAR AS value,
       'region' AS topic FROM region
UNION ALL
SELECT CAST(c_custkey AS VARCHAR) AS key,
       to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
                'c_mktsegment': c_mktsegment})::VARCHAR AS value,
       'customer' AS topic FROM customer"""

UPSERT_LAST_WINS = """
SELECT user_id, event_type, arg_max(event_id, ts) AS event_id, max(ts) AS ts, arg_max(value, ts) AS value,
       min(ts) AS first_ts
FROM events GROUP BY user_id, event_type"""

UPSERT_COALESCE = """
WITH e AS (SELECT user_id, event_type, event_id, ts,
                  CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value FROM events)
SELECT user_id, event_type, arg_max(event_id, ts) AS event_id,
       arg_max(value, ts) FILTER (WHERE value IS NOT NULL) AS value,
       CASE WHEN count(*) > 1 THEN max(ts) END AS last_updated_at_dtz
FROM e GROUP BY user_id, event_type"""


def _scd2_sql(keys: list[str], tracked: list[str]) -> str:
    part = ", ".join(keys)
    order = "o_orderdate, o_orderkey"
    lags = ", ".join(f"lag({t}) OVER w AS prev_{t}" for t in tracked)
    chg = " OR ".join(f"prev_{t} IS DISTINCT FROM {t}" for t in tracked)
    cols = ", ".join(keys + [t for t in tracked if t not in keys])
    return f"""
WITH f AS (SELECT {cols}, o_orderkey, o_orderdate, {lags}, row_number() OVER w AS rn
           FROM orders WINDOW w AS (PARTITION BY {part} ORDER BY {order})),
g AS (SELECT *, CASE WHEN rn = 1 OR {chg} THEN 1 ELSE 0 END AS chg FROM f),
h AS (SELECT *, sum(chg) OVER (PARTITION BY {part} ORDER BY {order}
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM g),
k AS (SELECT *, max(o_orderdate) OVER (PARTITION BY {part}, grp) AS last_clock FROM h)
SELECT {cols}, o_orderkey, o_orderdate AS effective_start_at_dtz,
       lead(o_orderdate) OVER (PARTITION BY {part} ORDER BY {order}) AS effective_end_at_dtz,
       lead(o_orderdate) OVER (PARTITION BY {part} ORDER BY {order}) IS NULL AS is_current,
       last_clock AS last_updated_at_dtz
FROM k WHERE chg = 1"""


SCD2_DIMENSION = _scd2_sql(["o_custkey"], ["o_orderstatus", "o_orderpriority"])
SCD2_BRIDGE = _scd2_sql(["o_custkey", "o_orderpriority"], ["o_orderstatus"])

SCD2_CASCADE = """
WITH f AS (SELECT *, lag(o_orderstatus) OVER w AS ps, row_number() OVER w AS rn
           FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
g AS (SELECT *, CASE WHEN rn = 1 OR ps IS DISTINCT FROM o_orderstatus THEN o_orderkey END AS chg_key FROM f),
v AS (SELECT *, last_value(chg_key IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS location_version FROM g),
s AS (SELECT o_custkey, o_orderpriority, location_version, o_orderkey, o_orderdate,
             lag(location_version) OVER w2 AS pv, row_number() OVER w2 AS rn2
      FROM v WINDOW w2 AS (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey)),
k AS (SELECT * FROM s WHERE rn2 = 1 OR pv IS DISTINCT FROM location_version)
SELECT o_custkey, o_orderpriority, location_version, o_orderkey, o_orderdate AS effective_start_at_dtz,
       lead(o_orderdate) OVER w3 AS effective_end_at_dtz, lead(o_orderdate) OVER w3 IS NULL AS is_current
FROM k WINDOW w3 AS (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey)"""

HAVERSINE_PAIRS = f"""
SELECT c_custkey, n_nationkey,
       round({_gc(C_LAT, C_LON, "(40.0::DOUBLE + n_nationkey * 0.02::DOUBLE)", "(-90.0::DOUBLE + n_nationkey * 0.02::DOUBLE)")}, 6)
           AS distance_km
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

GEO_CTES = f"""
c AS (SELECT c_custkey, {C_LAT} AS plat, {C_LON} AS plon FROM customer),
s AS (SELECT s_suppkey, {S_LAT} AS qlat, {S_LON} AS qlon FROM supplier),
cand AS (SELECT c_custkey, s_suppkey, {_gc('plat', 'plon', 'qlat', 'qlon')} AS d
         FROM c JOIN s ON qlat BETWEEN plat - 0.05::DOUBLE AND plat + 0.05::DOUBLE
                      AND qlon BETWEEN plon - 0.05::DOUBLE AND plon + 0.05::DOUBLE),
best AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS rn FROM cand),
m AS (SELECT c.c_custkey, b.s_suppkey AS match_id, b.d
      FROM c LEFT JOIN best b ON c.c_custkey = b.c_custkey AND b.rn = 1 AND b.d <= 2.0::DOUBLE)"""

NEAREST_GEO = f"WITH {GEO_CTES} SELECT c_custkey, match_id, round(d, 6) AS distance_km FROM m"


def _first_come(unlinked: str) -> str:
    """Created points, one place after the other: a recursion that carries them as a list."""
    near = f"abs(p.lat - plat) <= 0.05::DOUBLE AND abs(p.lon - plon) <= 0.05::DOUBLE AND {_gc('plat', 'plon', 'p.lat', 'p.lon')} <= 2.0::DOUBLE"
    return f"""
u AS (SELECT plat, plon, min(c_custkey) AS o, row_number() OVER (ORDER BY min(c_custkey)) AS rn
      FROM c JOIN m USING (c_custkey) WHERE match_id IS NULL AND {unlinked} GROUP BY plat, plon),
r AS (SELECT 0::BIGINT AS taken, []::STRUCT(lat DOUBLE, lon DOUBLE, o BIGINT)[] AS made
      UNION ALL SELECT rn, CASE WHEN len(list_filter(made, lambda p: {near})) > 0 THEN made
                       ELSE list_append(made, {{'lat': plat, 'lon': plon, 'o': o}}) END FROM r JOIN u ON rn = taken + 1),
made AS (SELECT UNNEST(made, recursive := true) FROM (SELECT made FROM r ORDER BY taken DESC LIMIT 1))"""


def _linked(unlinked: str) -> str:
    """Each customer's link: to a supplier (``old``) or to the point created for customer ``o``."""
    return f"""{GEO_CTES}, {_first_come(unlinked)},
near AS (SELECT c_custkey, o, CASE WHEN plat = lat AND plon = lon THEN 0.0::DOUBLE ELSE {_gc('plat', 'plon', 'lat', 'lon')} END AS nd FROM c JOIN made ON o <= c_custkey
         WHERE (plat = lat AND plon = lon) OR (abs(lat - plat) <= 0.05::DOUBLE AND abs(lon - plon) <= 0.05::DOUBLE AND {_gc('plat', 'plon', 'lat', 'lon')} <= 2.0::DOUBLE)),
first AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY nd, o) AS rn FROM near),
l AS (SELECT m.c_custkey, match_id, o, match_id IS NOT NULL AND (o IS NULL OR d <= nd) AS old FROM m LEFT JOIN first f ON f.c_custkey = m.c_custkey AND rn = 1)"""


_UNLINKED = "c_custkey % 5 <> 0"
GEO_LINK = f"""WITH RECURSIVE {_linked(_UNLINKED)}
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN -c_custkey WHEN old THEN match_id END AS linked_id,
       CASE WHEN {_UNLINKED} AND NOT old THEN o END AS created_by, {_UNLINKED} AND NOT old AND o = c_custkey AS created FROM l"""
GEO_NEW_POINTS = f"""WITH RECURSIVE {GEO_CTES}, {_first_come('TRUE')}
SELECT lat AS latitude, lon AS longitude FROM made"""


def _forecast_by_geo() -> str:
    """The forecast mart with each location's place: a supplier's, or that of the customer it was created for."""
    places = _linked("TRUE").replace("2.0::DOUBLE", "1.0::DOUBLE")
    at = lambda side, loc: f"(SELECT {side}.*, place FROM {side} JOIN place ON c_custkey = {loc}) {side}"
    head, _, _ = DAILY_HOURLY_JOIN.strip().removeprefix("WITH ").partition("FROM a JOIN w ON")
    return f"""WITH place AS (WITH RECURSIVE {places}
  SELECT c_custkey, CASE WHEN old THEN match_id ELSE -o END AS place FROM l), {head}
FROM {at('a', 'location_id')} JOIN {at('w', 'location_id')} ON a.place = w.place AND a.date_forecast_dtz = w.forecast_day_dtz
     JOIN {at('orow', 'openaq_locations_id')} ON orow.place = a.place CROSS JOIN p"""


FORECAST_BY_GEO = _forecast_by_geo()


def _window_read() -> str:
    lat, lon, tol = 40.25, -89.75, 0.1
    b = {k: repr(v) for k, v in (("la0", lat - tol), ("la1", lat + tol), ("lo0", lon - tol), ("lo1", lon + tol))}
    rows = lambda kind, idn, val: f"""SELECT e.event_id AS {idn}, date_trunc('hour', e.ts) AS st,
           date_trunc('hour', e.ts) + INTERVAL 1 HOUR AS en, 'forecast' AS record_type,
           {C_LAT} AS latitude, {C_LON} AS longitude, e.value AS {val}
    FROM events e JOIN customer c ON e.user_id = c.c_custkey WHERE e.event_type = '{kind}'"""  # noqa: E731
    box = (f"latitude BETWEEN CAST('{b['la0']}' AS DOUBLE) AND CAST('{b['la1']}' AS DOUBLE) "
           f"AND longitude BETWEEN CAST('{b['lo0']}' AS DOUBLE) AND CAST('{b['lo1']}' AS DOUBLE) "
           f"AND st >= (SELECT lo FROM lo) AND st < (SELECT lo FROM lo) + INTERVAL 744 HOUR")
    return f"""
WITH lo AS (SELECT date_trunc('day', min(ts)) AS lo FROM events),
w AS (SELECT * FROM ({rows('view', 'wx_event_id', 'temperature')}) WHERE {box}),
a0 AS (SELECT * FROM ({rows('click', 'air_event_id', 'pm2_5')}) WHERE {box}),
a AS (SELECT DISTINCT ON (st) st, air_event_id, pm2_5 FROM a0 ORDER BY st, air_event_id DESC)
SELECT w.st AS start_time_utc, w.en AS end_time_utc, w.record_type, w.latitude, w.longitude, w.wx_event_id,
       w.temperature, a.air_event_id, a.pm2_5
FROM w LEFT JOIN a ON w.st = a.st"""


WINDOW_READ = _window_read()


def _check_sql(table: str, kind: str, col: str, low=None, high=None, values=(), mostly=1.0) -> str:
    if kind == "not_null":
        unexp = f"{col} IS NULL"
        base = "count(*)"
    elif kind == "between":
        conds = []
        if low is not None:
            conds.append(f"{col} < {float(low)!r}::DOUBLE")
        if high is not None:
            conds.append(f"{col} > {float(high)!r}::DOUBLE")
        unexp = f"{col} IS NOT NULL AND ({' OR '.join(conds)})"
        base = f"count({col})"
    else:
        vals = ", ".join("'" + v + "'" for v in values)
        unexp = f"{col} IS NOT NULL AND {col} NOT IN ({vals})"
        base = f"count({col})"
    u = f"count(*) FILTER (WHERE {unexp})"
    ratio = f"(CASE WHEN {base} > 0 THEN {u}::DOUBLE / {base} ELSE 0.0::DOUBLE END)"
    return (f"SELECT '{table}' AS table_name, '{kind}' AS \"check\", '{col}' AS column_name, count(*) AS n, "
            f"count({col}) AS nonnull, {u} AS unexpected, round({ratio}, 6) AS unexpected_ratio, "
            f"(1.0::DOUBLE - {ratio}) >= {float(mostly)!r}::DOUBLE AS success FROM {table}")


QUALITY_SUITE = "\nUNION ALL\n".join([
    _check_sql("lineitem", "not_null", "l_orderkey"),
    _check_sql("lineitem", "between", "l_quantity", 1, 45, mostly=0.9),
    _check_sql("lineitem", "between", "l_discount", 0, 0.08, mostly=0.99),
    _check_sql("lineitem", "in_set", "l_returnflag", values=("A", "N")),
    _check_sql("lineitem", "not_null", "l_shipdate"),
    _check_sql("customer", "between", "c_acctbal", 0, None, mostly=0.9),
    _check_sql("customer", "in_set", "c_mktsegment",
               values=("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD")),
    _check_sql("customer", "not_null", "c_name"),
    _check_sql("events", "between", "value", 0, None),
    _check_sql("events", "not_null", "props"),
    _check_sql("events", "accepted_values", "event_type", values=("click", "view", "purchase", "signup"), mostly=0.7),
])

UNIQUE_CHECK = """
SELECT o_custkey, o_orderdate, count(*) AS n FROM orders
WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
GROUP BY o_custkey, o_orderdate HAVING count(*) > 1"""

ACCEPTED_RANGE = "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0"

ACCEPTED_RANGE_BOTH = "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45"


def _model_checks() -> str:
    head, _, _ = DAILY_HOURLY_JOIN.partition("a AS (SELECT date_forecast_dtz")
    upto, _, _ = DAILY_HOURLY_JOIN.partition("w AS (SELECT location_id")
    bad = ("(temperature IS NOT NULL AND (temperature < -80 OR temperature > 80)) OR (relative_humidity IS NOT NULL AND (relative_humidity < 0 "
           "OR relative_humidity > 100)) OR (probability_of_precipitation IS NOT NULL AND (probability_of_precipitation < 0 OR "
           "probability_of_precipitation > 100)) OR (wind_speed IS NOT NULL AND (wind_speed < 0 OR wind_speed > 300))")
    clean = ", ".join(f"CASE WHEN {c} BETWEEN {a} AND {b} THEN {c} END AS {c}_clean" for c, a, b in (
        ("temperature", -80, 80), ("relative_humidity", 0, 100), ("probability_of_precipitation", 0, 100), ("wind_speed", 0, 300)))
    m2, _, _ = O1_CTES.partition("lm AS (SELECT")
    every = m2.replace("FROM m WHERE mtype = 'events.latest'", "FROM m").rstrip().rstrip(",")
    sql = {
        "stg_openaq_measurements_by_location": f"WITH {every} SELECT * FROM m2",
        "stg_weather_hourly_forecast": f"{upto.rstrip().rstrip(',')} SELECT {clean}, NOT ({bad}) AS is_valid FROM w0",
        "stg_airnow_air_quality_forecast": f"{head.rstrip().rstrip(',')} SELECT *, NOT (aqi_clean IS NOT NULL AND (aqi_clean < 0 OR aqi_clean > 500)) AS is_valid FROM a1",
        "fct_openaq_latest_by_location": LATEST_BY_LOCATION,
        "fct_open_meteo_current_weather_air_conditions": CURRENT_BY_LOCATION,
        "fct_open_meteo_latest_weather_air_forecast": LATEST_FORECAST,
        "fct_air_weather_forecast": DAILY_HOURLY_JOIN}
    tables = {n: (q, [ch for ch in MODEL_CHECKS[n] if ch.column != "us_aqi"]) for n, q in sql.items()}
    absent = " UNION ALL ".join(  # marts bound here have no such column, so their check fails
        f"SELECT '{n}', 'between', 'us_aqi', count(*), 0, count(*), 1.0::DOUBLE, FALSE FROM ({q})" for n, q in sql.items()
        if any(ch.column == "us_aqi" for ch in MODEL_CHECKS[n]))
    return checks_sql(tables) + " SELECT * FROM s UNION ALL " + absent


MODEL_CHECKS_SQL = _model_checks()

VOLUME_ANOMALY = """
WITH c AS (SELECT date_trunc('day', ts) AS bucket, count(*) AS n FROM events GROUP BY 1),
w AS (SELECT bucket, n, avg(n) OVER win AS m, stddev_samp(n) OVER win AS sd FROM c
      WINDOW win AS (ORDER BY bucket ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
SELECT bucket, n, round(m, 6) AS trailing_mean, round(sd, 6) AS trailing_stddev,
       round(CASE WHEN sd > 0 THEN (n - m) / sd END, 6) AS z_score,
       COALESCE(abs(CASE WHEN sd > 0 THEN (n - m) / sd END) > 3.0::DOUBLE, FALSE) AS is_anomaly
FROM w"""

BACKFILL_FLAGS = """
WITH t AS (SELECT event_id,
                  CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 7 = 0 THEN -value ELSE value END AS value,
                  CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value_normalized,
                  CASE WHEN event_id % 4 = 0 THEN NULL ELSE TRUE END AS is_valid,
                  CASE WHEN event_id % 2 = 0 THEN 'legacy' END AS quality_status
           FROM events),
r AS (SELECT *, (value_normalized IS NULL OR is_valid IS NULL OR quality_status IS NULL) AS redo FROM t)
SELECT event_id, value,
       CASE WHEN redo THEN (CASE WHEN value IS NULL OR value < 0 THEN NULL ELSE value END) ELSE value_normalized END
           AS value_normalized,
       CASE WHEN redo THEN (CASE WHEN value IS NULL OR value < 0 THEN FALSE ELSE TRUE END) ELSE is_valid END AS is_valid,
       CASE WHEN redo THEN (CASE WHEN value IS NULL THEN 'missing_value' WHEN value < 0 THEN 'negative_value' END)
            ELSE quality_status END AS quality_status
FROM r"""

STREAM_REPLAY = """
SELECT user_id, event_type, arg_max(event_id, ts) AS event_id, max(ts) AS ts, arg_max(value, ts) AS value
FROM events GROUP BY user_id, event_type"""

ORACLE_SQL = {
    "latest_by_location": LATEST_BY_LOCATION,
    "latest_pivot": LATEST_PIVOT,
    "current_snapshot": CURRENT_SNAPSHOT,
    "current_by_location": CURRENT_BY_LOCATION,
    "latest_forecast": LATEST_FORECAST,
    "distinct_on_first": DISTINCT_ON_FIRST,
    "distinct_on_last": DISTINCT_ON_LAST,
    "daily_hourly_join": DAILY_HOURLY_JOIN,
    "nearest_time_global": NEAREST_TIME_GLOBAL,
    "nearest_time_per_key": NEAREST_TIME_PER_KEY,
    "range_clean_flags": RANGE_CLEAN_FLAGS,
    "category_repair": CATEGORY_REPAIR,
    "measurement_normalize": MEASUREMENT_NORMALIZE,
    "time_parse_mixed": TIME_PARSE_MIXED,
    "event_ids": EVENT_IDS,
    "parallel_arrays": PARALLEL_ARRAYS,
    "flatten_quantities": FLATTEN_QUANTITIES,
    "sensor_map_dedupe": SENSOR_MAP_DEDUPE,
    "nearest_top1": NEAREST_TOP1,
    "validate_split": VALIDATE_SPLIT,
    "malformed_messages": MALFORMED_MESSAGES,
    "dead_letters": DEAD_LETTERS,
    "dead_letter_topic": DEAD_LETTER_TOPIC,
    "publish_payload": PUBLISH_PAYLOAD,
    "upsert_last_wins": UPSERT_LAST_WINS,
    "upsert_coalesce": UPSERT_COALESCE,
    "scd2_dimension": SCD2_DIMENSION,
    "scd2_bridge": SCD2_BRIDGE,
    "scd2_replay": SCD2_DIMENSION,
    "scd2_cascade": SCD2_CASCADE,
    "haversine_pairs": HAVERSINE_PAIRS,
    "nearest_geo": NEAREST_GEO,
    "geo_link": GEO_LINK,
    "geo_new_points": GEO_NEW_POINTS,
    "forecast_by_geo": FORECAST_BY_GEO,
    "window_read": WINDOW_READ,
    "quality_suite": QUALITY_SUITE,
    "unique_check": UNIQUE_CHECK,
    "accepted_range": ACCEPTED_RANGE,
    "accepted_range_both": ACCEPTED_RANGE_BOTH,
    "model_checks": MODEL_CHECKS_SQL,
    "volume_anomaly": VOLUME_ANOMALY,
    "backfill_flags": BACKFILL_FLAGS,
    "stream_replay": STREAM_REPLAY,
    **INGEST_SQL,
    **SUITE_SQL,
    **OPENAQ_SQL,
    **BODY_SQL,
}

ORACLE_SQL["mart_refresh"] = " UNION ALL ".join(
    f"SELECT '{n}' AS mart, count(*) AS live_rows, TRUE AS refused FROM ({ORACLE_SQL[n]})" for n in ("latest_by_location", "current_by_location"))
