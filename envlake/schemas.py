"""Declared table schemas (DDL strings; never inferred). Keys are enforced by
the upsert / SCD-2 operators and asserted by the quality checks."""

from __future__ import annotations

_QUANT = ", ".join(f"{q} DOUBLE, {q}_min DOUBLE, {q}_max DOUBLE, {q}_unit STRING" for q in (
    "temperature", "relative_humidity", "dewpoint", "wind_speed", "wind_gust", "probability_of_precipitation"))
_SCD = "effective_start_at_dtz TIMESTAMP, effective_end_at_dtz TIMESTAMP, is_current BOOLEAN"

TABLES = {
    "stg_openaq_measurements_by_location":
        "event_id STRING, openaq_locations_id BIGINT, openaq_sensors_id BIGINT, datetime_utc TIMESTAMP, "
        "value DOUBLE, value_normalized DOUBLE, is_valid BOOLEAN, quality_status STRING, source STRING, "
        "event_type STRING, source_version STRING, ingested_at_dtz TIMESTAMP, last_updated_at_dtz TIMESTAMP",
    "stg_weather_hourly_forecast":
        "event_id STRING, event_type STRING, source STRING, office STRING, grid_id STRING, grid_x INT, grid_y INT, "
        "start_time TIMESTAMP, end_time TIMESTAMP, is_daytime BOOLEAN, temperature_trend STRING, "
        f"wind_direction STRING, short_forecast STRING, detailed_forecast STRING, {_QUANT}, "
        "ingested_at_dtz TIMESTAMP, last_updated_at_dtz TIMESTAMP",
    "stg_airnow_air_quality_forecast":
        "event_id STRING, source STRING, date_issue_dtz TIMESTAMP, date_forecast_dtz TIMESTAMP, "
        "reporting_area STRING, state_code STRING, latitude DOUBLE, longitude DOUBLE, parameter_name STRING, "
        "aqi INT, category_number INT, category_name STRING, action_day BOOLEAN, discussion STRING, "
        f"raw_data STRING, {_SCD}, last_updated_at_dtz TIMESTAMP",
    "stg_open_meteo_weather":
        "event_id STRING, record_type STRING, record_frequency_min INT, open_meteo_start_time TIMESTAMP, "
        "open_meteo_end_time TIMESTAMP, latitude DOUBLE, longitude DOUBLE, temperature DOUBLE, "
        "temperature_unit STRING, rel_humidity DOUBLE, rel_humidity_unit STRING, dew_point DOUBLE, "
        "dew_point_unit STRING, apparent_temperature DOUBLE, apparent_temperature_unit STRING, "
        "precipitation_prob DOUBLE, precipitation_prob_unit STRING, precipitation DOUBLE, precipitation_unit STRING, "
        "cloud_cover DOUBLE, cloud_cover_unit STRING, wind_speed DOUBLE, wind_speed_unit STRING, wind_gusts DOUBLE, "
        "wind_gusts_unit STRING, wind_direction DOUBLE, wind_direction_unit STRING, is_day BOOLEAN, "
        "ingested_at_dtz TIMESTAMP, last_updated_at_dtz TIMESTAMP",
    "stg_open_meteo_air":
        "event_id STRING, record_type STRING, record_frequency_min INT, open_meteo_start_time TIMESTAMP, "
        "open_meteo_end_time TIMESTAMP, latitude DOUBLE, longitude DOUBLE, pm2_5 DOUBLE, pm2_5_unit STRING, "
        "pm10 DOUBLE, pm10_unit STRING, us_aqi DOUBLE, us_aqi_unit STRING, ozone DOUBLE, ozone_unit STRING, "
        "uv_index DOUBLE, uv_index_unit STRING, ingested_at_dtz TIMESTAMP, last_updated_at_dtz TIMESTAMP",
    "dim_openaq_locations":
        "locations_id_sk BIGINT, openaq_locations_id BIGINT, name STRING, locality STRING, timezone STRING, "
        "country_id BIGINT, country_code STRING, country_name STRING, owner_id BIGINT, owner_name STRING, "
        "provider_id BIGINT, provider_name STRING, latitude DOUBLE, longitude DOUBLE, first_seen_at TIMESTAMP, "
        f"last_seen_at TIMESTAMP, {_SCD}, last_updated_at_dtz TIMESTAMP",
    "dim_openaq_sensors":
        "sensors_id_sk BIGINT, openaq_sensors_id BIGINT, locations_id_sk BIGINT, parameter_id BIGINT, "
        f"parameter_name STRING, parameter_display_name STRING, parameter_units STRING, {_SCD}",
    "dim_openaq_licenses":
        "license_id_sk BIGINT, openaq_license_id BIGINT, name STRING, commercial_use_allowed BOOLEAN, "
        "attribution_required BOOLEAN, share_alike_required BOOLEAN, modification_allowed BOOLEAN, "
        f"redistribution_allowed BOOLEAN, source_url STRING, {_SCD}, last_updated_at_dtz TIMESTAMP",
    "openaq_locations_license_bridge":
        "locations_id_sk BIGINT, license_id_sk BIGINT, license_attribution_name STRING, "
        "license_attribution_url STRING, license_date_from_dtz TIMESTAMP, license_date_to_dtz TIMESTAMP, "
        f"{_SCD}",
    "dim_geo_locations":
        "geo_location_id_sk BIGINT, latitude DOUBLE, longitude DOUBLE, canonical_name STRING, source STRING",
    "dim_nws_gridpoints":
        "office_id STRING, grid_x INT, grid_y INT, geo_location_id_sk BIGINT, canonical_name STRING",
    "etl_job_runs":
        "dag_id STRING, run_id STRING, execution_date TIMESTAMP, start_time TIMESTAMP, end_time TIMESTAMP, "
        "state STRING, error_message STRING, created_at TIMESTAMP",
}

# Business keys (for check_unique and the upsert / SCD-2 operators).
KEYS = {
    "stg_openaq_measurements_by_location": ["event_id"], "stg_weather_hourly_forecast": ["event_id"],
    "stg_airnow_air_quality_forecast": ["event_id"], "stg_open_meteo_weather": ["event_id"],
    "stg_open_meteo_air": ["event_id"], "dim_openaq_locations": ["openaq_locations_id", "effective_start_at_dtz"],
    "dim_openaq_sensors": ["openaq_sensors_id", "effective_start_at_dtz"],
    "dim_openaq_licenses": ["openaq_license_id", "effective_start_at_dtz"],
    "openaq_locations_license_bridge": ["locations_id_sk", "license_id_sk", "effective_start_at_dtz"],
    "dim_nws_gridpoints": ["office_id", "grid_x", "grid_y"],
}
