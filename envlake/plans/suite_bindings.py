"""The declared staging suites bound to the driver tables, with planted faults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.operators import quality as Q
from envlake.plans import driver_tables as D

_NWS = """
SELECT concat('n', CAST(event_id % 900 AS STRING)) AS event_id, CASE WHEN event_id % 50 <> 0 THEN 'api' END AS source, 'o' AS office,
       'g' AS grid_id, user_id AS grid_x, 7 AS grid_y, ts AS start_time, ts AS end_time,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 2 = 0 END AS is_daytime, value * 2 - 60 AS temperature,
       value AS relative_humidity, CAST(user_id % 103 AS DOUBLE) AS probability_of_precipitation, value * 3 AS wind_speed
FROM events"""
_AIRNOW = """
SELECT concat('a', CAST(o_orderkey AS STRING)) AS event_id, 'airnow' AS source, o_orderdate AS date_issue_dtz,
       o_orderdate AS date_forecast_dtz, CASE WHEN o_custkey % 40 <> 0 THEN 'area' END AS reporting_area, 'WI' AS state_code,
       43.0 AS latitude, -89.0 AS longitude, o_orderstatus AS parameter_name, CAST(o_orderkey % 503 AS INT) - 1 AS aqi,
       CAST(substr(o_orderpriority, 1, 1) AS INT) + 1 AS category_number,
       CASE CAST(substr(o_orderpriority, 1, 1) AS INT) WHEN 1 THEN 'Good' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Unhealthy'
            WHEN 4 THEN 'Hazardous' ELSE 'Bad' END AS category_name, '{}' AS raw_data, o_orderdate AS effective_start_at_dtz,
       o_orderstatus = 'F' AS action_day
FROM orders"""
_OPENAQ = """
SELECT concat(CAST(user_id AS STRING), ':', event_type, ':', CAST(event_id % 5000 AS STRING)) AS event_id, user_id AS openaq_locations_id,
       event_type AS openaq_sensors_id, ts AS datetime_utc, CASE WHEN event_id % 30 <> 0 THEN value END AS value,
       CASE WHEN event_id % 31 = 0 THEN -value ELSE value END AS value_normalized, event_id % 2 = 0 AS is_valid,
       CASE event_id % 5 WHEN 0 THEN 'negative_value' WHEN 1 THEN 'odd' END AS quality_status, 'events' AS source,
       '1' AS source_version, 'latest' AS event_type, ts AS ingested_at_dtz
FROM events"""
_SUITES = {"nws": ("events", _NWS, Q.NWS_SUITE), "airnow": ("orders", _AIRNOW, Q.AIRNOW_SUITE), "openaq": ("events", _OPENAQ, Q.OPENAQ_SUITE)}


def _results(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, (source, sql, suite) in _SUITES.items():
        staged = spark.sql(sql.replace(f"FROM {source}", "FROM {src}").replace("'{}'", "'{{}}'"), src=D.table(spark, d, source))
        res = Q.run_suite(staged, name, suite)
        out = res if out is None else out.unionByName(res)
    return out


def staging_suites(spark: SparkSession, d: str) -> DataFrame:
    """One row a declared expectation of the three staging tables."""
    return _results(spark, d)


def staging_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """One row a table: whether its suite passed, and what failed."""
    return Q.suite_verdict(_results(spark, d))


QUERIES = {f.__name__: f for f in (staging_suites, staging_verdicts)}


def _unexpected_sql(ch: Q.Check) -> str:
    c = ch.column
    if ch.kind == "not_null":
        return f"{c} IS NULL"
    if ch.kind == "between":
        low, high = (None if x is None else f"{float(x)!r}::DOUBLE" for x in (ch.low, ch.high))
        return " OR ".join([f"{c} < {low}"] * (low is not None) + [f"{c} > {high}"] * (high is not None))
    return f"CAST({c} AS VARCHAR) NOT IN (" + ", ".join(f"'{str(v).lower() if isinstance(v, bool) else v}'" for v in ch.values) + ")"


def checks_sql(tables: dict[str, tuple[str, list[Q.Check]]]) -> str:
    """``WITH ..., s AS (one row a check)`` over the tables' SQL."""
    parts = []
    for name, (_, suite) in tables.items():
        for ch in suite:
            bad = (f"(SELECT coalesce(sum(k), 0) FROM (SELECT count(*) AS k FROM {name} WHERE {ch.column} IS NOT NULL GROUP BY {ch.column} HAVING count(*) > 1))"
                   if ch.kind == "unique" else f"count(*) FILTER (WHERE {_unexpected_sql(ch)})")
            base = "count(*)" if ch.kind == "not_null" else f"count({ch.column})"
            parts.append(f"SELECT '{name}' AS table_name, '{ch.kind}' AS kind, '{ch.column}' AS column_name, count(*) AS n, "
                         f"count({ch.column}) AS nonnull, CAST({bad} AS BIGINT) AS unexpected, CAST({base} AS DOUBLE) AS base, "
                         f"{ch.mostly!r}::DOUBLE AS mostly FROM {name}")
    ctes = ", ".join(f"{name} AS ({sql})" for name, (sql, _) in tables.items())
    return (f"WITH {ctes}, r AS ({' UNION ALL '.join(parts)}), s AS (SELECT table_name, kind AS \"check\", column_name, n, nonnull, unexpected, "
            "round(CASE WHEN base > 0 THEN unexpected / base ELSE 0 END, 6) AS unexpected_ratio, "
            "1.0::DOUBLE - (CASE WHEN base > 0 THEN unexpected / base ELSE 0 END) >= mostly AS success FROM r)")


def _oracle_results() -> str:
    return checks_sql({name: (sql.replace("STRING", "VARCHAR"), suite) for name, (_, sql, suite) in _SUITES.items()})


ORACLE_SQL = {
    "staging_suites": _oracle_results() + " SELECT * FROM s",
    "staging_verdicts": _oracle_results() + """
        SELECT table_name, bool_and(success) AS success,
               coalesce(string_agg("check" || ':' || column_name, ',' ORDER BY "check" || ':' || column_name) FILTER (NOT success), '') AS failed
        FROM s GROUP BY table_name""",
}
