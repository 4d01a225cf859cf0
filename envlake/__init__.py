"""envlake: Spark-native ingest, upsert, dimension history, marts and quality checks
for environmental time-series data (air quality, forecasts, current conditions).

Everything is expressed with DataFrame / SQL built-ins so Catalyst and AQE plan
the work; there are no Python UDFs on any hot path.
"""

__version__ = "0.1.0"
