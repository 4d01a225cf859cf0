"""Event ids, canonical names and name conversions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from envlake.functions.timefn import iso_z


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def fmt4(x: Column | str) -> Column:
    """``%.4f`` of a double (JVM rounds half-up on the decimal text)."""
    return F.format_string("%.4f", _c(x).cast("double"))


def open_meteo_event_id(kind: Column | str, record_type: Column | str, lat, lon, start_utc) -> Column:
    """``open-meteo:<kind>:<record_type>:<lat %.4f>:<lon %.4f>:<start iso Z>``.

    ``kind`` / ``record_type`` are literals (str) or columns."""
    k = kind if isinstance(kind, Column) else F.lit(kind)
    rt = record_type if isinstance(record_type, Column) else F.lit(record_type)
    return F.concat_ws(":", F.lit("open-meteo"), k, rt, fmt4(lat), fmt4(lon), iso_z(_c(start_utc)))


def measurement_event_id(location_id, sensor_id, event_type, ts) -> Column:
    """``<location>:<sensor>:<event_type>:<ts iso Z>``."""
    et = F.lit(event_type) if isinstance(event_type, str) else event_type
    return F.concat_ws(":", _c(location_id).cast("string"), _c(sensor_id).cast("string"), et,
                       F.coalesce(iso_z(_c(ts)), F.lit("unknown")))


def airnow_event_id(reporting_area, date_issue, date_forecast) -> Column:
    """``airnow:<area without spaces>:<issue>:<forecast>`` (parameter not included)."""
    area = F.replace(F.coalesce(_c(reporting_area), F.lit("unknown")), F.lit(" "), F.lit(""))
    return F.concat(F.lit("airnow:"), area, F.lit(":"), F.coalesce(_c(date_issue).cast("string"), F.lit("None")),
                    F.lit(":"), F.coalesce(_c(date_forecast).cast("string"), F.lit("None")))


def nws_event_id(grid_id, grid_x, grid_y, start, end) -> Column:
    """``<grid_id>:<x>,<y>:<start>-<end>`` with 'unknown' for absent grid parts."""
    def part(c):
        return F.coalesce(_c(c).cast("string"), F.lit("unknown"))
    return F.concat(part(grid_id), F.lit(":"), part(grid_x), F.lit(","), part(grid_y), F.lit(":"),
                    F.coalesce(_c(start).cast("string"), F.lit("None")), F.lit("-"),
                    F.coalesce(_c(end).cast("string"), F.lit("None")))


def fallback_id(event_id, *parts) -> Column:
    """Keep a non-empty event id, else build one from the given parts."""
    e = _c(event_id)
    built = F.concat_ws(":", *[_c(p).cast("string") for p in parts])
    return F.when(e.isNull() | (e == F.lit("")), built).otherwise(e)


_CAMEL = re.compile(r"(?<!^)(?=[A-Z])")


def snake_case_name(name: str) -> str:
    """camelCase -> snake_case for plan-time column names."""
    return _CAMEL.sub("_", name).lower()


def snake_case(c: Column | str) -> Column:
    return F.lower(F.regexp_replace(_c(c), r"(?<!^)(?=[A-Z])", "_"))


def join_nonempty(*parts, sep: str = " - ") -> Column:
    """Trim each part, drop empty/NULL ones, join the rest with ``sep``."""
    arr = F.array(*[F.trim(F.coalesce(_c(p).cast("string"), F.lit(""))) for p in parts])
    return F.array_join(F.filter(arr, lambda x: x != F.lit("")), sep)


def canonical_name(name, locality, country_name, country_code, location_id) -> Column:
    """Human-readable location label with a generic fallback."""
    country = F.when(F.coalesce(_c(country_name), F.lit("")) != F.lit(""), _c(country_name)) \
        .otherwise(_c(country_code))
    j = join_nonempty(name, locality, country)
    return F.when(j != F.lit(""), j).otherwise(
        F.concat(F.lit("OpenAQ location "), _c(location_id).cast("string")))


def nws_gridpoint_name(office, grid_x, grid_y) -> Column:
    return F.format_string("NWS %s %s,%s", _c(office), _c(grid_x), _c(grid_y))
