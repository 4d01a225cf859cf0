"""Time parsing and formatting.

All helpers assume ``spark.sql.session.timeZone=UTC`` (see envlake.session).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FALLBACK_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_utc(c: Column | str, dtype: T.DataType | None = None) -> tuple[Column, Column]:
    """Mixed-input timestamp -> (utc_timestamp, error_flag).

    * timestamp input passes through (naive values are UTC already);
    * numbers are epoch seconds (fraction kept to the microsecond);
    * strings are ISO-8601 with ``Z``/offset or naive (= UTC), with a
      ``yyyy-MM-dd HH:mm:ss`` fallback.
    The error flag is true when a non-null input could not be parsed, so the
    caller can route the row to a dead-letter output instead of raising.
    """
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        ts = col.cast("timestamp")
    elif isinstance(dtype, T.DateType):
        ts = col.cast("timestamp")
    elif isinstance(dtype, T.NumericType):
        ts = F.timestamp_micros(F.round(col.cast("double") * F.lit(1e6)).cast("bigint"))
    else:
        s = F.trim(col.cast("string"))
        ts = F.coalesce(F.try_to_timestamp(s), F.try_to_timestamp(s, F.lit(FALLBACK_FORMAT)))
    err = col.isNotNull() & ts.isNull()
    return ts, err


def local_to_utc(local_iso: Column | str, tz_name: Column | str) -> Column:
    """Local wall-clock ISO text (no offset) interpreted in an IANA zone -> UTC.

    ``tz_name`` may be a column, so one job serves many zones."""
    s = F.col(local_iso) if isinstance(local_iso, str) else local_iso
    tz = F.col(tz_name) if isinstance(tz_name, str) else tz_name
    return F.to_utc_timestamp(F.try_to_timestamp(s), tz)


def iso_z(ts: Column | str) -> Column:
    """ISO-8601 UTC text ending in ``Z``; microseconds only when non-zero."""
    t = F.col(ts) if isinstance(ts, str) else ts
    frac = F.date_format(t, "SSSSSS")
    return F.when(t.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
                 F.when(frac != F.lit("000000"), F.concat(F.lit("."), frac)).otherwise(F.lit("")),
                 F.lit("Z")))


def seconds_between(a: Column, b: Column) -> Column:
    """(a - b) in seconds as double, exact to the microsecond."""
    return (F.unix_micros(a) - F.unix_micros(b)) / F.lit(1e6)


def age_seconds(ts: Column, now: Column) -> Column:
    """``extract(epoch from ts - now)::bigint``: rounds half away from zero like
    the SQL cast (a bare Spark cast would truncate)."""
    return F.round(seconds_between(ts, now)).cast("bigint")


def trunc_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def trunc_day(ts: Column) -> Column:
    return F.date_trunc("day", ts)
