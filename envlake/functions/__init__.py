"""Column-expression helpers (all JVM built-ins, codegen friendly)."""

from envlake.functions.timefn import (  # noqa: F401
    parse_utc, local_to_utc, iso_z, age_seconds, seconds_between, trunc_hour, trunc_day,
)
from envlake.functions.coerce import (  # noqa: F401
    as_bool, float_or_null, strict_float, strict_float_error, falsy_default, safe_get, try_int,
)
from envlake.functions.clean import (  # noqa: F401
    Rule, range_clean, quality_status, is_valid, aqi_repair, aqi_flags, adjusted_aqi,
    normalize_measurement, WEATHER_RULES,
)
from envlake.functions.ids import (  # noqa: F401
    fmt4, open_meteo_event_id, measurement_event_id, airnow_event_id, nws_event_id,
    fallback_id, snake_case, snake_case_name, join_nonempty, canonical_name, nws_gridpoint_name,
)
from envlake.functions.geo import great_circle_km, EARTH_RADIUS_KM  # noqa: F401
