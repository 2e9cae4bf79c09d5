"""Average speed in km/h, recomputed from cleaned distance and performance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from racelake.functions.columns import as_col

# Fixed values.
KM_PER_MILE = 1.60934
SPEED_DECIMALS = 3
SPEED_MAX_KMH = 50
RAW_SPEED_SCALE_LIMIT = 1000


def _to_km(unit: Column) -> Column:
    return F.when(unit == "km", F.lit(1.0)).when(unit == "mi", F.lit(KM_PER_MILE))


def average_speed_kmh(distance_value: Column | str, distance_unit: Column | str,
                      seconds: Column | str, perf_distance: Column | str,
                      perf_unit: Column | str) -> Column:
    """km/h, rounded half-up to 3 decimals.

    Distance events (km, mi): event distance in km over performance hours.
    Fixed-time events (h): covered distance in km over event hours.
    Miles convert with 1.60934 (kilometres multiply by exactly 1.0, which leaves
    the double unchanged).  ``try_divide`` turns a zero time into NULL instead
    of an ANSI error; any missing input gives NULL.
    """
    value, unit = as_col(distance_value), as_col(distance_unit)
    secs, covered, cov_unit = as_col(seconds), as_col(perf_distance), as_col(perf_unit)
    speed = (F.when(unit.isin("km", "mi"), F.try_divide(value * _to_km(unit), secs / 3600))
             .when(unit == "h", F.try_divide(covered * _to_km(cov_unit), value)))
    return F.round(speed, SPEED_DECIMALS)


def raw_speed_numeric(c: Column | str) -> Column:
    return as_col(c).try_cast("double")


def rescale_speed(c: Column | str) -> Column:
    """Exploratory fix of the raw speed text: values above 1000 are thousandths."""
    v = raw_speed_numeric(c)
    return F.when(v > RAW_SPEED_SCALE_LIMIT, v / 1000).otherwise(v)


def speed_quality(c: Column | str) -> Column:
    """Class of a raw speed text: raw_null, malformed, zero/negative, scaled, valid."""
    raw = as_col(c)
    v = raw_speed_numeric(raw)
    return (F.when(raw.isNull(), "raw_null")
            .when(v.isNull(), "malformed_not_numeric")
            .when(v <= 0, "zero_or_negative")
            .when(v > RAW_SPEED_SCALE_LIMIT, "scaled_above_1000")
            .otherwise("valid_numeric"))
