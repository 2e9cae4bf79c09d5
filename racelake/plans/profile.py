"""Exploratory profiling of the raw race results (the EDA notebooks' operators).

Per-column loops of the studied notebooks become single aggregates; the parser
previews become projections over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.functions import athlete, distance, speed
from racelake.functions.columns import snake_case_columns
from racelake.operators.aggregates import value_counts


def snake(raw: DataFrame) -> DataFrame:
    return snake_case_columns(raw)


def multistage_profile(raw: DataFrame) -> DataFrame:
    """Distinct (text, value, unit, stage count, event type) of raw distances."""
    r = snake(raw)
    cols = distance.multistage_columns("event_distance_length")
    return r.select(F.col("event_distance_length"), *[v.alias(k) for k, v in cols.items()]).distinct()


def speed_quality_counts(raw: DataFrame) -> DataFrame:
    return value_counts(snake(raw).select(speed.speed_quality("athlete_average_speed").alias("speed_quality_status")),
                        "speed_quality_status")


def club_pattern_counts(raw: DataFrame) -> DataFrame:
    return value_counts(snake(raw).select(athlete.club_pattern("athlete_club").alias("club_pattern_type")),
                        "club_pattern_type")


def speed_outlier_bands(raw: DataFrame) -> DataFrame:
    """Rows of raw numeric speed in (30, 1000] and above 1000."""
    value = speed.raw_speed_numeric("athlete_average_speed")
    wide = snake(raw).agg(F.count_if((value > 30) & (value <= 1000)).alias("medium"),
                          F.count_if(value > 1000).alias("high"))
    return wide.selectExpr("stack(2, 'above_30_up_to_1000', medium, 'above_1000', high) as (speed_band, row_count)")


def rescaled_speeds(raw: DataFrame) -> DataFrame:
    """Raw speed text with its rescaled value; NULL and non-positive dropped."""
    r = snake(raw).select("athlete_average_speed",
                          speed.rescale_speed("athlete_average_speed").alias("athlete_average_speed_kmh"))
    return r.filter(F.col("athlete_average_speed_kmh").isNotNull() & (F.col("athlete_average_speed_kmh") > 0))


def blank_text_counts(raw: DataFrame, cols) -> DataFrame:
    r = snake(raw)
    return r.agg(*[F.count_if(F.col(c).isNull() | (F.length(F.trim(F.col(c))) == 0)).alias(f"blank_{c}")
                   for c in cols])


# The looser classes of raw distance text and the endings of raw performance text, in order.
EVENT_UNIT_TYPES = [("days_invalid", "rlike", r"\d+d$"), ("distance_km", "contains", "km"),
                    ("distance_mi", "contains", "mi"), ("time_hours", "rlike", r"\d+h$")]
PERFORMANCE_SUFFIXES = [("time_hours", " h"), ("distance_km", " km"), ("distance_mi", " mi")]


def event_unit_distribution(raw: DataFrame) -> DataFrame:
    """Rows per coarse unit of the distance text (unanchored tests, first match wins)."""
    text = distance.normalized_distance("event_distance_length")
    label = F.coalesce(*[F.when(text.rlike(p) if how == "rlike" else text.contains(p), F.lit(name))
                         for name, how, p in EVENT_UNIT_TYPES], F.lit("other"))
    return value_counts(raw.select(label.alias("event_unit_type")), "event_unit_type")


def performance_suffix_counts(raw: DataFrame) -> DataFrame:
    """Rows per ending of the performance text."""
    text = F.col("athlete_performance")
    label = F.coalesce(F.when(text.isNull(), F.lit("null")),
                       *[F.when(text.endswith(end), F.lit(name)) for name, end in PERFORMANCE_SUFFIXES],
                       F.lit("unknown"))
    return value_counts(raw.select(label.alias("performance_type")), "performance_type")
