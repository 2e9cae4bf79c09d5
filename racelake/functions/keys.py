"""Deterministic keys (stream-safe: no ranking windows)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from racelake.functions.columns import as_col

KEY_SEPARATOR = "||"

# Inputs of the two hash keys, in hash order.
EVENT_KEY_COLUMNS = ["event_name", "event_distance_length"]
RESULT_KEY_COLUMNS = [
    "event_name",
    "event_date_raw",
    "event_distance_length",
    "event_number_of_finishers",
    "athlete_id",
    "athlete_country",
    "country_code_iso3",
    "country_name",
    "athlete_year_of_birth",
    "athlete_gender",
    "athlete_age_category",
    "athlete_club",
    "athlete_performance",
    "athlete_average_speed",
]


def surrogate_key(cols, sep: str = KEY_SEPARATOR) -> Column:
    """SHA-256 hex of the columns joined by ``sep``.

    ``concat_ws`` skips NULLs, so a NULL input shifts the later fields; kept for
    key compatibility (only the last input may be NULL after silver).
    """
    return F.sha2(F.concat_ws(sep, *[as_col(c).cast("string") for c in cols]), 256)


def event_id() -> Column:
    return surrogate_key(EVENT_KEY_COLUMNS)


def result_id() -> Column:
    return surrogate_key(RESULT_KEY_COLUMNS)
