"""Athlete performance text: classify, then parse to seconds or a distance.

The text is trimmed once and every pattern is applied to the trimmed text (the
studied code classified trimmed text but extracted from the untrimmed one, so a
padded value could classify yet fail to parse).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from racelake.functions.columns import as_col

# Performance layouts, matched on trim(text) in this order.
TIME_HOURS = r"^([0-9]+):([0-9]{2}):([0-9]{2}) h$"
TIME_DAYS_HOURS = r"^([0-9]+)d ([0-9]{2}):([0-9]{2}):([0-9]{2}) h$"
DISTANCE_KM = r"^([0-9]+(\.[0-9]+)?) km$"
DISTANCE_MI = r"^([0-9]+(\.[0-9]+)?) mi$"
PERFORMANCE_CLASSES = [
    ("time_hours", TIME_HOURS),
    ("time_days_hours", TIME_DAYS_HOURS),
    ("distance_km", DISTANCE_KM),
    ("distance_mi", DISTANCE_MI),
]
TIME_TYPES = ["time_hours", "time_days_hours"]
DISTANCE_TYPES = ["distance_km", "distance_mi"]


def classify_performance(c: Column | str) -> Column:
    raw = as_col(c)
    text = F.trim(raw)
    expr = F.when(raw.isNull(), "null")
    for name, pattern in PERFORMANCE_CLASSES:
        expr = expr.when(text.rlike(pattern), name)
    return expr.otherwise("unknown")


def _part(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group).try_cast("int")


def _is(text: Column, pattern: str, kind: Column | str | None) -> Column:
    """Whether the text has a layout: by the stored type column if there is one, else by the pattern."""
    return text.rlike(pattern) if kind is None else as_col(kind) == dict((p, n) for n, p in PERFORMANCE_CLASSES)[pattern]


def duration_seconds(c: Column | str, kind: Column | str | None = None) -> Column:
    """``H+:MM:SS h`` and ``Dd HH:MM:SS h`` -> whole seconds (else NULL).

    The layout is validated with ``rlike`` on the text itself, or known from ``kind``, the
    stored column of ``classify_performance``; the minute and second fields then sit at fixed offsets
    from the end, so they are substrings, and the leading hours / days field is
    the text before the first ``:`` / ``d``.  Arithmetic runs in ``long`` and
    ends in ``try_cast``: an absurd value (``999999:00:00 h``) becomes NULL
    instead of an ANSI overflow error.
    """
    text = F.trim(as_col(c))
    n = F.length(text)

    def field(offset_from_end: int) -> Column:  # two digits ending offset_from_end chars before the end
        return F.substring(text, n - offset_from_end, 2).try_cast("long")

    minutes_seconds = field(6) * 60 + field(3)
    hms = F.substring_index(text, ":", 1).try_cast("long") * 3600 + minutes_seconds
    dhms = (F.substring_index(text, "d", 1).try_cast("long") * 86400 + field(9) * 3600 + minutes_seconds)
    return (F.when(_is(text, TIME_HOURS, kind), hms).when(_is(text, TIME_DAYS_HOURS, kind), dhms)).try_cast("int")


def performance_distance(c: Column | str, kind: Column | str | None = None) -> Column:
    """``x km`` / ``x mi`` -> x as double, unit kept (miles are not converted); ``kind`` as in ``duration_seconds``."""
    text = F.trim(as_col(c))
    # Gated by the layout: casting '' to double fails through a caught exception.
    return F.when(_is(text, DISTANCE_KM, kind) | _is(text, DISTANCE_MI, kind),
                  F.substring_index(text, " ", 1).try_cast("double"))


def performance_unit(performance_type: Column | str) -> Column:
    t = as_col(performance_type)
    return (F.when(t.isin(*TIME_TYPES), "seconds")
            .when(t == "distance_km", "km")
            .when(t == "distance_mi", "mi"))
