"""Column naming and generic column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NON_ALNUM = re.compile(r"[^a-z0-9]+")


def _snake(name: str) -> str:
    return _NON_ALNUM.sub("_", name.strip().lower()).strip("_")


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case (``Event distance/length`` ->
    ``event_distance_length``).  Two names that collide raise, because a later
    select on the shared name would be ambiguous."""
    names = [_snake(c) for c in df.columns]
    seen: dict[str, str] = {}
    for original, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {original!r} both become {new!r}")
        seen[new] = original
    return df.toDF(*names)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: Column | str, type_name: str) -> Column:
    """Cast that yields NULL on malformed text instead of failing (ANSI mode)."""
    return as_col(c).try_cast(type_name)


def missing_or_sentinel(c: Column | str, sentinels=("None",)) -> Column:
    """True when the value is NULL or equal to one of the sentinel texts."""
    c = as_col(c)
    return c.isNull() | c.isin(*sentinels)


def is_blank(c: Column | str) -> Column:
    """NULL, empty or only spaces."""
    c = as_col(c)
    return c.isNull() | (F.length(F.trim(c)) == 0)


def is_non_ascii(c: Column | str) -> Column:
    return as_col(c).rlike(r"[^\x00-\x7F]")


def nullif_value(c: Column | str, value) -> Column:
    """Sentinel -> NULL (e.g. birth year 1193)."""
    c = as_col(c)
    return F.when(c == F.lit(value), F.lit(None)).otherwise(c)


def null_out_of_range(c: Column | str, lo, hi) -> Column:
    """Values below ``lo`` or above ``hi`` become NULL; bounds are inclusive."""
    c = as_col(c)
    return F.when((c < lo) | (c > hi), F.lit(None)).otherwise(c)
