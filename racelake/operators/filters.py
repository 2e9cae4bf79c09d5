"""Row filters: keep rows meeting a rule, or find the rows that break it.

All predicates are built-in expressions, so Catalyst pushes those on source
columns into the parquet scan (``PushedFilters``) and keeps the rest inside
whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.functions.columns import as_col, is_blank, missing_or_sentinel


def keep_values(df: DataFrame, column: str, allowed) -> DataFrame:
    return df.filter(F.col(column).isin(*allowed))


def drop_values(df: DataFrame, column: str, banned) -> DataFrame:
    """Blacklist filter; a NULL value is dropped too (SQL three-valued logic)."""
    return df.filter(~F.col(column).isin(*banned))


def keep_positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) > 0))


def consistent(unit_col: str, type_col: str, pairs) -> Column:
    """``OR`` over (units, types) pairs: unit in units AND type in types."""
    terms = [F.col(unit_col).isin(*units) & F.col(type_col).isin(*types) for units, types in pairs]
    return reduce(lambda a, b: a | b, terms)


def keep_consistent(df: DataFrame, unit_col: str, type_col: str, pairs) -> DataFrame:
    return df.filter(consistent(unit_col, type_col, pairs))


def violating_rows(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which a rule is false (NULL counts as broken)."""
    return df.filter(~F.coalesce(rule, F.lit(False)))


def keep_range(df: DataFrame, column: str, lo, hi, lo_inclusive: bool = False,
               hi_inclusive: bool = True) -> DataFrame:
    c = F.col(column)
    lower = c >= lo if lo_inclusive else c > lo
    upper = c <= hi if hi_inclusive else c < hi
    return df.filter(c.isNotNull() & lower & upper)


def require_columns(df: DataFrame, columns) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def keep_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).rlike(pattern))


def keep_containing(df: DataFrame, column: str, text: str) -> DataFrame:
    return df.filter(F.col(column).contains(text))


def keep_suffix(df: DataFrame, column: str, suffix: str) -> DataFrame:
    return df.filter(F.col(column).endswith(suffix))


def missing_rows(df: DataFrame, column: str, sentinels=("None",)) -> DataFrame:
    return df.filter(missing_or_sentinel(column, sentinels))


def rows_outside(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """NULL, below ``lo`` or above ``hi``."""
    c = F.col(column)
    return df.filter(c.isNull() | (c < lo) | (c > hi))


def rows_in_band(df: DataFrame, column: Column | str, lo=None, hi=None) -> DataFrame:
    """``lo < x <= hi``; an open side when its bound is None."""
    c = as_col(column)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c > lo)
    if hi is not None:
        cond = cond & (c <= hi)
    return df.filter(cond)


def blank_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_blank(column))


def keep_known(df: DataFrame, column: str, unknown: str = "unknown") -> DataFrame:
    c = F.col(column)
    return df.filter(c.isNotNull() & (F.lower(c) != unknown))
