"""Ordering and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sort_col(spec) -> Column:
    """``"c"`` ascending, ``("c", "desc")``, ``("c", "asc_nulls_first")`` ..."""
    if isinstance(spec, Column):
        return spec
    if isinstance(spec, str):
        return F.col(spec).asc()
    name, how = spec
    return getattr(F.col(name), how)()


def sorted_by(df: DataFrame, specs) -> DataFrame:
    """Global sort (range partitioning on a sample of the keys).  List enough
    columns to break ties: rows sharing the whole sort key cannot be split
    across range partitions, so a hot key would otherwise sort in one task."""
    return df.orderBy(*[_sort_col(s) for s in specs])


def top_k(df: DataFrame, specs, k: int) -> DataFrame:
    """``ORDER BY ... LIMIT k``: planned as TakeOrderedAndProject, each task
    keeps only its own k best rows, so nothing beyond k rows per task moves.
    Give a unique tie-breaker last so the k rows are well defined."""
    return df.orderBy(*[_sort_col(s) for s in specs]).limit(k)
