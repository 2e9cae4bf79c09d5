"""Joins: lookup enrichment, star joins, key audits, duplicate-key lookups.

Broadcast policy: none of these joins carries a hint.  Spark broadcasts a side whose size in
bytes (file statistics at planning, shuffle statistics under AQE) is within
``spark.sql.autoBroadcastJoinThreshold`` and otherwise runs a shuffle join whose skewed
partitions AQE splits; no job runs while a query is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str,
           how: str = "inner") -> DataFrame:
    """Equi-join to a lookup and drop the lookup's copy of the key.

    Works for a batch or a streaming ``df`` (stream-static join); unmatched rows
    are dropped by the inner join.
    """
    return df.join(lookup, df[left_key] == lookup[right_key], how).drop(lookup[right_key])


def join_star(fact: DataFrame, dims, how: str = "inner") -> DataFrame:
    """Join a fact to several dimensions: ``dims`` is a list of (df, key) or
    (df, fact_key, dim_key).  Each dimension's key column is dropped after the
    join so the result has one copy of every key."""
    out = fact
    for spec in dims:
        if len(spec) == 2:
            dim, key = spec
            out = out.join(dim, on=key, how=how)
        else:
            dim, fact_key, dim_key = spec
            out = out.join(dim, out[fact_key] == dim[dim_key], how).drop(dim[dim_key])
    return out


def missing_key_counts(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """(key, row_count) of the keys without a dimension row.  The fact is counted per key
    before the anti join, so a hot key sends one row per task; NULL keys count as missing."""
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.join(dim.select(key), on=key, how="left_anti")


def missing_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row (explicit anti join; the
    ``LEFT JOIN ... IS NULL`` form stays an outer join in Catalyst)."""
    return fact.join(dim.select(key), on=key, how="left_anti")


def duplicate_key_values(df: DataFrame, key: str, min_count: int = 2) -> DataFrame:
    """Keys occurring at least ``min_count`` times, with their count.  Partial
    aggregation runs map-side, so a hot key costs one row per map task."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("duplicate_count"))
            .filter(F.col("duplicate_count") >= min_count))


def rows_with_duplicate_keys(df: DataFrame, key: str, keys: DataFrame | None = None) -> DataFrame:
    """All rows whose key occurs more than once (semi join back to the keys).

    ``keys``: those of ``duplicate_key_values``, stored.  Their size is known then before the rows move, so
    few keys are broadcast; otherwise Spark shuffles the rows while the keys are still counted."""
    keys = duplicate_key_values(df, key) if keys is None else keys
    return df.join(keys.select(key), on=key, how="left_semi")
