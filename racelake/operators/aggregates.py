"""Aggregations: distributions, distinct counts, audits, summaries.

Everything is a single distributed aggregate: per-column profiling loops of the
studied notebooks (one job per column) become one ``agg`` whose wide row is
turned into rows with ``stack``.  Grouped aggregates use partial (map-side)
aggregation, so a hot group sends one partial row per task through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racelake.functions.columns import as_col
from racelake.operators.sketches import exact_distinct


def _q(name: str) -> str:
    return f"`{name}`"


def value_counts(df: DataFrame, *cols: str, count_name: str = "row_count") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_name))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, cols) -> DataFrame:
    return df.select(*cols).distinct()


def _unpivot(wide: DataFrame, names, name_col: str, value_col: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', {_q(n)}" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {pairs}) as ({name_col}, {value_col})")


def profile_distinct(df: DataFrame, approx: bool = False) -> DataFrame:
    """(column_name, distinct_values) for every column; NULLs do not count.

    Exact counts aggregate each column apart (``sketches.exact_distinct``).  ``approx=True`` takes
    HyperLogLog++ sketches of all columns in one pass instead (fixed memory, about 1% error);
    sketches that are stored and merged are in ``sketches.ProfileStore``.
    """
    if not approx:
        return exact_distinct(df, df.columns)
    wide = df.agg(*[F.approx_count_distinct(F.col(_q(c)), 0.01).alias(c) for c in df.columns])
    return _unpivot(wide, df.columns, "column_name", "distinct_values")


def distinct_counts(df: DataFrame, cols, prefix: str = "distinct_") -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"{prefix}{c}") for c in cols])


def null_counts(df: DataFrame, cols, suffix: str = "_null_count") -> DataFrame:
    return df.agg(*[F.count_if(F.col(_q(c)).isNull()).alias(f"{c}{suffix}") for c in cols])


def null_percentages(df: DataFrame, cols) -> DataFrame:
    """(column_name, null_count, total_rows, null_percent) from one pass."""
    wide = df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count_if(F.col(_q(c)).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', {_q(c)}" for c in cols)
    return (wide.selectExpr("total_rows", f"stack({len(cols)}, {pairs}) as (column_name, null_count)")
            .withColumn("null_percent",
                        F.round(F.col("null_count") * 100.0 / F.col("total_rows"), 2)))


def predicate_share(df: DataFrame, predicate: Column, name: str) -> DataFrame:
    """Rows, rows meeting a predicate (NULL does not) and their percentage, in one pass."""
    n, hit = F.count(F.lit(1)), F.count_if(predicate)
    return df.agg(n.alias("total_rows"), hit.alias(f"{name}_rows"),
                  F.round(F.try_divide(hit * 100.0, n).cast("double"), 2).alias(f"{name}_percent"))


def key_audit(df: DataFrame, key: str, cols=()) -> DataFrame:
    """Row count, NULLs per column and extra rows per duplicated key."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [(F.count(F.lit(1)) - F.count(c)).alias(f"null_{c}_rows") for c in cols]
    aggs.append((F.count(F.lit(1)) - F.count_distinct(key)).alias(f"duplicate_{key}_rows"))
    return df.agg(*aggs)


def range_stats(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.agg(F.min(c).alias(f"min_{column}"), F.avg(c).alias(f"avg_{column}"),
                  F.max(c).alias(f"max_{column}"),
                  (F.count(F.lit(1)) - F.count(c)).alias(f"null_{column}_rows"))


def scaled(c: Column | str, decimals: int = 3) -> Column:
    """A value with ``decimals`` decimals as a whole number: sums of it are exact in any order."""
    return F.round(as_col(c) * 10 ** decimals).cast("long")


def fixed_point_avg(c: Column | str, decimals: int = 3) -> Column:
    """Average of a column holding values with ``decimals`` decimals, exact.

    Summing the scaled integers is exact and independent of partitioning, so the
    rounded average is the same on any cluster layout (a floating-point sum
    depends on the order partial sums arrive in, which matters for ties).
    """
    unit = 10 ** decimals
    c = as_col(c)
    scaled_sum = F.sum(scaled(c, decimals))
    return F.round(scaled_sum.cast("double") / F.count(c).cast("double") / unit, decimals)


def rounded_avg(c: Column | str, decimals: int) -> Column:
    return F.round(F.avg(as_col(c)), decimals)


def ratio(a: Column | str, b: Column | str, decimals: int = 2) -> Column:
    return F.round(as_col(a) / as_col(b), decimals)


def with_share(df: DataFrame, column: str, total: Column, name: str, decimals: int = 2) -> DataFrame:
    """``column`` as a percentage of ``total``, in exact decimal arithmetic, as a double."""
    return df.withColumn(name, F.round(F.expr(f"{_q(column)} * 100.0") / total, decimals).cast("double"))


def share_of_total(df: DataFrame, column: str, name: str, decimals: int = 2) -> DataFrame:
    """``x * 100.0 / SUM(x) OVER ()``.

    Meant for already aggregated frames whose row count is bounded by a small
    vocabulary (e.g. gender x age group): the empty window runs in one task.
    """
    return with_share(df, column, window_total(column), name, decimals)


SUMMARY_STATS = ["count", "mean", "stddev", "min", "p25", "p50", "p75", "max"]


def numeric_summary(df: DataFrame, cols, exact: bool = False, decimals: int = 6) -> DataFrame:
    """Typed count/mean/stddev/min/quartiles/max, one row per column, from a
    single aggregate; mean and stddev are rounded to ``decimals``.

    Quartiles come from ``percentile_approx`` (a fixed-size mergeable sketch, as
    ``DataFrame.summary`` does).  ``exact=True`` uses ``percentile``, whose
    buffer holds one counter per distinct value: for bounded domains only
    (years, counts).
    """
    aggs = []
    for c in cols:
        x = F.col(_q(c)).cast("double")

        quartiles = (F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))) if exact
                     else F.percentile_approx(x, [0.25, 0.5, 0.75], 10000).cast("array<double>"))

        def q(p, all_three=quartiles):
            return F.get(all_three, F.lit(int(p * 4) - 1))

        aggs += [F.count(x).cast("double").alias(f"{c}__count"),
                 F.round(F.avg(x), decimals).alias(f"{c}__mean"),
                 F.round(F.stddev_samp(x), decimals).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 q(0.25).alias(f"{c}__p25"), q(0.5).alias(f"{c}__p50"),
                 q(0.75).alias(f"{c}__p75"), F.max(x).alias(f"{c}__max")]
    rows = ", ".join(f"'{c}', " + ", ".join(_q(f"{c}__{s}") for s in SUMMARY_STATS) for c in cols)
    return (df.agg(*aggs)
            .selectExpr(f"stack({len(cols)}, {rows}) as (column_name, {', '.join(SUMMARY_STATS)})")
            .withColumn("count", F.col("count").cast("long")))


def window_total(column: str) -> Column:
    """``SUM(column) OVER ()`` for small, already aggregated frames."""
    return F.sum(column).over(Window.partitionBy())
