"""Column profiles that are stored per delivery and merged, never recomputed.

A delivery leaves one small row per column: its rows and NULLs, for numbers their least, greatest
and total, and two sketches of fixed size - HyperLogLog for the distinct values, KLL for the
quantiles.  Rows of any deliveries merge into the row of their union, so the profile of a table
that grows costs one scan of what is new.

Error bounds: the distinct count's relative standard error is about 1.04 / sqrt(2 ** lg_k); the
rank of a KLL quantile is off by about 2.3 / k ** 0.9 (99 % of the time), e.g. 0.5 % for k = 1000.

Sketches merge in two steps, ``MERGE_TASKS`` groups of tasks and then these groups, so no task
receives the sketches of all tasks of a large scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

LG_K = 14
KLL_K = 1000
MERGE_TASKS = 64
SCHEMA = ("column_name string, row_count long, null_count long, minimum double, maximum double, total double, "
          "distinct_sketch binary, quantile_sketch binary")


def _hashable(df: DataFrame, c: str) -> Column:
    kind = dict(df.dtypes)[c]
    return F.col(f"`{c}`") if kind in ("int", "bigint", "string", "binary") else F.col(f"`{c}`").cast("string")


def _merge() -> list[Column]:
    return [F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
            F.min("minimum").alias("minimum"), F.max("maximum").alias("maximum"), F.sum("total").alias("total"),
            F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
            F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch")]


def column_sketches(df: DataFrame, lg_k: int = LG_K, kll_k: int = KLL_K) -> DataFrame:
    """One row per column of ``df`` (``SCHEMA``), from one scan that never turns a row into several."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    aggs, rows = [], []
    for k, c in enumerate(df.columns):
        x = F.col(f"`{c}`")
        y = x.cast("double") if c in numeric else F.lit(None).cast("double")
        aggs += [F.count(F.lit(1)).alias(f"n{k}"), F.count_if(x.isNull()).alias(f"u{k}"), F.min(y).alias(f"a{k}"),
                 F.max(y).alias(f"b{k}"), F.sum(y).alias(f"t{k}"),
                 F.hll_sketch_agg(_hashable(df, c), F.lit(lg_k)).alias(f"h{k}"),
                 F.kll_sketch_agg_double(y, F.lit(kll_k)).alias(f"q{k}")]
        rows.append(f"'{c}', n{k}, u{k}, a{k}, b{k}, t{k}, h{k}, q{k}")
    names = ", ".join(f.split(" ")[0] for f in SCHEMA.split(", "))
    per_group = df.groupBy((F.spark_partition_id() % MERGE_TASKS).alias("_group")).agg(*aggs)
    parts = per_group.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) as ({names})")
    return parts.groupBy("column_name").agg(*_merge())


class ProfileStore:
    """The sketches of a table's deliveries under ``root`` (a shared folder)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def add(self, df: DataFrame, delivery: str, lg_k: int = LG_K, kll_k: int = KLL_K) -> None:
        """Sketch one delivery; adding it again replaces its rows."""
        column_sketches(df, lg_k, kll_k).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/delivery={delivery}")

    def merged(self) -> DataFrame:
        """One row per column over all deliveries."""
        rows = self.spark.read.schema(f"{SCHEMA}, delivery string").parquet(self.root)
        return rows.groupBy("column_name").agg(*_merge())

    def distinct_counts(self) -> DataFrame:
        """(column_name, distinct_values): estimates."""
        return self.merged().select("column_name", F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"))

    def summary(self, quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
        """Exact count, minimum and maximum and the mean of each numeric column, and its estimated quantiles."""
        q = [F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(p))).alias(f"p{round(100 * p)}")
             for p in quantiles]
        filled = F.col("row_count") - F.col("null_count")
        return (self.merged().filter(F.col("minimum").isNotNull())
                .select("column_name", filled.alias("count"), (F.col("total") / filled).alias("mean"),
                        F.col("minimum").alias("min"), *q, F.col("maximum").alias("max")))


def exact_distinct(df: DataFrame, columns) -> DataFrame:
    """(column_name, distinct_values): exact counts of the given columns (NULLs do not count).

    Each column is aggregated apart, in its own type: the scan of a column store reads that column
    only, its values are made distinct within each task, and no row is multiplied."""
    counts = [df.select(F.col(f"`{c}`").alias("v")).distinct().agg(F.count("v").alias("distinct_values"))
              .select(F.lit(c).alias("column_name"), "distinct_values") for c in columns]
    empty = df.sparkSession.createDataFrame([], "column_name string, distinct_values long")
    return reduce(DataFrame.unionByName, counts, empty) if counts else empty


def bounded_distinct(df: DataFrame, estimates: DataFrame, bound: int) -> DataFrame:
    """(column_name, distinct_values, exact): exact counts of the columns that are estimated at ``bound``
    distinct values or fewer, the estimate of the others.

    ``estimates`` (column_name, distinct_values) has a row per column; only these are collected."""
    known = {r["column_name"]: r["distinct_values"] for r in estimates.collect()}
    small = [c for c in df.columns if known[c] <= bound]
    large = df.sparkSession.createDataFrame([(c, known[c], False) for c in df.columns if c not in small],
                                            "column_name string, distinct_values long, exact boolean")
    return exact_distinct(df, small).withColumn("exact", F.lit(True)).unionByName(large)
