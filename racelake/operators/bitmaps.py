"""Exact distinct counts as mergeable bitmaps.

A set of integers is a few rows (bucket, bitmap): bucket ``n`` holds the numbers
whose bit lies in the n-th run of 32,768, as a bitmap of 4 KB built by Spark's
``bitmap_construct_agg``.  Sets of the same group are united with ``bitmap_or_agg`` however often
and in whatever order their parts arrive, so a distinct count can be stored, added to and rolled
up to coarser groups; ``COUNT(DISTINCT)`` can do none of that, and several of them in one aggregate
make Spark expand every row once for each.

Bits need dense numbers.  ``dense_numbers`` gives the values of a key column numbers without gaps,
in parallel: each task numbers its own rows, and an offset for each task (a row a task) is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET, BITS = "bucket", "bits"


def bitmap_rows(df: DataFrame, keys, number: Column | str, fine: bool = False) -> DataFrame:
    """(keys, bucket, bits): the set of ``number`` (an integer; NULLs left out) per group.

    One shuffle, of bitmaps that each task has built of its own rows: a hot group, or a number that
    a third of the rows hold, sends one bitmap a task and bucket.

    ``fine``: for so many groups that a task has few rows of each group and bucket, and would send
    4 KB for nearly every row.  The distinct numbers are shuffled instead, and each bitmap is built
    where all numbers of its group and bucket (32,768 at most) have met."""
    number = F.col(number) if isinstance(number, str) else number
    numbers = df.select(*keys, number.cast("long").alias("_n")).filter(F.col("_n").isNotNull())
    bucket = F.bitmap_bucket_number("_n").alias(BUCKET)
    if fine:
        numbers = numbers.distinct().select(*keys, bucket, "_n").repartition(*keys, BUCKET)
        bucket = F.col(BUCKET)
    return (numbers.groupBy(*keys, bucket)
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias(BITS)))


def union_bitmaps(rows: DataFrame, keys) -> DataFrame:
    """Bitmaps of coarser groups (or of several parts of the same ones): one row per (keys, bucket)."""
    return rows.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_bits(rows: DataFrame, keys, name: str) -> DataFrame:
    """(keys, name): the size of each group's set; ``rows`` has one row per (keys, bucket)."""
    return rows.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))


def distinct_count(df: DataFrame, keys, number: Column | str, name: str) -> DataFrame:
    """``COUNT(DISTINCT number)`` per group through bitmaps."""
    return count_bits(bitmap_rows(df, keys, number), keys, name)


def dense_numbers(df: DataFrame, name: str, first: int = 0) -> DataFrame:
    """``df`` with numbers ``first``, ``first`` + 1, ... in column ``name``.

    ``df`` must give the same rows in the same partitions whenever it is read: a stored table."""
    placed = df.select("*", F.spark_partition_id().alias("_task"),
                       F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_place"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
               .select("_task", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + first).alias("_offset")))
    return (placed.join(F.broadcast(offsets), "_task")  # a row a task
            .withColumn(name, F.col("_offset") + F.col("_place")).drop("_task", "_place", "_offset"))
