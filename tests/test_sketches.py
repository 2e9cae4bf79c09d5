"""Stored column sketches: error bounds, merging, exact counts under a bound."""

import uuid

import pytest

from pyspark.sql import functions as F

from racelake.operators import sketches
from racelake.plans.lakehouse import lakehouse

N = 60_000


@pytest.fixture(scope="module")
def store(spark, sf_dir):
    """Three deliveries of 20,000 rows, the middle one given twice."""
    df = spark.range(N, numPartitions=6).select(
        (F.col("id") % 3).cast("int").alias("few"), F.col("id").alias("unique"),
        F.concat(F.lit("t"), F.col("id") % 5000).alias("text"), F.lit(None).cast("double").alias("nothing"),
        F.when(F.col("id") % 4 == 0, None).otherwise((F.col("id") * 7919 % N).cast("double")).alias("spread"))
    out = sketches.ProfileStore(spark, f"{lakehouse(spark, sf_dir).root}/sketches-{uuid.uuid4().hex[:8]}")
    for k in (0, 1, 2, 1):
        out.add(df.filter(F.floor(F.col("unique") / (N / 3)) == k), str(k))
    return out, df


def test_distinct_estimates_of_merged_deliveries_keep_the_bound(store):
    out, df = store
    got = {r[0]: r[1] for r in out.distinct_counts().collect()}
    exact = {r[0]: r[1] for r in sketches.exact_distinct(df, df.columns).collect()}
    assert exact == {"few": 3, "unique": N, "text": 5000, "nothing": 0, "spread": 45_000}
    error = 1.04 / 2 ** (sketches.LG_K / 2)
    assert all(abs(got[c] - n) <= max(1, 4 * error * n) for c, n in exact.items()), got


def test_quantiles_keep_the_rank_bound_and_the_rest_is_exact(store):
    out, df = store
    rows = {r["column_name"]: r for r in out.summary((0.1, 0.5, 0.9)).collect()}
    assert set(rows) == {"few", "unique", "spread"}  # numbers with a value
    values = sorted(r[0] for r in df.select("spread").collect() if r[0] is not None)
    spread = rows["spread"]
    assert (spread["count"], spread["min"], spread["max"]) == (len(values), values[0], values[-1])
    assert spread["mean"] == pytest.approx(sum(values) / len(values))
    for p in (10, 50, 90):
        below = sum(v <= spread[f"p{p}"] for v in values)
        assert abs(below / len(values) - p / 100) <= 2 * 2.3 / sketches.KLL_K ** 0.9


def test_only_columns_under_the_bound_are_counted_exactly(store):
    out, df = store
    got = {r[0]: (r[1], r[2]) for r in sketches.bounded_distinct(df, out.distinct_counts(), 10_000).collect()}
    assert got["few"] == (3, True) and got["text"] == (5000, True) and got["nothing"] == (0, True)
    assert not got["unique"][1] and not got["spread"][1]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "a int, b string")
    rows = sketches.column_sketches(empty).collect()
    assert rows == []  # no task saw a row
    assert {r[0]: r[1] for r in sketches.exact_distinct(empty, ["a", "b"]).collect()} == {"a": 0, "b": 0}
