"""Generic operators on small frames."""

from pyspark.sql import functions as F

from racelake.operators import aggregates, dedup, joins, sort


def test_one_row_per_key_orders(spark):
    df = spark.createDataFrame([
        (1, "2020-01-01", "b", "old"), (1, "2021-01-01", "z", "new"), (1, "2021-01-01", "a", "newest-tie"),
        (2, "2019-05-05", "c", "only"),
    ], "k int, d string, rid string, v string").withColumn("d", F.to_date("d"))
    out = dedup.one_row_per_key(df, "k", ["d", "rid"], descending=["d"])
    assert sorted((r["k"], r["v"]) for r in out.collect()) == [(1, "newest-tie"), (2, "only")]


def test_duplicate_keys_and_semi_join(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert [tuple(r) for r in joins.duplicate_key_values(df, "k").collect()] == [(1, 2)]
    assert sorted(r["v"] for r in joins.rows_with_duplicate_keys(df, "k").collect()) == ["a", "b"]


def test_missing_keys_is_anti_join(spark):
    fact = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    dim = spark.createDataFrame([(1,), (3,)], "k int")
    out = joins.missing_keys(fact, dim, "k")
    assert [r["k"] for r in out.collect()] == [2]
    assert "LeftAnti" in out._jdf.queryExecution().optimizedPlan().toString()


def test_missing_key_counts(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,), (3,)], "k int")
    dim = spark.createDataFrame([(1,), (3,)], "k int")
    out = joins.missing_key_counts(fact, dim, "k")
    assert sorted(map(tuple, out.collect()), key=repr) == [(2, 2), (None, 1)]


def test_predicate_share(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert tuple(aggregates.predicate_share(df, F.col("x") == "a", "hit").first()) == (3, 1, 33.33)
    assert tuple(aggregates.predicate_share(df.limit(0), F.col("x") == "a", "hit").first()) == (0, 0, None)


def test_profile_distinct_single_job(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "`x y` int, z string")
    out = {r["column_name"]: r["distinct_values"] for r in aggregates.profile_distinct(df).collect()}
    assert out == {"x y": 2, "z": 2}


def test_fixed_point_avg_ties(spark):
    df = spark.createDataFrame([(7.666,), (7.667,)], "s double")
    assert df.select(aggregates.fixed_point_avg("s", 3)).first()[0] == 7.667


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "g string, n long")
    out = {r["g"]: r["p"] for r in aggregates.share_of_total(df, "n", "p").collect()}
    assert out == {"a": 25.0, "b": 75.0}


def test_top_k(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(10)], "i int, m int")
    out = sort.top_k(df, [("m", "desc"), "i"], 3)
    assert [r["i"] for r in out.collect()] == [2, 5, 8]


def test_filters_small(spark):
    from racelake.operators import filters
    df = spark.createDataFrame([("a", 1.0), ("  ", 31.0), (None, 1001.0), ("unknown", None), ("xd", 0.5)],
                               "t string, x double")
    assert filters.blank_rows(df, "t").count() == 2
    assert [r["t"] for r in filters.keep_known(df, "t").collect()] == ["a", "  ", "xd"]
    assert [r["x"] for r in filters.rows_in_band(df, "x", 30, 1000).collect()] == [31.0]
    assert [r["x"] for r in filters.rows_in_band(df, "x", 1000, None).collect()] == [1001.0]
    assert filters.rows_outside(df, "x", 1, 100).count() == 3          # NULL, 1001, 0.5
    assert filters.keep_suffix(df, "t", "d").count() == 1
    assert filters.missing_rows(df, "t", ["unknown"]).count() == 2
    assert filters.violating_rows(df, F.col("x") > 1).count() == 3     # 1.0, NULL, 0.5


def test_approximate_profiles(spark):
    df = spark.range(0, 20000).select((F.col("id") % 5000).alias("k"), (F.col("id") % 100).cast("double").alias("v"))
    approx = {r["column_name"]: r["distinct_values"] for r in aggregates.profile_distinct(df, approx=True).collect()}
    assert abs(approx["k"] - 5000) <= 150 and abs(approx["v"] - 100) <= 3
    exact = aggregates.numeric_summary(df, ["v"], exact=True).first()
    rough = aggregates.numeric_summary(df, ["v"], exact=False).first()
    assert exact["p50"] == 49.5 and abs(rough["p50"] - 49.5) <= 1
    assert exact["count"] == rough["count"] == 20000
