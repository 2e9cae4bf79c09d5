"""One key holding a third of all rows: results stay exact and whole, and the
grouped operators keep map-side partial aggregation (one partial row per task
for the hot key)."""

from pyspark.sql import functions as F

from racelake.operators import aggregates, dedup, joins
from racelake.plans import views

N = 30_000


def _skewed(spark):
    # Key 0 holds a third of the rows; the rest spread over 2,000 keys.
    ids = spark.range(N, numPartitions=8)
    return ids.select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).cast("int").alias("athlete_id"),
        F.col("id").cast("string").alias("result_id"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("event_start_date"),
        (F.col("id") % 97).cast("string").alias("event_id"),
        ((F.col("id") % 5000) / 1000 + 5).alias("athlete_average_speed_kmh"),
        (F.col("id") % 60 + 18).cast("int").alias("athlete_age_at_event"),
    )


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_value_counts_hot_key(spark):
    df = _skewed(spark)
    out = aggregates.value_counts(df, "athlete_id")
    assert "partial_count" in _plan(out)
    counts = {r["athlete_id"]: r["row_count"] for r in out.collect()}
    assert counts[0] == N // 3 and sum(counts.values()) == N


def test_one_row_per_key_hot_key(spark):
    df = _skewed(spark)
    out = dedup.one_row_per_key(df, "athlete_id", ["event_start_date", "result_id"], descending=["event_start_date"])
    assert "partial_min_by" in _plan(out)
    pdf = df.toPandas().sort_values(["event_start_date", "result_id"], ascending=[False, True])
    expected = pdf.drop_duplicates("athlete_id").set_index("athlete_id")["result_id"].to_dict()
    got = {r["athlete_id"]: r["result_id"] for r in out.collect()}
    assert got == expected


def test_duplicate_keys_hot_key(spark):
    df = _skewed(spark)
    dup = joins.duplicate_key_values(df, "athlete_id")
    assert "partial_count" in _plan(dup)
    assert joins.rows_with_duplicate_keys(df, "athlete_id").count() == N


def test_demographics_hot_athlete(spark):
    fact = _skewed(spark)
    dim = spark.range(0, 2001).select(
        F.col("id").cast("int").alias("athlete_id"),
        F.when(F.col("id") % 2 == 0, "M").otherwise("F").alias("athlete_gender"),
        F.lit(1980).alias("athlete_year_of_birth"),
        F.when(F.col("id") % 3 == 0, "M40").otherwise("W35").alias("athlete_age_category"),
        F.lit("unknown").alias("athlete_club"))
    out = {(r["gender"], r["age_group"]): (r["athlete_entries"], r["unique_athletes"])
           for r in views.runner_demographics(fact, dim).collect()}
    pf, pd_ = fact.toPandas(), dim.toPandas()
    merged = pf.merge(pd_, on="athlete_id")
    merged["gender"] = merged["athlete_gender"].map({"M": "Male", "F": "Female"})
    merged["age_group"] = merged["athlete_age_category"].str[1:] + "+"
    expected = {k: (len(g), g["athlete_id"].nunique()) for k, g in merged.groupby(["gender", "age_group"])}
    assert out == expected
