"""Invariants of the bronze -> silver -> gold chain at sf0.001."""

from pyspark.sql import functions as F

from racelake.plans.lakehouse import lakehouse
from racelake.queries import REGISTRY


def test_keys_unique_and_foreign_keys(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    for name, key in [("dim_event", "event_id"), ("dim_athlete", "athlete_id"),
                      ("dim_country", "country_code_iso3"), ("dim_date", "date_id"),
                      ("fact_results", "result_id")]:
        t = lake.table(name)
        assert t.count() == t.select(key).distinct().count(), name
    for q in ["dq_missing_event_keys", "dq_missing_athlete_keys", "dq_missing_country_keys",
              "dq_missing_date_keys"]:
        assert REGISTRY[q](spark, sf_dir).first()[0] == 0


def test_views_partition_the_fact(spark, sf_dir):
    fact = lakehouse(spark, sf_dir).fact().count()
    parts = sum(REGISTRY[v](spark, sf_dir).count()
                for v in ["vw_distance_km_results", "vw_distance_mi_results", "vw_time_hour_results"])
    assert parts == fact > 0


def test_rejections_account_for_every_row(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    counts = {r["stage"]: r["row_count"] for r in REGISTRY["rejection_counts"](spark, sf_dir).collect()}
    assert sum(counts.values()) == lake.raw().count()
    assert counts["kept"] == lake.silver().count()


def test_silver_rules_hold(spark, sf_dir):
    s = lakehouse(spark, sf_dir).silver()
    bad = s.filter((F.col("athlete_average_speed_kmh") <= 0) | (F.col("athlete_average_speed_kmh") > 50)
                   | F.col("athlete_age_at_event").isNull() | (F.col("event_number_of_finishers") <= 0))
    assert bad.count() == 0
    audit = REGISTRY["dq_null_key_audit"](spark, sf_dir).first().asDict()
    assert all(v == 0 for k, v in audit.items() if k != "row_count")


def test_stream_equals_batch(spark, sf_dir):
    batch = lakehouse(spark, sf_dir).silver()
    stream = REGISTRY["stream_silver_obt"](spark, sf_dir)
    assert stream.count() == batch.count()
    assert stream.select("result_id").exceptAll(batch.select("result_id")).count() == 0


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["country_name", "country_code", "race_result_records", "unique_athletes",
                          "events_participated", "average_speed_kmh", "average_athlete_age"]
