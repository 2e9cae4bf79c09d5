"""Structured Streaming operators on the supplied events table."""

import uuid

from racelake.plans.lakehouse import lakehouse
from racelake.streaming import ingest


def _root(spark, sf_dir):
    return f"{lakehouse(spark, sf_dir).root}/test-{uuid.uuid4().hex[:8]}"


def test_incremental_runs_process_only_new_files(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    root = _root(spark, sf_dir)
    first, second = events.randomSplit([0.5, 0.5], seed=7)
    first.write.parquet(f"{root}/landing/a")
    stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{root}/landing")
    ingest.write_append(stream, f"{root}/out", f"{root}/ckpt")
    assert spark.read.parquet(f"{root}/out").count() == first.count()
    second.write.parquet(f"{root}/landing/b")
    stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{root}/landing")
    ingest.write_append(stream, f"{root}/out", f"{root}/ckpt")
    assert spark.read.parquet(f"{root}/out").count() == events.count()


def test_dedup_keeps_rows_that_arrive_late(spark, sf_dir):
    """An older row that was never seen lands in a second run and stays; copies are dropped."""
    root = _root(spark, sf_dir)
    schema = "k int, t timestamp, note string"
    runs = [["(1, timestamp'2022-01-01', 'a')"],
            ["(2, timestamp'1990-01-01', null)", "(3, timestamp'2022-01-02', 'null')", "(1, timestamp'2022-01-01', 'a')",
             "(2, timestamp'1990-01-01', null)"]]
    for i, rows in enumerate(runs):
        spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS v(k, t, note)").write.parquet(f"{root}/landing/{i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/landing")
        ingest.write_append(ingest.dedup_stream(stream, ["k", "t", "note"]), f"{root}/out", f"{root}/ckpt")
    got = spark.read.parquet(f"{root}/out")
    assert sorted((r.k, r.note) for r in got.collect()) == [(1, "a"), (2, None), (3, "null")]
    assert got.columns == ["k", "t", "note"]


def test_silver_stream_matches_batch(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    raw = lake.raw()
    root = _root(spark, sf_dir)
    bronze = ingest.read_table_stream(spark, lake.path("bronze_results"), raw.schema)
    silver = ingest.silver_stream(bronze, lake.lookup())
    ingest.write_append(silver, f"{root}/silver", f"{root}/ckpt")
    got = spark.read.parquet(f"{root}/silver")
    assert got.count() == lake.silver().count()
    assert got.select("result_id").exceptAll(lake.silver().select("result_id")).count() == 0
