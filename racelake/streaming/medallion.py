"""The whole lake as an incremental run: landing files to bronze, silver and gold.

``Medallion.run`` takes the files that no earlier run has seen.  Bronze is a file stream appended
to a parquet table.  Silver is a stream of that table whose micro-batches go through the batch
chain (``foreachBatch``): one pass parses, checks, observes the rejections and adds the rows that
no earlier batch let through.  Gold takes each batch's new silver rows alone: a part of the fact
table and a part of the views' state (``plans.incremental``).

Every output of a batch lies in a folder of its number and is written whole, and a batch only
looks at what *earlier* batches let through.  A batch that is repeated after a failure therefore
replaces its own rows and adds nothing, and the stream's checkpoint repeats the last batch only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from racelake.plans import silver as silver_plan
from racelake.plans import star
from racelake.plans.incremental import GoldStates
from racelake.session import delete, release, settings
from racelake.sources.files import BRONZE_OPTIONS, BRONZE_READING, RESULTS_SCHEMA, TABLE_OPTIONS
from racelake.streaming.ingest import MAX_FILES_PER_TRIGGER, ingest_stream, read_table_stream, row_key

KEY_BUCKETS = 64
#: Distinct rows of a batch that meet the earlier keys at once, in shares by key: bounds the disk of that join, no result.
ROWS_PER_SHARE = 1 << 25


def for_each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every available micro-batch to ``handle`` (batch, number), then stop."""
    query = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    del query  # its last batch's shuffle is free to go
    release(stream.sparkSession)


class KeyTable:
    """The 32-byte keys of all rows let through, in a table that is hash-partitioned by key.

    The table is bucketed, so an anti join to it moves the batch's keys to the buckets and not the
    table's.  ``buckets`` is fixed for the life of the table: choose it for the final size."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = KEY_BUCKETS):
        self.name = f"racelake_keys_{hashlib.sha1(f'{path}/{buckets}'.encode()).hexdigest()[:16]}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (key BINARY, batch BIGINT) USING parquet "
                  f"CLUSTERED BY (key) INTO {buckets} BUCKETS LOCATION '{path}/{buckets}-buckets'")

    def any_before(self, spark: SparkSession, batch: int) -> bool:
        return not spark.table(self.name).filter(F.col("batch") < batch).isEmpty()

    def unseen(self, df: DataFrame, batch: int) -> DataFrame:
        """Rows whose ``key`` no batch before ``batch`` has added.

        An outer join, as Spark would move a ``left_anti`` join in front of the aggregate that makes
        ``df`` distinct, where a hot row is not yet one row; the table holds a key once."""
        earlier = df.sparkSession.table(self.name).filter(F.col("batch") < batch)
        return df.join(earlier, "key", "left").filter(F.col("batch").isNull()).drop("batch")

    def add(self, keys: DataFrame, batch: int) -> None:
        """Add a batch's keys; a batch that is there already is left as it is."""
        if keys.sparkSession.table(self.name).filter(F.col("batch") == batch).isEmpty():
            keys.select("key", F.lit(batch).cast("long").alias("batch")).write.insertInto(self.name)


class DistinctSink:
    """Exact deduplication over micro-batches and runs without state in the stream.

    Equal rows of a batch are aggregated first (partial counts in each task, so a row delivered a
    million times is one row a task) and stored, then the distinct rows meet the keys of earlier batches,
    if there are any, a share of the keys at a time: only one shuffle of rows is on disk at once."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = KEY_BUCKETS):
        self.spark, self.path = spark, f"{root}/rows"
        self.keys = KeyTable(spark, f"{root}/keys", buckets)

    def add(self, batch: DataFrame, cols, number: int) -> DataFrame:
        """Append the rows of ``batch`` that are new in ``cols`` (which determine the others); returns them, stored."""
        spark = batch.sparkSession
        distinct = batch.distinct().withColumn("key", row_key(cols))
        schema, folder = distinct.schema, f"{self.path}/batch={number}"
        if not self.keys.any_before(spark, number):
            distinct.write.mode("overwrite").options(**TABLE_OPTIONS).parquet(folder)
        else:
            whole = f"{self.path}-whole/batch={number}"
            distinct.write.mode("overwrite").options(**BRONZE_OPTIONS).parquet(whole)
            release(spark)
            rows = spark.read.schema(schema).parquet(whole)
            shares = max(1, -(-rows.count() // ROWS_PER_SHARE))
            for k in range(shares):
                mine = rows.filter(F.pmod(F.xxhash64("key"), F.lit(shares)) == k) if shares > 1 else rows
                (self.keys.unseen(mine, number).write.mode("append" if k else "overwrite")
                 .options(**TABLE_OPTIONS).parquet(folder))
                release(spark)
            delete(spark, whole)
        release(spark)
        stored = spark.read.schema(schema).parquet(folder)
        self.keys.add(stored, number)
        release(spark)
        return stored.drop("key")

    def read(self, schema: StructType) -> DataFrame:
        """All rows let through."""
        return self.spark.read.schema(schema).parquet(self.path)


def dedup_stream_exact(stream: DataFrame, root: str, checkpoint: str, buckets: int = KEY_BUCKETS) -> DataFrame:
    """Every distinct row of the stream once, over all runs with the same folders."""
    sink = DistinctSink(stream.sparkSession, root, buckets)
    for_each_batch(stream, lambda batch, number: sink.add(batch, batch.columns, number), checkpoint)
    return sink.read(stream.schema)


class Medallion:
    """Bronze, silver, gold and their accounting under ``root``, kept up to date by ``run``."""

    def __init__(self, spark: SparkSession, root: str, lookup: DataFrame, schema: StructType = RESULTS_SCHEMA,
                 buckets: int = KEY_BUCKETS, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER):
        self.spark, self.root, self.lookup, self.schema = spark, root.rstrip("/"), lookup, schema
        self.max_files = max_files_per_trigger
        self.sink = DistinctSink(spark, f"{self.root}/silver", buckets)
        self.gold = GoldStates(spark, f"{self.root}/gold")

    def run(self, landing: str) -> None:
        """Take the files that are new in ``landing`` through all layers."""
        bronze = f"{self.root}/bronze"
        ingest_stream(self.spark, landing, self.schema, bronze, f"{self.root}/_checkpoints/bronze", self.max_files)
        stream = read_table_stream(self.spark, bronze, self.schema, self.max_files)
        with settings(self.spark, BRONZE_READING):
            for_each_batch(stream, self.batch, f"{self.root}/_checkpoints/silver")

    def batch(self, raw: DataFrame, number: int) -> None:
        """One micro-batch of bronze rows."""
        spark = raw.sparkSession
        accounting = silver_plan.Accounting()
        valid = silver_plan.valid_enriched(raw, self.lookup, accounting)
        fresh = self.sink.add(valid, silver_plan.DEDUP_COLUMNS, number)
        counts = accounting.counts(raw, self.lookup, fresh.count())
        silver_plan.counts_table(spark, counts).write.mode("overwrite").parquet(f"{self.root}/accounting/batch={number}")
        silver = silver_plan.add_keys(fresh).select(*silver_plan.SILVER_COLUMNS)
        star.write_fact(silver, f"{self.root}/fact_results/batch={number}")
        release(spark)
        GoldStates(spark, self.gold.root).add(silver, f"{number:010d}")

    def silver(self) -> DataFrame:
        rows = self.spark.read.parquet(self.sink.path).drop("batch", "key")
        return silver_plan.add_keys(rows).select(*silver_plan.SILVER_COLUMNS)

    def fact(self, distance_type: str | None = None) -> DataFrame:
        return star.read_fact(self.spark, f"{self.root}/fact_results", distance_type)

    def dims(self) -> dict[str, DataFrame]:
        """The dimensions of all rows so far: events and dates from each delivery's distinct rows, athletes and
        countries from the delivery's picks."""
        return {"event": self.gold.dim_event(), "athlete": self.gold.dim_athlete(),
                "country": self.gold.dim_country(), "date": self.gold.dim_date()}

    def accounting(self) -> DataFrame:
        """(stage, row_count) over all batches: each raw row in exactly one stage."""
        return (self.spark.read.schema("stage string, row_count long, batch long").parquet(f"{self.root}/accounting")
                .groupBy("stage").agg(F.sum("row_count").alias("row_count")))
