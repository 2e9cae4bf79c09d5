"""Structured Streaming: incremental file ingest and the silver chain on a stream.

Every stream runs with ``trigger(availableNow=True)``: it processes all files
not yet recorded in its checkpoint, commits, and stops, so a scheduled job
picks up only new files on each run (exactly-once through the checkpoint and
the file sink's log).  Checkpoints and sinks live in the shared folder of
``spark.checkpoint.dir``, so a restarted driver or a lost executor resumes
from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from racelake.plans import silver as silver_plan
from racelake.session import release
from racelake.sources.files import BRONZE_OPTIONS, CSV_OPTIONS, TIMESTAMP_OPTIONS


#: Files that one micro-batch takes from a backlog: bounds the work (and the state update) of a batch.
MAX_FILES_PER_TRIGGER = 1000


def read_csv_stream(spark: SparkSession, path: str, schema: StructType,
                    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Streaming CSV scan of a landing folder (and its sub-folders) with a fixed schema."""
    return (spark.readStream.format("csv").options(**CSV_OPTIONS).options(**TIMESTAMP_OPTIONS)
            .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", str(max_files_per_trigger))
            .schema(schema).load(path))


def write_append(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Append a stream to a parquet table, once, over everything available."""
    query = (stream.writeStream.format("parquet").outputMode("append")
             .options(**BRONZE_OPTIONS).option("path", sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    del query  # its last batch's shuffle is free to go
    release(stream.sparkSession)


def ingest_stream(spark: SparkSession, landing: str, schema: StructType, sink: str, checkpoint: str,
                  max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Bronze ingest: new CSV files in ``landing`` -> appended to ``sink``."""
    write_append(read_csv_stream(spark, landing, schema, max_files_per_trigger), sink, checkpoint)
    return spark.read.parquet(sink)


def read_table_stream(spark: SparkSession, path: str, schema: StructType,
                      max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Stream read of a parquet table written by another stream (``FROM STREAM t``)."""
    return (spark.readStream.option("maxFilesPerTrigger", str(max_files_per_trigger))
            .schema(schema).parquet(path))


def row_key(cols) -> Column:
    """32-byte SHA-256 over the JSON of the columns, which tells NULL from text."""
    return F.unhex(F.sha2(F.to_json(F.struct(*cols)), 256))


def dedup_stream(stream: DataFrame, cols) -> DataFrame:
    """Stateful dedup across micro-batches and runs: every distinct row comes out once.

    The state holds one 32-byte key per distinct row, not the columns.  It is exact and grows
    with the distinct rows: use the RocksDB state store at scale.  Its partition count is
    ``spark.sql.shuffle.partitions`` of the first run, and copies of one row meet in one state
    task; ``racelake.streaming.medallion.DistinctSink`` has neither limit.  There is no watermark:
    files arrive in no order of event time, so an expiry would drop rows that were never seen.
    """
    return stream.withColumn("_row_key", row_key(cols)).dropDuplicates(["_row_key"]).drop("_row_key")


def silver_stream(raw_stream: DataFrame, lookup: DataFrame) -> DataFrame:
    """The silver chain on a stream: the batch parsers and rules unchanged,
    a stream-static join to the lookup, exact stateful dedup, then the keys."""
    rows = silver_plan.enrich_country(silver_plan.valid_rows(raw_stream), lookup)
    base = [c for c in silver_plan.SILVER_COLUMNS if c not in ("event_id", "result_id")]
    deduped = dedup_stream(rows.select(*base), silver_plan.DEDUP_COLUMNS)
    return silver_plan.add_keys(deduped).select(*silver_plan.SILVER_COLUMNS)
