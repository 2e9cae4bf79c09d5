"""File sources and sinks: CSV scans, schema inference, table writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# CSV text is kept byte for byte: the race-results fields carry meaningful
# leading/trailing spaces that the parsers trim themselves.
CSV_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# Exact timestamps through CSV text (the default keeps milliseconds only).
TIMESTAMP_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}

#: Stored tables hold hash keys as hex text, which only an entropy coder makes small.
TABLE_OPTIONS = {"compression": "zstd"}
#: Bronze files in small row groups, and read in small splits: their rows are many times wider once parsed, and what
#: a task holds of them (the partial aggregate of the silver rows) must not grow with the files.
BRONZE_OPTIONS = TABLE_OPTIONS | {"parquet.block.size": str(4 << 20)}
BRONZE_READING = {"spark.sql.files.maxPartitionBytes": str(8 << 20)}
#: Landed files are compressed whole, and so are read by one task each.
LANDING_OPTIONS = {"compression": "gzip"}

# The schema of the race results and of the country lookup, for batch and stream
# alike.  Speed stays text: it holds clock times beside numbers, and a type that depended on the
# files at hand would give one result two keys.
RESULTS_SCHEMA = StructType([
    StructField("Year of event", IntegerType()),
    StructField("Event dates", StringType()),
    StructField("Event name", StringType()),
    StructField("Event distance/length", StringType()),
    StructField("Event number of finishers", IntegerType()),
    StructField("Athlete performance", StringType()),
    StructField("Athlete club", StringType()),
    StructField("Athlete country", StringType()),
    StructField("Athlete year of birth", DoubleType()),
    StructField("Athlete gender", StringType()),
    StructField("Athlete age category", StringType()),
    StructField("Athlete average speed", StringType()),
    StructField("Athlete ID", IntegerType()),
])
COUNTRIES_SCHEMA = StructType([
    StructField("athlete_country_code", StringType()),
    StructField("country_code_iso3", StringType()),
    StructField("country_name", StringType()),
])


def infer_csv_schema(spark: SparkSession, sample_path: str) -> StructType:
    """Schema of a sample file (header + type inference), to fix a stream's schema.

    Inference scans the sample once; point it at one representative file, not
    the whole landing folder.
    """
    return (spark.read.format("csv").options(**CSV_OPTIONS).option("inferSchema", "true")
            .load(sample_path).schema)


def schema_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """(column_name, data_type) rows of a schema (a column listing as a table)."""
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields],
                                 "column_name string, data_type string")


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             infer: bool = False) -> DataFrame:
    """Batch CSV scan with header; a given schema wins over inference."""
    reader = spark.read.format("csv").options(**CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.load(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Full-refresh sink: overwrite the table, then read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
