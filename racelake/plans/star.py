"""Gold star schema: four dimensions and one fact, from the silver table.

Dimension rows must be unique per key and reproducible.  ``dim_event`` and
``dim_date`` carry only attributes that are functions of their key, so a
``distinct()`` (hash aggregate, partial map-side) is exact.  An athlete's club
or category, and the athlete code behind one ISO3 country, can differ between
results; those dimensions keep the row that sorts first by a total order
(latest event then smallest result id; smallest athlete code), through
``one_row_per_key`` - a grouped ``min_by``, no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.functions.dates import date_key
from racelake.operators.dedup import one_row_per_key
from racelake.sources.files import TABLE_OPTIONS

# Dimension and fact column lists.
DIM_EVENT_COLUMNS = ["event_id", "event_name", "event_distance_length", "event_distance_type",
                     "event_distance_value", "event_distance_unit"]
DIM_ATHLETE_COLUMNS = ["athlete_id", "athlete_gender", "athlete_year_of_birth",
                       "athlete_age_category", "athlete_club"]
DIM_COUNTRY_COLUMNS = ["country_code_iso3", "athlete_country", "country_name"]
DIM_DATE_COLUMNS = ["date_id", "event_start_date", "year", "month", "month_name", "day"]
FACT_COLUMNS = ["result_id", "event_id", "athlete_id", "country_code_iso3", "date_id",
                "event_number_of_finishers", "athlete_performance", "athlete_performance_type",
                "athlete_performance_seconds", "athlete_performance_distance",
                "athlete_performance_unit", "athlete_average_speed", "athlete_average_speed_kmh",
                "athlete_age_at_event"]


def dim_event(silver: DataFrame) -> DataFrame:
    return silver.select(*DIM_EVENT_COLUMNS).distinct()


def pick_latest(rows: DataFrame) -> DataFrame:
    """One row per athlete: the latest event start date, then the smallest result id."""
    return one_row_per_key(rows, "athlete_id", order_by=["event_start_date", "result_id"],
                           descending=["event_start_date"])


def latest_athletes(silver: DataFrame) -> DataFrame:
    """Latest attributes per athlete, with the date and result that they come from."""
    return pick_latest(silver.select(*DIM_ATHLETE_COLUMNS, "event_start_date", "result_id"))


def dim_athlete(silver: DataFrame) -> DataFrame:
    """Latest attributes per athlete (by event start date, then result id)."""
    return latest_athletes(silver).select(*DIM_ATHLETE_COLUMNS)


def dim_country(silver: DataFrame) -> DataFrame:
    """One row per ISO3 code: the smallest athlete code and its name."""
    return one_row_per_key(silver.select(*DIM_COUNTRY_COLUMNS).distinct(), "country_code_iso3",
                           order_by=["athlete_country", "country_name"]).select(*DIM_COUNTRY_COLUMNS)


def dim_date(silver: DataFrame) -> DataFrame:
    """One row per start date; the dates are made distinct before any is formatted."""
    d = F.col("event_start_date")
    return silver.select(d).distinct().select(
        date_key(d).alias("date_id"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
    )


def _fact_columns() -> list[Column]:
    return [date_key("event_start_date").alias(c) if c == "date_id" else F.col(c) for c in FACT_COLUMNS]


def fact_results(silver: DataFrame) -> DataFrame:
    """Projection only: no shuffle."""
    return silver.select(*_fact_columns())


#: The fact table's files are parted by this attribute of the event, which every distance view asks for.
FACT_PARTITION = "event_distance_type"


def write_fact(silver: DataFrame, path: str) -> None:
    """The fact rows, in a folder per distance type (three values, so at most three files a task)."""
    (silver.select(*_fact_columns(), FACT_PARTITION)
     .write.mode("overwrite").options(**TABLE_OPTIONS).partitionBy(FACT_PARTITION).parquet(path))


def read_fact(spark: SparkSession, path: str, distance_type: str | None = None) -> DataFrame:
    """The fact; with a distance type only that folder's files are read."""
    stored = spark.read.parquet(path)
    if distance_type is not None:
        stored = stored.filter(F.col(FACT_PARTITION) == distance_type)
    return stored.select(*FACT_COLUMNS)
