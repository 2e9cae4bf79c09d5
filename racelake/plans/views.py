"""Gold analytical views over the star schema.

Join strategy: no hints.  Spark broadcasts a dimension whose files are within its size
threshold (the country lookup, the calendar; small ``dim_event``) and otherwise joins by
shuffle, where AQE splits skewed partitions (a very active athlete).

Averages of the 3-decimal speed use ``fixed_point_avg`` (exact, independent of
partitioning); ``COUNT(DISTINCT ...)`` groups are planned by Catalyst with the
distinct value in the first shuffle key, so a dominant group is spread too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake.functions.athlete import age_group_label, business_age_group, gender_label
from racelake.functions.performance import DISTANCE_TYPES, TIME_TYPES
from racelake.operators.aggregates import fixed_point_avg, rounded_avg, share_of_total
from racelake.operators.filters import keep_known

# Which fact measure each distance-type view shows.
VIEW_MEASURE = {
    "distance_km": "athlete_performance_seconds",
    "distance_mi": "athlete_performance_seconds",
    "time_hours": "athlete_performance_distance",
}

# Which performance types a result of each distance type can have.
VIEW_PERFORMANCE = {
    "distance_km": TIME_TYPES,
    "distance_mi": TIME_TYPES,
    "time_hours": DISTANCE_TYPES,
}


def _star(fact: DataFrame, dims: dict[str, DataFrame], distance_type: str | None,
          how: str = "inner") -> DataFrame:
    event = dims["event"]
    if distance_type is not None:
        event = event.filter(F.col("event_distance_type") == distance_type)
        # A result's performance type fits its event's unit (a silver rule), so the scan of the
        # fact can skip the results of the other units.
        fact = fact.filter(F.col("athlete_performance_type").isin(*VIEW_PERFORMANCE[distance_type]))
    return (fact
            .join(event, "event_id", how)
            .join(dims["athlete"], "athlete_id", how)
            .join(dims["country"], "country_code_iso3", how)
            .join(dims["date"], "date_id", how))


def distance_type_results(fact: DataFrame, dims: dict[str, DataFrame], distance_type: str) -> DataFrame:
    """vw_distance_km_results / vw_distance_mi_results / vw_time_hour_results."""
    measure = VIEW_MEASURE[distance_type]
    return _star(fact, dims, distance_type).select(
        "result_id", "event_start_date", "year", "month", "month_name", "day",
        "event_name", "event_distance_length", "event_distance_value", "event_distance_unit",
        "athlete_id", "athlete_gender", "athlete_year_of_birth", "athlete_age_category",
        "athlete_country", "country_name",
        "event_number_of_finishers", "athlete_performance", measure,
        "athlete_average_speed_kmh", "athlete_age_at_event")


def _activity_aggs(events_name: str):
    return [
        F.count(F.lit(1)).alias("__entries"),
        F.count_distinct("athlete_id").alias("unique_athletes"),
        F.count_distinct("event_id").alias(events_name),
        fixed_point_avg("athlete_average_speed_kmh", 3).alias("average_speed_kmh"),
        rounded_avg("athlete_age_at_event", 1).alias("average_athlete_age"),
    ]


def global_leaderboard(fact: DataFrame, dim_country: DataFrame) -> DataFrame:
    return (fact.join(dim_country, "country_code_iso3")
            .groupBy("country_name", "country_code_iso3")
            .agg(*_activity_aggs("events_participated"))
            .select("country_name", F.col("country_code_iso3").alias("country_code"),
                    F.col("__entries").alias("race_result_records"), "unique_athletes",
                    "events_participated", "average_speed_kmh", "average_athlete_age"))


def seasonal_race_trends(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per year and month; grouped by month number, which is not shown."""
    return (fact.join(dim_date, "date_id")
            .groupBy("year", "month", "month_name")
            .agg(*_activity_aggs("events_held"))
            .select(F.col("year").alias("race_year"), F.col("month_name").alias("race_month"),
                    F.col("__entries").alias("athlete_entries"), "unique_athletes", "events_held",
                    "average_speed_kmh", "average_athlete_age"))


def country_seasonal_trends(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Per year, month and the athlete's country (not the venue's)."""
    return (fact.join(dim_date, "date_id")
            .join(dim_country, "country_code_iso3")
            .groupBy("year", "month", "month_name", "country_name")
            .agg(*_activity_aggs("events_held"))
            .select(F.col("year").alias("race_year"), F.col("month_name").alias("race_month"),
                    "country_name", F.col("__entries").alias("athlete_entries"), "unique_athletes",
                    "events_held", "average_speed_kmh", "average_athlete_age"))


def _demographic_base(fact: DataFrame, dim_athlete: DataFrame) -> DataFrame:
    athletes = keep_known(dim_athlete, "athlete_age_category")
    label, sort = age_group_label("athlete_age_category")
    return (fact.select("athlete_id", "event_id", "athlete_average_speed_kmh", "athlete_age_at_event")
            .join(athletes, "athlete_id")
            .select(gender_label("athlete_gender").alias("gender"), label.alias("age_group"),
                    sort.alias("age_group_sort"), "athlete_id", "event_id",
                    "athlete_average_speed_kmh", "athlete_age_at_event"))


def runner_demographics(fact: DataFrame, dim_athlete: DataFrame) -> DataFrame:
    """Per gender and age group of the athlete dimension's category."""
    return (_demographic_base(fact, dim_athlete)
            .groupBy("gender", "age_group", "age_group_sort")
            .agg(F.count(F.lit(1)).alias("athlete_entries"),
                 F.count_distinct("athlete_id").alias("unique_athletes"),
                 fixed_point_avg("athlete_average_speed_kmh", 3).alias("average_speed_kmh"),
                 rounded_avg("athlete_age_at_event", 1).alias("average_athlete_age"))
            .select("gender", "age_group", "athlete_entries", "unique_athletes",
                    "average_speed_kmh", "average_athlete_age"))


def demographics_full(fact: DataFrame, dim_athlete: DataFrame) -> DataFrame:
    """Demographics plus entries per athlete, participation share and events.

    The share needs the grand total; it is taken over the aggregated rows, whose
    number is bounded by gender x age-group labels (a grouping set read by a scalar subquery
    runs the join twice, as Spark does not share the two plans' exchanges).
    """
    summary = (_demographic_base(fact, dim_athlete)
               .groupBy("gender", "age_group", "age_group_sort")
               .agg(F.count(F.lit(1)).alias("athlete_entries"),
                    F.count_distinct("athlete_id").alias("unique_athletes"),
                    F.count_distinct("event_id").alias("events_participated"),
                    fixed_point_avg("athlete_average_speed_kmh", 3).alias("average_speed_kmh"),
                    rounded_avg("athlete_age_at_event", 1).alias("average_athlete_age")))
    return (share_of_total(summary, "athlete_entries", "participation_share_percent")
            .withColumn("entries_per_athlete", F.round(F.col("athlete_entries") / F.col("unique_athletes"), 2))
            .orderBy("gender", "age_group_sort")
            .select("gender", "age_group", "athlete_entries", "unique_athletes", "entries_per_athlete",
                    "participation_share_percent", "events_participated", "average_speed_kmh",
                    "average_athlete_age"))


# Business views - (distance type, label/measure column names).
BUSINESS_VIEWS = {
    "km": ("distance_km", "race_distance_label", "race_distance_value", "race_distance_unit"),
    "mi": ("distance_mi", "race_distance_label", "race_distance_value", "race_distance_unit"),
    "hour": ("time_hours", "race_time_limit_label", "race_time_limit_hours", "race_time_unit"),
}


def business_view(fact: DataFrame, dims: dict[str, DataFrame], kind: str) -> DataFrame:
    """Business-labelled result rows of one distance type.

    The hour view reports the covered distance with its own unit
    (``distance_covered`` + ``distance_covered_unit``): miles stay miles.
    """
    distance_type, label_col, value_col, unit_col = BUSINESS_VIEWS[kind]
    base = _star(fact, dims, distance_type)
    cols = [
        "result_id",
        F.col("event_start_date").alias("race_date"), F.col("year").alias("race_year"),
        F.col("month_name").alias("race_month"), F.col("day").alias("race_day"),
        "event_name",
        F.col("event_distance_length").alias(label_col), F.col("event_distance_value").alias(value_col),
        F.col("event_distance_unit").alias(unit_col),
        "athlete_id", gender_label("athlete_gender").alias("gender"),
        F.col("athlete_year_of_birth").alias("birth_year"),
        business_age_group("athlete_age_category").alias("age_group"),
        F.col("athlete_age_at_event").alias("athlete_age"),
        "country_name",
        F.col("event_number_of_finishers").alias("number_of_finishers"),
    ]
    if kind == "hour":
        cols += [F.col("athlete_performance").alias("distance_covered_text"),
                 F.col("athlete_performance_distance").alias("distance_covered"),
                 F.col("athlete_performance_unit").alias("distance_covered_unit")]
    else:
        cols += [F.col("athlete_performance").alias("finish_time"),
                 F.col("athlete_performance_seconds").alias("finish_time_seconds")]
    cols.append(F.col("athlete_average_speed_kmh").alias("average_speed_kmh"))
    return base.select(*cols)


def star_left_preview(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact with every dimension left-joined (rows kept when a key is missing)."""
    return _star(fact, dims, None, how="left").select(
        "result_id", "event_start_date", "year", "month_name", "event_name", "event_distance_length",
        "event_distance_type", "athlete_id", "athlete_gender", "athlete_year_of_birth",
        "athlete_age_category", "country_name", "athlete_performance", "athlete_performance_type",
        "athlete_average_speed_kmh", "athlete_age_at_event")
