"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the supplied tables (through the materialised layers of
``racelake.plans.lakehouse``) and runs over whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.functions import athlete as _ath
from racelake.functions import dates as _dates
from racelake.functions import distance as _dist
from racelake.functions import keys as _keys
from racelake.functions import performance as _perf
from racelake.functions import speed as _speed
from racelake.functions.columns import rename_column, safe_cast, snake_case_columns
from racelake.operators import aggregates as _agg
from racelake.operators import filters as _flt
from racelake.operators import sketches as _sketches
from racelake.operators import bitmaps as _bitmaps
from racelake.operators.dedup import dedup_results
from racelake.operators.joins import duplicate_key_values, rows_with_duplicate_keys
from racelake.operators.sort import sorted_by, top_k
from racelake.plans import profile as _prof
from racelake.plans import quality as _dq
from racelake.plans import silver as _silver
from racelake.plans import views
from racelake.plans.lakehouse import Lakehouse, lakehouse
from racelake.session import release, settings
from racelake.sources import files as _files
from racelake.streaming import ingest as _stream
from racelake.streaming import medallion as _medallion

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- silver / gold

@register("silver_obt")
def silver_obt(spark, sf_dir):
    return lakehouse(spark, sf_dir).silver()


@register("fact_results")
def fact_results(spark, sf_dir):
    return lakehouse(spark, sf_dir).fact()


for _dim in ("event", "athlete", "country", "date"):
    def _dim_query(spark, sf_dir, _dim=_dim):
        return lakehouse(spark, sf_dir).table(f"dim_{_dim}")
    register(f"dim_{_dim}")(_dim_query)


@register("vw_distance_km_results")
def vw_distance_km_results(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    return views.distance_type_results(lake.fact("distance_km"), lake.dims(), "distance_km")


@register("vw_distance_mi_results")
def vw_distance_mi_results(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    return views.distance_type_results(lake.fact("distance_mi"), lake.dims(), "distance_mi")


@register("vw_time_hour_results")
def vw_time_hour_results(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    return views.distance_type_results(lake.fact("time_hours"), lake.dims(), "time_hours")


@register("vw_global_leaderboard")
def vw_global_leaderboard(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    return views.global_leaderboard(lake.fact(), lake.dims()["country"])


@register("vw_seasonal_race_trends")
def vw_seasonal_race_trends(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    return views.seasonal_race_trends(lake.fact(), lake.dims()["date"])


@register("vw_runner_demographics")
def vw_runner_demographics(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    return views.runner_demographics(lake.fact(), lake.dims()["athlete"])


@register("vw_country_seasonal_trends")
def vw_country_seasonal_trends(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    d = lake.dims()
    return views.country_seasonal_trends(lake.fact(), d["date"], d["country"])


@register("demographics_full")
def demographics_full(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    return views.demographics_full(lake.fact(), lake.dims()["athlete"])


for _kind in ("km", "mi", "hour"):
    def _business(spark, sf_dir, _kind=_kind):
        lake = lakehouse(spark, sf_dir)
        return views.business_view(lake.fact(views.BUSINESS_VIEWS[_kind][0]), lake.dims(), _kind)
    register(f"vw_{_kind}_business")(_business)


@register("star_left_preview")
def star_left_preview(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    return views.star_left_preview(lake.fact(), lake.dims())


# ------------------------------------------------------------ helpers

def _raw(spark, sf_dir):
    """Bronze race results, snake_case."""
    return snake_case_columns(lakehouse(spark, sf_dir).raw())


def _derived(spark, sf_dir):
    """Every silver column derived for every raw row, nothing filtered yet."""
    return _silver.silver_columns(lakehouse(spark, sf_dir).raw())


def _tpch(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------ columns, parsers

@register("snake_case_columns")
def q_snake_case_columns(spark, sf_dir):
    return _raw(spark, sf_dir)


@register("rename_column")
def q_rename_column(spark, sf_dir):
    return rename_column(lakehouse(spark, sf_dir).raw(), "Athlete country", "athlete_country_code")


@register("try_cast_speed")
def q_try_cast_speed(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "athlete_average_speed", safe_cast("athlete_average_speed", "double").alias("athlete_average_speed_numeric"))


@register("classify_date_format")
def q_classify_date_format(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "event_dates", _dates.classify_date_format("event_dates").alias("event_date_format_type"))


@register("parse_event_dates")
def q_parse_event_dates(spark, sf_dir):
    r = _raw(spark, sf_dir)
    start, end = _dates.event_date_bounds("event_dates")
    return r.select(F.col("event_dates").alias("event_date_raw"),
                    _dates.classify_date_format("event_dates").alias("event_date_format_type"),
                    start.alias("event_start_date"), end.alias("event_end_date"))


@register("event_duration_days")
def q_event_duration_days(spark, sf_dir):
    d = q_parse_event_dates(spark, sf_dir)
    d = _flt.require_columns(d, ["event_start_date", "event_end_date"])
    return d.select("event_date_raw", "event_start_date", "event_end_date",
                    _dates.event_duration_days("event_start_date", "event_end_date").alias("event_duration_days"),
                    _dates.dates_in_order("event_start_date", "event_end_date").alias("dates_in_order"))


@register("filter_valid_dates")
def q_filter_valid_dates(spark, sf_dir):
    d = _derived(spark, sf_dir)
    return _flt.require_columns(d, ["event_start_date", "event_end_date"]).select(
        "event_date_raw", "event_date_format_type", "event_start_date", "event_end_date")


@register("classify_event_distance")
def q_classify_event_distance(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "event_distance_length", _dist.classify_event_distance("event_distance_length").alias("event_distance_type"))


@register("filter_event_type")
def q_filter_event_type(spark, sf_dir):
    d = q_classify_event_distance(spark, sf_dir)
    return _flt.keep_values(d, "event_distance_type", _dist.KEPT_DISTANCE_CLASSES)


@register("standardize_distance")
def q_standardize_distance(spark, sf_dir):
    d = q_filter_event_type(spark, sf_dir)
    return d.select(F.col("event_distance_length").alias("event_distance_length_raw"),
                    _dist.standardize_distance("event_distance_length").alias("event_distance_length"),
                    _dist.standardize_distance_type("event_distance_type").alias("event_distance_type"))


@register("extract_distance_value_unit")
def q_extract_distance_value_unit(spark, sf_dir):
    d = q_standardize_distance(spark, sf_dir)
    return d.select("event_distance_length",
                    _dist.distance_value("event_distance_length").alias("event_distance_value"),
                    _dist.distance_unit("event_distance_length").alias("event_distance_unit"))


@register("multistage_distance_profile")
def q_multistage_distance_profile(spark, sf_dir):
    return _prof.multistage_profile(lakehouse(spark, sf_dir).raw())


@register("classify_performance")
def q_classify_performance(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "athlete_performance", _perf.classify_performance("athlete_performance").alias("athlete_performance_type"))


@register("filter_performance_type")
def q_filter_performance_type(spark, sf_dir):
    return _flt.drop_values(q_classify_performance(spark, sf_dir), "athlete_performance_type", ["null", "unknown"])


@register("parse_duration_seconds")
def q_parse_duration_seconds(spark, sf_dir):
    d = _flt.keep_values(q_classify_performance(spark, sf_dir), "athlete_performance_type", _perf.TIME_TYPES)
    return d.withColumn("athlete_performance_seconds", _perf.duration_seconds("athlete_performance"))


@register("parse_performance_distance")
def q_parse_performance_distance(spark, sf_dir):
    d = _flt.keep_values(q_classify_performance(spark, sf_dir), "athlete_performance_type", _perf.DISTANCE_TYPES)
    return d.withColumns({
        "athlete_performance_distance": _perf.performance_distance("athlete_performance"),
        "athlete_performance_unit": _perf.performance_unit("athlete_performance_type"),
    })


@register("clean_club")
def q_clean_club(spark, sf_dir):
    return _raw(spark, sf_dir).select(F.col("athlete_club").alias("athlete_club_raw"),
                                      _ath.clean_club("athlete_club").alias("athlete_club"))


@register("normalize_codes")
def q_normalize_codes(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        F.col("athlete_country").alias("athlete_country_raw"),
        _ath.normalize_code("athlete_country").alias("athlete_country"),
        F.col("athlete_gender").alias("athlete_gender_raw"),
        _ath.normalize_code("athlete_gender").alias("athlete_gender"))


@register("null_sentinel")
def q_null_sentinel(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        F.col("athlete_year_of_birth").alias("athlete_year_of_birth_raw"),
        _ath.clean_birth_year("athlete_year_of_birth").alias("athlete_year_of_birth"))


@register("age_at_event")
def q_age_at_event(spark, sf_dir):
    r = _raw(spark, sf_dir).select(
        "year_of_event", F.col("athlete_year_of_birth").alias("athlete_year_of_birth_raw"),
        _ath.clean_birth_year("athlete_year_of_birth").alias("athlete_year_of_birth"))
    return r.withColumn("athlete_age_at_event", _ath.age_at_event("year_of_event", "athlete_year_of_birth"))


@register("clean_age_category")
def q_clean_age_category(spark, sf_dir):
    return _raw(spark, sf_dir).select(F.col("athlete_age_category").alias("athlete_age_category_raw"),
                                      _ath.clean_category("athlete_age_category").alias("athlete_age_category"))


@register("average_speed_kmh")
def q_average_speed_kmh(spark, sf_dir):
    return _derived(spark, sf_dir).select(
        "event_distance_value", "event_distance_unit", "athlete_performance_seconds",
        "athlete_performance_distance", "athlete_performance_unit", "athlete_average_speed_kmh")


@register("rescale_speed")
def q_rescale_speed(spark, sf_dir):
    return _prof.rescaled_speeds(lakehouse(spark, sf_dir).raw())


@register("speed_quality_counts")
def q_speed_quality_counts(spark, sf_dir):
    return _prof.speed_quality_counts(lakehouse(spark, sf_dir).raw())


@register("club_pattern_counts")
def q_club_pattern_counts(spark, sf_dir):
    return _prof.club_pattern_counts(lakehouse(spark, sf_dir).raw())


@register("gender_label")
def q_gender_label(spark, sf_dir):
    a = lakehouse(spark, sf_dir).table("dim_athlete")
    return a.select("athlete_id", "athlete_gender", _ath.gender_label("athlete_gender").alias("gender"))


@register("age_group_label")
def q_age_group_label(spark, sf_dir):
    a = lakehouse(spark, sf_dir).table("dim_athlete")
    label, sort = _ath.age_group_label("athlete_age_category")
    return a.select("athlete_id", "athlete_age_category", label.alias("age_group"), sort.alias("age_group_sort"))


@register("surrogate_event_id")
def q_surrogate_event_id(spark, sf_dir):
    s = lakehouse(spark, sf_dir).silver()
    return s.select("event_name", "event_distance_length", _keys.event_id().alias("event_id")).distinct()


@register("surrogate_result_id")
def q_surrogate_result_id(spark, sf_dir):
    s = lakehouse(spark, sf_dir).silver()
    return s.select(*_keys.RESULT_KEY_COLUMNS, _keys.result_id().alias("result_id"))


# ------------------------------------------------------------ filters

@register("filter_finishers")
def q_filter_finishers(spark, sf_dir):
    return _flt.keep_positive(_raw(spark, sf_dir), "event_number_of_finishers").select(
        "event_name", "event_number_of_finishers")


@register("filter_unit_consistency")
def q_filter_unit_consistency(spark, sf_dir):
    return _flt.keep_consistent(_derived(spark, sf_dir), "event_distance_unit", "athlete_performance_type",
                                _silver.UNIT_PERFORMANCE_PAIRS).select(
        "event_distance_length", "event_distance_unit", "athlete_performance", "athlete_performance_type")


@register("filter_speed_range")
def q_filter_speed_range(spark, sf_dir):
    return _flt.keep_range(_derived(spark, sf_dir), "athlete_average_speed_kmh", 0, _speed.SPEED_MAX_KMH).select(
        "event_distance_length", "athlete_performance", "athlete_average_speed_kmh")


@register("filter_required_fields")
def q_filter_required_fields(spark, sf_dir):
    cols = ["athlete_country", "athlete_gender", "athlete_year_of_birth", "athlete_age_at_event"]
    return _flt.require_columns(_derived(spark, sf_dir), cols).select("athlete_id", *cols)


@register("regex_match_filter")
def q_regex_match_filter(spark, sf_dir):
    return _flt.keep_matching(_raw(spark, sf_dir), "event_dates", _dates.DATE_LAYOUTS["single_date"]).select(
        "event_dates")


@register("substring_predicates")
def q_substring_predicates(spark, sf_dir):
    r = _raw(spark, sf_dir)
    c = F.col("event_distance_length")
    return (r.filter(c.contains("Etappen") | c.endswith("d"))
            .select("event_distance_length", c.contains("Etappen").alias("contains_etappen"),
                    c.endswith("d").alias("ends_with_d")))


@register("missing_or_sentinel")
def q_missing_or_sentinel(spark, sf_dir):
    r = _raw(spark, sf_dir)
    found = r.filter(F.col("athlete_year_of_birth").isNull() | (F.col("athlete_year_of_birth") == 1193))
    # Tie-breakers after the sort key let the range partitioner split a large
    # tie group (all NULL birth years) across tasks.
    return sorted_by(found.drop("event_number_of_finishers"),
                     [("athlete_year_of_birth", "asc_nulls_first"), "athlete_id", "year_of_event",
                      "event_dates", "event_name"])


@register("dq_unit_mismatch_rows")
def q_dq_unit_mismatch_rows(spark, sf_dir):
    d = _derived(spark, sf_dir)
    earlier = (F.col("event_start_date").isNotNull() & F.col("event_end_date").isNotNull()
               & F.col(_silver.DISTANCE_CLASS).isin(*_dist.KEPT_DISTANCE_CLASSES)
               & (F.col("event_number_of_finishers") > 0)
               & ~F.col("athlete_performance_type").isin("null", "unknown"))
    return _dq.unit_mismatch_rows(d.filter(earlier)).select(
        "event_distance_length", "event_distance_unit", "athlete_performance", "athlete_performance_type")


@register("dq_year_out_of_range")
def q_dq_year_out_of_range(spark, sf_dir):
    return _flt.rows_outside(_raw(spark, sf_dir), "year_of_event", 1798, 2022)


@register("speed_outlier_bands")
def q_speed_outlier_bands(spark, sf_dir):
    return _prof.speed_outlier_bands(lakehouse(spark, sf_dir).raw())


@register("dq_blank_text")
def q_dq_blank_text(spark, sf_dir):
    return _prof.blank_text_counts(lakehouse(spark, sf_dir).raw(),
                                   ["event_name", "event_distance_length", "athlete_club"])


# ------------------------------------------------------------ joins and keys

@register("enrich_country")
def q_enrich_country(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    rows = _silver.enrich_country(_silver.valid_rows(lake.raw()), lake.lookup())
    return rows.select("athlete_id", "athlete_country", "country_code_iso3", "country_name")


def _key_audit(dim_name: str, key: str, out: str):
    def fn(spark, sf_dir):
        lake = lakehouse(spark, sf_dir)
        return _dq.missing_key_count(lake.fact(), lake.table(dim_name), key, out)
    return fn


register("dq_missing_event_keys")(_key_audit("dim_event", "event_id", "missing_event_keys"))
register("dq_missing_athlete_keys")(_key_audit("dim_athlete", "athlete_id", "missing_athlete_keys"))
register("dq_missing_country_keys")(_key_audit("dim_country", "country_code_iso3", "missing_country_keys"))
register("dq_missing_date_keys")(_key_audit("dim_date", "date_id", "missing_date_keys"))


@register("dq_duplicate_totals")
def q_dq_duplicate_totals(spark, sf_dir):
    return _dq.duplicate_totals(lakehouse(spark, sf_dir).table("silver_candidates"), "result_id")


@register("duplicate_rows_detail")
def q_duplicate_rows_detail(spark, sf_dir):
    c = lakehouse(spark, sf_dir).table("silver_candidates")
    return sorted_by(rows_with_duplicate_keys(c, "result_id").select(
        "result_id", "event_id", "year_of_event", "event_name", "event_date_raw", "event_distance_length",
        "athlete_id", "athlete_country", "country_name", "athlete_performance", "athlete_average_speed",
        "athlete_average_speed_kmh"), ["result_id", "event_name", "athlete_id"])


@register("sample_duplicate_group")
def q_sample_duplicate_group(spark, sf_dir):
    return _dq.sample_duplicate_group(lakehouse(spark, sf_dir).table("silver_candidates"))


@register("duplicate_column_diff")
def q_duplicate_column_diff(spark, sf_dir):
    candidates = lakehouse(spark, sf_dir).table("silver_candidates")
    keys = _files.write_table(duplicate_key_values(candidates, "result_id").select("result_id"),
                              _scratch(spark, sf_dir, "duplicate_keys"))
    release(spark)
    return _dq.duplicate_column_diff(candidates, keys=keys)


@register("duplicate_combinations")
def q_duplicate_combinations(spark, sf_dir):
    return _dq.duplicate_combinations(lakehouse(spark, sf_dir).raw(), [
        "Year of event", "Event name", "Athlete ID", "Athlete performance", "Athlete country"])


@register("dedup_results")
def q_dedup_results(spark, sf_dir):
    return dedup_results(lakehouse(spark, sf_dir).table("silver_candidates"), _silver.DEDUP_COLUMNS)


# ------------------------------------------------------------ aggregates, checks

@register("value_counts")
def q_value_counts(spark, sf_dir):
    return sorted_by(_agg.value_counts(_raw(spark, sf_dir), "event_distance_length"),
                     [("row_count", "desc"), "event_distance_length"])


@register("count_by_unit")
def q_count_by_unit(spark, sf_dir):
    return _agg.value_counts(lakehouse(spark, sf_dir).silver(), "event_distance_unit")


@register("count_by_type_pair")
def q_count_by_type_pair(spark, sf_dir):
    return _agg.value_counts(lakehouse(spark, sf_dir).silver(), "event_distance_type", "athlete_performance_type")


@register("event_type_distribution")
def q_event_type_distribution(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    return _dq.event_type_distribution(lake.fact(), lake.table("dim_event"))


@register("profile_distinct_counts")
def q_profile_distinct_counts(spark, sf_dir):
    return _agg.profile_distinct(lakehouse(spark, sf_dir).raw())


_PROFILES: dict[str, _sketches.ProfileStore] = {}
PROFILE_BOUND = 1_000_000


def _profile(spark, sf_dir) -> _sketches.ProfileStore:
    """Sketches of the raw table's columns, taken of two deliveries apart; once per lake."""
    lake = lakehouse(spark, sf_dir)
    if lake.root not in _PROFILES:
        store = _sketches.ProfileStore(spark, _scratch(spark, sf_dir, "profile"))
        for k, part in enumerate(_two_drops(lake.raw())):
            store.add(part, str(k))
        _PROFILES[lake.root] = store
    return _PROFILES[lake.root]


@register("profile_distinct_bounded")
def q_profile_distinct_bounded(spark, sf_dir):
    """Merged sketches choose the columns of at most a million values, which are counted exactly."""
    raw = lakehouse(spark, sf_dir).raw()
    return _sketches.bounded_distinct(raw, _profile(spark, sf_dir).distinct_counts(), PROFILE_BOUND)


@register("profile_sketch_error")
def q_profile_sketch_error(spark, sf_dir):
    """Per column whether the merged sketches' distinct count is within four standard errors of the exact one."""
    estimate = _profile(spark, sf_dir).distinct_counts().withColumnRenamed("distinct_values", "estimate")
    exact = _agg.profile_distinct(lakehouse(spark, sf_dir).raw())
    off = F.abs(F.col("estimate") - F.col("distinct_values"))
    bound = F.greatest(F.lit(1.0), F.col("distinct_values") * (4 * 1.04 / 2 ** (_sketches.LG_K / 2)))
    return exact.join(estimate, "column_name").select("column_name", "distinct_values", (off <= bound).alias("within_bound"))


@register("numeric_summary_merged")
def q_numeric_summary_merged(spark, sf_dir):
    """Counts, extremes and means of the numeric columns from merged sketches (the parts that are exact)."""
    return _profile(spark, sf_dir).summary().select("column_name", "count", F.round("mean", 6).alias("mean"), "min", "max")


@register("layer_row_counts")
def q_layer_row_counts(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    tables = {n: lake.table(n) for n in ("bronze_results", "bronze_country_codes", "silver_obt", "fact_results",
                                         "dim_event", "dim_athlete", "dim_country", "dim_date")}
    for name in ("vw_distance_km_results", "vw_distance_mi_results", "vw_time_hour_results",
                 "vw_global_leaderboard", "vw_seasonal_race_trends", "vw_runner_demographics",
                 "vw_country_seasonal_trends"):
        tables[name] = REGISTRY[name](spark, sf_dir)
    return _dq.layer_row_counts(tables)


@register("distinct_values")
def q_distinct_values(spark, sf_dir):
    return _agg.distinct_values(_raw(spark, sf_dir), ["athlete_gender"])


@register("distinct_key_counts")
def q_distinct_key_counts(spark, sf_dir):
    s = lakehouse(spark, sf_dir).silver()
    return s.agg(F.count(F.lit(1)).alias("row_count"),
                 F.count_distinct("result_id").alias("distinct_result_ids"),
                 F.count_distinct("event_id").alias("distinct_event_ids"),
                 F.count_distinct("athlete_id").alias("distinct_athletes"))


@register("dq_speed_stats")
def q_dq_speed_stats(spark, sf_dir):
    return _dq.speed_stats(lakehouse(spark, sf_dir).silver())


@register("dq_age_range")
def q_dq_age_range(spark, sf_dir):
    return _dq.age_range(lakehouse(spark, sf_dir).silver())


@register("dq_missing_country")
def q_dq_missing_country(spark, sf_dir):
    return _dq.missing_country(lakehouse(spark, sf_dir).silver())


@register("dq_unit_mismatch")
def q_dq_unit_mismatch(spark, sf_dir):
    return _dq.unit_mismatch_count(lakehouse(spark, sf_dir).silver())


@register("null_counts")
def q_null_counts(spark, sf_dir):
    """NULLs of every raw column plus the 1193 birth-year typo, one pass."""
    r = _raw(spark, sf_dir)
    return r.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_null_count") for c in r.columns],
                 F.count_if(F.col("athlete_year_of_birth") == _ath.BIRTH_YEAR_SENTINEL)
                 .alias("invalid_1193_birth_year_count"))


@register("lookup_null_counts")
def q_lookup_null_counts(spark, sf_dir):
    raw_lookup = lakehouse(spark, sf_dir).lookup()
    cleaned = raw_lookup.select(
        _ath.normalize_code("athlete_country_code").alias("athlete_country_code"),
        _ath.normalize_code("country_code_iso3").alias("country_code_iso3"),
        F.trim("country_name").alias("country_name"))
    return _agg.null_counts(cleaned, cleaned.columns)


@register("dq_null_key_audit")
def q_dq_null_key_audit(spark, sf_dir):
    return _dq.null_key_audit(lakehouse(spark, sf_dir).silver())


@register("dq_dim_uniqueness")
def q_dq_dim_uniqueness(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    return _dq.dim_uniqueness({
        "dim_event": (lake.table("dim_event"), "event_id"),
        "dim_athlete": (lake.table("dim_athlete"), "athlete_id"),
        "dim_country": (lake.table("dim_country"), "country_code_iso3"),
        "dim_date": (lake.table("dim_date"), "date_id"),
        "fact_results": (lake.fact(), "result_id"),
    })


@register("duplicate_keys")
def q_duplicate_keys(spark, sf_dir):
    return duplicate_key_values(lakehouse(spark, sf_dir).table("silver_candidates"), "result_id")


@register("duplicate_country_codes")
def q_duplicate_country_codes(spark, sf_dir):
    lk = lakehouse(spark, sf_dir).lookup().select(_ath.normalize_code("athlete_country_code").alias(
        "athlete_country_code"))
    return duplicate_key_values(lk, "athlete_country_code").withColumnRenamed("duplicate_count", "row_count")


@register("repeat_athletes")
def q_repeat_athletes(spark, sf_dir):
    return sorted_by(duplicate_key_values(lakehouse(spark, sf_dir).silver(), "athlete_id")
                     .withColumnRenamed("duplicate_count", "result_count"),
                     [("result_count", "desc"), "athlete_id"])


@register("numeric_summary")
def q_numeric_summary(spark, sf_dir):
    return _agg.numeric_summary(_raw(spark, sf_dir),
                                ["year_of_event", "event_number_of_finishers", "athlete_year_of_birth"],
                                exact=True)  # years and counts: bounded domains


@register("null_percentages")
def q_null_percentages(spark, sf_dir):
    r = _raw(spark, sf_dir)
    return _agg.null_percentages(r, r.columns)


@register("rejection_counts")
def q_rejection_counts(spark, sf_dir):
    """As observed by the pass that wrote silver."""
    return lakehouse(spark, sf_dir).table("silver_accounting")


@register("parse_failure_counts")
def q_parse_failure_counts(spark, sf_dir):
    return _dq.parse_failure_counts(_derived(spark, sf_dir))


# ------------------------------------------------------------ sort / top-k

@register("leaderboard_sorted")
def q_leaderboard_sorted(spark, sf_dir):
    return sorted_by(vw_global_leaderboard(spark, sf_dir), [("race_result_records", "desc"), "country_code"])


@register("seasonal_sorted")
def q_seasonal_sorted(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    trends = views.seasonal_race_trends(lake.fact(), lake.dims()["date"])
    return sorted_by(trends, ["race_year", "race_month"])


@register("top_speeds")
def q_top_speeds(spark, sf_dir):
    s = lakehouse(spark, sf_dir).silver().select(
        "result_id", "year_of_event", "event_name", "event_distance_length", "athlete_performance",
        "athlete_average_speed", "athlete_average_speed_kmh", "athlete_country", "country_name", "athlete_id")
    return top_k(s, [("athlete_average_speed_kmh", "desc"), "result_id"], 100)


SPEEDING_COLUMNS = ["year_of_event", "event_name", "event_distance_length", "athlete_performance",
                    "athlete_average_speed", "athlete_average_speed_kmh", "athlete_country", "athlete_id"]


@register("speed_over_limit_count")
def q_speed_over_limit_count(spark, sf_dir):
    """Rows faster than the limit: before the speed rule, and in silver (none by the rule)."""
    over = F.count_if(F.col("athlete_average_speed_kmh") > _speed.SPEED_MAX_KMH).alias("row_count")
    before = _derived(spark, sf_dir).agg(over).select(F.lit("before_rules").alias("stage"), "row_count")
    return before.unionByName(lakehouse(spark, sf_dir).silver().agg(over).select(
        F.lit("silver").alias("stage"), "row_count"))


@register("speed_over_limit_top")
def q_speed_over_limit_top(spark, sf_dir):
    """The 100 fastest rows above the limit, before the speed rule."""
    rows = _derived(spark, sf_dir).filter(F.col("athlete_average_speed_kmh") > _speed.SPEED_MAX_KMH)
    order = [("athlete_average_speed_kmh", "desc")] + [
        (c, "asc_nulls_last") for c in SPEEDING_COLUMNS if c != "athlete_average_speed_kmh"]
    return top_k(rows.select(*SPEEDING_COLUMNS), order, 100)


@register("event_unit_distribution")
def q_event_unit_distribution(spark, sf_dir):
    return _prof.event_unit_distribution(_raw(spark, sf_dir))


@register("predicate_share")
def q_predicate_share(spark, sf_dir):
    return _agg.predicate_share(_raw(spark, sf_dir), F.col("event_distance_length").contains("Etappen"), "multistage")


@register("performance_suffix_counts")
def q_performance_suffix_counts(spark, sf_dir):
    return _prof.performance_suffix_counts(_raw(spark, sf_dir))


@register("missing_text_none")
def q_missing_text_none(spark, sf_dir):
    """Rows whose distance is missing: NULL, or the text ``None``."""
    columns = ["year_of_event", "event_dates", "event_name", "event_distance_length", "athlete_club", "athlete_id"]
    return _flt.missing_rows(_raw(spark, sf_dir), "event_distance_length").select(*columns)


@register("view_refresh")
def q_view_refresh(spark, sf_dir):
    """A stored view before and after new source files: built on the first delivery, refreshed after the second."""
    schema, root, landings = _raw_landing(spark, sf_dir, "view_refresh", _two_drops)
    lookup = lakehouse(spark, sf_dir).lookup()
    reader = spark.read.format("csv").options(**_files.CSV_OPTIONS).option("recursiveFileLookup", "true").schema(schema)
    lake = Lakehouse(spark, f"{root}/landing", root=f"{root}/tables", sources={
        "bronze_results": lambda: reader.load(f"{root}/landing"), "bronze_country_codes": lambda: lookup})
    for land in landings:
        land()
        lake.discard()  # the lake is this call's own, and nothing reads the board of the first delivery
        board = lake.view("vw_global_leaderboard",
                          lambda lk: views.global_leaderboard(lk.fact(), lk.dims()["country"]))
    return board


@register("dim_preview")
def q_dim_preview(spark, sf_dir):
    return top_k(lakehouse(spark, sf_dir).table("dim_date"), ["event_start_date"], 100)


# ------------------------------------------------------------ sources, sinks, streams


def _scratch(spark, sf_dir, name: str) -> str:
    """A fresh folder under the lake root (shared storage), one per call."""
    return f"{lakehouse(spark, sf_dir).root}/io/{name}-{uuid.uuid4().hex[:8]}"


def _land_csv(df, path: str) -> None:
    with settings(df.sparkSession, _files.BRONZE_READING):
        (df.write.mode("overwrite").options(**_files.CSV_OPTIONS).options(**_files.TIMESTAMP_OPTIONS)
         .options(**_files.LANDING_OPTIONS).csv(path))


_LANDED: dict[str, str] = {}


def _raw_csv(spark, sf_dir) -> str:
    """The bronze race results landed as CSV files (header = raw column names), once per lake."""
    lake = lakehouse(spark, sf_dir)
    if lake.root not in _LANDED:
        path = f"{lake.root}/io/raw_csv"
        _files.write_csv(lake.raw(), path)
        _LANDED[lake.root] = path
    return _LANDED[lake.root]


@register("csv_fixed_schema_scan")
def q_csv_fixed_schema_scan(spark, sf_dir):
    """The landed files under the fixed schema that batch and stream share."""
    return _files.read_csv(spark, _raw_csv(spark, sf_dir), _files.RESULTS_SCHEMA)


@register("csv_batch_scan")
def q_csv_batch_scan(spark, sf_dir):
    """Header + type inference over every landed file."""
    return _files.read_csv(spark, _raw_csv(spark, sf_dir), infer=True)


@register("csv_infer_schema")
def q_csv_infer_schema(spark, sf_dir):
    """Schema inferred from one sample file of the landing folder."""
    folder = _raw_csv(spark, sf_dir)
    sample = sorted(f for f in spark.read.text(folder).inputFiles() if f.endswith(".csv"))[0]
    return _files.schema_rows(spark, _files.infer_csv_schema(spark, sample))


@register("table_full_refresh")
def q_table_full_refresh(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    path = _scratch(spark, sf_dir, "dim_country_refresh")
    _files.write_table(lake.table("dim_country"), path)       # first build
    return _files.write_table(lake.table("dim_country"), path)  # full refresh replaces it


def _two_drops(df):
    """Split a table into two deliveries that together hold every row once (by a hash of the row)."""
    half = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(2))
    return [df.filter(half == 0), df.filter(half == 1)]


@register("stream_csv_ingest")
def q_stream_csv_ingest(spark, sf_dir):
    events = _tpch(spark, sf_dir, "events")
    root = _scratch(spark, sf_dir, "events_stream")
    _land_csv(events, f"{root}/landing/drop1")
    return _stream.ingest_stream(spark, f"{root}/landing", events.schema, f"{root}/bronze", f"{root}/_ckpt")


@register("stream_incremental_append")
def q_stream_incremental_append(spark, sf_dir):
    """Two runs over a landing folder; the second run appends only the new drop."""
    events = _tpch(spark, sf_dir, "events")
    root = _scratch(spark, sf_dir, "events_incremental")
    for i, drop in enumerate(_two_drops(events), start=1):
        _land_csv(drop, f"{root}/landing/drop{i}")
        _stream.ingest_stream(spark, f"{root}/landing", events.schema, f"{root}/bronze", f"{root}/_ckpt")
    return spark.read.parquet(f"{root}/bronze")


def _raw_landing(spark, sf_dir, name, drops):
    lake = lakehouse(spark, sf_dir)
    raw = lake.raw()
    root = _scratch(spark, sf_dir, name)
    return _files.RESULTS_SCHEMA, root, [(lambda d=d, i=i: _land_csv(d, f"{root}/landing/drop{i}"))
                              for i, d in enumerate(drops(raw), start=1)]


@register("stream_silver_obt")
def q_stream_silver_obt(spark, sf_dir):
    """Medallion streams, run twice as two CSV drops land: results landing CSV ->
    bronze parquet (file source); the country lookup CSV -> its bronze table the
    same way; bronze results read as a stream -> silver (stateful dedup across
    runs, stream-static join to the lookup's snapshot)."""
    schema, root, landings = _raw_landing(spark, sf_dir, "silver_stream", _two_drops)
    lookup_raw = lakehouse(spark, sf_dir).lookup()
    _land_csv(lookup_raw, f"{root}/landing_countries/drop1")
    lookup = _stream.ingest_stream(spark, f"{root}/landing_countries", _files.COUNTRIES_SCHEMA,
                                   f"{root}/bronze_countries", f"{root}/_ckpt_countries")
    for land in landings:
        land()
        _stream.ingest_stream(spark, f"{root}/landing", schema, f"{root}/bronze", f"{root}/_ckpt_bronze")
        bronze = _stream.read_table_stream(spark, f"{root}/bronze", schema)
        _stream.write_append(_stream.silver_stream(bronze, lookup), f"{root}/silver", f"{root}/_ckpt_silver")
        del bronze
        release(spark)
    return spark.read.parquet(f"{root}/silver")


@register("stream_static_enrich")
def q_stream_static_enrich(spark, sf_dir):
    schema, root, landings = _raw_landing(spark, sf_dir, "enrich_stream", lambda raw: [raw])
    lookup = lakehouse(spark, sf_dir).lookup()
    for land in landings:
        land()
    stream = _silver.enrich_country(_silver.valid_rows(_stream.read_csv_stream(spark, f"{root}/landing", schema)), lookup)
    _stream.write_append(stream.select("athlete_id", "athlete_country", "country_code_iso3", "country_name"),
                         f"{root}/out", f"{root}/_ckpt")
    return spark.read.parquet(f"{root}/out")


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """The whole raw table delivered twice; the keys of earlier batches drop the re-delivered rows."""
    schema, root, landings = _raw_landing(spark, sf_dir, "dedup_stream", lambda raw: [raw, raw])
    for land in landings:
        land()
        stream = snake_case_columns(_stream.read_csv_stream(spark, f"{root}/landing", schema))
        out = _medallion.dedup_stream_exact(stream, f"{root}/out", f"{root}/_ckpt")
    return out.select(*stream.columns)


# ------------------------------------------------------------ incremental lake

_INCREMENTAL: dict[str, _medallion.Medallion] = {}


def _incremental(spark, sf_dir) -> _medallion.Medallion:
    """The raw table in two deliveries, each taken through all layers by a run of its own; once per lake."""
    lake = lakehouse(spark, sf_dir)
    if lake.root not in _INCREMENTAL:
        schema, root, landings = _raw_landing(spark, sf_dir, "medallion", _two_drops)
        medallion = _medallion.Medallion(spark, f"{root}/lake", lake.lookup(), schema)
        for land in landings:
            land()
            medallion.run(f"{root}/landing")
        _INCREMENTAL[lake.root] = medallion
    return _INCREMENTAL[lake.root]


@register("incremental_silver_obt")
def q_incremental_silver_obt(spark, sf_dir):
    """Silver after two deliveries: exact deduplication over both."""
    return _incremental(spark, sf_dir).silver()


@register("incremental_fact_results")
def q_incremental_fact_results(spark, sf_dir):
    """The fact parts of both deliveries."""
    return _incremental(spark, sf_dir).fact()


@register("stream_rejection_counts")
def q_stream_rejection_counts(spark, sf_dir):
    """The losses of each micro-batch, observed and stored with it, added up."""
    return _incremental(spark, sf_dir).accounting()


@register("incremental_global_leaderboard")
def q_incremental_global_leaderboard(spark, sf_dir):
    return _incremental(spark, sf_dir).gold.global_leaderboard()


@register("incremental_seasonal_race_trends")
def q_incremental_seasonal_race_trends(spark, sf_dir):
    return _incremental(spark, sf_dir).gold.seasonal_race_trends()


@register("incremental_country_seasonal_trends")
def q_incremental_country_seasonal_trends(spark, sf_dir):
    return _incremental(spark, sf_dir).gold.country_seasonal_trends()


@register("incremental_runner_demographics")
def q_incremental_runner_demographics(spark, sf_dir):
    return _incremental(spark, sf_dir).gold.runner_demographics()


@register("incremental_demographics_full")
def q_incremental_demographics_full(spark, sf_dir):
    return _incremental(spark, sf_dir).gold.demographics_full()


@register("compacted_country_seasonal_trends")
def q_compacted_country_seasonal_trends(spark, sf_dir):
    """The state of both deliveries merged into one, then the view."""
    return _incremental(spark, sf_dir).gold.compact(f"merged{uuid.uuid4().hex[:8]}").country_seasonal_trends()


@register("bitmap_distinct_counts")
def q_bitmap_distinct_counts(spark, sf_dir):
    """Exact distinct athletes and events per country through bitmaps; events numbered densely."""
    lake = lakehouse(spark, sf_dir)
    numbers = _bitmaps.dense_numbers(lake.table("dim_event").select("event_id"), "event_no")
    fact = lake.fact().select("country_code_iso3", "athlete_id", "event_id").join(numbers, "event_id")
    key = ["country_code_iso3"]
    return (_bitmaps.distinct_count(fact, key, "athlete_id", "distinct_athletes")
            .join(_bitmaps.distinct_count(fact, key, "event_no", "distinct_events"), key))
