"""Silver one-big-table: parse, validate, enrich, deduplicate, key.

``silver_columns`` derives every typed column from the raw text without
dropping anything; ``_rules()`` gives the row rules in the reference order
(``SILVER_RULE_NAMES``), ``FILTER_ORDER`` the cheap-first order used for
filtering.  The candidates are the rows passing all rules, inner-joined to the
country lookup and keyed; the silver table is the deduplicated candidates.

``counted_rows`` does all of it in one pass: it parses once and step by step, each rejected
row only as far as its first broken rule's step, observes how many rows each rule rejects
(first rule broken wins) while the rows flow by, aggregates equal
rows to one with their number (``copies``) and hashes the keys of what is left.  The
silver table is that table without ``copies``, the candidates are its rows repeated
``copies`` times, and the accounting needs no scan of its own.

The chain is stateless up to the deduplication, so the same functions serve a
static DataFrame and a streaming one (``racelake.streaming``).
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from racelake.functions import athlete, dates, distance, keys, performance, speed
from racelake.functions.columns import snake_case_columns
from racelake.operators.filters import consistent
from racelake.operators.joins import enrich

# The columns a result is deduplicated on.
DEDUP_COLUMNS = [
    "year_of_event",
    "event_date_raw",
    "event_name",
    "event_distance_length",
    "event_number_of_finishers",
    "athlete_performance",
    "athlete_club",
    "athlete_country",
    "athlete_year_of_birth",
    "athlete_gender",
    "athlete_age_category",
    "athlete_average_speed",
    "athlete_id",
    "country_code_iso3",
    "country_name",
]

# Fixed values: (event unit(s), allowed performance types) pairs.
UNIT_PERFORMANCE_PAIRS = [
    (["km", "mi"], performance.TIME_TYPES),
    (["h"], performance.DISTANCE_TYPES),
]

SILVER_COLUMNS = [
    "year_of_event", "event_dates", "event_name", "event_distance_length",
    "event_number_of_finishers", "athlete_performance", "athlete_club", "athlete_country",
    "athlete_year_of_birth", "athlete_gender", "athlete_age_category", "athlete_average_speed",
    "athlete_id", "event_date_raw", "event_date_format_type", "event_start_date", "event_end_date",
    "event_distance_type", "event_distance_value", "event_distance_unit", "athlete_performance_type",
    "athlete_performance_seconds", "athlete_performance_distance", "athlete_performance_unit",
    "athlete_age_at_event", "athlete_average_speed_kmh", "country_code_iso3", "country_name",
    "event_id", "result_id",
]

DISTANCE_CLASS = "_distance_class"


def silver_columns(raw: DataFrame) -> DataFrame:
    """All derived silver columns over raw rows (raw CSV names or snake_case)."""
    df = snake_case_columns(raw)
    c = F.col
    df = df.withColumns({
        "year_of_event": c("year_of_event").try_cast("int"),
        "event_name": F.trim(c("event_name")),
        "event_date_raw": c("event_dates"),
        "event_date_format_type": dates.classify_date_format("event_dates"),
        DISTANCE_CLASS: distance.classify_event_distance("event_distance_length"),
        "athlete_performance_type": performance.classify_performance("athlete_performance"),
        "athlete_club": athlete.clean_club("athlete_club"),
        "athlete_country": athlete.normalize_code("athlete_country"),
        "athlete_year_of_birth": athlete.clean_birth_year("athlete_year_of_birth"),
        "athlete_age_category": athlete.clean_category("athlete_age_category"),
        "athlete_gender": athlete.normalize_code("athlete_gender"),
        "athlete_id": c("athlete_id").try_cast("int"),
    })
    start, end = dates.event_date_bounds("event_dates")
    df = df.withColumns({
        "event_start_date": start,
        "event_end_date": end,
        "event_distance_length": distance.standardize_distance("event_distance_length"),
        "event_distance_type": distance.standardize_distance_type(DISTANCE_CLASS),
        "athlete_performance_seconds": performance.duration_seconds("athlete_performance"),
        "athlete_performance_distance": performance.performance_distance("athlete_performance"),
        "athlete_performance_unit": performance.performance_unit("athlete_performance_type"),
        "athlete_age_at_event": athlete.age_at_event("year_of_event", "athlete_year_of_birth"),
    })
    df = df.withColumns({
        "event_distance_value": distance.distance_value("event_distance_length"),
        "event_distance_unit": distance.distance_unit("event_distance_length"),
    })
    return df.withColumn("athlete_average_speed_kmh", speed.average_speed_kmh(
        "event_distance_value", "event_distance_unit", "athlete_performance_seconds",
        "athlete_performance_distance", "athlete_performance_unit"))


def _rules() -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("unparseable_event_dates", c("event_start_date").isNotNull() & c("event_end_date").isNotNull()),
        ("invalid_event_distance", c(DISTANCE_CLASS).isin(*distance.KEPT_DISTANCE_CLASSES)),
        ("no_finishers", F.coalesce(c("event_number_of_finishers").try_cast("int") > 0, F.lit(False))),
        ("unknown_performance", ~c("athlete_performance_type").isin("null", "unknown")),
        ("performance_unit_mismatch",
         consistent("event_distance_unit", "athlete_performance_type", UNIT_PERFORMANCE_PAIRS)),
        ("missing_country", c("athlete_country").isNotNull()),
        ("missing_birth_year_or_age",
         c("athlete_year_of_birth").isNotNull() & c("athlete_age_at_event").isNotNull()),
        ("missing_gender", c("athlete_gender").isNotNull()),
        ("implausible_speed", c("athlete_average_speed_kmh").isNotNull()
         & (c("athlete_average_speed_kmh") > 0) & (c("athlete_average_speed_kmh") <= speed.SPEED_MAX_KMH)),
    ]


# Rule names in the order the rules apply.
SILVER_RULE_NAMES = [
    "unparseable_event_dates", "invalid_event_distance", "no_finishers", "unknown_performance",
    "performance_unit_mismatch", "missing_country", "missing_birth_year_or_age", "missing_gender",
    "implausible_speed",
]


# Evaluation order of the conjunction: cheap integer/null tests first, regex
# classifications next, date parsing and speed last.  ``AND`` short-circuits in
# generated code, so rows failing a cheap rule never reach the parsers.  (The
# rejection accounting keeps the reference order instead.)
FILTER_ORDER = [
    "no_finishers", "missing_country", "missing_gender", "missing_birth_year_or_age",
    "invalid_event_distance", "unknown_performance", "performance_unit_mismatch",
    "unparseable_event_dates", "implausible_speed",
]


def passes_silver_rules() -> Column:
    rules = dict(_rules())
    return reduce(lambda a, b: a & b, [rules[name] for name in FILTER_ORDER])


def clean_country_lookup(lookup: DataFrame) -> DataFrame:
    c = F.col
    return (lookup.select(
        athlete.normalize_code("athlete_country_code").alias("athlete_country_code"),
        athlete.normalize_code("country_code_iso3").alias("country_code_iso3"),
        F.trim(c("country_name")).alias("country_name"))
        .filter(c("athlete_country_code").isNotNull() & c("country_code_iso3").isNotNull()
                & c("country_name").isNotNull()))


def valid_rows(raw: DataFrame) -> DataFrame:
    """Rows passing every silver rule, before enrichment (helper columns dropped)."""
    return silver_columns(raw).filter(passes_silver_rules()).drop(DISTANCE_CLASS)


def enrich_country(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Inner join to the cleaned country lookup; rows without a match are dropped."""
    return enrich(df, clean_country_lookup(lookup), "athlete_country", "athlete_country_code")


def add_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"event_id": keys.event_id(), "result_id": keys.result_id()})


COPIES = "copies"
#: Rows that one step of ``repeat_copies`` makes of an array: bounds the memory of a hot row.
COPY_STEP = 1 << 16


def reject_reason() -> Column:
    """The first rule, in the rules' order, that a row of ``silver_columns`` breaks; NULL if none."""
    reason = None
    for name, rule in _rules():
        broken = ~F.coalesce(rule, F.lit(False))
        reason = F.when(broken, name) if reason is None else reason.when(broken, name)
    return reason


def counts_table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """(stage, row_count) rows of the counts, in one partition."""
    if not counts:
        return spark.createDataFrame([], "stage string, row_count long")
    pairs = [F.lit(x) for stage, n in sorted(counts.items()) for x in (stage, n)]
    return (spark.range(0, 1, 1, 1).select(F.explode(F.create_map(*pairs)).alias("stage", "row_count"))
            .select("stage", F.col("row_count").cast("long").alias("row_count")))


def _observed(observation: Observation | _Steps) -> dict[str, int]:
    """The metrics; none if the observed rows were found empty while the query ran and left its plan."""
    try:
        return observation.get
    except Py4JJavaError:  # a row without columns
        return {}


class _Steps:
    """The observations of the steps of one pass, read as one."""

    def __init__(self) -> None:
        self.taken: list[Observation] = []

    @property
    def get(self) -> dict[str, int]:
        return {name: n for step in self.taken for name, n in _observed(step).items()}


class Accounting:
    """What became of the raw rows of one silver pass, observed while it is written.

    Spark counts an observed row again where a lost executor makes it repeat a finished task, and
    forgets the metrics of a part that it finds empty at run time, so ``counts`` compares the sums
    with the number of raw rows and counts anew if they differ.
    """

    def __init__(self) -> None:
        self._rules = _Steps()
        self._matches = Observation()

    def passing(self, df: DataFrame, names: list[str]) -> DataFrame:
        """Rows that break none of the named rules; those that do are observed under the first one they break."""
        rules, reason = dict(_rules()), None
        for name in names:
            broken = ~F.coalesce(rules[name], F.lit(False))
            reason = F.when(broken, name) if reason is None else reason.when(broken, name)
        step = Observation()
        self._rules.taken.append(step)
        tagged = df.withColumn("_reason", reason).observe(
            step, *[F.count_if(F.col("_reason") == name).alias(name) for name in names])
        return tagged.filter(F.col("_reason").isNull()).drop("_reason")

    def observe_matches(self, df: DataFrame) -> DataFrame:
        return df.observe(self._matches, F.count(F.lit(1)).alias("passed"),
                          F.count_if(F.col("country_code_iso3").isNull()).alias("no_country_match"))

    def counts(self, raw: DataFrame, lookup: DataFrame, kept: int) -> dict[str, int]:
        """Rows by stage once the pass is written with ``kept`` rows; stages without rows are left out.

        ``raw`` is only counted (for stored tables: from the files' footers)."""
        total, rules, matches = raw.count(), _observed(self._rules), _observed(self._matches)
        found = {name: rules.get(name, 0) for name in SILVER_RULE_NAMES}
        if sum(found.values()) + matches.get("passed", 0) == total:
            found["no_country_match"] = matches.get("no_country_match", 0)
        else:
            found = {r["stage"]: r["row_count"] for r in _rejected(raw, lookup).collect()}  # a row per rule
        found |= {"duplicate": total - sum(found.values()) - kept, "kept": kept}
        return {stage: n for stage, n in found.items() if n}


def _checked(raw: DataFrame, accounting: Accounting) -> DataFrame:
    """The rows of ``silver_columns`` that pass every rule, rejections observed.

    The rules apply in their order in three steps; what a later step needs is parsed only for the rows that
    the earlier ones let through, by the layout that the earlier ones found."""
    df, c = snake_case_columns(raw), F.col
    df = df.withColumns({
        "event_date_raw": c("event_dates"),
        "event_date_format_type": dates.classify_date_format("event_dates"),
        "event_distance_length": distance.normalized_distance("event_distance_length"),
    })
    start, end = dates.event_date_bounds("event_dates", layout="event_date_format_type")
    df = df.withColumns({"event_start_date": start, "event_end_date": end,
                         DISTANCE_CLASS: distance.classify_event_distance("event_distance_length")})
    df = accounting.passing(df, SILVER_RULE_NAMES[:3])

    df = df.withColumns({
        "year_of_event": c("year_of_event").try_cast("int"),
        "athlete_performance_type": performance.classify_performance("athlete_performance"),
        "athlete_country": athlete.normalize_code("athlete_country"),
        "athlete_year_of_birth": athlete.clean_birth_year("athlete_year_of_birth"),
        "athlete_gender": athlete.normalize_code("athlete_gender"),
        "event_distance_length": distance.standardize_distance("event_distance_length"),
        "event_distance_type": distance.standardize_distance_type(DISTANCE_CLASS),
    })
    df = df.withColumns({
        "event_distance_unit": distance.unit_of_type("event_distance_type"),
        "athlete_age_at_event": athlete.age_at_event("year_of_event", "athlete_year_of_birth"),
    })
    df = accounting.passing(df, SILVER_RULE_NAMES[3:8])

    kind = "athlete_performance_type"
    df = df.withColumns({
        "event_distance_value": distance.distance_value("event_distance_length"),
        "athlete_performance_seconds": performance.duration_seconds("athlete_performance", kind),
        "athlete_performance_distance": performance.performance_distance("athlete_performance", kind),
        "athlete_performance_unit": performance.performance_unit(kind),
    })
    df = df.withColumn("athlete_average_speed_kmh", speed.average_speed_kmh(
        "event_distance_value", "event_distance_unit", "athlete_performance_seconds",
        "athlete_performance_distance", "athlete_performance_unit"))
    df = accounting.passing(df, SILVER_RULE_NAMES[8:])

    return df.withColumns({
        "event_name": F.trim(c("event_name")),
        "athlete_club": athlete.clean_club("athlete_club"),
        "athlete_age_category": athlete.clean_category("athlete_age_category"),
        "athlete_id": c("athlete_id").try_cast("int"),
    })


def valid_enriched(raw: DataFrame, lookup: DataFrame, accounting: Accounting) -> DataFrame:
    """Rows passing every rule, with their country, before deduplication and keys; rejections are observed."""
    kept = _checked(raw, accounting).drop(DISTANCE_CLASS)
    matched = accounting.observe_matches(enrich(kept, clean_country_lookup(lookup), "athlete_country",
                                                "athlete_country_code", how="left"))
    base = [c for c in SILVER_COLUMNS if c not in ("event_id", "result_id")]
    return matched.filter(F.col("country_code_iso3").isNotNull()).select(*base)


def counted_rows(raw: DataFrame, lookup: DataFrame, accounting: Accounting) -> DataFrame:
    """Silver rows and how often each occurs (31 columns), from one parse and one hash of the keys.

    Every silver column is a function of ``DEDUP_COLUMNS`` (the derived ones are parsed from
    them, the keys hash them), so rows that repeat those 15 columns are fully identical: a hash
    aggregate over all of them with partial counts in each task, keys added to what is left.
    """
    rows = valid_enriched(raw, lookup, accounting)
    return add_keys(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(COPIES))).select(*SILVER_COLUMNS, COPIES)


def repeat_copies(counted: DataFrame) -> DataFrame:
    """Every row as often as it occurred: the candidates before deduplication (30 columns)."""
    last = F.col(COPIES) - 1
    steps = counted.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(COPY_STEP).cast("long"))))
    each = F.sequence(F.col("_step"), F.least(F.col("_step") + (COPY_STEP - 1), last))
    return steps.withColumn("_copy", F.explode(each)).select(*SILVER_COLUMNS)


def build_candidates(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    """Valid, enriched and keyed rows before deduplication (30 columns)."""
    rows = enrich_country(valid_rows(raw), lookup)
    base = [c for c in SILVER_COLUMNS if c not in ("event_id", "result_id")]
    return add_keys(rows.select(*base)).select(*SILVER_COLUMNS)


def dedup_candidates(candidates: DataFrame) -> DataFrame:
    """Batch deduplication of the candidates.

    Every silver column is a function of ``DEDUP_COLUMNS`` (the derived ones
    are parsed from them, the keys hash them), so dropping rows that repeat
    those 15 columns equals dropping fully identical rows: ``distinct()`` is a
    hash aggregate with map-side partial dedup (``dropDuplicates`` on a column
    subset plans as a sort aggregate of ``first()`` values).  The two 64-char
    hash keys are dropped before the shuffle and recomputed on the surviving
    rows, which keeps 128 bytes per row out of the exchange.
    """
    return add_keys(candidates.drop("event_id", "result_id").distinct()).select(*SILVER_COLUMNS)


def build_silver(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    """Batch silver OBT (30 columns)."""
    return dedup_candidates(build_candidates(raw, lookup))


def _rejected(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    """(stage, row_count) of the rejected rows, from one scan and one left join to the lookup."""
    derived = silver_columns(raw)
    keys = clean_country_lookup(lookup).select("athlete_country_code", "country_code_iso3")
    tagged = (enrich(derived.select("athlete_country", reject_reason().alias("_reason")), keys,
                     "athlete_country", "athlete_country_code", how="left")
              .select(F.coalesce(F.col("_reason"), F.when(F.col("country_code_iso3").isNull(),
                                                          F.lit("no_country_match"))).alias("stage")))
    return (tagged.filter(F.col("stage").isNotNull()).groupBy("stage")
            .agg(F.count(F.lit(1)).alias("row_count")))


def rejection_counts(raw: DataFrame, lookup: DataFrame, candidates: DataFrame | None = None,
                     silver: DataFrame | None = None) -> DataFrame:
    """(stage, row_count): every raw row lands in exactly one bucket.

    Buckets: the first silver rule a row breaks (reference order), then
    ``no_country_match`` for valid rows without a lookup match, ``duplicate``
    for repeated rows, and ``kept``.  The lake stores the same counts as observed by
    the pass that wrote silver (``Accounting``); this is the form without a stored
    lake.  Kept and duplicate rows are the row counts of the candidates and silver
    tables when given (otherwise they are derived here).
    """
    rejected = _rejected(raw, lookup)
    if candidates is None:
        candidates = build_candidates(raw, lookup)
    if silver is None:
        silver = dedup_candidates(candidates)
    totals = (candidates.agg(F.count(F.lit(1)).alias("valid"), F.lit(0).cast("long").alias("kept"))
              .unionByName(silver.agg(F.lit(0).cast("long").alias("valid"), F.count(F.lit(1)).alias("kept")))
              .agg(F.sum("valid").alias("valid"), F.sum("kept").alias("kept")))
    outcome = totals.selectExpr("stack(2, 'kept', kept, 'duplicate', valid - kept) as (stage, row_count)")
    return (rejected.unionByName(outcome).filter(F.col("row_count") > 0)
            .withColumn("row_count", F.col("row_count").cast("long")))
