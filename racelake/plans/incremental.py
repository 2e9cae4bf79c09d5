"""Gold views kept up to date delivery by delivery.

The stored state of the activity views is what can be added up: for each delivery, country and
month the number of results and the exact sums behind the averages, and the athletes and events
as bitmaps (``operators.bitmaps``).  A delivery reads its own silver rows, writes its own part of the
state and changes no other; a view adds the parts up and joins the dimensions as they are now.
The demographic views group by an attribute that a later result may change (an athlete's latest
category), so their state is kept per athlete and meets the athlete dimension when it is read.

Every part lies in a folder of its delivery and is written whole, so a delivery that is repeated
replaces its own part and adds nothing.  ``compact`` merges the parts of closed deliveries into one.
Nothing of this needs the fact table again: a full rebuild is the same state from one delivery.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.functions.athlete import age_group_label, gender_label
from racelake.functions.dates import month_name
from racelake.operators import bitmaps
from racelake.operators.aggregates import scaled, with_share
from racelake.operators.filters import keep_known
from racelake.operators.joins import missing_keys
from racelake.plans import star
from racelake.session import release
from racelake.sources.files import TABLE_OPTIONS

SUMS = ["entries", "speed_sum", "speed_count", "age_sum", "age_count"]
SPEED_DECIMALS = 3


def _partials(speed: str = "athlete_average_speed_kmh", age: str = "athlete_age_at_event") -> list[Column]:
    return [F.count(F.lit(1)).alias("entries"),
            F.sum(scaled(speed, SPEED_DECIMALS)).alias("speed_sum"), F.count(speed).alias("speed_count"),
            F.sum(F.col(age).cast("long")).alias("age_sum"), F.count(age).alias("age_count")]


def _added() -> list[Column]:
    return [F.sum(c).alias(c) for c in SUMS]


def _averages() -> list[Column]:
    unit = 10 ** SPEED_DECIMALS
    speed = F.col("speed_sum").cast("double") / F.col("speed_count").cast("double") / unit
    age = F.col("age_sum").cast("double") / F.col("age_count").cast("double")
    return [F.round(speed, SPEED_DECIMALS).alias("average_speed_kmh"), F.round(age, 1).alias("average_athlete_age")]


class GoldStates:
    """The stored, mergeable state of the analytical views under ``root`` (a shared folder)."""

    PARTS = {
        "event_numbers": "event_id string, event_no long",
        "activity": "country_code_iso3 string, year int, month int, entries long, speed_sum long, speed_count long, "
                    "age_sum long, age_count long",
        "activity_athletes": "country_code_iso3 string, year int, month int, bucket long, bits binary",
        "activity_events": "country_code_iso3 string, year int, month int, bucket long, bits binary",
        "athletes": "athlete_id int, entries long, speed_sum long, speed_count long, age_sum long, age_count long",
        "athlete_events": "athlete_id int, event_no long",
        "dim_athlete": "athlete_id int, athlete_gender string, athlete_year_of_birth int, athlete_age_category string, "
                       "athlete_club string, event_start_date date, result_id string",
        "dim_country": "country_code_iso3 string, athlete_country string, country_name string",
        "dim_event": "event_id string, event_name string, event_distance_length string, event_distance_type string, "
                     "event_distance_value double, event_distance_unit string",
        "dim_date": "date_id int, event_start_date date, year int, month int, month_name string, day int",
    }
    KEYS = {"activity": ["country_code_iso3", "year", "month"],
            "activity_athletes": ["country_code_iso3", "year", "month"],
            "activity_events": ["country_code_iso3", "year", "month"]}

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------ parts

    def _folder(self, part: str) -> str:
        return f"{self.root}/{part}"

    def part(self, name: str) -> DataFrame:
        """All deliveries' rows of one part, with their ``delivery``."""
        return self.spark.read.schema(f"{self.PARTS[name]}, delivery string").parquet(self._folder(name))

    def _put(self, name: str, df: DataFrame, delivery: str) -> DataFrame:
        path = f"{self._folder(name)}/delivery={delivery}"
        columns = [c.split(" ")[0] for c in self.PARTS[name].split(", ")]
        df.select(*columns).write.mode("overwrite").options(**TABLE_OPTIONS).parquet(path)
        release(self.spark)
        return self.spark.read.schema(self.PARTS[name]).parquet(path)

    def _stored(self, df: DataFrame, name: str, delivery: str) -> DataFrame:
        """Rows that several parts of a delivery are made of, written once."""
        path = f"{self.root}/{name}/delivery={delivery}"
        df.write.mode("overwrite").options(**TABLE_OPTIONS).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # ------------------------------------------------------------ one delivery

    def add(self, silver: DataFrame, delivery: str) -> None:
        """Add the silver rows of one delivery (rows that no other delivery holds).

        ``delivery`` names a folder; adding the same delivery again replaces its part."""
        numbers = self._number_events(silver, delivery)
        rows = (silver.select("country_code_iso3", "athlete_id", "event_id", F.year("event_start_date").alias("year"),
                              F.month("event_start_date").alias("month"), "athlete_average_speed_kmh",
                              "athlete_age_at_event")
                .join(numbers, "event_id").drop("event_id"))
        rows = self._stored(rows, "_rows", delivery)  # the hash and the join are made once for the five states below
        key = self.KEYS["activity"]
        self._put("activity", rows.groupBy(*key).agg(*_partials()), delivery)
        self._put("activity_athletes", bitmaps.bitmap_rows(rows, key, "athlete_id", fine=True), delivery)
        self._put("activity_events", bitmaps.bitmap_rows(rows, key, "event_no", fine=True), delivery)
        self._put("athletes", rows.groupBy("athlete_id").agg(*_partials()), delivery)
        self._put("athlete_events", rows.select("athlete_id", "event_no").distinct(), delivery)
        self._put("dim_athlete", star.latest_athletes(silver), delivery)
        self._put("dim_country", star.dim_country(silver), delivery)
        self._put("dim_event", star.dim_event(silver), delivery)
        self._put("dim_date", star.dim_date(silver), delivery)

    def _number_events(self, silver: DataFrame, delivery: str) -> DataFrame:
        """Dense numbers of the events: those of other deliveries stay, new ones follow the largest."""
        none = self.spark.createDataFrame([], self.PARTS["event_numbers"])
        none.write.mode("ignore").parquet(f"{self._folder('event_numbers')}/delivery=none")  # the table exists
        known = self.part("event_numbers").filter(F.col("delivery") != delivery)
        last = known.agg(F.max("event_no")).first()[0]
        fresh = missing_keys(silver.select("event_id").distinct(), known, "event_id")
        fresh = self._stored(fresh, "_new_events", delivery)  # numbered by place: must not change between reads
        self._put("event_numbers", bitmaps.dense_numbers(fresh, "event_no", 0 if last is None else last + 1), delivery)
        return self.part("event_numbers").select("event_id", "event_no")

    def deliveries(self) -> list[str]:
        return sorted(r[0] for r in self.part("activity").select("delivery").distinct().collect())  # folder names

    def compact(self, into: str = "compacted") -> GoldStates:
        """The merged state of all deliveries, as one delivery ``into`` under a root of its own.

        The views of the new state are those of the old one; add no delivery meanwhile."""
        target = GoldStates(self.spark, f"{self.root}-{into}")
        key = self.KEYS["activity"]
        merged = {
            "event_numbers": self.part("event_numbers"),
            "activity": self.part("activity").groupBy(*key).agg(*_added()),
            "activity_athletes": bitmaps.union_bitmaps(self.part("activity_athletes"), key),
            "activity_events": bitmaps.union_bitmaps(self.part("activity_events"), key),
            "athletes": self.part("athletes").groupBy("athlete_id").agg(*_added()),
            "athlete_events": self.part("athlete_events").select("athlete_id", "event_no").distinct(),
            "dim_athlete": self._latest_athletes(), "dim_country": self.dim_country(),
            "dim_event": self.dim_event(), "dim_date": self.dim_date(),
        }
        for name, df in merged.items():
            target._put(name, df, into)
        return target

    # ------------------------------------------------------------ dimensions

    def _latest_athletes(self) -> DataFrame:
        return star.pick_latest(self.part("dim_athlete").drop("delivery"))

    def dim_athlete(self) -> DataFrame:
        return self._latest_athletes().drop("event_start_date", "result_id")

    def dim_country(self) -> DataFrame:
        return star.dim_country(self.part("dim_country"))

    def dim_event(self) -> DataFrame:
        return self.part("dim_event").drop("delivery").distinct()

    def dim_date(self) -> DataFrame:
        return self.part("dim_date").drop("delivery").distinct()

    # ------------------------------------------------------------ views

    def _activity(self, keys: list[str], events: str) -> DataFrame:
        """(keys, sums, unique_athletes, events): one row per group of the activity state."""
        joined = lambda name: (self.part(name).join(self.dim_country().select("country_code_iso3", "country_name"),
                                                    "country_code_iso3")
                               if "country_name" in keys else self.part(name))
        sums = joined("activity").groupBy(*keys).agg(*_added())
        sets = [bitmaps.count_bits(bitmaps.union_bitmaps(joined(part), keys), keys, name)
                for part, name in (("activity_athletes", "unique_athletes"), ("activity_events", events))]
        return reduce(lambda a, b: a.join(b, keys, "left"), sets, sums).fillna(0, ["unique_athletes", events])

    def global_leaderboard(self) -> DataFrame:
        return (self._activity(["country_name", "country_code_iso3"], "events_participated")
                .select("country_name", F.col("country_code_iso3").alias("country_code"),
                        F.col("entries").alias("race_result_records"), "unique_athletes", "events_participated",
                        *_averages()))

    def seasonal_race_trends(self) -> DataFrame:
        return (self._activity(["year", "month"], "events_held")
                .select(F.col("year").alias("race_year"), month_name(F.col("month")).alias("race_month"),
                        F.col("entries").alias("athlete_entries"), "unique_athletes", "events_held", *_averages()))

    def country_seasonal_trends(self) -> DataFrame:
        return (self._activity(["year", "month", "country_name"], "events_held")
                .select(F.col("year").alias("race_year"), month_name(F.col("month")).alias("race_month"), "country_name",
                        F.col("entries").alias("athlete_entries"), "unique_athletes", "events_held", *_averages()))

    def _demographic_groups(self) -> DataFrame:
        label, sort = age_group_label("athlete_age_category")
        return keep_known(self.dim_athlete(), "athlete_age_category").select(
            "athlete_id", gender_label("athlete_gender").alias("gender"), label.alias("age_group"),
            sort.alias("age_group_sort"))

    def _demographics(self) -> DataFrame:
        per_athlete = self.part("athletes").groupBy("athlete_id").agg(*_added())
        return (per_athlete.join(self._demographic_groups(), "athlete_id")
                .groupBy("gender", "age_group", "age_group_sort")
                .agg(*_added(), F.count(F.lit(1)).alias("unique_athletes")))

    def runner_demographics(self) -> DataFrame:
        return self._demographics().select("gender", "age_group", F.col("entries").alias("athlete_entries"),
                                           "unique_athletes", *_averages())

    def demographics_full(self) -> DataFrame:
        keys = ["gender", "age_group", "age_group_sort"]
        groups = self._demographics()
        pairs = self.part("athlete_events").join(self._demographic_groups(), "athlete_id")
        events = bitmaps.distinct_count(pairs, keys, "event_no", "events_participated")
        total = groups.agg(F.sum("entries").alias("total_entries"))
        same = reduce(lambda a, b: a & b, [groups[k].eqNullSafe(events[k]) for k in keys])
        rows = groups.join(events, same, "left").select(*(groups[c] for c in groups.columns), "events_participated")
        return (with_share(rows, "entries", total.scalar(), "participation_share_percent")
                .withColumn("entries_per_athlete", F.round(F.col("entries") / F.col("unique_athletes"), 2))
                .orderBy("gender", "age_group_sort")
                .select("gender", "age_group", F.col("entries").alias("athlete_entries"), "unique_athletes",
                        "entries_per_athlete", "participation_share_percent", "events_participated", *_averages()))
