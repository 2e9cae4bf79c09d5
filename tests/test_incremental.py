"""The incremental lake: deliveries, replays, accounting, stored state."""

import uuid

from pyspark.sql import functions as F

from racelake.__main__ import update
from racelake.operators import bitmaps
from racelake.plans import silver as silver_plan
from racelake.plans.incremental import GoldStates
from racelake.plans.lakehouse import lakehouse
from racelake.queries import REGISTRY, _two_drops
from racelake.sources.files import RESULTS_SCHEMA, write_csv
from racelake.streaming.ingest import row_key
from racelake.streaming.medallion import DistinctSink, Medallion

VIEWS = {"global_leaderboard": "vw_global_leaderboard", "seasonal_race_trends": "vw_seasonal_race_trends",
         "country_seasonal_trends": "vw_country_seasonal_trends", "runner_demographics": "vw_runner_demographics",
         "demographics_full": "demographics_full"}


def _root(spark, sf_dir):
    return f"{lakehouse(spark, sf_dir).root}/test-{uuid.uuid4().hex[:8]}"


def _same(a, b):
    return sorted(map(repr, a.select(*sorted(a.columns)).collect())) == sorted(
        map(repr, b.select(*sorted(a.columns)).collect()))


def test_a_second_delivery_reads_only_its_own_files_and_equals_the_full_rebuild(spark, sf_dir):
    lake, root = lakehouse(spark, sf_dir), _root(spark, sf_dir)
    states = GoldStates(spark, f"{root}/gold")
    for k, part in enumerate(_two_drops(lake.silver())):
        path = f"{root}/silver/{k}"
        part.write.parquet(path)
        states.add(spark.read.parquet(path), str(k))
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(hadoop, True)  # no later delivery and no view may need these rows again
    assert states.deliveries() == ["0", "1"]
    merged = states.compact()
    for method, view in VIEWS.items():
        want = REGISTRY[view](spark, sf_dir)
        assert want.count() > 0
        assert _same(getattr(states, method)(), want), method
    assert _same(merged.country_seasonal_trends(), states.country_seasonal_trends())
    assert _same(merged.demographics_full(), states.demographics_full())
    assert _same(states.dim_athlete(), lake.table("dim_athlete"))
    assert _same(states.dim_country(), lake.table("dim_country"))


def test_a_repeated_delivery_replaces_its_part(spark, sf_dir):
    lake, root = lakehouse(spark, sf_dir), _root(spark, sf_dir)
    states = GoldStates(spark, root)
    first, second = _two_drops(lake.silver())
    for rows, delivery in ((first, "1"), (second, "2"), (first, "1"), (second, "2")):
        states.add(rows, delivery)
    assert _same(states.global_leaderboard(), REGISTRY["vw_global_leaderboard"](spark, sf_dir))
    numbers = [r[0] for r in states.part("event_numbers").select("event_no").collect()]
    assert len(numbers) == len(set(numbers)) == lake.table("dim_event").count()


def test_an_athlete_changes_group_with_a_later_result(spark, sf_dir):
    """A later delivery moves an athlete's earlier results to the group of the latest category."""
    silver = lakehouse(spark, sf_dir).silver()
    athlete = silver.filter("athlete_age_category rlike '^[MW][0-9]+$'").first()["athlete_id"]
    mine = silver.filter(F.col("athlete_id") == athlete).limit(3)
    later = mine.withColumns({"event_start_date": F.date_add("event_start_date", 9000), "athlete_age_category": F.lit("W90"),
                              "result_id": F.concat(F.lit("x"), "result_id")})
    states = GoldStates(spark, _root(spark, sf_dir))
    states.add(mine, "a")
    before = states.runner_demographics().collect()
    states.add(later, "b")
    after = states.runner_demographics().collect()
    assert [r["age_group"] for r in after] == ["90+"] != [r["age_group"] for r in before]
    assert after[0]["athlete_entries"] == 2 * before[0]["athlete_entries"]


def test_runs_take_new_files_and_a_replayed_batch_adds_nothing(spark, sf_dir):
    lake, root = lakehouse(spark, sf_dir), _root(spark, sf_dir)
    medallion = Medallion(spark, f"{root}/lake", lake.lookup())
    for k, part in enumerate(_two_drops(lake.raw())):
        write_csv(part, f"{root}/landing/{k}")
        medallion.run(f"{root}/landing")
    medallion.run(f"{root}/landing")  # nothing new

    def state():
        return [sorted(map(repr, df.collect())) for df in (
            medallion.silver(), medallion.fact(), medallion.accounting(), medallion.gold.country_seasonal_trends())]

    once = state()
    assert once[0] == sorted(map(repr, lake.silver().collect()))
    assert once[1] == sorted(map(repr, lake.fact().collect()))
    assert once[2] == sorted(map(repr, lake.table("silver_accounting").collect()))
    assert sum(r["row_count"] for r in medallion.accounting().collect()) == lake.raw().count()

    # the last batch again, as a stream does after a failure before its commit
    bronze = spark.read.schema(RESULTS_SCHEMA).parquet(f"{root}/lake/bronze")
    drop = _two_drops(bronze)[1]
    keys = spark.table(medallion.sink.keys.name).count()
    medallion.batch(drop, 1)
    assert state() == once
    assert spark.table(medallion.sink.keys.name).count() == keys
    # delivered again under a new number, it is all duplicates
    medallion.batch(drop, 2)
    again = state()
    assert again[0] == once[0] and again[3] == once[3]


def test_accounting_counts_anew_if_observed_sums_do_not_add_up(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    accounting = silver_plan.Accounting()
    kept = silver_plan.counted_rows(lake.raw(), lake.lookup(), accounting)
    kept.write.format("noop").mode("overwrite").save()
    want = {r["stage"]: r["row_count"] for r in lake.table("silver_accounting").collect()}
    assert accounting.counts(lake.raw(), lake.lookup(), lake.silver().count()) == want

    class Twice:  # what a repeated task leaves
        get = {name: 2 * want.get(name, 0) for name in silver_plan.SILVER_RULE_NAMES}

    accounting._rules = Twice
    assert accounting.counts(lake.raw(), lake.lookup(), lake.silver().count()) == want


def test_accounting_of_a_pass_that_keeps_nothing(spark, sf_dir):
    lake, root = lakehouse(spark, sf_dir), _root(spark, sf_dir)
    bad = lake.raw().filter(F.col("Event dates").startswith("00."))
    assert bad.count() > 0
    accounting = silver_plan.Accounting()
    sink = DistinctSink(spark, root, buckets=8)
    rows = silver_plan.valid_enriched(bad, lake.lookup(), accounting)
    assert sink.add(rows, silver_plan.DEDUP_COLUMNS, 0).count() == 0
    assert accounting.counts(bad, lake.lookup(), 0) == {"unparseable_event_dates": bad.count()}


def test_hot_row_is_distinct_before_it_moves(spark, sf_dir):
    """One row delivered 200,000 times: one row a task leaves for the shuffle."""
    root = _root(spark, sf_dir)
    hot = spark.range(300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 < 2, F.lit(0)).otherwise(F.col("id")).alias("k"), F.lit("x").alias("t"))
    sink = DistinctSink(spark, root, buckets=8)
    assert sink.add(hot, ["k", "t"], 0).count() == 100_001
    assert sink.add(hot.filter("k < 500").union(spark.sql("SELECT -7L, 'x'")), ["k", "t"], 1).count() == 1
    at_scale = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a key table beyond any broadcast
    try:
        distinct = hot.distinct().withColumn("key", row_key(["k", "t"]))
        plan = sink.keys.unseen(distinct, 2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", at_scale)
    left, right = plan.split("SortMergeJoin")[1].split("FileScan")[0], plan[plan.index("FileScan"):]
    assert left.count("HashAggregate") == 2 and left.count("Exchange") == 2  # distinct first, then to the key's bucket
    assert "Bucketed: true" in right


def test_candidates_are_the_silver_rows_repeated(spark):
    counted = spark.createDataFrame([(1, 3), (2, 1), (3, 200_000)], "event_number_of_finishers int, copies long")
    for c in silver_plan.SILVER_COLUMNS:
        if c not in counted.columns:
            counted = counted.withColumn(c, F.lit(None).cast("string"))
    got = silver_plan.repeat_copies(counted).groupBy("event_number_of_finishers").count().collect()
    assert {r[0]: r[1] for r in got} == {1: 3, 2: 1, 3: 200_000}


def test_bitmaps_count_distinct_numbers_of_any_sign_and_size(spark):
    rows = [("a", n) for n in (0, 1, 1, 32767, 32768, 32769, -1, -32768, 10 ** 12, None)] + [("b", 5)] * 4 + [("c", None)]
    df = spark.createDataFrame(rows, "g string, n long")
    got = {r["g"]: r["k"] for r in bitmaps.distinct_count(df, ["g"], "n", "k").collect()}
    assert got == {"a": 8, "b": 1}
    halves = [bitmaps.bitmap_rows(part, ["g"], "n") for part in df.randomSplit([0.5, 0.5], 3)]
    united = bitmaps.union_bitmaps(halves[0].union(halves[1]), ["g"])
    assert {r["g"]: r["k"] for r in bitmaps.count_bits(united, ["g"], "k").collect()} == got


def test_dense_numbers_have_no_gaps(spark, sf_dir):
    path = _root(spark, sf_dir)
    spark.range(1000, numPartitions=7).filter("id % 3 = 0").write.parquet(path)
    got = [r[0] for r in bitmaps.dense_numbers(spark.read.parquet(path), "n", 50).select("n").collect()]
    assert sorted(got) == list(range(50, 50 + 334))


def test_incremental_command(spark, sf_dir):
    lake, root = lakehouse(spark, sf_dir), _root(spark, sf_dir)
    write_csv(lake.lookup(), f"{root}/countries")
    for k, part in enumerate(_two_drops(lake.raw())):
        write_csv(part, f"{root}/landing/{k}")
        paths = update(spark, f"{root}/landing", f"{root}/countries", f"{root}/out")
    for name in ("vw_distance_km_results", "vw_time_hour_results", "vw_seasonal_race_trends"):
        assert _same(spark.read.parquet(paths[name]), REGISTRY[name](spark, sf_dir))


def test_a_row_is_parsed_only_as_far_as_its_first_broken_rule(spark, sf_dir):
    """Three filters, each before the parsing of the next step, and the rows and losses of the rules at once."""
    lake = lakehouse(spark, sf_dir)
    accounting = silver_plan.Accounting()
    rows = silver_plan.valid_enriched(lake.raw(), lake.lookup(), accounting)
    assert len(accounting._rules.taken) == 3
    want = silver_plan.enrich_country(silver_plan.valid_rows(lake.raw()), lake.lookup()).select(*rows.columns)
    assert _same(rows, want)
    found = accounting._rules.get
    assert {k: n for k, n in found.items() if n} == {
        r.reason: r.n for r in silver_plan.silver_columns(lake.raw()).groupBy(silver_plan.reject_reason().alias("reason"))
        .agg(F.count(F.lit(1)).alias("n")).filter("reason is not null").collect()}


def test_fine_groups_shuffle_numbers_not_bitmaps(spark):
    """50,000 groups of two numbers: the same sets, and no bitmap before the rows of its group have met."""
    df = spark.range(200_000, numPartitions=4).select((F.col("id") % 50_000).alias("g"), F.expr(
        "if(id % 7 = 0, null, id % 100000 * 65536)").alias("n"))
    fine, plain = bitmaps.bitmap_rows(df, ["g"], "n", fine=True), bitmaps.bitmap_rows(df, ["g"], "n")
    few = F.col("g") < 2_000
    assert _same(fine.filter(few), plain.filter(few))
    plan = fine._jdf.queryExecution().executedPlan().toString()
    assert plan.index("bitmap_construct_agg") < plan.index("Exchange")
    assert "bitmap_construct_agg" not in plan[plan.index("Exchange"):]
