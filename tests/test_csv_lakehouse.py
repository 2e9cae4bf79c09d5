"""The lake over real CSV inputs equals the lake over the derived fixture."""

import uuid

from racelake.__main__ import build
from racelake.plans.lakehouse import Lakehouse, csv_lakehouse, lakehouse
from racelake.queries import REGISTRY
from racelake.sources.files import COUNTRIES_SCHEMA, CSV_OPTIONS, RESULTS_SCHEMA, write_csv


def test_csv_pipeline_matches_fixture(spark, sf_dir):
    lake = lakehouse(spark, sf_dir)
    root = f"{lake.root}/csv-{uuid.uuid4().hex[:8]}"
    write_csv(lake.raw(), f"{root}/in/results")
    write_csv(lake.lookup(), f"{root}/in/countries")
    paths = build(spark, f"{root}/in/results", f"{root}/in/countries", f"{root}/out")
    silver = spark.read.parquet(f"{root}/out/tables/silver_obt")
    assert silver.select("result_id").exceptAll(lake.silver().select("result_id")).count() == 0
    assert silver.count() == lake.silver().count()
    board = spark.read.parquet(paths["vw_global_leaderboard"])
    expected = REGISTRY["vw_global_leaderboard"](spark, sf_dir)
    assert board.count() == expected.count() > 0
    assert board.exceptAll(expected).count() == 0


def _csv(spark, path, rows):
    spark.createDataFrame(rows, RESULTS_SCHEMA).coalesce(1).write.options(**CSV_OPTIONS).csv(path)


def test_a_result_has_one_key_whatever_lies_beside_it(spark, sf_dir):
    root = f"{lakehouse(spark, sf_dir).root}/keys-{uuid.uuid4().hex[:8]}"
    row = (2018, "06.01.2018", "Race (USA)", "50km", 20, "4:51:39 h", "*Club", "USA", 1978.0, "M", "M35", "10.286", 7)
    clock = (*row[:11], "09:29:17", 8)
    write_csv(spark.createDataFrame([("USA", "USA", "United States")], COUNTRIES_SCHEMA), f"{root}/countries")
    ids = []
    for k, rows in enumerate([[row], [row, clock]]):
        _csv(spark, f"{root}/in{k}", rows)
        silver = csv_lakehouse(spark, f"{root}/in{k}", f"{root}/countries", root=f"{root}/out{k}").silver()
        ids.append(silver.filter("athlete_id = 7").first()["result_id"])
    assert ids[0] == ids[1]


def test_file_uri_gives_the_rows_of_the_plain_path(spark, sf_dir):
    plain = lakehouse(spark, sf_dir).lookup().collect()
    assert sorted(lakehouse(spark, f"file://{sf_dir}").lookup().collect()) == sorted(plain)


def test_views_are_stored_and_refreshed(spark, sf_dir):
    root = f"{lakehouse(spark, sf_dir).root}/refresh-{uuid.uuid4().hex[:8]}"
    rows = [1]
    lake = Lakehouse(spark, root, root=root, sources={"bronze_results": lambda: spark.range(len(rows))})
    view = lambda lk: lk.raw().groupBy().count()
    assert lake.view("v", view).first()[0] == 1
    rows.append(2)
    old = lake.view("v", view)
    assert old.first()[0] == 1
    lake.refresh()
    assert lake.view("v", view).first()[0] == 2 and old.first()[0] == 1
