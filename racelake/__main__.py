"""Build the lake from CSV files and write the gold views.

    python -m racelake --results <csv folder> --countries <csv folder> --out <folder> [--incremental]

Writes bronze, silver and the star schema under ``<out>/tables`` and every view
under ``<out>/views/<name>`` (parquet).  With ``--incremental`` the tables are those of
``racelake.streaming.medallion`` under ``<out>/lake``: each run takes the new files only,
and the views are read from the stored state.  On a cluster, ``--out`` is a shared
folder; the session is the one ``spark-submit`` provides.
"""

from __future__ import annotations

import argparse

from racelake.plans import views
from racelake.plans.lakehouse import csv_lakehouse
from racelake.session import get_session
from racelake.sources.files import COUNTRIES_SCHEMA, read_csv
from racelake.streaming.medallion import Medallion

TABLES = ["bronze_results", "bronze_country_codes", "silver_obt", "silver_accounting", "fact_results",
          "dim_event", "dim_athlete", "dim_country", "dim_date"]


def _write_views(outputs: dict, out: str) -> dict[str, str]:
    paths = {}
    for name, df in outputs.items():
        paths[name] = f"{out}/views/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def build(spark, results: str, countries: str, out: str) -> dict[str, str]:
    """Everything from scratch."""
    lake = csv_lakehouse(spark, results, countries, root=f"{out}/tables")
    for name in TABLES:
        lake.table(name)
    dims, fact = lake.dims(), lake.fact()
    return _write_views({
        "vw_distance_km_results": views.distance_type_results(lake.fact("distance_km"), dims, "distance_km"),
        "vw_distance_mi_results": views.distance_type_results(lake.fact("distance_mi"), dims, "distance_mi"),
        "vw_time_hour_results": views.distance_type_results(lake.fact("time_hours"), dims, "time_hours"),
        "vw_global_leaderboard": views.global_leaderboard(fact, dims["country"]),
        "vw_seasonal_race_trends": views.seasonal_race_trends(fact, dims["date"]),
        "vw_runner_demographics": views.runner_demographics(fact, dims["athlete"]),
        "vw_country_seasonal_trends": views.country_seasonal_trends(fact, dims["date"], dims["country"]),
    }, out)


def update(spark, results: str, countries: str, out: str) -> dict[str, str]:
    """Only the files of ``results`` that no earlier run has taken; the country lookup is read as it is now."""
    lookup = read_csv(spark, countries, COUNTRIES_SCHEMA)
    lake = Medallion(spark, f"{out}/lake", lookup)
    lake.run(results)
    dims = lake.dims()
    return _write_views({
        "vw_distance_km_results": views.distance_type_results(lake.fact("distance_km"), dims, "distance_km"),
        "vw_distance_mi_results": views.distance_type_results(lake.fact("distance_mi"), dims, "distance_mi"),
        "vw_time_hour_results": views.distance_type_results(lake.fact("time_hours"), dims, "time_hours"),
        "vw_global_leaderboard": lake.gold.global_leaderboard(),
        "vw_seasonal_race_trends": lake.gold.seasonal_race_trends(),
        "vw_runner_demographics": lake.gold.runner_demographics(),
        "vw_country_seasonal_trends": lake.gold.country_seasonal_trends(),
        "silver_accounting": lake.accounting(),
    }, out)


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="racelake", description=__doc__.splitlines()[0])
    parser.add_argument("--results", required=True, help="folder of race-results CSV files")
    parser.add_argument("--countries", required=True, help="folder of country lookup CSV files")
    parser.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    parser.add_argument("--incremental", action="store_true", help="take only files that no earlier run has taken")
    parser.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    args = parser.parse_args(argv)
    spark = get_session(args.master)
    run = update if args.incremental else build
    for name, path in run(spark, args.results, args.countries, args.out).items():
        print(name, path)


if __name__ == "__main__":
    main()
