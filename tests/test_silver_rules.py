"""FIXTURES.md section 4 rule cases through the whole silver rule chain."""

import pytest

from racelake.plans import silver
from racelake.sources.fixture import RAW_COLUMNS

SCHEMA = ", ".join(f"`{c}` {t}" for c, t in zip(RAW_COLUMNS, [
    "int", "string", "string", "string", "int", "string", "string", "string", "double", "string",
    "string", "string", "int"]))


def row(**kw):
    base = {"Year of event": 2000, "Event dates": "07.12.2000", "Event name": " Race ",
            "Event distance/length": "100km", "Event number of finishers": 10,
            "Athlete performance": "3:32:00 h", "Athlete club": None, "Athlete country": "abx",
            "Athlete year of birth": 1970.0, "Athlete gender": "m", "Athlete age category": "M30",
            "Athlete average speed": "28302.0", "Athlete ID": 1}
    base.update(kw)
    return tuple(base[c] for c in RAW_COLUMNS)


def kept(spark, *rows):
    return silver.valid_rows(spark.createDataFrame(list(rows), SCHEMA)).count()


def test_base_row_kept(spark):
    assert kept(spark, row()) == 1


@pytest.mark.parametrize("perf,expected", [
    ("7:12:00 h", 1),      # 50 km in 1 h = 50.0 km/h: kept
    ("0:59:59 h", 0),      # 50.014 km/h: dropped
])
def test_speed_bound(spark, perf, expected):
    r = list(row(**{"Event distance/length": "50km", "Athlete performance": perf}))
    if perf == "7:12:00 h":
        r[RAW_COLUMNS.index("Event distance/length")] = "360km"   # 360 km / 7.2 h = 50.0
    assert kept(spark, tuple(r)) == expected


@pytest.mark.parametrize("dist,perf", [("100km", "24.0 km"), ("24h", "5:00:00 h")])
def test_unit_mismatch_dropped(spark, dist, perf):
    assert kept(spark, row(**{"Event distance/length": dist, "Athlete performance": perf})) == 0


@pytest.mark.parametrize("birth,expected", [(1193.0, 0), (1996.0, 0), (1995.0, 1), (1900.0, 1), (1899.0, 0)])
def test_age_bounds(spark, birth, expected):
    assert kept(spark, row(**{"Athlete year of birth": birth})) == expected


@pytest.mark.parametrize("dates,expected", [("00.06.2000", 0), ("31.02.2000", 0), (None, 0),
                                            ("31.12.-01.01.2001", 1), ("2000-12-07", 0)])
def test_dates(spark, dates, expected):
    assert kept(spark, row(**{"Event dates": dates})) == expected


@pytest.mark.parametrize("dist,expected", [("50K", 1), (" 45Km", 1), ("71.5", 0), ("10d", 0),
                                           ("57km/2Etappen", 0), ("24.5h", 0)])
def test_distance_kinds(spark, dist, expected):
    assert kept(spark, row(**{"Event distance/length": dist, "Athlete performance": "8:00:00 h"})) == expected


def test_missing_fields_dropped(spark):
    assert kept(spark, row(**{"Athlete country": None}), row(**{"Athlete gender": None}),
                row(**{"Event number of finishers": 0})) == 0


def test_silver_tasks_stay_small_however_large_the_bronze_files(spark, tmp_path, monkeypatch):
    """A bronze file has many row groups, silver reads them in small splits and spreads its rows by their number."""
    import pyarrow.parquet as pq

    from racelake.plans import lakehouse as lh
    from racelake.sources import files
    from racelake.sources.fixture import race_results_raw

    reading, parts = "spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions"
    monkeypatch.setitem(files.BRONZE_OPTIONS, "parquet.block.size", str(16 << 10))
    monkeypatch.setattr(lh, "ROWS_PER_PARTITION", 100)
    seen, made = [], lh.silver_plan.counted_rows

    def counted(raw, lookup, accounting):
        seen.append((spark.conf.get(reading), int(spark.conf.get(parts))))
        return made(raw, lookup, accounting)

    monkeypatch.setattr(lh.silver_plan, "counted_rows", counted)
    sf_dir = "/root/testdata/sf0.001"
    lake = lh.Lakehouse(spark, sf_dir, root=str(tmp_path), sources={
        "bronze_results": lambda: race_results_raw(spark, sf_dir).coalesce(1)})
    before, rows = [spark.conf.get(k, None) for k in (reading, parts)], lake.raw().count()
    file, = tmp_path.glob("bronze_results/*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 1
    assert lake.silver().count() > 0
    assert seen == [(files.BRONZE_READING[reading], max(int(before[1]), -(-rows // 100)))]
    assert [spark.conf.get(k, None) for k in (reading, parts)] == before
