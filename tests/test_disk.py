"""What the lake leaves on disk: compressed tables and landings, no files of finished steps."""

import glob
import gzip
import uuid

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from racelake import queries
from racelake.operators.joins import duplicate_key_values
from racelake.plans import lakehouse as lh
from racelake.plans import quality
from racelake.plans.lakehouse import Lakehouse, lakehouse
from racelake.queries import REGISTRY
from racelake.streaming import medallion


def _codecs(folder):
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression
            for f in glob.glob(f"{folder}/**/*.parquet", recursive=True) if pq.ParquetFile(f).metadata.num_row_groups}


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_each_layer_is_stored_compressed_and_frees_its_shuffles(spark, sf_dir, tmp_path, monkeypatch):
    freed = []
    monkeypatch.setattr(lh, "release", lambda spark: freed.append(1))
    lake = Lakehouse(spark, sf_dir, root=str(tmp_path / "lake"))
    lake.dims(), lake.fact()
    for name in ("bronze_results", "silver_obt", "fact_results", "dim_event"):
        assert _codecs(f"{lake.root}/{name}") == {"ZSTD"}, name
    assert len(freed) >= 7  # bronze, lookup, silver, four dimensions and the fact at least


def test_a_lake_without_readers_is_discarded(spark, sf_dir, tmp_path):
    lake = Lakehouse(spark, sf_dir, root=str(tmp_path / "lake"))
    rows = lake.silver().count()
    lake.discard()
    assert not (tmp_path / "lake/silver_obt").exists() and not (tmp_path / "lake/bronze_results").exists()
    assert lake.silver().count() == rows


def test_the_refreshed_view_keeps_no_tables_of_the_first_delivery(spark, sf_dir, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "_scratch", lambda *_: str(tmp_path / "io"))
    assert _rows(REGISTRY["view_refresh"](spark, sf_dir)) == _rows(REGISTRY["vw_global_leaderboard"](spark, sf_dir))
    assert not list((tmp_path / "io/tables").glob("v1/*"))


def test_landed_files_are_compressed_in_bounded_pieces(spark, sf_dir, tmp_path):
    raw = lakehouse(spark, sf_dir).raw()
    queries._land_csv(raw, str(tmp_path / "land"))
    files = glob.glob(f"{tmp_path}/land/*.csv.gz")
    with_header = [gzip.open(f, "rt", encoding="utf8", newline="").read().count("\n") for f in files]
    assert files and sum(with_header) - len(files) == raw.count()


def test_duplicate_columns_are_the_same_from_stored_keys(spark, tmp_path):
    rows = [("a", 1), ("a", 2), ("b", 1), ("c", None), ("c", 3), (None, 1), (None, 2)]
    df = spark.createDataFrame([(k, *[v] * len(quality.DIFF_COLUMNS)) for k, v in rows],
                               "result_id string, " + ", ".join(f"{c} int" for c in quality.DIFF_COLUMNS))
    duplicate_key_values(df, "result_id").write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys"))
    stored = quality.duplicate_column_diff(df, keys=keys)
    assert _rows(stored) == _rows(quality.duplicate_column_diff(df))
    assert {r["result_id"]: (r["row_count"], r["distinct_athlete_id"]) for r in stored.collect()} == {
        "a": (2, 2), "c": (2, 1)}


def test_later_batches_meet_the_earlier_keys_in_shares(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(medallion, "ROWS_PER_SHARE", 10)
    met, unseen = [], medallion.KeyTable.unseen
    monkeypatch.setattr(medallion.KeyTable, "unseen", lambda self, df, n: met.append(n) or unseen(self, df, n))
    root = f"{tmp_path}/{uuid.uuid4().hex[:8]}"
    sink = medallion.DistinctSink(spark, root, buckets=2)
    rows = lambda a, b: spark.range(a, b).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    for number, (a, b) in enumerate([(0, 40), (20, 75), (20, 75)]):
        sink.add(rows(a, b).union(rows(a, b)), ["id", "v"], number)
    sink.add(rows(20, 75), ["id", "v"], 1)  # a batch that is repeated
    assert met == [1] * 6 + [2] * 6 + [1] * 6
    assert _rows(sink.read(rows(0, 1).schema).select("id", "v")) == _rows(rows(0, 75))
    assert not glob.glob(f"{root}/rows-whole/batch=*")
    assert _codecs(f"{root}/rows") == {"ZSTD"}
