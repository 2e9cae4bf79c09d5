"""Materialised layers (bronze, silver, gold) for one input folder.

Like the studied pipeline's tables, each layer is computed once and written as
parquet; later queries read the files, so lineage stays short and a lost
executor costs a task retry, not a recomputation of the layers below.  Files
live in the shared folder named by ``spark.checkpoint.dir`` (see
``racelake.session.lake_root``), never in a machine-local folder on a cluster.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession

from racelake.plans import silver as silver_plan
from racelake.plans import star
from racelake.session import app_id, delete, lake_root, release, settings
from racelake.sources.files import (BRONZE_OPTIONS, BRONZE_READING, COUNTRIES_SCHEMA, RESULTS_SCHEMA, TABLE_OPTIONS,
                                    read_csv)
from racelake.sources.fixture import country_lookup_raw, race_results_raw

#: Tables that the silver pass makes together.
SILVER_TABLES = ("silver_obt", "silver_candidates")
#: Raw rows to a shuffle partition of the silver pass, at least as many partitions as the session has: bounds its memory.
ROWS_PER_PARTITION = 1 << 19
_LOCK = threading.RLock()
_LAKES: dict[tuple[str, str], "Lakehouse"] = {}


class Lakehouse:
    """Lazily materialised tables of one input folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None,
                 sources: dict | None = None):
        """``sources`` maps ``bronze_results`` / ``bronze_country_codes`` to
        DataFrame builders; by default both are derived from the supplied
        tables in ``sf_dir`` (the fixture)."""
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")  # a path or a URI: only Spark opens it
        digest = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:12]
        self.root = root or f"{lake_root(spark)}/{digest}"
        self._built: dict[str, DataFrame] = {}
        self._version = 0
        sources = sources or {}
        self._builders = {
            "bronze_results": sources.get("bronze_results", lambda: race_results_raw(spark, self.sf_dir)),
            "bronze_country_codes": sources.get("bronze_country_codes",
                                                lambda: country_lookup_raw(spark, self.sf_dir)),
            "silver_accounting": self._silver_accounting,
            "dim_event": lambda: star.dim_event(self.table("silver_obt")),
            "dim_athlete": lambda: star.dim_athlete(self.table("silver_obt")),
            "dim_country": lambda: star.dim_country(self.table("silver_obt")),
            "dim_date": lambda: star.dim_date(self.table("silver_obt")),
        }

    def path(self, name: str) -> str:
        """Folder of a table; a refresh writes to a new one, so open readers keep their files."""
        return f"{self.root}/{name}" if not self._version else f"{self.root}/v{self._version}/{name}"

    def refresh(self) -> None:
        """Forget the built layers and views: the next use builds them from the sources as they are then."""
        with _LOCK:
            self._built = {}
            self._version += 1

    def discard(self) -> None:
        """Delete the files of the built layers and views, for a lake of which no table is read any more; then as
        ``refresh``."""
        with _LOCK:
            for name in {"silver_obt" if name in SILVER_TABLES else name for name in self._built}:
                delete(self.spark, self.path(name))
            self.refresh()

    def view(self, name: str, build) -> DataFrame:
        """A stored view: ``build(lake)`` written on first use after a refresh, then read back."""
        self._builders.setdefault(name, lambda: build(self))
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        """The materialised table (built on first use, then read back once;
        later calls reuse the same DataFrame and its file listing)."""
        if name not in self._built:
            with _LOCK:
                if name in SILVER_TABLES:
                    self._build_silver()
                if name == "fact_results":
                    star.write_fact(self.table("silver_obt"), self.path(name))
                    self._built[name] = star.read_fact(self.spark, self.path(name))
                if name not in self._built:
                    self._builders[name]().write.mode("overwrite").options(**BRONZE_OPTIONS).parquet(self.path(name))
                    self._built[name] = self.spark.read.parquet(self.path(name))
                release(self.spark)
        return self._built[name]

    def _build_silver(self) -> None:
        """One pass over bronze: the silver rows with their copies (the files of ``silver_obt``), from which
        ``silver_obt`` and ``silver_candidates`` are projections, and the accounting of every raw row."""
        raw, lookup = self.table("bronze_results"), self.table("bronze_country_codes")
        accounting = silver_plan.Accounting()
        path = self.path("silver_obt")
        parts = "spark.sql.shuffle.partitions"
        wanted = max(int(self.spark.conf.get(parts)), -(-raw.count() // ROWS_PER_PARTITION))
        with settings(self.spark, BRONZE_READING | {parts: str(wanted)}):
            silver_plan.counted_rows(raw, lookup, accounting).write.mode("overwrite").options(**TABLE_OPTIONS).parquet(path)
        counted = self.spark.read.parquet(path)
        self._counts = accounting.counts(raw, lookup, counted.count())
        self._built["silver_obt"] = counted.select(*silver_plan.SILVER_COLUMNS)
        self._built["silver_candidates"] = silver_plan.repeat_copies(counted)

    def _silver_accounting(self) -> DataFrame:
        """(stage, row_count) of the last silver pass."""
        self.table("silver_obt")
        return silver_plan.counts_table(self.spark, self._counts)

    # Convenience accessors.
    def raw(self) -> DataFrame:
        return self.table("bronze_results")

    def lookup(self) -> DataFrame:
        return self.table("bronze_country_codes")

    def silver(self) -> DataFrame:
        return self.table("silver_obt")

    def fact(self, distance_type: str | None = None) -> DataFrame:
        """The fact table; with a distance type only the files of that type."""
        whole = self.table("fact_results")
        return whole if distance_type is None else star.read_fact(self.spark, self.path("fact_results"), distance_type)

    def dims(self) -> dict[str, DataFrame]:
        return {n: self.table(f"dim_{n}") for n in ("event", "athlete", "country", "date")}


def csv_lakehouse(spark: SparkSession, results_csv: str, countries_csv: str,
                  root: str | None = None) -> Lakehouse:
    """A lake over real input files: the race-results CSV folder and the country
    lookup CSV folder (header row, the fixed schemas, text kept byte for byte)."""
    return Lakehouse(spark, f"{results_csv}|{countries_csv}", root=root, sources={
        "bronze_results": lambda: read_csv(spark, results_csv, RESULTS_SCHEMA),
        "bronze_country_codes": lambda: read_csv(spark, countries_csv, COUNTRIES_SCHEMA),
    })


def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    key = (app_id(spark), sf_dir.rstrip("/"))
    with _LOCK:
        lake = _LAKES.get(key)
        if lake is None:
            lake = _LAKES[key] = Lakehouse(spark, sf_dir)
    return lake
