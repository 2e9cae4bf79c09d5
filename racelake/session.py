"""Session construction and the shared storage folder.

On a cluster the session is supplied by the platform; ``get_session`` only fills
in settings that are unset, so a cluster's own values always win.  Durable
intermediate tables (the materialised silver and gold layers, stream
checkpoints) live under ``spark.checkpoint.dir``; a local folder is created only
when that setting is absent, which is the case in tests.
"""

from __future__ import annotations

import gc
import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings applied when the caller has not set them.  AQE re-plans joins from
# runtime sizes, coalesces small shuffle partitions and splits skewed join
# partitions (one athlete or one country may carry a third of all rows).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Post-shuffle stages here are CPU-bound (text parsing) on little shuffle
    # data; a smaller floor keeps small local runs parallel.  At scale the
    # partitions are far above this floor and it has no effect.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    # The silver rule filter inlines every parser once Catalyst pushes it below
    # the projections; a generated method that large is never JIT-compiled by
    # HotSpot (limit 8000 bytes of bytecode).  Spark then compiles such stages
    # operator by operator instead of running them interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Streaming dedup state grows with the data: keep it in RocksDB (off the JVM
    # heap, spills to local disk, incremental changelog checkpoints to the
    # shared checkpoint folder) rather than in executor heap maps.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _driver_memory_given() -> bool:
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # started by spark-submit
        return True
    told = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    conf_dir = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    try:
        with open(os.path.join(conf_dir, "spark-defaults.conf")) as fh:
            told += fh.read()
    except OSError:
        pass
    return "spark.driver.memory" in told or "--driver-memory" in told


def _half_of_memory() -> str:
    pages, size = os.sysconf("SC_PHYS_PAGES"), os.sysconf("SC_PAGE_SIZE")
    return f"{max(1024, pages * size // 2 // (1 << 20))}m"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "racelake") -> SparkSession:
    """The active session, or a new one; only settings that nobody has set are filled in.

    Settings given to ``spark-submit``, in ``PYSPARK_SUBMIT_ARGS`` or in Spark's defaults file
    are known once the JVM runs, so it is started before the defaults are chosen.  The driver's
    memory has to be given before that: under ``spark-submit``, or where it is set, it is left
    alone; otherwise it is ``RACELAKE_DRIVER_MEMORY`` or half of this machine's memory.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        for key, value in DEFAULT_CONF.items():
            if active.conf.isModifiable(key) and active.conf.get(key, None) is None:
                active.conf.set(key, value)
        return active
    first = SparkConf(loadDefaults=False)
    if not _driver_memory_given():
        first.set("spark.driver.memory", os.environ.get("RACELAKE_DRIVER_MEMORY") or _half_of_memory())
    SparkContext._ensure_initialized(conf=first)
    given = SparkConf()
    wanted = dict(DEFAULT_CONF)
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app_name)
    # The launcher always fills in a master, so its being set says nothing.
    if master and "PYSPARK_GATEWAY_PORT" not in os.environ and "--master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.master(master)
    for key, value in wanted.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    value = spark.conf.get(key, None)
    if value:
        return value
    try:
        return spark.sparkContext.getConf().get(key, None)
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
        return None


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside; afterwards they are as they were."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps that nothing refers to any more."""
    gc.collect()
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # noqa: BLE001 - Spark Connect
        pass


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared storage that no later step reads."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect
        return _conf(spark, "spark.app.id") or "app"


def default_parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect
        return int(_conf(spark, "spark.default.parallelism") or os.cpu_count() or 8)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    When unset (local runs, tests) a private folder is created and registered as
    the context's checkpoint directory, so ``DataFrame.checkpoint()`` works too.
    """
    configured = _conf(spark, "spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    try:
        existing = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - Spark Connect: no context to register with
        existing = None
    if existing:
        # The context appends a random sub-folder; keep tables beside it.
        return os.path.dirname(existing.rstrip("/"))
    master = _conf(spark, "spark.master") or ""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share: "
                         f"a machine-local folder does not do on {master or 'this cluster'}")
    local = tempfile.mkdtemp(prefix="racelake-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(local)
    except Exception:  # noqa: BLE001 - Spark Connect
        pass
    return local


def lake_root(spark: SparkSession) -> str:
    """Folder for materialised layers of this application."""
    return f"{checkpoint_dir(spark)}/racelake/{app_id(spark)}"
