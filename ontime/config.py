"""Fixed column lists and session helpers shared by every job."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# --- Fixed values (must equal the on-time-performance data layout) -----------------
# The 18 columns kept from a raw on-time record, in the order cleaning writes them.
SELECTED_FIELDS = [
    "Year", "Month", "DayofMonth", "DayOfWeek", "FlightDate", "UniqueCarrier",
    "FlightNum", "Origin", "Dest", "CRSDepTime", "DepTime", "DepDelay",
    "DepDelayMinutes", "CRSArrTime", "ArrTime", "ArrDelay", "ArrDelayMinutes",
    "Cancelled",
]
# The same 18 columns in the order of the flights table definition.
TABLE_FIELDS = [
    "DayOfWeek", "Origin", "UniqueCarrier", "FlightNum", "Dest", "ArrDelayMinutes",
    "FlightDate", "ArrDelay", "Month", "DepDelayMinutes", "DepDelay", "CRSArrTime",
    "Year", "Cancelled", "ArrTime", "DepTime", "CRSDepTime", "DayofMonth",
]
# Integer-typed columns of the flights table; every other data column is a string.
INT_FIELDS = [
    "DayOfWeek", "ArrDelayMinutes", "ArrDelay", "Month", "DepDelayMinutes",
    "DepDelay", "Year", "Cancelled", "DayofMonth",
]
# Partition columns of the flights table and of the day-partitioned lake.
TABLE_PARTITIONS = ["Yeard", "Monthd"]
LAKE_PARTITIONS = ["Yeard", "Monthd", "Dayd"]
# Noon boundary of the two-leg itinerary query (text compare, exclusive both ways).
NOON = "1200"
# ---------------------------------------------------------------------------------

STRING_FIELDS = [c for c in TABLE_FIELDS if c not in INT_FIELDS]


def default_session(master: str = "local[*]", shuffle_partitions: int = 8,
                    app_name: str = "ontime") -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster the session comes from the launcher; nothing here is required there.
    """
    return (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


# Sizing for a large cluster (hundreds of TB, ~1000 executors). The biggest shuffle is a
# year of flights re-partitioned for the best-flight join back (~5 TB of pruned rows at
# 100 TB): 20,000 initial partitions keep it near 250 MB per task, and AQE coalesces
# the many small shuffles (aggregates) down to the advisory size. AQE cannot split a
# large partition that is not skewed, hence the high initial number.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
}


def cluster_defaults(spark: SparkSession) -> dict[str, str]:
    """Apply ``CLUSTER_DEFAULTS`` for every setting the user did not set; returns those set."""
    given = spark.sparkContext.getConf()
    applied = {}
    for key, value in CLUSTER_DEFAULTS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
            applied[key] = value
    return applied


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session; only when it is unset and the master is local (tests, local
    runs) a private temporary folder is created and registered; on a cluster that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not sc.master.split("[")[0] == "local":
                raise RuntimeError("set spark.checkpoint.dir to shared storage: a temporary folder of one "
                                   f"machine cannot serve the executors of {sc.master}")
            current = tempfile.mkdtemp(prefix="ontime-checkpoints-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a while; those of before come back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffles_freed(spark: SparkSession):
    """While it holds, a query's shuffle files go when the query ends. Otherwise they stay on the
    executors' disks until the driver happens to collect its garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


#: Partition files that a task holds open, at most, before it sorts what is left by partition,
#: and the MB of heap that each is reckoned at.
OPEN_WRITERS, WRITER_MB = 250, 5


def open_writers(spark: SparkSession) -> int:
    """Partition files that a task may hold open: by its share of an executor's heap."""
    sc = spark.sparkContext
    local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
    heap = sc.getConf().get("spark.driver.memory" if local else "spark.executor.memory", "1g")
    mb = sc._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsMb(heap)
    # The driver is listed among the executors.
    executors = 1 if local else max(1, len(sc._jsc.sc().statusTracker().getExecutorInfos()) - 1)
    cores = int(sc.getConf().get("spark.executor.cores", "0")) or -(-sc.defaultParallelism // executors)
    return min(OPEN_WRITERS, mb // max(1, cores) // WRITER_MB)


def write_partitioned(rows: DataFrame, path: str, fmt: str, keys: list[str], **options: str) -> None:
    """Write ``rows`` partitioned by ``keys``; partitions written again replace only those.

    The writer's default sorts all rows of a task by partition, in memory many times the size
    of the files, and spills from some size on. A task that meets few partitions needs no sort."""
    spark = rows.sparkSession
    with shuffles_freed(spark), settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(open_writers(spark))}):
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
         .partitionBy(*keys).format(fmt).save(path))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for one job's outputs."""
    return f"{checkpoint_dir(spark)}/ontime/{name}-{uuid.uuid4().hex[:12]}"


_BUILT: dict[tuple[str, str, str], str] = {}
_BUILD_LOCK = threading.RLock()


def built_once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]) -> str:
    """The scratch folder that ``build`` filled, built once per application and input, and
    built again when the folder is gone."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _BUILD_LOCK:
        path = _BUILT.get(key)
        if path:
            try:
                spark.read.parquet(f"{path}/_built_marker/done")
                return path
            except AnalysisException:
                pass
        path = scratch_path(spark, name)
        build(path)
        spark.range(1).coalesce(1).write.parquet(f"{path}/_built_marker/done")
        _BUILT[key] = path
        return path


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers (once per application).

    Functions given to ``mapInArrow`` / ``mapInPandas`` are imported by module name on
    the executors; ``addPyFile`` distributes a zip of the package with the job, so it
    works whatever the workers' path (the same as ``--py-files`` on ``spark-submit``).
    """
    app = spark.sparkContext.applicationId
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg_dir)
        zip_path = os.path.join(tempfile.mkdtemp(prefix="ontime-pkg-"), "ontime.zip")
        with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as zf:
            for folder, _, files in os.walk(pkg_dir):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        zf.write(full, os.path.relpath(full, root))
        spark.sparkContext.addPyFile(zip_path)
        _SHIPPED.add(app)
