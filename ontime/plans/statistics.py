"""Stored statistics of the flights table, kept up to date month by month."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TABLE_PARTITIONS, scratch_path
from ..operators.statistics import STATISTICS, month_statistics_of
from ..sinks.versions import newest, read_version, remove_old_versions, write_version
from ..sources.lake import read_flights_table

STORED = f"{STATISTICS}, files_hash long"
MONTH_OF_PATH = r"Yeard=([0-9]+)/Monthd=([0-9]+)/[^/]+$"


def month_files(spark: SparkSession, table_path: str) -> DataFrame:
    """(Yeard, Monthd, files_hash) of the table's months: a hash over path, length and
    modification time of their files, in any order. Contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
             .load(table_path).where(F.col("path").rlike(MONTH_OF_PATH)))
    keys = (F.regexp_extract("path", MONTH_OF_PATH, i + 1).cast("int").alias(k) for i, k in enumerate(TABLE_PARTITIONS))
    return files.groupBy(*keys).agg(F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("files_hash"))


def read_statistics(spark: SparkSession, stats_path: str) -> DataFrame:
    number = newest(spark, stats_path)
    return spark.createDataFrame([], STORED) if number is None else read_version(spark, stats_path, number)


def update_statistics(spark: SparkSession, table_path: str, stats_path: str) -> list[tuple[int, int]]:
    """Bring the stored statistics up to date with the table: months whose files are other than
    those the statistics were made from are read, once, and merged months need no scan.
    Returns the months read. Statistics of months that are gone go. The stored rows (a few kB
    per month and column) are one version of a versioned table, so readers see
    all of an update or nothing."""
    stage = scratch_path(spark, "month_files")
    month_files(spark, table_path).write.parquet(stage)
    now = spark.read.parquet(stage)
    scanned: list[tuple[int, int]] = []

    def rows(base: int | None) -> DataFrame:
        old = spark.createDataFrame([], STORED) if base is None else read_version(spark, stats_path, base)
        same = [*TABLE_PARTITIONS, "files_hash"]
        todo = now.join(old.select(*same).distinct(), same, "left_anti").collect()  # a row per month
        scanned[:] = sorted((m.Yeard, m.Monthd) for m in todo)
        kept = old.join(now, same, "left_semi").select(*old.columns)
        if not scanned:
            return kept
        part = reduce(lambda a, b: a | b, ((F.col("Yeard") == y) & (F.col("Monthd") == m) for y, m in scanned))
        fresh = month_statistics_of(read_flights_table(spark, table_path).where(part))
        return kept.unionByName(fresh.join(now, TABLE_PARTITIONS).select(*old.columns))

    write_version(spark, stats_path, rows)
    remove_old_versions(spark, stats_path)
    return scanned
