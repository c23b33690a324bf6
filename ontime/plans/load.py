"""Load: clean lake -> typed flights table partitioned by month, with statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LAKE_PARTITIONS, scratch_path
from ..operators.quality import column_profile
from ..sinks.versions import newest, read_version, remove, write_version
from ..sources.lake import (lake_files, read_flights_table, read_lake, register_flights_table,
                            type_flights, write_flights_table)

#: What the ledger of a table keeps of each lake file in it.
LEDGER = "path string, length long, modificationTime timestamp, Yeard string, Monthd string, Dayd string"


def load(spark: SparkSession, lake_path: str, table_path: str, table_name: str | None = None,
         fmt: str = "parquet", compute_stats: bool = True, shuffle: bool = False) -> DataFrame:
    """Type the lake and store it as the flights table; return the stored table.

    The lake is Parquet or CSV, in day folders or as day files in month folders. ``shuffle``
    brings the rows of a month together first; without it every task writes the months it read.
    With ``table_name`` the table is also declared in the catalog with its partitions
    and statistics (``ANALYZE TABLE``), so SQL users can query it by name.
    """
    write_flights_table(type_flights(read_lake(spark, lake_path, fmt)), table_path, shuffle)
    if table_name:
        return register_flights_table(spark, table_name, table_path, compute_stats)
    return read_flights_table(spark, table_path)


def load_changes(spark: SparkSession, lake_path: str, table_path: str, ledger_path: str,
                 fmt: str = "parquet", shuffle: bool = False) -> DataFrame:
    """Bring the flights table up to date with the lake: only months with new, changed or
    missing files are read and written again. Returns a row per month: Yeard, Monthd, n_files
    (now in the lake), n_changed, status (``new``, ``changed``, ``gone`` or ``kept``).

    The ledger has path, length and modification time of the lake files that the table holds. It
    is written after the table, so that a load that broke off is done again. A month without
    files is removed from the table; a changed month of which no record can be read keeps its
    rows. A file whose path tells no month is an error, as its rows
    could not be told from those of other files; load such a lake as a whole.
    """
    stage = scratch_path(spark, "lake_files")  # one listing, whatever happens to the lake meanwhile
    lake_files(spark, lake_path, fmt).write.parquet(stage)
    now = spark.read.parquet(stage)
    stray = now.where("Yeard is null or Monthd is null").first()
    if stray:
        raise ValueError(f"no month in the path of {stray['path']}")
    number = newest(spark, ledger_path)
    before = spark.createDataFrame([], LEDGER) if number is None else read_version(spark, ledger_path, number)
    old, new = before.alias("old"), now.alias("new")
    differs = ~(F.col("old.length").eqNullSafe(F.col("new.length"))
                & F.col("old.modificationTime").eqNullSafe(F.col("new.modificationTime")))
    months = (old.join(new, F.col("old.path") == F.col("new.path"), "full_outer")
              .groupBy(*(F.coalesce(f"new.{k}", f"old.{k}").alias(k) for k in LAKE_PARTITIONS[:2]))
              .agg(F.count("new.path").alias("n_files"), F.count_if(differs).alias("n_changed"), F.count("old.path").alias("_before"))
              .select(*LAKE_PARTITIONS[:2], "n_files", "n_changed",
                      F.when(F.col("n_files") == 0, "gone").when(F.col("_before") == 0, "new")
                      .when(F.col("n_changed") > 0, "changed").otherwise("kept").alias("status")))
    report_path = scratch_path(spark, "load_report")
    months.write.parquet(report_path)
    report = spark.read.parquet(report_path)
    todo = report.where("status <> 'kept'").collect()  # a row per month
    again = [(F.col("Yeard") == m.Yeard) & (F.col("Monthd") == m.Monthd) for m in todo if m.status != "gone"]
    if again:
        part = reduce(lambda a, b: a | b, again)
        write_flights_table(type_flights(read_lake(spark, lake_path, fmt, part=part)), table_path, shuffle)
    for m in todo:
        if m.status == "gone":
            remove(spark, f"{table_path}/Yeard={int(m.Yeard)}/Monthd={int(m.Monthd)}")
    if todo:
        write_version(spark, ledger_path, lambda _: now)
    return report


def profile(table: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Column profile of the stored table (rows, NULLs, min, max per column)."""
    return column_profile(table, approx_distinct)
