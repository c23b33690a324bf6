"""Reading the clean lake and the typed flights table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import INT_FIELDS, LAKE_PARTITIONS, SELECTED_FIELDS, TABLE_FIELDS, TABLE_PARTITIONS, write_partitioned
from ..functions import keep_string, pad_hhmm, to_int
from ..schema import FLIGHTS_SCHEMA, LAKE_PARTITIONED_SCHEMA
from .archives import csv_bad, csv_rows, list_files
from .ranges import SPLIT_BYTES

TIME_FIELDS = ["CRSDepTime", "DepTime", "CRSArrTime", "ArrTime"]


DAY_FOLDER = r"Yeard=([0-9]{4})/Monthd=([0-9]{2})/Dayd=([0-9]{2})/[^/]+$"
#: One file per day in month folders, named by its day: ``2008/10/2008_10_05.csv``.
DAY_FILE = r"/([0-9]{4})/([0-9]{1,2})/[^/]*?([0-9]{4})_([0-9]{1,2})_([0-9]{1,2})[^/0-9]*$"


def day_of_path(path: str = "path") -> tuple[Column, Column, Column]:
    """Year, month and day that a lake path tells, as zero-padded text: of day folders, of day
    files in month folders, or of month folders alone (then without a day). Null where it
    tells none."""
    def part(pattern: str, group: int, width: int) -> Column:
        return F.lpad(F.nullif(F.regexp_extract(path, pattern, group), F.lit("")), width, "0")

    return (F.coalesce(part(DAY_FOLDER, 1, 4), part(DAY_FILE, 3, 4), part(MONTH_FOLDER, 1, 4)),
            F.coalesce(part(DAY_FOLDER, 2, 2), part(DAY_FILE, 4, 2), part(MONTH_FOLDER, 2, 2)),
            F.coalesce(part(DAY_FOLDER, 3, 2), part(DAY_FILE, 5, 2)))


def position_group(path: Column) -> Column:
    """What positions are counted in: the folder of a day that may have several files, else
    the file."""
    return F.when(path.rlike(DAY_FOLDER), F.regexp_replace(path, r"/[^/]+$", "")).otherwise(path)


def with_day(files: DataFrame) -> DataFrame:
    """Files with the day keys that their paths tell."""
    return files.select("*", *(c.alias(k) for c, k in zip(day_of_path(), LAKE_PARTITIONS)))


def lake_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The lake's files: path, length, modificationTime, day keys. Contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}")
             .option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime"))
    return with_day(files)


def read_lake(spark: SparkSession, path: str, fmt: str = "parquet", split_bytes: int = SPLIT_BYTES,
              part: Column | None = None) -> DataFrame:
    """The clean lake as text columns plus its day partitions, or the ``part`` of its files that
    a condition on the day keys names (other files are not read).

    CSV files are bound by header name, whatever their column order; empty fields stay ``''``.
    The day comes from the path, in any layout of ``day_of_path``, and where that tells no
    day, from the record's own Year, Month and DayofMonth.
    """
    if fmt == "csv":
        files = list_files(spark, path, "*.csv")
        if part is not None:
            files = with_day(files).where(part).select("path", "length")
        rows = csv_rows(files, split_bytes)
        own = [F.lpad(F.col(c).try_cast("int").cast("string"), w, "0") for c, w in (("Year", 4), ("Month", 2), ("DayofMonth", 2))]
        return rows.select(*SELECTED_FIELDS, *(F.coalesce(told, kept).alias(k)
                                               for told, kept, k in zip(day_of_path(), own, LAKE_PARTITIONS)))
    rows = spark.read.schema(LAKE_PARTITIONED_SCHEMA).format(fmt).load(path)
    return rows if part is None else rows.where(part)


def lake_bad_records(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of a CSV lake that reading leaves out: path, day keys, record, reason, text."""
    bad = csv_bad(list_files(spark, path, "*.csv"), split_bytes)
    return bad.select("path", *(c.alias(k) for c, k in zip(day_of_path(), LAKE_PARTITIONS)), "record", "reason", "text")


MONTH_FOLDER = r"/([0-9]{4})/([0-9]{1,2})/[^/]+$"


def read_delimited_flights(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Headered CSV files (the fact-table text layout, in any column order), typed.

    Files sit in ``.../YYYY/MM/`` folders; as with a registered partition, ``Yeard`` and
    ``Monthd`` are the folder's values, falling back to the Year/Month columns for files
    outside such folders.
    """
    df = csv_rows(list_files(spark, path, "*.csv"), split_bytes)
    year = F.nullif(F.regexp_extract("path", MONTH_FOLDER, 1), F.lit(""))
    month = F.nullif(F.regexp_extract("path", MONTH_FOLDER, 2), F.lit(""))
    return type_flights(df.withColumn("Yeard", F.coalesce(year, F.col("Year")))
                          .withColumn("Monthd", F.coalesce(month, F.col("Month"))))


def type_flights(lake: DataFrame) -> DataFrame:
    """Lake text -> flights table types.

    Integers go through double (``'-14.00'`` -> -14; anything else NULL), text columns
    keep ``''`` for empty fields, all-digit clock times are left-padded to 4 digits so
    the text compare with ``'1200'`` is right. ``Yeard``/``Monthd`` come from the lake's
    partition folders when present, else from Year/Month.
    """
    cols = []
    for c in TABLE_FIELDS:
        if c in INT_FIELDS:
            cols.append(to_int(c).alias(c))
        elif c in TIME_FIELDS:
            cols.append(pad_hhmm(keep_string(c)).alias(c))
        else:
            cols.append(keep_string(c).alias(c))
    year = to_int("Yeard") if "Yeard" in lake.columns else to_int("Year")
    month = to_int("Monthd") if "Monthd" in lake.columns else to_int("Month")
    return lake.select(*cols, year.alias("Yeard"), month.alias("Monthd"))


def write_flights_table(flights: DataFrame, path: str, shuffle: bool = True) -> None:
    """Store typed flights as Parquet partitioned by month (``Yeard``, ``Monthd``).

    Dynamic overwrite replaces the months present and keeps the others. With ``shuffle``
    rows are rebalanced on the partition keys first, so a month becomes a few large files
    and a hot month is split by AQE; without it each task writes the months it holds, which
    is right for input that is already laid out by period, as the lake is.
    """
    if shuffle:
        flights = flights.hint("rebalance", *TABLE_PARTITIONS)
    write_partitioned(flights, path, "parquet", TABLE_PARTITIONS)


def read_flights_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored flights table; filters on ``Yeard``/``Monthd`` prune folders."""
    return spark.read.schema(FLIGHTS_SCHEMA).parquet(path)


def register_flights_table(spark: SparkSession, name: str, path: str,
                           compute_stats: bool = True) -> DataFrame:
    """Declare the stored table in the catalog, register its month partitions and compute
    partition, table and column statistics. A table of that name at another place is an
    error: its rows would be returned instead."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FLIGHTS_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"PARTITIONED BY ({', '.join(TABLE_PARTITIONS)}) LOCATION '{path}'")
    described = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    if _plain(described) != _plain(path):
        raise ValueError(f"table {name} exists at {described}, not at {path}")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    if compute_stats:
        spark.sql(f"ANALYZE TABLE {name} PARTITION ({', '.join(TABLE_PARTITIONS)}) COMPUTE STATISTICS")
        # Counts the table's rows as well.
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    return spark.table(name)


def _plain(path: str) -> str:
    """A path without the marks of the local file system."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def month_statistics(spark: SparkSession, name: str) -> DataFrame:
    """``(Yeard, Monthd, n_rows)`` per month partition, as the catalog's statistics have it."""
    rows = []
    for (spec,) in spark.sql(f"SHOW PARTITIONS {name}").collect():  # a row per month
        values = dict(x.split("=") for x in spec.split("/"))
        clause = ", ".join(f"{k}={v}" for k, v in values.items())
        text = spark.sql(f"DESCRIBE EXTENDED {name} PARTITION ({clause})").where(
            "col_name = 'Partition Statistics'").first()
        found = re.search(r"(\d+) rows", text["data_type"]) if text else None
        rows.append((*(int(values[k]) for k in TABLE_PARTITIONS), int(found[1]) if found else None))
    return spark.createDataFrame(rows, "Yeard int, Monthd int, n_rows long")


def add_month_partition(spark: SparkSession, name: str, year: int, month: int,
                        location: str) -> None:
    """Register one month folder (anywhere) as partition ``(Yeard, Monthd)``."""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION "
              f"(Yeard={int(year)}, Monthd={int(month)}) LOCATION '{location}'")
