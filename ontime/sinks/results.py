"""Result tables: keyed answers of 2.1-2.4 and the itinerary table of 3.2.

A result table is Parquet at a path (a folder per version), stored under its external
column names. The default write replaces it; ``mode="upsert"`` replaces rows by key and keeps the rest
(what an ``INSERT OVERWRITE`` into a key-value store does). Result tables hold one row
per key (airports x carriers at most), so they are small next to the flights.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..config import scratch_path
from .versions import newest, read_version, write_version

# --- Fixed values: result table layouts (internal name -> external name) ------------
RESULT_TABLES: dict[str, dict] = {
    "2_1": {"columns": {"airport": "Airport", "airline": "Airline",
                        "avg_delay": "AvgDelay", "rank": "Rank"},
            "keys": ["airport", "airline"]},
    "2_2": {"columns": {"origin": "Airport", "dest": "Destination",
                        "avg_delay": "AvgDelay", "rank": "Rank"},
            "keys": ["origin", "dest"]},
    "2_3": {"columns": {"flight": "Flight", "airline": "Airline",
                        "avg_delay": "AvgDelay", "rank": "Rank"},
            "keys": ["flight", "airline"]},
    "2_4": {"columns": {"flight": "Flight", "avg_delay": "AvgDelay"},
            "keys": ["flight"]},
}
RESULT_TYPES = {"airport": StringType(), "airline": StringType(), "origin": StringType(),
                "dest": StringType(), "flight": StringType(), "avg_delay": DoubleType(),
                "rank": LongType()}
# The declared schema of the itinerary table, in order.
ITINERARY_SCHEMA = StructType([
    StructField("x", StringType()), StructField("y", StringType()),
    StructField("airline1", StringType()), StructField("flightnum1", StringType()),
    StructField("flightdate1", StringType()), StructField("departure1", StringType()),
    StructField("delay1", DoubleType()), StructField("z", StringType()),
    StructField("airline2", StringType()), StructField("flightnum2", StringType()),
    StructField("flightdate2", StringType()), StructField("departure2", StringType()),
    StructField("delay2", DoubleType()), StructField("total_delay", DoubleType()),
    StructField("itinerary", StringType()),
])
# ---------------------------------------------------------------------------------


def _external(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(i).cast(RESULT_TYPES[i]).alias(e) for i, e in columns.items()])


def write_result(df: DataFrame, table: str, path: str, mode: str = "overwrite",
                 keys: Sequence[str] | None = None) -> None:
    """Store ``df`` (internal names) as result table ``table`` at ``path``.

    Every write publishes a new version (``sinks/versions.py``); readers take the newest one, so
    they see the old rows or the new ones, never a mixture, and of two writers neither undoes the
    other's upsert. ``upsert`` stages the new rows once and adds the old rows whose key is not
    among them (a ``left_anti`` join).
    """
    spec = RESULT_TABLES[table]
    columns = spec["columns"]
    if mode not in ("overwrite", "upsert"):
        raise ValueError(f"mode must be 'overwrite' or 'upsert', not {mode!r}")
    new = _external(df, columns)
    spark = df.sparkSession
    if mode == "upsert" and newest(spark, path) is not None:
        stage = scratch_path(spark, "upsert")
        new.write.parquet(stage)
        new = spark.read.parquet(stage)
    key_ext = [columns[k] for k in (keys or spec["keys"])]

    def rows(base: int | None) -> DataFrame:
        if mode == "overwrite" or base is None:
            return new
        old = read_version(spark, path, base).select(*new.columns)
        return new.unionByName(old.join(new.select(*key_ext), key_ext, "left_anti").select(*new.columns))

    write_version(spark, path, rows)


def read_result(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Read a result table's newest version back under its internal column names."""
    columns = RESULT_TABLES[table]["columns"]
    number = newest(spark, path)
    if number is None:
        raise ValueError(f"no version of result table {table} at {path}")
    df = read_version(spark, path, number)
    return df.select(*[F.col(e).alias(i) for i, e in columns.items()])


def write_itineraries(df: DataFrame, path: str) -> None:
    """Replace the itinerary table: columns bound by position to the declared schema."""
    if len(df.columns) != len(ITINERARY_SCHEMA):
        raise ValueError("itinerary rows must have the 15 declared columns")
    typed = df.select(*[F.col(c).cast(f.dataType).alias(f.name)
                        for c, f in zip(df.columns, ITINERARY_SCHEMA.fields)])
    typed.write.mode("overwrite").parquet(path)


def read_itineraries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ITINERARY_SCHEMA).parquet(path)
