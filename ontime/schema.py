"""Schemas of the lake, the flights table and the messages."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .config import INT_FIELDS, LAKE_PARTITIONS, SELECTED_FIELDS, TABLE_FIELDS, TABLE_PARTITIONS

# Clean lake: the 18 columns as text (empty fields kept as ''), plus day partitions.
LAKE_SCHEMA = StructType([StructField(c, StringType()) for c in SELECTED_FIELDS])
LAKE_PARTITIONED_SCHEMA = StructType(
    LAKE_SCHEMA.fields + [StructField(c, StringType()) for c in LAKE_PARTITIONS])

# Flights table: typed columns in table order, plus month partitions.
FLIGHTS_SCHEMA = StructType(
    [StructField(c, IntegerType() if c in INT_FIELDS else StringType()) for c in TABLE_FIELDS]
    + [StructField(c, IntegerType()) for c in TABLE_PARTITIONS])

# A replayed message: one JSON object per lake row, every field a string.
MESSAGE_SCHEMA = LAKE_SCHEMA
MESSAGE_ROW_SCHEMA = StructType([StructField("topic", StringType()),
                                 StructField("value", StringType())])
