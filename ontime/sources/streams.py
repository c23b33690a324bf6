"""Streaming sources: files dropped in a folder, Kafka topics, replayed messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from ..schema import LAKE_PARTITIONED_SCHEMA, MESSAGE_ROW_SCHEMA, MESSAGE_SCHEMA
from .archives import csv_rows


# The layout of the file-listing source; streams want it stated.
FILES_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _capped(reader: DataStreamReader, max_files: int | None, max_bytes: int | None) -> DataStreamReader:
    if max_files and max_bytes:
        raise ValueError("cap a batch by files or by bytes, not by both")
    if max_files:
        return reader.option("maxFilesPerTrigger", max_files)
    return reader.option("maxBytesPerTrigger", max_bytes) if max_bytes else reader


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                schema: StructType | None = None, max_files_per_trigger: int | None = None,
                glob: str | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """New files under ``path`` become rows.

    CSV files are bound to the lake's 18 text columns by their header, whatever their column
    order (the stream is one of file paths, which the executors open); empty fields stay
    ``''``. Nested ``YYYY/MM`` folders are searched recursively.
    Parquet lakes are read with their day partitions.

    A batch takes new files up to ``max_files_per_trigger`` of them or ``max_bytes_per_trigger``
    bytes (one file at least), so its size follows from the files, not from their number. Only
    one of the two can be given.
    """
    reader = _capped(spark.readStream, max_files_per_trigger, max_bytes_per_trigger)
    if glob or fmt == "csv":
        reader = reader.option("pathGlobFilter", glob or "*.csv")
    if fmt == "csv":
        files = reader.schema(FILES_SCHEMA).format("binaryFile").option("recursiveFileLookup", True).load(path)
        return csv_rows(files.select("path")).drop("path", "record")
    return reader.schema(schema or LAKE_PARTITIONED_SCHEMA).format(fmt).load(path)


def kafka_stream(spark: SparkSession, brokers: str, topics: Sequence[str] | str,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Messages of one or more topics from the earliest offset, as ``(topic, value)``.

    Progress is kept in the query's checkpoint, so a new checkpoint re-reads the topics
    from the start, like a fresh consumer group. Needs the spark-sql-kafka connector.
    """
    subscribe = topics if isinstance(topics, str) else ",".join(topics)
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", brokers)
              .option("subscribe", subscribe)
              .option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    try:
        raw = reader.load()
    except Exception as exc:
        if "kafka" in str(exc).lower() and "data source" in str(exc).lower():
            raise RuntimeError(KAFKA_MISSING) from exc
        raise
    return raw.select(F.col("topic"), F.col("value").cast("string").alias("value"))


KAFKA_MISSING = ("the Kafka connector (org.apache.spark:spark-sql-kafka-0-10) is not on the "
                 "classpath; add it with --packages or spark.jars.packages")


def message_stream(spark: SparkSession, path: str,
                   max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Replayed messages stored as files (``topic, value``), read as a stream."""
    reader = _capped(spark.readStream.schema(MESSAGE_ROW_SCHEMA), max_files_per_trigger, max_bytes_per_trigger)
    return reader.parquet(path)


def parse_messages(messages: DataFrame) -> DataFrame:
    """JSON values -> the 18 text columns (same parser for Kafka and for files).

    A malformed value gives a row of NULLs, and a missing field a NULL; consumers skip
    rows whose key is NULL instead of failing.
    """
    parsed = F.from_json(F.col("value"), MESSAGE_SCHEMA, {"mode": "PERMISSIVE"})
    return messages.select(parsed.alias("m")).select("m.*")


def rate_cap(records_per_partition_per_s: int, partitions: int, interval_s: float) -> int:
    """``maxOffsetsPerTrigger`` equivalent of a per-partition records/second cap."""
    return int(records_per_partition_per_s * partitions * interval_s)
