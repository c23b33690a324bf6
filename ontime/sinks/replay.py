"""Replay the lake as messages: one JSON object per row, spread round robin over topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..config import SELECTED_FIELDS, scratch_path
from ..schema import LAKE_PARTITIONED_SCHEMA
from ..sources.archives import csv_rows, list_files
from ..sources.lake import position_group
from ..sources.ranges import SPLIT_BYTES


def lake_with_positions(spark: SparkSession, lake_path: str, fmt: str = "parquet",
                        split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The lake with each row's position within its day, however many files a day has. Day
    folders may hold several files of a day; elsewhere every file counts on its own.

    A row's position is its index in its file (given by the reader, no window over the rows)
    plus the rows of the day's earlier files, from a table of one row per file.
    """
    if fmt == "csv":
        # Staged, so that the counts per file and the messages need one parse of the files.
        staged = scratch_path(spark, "replay_rows")
        (csv_rows(list_files(spark, lake_path, "*.csv"), split_bytes)
         .select(*SELECTED_FIELDS, F.col("path").alias("_file"), (F.col("record") - 1).alias("_index")).write.parquet(staged))
        df = spark.read.parquet(staged)
    else:
        df = (spark.read.schema(LAKE_PARTITIONED_SCHEMA).parquet(lake_path)
              .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index")))
    earlier = Window.partitionBy("_day").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = (df.groupBy("_file").agg(F.max("_index").alias("_last")).withColumn("_day", position_group(F.col("_file")))
             .select("_file", F.coalesce(F.sum(F.col("_last") + 1).over(earlier), F.lit(0)).alias("_before")))
    # A row per file: broadcast, or a lake of some size would be shuffled and sorted whole for it.
    return df.join(F.broadcast(files), "_file").withColumn("_pos", F.col("_before") + F.col("_index"))


def to_messages(lake: DataFrame, topics: Sequence[str]) -> DataFrame:
    """``(topic, value)``: the i-th row of a day goes to ``topics[i mod n]``.

    The value is the row as a JSON object of strings, NULL fields written as ``null``.
    """
    if not topics:
        raise ValueError("at least one topic is needed")
    topic_arr = F.array(*[F.lit(t) for t in topics])
    value = F.to_json(F.struct(*SELECTED_FIELDS), {"ignoreNullFields": "false"})
    return lake.select(
        F.element_at(topic_arr, (F.col("_pos") % len(topics) + 1).cast("int")).alias("topic"),
        value.alias("value"))


def write_messages(messages: DataFrame, path: str | None = None,
                   brokers: str | None = None) -> None:
    """Publish messages: to Kafka when ``brokers`` is given, else as Parquet at ``path``.

    The Kafka sink takes the per-row ``topic`` column, so one write serves all topics
    (it needs the spark-sql-kafka connector on the classpath).
    """
    if brokers:
        try:
            (messages.write.format("kafka")
             .option("kafka.bootstrap.servers", brokers).save())
        except Exception as exc:
            if "kafka" in str(exc).lower() and "data source" in str(exc).lower():
                from ..sources.streams import KAFKA_MISSING
                raise RuntimeError(KAFKA_MISSING) from exc
            raise
    elif path:
        messages.write.mode("overwrite").option("compression", "zstd").parquet(path)
    else:
        raise ValueError("give a path or brokers")


def replay(spark: SparkSession, lake_path: str, topics: Sequence[str],
           out_path: str | None = None, brokers: str | None = None, fmt: str = "parquet",
           split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Replay the lake; returns the number of messages sent per topic, counted while they
    are written."""
    sent = Observation()
    counts = [F.count_if(F.col("topic") == t).alias(f"n{i}") for i, t in enumerate(topics)]
    messages = to_messages(lake_with_positions(spark, lake_path, fmt, split_bytes), topics).observe(sent, *counts)
    write_messages(messages, out_path, brokers)
    rows = [(t, sent.get.get(f"n{i}", 0)) for i, t in enumerate(topics)]
    return spark.createDataFrame(rows, "topic string, n_messages long").where("n_messages > 0")
