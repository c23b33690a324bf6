"""Registered streaming jobs over the driver's tables.

``s*``: ``lineitem`` files of the scale-factor folder are the file stream (flights are
completed by stream-static joins with the other tables). ``replay``: the flights are
written as a day-partitioned lake and replayed as messages. ``k*``: the replayed
messages are read as a stream through the same parser as Kafka values. All run with
``availableNow`` into a fresh checkpoint and return the final state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import built_once, scratch_path
from ..sinks.lake import lake_rows, write_lake
from ..sinks.replay import replay
from ..sources.streams import file_stream, message_stream, parse_messages
from ..sources.testdata import flights, stored_flights
from ..streaming.aggregates import AGGREGATES, report_order
from ..streaming.runner import read_together, report, run_available, start_together, stored_state

# --- Replay parameters: the topics messages are spread over ------------------------
TOPICS = ["flights-t1", "flights-t2", "flights-t3", "flights-t4"]
# ---------------------------------------------------------------------------------

STREAM_COLUMNS = {
    "1_1": ["Origin", "Dest"],
    "1_2": ["UniqueCarrier", "ArrDelay"],
    "1_3": ["DayOfWeek", "ArrDelay"],
}


def lineitem_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a file stream (a folder plus a name filter; a file path is not a
    valid stream source)."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").schema
    return file_stream(spark, sf_dir, fmt="parquet", schema=schema, glob="lineitem.parquet")


def file_stream_job(name: str):
    fn = AGGREGATES[name][0]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stream = lineitem_stream(spark, sf_dir)
        agg = fn(flights(spark, sf_dir, STREAM_COLUMNS[name], lineitem=stream))
        base = scratch_path(spark, f"stream_{name}")
        return run_available(agg, f"file_stream_{name}", f"{base}/checkpoint", f"{base}/state")

    run.__name__ = f"s{name}"
    return run


def build_lake(spark: SparkSession, sf_dir: str) -> str:
    """Write the driver-table flights as a clean lake once per application; its path.

    The lake is derived data (like a materialised view of the tables): replay, the
    message streams and the load all read the same copy. The stored flights lie by month, so
    their days are written where they are.
    """
    path = built_once(spark, sf_dir, "lake",
                      lambda base: write_lake(lake_rows(stored_flights(spark, sf_dir)), f"{base}/lake", shuffle=False))
    return f"{path}/lake"


def replay_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = build_lake(spark, sf_dir)
    return replay(spark, lake, TOPICS, out_path=scratch_path(spark, "messages"))


def replayed_messages(spark: SparkSession, sf_dir: str) -> str:
    """Replay the lake to message files once per application; their folder."""
    path = built_once(spark, sf_dir, "messages",
                      lambda base: replay(spark, build_lake(spark, sf_dir), TOPICS, out_path=f"{base}/files"))
    return f"{path}/files"


def message_stream_job(name: str):
    fn = AGGREGATES[name][0]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        messages = replayed_messages(spark, sf_dir)
        agg = fn(parse_messages(message_stream(spark, messages)))
        base = scratch_path(spark, f"messages_{name}")
        return run_available(agg, f"message_stream_{name}", f"{base}/checkpoint",
                             f"{base}/state")

    run.__name__ = f"k{name}"
    return run


def restarted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """1.1 over half of the messages, stopped, and started again when the rest is there: the
    published state, and the checkpoint that it came back from."""
    messages = spark.read.parquet(replayed_messages(spark, sf_dir))
    base = scratch_path(spark, "restart")
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    for part in (0, 1):
        messages.where(half == part).write.mode("append").option("compression", "zstd").parquet(f"{base}/files")
        agg = AGGREGATES["1_1"][0](parse_messages(message_stream(spark, f"{base}/files")))
        state = run_available(agg, "restart", f"{base}/checkpoint", f"{base}/state")
    return state, f"{base}/checkpoint"


def restart_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restarted(spark, sf_dir)[0]


def stored_state_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregation state in the checkpoint after a restart, beside the published one."""
    published, checkpoint = restarted(spark, sf_dir)
    stored = stored_state(spark, checkpoint).select("airport", F.col("state.count").alias("in_checkpoint"))
    return published.join(stored, "airport", "full_outer")


def running_together(spark: SparkSession, sf_dir: str) -> str:
    """All three aggregates over the messages of all topics in one application."""
    base = scratch_path(spark, "together")
    messages = message_stream(spark, replayed_messages(spark, sf_dir))
    start_together(parse_messages(messages), base, show=False, available_now=True).awaitTermination()
    return base


def all_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = running_together(spark, sf_dir)
    values = {"1_1": ("airport", "total_flights"), "1_2": ("airline", "avg_delay"), "1_3": ("weekday", "avg_delay")}
    parts = [read_together(spark, base, n).select(
        F.lit(n).alias("measure"), F.col(k).alias("key"), F.col(v).cast("double").alias("value"))
        for n, (k, v) in values.items()]
    return parts[0].union(parts[1]).union(parts[2])


def report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the busiest airports: the first ten of the current state."""
    state = message_stream_job("1_1")(spark, sf_dir)
    rows = report(state, report_order("1_1"), "1_1", out=lambda line: None)
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], "place int, airport string, total_flights long")


def stream_jobs() -> dict:
    jobs = {"s1_1_restart": restart_job, "state_after_restart": stored_state_job, "k_all": all_job, "report_top10": report_job}
    for name in AGGREGATES:
        jobs[f"s{name}"] = file_stream_job(name)
        jobs[f"k{name}"] = message_stream_job(name)
    jobs["replay"] = replay_job
    return jobs


def stream_oracles(flights_cte: str) -> dict[str, str]:
    f = flights_cte

    def mean(key_expr: str, key: str) -> str:
        d = "coalesce(TRY_CAST(ArrDelay AS DOUBLE), 0)"
        return (f + f"SELECT {key_expr} AS {key}, sum({d}) AS sum_delay, count(*) AS n_flights, "
                f"sum({d}) / count(*) AS avg_delay FROM flights WHERE {key_expr} IS NOT NULL "
                f"GROUP BY {key_expr}")

    traffic = f + """SELECT airport, count(*) AS total_flights FROM (
  SELECT Origin AS airport FROM flights UNION ALL SELECT Dest AS airport FROM flights) s
WHERE airport IS NOT NULL GROUP BY airport"""
    topics = ", ".join(f"({i}, '{t}')" for i, t in enumerate(TOPICS))
    n = len(TOPICS)
    def one(name: str, sql: str, key: str, value: str) -> str:
        body = sql.removeprefix(f)
        return f"SELECT '{name}' AS measure, {key} AS key, CAST({value} AS DOUBLE) AS value FROM ({body}) q{name}"

    weekday = mean("CAST(DayOfWeek AS VARCHAR)", "weekday")
    return {
        "s1_1_restart": traffic,
        "state_after_restart": f + f"SELECT *, total_flights AS in_checkpoint FROM ({traffic.removeprefix(f)}) t",
        "k_all": f + "\nUNION ALL\n".join((one("1_1", traffic, "airport", "total_flights"),
                                           one("1_2", mean("UniqueCarrier", "airline"), "airline", "avg_delay"),
                                           one("1_3", weekday, "weekday", "avg_delay"))),
        "report_top10": f + f"""SELECT CAST(row_number() OVER (ORDER BY total_flights DESC, airport) AS INTEGER) AS place,
  airport, total_flights FROM ({traffic.removeprefix(f)}) t ORDER BY place LIMIT 10""",
        "s1_1": traffic,
        "k1_1": traffic,
        "s1_2": mean("UniqueCarrier", "airline"),
        "k1_2": mean("UniqueCarrier", "airline"),
        "s1_3": mean("DayOfWeek", "weekday"),
        "k1_3": weekday,
        # The i-th row of a day goes to topic i mod n, however many files the day has.
        "replay": f + f"""SELECT t.topic, CAST(sum((d.n - t.i + {n - 1}) // {n}) AS BIGINT) AS n_messages
FROM (SELECT Year, Month, DayofMonth, count(*) AS n FROM flights GROUP BY 1, 2, 3) d,
     (VALUES {topics}) t(i, topic)
GROUP BY t.topic""",
    }
