"""Registered ingest and load jobs over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import INT_FIELDS, SELECTED_FIELDS, TABLE_FIELDS, TABLE_PARTITIONS, built_once, scratch_path, shuffles_freed
from ..operators.dealing import deal_by_range
from ..operators.statistics import merged_statistics
from ..sinks.lake import lake_rows, write_day_files, write_lake, write_lines
from ..sinks.replay import replay
from ..sources.archives import BAD_BYTE, CUT_SHORT, deliver_files, list_archives, write_archives, write_broken_archives
from ..sources.lake import lake_bad_records, month_statistics, read_delimited_flights, read_flights_table
from ..sources.streams import file_stream
from ..sources.testdata import stored_flights
from ..streaming.aggregates import AGGREGATES
from ..streaming.runner import run_available
from .ingest import ingest, lake_day_summary
from .load import load, load_changes, profile
from .resume import ingest_changes
from .statistics import read_statistics, update_statistics
from .streams import TOPICS, build_lake, stream_oracles


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver-table flights as raw on-time records: text, wider than the 18 kept columns."""
    text = lake_rows(stored_flights(spark, sf_dir)).select(*SELECTED_FIELDS)
    return text.select(*SELECTED_FIELDS, F.concat(F.lit("N"), F.col("FlightNum")).alias("TailNum"),
                       F.lit("").alias("Distance"))


def by_period(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Rows dealt to archives of contiguous periods, as raw archives are; a day with many
    rows spans several."""
    n = max(spark.sparkContext.defaultParallelism, raw.rdd.getNumPartitions())
    year, month, day = (F.coalesce(F.col(c).try_cast("int").cast("long"), F.lit(0)) for c in ("Year", "Month", "DayofMonth"))
    within = F.xxhash64("FlightNum", "FlightDate", "DepTime").bitwiseAND(0xFFFFFFFF)
    return deal_by_range(raw, F.shiftleft((year * 16 + month) * 32 + day, 32) + within, n)


def send_archives(spark: SparkSession, raw: DataFrame, dest: str) -> None:
    with shuffles_freed(spark):
        write_archives(raw, dest).count()


def ingest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "ingest")
    send_archives(spark, by_period(spark, raw_rows(spark, sf_dir)), f"{base}/RAW")
    result = ingest(spark, f"{base}/RAW", f"{base}/lake", f"{base}/quarantine", f"{base}/stage")
    return lake_day_summary(spark, result.lake_path)


# Which records of the defective archives are cut short, hold a bad byte or a bad day.
SHORT, BAD, NO_DAY = "FlightNum % 107 = 3", "FlightNum % 103 = 5", "FlightNum % 101 = 7"


def defective_ingest(spark: SparkSession, sf_dir: str) -> str:
    """Ingest of archives with defects in them, and of two broken ones; its folder."""
    def build(base: str) -> None:
        raw = by_period(spark, raw_rows(spark, sf_dir))
        # The defects go into columns that are dealt to every place of a record.
        raw = (raw.withColumn("DayofMonth", F.when(F.expr(NO_DAY), F.lit("31x")).otherwise(F.col("DayofMonth")))
               .withColumn("UniqueCarrier", F.when(F.expr(BAD), F.concat("UniqueCarrier", F.lit(BAD_BYTE)))
                           .otherwise(F.col("UniqueCarrier")))
               .withColumn("Origin", F.when(F.expr(SHORT), F.concat("Origin", F.lit(CUT_SHORT))).otherwise(F.col("Origin")))
               .withColumn("Dest", F.when(F.expr(SHORT), F.concat("Dest", F.lit(CUT_SHORT))).otherwise(F.col("Dest"))))
        send_archives(spark, raw, f"{base}/RAW")
        write_broken_archives(spark, f"{base}/RAW").count()
        result = ingest(spark, f"{base}/RAW", f"{base}/lake", f"{base}/quarantine", f"{base}/stage")
        result.manifest.write.parquet(f"{base}/manifest")

    return built_once(spark, sf_dir, "defective_ingest", build)


def ingest_manifest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = spark.read.parquet(f"{defective_ingest(spark, sf_dir)}/manifest")
    return manifest.groupBy("status").agg(
        F.count("error").alias("errors"), *(F.sum(c).alias(f"n_{c}") for c in ("read", "kept", "skipped", "written")))


def ingest_quarantine_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = spark.read.parquet(f"{defective_ingest(spark, sf_dir)}/quarantine")
    return records.groupBy("reason").agg(F.count(F.lit(1)).alias("n_records"))


#: Archives that arrive incomplete at first.
INCOMPLETE = "crc32(cast(regexp_extract(path, '[^/]+$', 0) as binary)) % 3 = 0"


def ingest_resume_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest of archives of which some are incomplete, and again when those have arrived
    whole: the days of the lake, and whether the second run read exactly the failed ones."""
    base = scratch_path(spark, "ingest_resume")
    send_archives(spark, by_period(spark, raw_rows(spark, sf_dir)), f"{base}/sent")
    sent = list_archives(spark, f"{base}/sent")
    deliver_files(sent, f"{base}/RAW", INCOMPLETE).count()
    first = ingest_changes(spark, f"{base}/RAW", f"{base}/lake", f"{base}/ledger")
    deliver_files(sent.where(INCOMPLETE), f"{base}/RAW").count()
    second = ingest_changes(spark, f"{base}/RAW", f"{base}/lake", f"{base}/ledger")
    runs = first.select("path", F.col("status").alias("before")).join(second, "path", "full_outer")
    right = (F.col("before") == "ERROR") == (F.col("action") == "failed")
    resumed = runs.agg(F.coalesce(F.every(right & (F.col("status") == "OK")), F.lit(True))).first()[0]
    return lake_day_summary(spark, f"{base}/lake").withColumn("resumed", F.lit(resumed))


def csv_files(spark: SparkSession, sf_dir: str) -> str:
    """The flights as CSV files of two column orders in one folder."""
    def build(base: str) -> None:
        text = lake_rows(stored_flights(spark, sf_dir))
        for name, columns, rest in (("a", SELECTED_FIELDS, 0), ("b", TABLE_FIELDS, 1)):
            (text.where(F.col("DayofMonth").cast("int") % 2 == rest).select(*columns)
             .write.option("header", True).option("emptyValue", "").csv(f"{base}/files/{name}"))

    return f"{built_once(spark, sf_dir, 'csv_files', build)}/files"


def scan_csv_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan_summary(read_delimited_flights(spark, csv_files(spark, sf_dir)))


def _scan_summary(table: DataFrame) -> DataFrame:
    return table.groupBy(F.col("Yeard").alias("year"), F.col("Monthd").alias("month")).agg(
        F.count(F.lit(1)).alias("n_flights"), F.sum("ArrDelay").alias("arr_delay_sum"),
        F.count_distinct("Origin", "Dest").alias("n_routes"), F.max("UniqueCarrier").alias("last_carrier"),
        F.min("DepTime").alias("first_departure"))


#: Small ranges, so that the files of the registered queries are split as large ones are.
SMALL_SPLIT = 1 << 20


def scan_csv_split_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan_summary(read_delimited_flights(spark, csv_files(spark, sf_dir), SMALL_SPLIT))


def day_file_lake(spark: SparkSession, sf_dir: str) -> str:
    """The flights as one CSV file per day in month folders."""
    def build(base: str) -> None:
        text = lake_rows(stored_flights(spark, sf_dir))
        write_day_files(text, f"{base}/lake").write.parquet(f"{base}/files")

    return f"{built_once(spark, sf_dir, 'day_file_lake', build)}/lake"


def load_day_files_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, day_file_lake(spark, sf_dir), scratch_path(spark, "flights_table"), fmt="csv", shuffle=True)
    return _scan_summary(table)


def replay_day_files_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(spark, day_file_lake(spark, sf_dir), TOPICS, out_path=scratch_path(spark, "messages"), fmt="csv")


def csv_bad_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that a scan of damaged CSV files leaves out, by month folder and reason."""
    def build(base: str) -> None:
        text = lake_rows(stored_flights(spark, sf_dir))
        # A cut record has its first nine fields only.
        fields = F.when(F.expr(SHORT), F.concat_ws(",", *SELECTED_FIELDS[:9])).otherwise(F.concat_ws(",", *SELECTED_FIELDS))
        path = F.concat_ws("/", F.lit(f"{base}/lake"), "Yeard", "Monthd", F.lit("flights.csv"))
        write_lines(text.select(path.alias("path"), fields.alias("line")), ",".join(SELECTED_FIELDS)).write.parquet(f"{base}/files")

    path = f"{built_once(spark, sf_dir, 'damaged_csv', build)}/lake"
    bad = lake_bad_records(spark, path, SMALL_SPLIT)
    return bad.groupBy(F.col("Yeard").cast("int").alias("year"), F.col("Monthd").cast("int").alias("month"), "reason").agg(
        F.count(F.lit(1)).alias("n_records"))


def csv_stream_job(name: str):
    fn = AGGREGATES[name][0]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stream = file_stream(spark, csv_files(spark, sf_dir), "csv")
        base = scratch_path(spark, f"csv_stream_{name}")
        return run_available(fn(stream), f"csv_stream_{name}", f"{base}/checkpoint", f"{base}/state")

    return run


def replay_csv_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = built_once(spark, sf_dir, "csv_lake",
                      lambda base: write_lake(lake_rows(stored_flights(spark, sf_dir)), f"{base}/lake", "csv", shuffle=False))
    return replay(spark, f"{path}/lake", TOPICS, out_path=scratch_path(spark, "messages"), fmt="csv")


def load_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, build_lake(spark, sf_dir), scratch_path(spark, "flights_table"),
                 table_name=f"flights_{uuid.uuid4().hex[:8]}")
    return profile(table)


def load_stats_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"flights_{uuid.uuid4().hex[:8]}"
    load(spark, build_lake(spark, sf_dir), scratch_path(spark, "flights_table"), table_name=name)
    return month_statistics(spark, name)


#: The day that is delivered again, without its cancelled flights.
CHANGED_DAY = (2000, 6, 15)


def load_again_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake loaded, one of its days delivered again and the lake loaded again: the table's
    months, and whether the second load wrote them."""
    rows = lake_rows(stored_flights(spark, sf_dir))
    base = scratch_path(spark, "load_again")
    write_lake(rows, f"{base}/lake")
    load_changes(spark, f"{base}/lake", f"{base}/table", f"{base}/ledger")
    year, month, day = CHANGED_DAY
    again = rows.where(f"Yeard = '{year}' AND Monthd = '{month:02d}' AND Dayd = '{day:02d}' AND Cancelled = '0'")
    write_lake(again, f"{base}/lake")
    report = load_changes(spark, f"{base}/lake", f"{base}/table", f"{base}/ledger")
    written = report.select(F.col("Yeard").cast("int").alias("year"), F.col("Monthd").cast("int").alias("month"),
                            (F.col("status") != "kept").alias("reloaded"))
    return _scan_summary(read_flights_table(spark, f"{base}/table")).join(written, ["year", "month"])


def column_stats_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a table whose one day was loaded again, merged from those stored per
    month, and how many months the second update read."""
    rows = lake_rows(stored_flights(spark, sf_dir))
    base = scratch_path(spark, "column_stats")
    write_lake(rows, f"{base}/lake")
    load_changes(spark, f"{base}/lake", f"{base}/table", f"{base}/ledger")
    update_statistics(spark, f"{base}/table", f"{base}/statistics")
    year, month, day = CHANGED_DAY
    write_lake(rows.where(f"Yeard = '{year}' AND Monthd = '{month:02d}' AND Dayd = '{day:02d}' AND Cancelled = '0'"), f"{base}/lake")
    load_changes(spark, f"{base}/lake", f"{base}/table", f"{base}/ledger")
    scanned = update_statistics(spark, f"{base}/table", f"{base}/statistics")
    merged = merged_statistics(read_statistics(spark, f"{base}/statistics"))
    return merged.select("column", "n_rows", "n_nulls", "min_value", "max_value", F.lit(len(scanned)).cast("long").alias("months_read"))


def pipeline_jobs() -> dict:
    return {"ing": ingest_job, "load": load_job, "ing_manifest": ingest_manifest_job, "ing_resume": ingest_resume_job,
            "ing_quarantine": ingest_quarantine_job, "scan_csv": scan_csv_job, "replay_csv": replay_csv_job,
            "load_stats": load_stats_job, "scan_csv_split": scan_csv_split_job, "csv_bad": csv_bad_job,
            "load_day_files": load_day_files_job, "load_again": load_again_job, "column_stats": column_stats_job, "replay_day_files": replay_day_files_job, **{f"s{n}_csv": csv_stream_job(n) for n in AGGREGATES}}


def pipeline_oracles(flights_cte: str) -> dict[str, str]:
    f = flights_cte

    def profile_sql(more: str = "", where: str = "") -> str:
        parts = []
        for c in TABLE_FIELDS + TABLE_PARTITIONS:
            v = c if (c in INT_FIELDS or c in TABLE_PARTITIONS) else f"coalesce({c}, '')"
            parts.append(f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({v}) AS n_nulls, "
                         f"CAST(min({v}) AS VARCHAR) AS min_value, CAST(max({v}) AS VARCHAR) AS max_value{more} "
                         f"FROM flights {where}")
        return f + "\nUNION ALL\n".join(parts)

    number = "CAST(FlightNum AS BIGINT)"
    short, bad, no_day = (x.replace("FlightNum", number) for x in (SHORT, BAD, NO_DAY))
    streams = stream_oracles(f)
    def scan_sql(more: str = "", where: str = "") -> str:
        return f + f"""SELECT Yeard AS year, Monthd AS month, count(*) AS n_flights, sum(ArrDelay) AS arr_delay_sum,
  count(DISTINCT Origin || '>' || Dest) AS n_routes, max(UniqueCarrier) AS last_carrier,
  min(coalesce(DepTime, '')) AS first_departure{more}
FROM flights {where} GROUP BY Yeard, Monthd"""

    def days_sql(more: str = "") -> str:
        return f + f"""SELECT Year AS year, Month AS month, DayofMonth AS day, count(*) AS n_flights,
  sum(CAST(ArrDelay AS DOUBLE)) AS arr_delay_sum,
  CAST(count(*) FILTER (WHERE Cancelled = 1) AS BIGINT) AS n_cancelled{more}
FROM flights GROUP BY Year, Month, DayofMonth"""

    year, month, day = CHANGED_DAY
    on_day = f"Year = {year} AND Month = {month} AND DayofMonth = {day}"
    return {
        **{f"s{n}_csv": streams[f"k{n}"] for n in AGGREGATES},
        "replay_csv": streams["replay"],
        "replay_day_files": streams["replay"],
        **dict.fromkeys(["scan_csv_split", "load_day_files", "scan_csv"], scan_sql()),
        "load_again": scan_sql(f", Yeard = {year} AND Monthd = {month} AS reloaded", f"WHERE NOT ({on_day} AND Cancelled <> 0)"),
        "csv_bad": f + f"""SELECT Yeard AS year, Monthd AS month, 'malformed record' AS reason, count(*) AS n_records
FROM flights WHERE {short} GROUP BY Yeard, Monthd""",
        "load_stats": f + "SELECT Yeard, Monthd, count(*) AS n_rows FROM flights GROUP BY Yeard, Monthd",
        "ing_manifest": f + f"""SELECT 'OK' AS status, 0 AS errors, count(*) AS n_read,
  count(*) FILTER (NOT ({short} OR {bad} OR {no_day})) AS n_kept,
  count(*) FILTER ({short} OR {bad} OR {no_day}) AS n_skipped,
  count(*) FILTER (NOT ({short} OR {bad} OR {no_day})) AS n_written FROM flights
UNION ALL SELECT 'ERROR', 2, 0, 0, 0, 0""",
        "ing_quarantine": f + f"""SELECT CASE WHEN {short} THEN 'malformed record' WHEN {bad} THEN 'undecodable text'
  ELSE 'DayofMonth is not a number' END AS reason, count(*) AS n_records
FROM flights WHERE {short} OR {bad} OR {no_day} GROUP BY 1""",
        "ing_resume": days_sql(", true AS resumed"),
        "ing": days_sql(),
        "load": profile_sql(),
        "column_stats": profile_sql(", CAST(1 AS BIGINT) AS months_read", f"WHERE NOT ({on_day} AND Cancelled <> 0)"),
    }
