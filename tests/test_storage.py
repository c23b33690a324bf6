"""Lake formats, the flights table in the catalog, partition registration, statistics."""

import os
import time

import pytest
from pyspark.sql import functions as F

from helpers import flights_df
from ontime.config import SELECTED_FIELDS, TABLE_FIELDS
from ontime.plans.ingest import ingest
from ontime.sinks.lake import lake_rows, write_lake
from ontime.sources.lake import (add_month_partition, month_statistics, read_delimited_flights, read_lake,
                                 register_flights_table, type_flights, write_flights_table)
from ontime.sources.streams import file_stream
from ontime.streaming.runner import start_all, read_state


def test_csv_lake_round_trip_and_header_check(spark, workdir):
    f = flights_df(spark, [{"FlightDate": "2008-03-04", "ArrDelay": None, "DepTime": None},
                           {"FlightDate": "2008-03-05", "UniqueCarrier": "B,C"}])
    lake = os.path.join(workdir, "lake")
    write_lake(f, lake, fmt="csv")
    assert sorted(os.listdir(os.path.join(lake, "Yeard=2008", "Monthd=03"))) == ["Dayd=04", "Dayd=05"]
    back = read_lake(spark, lake, "csv")
    rows = {r.Dayd: r for r in back.collect()}
    assert rows["04"].ArrDelay == "" and rows["05"].UniqueCarrier == "B,C"
    # a file whose columns moved is bound by its header
    moved = os.path.join(lake, "Yeard=2008", "Monthd=03", "Dayd=06")
    os.makedirs(moved)
    with open(os.path.join(moved, "x.csv"), "w") as fh:
        fh.write(",".join(reversed(SELECTED_FIELDS)) + "\n" + ",".join(reversed([f"v{c}" for c in SELECTED_FIELDS])) + "\n")
    row = read_lake(spark, lake, "csv").where("Dayd = '06'").collect()[0]
    assert all(row[c] == f"v{c}" for c in SELECTED_FIELDS) and row.Yeard == "2008"


def test_delimited_fact_files_in_table_order(spark, workdir):
    path = os.path.join(workdir, "INPUT", "2008", "03")
    os.makedirs(path)
    row = {"DayOfWeek": "2", "Origin": "ORD", "UniqueCarrier": "AA", "FlightNum": "1", "Dest": "LAX",
           "ArrDelayMinutes": "0", "FlightDate": "2008-03-04", "ArrDelay": "-14.00", "Month": "3",
           "DepDelayMinutes": "5", "DepDelay": "5.00", "CRSArrTime": "1100", "Year": "2008",
           "Cancelled": "0.00", "ArrTime": "1046", "DepTime": "5", "CRSDepTime": "0900",
           "DayofMonth": "4"}
    with open(os.path.join(path, "2008_03_04.csv"), "w") as fh:
        fh.write(",".join(TABLE_FIELDS) + "\n" + ",".join(row[c] for c in TABLE_FIELDS) + "\n")
    # a file filed under another month folder takes the folder's partition values
    other = os.path.join(workdir, "INPUT", "2008", "04")
    os.makedirs(other)
    with open(os.path.join(other, "late.csv"), "w") as fh:
        fh.write(",".join(TABLE_FIELDS) + "\n" + ",".join(row[c] for c in TABLE_FIELDS) + "\n")
    got = sorted(read_delimited_flights(spark, os.path.join(workdir, "INPUT")).collect(),
                 key=lambda r: r.Monthd)
    assert (got[0].ArrDelay, got[0].Cancelled, got[0].DepTime, got[0].Yeard, got[0].Monthd) == \
        (-14, 0, "0005", 2008, 3)
    assert (got[1].Month, got[1].Monthd) == (3, 4)


def test_catalog_table_partitions_and_statistics(spark, workdir):
    f = flights_df(spark, [{"FlightDate": "2008-03-04"}, {"FlightDate": "2008-04-01"}])
    path = os.path.join(workdir, "table")
    write_flights_table(type_flights(lake_rows(f)), path)
    name = f"flights_t{int(time.time() * 1000) % 100000}"
    t = register_flights_table(spark, name, path)
    assert t.count() == 2
    parts = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    assert parts == ["Yeard=2008/Monthd=3", "Yeard=2008/Monthd=4"]
    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Statistics").collect()
    assert stats and "rows" in stats[0].data_type
    detail = spark.sql(f"DESCRIBE EXTENDED {name} PARTITION (Yeard=2008, Monthd=3)").collect()
    assert any(r.col_name == "Partition Statistics" and "1 rows" in r.data_type for r in detail)
    assert sorted(map(tuple, month_statistics(spark, name).collect())) == [(2008, 3, 1), (2008, 4, 1)]
    with pytest.raises(ValueError, match="exists at"):   # the same name at another place
        register_flights_table(spark, name, os.path.join(workdir, "another"))
    # a month stored elsewhere registered as a partition
    other = os.path.join(workdir, "elsewhere")
    write_flights_table(type_flights(lake_rows(flights_df(spark, [{"FlightDate": "2008-05-02"}]))), other)
    add_month_partition(spark, name, 2008, 5, os.path.join(other, "Yeard=2008", "Monthd=5"))
    assert spark.table(name).where("Yeard = 2008 AND Monthd = 5").count() == 1


def test_start_all_runs_three_queries_on_a_trigger(spark, workdir):
    src = os.path.join(workdir, "in")
    f = flights_df(spark, [{"Origin": "A", "Dest": "B", "ArrDelay": 2, "DayOfWeek": 3}])
    lake_rows(f).select(*SELECTED_FIELDS).write.option("header", True).csv(os.path.join(src, "a"))
    qs = start_all(file_stream(spark, src, "csv"), os.path.join(workdir, "run"), show=False,
                   triggers={"1_1": "1 second", "1_2": "1 second", "1_3": "1 second"})
    try:
        for q in qs:
            q.processAllAvailable()
    finally:
        for q in qs:
            q.stop()
    assert read_state(spark, os.path.join(workdir, "run", "state_1_3"), "").collect()[0].weekday == "3"
    assert read_state(spark, os.path.join(workdir, "run", "state_1_1"), "").count() == 2


def test_file_stream_rate_cap_splits_batches(spark, workdir):
    src = os.path.join(workdir, "in")
    for i in range(3):
        f = flights_df(spark, [{"UniqueCarrier": "X", "ArrDelay": i}])
        lake_rows(f).select(*SELECTED_FIELDS).coalesce(1).write.option("header", True) \
            .csv(os.path.join(src, f"d{i}"))
    q = (file_stream(spark, src, "csv", max_files_per_trigger=1).groupBy("UniqueCarrier").count()
         .writeStream.outputMode("complete").format("memory").queryName("capped")
         .option("checkpointLocation", os.path.join(workdir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    assert spark.table("capped").collect()[0]["count"] == 3


def test_ingest_of_empty_listing(spark, workdir):
    raw = os.path.join(workdir, "RAW")
    os.makedirs(raw)
    res = ingest(spark, raw, os.path.join(workdir, "lake"), os.path.join(workdir, "q"),
                 os.path.join(workdir, "s"))
    assert res.manifest.count() == 0 and res.runs.count() == 0


def test_column_profile_with_approx_distinct(spark):
    from ontime.operators.quality import column_profile
    f = flights_df(spark, [{"UniqueCarrier": c, "ArrDelay": d} for c, d in
                           [("A", 1), ("B", None), ("A", 5), ("C", -2)]])
    prof = {r.column: r for r in column_profile(f.select("UniqueCarrier", "ArrDelay"),
                                                approx_distinct=True).collect()}
    assert (prof["UniqueCarrier"].n_rows, prof["UniqueCarrier"].approx_distinct) == (4, 3)
    a = prof["ArrDelay"]
    assert (a.n_nulls, a.min_value, a.max_value, a.approx_distinct) == (1, "-2", "5", 3)


def test_temporary_checkpoint_folder_only_on_a_local_master():
    from types import SimpleNamespace

    from ontime.config import checkpoint_dir

    cluster = SimpleNamespace(
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"),
        conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(cluster)


def test_replay_position_does_not_depend_on_files(spark, workdir):
    from ontime.sinks.replay import replay

    f = flights_df(spark, [{"FlightDate": "2008-03-04", "FlightNum": str(i)} for i in range(6)])
    for files, fmt in ((1, "parquet"), (3, "parquet"), (3, "csv")):
        lake = os.path.join(workdir, f"lake{files}{fmt}")
        write_lake(lake_rows(f).repartition(files), lake, fmt, shuffle=False)
        sent = replay(spark, lake, ["a", "b", "c", "d"], os.path.join(workdir, f"m{files}{fmt}"), fmt=fmt)
        assert sorted(map(tuple, sent.collect())) == [("a", 2), ("b", 2), ("c", 1), ("d", 1)]
