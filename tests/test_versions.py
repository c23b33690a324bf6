"""Versioned result tables with several writers; incremental load."""

import os
import shutil
import threading

import pytest

from helpers import flights_df
from ontime.plans.load import load_changes
from ontime.sinks.lake import lake_rows, write_lake
from ontime.sinks.results import read_result, write_result
from ontime.sinks.versions import newest, remove_old_versions, versions, write_version
from ontime.sources.lake import read_flights_table

ROW = "flight string, avg_delay double"


def test_a_writer_that_comes_second_merges_again(spark, workdir):
    path = os.path.join(workdir, "t")
    calls = []

    def rows(base):
        calls.append(base)
        if len(calls) == 1:  # another writer publishes while this one is at work
            write_version(spark, path, lambda _: spark.range(5).toDF("x"))
        return spark.range(1).selectExpr(f"{-1 if base is None else base} AS x")

    assert write_version(spark, path, rows) == 1
    assert calls == [None, 0] and versions(spark, path) == [0, 1]
    assert [r.x for r in spark.read.parquet(f"{path}/version=1").collect()] == [0]
    assert not [f for f in os.listdir(path) if f.startswith("_writing")]


def test_two_writers_keep_each_others_upserts(spark, workdir):
    path = os.path.join(workdir, "t")
    write_result(spark.createDataFrame([("old", 1.0)], ROW), "2_4", path)
    failed = []

    def write(n):
        try:
            write_result(spark.createDataFrame([(f"new{n}", float(n)), ("both", float(n))], ROW), "2_4", path, mode="upsert")
        except Exception as e:  # shown by the assertion below
            failed.append(e)

    writers = [threading.Thread(target=write, args=(n,)) for n in range(3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert not failed
    got = sorted(r.flight for r in read_result(spark, "2_4", path).collect())
    assert got == ["both", "new0", "new1", "new2", "old"] and versions(spark, path) == [0, 1, 2, 3]
    assert remove_old_versions(spark, path) == [0, 1] and newest(spark, path) == 3
    assert read_result(spark, "2_4", path).count() == 5


def test_a_table_without_a_version_is_an_error(spark, workdir):
    with pytest.raises(ValueError, match="no version"):
        read_result(spark, "2_4", os.path.join(workdir, "nothing"))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_only_changed_months_are_loaded(spark, workdir, fmt):
    lake, table, ledger = (os.path.join(workdir, x) for x in ("lake", "table", "ledger"))

    def day(date, *numbers):
        write_lake(lake_rows(flights_df(spark, [{"FlightDate": date, "FlightNum": n} for n in numbers])), lake, fmt)

    def load_it():
        report = load_changes(spark, lake, table, ledger, fmt)
        return {f"{r.Yeard}-{r.Monthd}": (r.status, r.n_files, r.n_changed) for r in report.collect()}

    def rows():
        return sorted((r.FlightDate, r.FlightNum) for r in read_flights_table(spark, table).collect())

    day("2008-10-01", "1", "2")
    day("2008-10-02", "3")
    day("2008-11-05", "4")
    assert {m: x[0] for m, x in load_it().items()} == {"2008-10": "new", "2008-11": "new"}
    first = rows()
    assert len(first) == 4
    kept = set(os.listdir(f"{table}/Yeard=2008/Monthd=11"))
    assert {x[0] for x in load_it().values()} == {"kept"} and len(versions(spark, ledger)) == 1

    day("2008-10-02", "3", "5")  # delivered again
    day("2009-01-01", "6")
    assert {m: x[0] for m, x in load_it().items()} == {"2008-10": "changed", "2008-11": "kept", "2009-01": "new"}
    assert rows() == sorted([*first, ("2008-10-02", "5"), ("2009-01-01", "6")])
    assert set(os.listdir(f"{table}/Yeard=2008/Monthd=11")) == kept

    shutil.rmtree(f"{lake}/Yeard=2008/Monthd=11")
    assert load_it()["2008-11"][:2] == ("gone", 0)
    assert not [r for r in rows() if r[0].startswith("2008-11")]
    assert "2008-11" not in load_it()


def test_a_file_without_a_month_is_an_error(spark, workdir):
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{workdir}/lake")
    with pytest.raises(ValueError, match="no month"):
        load_changes(spark, f"{workdir}/lake", f"{workdir}/table", f"{workdir}/ledger")
