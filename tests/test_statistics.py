"""Stored statistics: merged months equal the whole table, only changed months are read."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import flights_df
from ontime.operators.quality import column_profile
from ontime.operators.statistics import merged_statistics, month_rows
from ontime.plans.statistics import read_statistics, update_statistics
from ontime.sources.lake import read_flights_table, write_flights_table


def month(spark, m, n, delay):
    return flights_df(spark, [{"FlightDate": f"2008-{m:02d}-{1 + i % 28:02d}", "Origin": f"O{m}{i}", "FlightNum": str(i % 50),
                               "ArrDelay": None if i % 7 == 0 else delay + i, "ArrDelayMinutes": None} for i in range(n)])


def test_merged_months_equal_the_table_and_old_months_are_not_read(spark, workdir):
    table, stats = os.path.join(workdir, "table"), os.path.join(workdir, "stats")
    write_flights_table(month(spark, 3, 400, 0).unionByName(month(spark, 4, 300, -500)), table)

    def check():
        whole, stored = read_flights_table(spark, table), read_statistics(spark, stats)
        got = {r.column: r for r in merged_statistics(stored).collect()}
        for r in column_profile(whole).collect():
            g = got[r.column]
            assert (g.n_rows, g.n_nulls, g.min_value, g.max_value) == (r.n_rows, r.n_nulls, r.min_value, r.max_value), r.column
        exact = whole.agg(*(F.count_distinct(c).alias(c) for c in whole.columns)).first()
        for c in whole.columns:
            assert abs(got[c].approx_distinct - exact[c]) <= 0.05 * exact[c], c
        delays = sorted(r.ArrDelay for r in whole.where("ArrDelay IS NOT NULL").collect())
        assert got["ArrDelay"].median == pytest.approx(delays[len(delays) // 2], abs=0.05 * (delays[-1] - delays[0]))
        assert got["ArrDelayMinutes"].median is None and got["Origin"].median is None
        assert sorted(map(tuple, month_rows(stored).collect())) == sorted(
            map(tuple, whole.groupBy("Yeard", "Monthd").count().collect()))

    assert update_statistics(spark, table, stats) == [(2008, 3), (2008, 4)]
    check()
    assert update_statistics(spark, table, stats) == []
    check()
    # A month written again and a new one: only these two are read.
    write_flights_table(month(spark, 4, 200, 5).unionByName(month(spark, 5, 10, 9)), table)
    assert update_statistics(spark, table, stats) == [(2008, 4), (2008, 5)]
    check()


def test_months_that_are_gone_have_no_statistics(spark, workdir):
    table, stats = os.path.join(workdir, "table"), os.path.join(workdir, "stats")
    write_flights_table(month(spark, 3, 5, 0).unionByName(month(spark, 4, 5, 0)), table)
    update_statistics(spark, table, stats)
    from ontime.sinks.versions import remove
    remove(spark, f"{table}/Yeard=2008/Monthd=4")
    assert update_statistics(spark, table, stats) == []
    assert [tuple(r) for r in month_rows(read_statistics(spark, stats)).collect()] == [(2008, 3, 5)]
