"""Result tables: external names, overwrite, upsert by key, lookups."""

import os

from helpers import flights_df
from ontime.operators.lookups import lookup, lookup_pairs
from ontime.plans import batch
from ontime.sinks.results import read_result, write_result


def test_upsert_keeps_other_keys(spark, workdir):
    path = os.path.join(workdir, "t24")
    old = spark.createDataFrame([("A-B", 1.0), ("C-D", 2.0)], "flight string, avg_delay double")
    new = spark.createDataFrame([("A-B", 5.0), ("E-F", 3.0)], "flight string, avg_delay double")
    write_result(old, "2_4", path)
    assert spark.read.parquet(f"{path}/version=0").columns == ["Flight", "AvgDelay"]
    write_result(new, "2_4", path, mode="upsert")
    got = dict((r.flight, r.avg_delay) for r in read_result(spark, "2_4", path).collect())
    assert got == {"A-B": 5.0, "C-D": 2.0, "E-F": 3.0}
    write_result(new, "2_4", path)
    assert read_result(spark, "2_4", path).count() == 2


def test_lookups_inline_and_joined(spark):
    f = flights_df(spark, [{"Origin": o, "Dest": "Z", "ArrDelay": 1} for o in "ABCDE"])
    res = batch.route_delays(f)
    assert sorted(r.flight for r in lookup(res, "flight", ["A-Z", "C-Z", "Q-Z"]).collect()) == ["A-Z", "C-Z"]
    many = [f"{o}-Z" for o in "AB"] + [f"N{i}" for i in range(1500)]
    assert lookup(res, "flight", many).count() == 2
    pairs = lookup_pairs(res, ["flight", "avg_delay"], [("A-Z", "1.0"), ("B-Z", "2.0")])
    assert [r.flight for r in pairs.collect()] == ["A-Z"]


def test_lookups_have_one_form_for_every_length(spark):
    res = spark.createDataFrame([("x", "A-Z", 1.0, "2008"), ("y", "C-Z", 2.0, "2009"), ("z", None, 3.0, None)],
                                "other string, flight string, avg_delay double, day string")
    many = ["A-Z", *(f"k{i}" for i in range(1500))]
    one, lots = lookup(res, "flight", ["A-Z"]), lookup(res, "flight", many)
    assert one.schema == lots.schema == res.schema and one.collect() == lots.collect() != []
    pairs = [("A-Z", "2008"), ("C-Z", "2008"), *((f"k{i}", "2008") for i in range(1500))]
    few, lots = (lookup_pairs(res, ["flight", "day"], p) for p in (pairs[:1], pairs))
    assert few.schema == lots.schema == res.schema and few.collect() == lots.collect() == one.collect()
    assert lookup_pairs(res, ["flight", "day"], []).collect() == []
