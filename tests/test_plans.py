"""Physical plans: the operators rely on Catalyst rewrites that must actually fire."""

import os

from helpers import flights_df
from ontime.operators.itinerary import best_legs
from ontime.plans import batch
from ontime.sources.lake import read_flights_table, write_flights_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_per_group_uses_window_group_limit(spark):
    f = flights_df(spark, [{"Origin": "A", "UniqueCarrier": c} for c in "XYZ"])
    text = batch.carriers_per_airport(f)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in text


def test_global_top_k_is_take_ordered(spark):
    f = flights_df(spark, [{"UniqueCarrier": c} for c in "XYZ"])
    assert "TakeOrderedAndProject" in plan(batch.best_carriers(f))


def test_traffic_is_one_aggregate_without_join(spark):
    f = flights_df(spark, [{"Origin": "A", "Dest": "B"}])
    text = plan(batch.busiest_airports(f))
    assert "Join" not in text and "Generate" in text


def test_itinerary_prunes_partitions_and_columns(spark, workdir):
    path = os.path.join(workdir, "flights")
    write_flights_table(flights_df(spark, [{"FlightDate": "2008-03-04"},
                                           {"FlightDate": "2007-03-04"}]), path)
    table = read_flights_table(spark, path)
    legs = batch.two_leg_itineraries(table, 2008)
    text = legs._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Yeard" in text and "(Yeard#" in text
    assert "ArrDelayMinutes" not in text.split("ReadSchema")[1]


def test_best_flights_are_one_scan_and_one_exchange(spark, workdir):
    path = os.path.join(workdir, "flights")
    write_flights_table(flights_df(spark, [{"FlightDate": "2008-03-04"}]), path)
    legs = best_legs(read_flights_table(spark, path), 2008)
    text = plan(legs).split("Initial Plan")[0]
    assert text.count("Exchange hashpartitioning") == 1 and text.count("FileScan") == 1
    assert text.count("WindowGroupLimit") == 2 and "Join" not in text
