"""The named batch questions, each ``flights DataFrame -> result DataFrame`` (no I/O).

``COLUMNS[name]`` lists the flights columns a job reads, so a source can prune (the
Parquet scan reads only those; the test-data adapter joins only what supplies them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import route
from ..operators.delays import mean_delay
from ..operators.itinerary import LEG_COLUMNS, itineraries
from ..operators.topk import global_rank, top_k, top_k_per_group
from ..operators.traffic import airport_traffic

TOP = 10

COLUMNS: dict[str, list[str]] = {
    "q1_1": ["Origin", "Dest", "FlightNum"],
    "q1_2": ["UniqueCarrier", "ArrDelay", "Cancelled"],
    "q1_3": ["DayOfWeek", "ArrDelay", "Cancelled"],
    "q2_1": ["Origin", "UniqueCarrier", "DepDelay", "Cancelled"],
    "q2_2": ["Origin", "Dest", "DepDelay", "Cancelled"],
    "q2_3": ["Origin", "Dest", "UniqueCarrier", "ArrDelay", "Cancelled"],
    "q2_4": ["Origin", "Dest", "ArrDelay", "Cancelled"],
    "q3_1": ["Origin", "Dest", "FlightNum", "Cancelled"],
    "q3_2": LEG_COLUMNS,
}


def busiest_airports(flights: DataFrame, k: int = TOP) -> DataFrame:
    """1.1 Ten busiest airports by departures + arrivals (cancelled flights count)."""
    return top_k(airport_traffic(flights), [F.col("total_flights").desc(), "airport"], k)


def best_carriers(flights: DataFrame, k: int = TOP) -> DataFrame:
    """1.2 Ten carriers with the lowest mean arrival delay."""
    m = mean_delay(flights, {"airline": "UniqueCarrier"}, "ArrDelay")
    return top_k(m, ["avg_delay", "airline"], k)


def weekday_delays(flights: DataFrame) -> DataFrame:
    """1.3 Days of the week by mean arrival delay (all seven, sorted)."""
    m = mean_delay(flights, {"Weekday": "DayOfWeek"}, "ArrDelay")
    return m.orderBy(F.col("avg_delay").asc_nulls_first(), "Weekday")


def carriers_per_airport(flights: DataFrame, k: int = TOP) -> DataFrame:
    """2.1 Per airport, the k carriers with the lowest mean departure delay."""
    m = mean_delay(flights, {"airport": "Origin", "airline": "UniqueCarrier"}, "DepDelay")
    return top_k_per_group(m, ["airport"], ["avg_delay", "airline"], k) \
        .select("airport", "airline", "avg_delay", "rank")


def destinations_per_airport(flights: DataFrame, k: int = TOP) -> DataFrame:
    """2.2 Per airport, the k destinations with the lowest mean departure delay."""
    m = mean_delay(flights, {"origin": "Origin", "dest": "Dest"}, "DepDelay")
    return top_k_per_group(m, ["origin"], ["avg_delay", "dest"], k) \
        .select("origin", "dest", "avg_delay", "rank")


def carriers_per_route(flights: DataFrame, k: int = TOP) -> DataFrame:
    """2.3 Per route X-Y, the k carriers with the lowest mean arrival delay."""
    m = mean_delay(flights, {"x": "Origin", "y": "Dest", "airline": "UniqueCarrier"},
                   "ArrDelay", require_delay=True)
    r = top_k_per_group(m, ["x", "y"], ["avg_delay", "airline"], k)
    return r.select(route("x", "y").alias("flight"), "airline", "avg_delay", "rank")


def route_delays(flights: DataFrame) -> DataFrame:
    """2.4 Mean arrival delay per route X-Y."""
    m = mean_delay(flights, {"x": "Origin", "y": "Dest"}, "ArrDelay", require_delay=True)
    return m.select(route("x", "y").alias("flight"), "avg_delay")


def airport_popularity(flights: DataFrame) -> DataFrame:
    """3.1 Rank of every airport by flights (cancelled excluded), no limit."""
    t = airport_traffic(flights.where(F.col("Cancelled") == 0))
    return global_rank(t, [F.col("total_flights").desc()], "rnk") \
        .orderBy("rnk", "airport")


def two_leg_itineraries(flights: DataFrame, year: int, require_delay: bool = False,
                        stage_path: str | None = None) -> DataFrame:
    """3.2 X->Y (before noon) then Y->Z (after noon) two days later, best flight per leg."""
    return itineraries(flights, year, gap_days=2, require_delay=require_delay,
                       stage_path=stage_path)


JOBS = {
    "q1_1": busiest_airports,
    "q1_2": best_carriers,
    "q1_3": weekday_delays,
    "q2_1": carriers_per_airport,
    "q2_2": destinations_per_airport,
    "q2_3": carriers_per_route,
    "q2_4": route_delays,
    "q3_1": airport_popularity,
}
