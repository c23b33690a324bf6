"""Airport traffic: departures + arrivals per airport."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def airport_sides(flights: DataFrame, count_col: str = "FlightNum") -> DataFrame:
    """One row per (airport, side) of each flight: ``(airport, is_dep, counted)``.

    ``counted`` is the column whose non-NULL values are counted (``count(flightnum)``).
    """
    return flights.select(F.inline(F.array(
        F.struct(F.col("Origin").alias("airport"), F.lit(True).alias("is_dep"),
                 F.col(count_col).alias("counted")),
        F.struct(F.col("Dest").alias("airport"), F.lit(False).alias("is_dep"),
                 F.col(count_col).alias("counted")),
    )))


def airport_traffic(flights: DataFrame, count_col: str = "FlightNum") -> DataFrame:
    """``total_flights`` per airport seen both as an origin and as a destination.

    Same answer as joining ``count(flightnum) GROUP BY origin`` with
    ``count(flightnum) GROUP BY dest`` on ``origin = dest`` -- airports that appear
    only on one side drop out, NULL airports never match -- but with one scan and one
    shuffle: each flight becomes two (airport, side) rows inside the scan stage and is
    folded by the partial aggregate before the exchange, so only one row per airport
    and map task is shuffled, whatever the skew.
    """
    return (
        airport_sides(flights, count_col)
        .where(F.col("airport").isNotNull())
        .groupBy("airport")
        .agg(
            F.count_if(F.col("is_dep")).alias("dep_rows"),
            F.count_if(~F.col("is_dep")).alias("arr_rows"),
            F.count(F.when(F.col("is_dep"), F.col("counted"))).alias("dep_flights"),
            F.count(F.when(~F.col("is_dep"), F.col("counted"))).alias("arr_flights"),
        )
        .where((F.col("dep_rows") > 0) & (F.col("arr_rows") > 0))
        .select("airport", (F.col("dep_flights") + F.col("arr_flights")).alias("total_flights"))
    )


def airport_activity(flights: DataFrame) -> DataFrame:
    """Every airport on either side of any flight with its number of appearances.

    The streaming definition: all airports, no join, every row counted.
    """
    airports = flights.select(F.explode(F.array(F.col("Origin"), F.col("Dest"))).alias("airport"))
    return (airports.where(F.col("airport").isNotNull())
            .groupBy("airport").agg(F.count(F.lit(1)).alias("total_flights")))
