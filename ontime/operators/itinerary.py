"""Two-leg itineraries X -> Y -> Z with the second leg two days after the first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import NOON
from ..functions import iso_date, plus_days, route

LEG_COLUMNS = ["Origin", "Dest", "UniqueCarrier", "FlightNum", "DepTime", "ArrDelay",
               "FlightDate", "Yeard", "Monthd", "DayofMonth", "Cancelled"]
ROUTE_DAY = ["Origin", "Dest", "Yeard", "Monthd", "DayofMonth"]


def best_flights(rows: DataFrame, keys: Sequence[str] = ROUTE_DAY,
                 value: str = "ArrDelay") -> DataFrame:
    """Rows with ``rank() = 1`` by ``value`` within each group of ``keys``, ties kept.

    One scan and one exchange: Catalyst puts a ``WindowGroupLimit`` before and after the
    exchange, so a map task sends on only its best rows of a group and a hot route-day
    crosses the network as its ties. NULL values sort first, as ``rank()`` ASC does.
    """
    order = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_first())
    return rows.withColumn("_rank", F.rank().over(order)).where("_rank = 1").drop("_rank")


def best_legs(flights: DataFrame, year: int, require_delay: bool = False) -> DataFrame:
    """Best flight per route, day and half-day (``_am``: before noon) of one year.

    Both halves share one window; ``DepTime`` of exactly
    ``'1200'`` (or NULL) belongs to neither half, as the text compare implies.
    """
    base = flights.select(*LEG_COLUMNS).where(
        (F.col("Yeard") == year) & (F.col("Cancelled") == 0)
        & ((F.col("DepTime") < NOON) | (F.col("DepTime") > NOON)))
    if require_delay:
        base = base.where(F.col("ArrDelay").isNotNull())
    base = base.withColumn("_am", F.col("DepTime") < NOON)
    return best_flights(base, ["_am", *ROUTE_DAY])


def join_legs(legs: DataFrame, gap_days: int = 2) -> DataFrame:
    """Morning X->Y on day d joined with afternoon Y->Z on day d + ``gap_days``.

    A two-key equi-join on (Y, date) over the reduced legs (bounded by routes x days);
    the answer fans out at hub airports by definition and AQE splits hot keys.
    """
    leg1 = legs.where(F.col("_am")).select(
        F.col("Origin").alias("x"), F.col("Dest").alias("y"),
        F.col("UniqueCarrier").alias("airline1"), F.col("FlightNum").alias("flightnum1"),
        F.col("FlightDate").alias("flightdate1"), F.col("DepTime").alias("departure1"),
        F.col("ArrDelay").cast("double").alias("delay1"),
        plus_days("FlightDate", gap_days).alias("_meet"))
    leg2 = legs.where(~F.col("_am")).select(
        F.col("Origin").alias("_y2"), F.col("Dest").alias("z"),
        F.col("UniqueCarrier").alias("airline2"), F.col("FlightNum").alias("flightnum2"),
        F.col("FlightDate").alias("flightdate2"), F.col("DepTime").alias("departure2"),
        F.col("ArrDelay").cast("double").alias("delay2"),
        iso_date("FlightDate").alias("_meet2"))

    joined = leg1.join(leg2, (leg1["y"] == leg2["_y2"]) & (leg1["_meet"] == leg2["_meet2"]))
    return joined.select(
        "x", "y", "airline1", "flightnum1", "flightdate1", "departure1", "delay1",
        "z", "airline2", "flightnum2", "flightdate2", "departure2", "delay2",
        (F.col("delay1") + F.col("delay2")).alias("total_delay"),
        route("x", "y", "z").alias("itinerary"))


def itineraries(flights: DataFrame, year: int, gap_days: int = 2,
                require_delay: bool = False, stage_path: str | None = None) -> DataFrame:
    """Best morning flight X->Y on day d with best afternoon flight Y->Z on d+2.

    With ``stage_path`` the reduced legs are written there once (a Parquet table in
    the shared checkpoint folder) and the final join reads them back: the year's
    flights are scanned and reduced once instead of once per join side, and a lost
    executor recomputes from the staged table instead of from the raw scan.
    """
    legs = best_legs(flights, year, require_delay)
    if stage_path is not None:
        legs.write.mode("overwrite").parquet(stage_path)
        legs = flights.sparkSession.read.parquet(stage_path)
    return join_legs(legs, gap_days)
