"""The three running aggregates (1.1-1.3 in streaming form).

Each is a plain ``DataFrame -> DataFrame`` aggregation, so it runs unchanged on a
static DataFrame, a file stream or a Kafka stream. The state is the built-in streaming
aggregation state (sum and count per key), bounded by the number of keys, with partial
aggregation in every micro-batch before the shuffle. No watermark: totals run since the
start, as the questions ask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import float_or_zero
from ..operators.delays import running_mean_delay
from ..operators.traffic import airport_activity


def airport_traffic(flights: DataFrame) -> DataFrame:
    """1.1 Departures + arrivals per airport, every airport on either side counted."""
    return airport_activity(flights)


def carrier_delay(flights: DataFrame) -> DataFrame:
    """1.2 Mean arrival delay per carrier; missing or non-numeric delays count as 0."""
    return running_mean_delay(flights, "airline", "UniqueCarrier")


def weekday_delay(flights: DataFrame) -> DataFrame:
    """1.3 Mean arrival delay per day of the week; missing delays count as 0."""
    return running_mean_delay(flights, "weekday", "DayOfWeek")


def all_measures(flights: DataFrame) -> DataFrame:
    """The three aggregates and the rejected rows as one: (measure, key, sum_delay, n_rows).

    Each flight becomes its rows of the measures inside the scan stage, so one query with one
    state reads and parses the input once. Keys are text; rows without a key are left out."""
    delay, none = float_or_zero("ArrDelay"), F.lit(0.0)

    def row(measure: str, key: Column, value: Column) -> Column:
        return F.struct(F.lit(measure).alias("measure"), key.cast("string").alias("key"), value.alias("delay"))

    missing = [F.col(c).isNull() for c in ("Origin", "Dest", "UniqueCarrier", "DayOfWeek")]
    reason = F.when(missing[0] & missing[2], "malformed").when(missing[0] | missing[1] | missing[2] | missing[3], "missing key")
    rows = F.array(row("1_1", F.col("Origin"), none), row("1_1", F.col("Dest"), none),
                   row("1_2", F.col("UniqueCarrier"), delay), row("1_3", F.col("DayOfWeek"), delay), row("rejected", reason, none))
    return (flights.select(F.inline(F.filter(rows, lambda r: r["key"].isNotNull())))
            .groupBy("measure", "key").agg(F.sum("delay").alias("sum_delay"), F.count(F.lit(1)).alias("n_rows")))


def measure_of(state: DataFrame, name: str) -> DataFrame:
    """One measure of the joint state, with the columns of its own aggregate."""
    rows = state.where(F.col("measure") == name)
    if name == "1_1":
        return rows.select(F.col("key").alias("airport"), F.col("n_rows").alias("total_flights"))
    if name == "rejected":
        return rows.select(F.col("key").alias("reason"), F.col("n_rows").alias("rows"))
    return rows.select(F.col("key").alias("airline" if name == "1_2" else "weekday"), "sum_delay",
                       F.col("n_rows").alias("n_flights"), (F.col("sum_delay") / F.col("n_rows")).alias("avg_delay"))


def rejected(flights: DataFrame) -> DataFrame:
    """Rows that at least one of the three aggregates skips because its key is missing
    (malformed messages, short lines), counted instead of being grouped under a NULL key.
    A row without one airport still counts for the other in the traffic."""
    bad = F.col("Origin").isNull() | F.col("Dest").isNull() \
        | F.col("UniqueCarrier").isNull() | F.col("DayOfWeek").isNull()
    return (flights.where(bad)
            .groupBy(F.when(F.col("UniqueCarrier").isNull() & F.col("Origin").isNull(),
                            "malformed").otherwise("missing key").alias("reason"))
            .agg(F.count(F.lit(1)).alias("rows")))


def report_order(name: str) -> list[Column]:
    """Report order of an aggregate; the key breaks ties so the top 10 is stable."""
    if name == "1_1":
        return [F.col("total_flights").desc(), F.col("airport")]
    if name == "rejected":
        return [F.col("reason")]
    key = "airline" if name == "1_2" else "weekday"
    return [F.col("avg_delay").asc(), F.col(key)]


# name -> (aggregate, trigger interval of the file-stream form)
AGGREGATES = {
    "1_1": (airport_traffic, "2 seconds"),
    "1_2": (carrier_delay, "5 seconds"),
    "1_3": (weekday_delay, "5 seconds"),
}
