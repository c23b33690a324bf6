"""Store the keyed answers, read them back, look them up (lookups 2.1-2.4 and 3.2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.lookups import lookup, lookup_pairs
from ..sinks.results import read_itineraries, read_result, write_itineraries, write_result

# --- Lookup parameters for the driver's data (airports are nation names there) -------
AIRPORTS = ["NATION_1", "NATION_6", "NATION_11", "NATION_16", "NATION_21", "NATION_3"]
ROUTES = ["NATION_1-NATION_2", "NATION_3-NATION_7", "NATION_10-NATION_12",
          "NATION_24-NATION_0", "NATION_5-NATION_5", "NATION_18-NATION_9"]
ITINERARY_DATES = [
    ("NATION_1-NATION_14-NATION_19", "2000-01-17"),
    ("NATION_13-NATION_19-NATION_23", "2000-05-07"),
    ("NATION_0-NATION_11-NATION_7", "2000-07-14"),
    ("NATION_1-NATION_10-NATION_20", "2000-06-01"),
    ("NATION_0-NATION_0-NATION_2", "2000-12-16"),
    ("NATION_1-NATION_11-NATION_2", "2000-06-09"),
]
# ---------------------------------------------------------------------------------

LOOKUP_COLUMN = {"2_1": "airport", "2_2": "origin", "2_3": "flight", "2_4": "flight"}


def stored_lookup(result: DataFrame, table: str, path: str, values: Sequence[str]) -> DataFrame:
    """Write ``result`` as result table ``table`` at ``path``; return the looked-up rows."""
    write_result(result, table, path)
    stored = read_result(result.sparkSession, table, path)
    return lookup(stored, LOOKUP_COLUMN[table], values)


def stored_itinerary_lookup(spark: SparkSession, itineraries: DataFrame, path: str,
                            pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Write the itinerary table; return the rows of the (itinerary, first date) pairs."""
    write_itineraries(itineraries, path)
    stored = read_itineraries(spark, path)
    return lookup_pairs(stored, ["itinerary", "flightdate1"], pairs).orderBy("itinerary")
