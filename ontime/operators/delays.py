"""Mean delays by key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import float_or_zero, mean2


def mean_delay(flights: DataFrame, keys: Mapping[str, str], delay: str,
               require_delay: bool = False, out: str = "avg_delay") -> DataFrame:
    """``round(avg(delay), 2)`` of non-cancelled flights per key.

    ``keys`` maps output name -> flights column. ``require_delay`` drops NULL delays
    before grouping (so groups with only NULL delays disappear instead of returning a
    NULL mean). Partial aggregation runs before the shuffle, so a hot key costs one row
    per map task.
    """
    df = flights.where(F.col("Cancelled") == 0)
    if require_delay:
        df = df.where(F.col(delay).isNotNull())
    return (df.groupBy(*[F.col(src).alias(name) for name, src in keys.items()])
              .agg(mean2(delay).alias(out)))


def running_mean_delay(flights: DataFrame, key: str, key_col: str,
                       delay: str = "ArrDelay") -> DataFrame:
    """The streaming mean: every flight counts, a non-numeric or missing delay is 0.

    Works on typed or raw (string) delays; ``sum`` and ``count`` are kept so a running
    state merges exactly, and the mean is ``sum / count`` without rounding.
    """
    return (flights.where(F.col(key_col).isNotNull())
            .groupBy(F.col(key_col).alias(key))
            .agg(F.sum(float_or_zero(delay)).alias("sum_delay"),
                 F.count(F.lit(1)).alias("n_flights"))
            .withColumn("avg_delay", F.col("sum_delay") / F.col("n_flights")))
