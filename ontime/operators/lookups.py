"""Keyed lookups on result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose ``column`` is one of ``values`` (``WHERE column IN (...)``)."""
    return lookup_pairs(df, [column], [(v,) for v in values])


def lookup_pairs(df: DataFrame, columns: Sequence[str],
                 pairs: Sequence[Sequence[str]]) -> DataFrame:
    """Rows matching any of the value tuples on ``columns`` (OR of ANDs).

    One form for every length: a semi join with a table of the keys, typed as the columns
    are; Catalyst chooses the join from the measured sizes. Rows keep ``df``'s columns.
    """
    spark = df.sparkSession
    texts = dict.fromkeys(tuple(None if v is None else str(v) for v in p) for p in pairs)
    keys = spark.createDataFrame(list(texts), ", ".join(f"`{c}` string" for c in columns))
    keys = keys.select(*[F.col(c).try_cast(df.schema[c].dataType).alias(c) for c in columns])
    return df.join(keys, list(columns), "left_semi").select(*df.columns)
