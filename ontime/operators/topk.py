"""Top-k per group and global top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence[str | Column]) -> list[Column]:
    # Spark's ascending default is NULLS FIRST, as in the reference engine.
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols]


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                    k: int, rank_col: str = "rank") -> DataFrame:
    """Rows with ``rank() <= k`` within each group of ``keys``, ordered by ``order``.

    ``rank`` keeps ties (so a group may return more than k rows). Catalyst turns the
    rank filter into a ``WindowGroupLimit`` on both sides of the shuffle, so at most
    k (plus ties) rows per group and map task cross the network. Meant for inputs that
    are already aggregated (one row per group member); ``rank`` is returned as BIGINT.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return (df.withColumn(rank_col, F.rank().over(w).cast("bigint"))
              .where(F.col(rank_col) <= k))


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """Global top k: ``TakeOrderedAndProject`` (per-partition heap, k rows to one task)."""
    return df.orderBy(*_order(order)).limit(k)


def global_rank(df: DataFrame, order: Sequence[str | Column], rank_col: str = "rnk") -> DataFrame:
    """``rank() OVER (ORDER BY ...)`` over a whole, already aggregated result.

    This needs one ordered partition; callers only use it on results with one row per
    airport, whose size is bounded by the number of airports and not by the data.
    """
    w = Window.orderBy(*_order(order))
    return df.withColumn(rank_col, F.rank().over(w).cast("bigint"))
