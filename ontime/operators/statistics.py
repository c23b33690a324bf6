"""Statistics that merge: per month and column, one aggregation into counts, bounds and sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..config import TABLE_PARTITIONS

STATISTICS = ("Yeard int, Monthd int, column string, n_rows long, n_nulls long, min_number long, max_number long, "
              "min_text string, max_text string, distinct_sketch binary, quantile_sketch binary")


def month_statistics_of(table: DataFrame) -> DataFrame:
    """A row per month and column (``STATISTICS``) of a flights table, in one pass: counts, least
    and greatest value, a distinct-count sketch, and for numbers a quantile sketch. The partial
    aggregates of a task are a row per month it reads, so a hot month is many small rows."""
    numbers = {f.name for f in table.schema.fields if isinstance(f.dataType, IntegralType)}
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    entries = []
    for i, c in enumerate(table.columns):
        number = c in numbers
        value = F.col(c).cast("long") if number else F.col(c).cast("string")
        aggregates += [F.count(c).alias(f"_n{i}"), F.min(value).alias(f"_lo{i}"), F.max(value).alias(f"_hi{i}"),
                       F.hll_sketch_agg(value).alias(f"_d{i}")]
        if number:
            aggregates.append(F.kll_sketch_agg_bigint(value).alias(f"_q{i}"))
        low, high, none = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.lit(None)
        entries.append(F.struct(
            F.lit(c).alias("column"), F.col("_rows").alias("n_rows"), (F.col("_rows") - F.col(f"_n{i}")).alias("n_nulls"),
            (low if number else none.cast("long")).alias("min_number"), (high if number else none.cast("long")).alias("max_number"),
            (none.cast("string") if number else low).alias("min_text"), (none.cast("string") if number else high).alias("max_text"),
            F.col(f"_d{i}").alias("distinct_sketch"), (F.col(f"_q{i}") if number else none.cast("binary")).alias("quantile_sketch")))
    keys = [F.col(k).alias(f"_{k}") for k in TABLE_PARTITIONS]
    return (table.groupBy(*keys).agg(*aggregates)
            .select(*(F.col(f"_{k}").alias(k) for k in TABLE_PARTITIONS), F.inline(F.array(*entries))))


def merged_statistics(stats: DataFrame) -> DataFrame:
    """Statistics of all months together, from the stored rows alone: column, n_rows, n_nulls,
    min_value, max_value (as text), approx_distinct, and for numbers quartile_1, median and
    quartile_3 (approximate; null for text and for columns without a value)."""
    merged = stats.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.min("min_number").alias("_lo"), F.max("max_number").alias("_hi"),
        F.min("min_text").alias("_lo_text"), F.max("max_text").alias("_hi_text"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("approx_distinct"),
        F.kll_merge_agg_bigint("quantile_sketch").alias("_q"))
    # A sketch of no values has no quantiles to ask for.
    quantiles = [F.when(F.col("_lo").isNotNull(), F.kll_sketch_get_quantile_bigint("_q", F.lit(p))).alias(n)
                 for p, n in ((0.25, "quartile_1"), (0.5, "median"), (0.75, "quartile_3"))]
    return merged.select("column", "n_rows", "n_nulls", F.coalesce(F.col("_lo").cast("string"), "_lo_text").alias("min_value"),
                         F.coalesce(F.col("_hi").cast("string"), "_hi_text").alias("max_value"), "approx_distinct", *quantiles)


def month_rows(stats: DataFrame) -> DataFrame:
    """``(Yeard, Monthd, n_rows)`` per month, from the stored rows."""
    return stats.groupBy(*TABLE_PARTITIONS).agg(F.max("n_rows").alias("n_rows"))
