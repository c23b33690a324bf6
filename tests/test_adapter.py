"""The test-data adapter: both join strategies of the dimension lookups give the same rows."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ontime.sources import testdata


def _digest(df):
    cols = sorted(df.columns)
    h = F.pmod(F.xxhash64(*cols), F.lit(2**31))   # order-insensitive, no overflow
    return df.select(F.sum(h).alias("h"), F.count(F.lit(1)).alias("n")).collect()[0]


def test_lookups_without_broadcast_match(spark):
    broadcast = testdata.flights(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = testdata.flights(spark, SF_SMALL)
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert _digest(shuffled) == _digest(broadcast)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_pruned_columns_keep_every_row(spark):
    full = testdata.flights(spark, SF_SMALL).count()
    for cols in (["Origin"], ["Dest"], ["UniqueCarrier"], ["ArrDelay"]):
        assert testdata.flights(spark, SF_SMALL, cols).count() == full
