"""Run running aggregates as Structured Streaming queries."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sinks.versions import newest, read_version, remove_old_versions, write_version
from .aggregates import AGGREGATES, all_measures, measure_of, rejected, report_order

REPORT_ROWS = 10
#: Published versions of a running state that stay readable.
STATE_VERSIONS = 3


def report(batch: DataFrame, order: Sequence[Column], title: str,
           rows: int = REPORT_ROWS, out: Callable[[str], None] = print) -> list[tuple]:
    """Print a header and the first ``rows`` keys of the current state in ``order``."""
    top = [tuple(r) for r in batch.orderBy(*order).limit(rows).collect()]
    out(f"--- {title} ---")
    for r in top:
        out(",".join("" if v is None else str(v) for v in r))
    return top


def publish_state(batch: DataFrame, path: str) -> int:
    """The state of one batch as the next version of the table at ``path``; versions
    before the last three are deleted. Returns the version's number."""
    number = write_version(batch.sparkSession, path, lambda _: batch)
    remove_old_versions(batch.sparkSession, path, keep=STATE_VERSIONS)
    return number


def read_state(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The newest published state; without rows where no batch has been published."""
    number = newest(spark, path)
    return spark.createDataFrame([], schema) if number is None else read_version(spark, path, number)


def stored_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The aggregation state that a query's checkpoint holds (of its last batch), as key and
    value columns: what a restart would go on from, read without starting the query."""
    return (spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
            .select("key.*", F.col("value").alias("state")))


def start(agg: DataFrame, name: str, checkpoint: str, result_path: str | None = None,
          order: Sequence[Column] | None = None, show: bool = False,
          trigger: dict | None = None) -> StreamingQuery:
    """Start one aggregate in complete mode.

    Each micro-batch carries the whole (key-bounded) state: it is published as the next
    version of the table at ``result_path`` (read it with ``read_state``) and/or reported
    (top 10 in ``order``). A reader sees the state of one batch, whole, also while the next is
    written. ``checkpoint`` holds the offsets and the aggregation state, so a restart resumes
    where it stopped (a batch that is done again is published again); every query needs its own.
    """
    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            if result_path:
                publish_state(batch, result_path)
            if show and order is not None:
                stamp = time.strftime("%Y-%m-%d %H:%M:%S")
                report(batch, order, f"{stamp} :: {name} :: batch {epoch_id}")
        finally:
            batch.unpersist()

    writer = (agg.writeStream.outputMode("complete").foreachBatch(sink)
              .option("checkpointLocation", checkpoint)
              .queryName(f"{name}_{uuid.uuid4().hex[:8]}"))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def run_available(agg: DataFrame, name: str, checkpoint: str, result_path: str) -> DataFrame:
    """Process everything available now, stop, and return the final state as a table."""
    q = start(agg, name, checkpoint, result_path)
    q.awaitTermination()
    return read_state(agg.sparkSession, result_path, agg.schema)


def start_all(flights: DataFrame | Callable[[float], DataFrame], base_path: str, show: bool = True,
              triggers: dict[str, str] | None = None, available_now: bool = False) -> list[StreamingQuery]:
    """The three aggregates over one input, started together (one checkpoint each),
    plus a count of the rows they reject. Wait with
    ``spark.streams.awaitAnyTermination()``.

    ``flights`` may be a function of a query's trigger interval in seconds, for inputs
    whose rate cap depends on it. ``available_now`` processes what is there and stops.
    """
    queries = []
    for name, (fn, interval) in {"rejected": (rejected, "5 seconds"), **AGGREGATES}.items():
        every = (triggers or {}).get(name, interval)
        source = flights(float(every.split()[0])) if callable(flights) else flights
        queries.append(start(
            fn(source), name if name == "rejected" else f"running_{name}", f"{base_path}/checkpoint_{name}",
            f"{base_path}/state_{name}", report_order(name), show,
            {"availableNow": True} if available_now else {"processingTime": every}))
    return queries


def start_together(flights: DataFrame, base_path: str, show: bool = True, every: str = "2 seconds",
                   available_now: bool = False) -> StreamingQuery:
    """The three aggregates and the rejected rows as one query with one checkpoint: the input
    is read and parsed once. Every batch publishes the whole (key-bounded) state as the next
    version of one table. Read it with ``read_together``."""
    def sink(batch: DataFrame, epoch_id: int) -> None:
        number = publish_state(batch, f"{base_path}/state")
        if show:
            stamp = time.strftime("%Y-%m-%d %H:%M:%S")
            state = read_version(batch.sparkSession, f"{base_path}/state", number)
            for name in (*AGGREGATES, "rejected"):
                report(measure_of(state, name), report_order(name), f"{stamp} :: running_{name} :: batch {epoch_id}")

    writer = (all_measures(flights).writeStream.outputMode("complete").foreachBatch(sink)
              .option("checkpointLocation", f"{base_path}/checkpoint").queryName(f"running_{uuid.uuid4().hex[:8]}"))
    return writer.trigger(**({"availableNow": True} if available_now else {"processingTime": every})).start()


def read_together(spark: SparkSession, base_path: str, name: str) -> DataFrame:
    """One measure of the newest complete state that ``start_together`` has written."""
    schema = "measure string, key string, sum_delay double, n_rows long"
    return measure_of(read_state(spark, f"{base_path}/state", schema), name)
