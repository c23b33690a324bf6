"""Registered jobs over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..config import scratch_path
from ..sinks.results import read_result, write_result
from ..sources.testdata import stored_flights
from . import batch
from .lookups import AIRPORTS, ITINERARY_DATES, ROUTES, stored_itinerary_lookup, stored_lookup
from .oracle import ITINERARY_YEAR, batch_oracles, flights_cte, lookup_oracles
from .pipeline import pipeline_jobs, pipeline_oracles
from .streams import stream_jobs, stream_oracles

Job = Callable[[SparkSession, str], DataFrame]


def _batch(name: str) -> Job:
    fn = batch.JOBS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(stored_flights(spark, sf_dir).select(*batch.COLUMNS[name]))

    run.__name__ = name
    return run


def _itineraries(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = stored_flights(spark, sf_dir).select(*batch.COLUMNS["q3_2"])
    return batch.two_leg_itineraries(table, ITINERARY_YEAR, stage_path=scratch_path(spark, "legs"))


def _lookup(name: str, table: str, values: list[str]) -> Job:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = _batch(name)(spark, sf_dir)
        return stored_lookup(result, table, scratch_path(spark, f"result_{table}"), values)

    run.__name__ = f"lookup_{table}"
    return run


def _itinerary_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_itinerary_lookup(spark, _itineraries(spark, sf_dir),
                                   scratch_path(spark, "result_3_2"), ITINERARY_DATES)


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result table 2.1 of all years, then the year ``ITINERARY_YEAR`` put over it by key."""
    flights = stored_flights(spark, sf_dir)
    path = scratch_path(spark, "upsert_2_1")
    write_result(batch.carriers_per_airport(flights), "2_1", path)
    write_result(batch.carriers_per_airport(flights.where(f"Yeard = {ITINERARY_YEAR}")), "2_1", path, mode="upsert")
    return read_result(spark, "2_1", path)


def registered() -> dict[str, Job]:
    jobs: dict[str, Job] = {name: _batch(name) for name in batch.JOBS}
    jobs["q3_2"] = _itineraries
    jobs["q_l1"] = _lookup("q2_1", "2_1", AIRPORTS)
    jobs["q_l2"] = _lookup("q2_2", "2_2", AIRPORTS)
    jobs["q_l3"] = _lookup("q2_3", "2_3", ROUTES)
    jobs["q_l4"] = _lookup("q2_4", "2_4", ROUTES)
    jobs["q_l5"] = _itinerary_lookup
    jobs["upsert"] = _upsert
    jobs.update(stream_jobs())
    jobs.update(pipeline_jobs())
    return dict(sorted(jobs.items()))


def oracles() -> dict[str, str]:
    return {**batch_oracles(), **lookup_oracles(AIRPORTS, ROUTES, ITINERARY_DATES),
            **stream_oracles(flights_cte()), **pipeline_oracles(flights_cte())}
