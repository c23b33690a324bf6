"""Command line for cluster runs: ``spark-submit -m``-style entry points.

    python -m ontime.cli ingest  --source RAW/ --lake CLEAN/ --work WORK/
    python -m ontime.cli load    --lake CLEAN/ --table FLIGHTS/ [--name flights]
    python -m ontime.cli batch   --table FLIGHTS/ --results RESULTS/ [--year 2008]
    python -m ontime.cli lookup  --results RESULTS/ --table-id 2_1 --keys CMI,BWI
    python -m ontime.cli lookup  --results RESULTS/ --table-id 3_2 --pairs CMI-ORD-LAX@2008-03-04
    python -m ontime.cli replay  --lake CLEAN/ --topics t1,t2 (--out MSGS/ | --brokers host:9092)
    python -m ontime.cli stream  --checkpoints CK/ (--files DIR [--csv] | --messages DIR
                                                    | --brokers B --topics T)

The session comes from the launcher (``spark-submit`` settings); scratch and staging
data go under the session's checkpoint folder unless ``--work`` is given.
"""

from __future__ import annotations

import argparse
import logging
import uuid

from pyspark.sql import SparkSession

from .config import cluster_defaults, scratch_path
from .operators.lookups import lookup, lookup_pairs
from .plans import batch
from .plans.ingest import ingest
from .plans.load import load, load_changes
from .plans.lookups import LOOKUP_COLUMN
from .plans.resume import ingest_changes
from .plans.statistics import update_statistics
from .sinks.replay import replay
from .sinks.results import read_itineraries, read_result, write_itineraries, write_result
from .sources.lake import read_flights_table, register_flights_table
from .sources.streams import file_stream, kafka_stream, message_stream, parse_messages, rate_cap
from .streaming.runner import start_all, start_together

log = logging.getLogger("ontime")

RESULT_JOBS = {"2_1": "q2_1", "2_2": "q2_2", "2_3": "q2_3", "2_4": "q2_4"}


def _spark(scale_defaults: bool) -> SparkSession:
    spark = SparkSession.builder.appName("ontime").getOrCreate()
    if scale_defaults:
        cluster_defaults(spark)
    return spark


def cmd_ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    work = a.work or scratch_path(spark, "ingest")
    if a.ledger:  # a folder of its own for every run
        report = ingest_changes(spark, a.source, a.lake, a.ledger, f"{work}/run-{uuid.uuid4().hex[:12]}", a.format)
        for r in report.groupBy("action", "status").count().orderBy("action", "status").collect():
            print(f"{r['count']} archives {r.action}: {r.status}")
        return
    res = ingest(spark, a.source, a.lake, f"{work}/quarantine", f"{work}/stage", a.format)
    res.manifest.write.mode("overwrite").parquet(f"{work}/manifest")
    runs = {r.status: r.archives for r in res.runs.collect()}
    if not runs:
        log.warning("no archives found under %s", a.source)
    print(f"archives: {runs}; manifest: {work}/manifest")


def cmd_load(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.ledger:
        report = load_changes(spark, a.lake, a.table, a.ledger, a.format)
        for r in report.groupBy("status").count().orderBy("status").collect():
            print(f"{r['count']} months {r.status}")
        table = register_flights_table(spark, a.name, a.table) if a.name else read_flights_table(spark, a.table)
    else:
        table = load(spark, a.lake, a.table, a.name, a.format)
    if a.stats:
        print(f"statistics: {len(update_statistics(spark, a.table, a.stats))} months read")
    print(f"flights table at {a.table}: {table.count()} rows")


def cmd_batch(spark: SparkSession, a: argparse.Namespace) -> None:
    flights = read_flights_table(spark, a.table)
    for name in ("q1_1", "q1_2", "q1_3"):
        print(f"--- {name} ---")
        for r in batch.JOBS[name](flights).collect():   # bounded: top 10 / 7 days
            print(",".join(str(v) for v in r))
    batch.JOBS["q3_1"](flights).write.mode("overwrite").parquet(f"{a.results}/3_1")
    for table, name in RESULT_JOBS.items():
        write_result(batch.JOBS[name](flights), table, f"{a.results}/{table}", a.mode)
    write_itineraries(batch.two_leg_itineraries(flights, a.year,
                                                stage_path=scratch_path(spark, "legs")),
                      f"{a.results}/3_2")
    print(f"result tables under {a.results}")


def cmd_lookup(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.table_id == "3_2":
        pairs = [tuple(p.split("@", 1)) for p in a.pairs.split(",")]
        df = lookup_pairs(read_itineraries(spark, f"{a.results}/3_2"),
                          ["itinerary", "flightdate1"], pairs).orderBy("itinerary")
    else:
        df = lookup(read_result(spark, a.table_id, f"{a.results}/{a.table_id}"),
                    LOOKUP_COLUMN[a.table_id], a.keys.split(","))
    if a.out:
        df.write.mode("overwrite").option("header", True).csv(a.out)
        print(f"rows written to {a.out}")
        return
    print(",".join(df.columns))
    for r in df.toLocalIterator():   # all rows, a partition at a time
        print(",".join("" if v is None else str(v) for v in r))


def cmd_replay(spark: SparkSession, a: argparse.Namespace) -> None:
    counts = replay(spark, a.lake, a.topics.split(","), a.out, a.brokers, a.format)
    for r in counts.collect():
        print(f"{r.topic}: {r.n_messages}")


def cmd_stream(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.brokers:
        cap = rate_cap(a.rate, a.partitions, 2) if a.rate else None
        flights = parse_messages(kafka_stream(spark, a.brokers, a.topics.split(","), cap))
    elif a.messages:
        flights = parse_messages(message_stream(spark, a.messages, a.max_files, a.max_bytes))
    else:
        flights = file_stream(spark, a.files, "csv" if a.csv else "parquet",
                              max_files_per_trigger=a.max_files, max_bytes_per_trigger=a.max_bytes)
    if a.brokers or a.messages:  # all measures on one trigger: one read of the input
        start_together(flights, a.checkpoints)
    else:
        start_all(flights, a.checkpoints, show=True)
    spark.streams.awaitAnyTermination()


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="ontime")
    p.add_argument("--no-scale-defaults", action="store_true",
                   help="do not apply the large-cluster sizing to unset settings")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("ingest")
    s.add_argument("--source", required=True)
    s.add_argument("--lake", required=True)
    s.add_argument("--work")
    s.add_argument("--ledger", help="folder of the ingested archives' ledger: only new, failed and changed ones are read")
    s.add_argument("--format", default="parquet", choices=["parquet", "csv"])

    s = sub.add_parser("load")
    s.add_argument("--lake", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--name")
    s.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    s.add_argument("--ledger", help="folder of the loaded files' ledger: only changed months are loaded")

    s.add_argument("--stats", help="folder of the stored statistics: those of changed months are made anew")

    s = sub.add_parser("batch")
    s.add_argument("--table", required=True)
    s.add_argument("--results", required=True)
    s.add_argument("--year", type=int, default=2008)
    s.add_argument("--mode", default="overwrite", choices=["overwrite", "upsert"])

    s = sub.add_parser("lookup")
    s.add_argument("--results", required=True)
    s.add_argument("--table-id", required=True, choices=["2_1", "2_2", "2_3", "2_4", "3_2"])
    s.add_argument("--keys", default="")
    s.add_argument("--pairs", default="")
    s.add_argument("--out", help="folder for the rows (CSV); without it they are printed")

    s = sub.add_parser("replay")
    s.add_argument("--lake", required=True)
    s.add_argument("--topics", required=True)
    s.add_argument("--out")
    s.add_argument("--brokers")
    s.add_argument("--format", default="parquet", choices=["parquet", "csv"])

    s = sub.add_parser("stream")
    s.add_argument("--checkpoints", required=True)
    s.add_argument("--files")
    s.add_argument("--messages", help="folder of replayed (topic, value) message files")
    s.add_argument("--csv", action="store_true")
    s.add_argument("--max-files", type=int)
    s.add_argument("--max-bytes", type=int, help="cap of a batch in bytes of new files, instead of --max-files")
    s.add_argument("--brokers")
    s.add_argument("--topics", default="")
    s.add_argument("--rate", type=int, help="cap, in records/s per partition (default: none)")
    s.add_argument("--partitions", type=int, help="partitions of all topics together, for --rate")

    a = p.parse_args(argv)
    if a.cmd == "stream" and a.rate and not a.partitions:
        p.error("--rate needs --partitions (of all topics together)")
    spark = _spark(not a.no_scale_defaults)
    {"ingest": cmd_ingest, "load": cmd_load, "batch": cmd_batch, "lookup": cmd_lookup,
     "replay": cmd_replay, "stream": cmd_stream}[a.cmd](spark, a)


if __name__ == "__main__":
    main()
