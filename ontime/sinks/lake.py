"""The clean lake: one folder per day, the 18 columns kept as text."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LAKE_PARTITIONS, SELECTED_FIELDS, ship_package, write_partitioned
from ..functions import keep_string


def day_keys() -> list:
    """``Yeard``, ``Monthd``, ``Dayd``: zero-padded text of Year/Month/DayofMonth."""
    return [F.lpad(F.col(c).try_cast("int").cast("string"), w, "0").alias(k)
            for c, w, k in (("Year", 4, "Yeard"), ("Month", 2, "Monthd"),
                            ("DayofMonth", 2, "Dayd"))]


def lake_rows(df: DataFrame) -> DataFrame:
    """Any flights-shaped rows (typed or text) -> lake rows.

    All 18 columns become text with NULL as ``''`` (the lake keeps the source text; the
    typed load is where numbers are parsed). The day partitions are zero-padded *copies*
    of Year/Month/DayofMonth, so the data columns stay inside the files.
    """
    return df.select(*[keep_string(c).alias(c) for c in SELECTED_FIELDS], *day_keys())


def write_lake(rows: DataFrame, path: str, fmt: str = "parquet", shuffle: bool = True) -> None:
    """Write lake rows partitioned by day; a day written again replaces only that day.

    ``shuffle=True``: ``REBALANCE`` on the day keys groups each day into one task -- so
    a normal day is one file, as in a day-file lake -- while AQE splits a hot day over
    several tasks and packs small days together. ``shuffle=False``: each task writes
    the days it holds (sorted only where they are many), no exchange at all;
    a day then has one file per task that held it -- the right choice when the input
    is already grouped by period, as rows unpacked from monthly archives are.
    Dynamic partition overwrite replaces exactly the days present in ``rows`` (a later
    run of the same day wins) and leaves the rest.
    """
    if "Dayd" not in rows.columns:
        rows = lake_rows(rows)
    if shuffle:
        rows = rows.hint("rebalance", *LAKE_PARTITIONS)
    options = {"header": "true", "emptyValue": ""} if fmt == "csv" else {}
    write_partitioned(rows, path, fmt, LAKE_PARTITIONS, **options)


def write_day_files(rows: DataFrame, path: str) -> DataFrame:
    """The lake as one headered CSV file per day, ``YYYY/MM/YYYY_MM_DD.csv``, for consumers of
    that layout. Returns (path, rows) of the files."""
    if "Dayd" not in rows.columns:
        rows = lake_rows(rows)
    quoted = [F.when(F.col(c).rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))
              .otherwise(F.coalesce(F.col(c), F.lit(""))) for c in SELECTED_FIELDS]
    keys = [F.coalesce(F.col(k), F.lit("unknown")) for k in LAKE_PARTITIONS]
    name = F.concat(F.concat_ws("/", F.lit(path.rstrip("/")), keys[0], keys[1], F.concat_ws("_", *keys)), F.lit(".csv"))
    lines = rows.select(name.alias("path"), F.concat_ws(",", *quoted).alias("line"))
    return write_lines(lines, ",".join(SELECTED_FIELDS))


def write_lines(lines: DataFrame, header: str) -> DataFrame:
    """Text files of the lines (path, line), each after the header; returns (path, rows).

    Lines are dealt by path and sorted by it inside a task, which streams one file after the
    other, so memory does not grow with a file. They travel as packed pieces of a file, so that
    neither the path nor the sort takes up room per line. A retried task writes the same files."""
    ship_package(lines.sparkSession)
    packed = lines.select("path", "line").mapInArrow(_pack_lines, "path string, lines binary, rows long")
    return packed.repartition("path").sortWithinPartitions("path").mapInArrow(_write_lines(header), "path string, rows long")


#: Bytes of text in a packed piece of a file, and those that a task holds before it sends all.
PIECE_BYTES, HELD_BYTES = 32 << 10, 16 << 20


def _pack_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[str]] = {}
    sizes: dict[str, int] = {}
    total = 0

    def packed(paths: list[str]) -> pa.RecordBatch:
        lines = [held.pop(p) for p in paths]
        for p in paths:
            del sizes[p]
        return pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()),
             pa.array([zlib.compress("".join(f"{row}\n" for row in rows).encode(), 1) for rows in lines], pa.binary()),
             pa.array([len(rows) for rows in lines], pa.int64())], names=["path", "lines", "rows"])

    for batch in batches:
        rows = zip(batch.column("path").to_pylist(), batch.column("line").to_pylist())
        for path, line in rows:
            held.setdefault(path, []).append(line)
            sizes[path] = sizes.get(path, 0) + len(line)
            total += len(line)
            if sizes[path] >= PIECE_BYTES:
                total -= sizes[path]
                yield packed([path])
        if total >= HELD_BYTES:
            yield packed(list(held))
            total = 0
    if held:
        yield packed(list(held))


def _write_lines(header: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ..sources.archives import _local_or_uri

        path, out, counts = None, None, {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("path", "lines", "rows")]
            for here, group in groupby(zip(*columns), key=itemgetter(0)):
                if here != path:
                    if out:
                        out.close()
                    fs, name = _local_or_uri(here)
                    fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
                    path, out = here, fs.open_output_stream(name)
                    counts[path] = 0
                    out.write(f"{header}\n".encode())
                for _, lines, rows in group:
                    out.write(zlib.decompress(lines))
                    counts[path] += rows
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                         names=["path", "rows"])
    return run
