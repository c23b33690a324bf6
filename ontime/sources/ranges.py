"""Byte ranges of CSV files, so that many tasks read one file.

A byte range may begin inside a quoted field, and only the bytes before it tell. So two
passes are made over files longer than a range. The first counts, per range and for both
cases, its quotes, its records and the quotes that RFC 4180 does not allow; running sums per
file over these few numbers then give each range its case and the number of its first
record. The second pass reads each range from its first record on to the end of the record
that its last line end leaves open. A file with a quote out of place is read as one range.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of a range, and bytes read at once.
SPLIT_BYTES = 128 << 20
BLOCK = 8 << 20
#: Longest header line.
HEADER_BYTES = 1 << 20
#: Tasks that ranges are dealt to, at most.
MAX_TASKS = 20_000

RANGE = "path string, start long, end long, inside int, before long, header binary"
_COUNTS = ("path string, start long, end long, quotes long, records array<long>, stray array<long>, header binary")
_COUNTS_ARROW = pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("quotes", pa.int64()),
                           ("records", pa.list_(pa.int64())), ("stray", pa.list_(pa.int64())), ("header", pa.binary())])
QUOTE, LINE, RETURN, COMMA = 0x22, 0x0A, 0x0D, 0x2C


def open_file(path: str):
    from .archives import _local_or_uri

    fs, name = _local_or_uri(path)
    return fs.open_input_file(name)


def _blocks(stream, start: int, end: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """Blocks of [start, end): bytes with up to one byte before and two behind, how many of
    them lie before, and how many belong to the block."""
    at = start
    while at < end:
        size = min(BLOCK, end - at)
        lead = 1 if at else 0
        stream.seek(at - lead)
        data = np.frombuffer(stream.read(lead + size + 2), np.uint8)
        yield data, lead, min(size, len(data) - lead)
        at += size


def count_range(stream, start: int, end: int) -> tuple[int, list[int], list[int]]:
    """Quotes of a range; its records and its quotes out of place, if it begins outside (0)
    or inside (1) of quotes. A record belongs to the range of the line end before it."""
    quotes, records, stray = 0, [0, 0], [0, 0]
    for data, lead, size in _blocks(stream, start, end):
        body = data[lead:lead + size]
        after = np.concatenate([data[lead + 1:lead + 1 + size], np.zeros(1, np.uint8)])[:size]
        second = np.concatenate([data[lead + 2:lead + 2 + size], np.zeros(2, np.uint8)])[:size]
        at_end = lead + size >= len(data)
        is_quote = body == QUOTE
        q = np.flatnonzero(is_quote)
        lines = np.flatnonzero(body == LINE)
        # Line ends that another record follows: neither an empty line nor the end of the file.
        follows = (after[lines] != LINE) & ~((after[lines] == RETURN) & (second[lines] == LINE))
        if at_end and len(lines) and lines[-1] == size - 1:
            follows[-1] = False
        inside = (np.searchsorted(q, lines) + quotes) & 1
        left = np.concatenate([data[:1] if lead else np.full(1, LINE, np.uint8), body[:-1]])[q]
        right = np.where((q == size - 1) & at_end, LINE, after[q])
        opens = (np.arange(len(q)) + quotes) & 1  # 0: this quote opens, if the range began outside
        before_ok = (left == COMMA) | (left == LINE) | (left == QUOTE)
        after_ok = (right == COMMA) | (right == LINE) | (right == RETURN) | (right == QUOTE)
        for case in (0, 1):
            records[case] += int((follows & (inside == case)).sum())
            stray[case] += int((~np.where(opens == case, before_ok, after_ok)).sum())
        quotes += len(q)
    return quotes, records, stray


def header_of(stream) -> bytes:
    """The first line that is not empty, with the bytes before it."""
    stream.seek(0)
    data = stream.read(HEADER_BYTES)
    at = len(data) - len(data.lstrip(b"\r\n"))
    quoted = False
    for i in range(at, len(data)):
        if data[i] == QUOTE:
            quoted = not quoted
        elif data[i] == LINE and not quoted:
            return data[:i + 1]
    return data


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end"))):
            with open_file(path) as stream:
                header = header_of(stream) if not start else None
                quotes, records, stray = count_range(stream, start, end)
                if header is not None and header.lstrip(b"\r\n") == header and header:
                    records = [r + 1 for r in records]  # the header, which no line end precedes
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([start]), pa.array([end]), pa.array([quotes]), pa.array([records]),
                 pa.array([stray]), pa.array([header], pa.binary())], schema=_COUNTS_ARROW)


def csv_ranges(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, start, end, inside, before, header) of every range of the files (path, length):
    whether it begins inside quotes, the records before its first one, and the file's header
    (null for a range that begins the file)."""
    size = F.lit(int(split_bytes))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("length").alias("end")))
    small = files.filter(F.col("length") <= size).select("path", F.inline(whole))
    n = F.ceil(F.col("length") / size).cast("long")
    long = files.filter(F.col("length") > size).select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("k")).select(
        "path", (F.col("k") * size).alias("start"), F.least((F.col("k") + 1) * size, "length").alias("end"))
    counts = _spread(long, split_bytes).mapInArrow(_count, _COUNTS)
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    of_file = Window.partitionBy("path")
    counts = counts.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    case = (F.col("inside") + 1).cast("int")
    found = (counts.withColumn("n", F.element_at("records", case))
             .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
             .withColumn("stray", F.max(F.element_at("stray", case)).over(of_file))
             .withColumn("length", F.max("end").over(of_file))
             .withColumn("header", F.max("header").over(of_file)))
    split = found.filter("stray = 0").select(
        "path", "start", "end", F.col("inside").cast("int").alias("inside"),
        # The header is no record of the data.
        F.greatest(F.col("before") - 1, F.lit(0)).alias("before"), F.when(F.col("start") > 0, F.col("header")).alias("header"))
    one = found.filter("stray > 0 and start = 0").select("path", "start", F.col("length").alias("end"))
    plain = small.union(one).select("path", "start", "end", F.lit(0).alias("inside"), F.lit(0).cast("long").alias("before"),
                                    F.lit(None).cast("binary").alias("header"))
    return split.union(plain)


def _spread(ranges: DataFrame, split_bytes: int) -> DataFrame:
    """Ranges dealt to tasks: as many as their bytes make full ranges, so a large range has a
    task of its own and small files share one (a given number is not coalesced again)."""
    row = ranges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("start")).alias("bytes")).first()
    full = -(-(row["bytes"] or 0) // split_bytes)
    least = min(row["n"], ranges.sparkSession.sparkContext.defaultParallelism)
    return ranges.repartition(max(1, least, min(MAX_TASKS, full)))


def dealt(ranges: DataFrame, split_bytes: int) -> DataFrame:
    """The ranges written once (the first pass runs once) and dealt to tasks."""
    from ..config import scratch_path

    spark = ranges.sparkSession
    path = scratch_path(spark, "csv_ranges")
    ranges.write.parquet(path)
    return _spread(spark.read.schema(RANGE).parquet(path), split_bytes)


class RangeStream(io.RawIOBase):
    """The header and the records of a range, as one readable CSV file."""

    def __init__(self, path: str, start: int, end: int, inside: int, header: bytes | None) -> None:
        self._chunks = self._read(path, start, end, inside, header)
        self._held = b""

    def readable(self) -> bool:
        return True

    def read(self, n: int = -1) -> bytes:
        while not self._held:
            chunk = next(self._chunks, None)
            if chunk is None:
                return b""
            self._held = chunk
        out, self._held = self._held[:n], self._held[n:]
        return out

    @staticmethod
    def _read(path: str, start: int, end: int, inside: int, header: bytes | None) -> Iterator[bytes]:
        with open_file(path) as stream:
            stream.seek(start)
            at, begun = start, start == 0
            if header is not None:
                yield header if header.endswith(b"\n") else header + b"\n"
            while True:
                data = stream.read(BLOCK)
                if not data:
                    return
                raw = np.frombuffer(data, np.uint8)
                q, lines = np.flatnonzero(raw == QUOTE), np.flatnonzero(raw == LINE)
                lines = lines[((np.searchsorted(q, lines) + inside) & 1) == 0]
                inside = (inside + len(q)) & 1
                first = 0
                if not begun:
                    if not len(lines) or at + lines[0] >= end:
                        if at + len(data) >= end:
                            return  # no record begins here
                        at += len(data)
                        continue
                    first, begun = int(lines[0]) + 1, True
                last = lines[at + lines >= end]
                if len(last):
                    yield data[first:int(last[0]) + 1]
                    return
                yield data[first:]
                at += len(data)
