"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import checkpoint_dir, scratch_path, ship_package

#: Bytes of text that a task works on at once (a block); longer documents form a block alone.
BLOCK_BYTES = 16 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """The two columns every operator reads; a null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n: the folds of the scoring operators."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that a lost executor costs
    no recomputation and later steps read files instead of repeating the work."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ready(spark: SparkSession) -> None:
    """Checkpoint folder registered and the package importable by Python workers."""
    checkpoint_dir(spark)
    ship_package(spark)


def blocks(batches: Iterable[pa.RecordBatch], sizes_of: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Consecutive rows gathered into tables of about ``limit`` bytes of one column."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = batch.column(sizes_of).nbytes / batch.num_rows
        step = max(1, int(limit // max(1.0, lengths)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            size += int(lengths * part.num_rows)
            if size >= limit:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
                pa.default_memory_pool().release_unused()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def utf8(table: pa.Table, name: str = "text") -> list[bytes]:
    return table.column(name).cast(pa.binary()).to_pylist()


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For consecutive runs of the given lengths: each item's run, and its place in it."""
    run = np.repeat(np.arange(len(lengths)), lengths)
    start = np.cumsum(lengths) - lengths
    return run, np.arange(int(lengths.sum())) - np.repeat(start, lengths)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer (in place): each input bit changes each output bit."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


#: ASCII capitals to small letters, every other byte as it is.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

#: Bits of an id filter; 512 KB on the driver and per task, whatever the number of ids.
FILTER_BITS = 1 << 22


def id_slot(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FILTER_BITS))


def id_filter(ids: DataFrame, column: str) -> bytes:
    """Bitmap of hashed ids (of fixed size): rows whose slot is unset are surely not among
    ``ids``. It only saves the shuffle of texts; an exact join follows."""
    slot = ids.select(id_slot(F.col(column)).alias("slot"))
    words = (slot.groupBy((F.col("slot") / 32).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 32 as int))")).alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    for word, bits in words:
        out[word] = bits
    return out.tobytes()


def in_filter(bitmap: bytes, slots: np.ndarray) -> np.ndarray:
    words = np.frombuffer(bitmap, np.uint32)
    return (words[slots >> 5] >> (slots & 31).astype(np.uint32)) & np.uint32(1) != 0
