"""Target-distribution importance resampling over hashed n-grams.

1. Scan. Texts are lower-cased (A-Z), every run of separators collapses to one space, and an
   overlapped regular expression with boundary lookarounds gives the span of each n-gram;
   its bytes' CRC-32 modulo the number of buckets is a feature. The buckets of a document
   are written once (two bytes a feature) and read by the next steps.
2. Counts. Each task sums its documents' features per bucket, so at most one row per bucket
   and task is shuffled; the bucket totals of documents and target (as many numbers as there
   are buckets) give a gain per bucket.
3. Draw. A document's weight is the sum of its gains, its score the weight plus a Gumbel
   number from a hash of its id; the highest scores are drawn. Scores are sorted by range
   partitioning, and a document's rank is its place in its range plus the sizes of the
   ranges before it.

Defined cases: a null or empty text has no features and weight 0, and is not drawn, as are
all texts of too few words. Texts are scanned whole. Ties go to the smaller id (null ids
last; their hash is that of an empty id). Repeated rows are drawn each. Extra columns are
ignored. An empty table gives an empty result; with an empty target all gains come from
the documents alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, blocks, ready, staged, utf8

BUCKETS, PERCENT, MIN_WORDS, SEED = 10_000, 10, 20, 2024
SEPARATORS = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FEATURES = "doc_id long, n_words long, n_features long, buckets binary"


def ngram(n: int) -> bytes:
    """Pattern of n consecutive words between single spaces, from one boundary to another."""
    return rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1)


def features(lo: int, hi: int, buckets: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        collapse = regex.compile(SEPARATORS).sub
        spans_of = [regex.compile(ngram(n)).finditer for n in range(lo, hi + 1)]
        for table in blocks(batches, limit=2 << 20):
            words, counts, found = [], [], []
            for raw in utf8(table):
                text = collapse(b" ", raw.translate(LOWER)).strip(b" ")
                hashed = np.fromiter((crc32(m.group()) % buckets for spans in spans_of for m in spans(text, overlapped=True)),
                                     np.uint32)
                words.append(text.count(b" ") + 1 if text else 0)
                counts.append(len(hashed))
                found.append(hashed.astype(cell(buckets)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [table.column("doc_id").combine_chunks(), pa.array(words, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(found, pa.binary())], names=["doc_id", "n_words", "n_features", "buckets"])
    return run


def cell(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def sums(buckets: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in batch.column("buckets"):
                total += np.bincount(np.frombuffer(row.as_buffer(), cell(buckets)), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["bucket", "n"])
    return run


def bucket_counts(hashed: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    partial = hashed.select("buckets").mapInArrow(sums(buckets), "bucket int, n long")
    for bucket, n in partial.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: 1000 times the log ratio of its smoothed shares, rounded down."""
    n, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(t + 1) * float(all_s + n)) / (float(s + 1) * float(all_t + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(gain: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = [int(gain[np.frombuffer(row.as_buffer(), cell(len(gain)))].sum()) for row in batch.column("buckets")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(weight, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"])
    return run


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """Adds ``place`` (1, 2, ...) in the given order over all rows, without one task that sees them all."""
    ranges = staged(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    # One row per range.
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return (ranges.withColumn("inside", inside).join(F.broadcast(before), "part")
            .withColumn("place", F.col("before") + F.col("inside")).drop("part", "inside", "before"))


def resample(docs: DataFrame, target: DataFrame, lo: int = 1, hi: int = 1, buckets: int = BUCKETS,
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null: not drawn).

    Of the documents with ``min_words`` words, ``percent`` of a hundred are drawn."""
    ready(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    hashed = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
                    .mapInArrow(features(lo, hi, buckets), FEATURES), "features")
    wanted = (target.select(F.lit(None).cast("long").alias("doc_id"), text)
              .mapInArrow(features(lo, hi, buckets), FEATURES))
    gain = gains(bucket_counts(hashed, buckets), bucket_counts(wanted, buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8),
               16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = (hashed.mapInArrow(weights(gain), "doc_id long, n_words long, n_features long, weight long")
              .withColumn("score", (F.col("weight") + gumbel).cast("long")))
    enough = F.col("n_words") >= min_words
    drawn = hashed.filter(enough).count() * percent // 100
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    ranks = ranked(scored.filter(enough), order)
    columns = ["doc_id", "n_features", "weight", "score"]
    rank = F.when(F.col("place") <= drawn, F.col("place")).cast("long").alias("rank")
    return ranks.select(*columns, rank).union(scored.filter(~enough).select(*columns, F.lit(None).cast("long").alias("rank")))


def drawn_documents(docs: DataFrame, target: DataFrame, **settings: int) -> DataFrame:
    """The drawn documents with their own columns; rows of one id are drawn together."""
    key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    ids = resample(docs, target, **settings).filter("rank is not null").select(key.alias("drawn_key")).distinct()
    return docs.join(ids, key == F.col("drawn_key"), "left_semi")
