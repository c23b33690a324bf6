"""Exact dedup: tree-merge of sorted digest runs, in DataFrame operations only.

Every input partition makes one run: a row per distinct text digest with the smallest
identifier and the count (partial aggregates, so a text that fills a partition leaves it as
one row). Runs are numbered, and in each of ``ROUNDS`` rounds the neighbouring runs that are
children of one node of the tree meet: their entries are exchanged by (node, range of
digests), sorted by digest and identifier, and entries that stand next to each other in the
merged order become one, the first, with the sum of the counts. The number of children comes from
the number of runs: the smallest power of two that leaves one run after the last round.
A range of digests is one of 65,536, so a node is spread over many tasks. Entries are
verified at each level: two become one only when the SHA-256 digest, the length and a
second, independent hash of the text all agree, so a digest that covered two texts would
stay two entries.

A text that holds a third of the rows is one entry per run, so no task ever gathers its
rows. The way back to the documents joins only entries with copies, on the digest; the
adaptive skew join splits a hot one.

Defined cases: a null text is the empty text. Rows with a null id count in their group and
are kept only when no row of it has an id. A repeated row (same id, same text) is kept
once. Extra columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ready, staged, texts

#: Rounds of the merge tree.
ROUNDS = 3
KEY = ["digest", "n_chars_normal", "second_hash"]


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, run, digest, n_chars_normal, second_hash) of every row's normalised text; a
    partition of the input is a run."""
    normal = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    return (texts(docs).select("doc_id", normal.alias("normal"))
            .select("doc_id", F.spark_partition_id().alias("run"), F.unhex(F.sha2("normal", 256)).alias("digest"),
                    F.length("normal").alias("n_chars_normal"),
                    F.xxhash64("normal").alias("second_hash")))


def children(n_runs: int) -> int:
    """Runs that meet in one node: the smallest power of two that, ``ROUNDS`` times over,
    covers all runs."""
    fan_in = 2
    while fan_in ** ROUNDS < n_runs:
        fan_in *= 2
    return fan_in


def merge_round(runs: DataFrame, fan_in: int) -> DataFrame:
    """Groups of ``fan_in`` neighbouring runs merged into one run each."""
    meeting = runs.select(F.floor(F.col("run") / fan_in).cast("int").alias("run"),
                          F.substring("digest", 1, 2).alias("range"), *KEY, "keep_id", "group_size")
    place = ["run", "range", *KEY]
    merged = (meeting.repartition("run", "range")
              .sortWithinPartitions(*place, F.col("keep_id").asc_nulls_last()))
    # Equal entries stand next to each other; the window needs neither exchange nor sort.
    same = Window.partitionBy(*place)
    first = F.row_number().over(same.orderBy(F.col("keep_id").asc_nulls_last()))
    return (merged.select("*", first.alias("nth"), F.sum("group_size").over(same).alias("n_rows"))
            .where("nth = 1").select("run", *KEY, "keep_id", F.col("n_rows").alias("group_size")))


def merge_runs(entries: DataFrame, n_runs: int) -> DataFrame:
    """The last run of the tree: one row per distinct text with ``keep_id`` and
    ``group_size``, from (doc_id, run, *KEY) rows."""
    runs = entries.groupBy("run", *KEY).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    for _ in range(ROUNDS):
        runs = merge_round(runs, children(n_runs))
    return runs.drop("run")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    ready(docs.sparkSession)
    rows = staged(digests(docs), "digests")
    n_runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    copies = (merge_runs(rows, n_runs).filter("group_size > 1")
              .select(*(F.col(c).alias(f"g_{c}") for c in KEY), "keep_id", "group_size"))
    joined = rows.join(copies, [rows[c] == F.col(f"g_{c}") for c in KEY], "left").select(
        "doc_id", F.lower(F.hex("digest")).alias("text_sha256"),
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"))
    # Rows of one id and text are numbered (row_number streams): a repeated row stays once.
    order = Window.partitionBy("text_sha256", "doc_id").orderBy("keep_id")
    return (joined.withColumn("place", F.row_number().over(order))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("place") == 1)).alias("kept"),
                    "text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns (for pipelines). The rows travel as one
    struct, so that no column of theirs can clash with the names used here."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).select(
        "row", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(0)).alias("key_id"), F.col("row.doc_id").isNull().alias("key_null"),
        F.xxhash64("row.text").alias("hash"), F.sha2("row.text", 256).alias("digest"))
    kept = exact_dedup(docs).filter("kept").select(
        F.coalesce("doc_id", F.lit(0)).alias("key_id"), F.col("doc_id").isNull().alias("key_null")).distinct()
    order = Window.partitionBy("key_id", "key_null", "hash", "digest").orderBy("key_id")
    return (rows.join(kept, ["key_id", "key_null"], "left_semi").withColumn("place", F.row_number().over(order))
            .filter("place = 1").select("row.*"))
