"""Corpus pipeline: toxicity, exact dedup, near-duplicate groups, mixing, tokenization.

Each stage takes the documents that the one before it kept and returns documents again
(same columns); the last returns the tokenized documents. ``run`` writes every stage's
result to the shared folder and reads it back, so a lost executor repeats one stage's task.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm import toxicity
from ontime.llm.byte_bpe import byte_bpe
from ontime.llm.common import documents, labels, staged
from ontime.llm.exact_dedup import keep_first
from ontime.llm.jaccard_join import jaccard_join
from ontime.llm.mixing import mixing, rounded
from ontime.llm.registry import RANKS


#: Smallest rate of a document in the mixing stage: the rates are multiplied by its inverse at most.
LEAST_RATE = 0.25


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity classifier does not reject, each by its own text."""
    return toxicity.drop_toxic(docs, labels(spark, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest id."""
    return keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each connected group of near duplicates, the document with the smallest id."""
    others = (jaccard_join(docs).filter("doc_id <> component_id").select("doc_id").distinct())
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the ratios of their mixing rates, and each at least once: the rates are
    divided by the smallest one, so a domain shrinks as the others grow. The fit itself
    bounds the rates by LEAST_RATE, as a rate of zero has no multiple."""
    rates = staged(mixing(docs, labels(spark, sf_dir), least=LEAST_RATE), "mixing_rates")
    smallest = rates.agg(F.min("rate")).first()[0]
    copies = (rates.withColumn("copies", rounded(F.col("rate") / F.lit(smallest))).filter("copies > 1")
              .groupBy(F.col("doc_id").alias("key_id")).agg(F.max("copies").alias("n_copies")))
    # The rows travel as one struct, so that no column of theirs can clash with these. Copies
    # of a row stay neighbours, and the next stage tokenizes neighbours of one text once.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("key_id"))
    return (rows.join(copies, "key_id", "left")
            .select("row", F.explode(F.sequence(F.lit(1), F.coalesce("n_copies", F.lit(1)))).alias("nth")).select("row.*"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (one row each): doc_id, n_tokens, digests and ids."""
    return byte_bpe(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix),
    ("byte_bpe", tokenize),
]
#: The stages fit models and merge tokens, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
