"""Queries over the driver's tables that apply each operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import byte_bpe
from .collocations import collocations
from .common import documents, labels
from .decontaminate import contamination
from .exact_dedup import exact_dedup
from .hmm_lm import hmm_lm
from .jaccard_join import jaccard_join
from .license_scan import license_scan
from .mixing import mixing
from .oracle_sql import oracles  # noqa: F401  (the entry reads it here)
from .pii_crf import pii_crf
from .quality_rules import quality_rules
from .resample import resample
from .suffix_dedup import suffix_dedup
from .toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]
#: Vocabulary of the BPE query.
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm(documents(spark, sf_dir))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))


def op5_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf(documents(spark, sf_dir))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir)).drop("matches")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).drop("n_rules_failed", "host_docs", "host_rate", "host_rejected")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing(documents(spark, sf_dir), labels(spark, sf_dir))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), benchmark(spark, sf_dir)).drop("spans")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def registered() -> dict[str, Query]:
    every = (op1_exact_dedup, op2_toxicity, op3_hmm_lm, op4_suffix_dedup, op5_pii_crf, op6_license_scan,
             op7_jaccard_join, op8_quality_rules, op9_byte_bpe, op10_mixing, op11_decontaminate, op12_resample,
             op13_collocations)
    return {f.__name__: f for f in every}
