"""Quality rules with host-level verdicts.

Each document is measured once (whole text) and tested against a few rules. Rule failures
are summed per host (the ``source`` column); the observed rate of every host is shrunk
towards the corpus by a beta prior whose two parameters are estimated from all hosts
(method of moments), so a host with few documents cannot be condemned by one of them. A
host whose shrunken failure rate exceeds ``HOST_LIMIT`` is rejected, and the verdict is
joined back to its documents.

The per-host sums are partial aggregates, so a host with a third of the rows crosses the
shuffle as one row per task. The join back carries numbers only; the adaptive skew join
splits a hot host.

Defined cases: a null text has no words (and fails the base rule). A null ``source`` is a
host of its own. Repeated rows are measured and returned each. Extra input columns are
ignored. An empty table gives an empty result; without hosts the prior is uniform.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, ready, staged

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host is rejected when more than this share of its documents must be expected to fail.
HOST_LIMIT = 0.5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
MEASURES = "doc_id long, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    covered, upto = 0, 0
    for at, window in enumerate(windows):
        if seen[window] > 1:
            covered += at + 3 - max(at, upto)
            upto = at + 3
    return covered


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in blocks(batches):
        out: list[tuple[int, ...]] = []
        for text in table.column("text").to_pylist():
            words = text.encode().split()  # bytes: ASCII white space only
            out.append((len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
                        repeated_lines(text), repeated_words(words)))
        yield pa.RecordBatch.from_arrays(
            [table.column("doc_id").combine_chunks(), table.column("source").combine_chunks(),
             *(pa.array(x, pa.int64()) for x in zip(*out))],
            names=["doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])


def measures(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(measure, MEASURES)


def rules() -> dict[str, F.Column]:
    """Document-level rules; a true column is a failure."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "too_short": F.col("n_words") < MIN_WORDS,
        "repetitive": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": F.col("n_symbols") > 1.0 * words,
        "word_length": (F.col("word_chars") / words > 30) | (F.col("word_chars") / words < 2),
        "duplicate_lines": F.col("n_dup_lines") > 0.5 * words,
    }


def host_rates(failed: DataFrame) -> DataFrame:
    """Per host: documents, failures, the rate shrunk by the empirical beta prior."""
    hosts = failed.groupBy("host", "host_null").agg(
        F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("rules_failed").cast("long")).alias("host_failures"))
    rate = F.col("host_failures") / F.col("host_docs")
    # One row: mean and variance of the hosts' rates, weighted by their documents.
    m = hosts.agg(
        F.sum("host_failures").alias("x"), F.sum("host_docs").alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("host_docs") * rate * rate).alias("s2"), F.sum(1 / F.col("host_docs")).alias("inv")).first()
    mean, strength = 0.5, 2.0
    if m["n"]:
        mean = min(max(m["x"] / m["n"], 1e-6), 1 - 1e-6)
        # Variance between hosts: the weighted variance less what sampling alone adds.
        spread = m["s2"] / m["n"] - (m["x"] / m["n"]) ** 2 - mean * (1 - mean) * m["k"] / m["n"]
        strength = min(max(mean * (1 - mean) / spread - 1, 2.0), 1e6) if spread > 0 else 1e6
    return hosts.withColumn("host_rate", (F.col("host_failures") + mean * strength) / (F.col("host_docs") + strength))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, kept, rules_failed,
    host_rate, host_rejected."""
    ready(docs.sparkSession)
    rows = staged(measures(docs), "quality").select(
        "*", F.coalesce("source", F.lit("")).alias("host"), F.col("source").isNull().alias("host_null"))
    failing = rules()
    checked = rows.select(
        "*", (failing["too_short"] | failing["repetitive"]).alias("base_failed"),
        sum((c.cast("int") for c in failing.values()), F.lit(0)).alias("n_rules_failed")).withColumn(
        "rules_failed", F.col("n_rules_failed") > 0)
    hosts = host_rates(checked).select("host", "host_null", "host_docs", "host_rate")
    return (checked.join(hosts, ["host", "host_null"], "left")
            .withColumn("host_rejected", F.col("host_rate") > HOST_LIMIT)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"),
                    "n_rules_failed", "host_docs", "host_rate", "host_rejected"))
