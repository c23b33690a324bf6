"""Mixing sources to target weights by soft membership, in DataFrame operations only.

A naive Bayes classifier fitted on a bounded sample of labelled rows gives every document
posterior probabilities of the domains "good", "low" and "toxic" (from the labels table).
Its inputs are a few bucketed measures of the text, so documents fall into a bounded number
of cells with equal posteriors. A convex fit then finds a nonnegative rate
per document that makes the expected domain token totals match the targets:

    minimise  sum_k (sum_i r_i t_i p_ik - T_k)^2 / (2 T_k T)  +  ridge * sum_i t_i (r_i - 1)^2 / (2 T),  r >= 0

With the domain gradients g_k = (total_k - T_k) / T_k at the minimum, the best rate of a row
is max(0, 1 - sum_k p_ik g_k / ridge). So the fit looks for K numbers: damped Newton steps on
the dual, a convex function of g, until the totals of those rates agree with g. The sums of a
step run over the cells (a document aggregate taken once) instead of the documents, and only
K + K x K + 1 of them reach the driver. A fit that does not get there fails.

Defined cases: a null or empty text has no tokens and gets its cell's rate. Null or other
labels are not learned from; without labelled rows all posteriors are equal. Targets are
weights that need not sum to 1; a domain of weight 0 has target 0. Repeated rows count each.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import logging
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ready, staged, texts

logger = logging.getLogger(__name__)

DOMAINS = ("good", "low", "toxic")
#: Target weights of the domains in expected tokens.
WEIGHTS = {"good": 0.85, "low": 0.13, "toxic": 0.02}
#: Labelled rows the classifier is fitted on, at most (smallest hash of the id first).
SAMPLE_ROWS = 30_000
#: Word beginnings that speak for the toxic domain, at most.
MAX_BEGINNINGS = 64
RIDGE = 1e-3
#: The fit ends when no domain total is off by more than this share of all tokens, else it fails.
GAP, NEWTON_STEPS = 1e-9, 200
#: Buckets of every feature of the classifier.
FEATURES = {"length": 12, "symbols": 6, "capitals": 4, "distinct": 8, "lines": 4, "beginnings": 3}
BLANKS = r"[\x20\x09-\x0D]+"


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, word beginnings and the features that need no learning."""
    words = F.filter(F.split(F.lower("text"), BLANKS), lambda w: w != "")
    size = F.greatest(F.length("text"), F.lit(1))

    def share(drop: str) -> Column:
        return (F.length("text") - F.length(F.translate("text", drop, ""))) / size

    lines = F.split("text", "\n")
    rows = texts(docs).withColumn("words", words).withColumn("distinct_words", F.array_distinct("words"))
    n = F.size("words")
    return rows.select(
        "doc_id", n.cast("long").alias("n_tokens"),
        F.least(F.log2(n + 1).cast("int"), F.lit(11)).alias("length"),
        F.least(F.floor(share("#*$%&|<>!") * 20), F.lit(5)).cast("int").alias("symbols"),
        F.least(F.floor(share("ABCDEFGHIJKLMNOPQRSTUVWXYZ") * 8), F.lit(3)).cast("int").alias("capitals"),
        F.least(F.floor(F.size("distinct_words") / F.greatest(n, F.lit(1)) * 8), F.lit(7)).cast("int").alias("distinct"),
        F.least(F.floor((1 - F.size(F.array_distinct(lines)) / F.size(lines)) * 8), F.lit(3)).cast("int").alias("lines"),
        F.array_distinct(F.transform("distinct_words", lambda w: F.substring(w, 1, 4))).alias("starts"))


def labelled(labels: DataFrame) -> DataFrame:
    """A bounded sample of (doc_id, domain)."""
    quality, toxic = F.col("quality").cast("int"), F.col("toxic").cast("int")
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.when(toxic == 1, 2).when(quality == 0, 1).when(quality == 1, 0).alias("domain"))
            .filter("domain is not null and doc_id is not null").groupBy("doc_id").agg(F.max("domain").alias("domain"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS))


def toxic_beginnings(sample: DataFrame) -> list[str]:
    totals = sample.agg(F.count_if(F.col("domain") == 2).alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not totals["t"]:
        return []
    forms = sample.select("domain", F.explode("starts").alias("form")).filter("length(form) = 4").groupBy("form").agg(
        F.count_if(F.col("domain") == 2).alias("t"), F.count(F.lit(1)).alias("n"))
    odds = ((F.col("t") + 0.5) / (totals["t"] + 1)) / ((F.col("n") - F.col("t") + 0.5) / (totals["n"] - totals["t"] + 1))
    best = (forms.filter((odds > 12) & (F.col("t") >= max(5, 0.01 * totals["t"])))
            .orderBy(F.desc("t"), "form").limit(MAX_BEGINNINGS))
    return [r["form"] for r in best.collect()]


def with_beginnings(rows: DataFrame, entries: list[str]) -> DataFrame:
    known = F.array(*map(F.lit, entries)).cast("array<string>")
    return rows.withColumn("beginnings", F.least(F.size(F.array_intersect("starts", known)), F.lit(2))).drop("starts")


def bayes(sample: DataFrame) -> tuple[list[float], dict[str, list[list[float]]]]:
    """Log priors per domain, and per feature and bucket the log likelihoods per domain."""
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("bucket")) for f in FEATURES)))
    counts = (sample.select("domain", pairs.alias("x")).groupBy("domain", "x.feature", "x.bucket").count().collect())
    table = {f: [[1.0] * len(DOMAINS) for _ in range(n)] for f, n in FEATURES.items()}
    sizes = [1.0] * len(DOMAINS)
    for row in counts:
        table[row["feature"]][row["bucket"]][row["domain"]] += row["count"]
        sizes[row["domain"]] += row["count"] / len(FEATURES)
    for f, n in FEATURES.items():
        table[f] = [[math.log(c / (s - 1 + n)) for c, s in zip(bucket, sizes)] for bucket in table[f]]
    return [math.log(s / sum(sizes)) for s in sizes], table


def posteriors(rows: DataFrame, model: tuple[list[float], dict[str, list[list[float]]]]) -> DataFrame:
    """Adds p_<domain> columns."""
    prior, table = model
    logs = [sum((F.element_at(F.array(*(F.lit(b[k]) for b in table[f])), F.col(f) + 1) for f in FEATURES), F.lit(prior[k]))
            for k in range(len(DOMAINS))]
    rows = rows.withColumns({f"log_{d}": x for d, x in zip(DOMAINS, logs)})
    top = F.greatest(*(F.col(f"log_{d}") for d in DOMAINS))
    parts = {d: F.exp(F.col(f"log_{d}") - top) for d in DOMAINS}
    whole = sum(parts.values(), F.lit(0.0))
    return rows.withColumns({f"p_{d}": F.round(x / whole, 9) for d, x in parts.items()}).drop(*(f"log_{d}" for d in DOMAINS))


def pull(gradient: list[float]) -> Column:
    """The domain gradient as it falls on a row."""
    return sum((F.col(f"p_{d}") * g for d, g in zip(DOMAINS, gradient)), F.lit(0.0))


def rate(gradient: list[float], least: float = 0.0) -> Column:
    """A row's best rate, not under ``least``, when the domains have this gradient."""
    return F.greatest(F.lit(float(least)), 1 - pull(gradient) / RIDGE)


def fit_rates(cells: DataFrame, weights: dict[str, float], least: float = 0.0) -> list[float]:
    """Domain gradient at the minimum, from cells (p_<domain>, n_tokens): Newton steps on the
    dual, as far as the domain totals of its rates agree with it."""
    start = cells.agg(*(F.sum(F.col("n_tokens") * F.col(f"p_{d}")).alias(d) for d in DOMAINS)).first()
    whole, weight = sum(float(start[d] or 0) for d in DOMAINS), sum(weights[d] for d in DOMAINS)
    gradient = np.zeros(len(DOMAINS))
    if not whole or not weight:
        return gradient.tolist()
    targets = np.array([weights[d] / weight for d in DOMAINS])
    scales = np.where(targets > 0, targets, 1.0)
    share = F.col("n_tokens") / whole
    pairs = [(a, b) for a in DOMAINS for b in DOMAINS]
    sums = [F.sum(share * (F.col("z") * F.col("r") + RIDGE / 2 * (F.col("r") - 1) ** 2)).alias("inner"),
            *(F.sum(share * F.col("r") * F.col(f"p_{d}")).alias(f"s_{d}") for d in DOMAINS),
            *(F.sum(F.when(F.col("r") > least, share * F.col(f"p_{a}") * F.col(f"p_{b}")).otherwise(0.0)).alias(f"h_{a}_{b}")
              for a, b in pairs)]

    def dual(g: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Value, slope and curvature at g, and the domain totals there (shares of all tokens)."""
        row = cells.withColumns({"z": pull(g.tolist()), "r": rate(g.tolist(), least)}).agg(*sums).first()
        totals = np.array([row[f"s_{d}"] for d in DOMAINS])
        curve = np.array([row[f"h_{a}_{b}"] for a, b in pairs]).reshape(len(DOMAINS), -1) / RIDGE
        value = (scales * g * g).sum() / 2 + (targets * g).sum() - row["inner"]
        return value, scales * g + targets - totals, np.diag(scales) + curve, totals

    value, slope, curve, totals = dual(gradient)
    for _ in range(NEWTON_STEPS):
        if np.abs(slope).max() <= GAP:
            break
        move, size = -np.linalg.solve(curve, slope), 1.0
        while True:
            after = dual(gradient + size * move)
            # Once differences of the value drown in rounding, the slope decides.
            if after[0] <= value + 1e-4 * size * (slope @ move) or np.abs(after[1]).max() < np.abs(slope).max() / 2:
                break
            size /= 2
            if size < 1e-12:
                raise RuntimeError(f"mixing: no descent, slope {slope.tolist()}")
        gradient = gradient + size * move
        value, slope, curve, totals = after
    else:
        if np.abs(slope).max() > GAP:
            raise RuntimeError(f"mixing: not solved in {NEWTON_STEPS} steps, slope {slope.tolist()}")
    # What remains is the price of the ridge, or of a domain that the documents do not have.
    logger.info("mixing: reached %s of all tokens, targets %s", totals.tolist(), targets.tolist())
    return gradient.tolist()


def rounded(rate: Column) -> Column:
    """The rate rounded up or down by a hash of the id."""
    uniform = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + uniform).cast("int")


def mixing(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None,
           least: float = 0.0) -> DataFrame:
    """One row per document: doc_id, n_tokens, p_good, p_low, p_toxic, rate, copies.

    ``copies`` rounds the rate up or down by a hash of the id, so that its expectation over
    documents is the rate. ``least`` is a lower bound of the rates, kept by the fit."""
    ready(docs.sparkSession)
    rows = staged(measured(docs), "mixing")
    # At most SAMPLE_ROWS pairs of numbers: broadcast.
    sample = rows.join(F.broadcast(labelled(labels)), "doc_id")
    entries = toxic_beginnings(sample)
    scored = posteriors(with_beginnings(rows, entries), bayes(with_beginnings(sample, entries)))
    probabilities = [f"p_{d}" for d in DOMAINS]
    cells = staged(scored.groupBy(*probabilities).agg(F.sum("n_tokens").alias("n_tokens")), "mixing_cells")
    gradient = fit_rates(cells, weights or WEIGHTS, least)
    return (scored.withColumn("rate", rate(gradient, least))
            .select("doc_id", "n_tokens", *probabilities, "rate",
                    rounded(F.col("rate")).alias("copies")))
