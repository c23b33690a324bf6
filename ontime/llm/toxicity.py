"""Toxicity by weak supervision.

1. Lexicon: over a bounded sample of labelled training rows (one of each group of near
   copies, by a bottom-k sketch of its words), words and word beginnings that occur in
   toxic documents far more often than in others become lexicon entries.
2. Voters: each entry votes "toxic" on documents that contain it and abstains elsewhere;
   pattern voters look at the form of a text (capitals, exclamation marks, symbols); one
   voter says "clean" where no entry occurs.
3. Label model: a generative model with one latent label estimates each voter's rates given
   the label by expectation maximisation; the table's label is one more voter, of fixed
   reliability, which names the two latent classes. Residual correlations of voter pairs, given the
   posterior label, shrink the weight of voters that repeat each other.
4. Classifier: a logistic regression on the voters' outputs, fitted to the posterior labels.

Every document is then scored by the classifier, in tasks that check each distinct word of
a block once. Labels, language, source and identifiers are never inputs of a score.

Defined cases: a null or empty text has no votes but "clean" and gets that score. Labels
that are null or of rows in the held-out fold are not learned from. Without any labelled
toxic row no entry is found and all scores are 0. Repeated rows and ties are scored alike,
a row each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, fold, ready, staged, texts

HELD_FOLD = 3
#: Labelled training rows the model is fitted on, at most (smallest hash of the id first).
SAMPLE_ROWS = 30_000
#: Word beginnings that are tried as lexicon entries, beside whole words.
STEMS = (4, 5, 6)
MIN_TOXIC_DOCS = 6
#: Share of the toxic sample that an entry must occur in.
MIN_TOXIC_SHARE = 0.01
MIN_ODDS = 12.0
MAX_ENTRIES = 120
ROUNDS = 25
#: Rate at which the table's label says "toxic" for clean and for toxic documents.
LABEL_RATES = (0.01, 0.9)
#: Hashes in the sketch that tells near copies in the sample.
SKETCH = 4
THRESHOLD = 0.7
LETTERS = re.compile(r"[^\W\d_]+")
PATTERNS = ("capitals", "exclamations", "symbols", "clean")


def forms(word: str) -> set[str]:
    """Entries a token could match: its letter runs (``=x``) and their beginnings (``x``)."""
    out = set()
    for run in LETTERS.findall(word):
        out.add("=" + run)
        out.update(run[:n] for n in STEMS if len(run) >= n)
    return out


def count_forms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per form and label, added up per block."""
    for table in blocks(batches):
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        known: dict[str, set[str]] = {}
        for text, toxic in zip(table.column("text").to_pylist(), table.column("toxic").to_pylist()):
            found: set[str] = set()
            for word in set(text.lower().split()):
                if word not in known:
                    known[word] = forms(word)
                found |= known[word]
            counts[toxic].update(found)
        every = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(every, pa.string()), pa.array([counts[1][f] for f in every], pa.int64()),
             pa.array([counts[0][f] for f in every], pa.int64())], names=["form", "toxic_docs", "clean_docs"])


def lexicon(sample: DataFrame) -> list[str]:
    """Entries with high odds for toxic, short ones first where a longer one adds nothing."""
    counts = sample.mapInArrow(count_forms, "form string, toxic_docs long, clean_docs long").groupBy("form").agg(
        F.sum("toxic_docs").alias("t"), F.sum("clean_docs").alias("c"))
    n = sample.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not n["t"]:
        return []
    odds = ((F.col("t") + 0.5) / (n["t"] + 1)) / ((F.col("c") + 0.5) / (n["n"] - n["t"] + 1))
    best = (counts.filter((F.col("t") >= max(MIN_TOXIC_DOCS, MIN_TOXIC_SHARE * n["t"])) & (odds >= MIN_ODDS))
            .orderBy(F.desc("t"), F.length("form"), "form").limit(20 * MAX_ENTRIES).collect())
    entries: list[str] = []
    for form in (r["form"] for r in best):
        word = form.lstrip("=")
        if not any(word.startswith(e) if not e.startswith("=") else word == e[1:] for e in entries):
            entries.append(form)
        if len(entries) == MAX_ENTRIES:
            break
    return entries


class Voters:
    """Outputs of all voters for texts, checking each distinct word of a block once."""

    def __init__(self, entries: list[str]):
        self.place = {e: i for i, e in enumerate(entries)}
        self.size = len(entries) + len(PATTERNS)

    def block(self, batch: list[str]) -> np.ndarray:
        out = np.zeros((len(batch), self.size), np.float32)
        hits: dict[str, list[int]] = {}
        seen: set[str] = set()
        entries = self.size - len(PATTERNS)
        for row, text in enumerate(batch):
            words = set(text.lower().split())
            for word in words - seen:
                found = [self.place[f] for f in forms(word) if f in self.place]
                if found:
                    hits[word] = found
            seen |= words
            for word in hits.keys() & words:
                out[row, hits[word]] = 1
            chars = max(1, len(text))
            out[row, entries:] = (
                text.isupper(), text.count("!") > 0.02 * chars, sum(map(text.count, "#*$%&@")) > 0.05 * chars,
                not out[row, :entries].any())
        return out


def vote(entries: list[str]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(entries)
        for table in blocks(batches):
            out = voters.block(table.column("text").to_pylist()).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in np.packbits(out, axis=1)], pa.binary()),
                 table.column("toxic").combine_chunks()], names=["votes", "toxic"])
    return run


def label_model(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Posterior probability of "toxic" for every (vote pattern, label) with its weight."""
    size = votes.shape[1]
    post = np.where(toxic == 1, 0.9, 0.02)
    label = np.where(toxic == 1, np.log(LABEL_RATES[1] / LABEL_RATES[0]),
                     np.log((1 - LABEL_RATES[1]) / (1 - LABEL_RATES[0])))
    for _ in range(ROUNDS):
        mass = np.stack([weight * (1 - post), weight * post])
        rate = (mass @ votes + 0.05) / (mass.sum(1, keepdims=True) + 0.1)
        prior = float(np.clip(mass[1].sum() / weight.sum(), 1e-4, 0.5))
        # What voters share beyond the label: correlation of residuals given the posterior.
        rest = votes - post[:, None] * rate[1] - (1 - post)[:, None] * rate[0]
        cover = (rest * weight[:, None]).T @ rest
        spread = np.sqrt(np.maximum(np.diag(cover), 1e-9))
        shared = np.abs(cover / spread[:, None] / spread[None])
        np.fill_diagonal(shared, 0)
        shared[shared < 0.1] = 0
        discount = 1 / (1 + shared.sum(1))
        evidence = votes * np.log(rate[1] / rate[0]) + (1 - votes) * np.log((1 - rate[1]) / (1 - rate[0]))
        logit = np.log(prior / (1 - prior)) + label + evidence @ discount
        post = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
    return post


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps; last: intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], 0.5)
    ridge[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * w
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """(lexicon entries, weights of the linear classifier)."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .filter((fold(F.col("doc_id"), HELD_FOLD) != 1) & F.col("toxic").isin(0, 1))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS))
    # At most SAMPLE_ROWS pairs of numbers: broadcast, so the texts are not shuffled.
    words = F.transform(F.split(F.lower("text"), r"\s+"), lambda w: F.xxhash64(w))
    rows = staged(texts(docs).join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "text", "toxic", F.slice(F.array_sort(F.array_distinct(words)), 1, SKETCH).alias("sketch")), "toxic")
    firsts = rows.groupBy("sketch").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    sample = rows.join(F.broadcast(firsts), "doc_id", "left_semi").select("text", "toxic")
    entries = lexicon(sample)
    if not entries:
        return [], np.zeros(len(PATTERNS) + 1)
    patterns = (sample.mapInArrow(vote(entries), "votes binary, toxic int")
                .groupBy("votes", "toxic").count().orderBy("votes", "toxic").collect())
    size = len(entries) + len(PATTERNS)
    votes = np.stack([np.unpackbits(np.frombuffer(r["votes"], np.uint8))[:size] for r in patterns]).astype(float)
    weight = np.array([r["count"] for r in patterns], float)
    posterior = label_model(votes, np.array([r["toxic"] for r in patterns]), weight)
    return entries, fit(votes, posterior, weight)


def score(entries: list[str], w: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(entries)
        for table in blocks(batches):
            votes = voters.block(table.column("text").to_pylist())
            p = 1 / (1 + np.exp(-np.clip(votes @ w[:-1] + w[-1], -30, 30))) if entries else np.zeros(len(votes))
            yield pa.RecordBatch.from_arrays(
                [table.column("doc_id").combine_chunks(), pa.array(p.astype(float)),
                 pa.array(votes[:, :len(entries)].sum(1).astype(np.int32))], names=["doc_id", "score", "n_entries"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_entries."""
    ready(docs.sparkSession)
    entries, w = train(docs, labels)
    rows = texts(docs).mapInArrow(score(entries, w), "doc_id long, score double, n_entries int")
    return rows.select("doc_id", F.coalesce(fold(F.col("doc_id"), HELD_FOLD) == 1, F.lit(False)).alias("held_out"),
                       "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_entries")


def clean(entries: list[str], w: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(entries)
        for table in blocks(batches):
            votes = voters.block([t or "" for t in table.column("text").to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(votes @ w[:-1] + w[-1], -30, 30))) if entries else np.zeros(len(votes))
            yield from table.filter(pa.array(p < THRESHOLD)).to_batches()
    return run


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose text is not rejected, with their own columns (for pipelines): each row is
    judged by its own text, whatever its id."""
    ready(docs.sparkSession)
    return docs.mapInArrow(clean(*train(docs, labels)), docs.schema)
