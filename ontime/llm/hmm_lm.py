"""Language-model scoring with a hidden Markov model.

The corpus is cut into blocks of documents. Each block lists its distinct words with their
training counts; the lists meet by word (a window sum; a word contributes one row per
block, however frequent it is), which gives every word its exact training count, and go
back to their blocks. A block is then a set of symbol sequences, one per document, and is
stored in that form.

The symbols are a fixed number of word classes (a hash of the word's length class and last
bytes, so short words are nearly their own class) plus the end symbol. Latent states emit
symbols; a symbol emits its words by their smoothed training counts. Baum-Welch runs over
all training documents: every task adds up its expected counts (scaled forward-backward,
all documents of a block side by side), Spark sums them across tasks, and the driver
normalises the sums, whose size is fixed by the model. The score of a text is the exact
log10 likelihood from the scaled forward recursion plus the words' probabilities within
their symbols.

Defined cases: a null text is the empty text, whose only token is the end. Words never seen
in training have count 0 and probability mass in their class. Texts are scored whole.
Repeated rows count as documents and are returned each. Without training rows the model
stays at its start values. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, blocks, fold, ragged, ready, staged, texts, utf8

STATES = 4
#: Symbols: word classes, then the end symbol.
CLASSES = 2048
SYMBOLS = CLASSES + 1
ITERATIONS = 3
HELD_FOLD = 5
SMOOTH = 0.5
#: Pseudo-counts of the transition and emission estimates.
PRIOR = 0.1
#: Tokens of the documents that one recursion runs over side by side.
SIDE_BY_SIDE = 400_000

BLOCK = ("block long, doc_ids array<long>, held array<boolean>, lengths array<int>, places binary, "
         "words array<binary>, counts array<int>")
SEQUENCES = ("block long, doc_ids array<long>, held array<boolean>, lengths array<int>, known array<int>, "
             "log_counts array<double>, symbols binary, class_tokens binary, class_words binary")
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double"


def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents as places in the block's word list, with training counts."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 24
    for table in blocks(batches):
        held = table.column("held").to_pylist()
        vocabulary: dict[bytes, int] = {}
        lengths, places = [], []
        for text in utf8(table):
            words = text.translate(LOWER).split()
            for word in set(words).difference(vocabulary):
                vocabulary[word] = len(vocabulary)
            lengths.append(len(words))
            places.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
        flat = np.concatenate(places)
        trained = np.repeat(~np.array(held, bool), lengths)
        counts = np.bincount(flat[trained], minlength=len(vocabulary)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
             pa.array([held], pa.list_(pa.bool_())), pa.array([lengths], pa.list_(pa.int32())),
             pa.array([flat.tobytes()], pa.binary()), pa.array([list(vocabulary)], pa.list_(pa.binary())),
             pa.array([counts], pa.list_(pa.int32()))],
            names=["block", "doc_ids", "held", "lengths", "places", "words", "counts"])
        number += 1


def to_sequences(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's documents as symbol sequences, from the exact counts of its words."""
    schema = pa.schema([
        ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int32())), ("known", pa.list_(pa.int32())), ("log_counts", pa.list_(pa.float64())),
        ("symbols", pa.binary()), ("class_tokens", pa.binary()), ("class_words", pa.binary())])
    if not left.num_rows:
        return schema.empty_table()
    place = right.column("place").to_numpy()
    n = int(place.max()) + 1 if len(place) else 0
    count, symbol, first = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, bool)
    count[place] = right.column("count").to_numpy()
    symbol[place] = right.column("symbol").to_numpy()
    first[place] = right.column("is_first").to_numpy()
    seen = first & (count > 0)
    class_tokens = np.bincount(symbol[seen], weights=count[seen], minlength=SYMBOLS)
    class_words = np.bincount(symbol[seen], minlength=SYMBOLS).astype(float)
    lengths = left.column("lengths").combine_chunks().flatten().to_numpy()
    flat = np.frombuffer(left.column("places")[0].as_py(), np.int32)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    logs = np.log10(count + SMOOTH)
    known = np.bincount(doc, weights=(count > 0)[flat], minlength=len(lengths)).astype(np.int32)
    log_counts = np.bincount(doc, weights=logs[flat], minlength=len(lengths))
    # the end symbol follows every text
    ends = np.cumsum(lengths)
    symbols = np.insert(symbol[flat].astype(np.int16), ends, np.int16(CLASSES))
    return pa.table([left.column("block"), left.column("doc_ids"), left.column("held"), left.column("lengths"),
                     pa.array([known], pa.list_(pa.int32())), pa.array([log_counts], pa.list_(pa.float64())),
                     pa.array([symbols.tobytes()], pa.binary()), pa.array([class_tokens.tobytes()], pa.binary()),
                     pa.array([class_words.tobytes()], pa.binary())], schema=schema)


class Hmm:
    """Start, transition and emission probabilities, with block-wise recursions.

    Documents of a block run side by side in time-major order: the tokens at one time of all
    documents that are that long stand together, longest document first.
    """

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def initial(cls) -> Hmm:
        """Deterministic start values, slightly uneven so that states can part."""
        rng = np.random.default_rng(11)
        emit = rng.dirichlet(np.full(STATES, 2.0), SYMBOLS)
        move = np.full((STATES, STATES), 0.1 / max(1, STATES - 1))
        np.fill_diagonal(move, 0.9)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(0))

    @staticmethod
    def layout(symbols: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per group of documents: (documents, time-major symbols, documents still running
        at each time). Groups hold documents of like length and a bounded number of tokens."""
        order = np.argsort(-lengths, kind="stable")
        starts = np.cumsum(lengths) - lengths
        group = (np.cumsum(lengths[order]) - lengths[order]) // SIDE_BY_SIDE
        for docs in np.split(order, np.flatnonzero(np.diff(group)) + 1):
            sizes = lengths[docs]
            running = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), side="right")
            at = np.cumsum(running) - running
            run, time = ragged(sizes)
            major = np.empty(len(run), symbols.dtype)
            major[at[time] + run] = symbols[starts[docs][run] + time]
            yield docs, major, running

    def forward(self, major: np.ndarray, running: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled forward values, scales, emission rows, all time-major."""
        rows = self.emit[major]
        alpha, scale = np.empty_like(rows), np.empty(len(major))
        at, before = 0, None
        for n in running.tolist():
            now = rows[at:at + n] * (self.start if before is None else before[:n] @ self.move)
            s = now.sum(1)
            now /= s[:, None]
            alpha[at:at + n], scale[at:at + n] = now, s
            before, at = now, at + n
        return alpha, scale, rows

    def expected(self, major: np.ndarray, running: np.ndarray) -> np.ndarray:
        """Expected starts, moves and emissions, one row each of STATES values."""
        alpha, scale, rows = self.forward(major, running)
        beta = np.ones_like(alpha)
        ends = np.cumsum(running)
        back = self.move.T
        for t in range(len(running) - 2, -1, -1):
            a, n = ends[t], running[t + 1]
            first = a - running[t]
            beta[first:first + n] = (rows[a:a + n] * beta[a:a + n] / scale[a:a + n, None]) @ back
        gamma = alpha * beta
        gamma /= gamma.sum(1, keepdims=True)
        starts = gamma[:running[0]].sum(0)
        later = np.arange(running[0], len(major))
        time = np.repeat(np.arange(1, len(running)), running[1:])
        previous = later - running[time - 1]
        into = rows[later] * beta[later] / scale[later, None]
        moves = self.move * (alpha[previous].T @ into)
        emitted = np.stack([np.bincount(major, weights=gamma[:, k], minlength=SYMBOLS) for k in range(STATES)], 1)
        return np.concatenate([starts[None], moves, emitted])


def _arrays(batch: pa.RecordBatch, row: int, *names: str) -> list[np.ndarray]:
    return [batch.column(n)[row].values.to_numpy(zero_copy_only=False) if batch.column(n)[row].values is not None
            else np.empty(0) for n in names]


def expect(model: Hmm) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 + STATES + SYMBOLS, STATES))
        for batch in batches:
            for row in range(batch.num_rows):
                held, lengths = _arrays(batch, row, "held", "lengths")
                symbols = np.frombuffer(batch.column("symbols")[row].as_py(), np.int16)
                lengths = lengths.astype(np.int64) + 1
                use = ~held.astype(bool)
                if use.any():
                    for _, major, running in model.layout(symbols[np.repeat(use, lengths)], lengths[use]):
                        total += model.expected(major, running)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), *(pa.array(total[:, k]) for k in range(STATES))],
            names=["item", *(f"s{k}" for k in range(STATES))])
    return run


def score(model: Hmm, class_log: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, held, known, log_counts, lengths = _arrays(
                    batch, row, "doc_ids", "held", "known", "log_counts", "lengths")
                symbols = np.frombuffer(batch.column("symbols")[row].as_py(), np.int16)
                lengths = lengths.astype(np.int64) + 1
                chain = np.empty(len(lengths))
                for docs, major, running in model.layout(symbols, lengths):
                    _, scale, _ = model.forward(major, running)
                    chain[docs] = np.bincount(ragged(running)[1], weights=np.log10(scale), minlength=len(docs))
                doc = np.repeat(np.arange(len(lengths)), lengths)
                within = np.bincount(doc, weights=class_log[symbols], minlength=len(lengths))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[row].values, pa.array(held.astype(bool)), pa.array(lengths),
                     pa.array(known.astype(np.int64)), pa.array(log_counts),
                     pa.array(chain + within + log_counts)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "log_counts", "score"])
    return run


def sequences(docs: DataFrame) -> DataFrame:
    """Stored blocks of symbol sequences with exact word counts applied."""
    held = F.coalesce(fold(F.col("doc_id"), HELD_FOLD) == 1, F.lit(False))
    cut_up = staged(texts(docs).select("*", held.alias("held")).mapInArrow(cut, BLOCK), "lm_blocks")
    listed = cut_up.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "item")).select(
        "block", "place", F.col("item.words").alias("word"), F.col("item.counts").alias("n"))
    by_word = Window.partitionBy("word")
    short = F.octet_length("word") <= 5
    shape = F.concat(F.least(F.floor(F.octet_length("word") / 3), F.lit(6)).cast("string").cast("binary"),
                     F.expr("substring(word, -4, 4)"))
    counted = listed.select(
        "block", "place", F.sum("n").over(by_word).alias("count"),
        (F.row_number().over(by_word.orderBy("block")) == 1).alias("is_first"),
        (F.crc32(F.when(short, F.col("word")).otherwise(shape)) % CLASSES).cast("int").alias("symbol"))
    left = cut_up.select("block", "doc_ids", "held", "lengths", "places")
    return staged(left.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(to_sequences, SEQUENCES),
                  "lm_sequences")


def hmm_lm(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score."""
    ready(docs.sparkSession)
    rows = sequences(docs)
    # Sums of fixed size: tokens and distinct words per symbol, and training documents.
    sums = rows.select("class_tokens", "class_words").mapInArrow(_add_classes, "item int, tokens double, words double")
    class_tokens, class_words = np.zeros(SYMBOLS), np.zeros(SYMBOLS)
    for item, tokens, words in sums.groupBy("item").agg(F.sum("tokens"), F.sum("words")).collect():
        class_tokens[item], class_words[item] = tokens, words
    ends = rows.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    train_tokens = int(class_tokens.sum()) + ends
    distinct = int(class_words.sum()) + (ends > 0)

    model = Hmm.initial()
    for _ in range(ITERATIONS if ends else 0):
        columns = ["item", *(f"s{k}" for k in range(STATES))]
        parts = rows.select("held", "lengths", "symbols").mapInArrow(
            expect(model), "item long, " + ", ".join(f"s{k} double" for k in range(STATES)))
        total = np.zeros((1 + STATES + SYMBOLS, STATES))
        for item, *values in parts.groupBy("item").agg(*(F.sum(c).alias(c) for c in columns[1:])).collect():
            total[item] = values
        start, move, emit = total[0] + PRIOR, total[1:1 + STATES] + PRIOR, total[1 + STATES:] + PRIOR
        model = Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))

    # Within a class: (count + s) / (tokens + s (words + 1)); the end is alone in its symbol.
    class_log = -np.log10(class_tokens + SMOOTH * (class_words + 1))
    class_log[CLASSES] = 0.0
    scored = rows.select("doc_ids", "held", "known", "log_counts", "lengths", "symbols").mapInArrow(
        score(model, class_log), RESULT)
    base = (F.col("log_counts") + F.lit(float(np.log10(ends + SMOOTH)))
            - F.col("n_tokens") * F.lit(float(np.log10(train_tokens + SMOOTH * (distinct + 1)))))
    return scored.select("doc_id", "held_out", "n_tokens",
                         (F.col("n_known") + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
                         F.lit(train_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def _add_classes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, words = np.zeros(SYMBOLS), np.zeros(SYMBOLS)
    for batch in batches:
        for row in range(batch.num_rows):
            tokens += np.frombuffer(batch.column("class_tokens")[row].as_py())
            words += np.frombuffer(batch.column("class_words")[row].as_py())
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(SYMBOLS), pa.int32()), pa.array(tokens), pa.array(words)], names=["item", "tokens", "words"])
