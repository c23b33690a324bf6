"""Phrase collocations by HAT-trie counting.

Texts are lower-cased (A-Z) and split at punctuation and line ends into pieces, pieces at
blanks into words. Everything is counted per language.

1. Counting. A task adds, for every word, the phrase of two words from there to its
   language's trie of word ids. The trie is shallow: it starts as one hash container
   (phrase -> count), and a container that grows beyond BURST entries bursts into containers
   by the next bits of the ids, so frequent beginnings get paths of their own and rare ones
   share containers. A phrase counts once for all its beginnings; their counts are the sums
   over their subtrees.
2. Spilling. When the tries hold LIMIT entries, their largest subtrees are written out as
   sorted runs, (language, phrase, count) each, until half of it is free; at the end of the
   input all of it is. The runs of all tasks are files in the shared folder.
3. Merging. Runs are dealt to partitions by ranges of phrases - prefixes, split finer where
   many phrases share one -, sorted there, and neighbouring equal phrases (of one language)
   are summed in one pass over the sorted rows. A phrase has one row per run, however frequent.
4. Longer phrases. A phrase of three words can only be frequent if both of its pairs are.
   Frequent pairs are marked in a bitmap of at most FILTER_BITS (a wrong mark costs time,
   nothing else), and a second scan counts, spills and merges the phrases whose pairs are
   both marked.
5. Scoring. A part of a phrase is at least as frequent as the phrase, so the parts of the
   candidates are looked up among the frequent phrases alone.

Defined cases: a null or empty text has no words; a null language is ``und``. Repeated rows
count each, in any order of the rows. Texts are read whole; a long one is cut at its pieces.
Ties are ordered by count and phrase. Extra columns are ignored; without candidates the
result is empty.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, blocks, mix, ready, staged, utf8

SHORTEST, LONGEST, MIN_COUNT, TOP, COVER_PERCENT = 2, 3, 10, 2000, 50
#: Entries of a container before it bursts, of a task's trie before it spills, and words it knows.
BURST, LIMIT, VOCABULARY = 32_768, 1_200_000, 600_000
#: Bytes of text that are counted at once.
SLICE = 1 << 21
#: Rows of one record batch of a run.
RUN_ROWS = 1 << 16
#: Parts of a language whose best phrases are found on their own first.
TOP_PARTS = 64

#: A-Z lower-cased, tabs as spaces, the characters that end a piece as line ends.
PIECES = bytes(0x0A if chr(b) in ".,;:!?\n\v\f\r" else 0x20 if b == 0x09 else b for b in LOWER)
BITS = 21  # of a word id in a container's key
MASK = (1 << BITS) - 1
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bits of the bitmap of frequent pairs, at most (8 MB).
FILTER_BITS = 1 << 26
#: Bits of a key that a node branches on, and its branches.
DIGIT = 7
FAN = 1 << DIGIT
# A part of 2 SLICE bytes has fewer distinct words than this.
assert VOCABULARY + (1 << 16) + SLICE // 2 < MASK
#: Rows of a run: the phrase, a line end and the language; the totals have no phrase.
RUN = "phrase string, n long"


class Trie:
    """Counts of keys: the ids of up to three words, BITS each, the first one highest,
    and 0 where the phrase is over. A node branches on the next DIGIT bits of a key."""

    def __init__(self, words: int) -> None:
        self.root: Counter | list = Counter()
        self.bits = BITS * words
        self.total = 0

    def add(self, keys: np.ndarray) -> None:
        """Counts sorted keys, each as often as it is there."""
        self.root = self._add(self.root, keys, self.bits - DIGIT)

    def _add(self, node: Counter | list, keys: np.ndarray, shift: int) -> Counter | list:
        if isinstance(node, Counter):
            before = len(node)
            node.update(keys.tolist())
            self.total += len(node) - before
            return self._burst(node, shift) if len(node) > BURST and shift >= 0 else node
        digits = (keys >> np.int64(shift)) & (FAN - 1)
        start = np.flatnonzero(np.diff(digits, prepend=-1)).tolist()
        for a, b in zip(start, [*start[1:], len(keys)]):
            d = int(digits[a])
            node[d] = self._add(Counter() if node[d] is None else node[d], keys[a:b], shift - DIGIT)
        return node

    def _burst(self, container: Counter, shift: int) -> list:
        keys, counts = arrays([container])
        digits = (keys >> np.int64(shift)) & (FAN - 1)
        order = np.argsort(digits, kind="stable")
        keys, counts, digits = keys[order], counts[order], digits[order]
        start = np.flatnonzero(np.diff(digits, prepend=-1)).tolist()
        node: list = [None] * FAN
        for a, b in zip(start, [*start[1:], len(keys)]):
            node[int(digits[a])] = Counter(dict(zip(keys[a:b].tolist(), counts[a:b].tolist())))
        return node

    def containers(self) -> list[Counter]:
        found, open_nodes = [], [self.root]
        while open_nodes:
            node = open_nodes.pop()
            if isinstance(node, Counter):
                found.append(node)
            else:
                open_nodes += [x for x in node if x is not None]
        return found

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of the largest containers, until at most ``keep`` entries are left."""
        if not keep:
            out = arrays(self.containers())
            self.root, self.total = Counter(), 0
            return out
        leaving = []
        for container in sorted(self.containers(), key=len, reverse=True):
            if self.total <= keep:
                break
            self.total -= len(container)
            leaving.append(container)
        out = arrays(leaving)
        for container in leaving:
            container.clear()
        return out


def arrays(containers: list[Counter]) -> tuple[np.ndarray, np.ndarray]:
    n = sum(map(len, containers))
    return (np.fromiter(chain.from_iterable(containers), np.int64, n),
            np.fromiter(chain.from_iterable(c.values() for c in containers), np.int64, n))


def beginnings(keys: np.ndarray, counts: np.ndarray, longest: int, shortest: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Columns of ids and counts of the beginnings of the phrases, by length."""
    order = np.argsort(keys)
    keys, sums = keys[order], np.concatenate([[0], np.cumsum(counts[order])])
    for n in range(shortest, longest + 1):
        part = keys >> np.int64(BITS * (longest - n))
        start = np.flatnonzero(np.diff(part, prepend=-1))
        total = np.diff(np.append(sums[start], sums[-1]))
        whole = (part[start] & MASK) != 0  # others were over before their n-th word
        part, total = part[start][whole], total[whole]
        yield [(part >> np.int64(BITS * (n - 1 - k))) & MASK for k in range(n)], total


def parts_of(text: bytes, longest: int) -> Iterator[tuple[bytes, bytes]]:
    """A prepared text in parts of about SLICE bytes that end with a piece, each with an
    empty rest; a longer piece is cut at a blank, and the words that follow are the rest."""
    at = 0
    while at < len(text):
        end = text.find(b"\n", at + SLICE, at + 2 * SLICE)
        if end >= 0 or len(text) - at <= 2 * SLICE:
            end = len(text) if end < 0 else end + 1
            yield text[at:end], b""
        else:
            blank, line = text.find(b" ", at + SLICE), text.find(b"\n", at + SLICE)
            end = min((x for x in (blank, line) if x >= 0), default=len(text))
            yield text[at:end], following(text, end, longest - 1)
        at = end


def following(text: bytes, at: int, n: int) -> bytes:
    """The n words from a place on, as far as its piece goes."""
    size = 1 << 10
    while True:
        piece, *more = text[at:at + size].split(b"\n", 1)
        words = piece.split(b" ")
        if more or at + size >= len(text) or len([w for w in words if w]) > n:
            return b" ".join([w for w in words if w][:n])
        size *= 2


def gram_hashes(words: np.ndarray, lang: str, n: int) -> np.ndarray:
    """Hashes of all runs of n words of a language, from the words' hashes."""
    out = np.full(max(0, len(words) - n + 1), xxhash.xxh3_64_intdigest(lang.encode()), np.uint64)
    for k in range(n if len(out) else 0):
        out = (out ^ (out >> np.uint64(29))) * STEP + words[k:k + len(out)]
    return mix(out)


def gram_slots(n: int, bits: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.empty(batch.num_rows, np.int64)
            for i, (lang, phrase) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())):
                words = np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in phrase.split(" ")], np.uint64)
                slots[i] = int(gram_hashes(words, lang, n)[0]) % bits
            yield pa.RecordBatch.from_arrays([pa.array(slots)], names=["slot"])
    return run


def gram_filter(phrases: DataFrame, n: int) -> np.ndarray:
    """Bitmap of the frequent phrases of n words, 16 bits each as far as FILTER_BITS go."""
    grams = phrases.filter(F.col("n_words") == n)
    bits = min(FILTER_BITS, max(1 << 16, 1 << int(16 * grams.count()).bit_length()))
    slots = grams.select("lang", "phrase").mapInArrow(gram_slots(n, bits), "slot long")
    words = (slots.groupBy((F.col("slot") / 32).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 32 as int))")).alias("bits")).toArrow())
    out = np.zeros(bits // 32, np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slots = hashes % np.uint64(32 * len(bitmap))
    return (bitmap[(slots >> np.uint64(5)).astype(np.int64)] >> (slots & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0


def count_phrases(size: int, limit: int, shared=None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs of the phrases of up to two words, or with a bitmap of frequent shorter phrases
    (a broadcast) of those of ``size`` words."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value if shared else None
        tries: dict[str, Trie] = {}
        vocabulary = {b"\n": 0, b"": -1}
        hashes = array("Q")  # of the words of ids 1, 2, ...
        totals: Counter = Counter()

        def ids_of(text: bytes) -> np.ndarray:
            words = pc.split_pattern(pa.array([text.replace(b"\n", b" \n ")], pa.string()), " ").flatten().dictionary_encode()
            found = words.dictionary.cast(pa.binary()).to_pylist()
            for word in found:
                if word not in vocabulary:
                    vocabulary[word] = len(vocabulary) - 1
                    if shared:
                        hashes.append(xxhash.xxh3_64_intdigest(word))
            ids = np.fromiter(map(vocabulary.__getitem__, found), np.int64, len(found))[words.indices.to_numpy()]
            return ids[ids >= 0]

        def count(lang: str, text: bytes, rest: bytes) -> None:
            ids = ids_of(text)
            n = len(ids)
            ids = np.concatenate([ids, ids_of(rest), np.zeros(size, np.int64)])
            keys, alive = np.zeros(n, np.int64), np.ones(n, bool)
            for k in range(size):
                alive &= ids[k:k + n] > 0
                keys = (keys << np.int64(BITS)) | np.where(alive, ids[k:k + n], 0)
            if shared:
                known = np.concatenate([np.zeros(1, np.uint64), np.array(hashes, np.uint64)])
                frequent = marked(bitmap, gram_hashes(known[ids], lang, size - 1))
                keys = np.sort(keys[alive & frequent[:n] & frequent[1:n + 1]])
            else:
                keys = np.sort(keys[ids[:n] > 0])
                totals[lang] += len(keys)
            tries.setdefault(lang, Trie(size)).add(keys)

        def spilled(keep: int) -> Iterator[pa.RecordBatch]:
            """Until every language has at most ``keep`` entries."""
            names = pa.array([w for w, i in vocabulary.items() if i > 0], pa.binary())
            for lang, trie in tries.items():
                if trie.total > keep:
                    yield from sorted_run(lang, *trie.spill(keep), names, size, size if shared else 1)
            if not keep:
                tries.clear()

        for table in blocks(batches, limit=2 * SLICE):
            grouped: dict[str, list[bytes]] = defaultdict(list)
            for lang, text in zip(table.column("lang").to_pylist(), utf8(table)):
                grouped[lang].append(text)
            for lang, held in grouped.items():
                for part, rest in parts_of(b"\n".join(held).translate(PIECES), size):
                    count(lang, part, rest)
                    if len(vocabulary) > VOCABULARY:
                        yield from spilled(0)
                        vocabulary.clear()
                        vocabulary.update({b"\n": 0, b"": -1})
                        del hashes[:]
                    elif sum(t.total for t in tries.values()) > limit:
                        yield from spilled(limit // (2 * len(tries)))
        yield from spilled(0)
        yield pa.RecordBatch.from_arrays([pa.array([f"\n{lang}" for lang in totals], pa.string()),
                                          pa.array(list(totals.values()), pa.int64())], names=["phrase", "n"])
    return run


def sorted_run(lang: str, keys: np.ndarray, counts: np.ndarray, names: pa.Array, longest: int,
               shortest: int) -> Iterator[pa.RecordBatch]:
    """The phrases of some subtrees and their beginnings, by length and in order."""
    for ids, total in beginnings(keys, counts, longest, shortest):
        for at in range(0, len(total), RUN_ROWS):
            words = [names.take(pa.array(x[at:at + RUN_ROWS] - 1)) for x in ids]
            phrase = pc.binary_join_element_wise(*words, b" ") if len(words) > 1 else words[0]
            phrase = pc.binary_join_element_wise(phrase, lang.encode(), b"\n").cast(pa.string())
            order = pc.sort_indices(phrase)
            yield pa.RecordBatch.from_arrays([phrase.take(order), pa.array(total[at:at + RUN_ROWS]).take(order)],
                                             names=["phrase", "n"])


def merge_sorted(least: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums neighbouring rows of one phrase; keeps phrases of ``least`` and the totals."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the last phrase, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = (pa.concat_tables([held, table]) if held is not None else table).combine_chunks()
            phrase = table.column("phrase").chunk(0)
            new = np.ones(len(phrase), bool)
            new[1:] = pc.not_equal(phrase[1:], phrase[:-1]).to_numpy(zero_copy_only=False)
            start = np.flatnonzero(new)
            total = np.add.reduceat(table.column("n").to_numpy(), start)
            summed = table.take(pa.array(start)).set_column(1, "n", pa.array(total))
            held = summed.slice(summed.num_rows - 1).combine_chunks()
            yield from frequent(summed.slice(0, summed.num_rows - 1))
        if held is not None:
            yield from frequent(held)

    def frequent(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from rows.filter(pc.or_(pc.greater_equal(rows.column("n"), least), pc.starts_with(rows.column("phrase"), "\n"))).to_batches()
    return run


def phrase_counts(docs: DataFrame, longest: int, least: int, limit: int = LIMIT) -> DataFrame:
    """(lang, phrase, n_words, n) of the phrases of up to ``longest`` words with n >= least,
    and per language an empty phrase of 0 words whose n counts all words."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def merged(size: int, shared=None) -> DataFrame:
        runs = staged(rows.mapInArrow(count_phrases(size, limit, shared), RUN), "phrase_runs")
        dealt = runs.repartitionByRange("phrase").sortWithinPartitions("phrase")
        phrase = F.substring_index("phrase", "\n", 1)
        return staged(dealt.mapInArrow(merge_sorted(least), RUN).select(
            F.col("phrase").substr(F.length(phrase) + 2, F.length("phrase")).alias("lang"), phrase.alias("phrase"),
            F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " "))).alias("n_words"), "n"), "phrases")

    counts = part = merged(2)
    for size in range(3, longest + 1):
        part = merged(size, docs.sparkSession.sparkContext.broadcast(gram_filter(part, size - 1)))
        counts = counts.union(part)
    return counts


def collocations(docs: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, min_count: int = MIN_COUNT,
                 top: int = TOP, cover_percent: int = COVER_PERCENT, limit: int = LIMIT) -> DataFrame:
    """Per language the ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    if not 2 <= shortest <= longest <= 3:
        raise ValueError("phrases have 2 or 3 words")
    ready(docs.sparkSession)
    counts = phrase_counts(docs, longest, min_count, limit)
    known = counts.filter("n_words > 0")
    candidates = known.filter(F.col("n_words") >= shortest).select("lang", "phrase", "n_words", F.col("n").alias("a"))
    words = F.split("phrase", " ")

    def part(at: Column, n: Column) -> Column:
        return F.array_join(F.slice(words, at, n), " ")

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")).select(
        "lang", "phrase", "n_words", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    # Decimals of 38 digits hold 1000000 a a for a up to 10**16, and l r.
    score = F.expr("cast(1000000 as decimal(38,0)) * wide_a * wide_a div (wide_l * wide_r)")
    wide = {f"wide_{c}": F.col(c).cast("decimal(38,0)") for c in "alr"}
    best = (cuts.withColumns(wide).withColumn("score", score).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("m")))
    # Every part of a longer candidate, with the highest count of a phrase that holds it.
    longer = candidates.filter(F.col("n_words") > shortest).select("lang", "n_words", "a", "phrase").select(
        "lang", "a", "phrase", "n_words",
        F.explode(F.sequence(F.lit(shortest), F.col("n_words") - 1)).alias("size"))
    inside = (longer.select("lang", "a", "size", "phrase", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1)).alias("at"))
              .groupBy("lang", part(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("a").alias("cover")))
    kept = (best.join(inside, ["lang", "phrase"], "left")
            .filter(F.col("cover").isNull() | (100 * F.col("cover") < cover_percent * F.col("a")))
            .select("lang", "phrase", "a", "m.l", "m.r", "m.score"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    some = (kept.withColumn("bucket", bucket).withColumn("place", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order)))
            .filter(F.col("place") <= top))
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = counts.filter("n_words = 0").groupBy("lang").agg(F.sum("n").alias("all_words"))
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                             F.col("all_words").alias("n"), F.col("score").cast("long").alias("score"))
