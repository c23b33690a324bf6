"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Texts are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters.
The windows of the benchmark are its items' runs of ``n`` words; an item of fewer words is
one window. Their hashes, each with the SHA-256 of the window's words and the item it is
from, are the hash set. Tasks look up every window of a document's words in it; a hit is
verified by the SHA-256 of the document's own words before it counts. Words inside a
verified window are hit.

The set is broadcast in slices of at most about SLICE_BYTES, whatever the size of the
benchmark: one slice for a usual benchmark, else one scan per slice, whose spans and items
are brought together by document. Nothing else is shuffled.

Defined cases: a null or empty text has no words and no hits; an item without words has no
window. Texts are scanned whole, in pieces of bounded size when long. A window that several
items share counts for each of them; repeated documents are returned each. Null items count
as no item (their windows still hit). Extra columns are ignored by ``contamination`` and kept
by ``decontaminate``. Without documents the result is empty, without a benchmark nothing is hit.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, blocks, mix, ready, staged, texts, utf8

WINDOW = 10
#: Bytes of hash set entries in one broadcast.
SLICE_BYTES = 32 << 20
#: Bytes of one entry besides its item id: hash, SHA-256, length, places in arrays.
ENTRY_BYTES = 64
#: Bytes of a text that are cut into words at once, and distinct words a task remembers.
PIECE_BYTES, KNOWN_WORDS = 1 << 20, 500_000
#: Low bits of a hash that are looked up first.
SIEVE_BITS = 22

#: Letters, digits and bytes of non-ASCII characters as they are (A-Z lower-cased), the rest as blanks.
WORDS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in LOWER)
IS_WORD = np.frombuffer(WORDS, np.uint8) != 0x20
STEP = np.uint64(0x9E3779B97F4A7C15)
SPANS = "array<struct<first_word:long,end_word:long,first_char:long,end_char:long>>"
FOUND = f"key long, doc_id long, n_words long, spans {SPANS}, items array<string>"


def pieces(text: bytes) -> Iterator[bytes]:
    """The text with blanks between its words, in pieces that end where a word ends."""
    at = 0
    while at < len(text):
        end = at + PIECE_BYTES
        part = text[at:end].translate(WORDS)
        while end < len(text):  # to the end of the word that the piece stops in
            more = text[end:end + PIECE_BYTES].translate(WORDS)
            cut = more.find(b" ")
            part += more if cut < 0 else more[:cut]
            end += len(more) if cut < 0 else cut
            if cut >= 0:
                break
        yield part
        at = end


def word_hashes(text: bytes, known: dict[bytes, int]) -> np.ndarray:
    out = [np.empty(0, np.uint64)]
    for part in pieces(text):
        words = part.split()
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        out.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
    return np.concatenate(out)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    out = np.full(max(0, len(words) - n + 1), n, np.uint64)
    for k in range(n if len(out) else 0):
        out = (out ^ (out >> np.uint64(29))) * STEP + words[k:k + len(out)]
    return mix(out)


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = IS_WORD[np.frombuffer(text, np.uint8)]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def digest(low: bytes, first: np.ndarray, end: np.ndarray, at: int, n: int) -> bytes:
    return hashlib.sha256(b" ".join(low[a:b] for a, b in zip(first[at:at + n].tolist(), end[at:at + n].tolist()))).digest()


def item_windows(n: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for table in blocks(batches):
            for item, text in zip(table.column("item").to_pylist(), utf8(table)):
                h = word_hashes(text, known)
                size = min(n, len(h))
                if not size:
                    continue
                first, end = word_places(text)
                low, hashes = text.translate(LOWER), window_hashes(h, size)
                for at in range(0, len(hashes), 1 << 16):
                    part = hashes[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(part), pa.string()), pa.array(part.view(np.int64)),
                         pa.array([size] * len(part), pa.int32()),
                         pa.array([digest(low, first, end, at + i, size) for i in range(len(part))], pa.binary())],
                        names=["item", "hash", "words", "digest"])
    return run


def hash_set(entries: pa.Table) -> dict:
    """Entries (item, hash, words, digest) as what a task looks up."""
    hashes = entries.column("hash").to_numpy().view(np.uint64)
    sizes, digests = entries.column("words").to_numpy(), entries.column("digest").to_pylist()
    wanted: dict[bytes, list[int]] = {}
    for i, d in enumerate(digests):
        wanted.setdefault(d, []).append(i)
    return {"by_size": {int(n): np.unique(hashes[sizes == n]) for n in np.unique(sizes)}, "wanted": wanted,
            "items": entries.column("item").to_pylist()}


def in_set(hashes: np.ndarray, wanted: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """Places of the hashes that are in the sorted array."""
    maybe = np.flatnonzero(sieve[(hashes & np.uint64((1 << SIEVE_BITS) - 1)).astype(np.int64)])
    at = np.minimum(np.searchsorted(wanted, hashes[maybe]), len(wanted) - 1)
    return maybe[wanted[at] == hashes[maybe]]


def runs_of(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and end of every run of true values."""
    step = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def verified(text: bytes, n_words: int, candidates: list[tuple[int, int]], known: dict) -> tuple[list[dict], list[str]]:
    """Spans and items of the candidate windows (place, words) that the text really has."""
    first, end = word_places(text)
    low = text.translate(LOWER)
    cover, items = np.zeros(n_words + 1, np.int64), set()
    for at, n in candidates:
        found = known["wanted"].get(digest(low, first, end, at, n))
        if found:
            cover[at] += 1
            cover[at + n] -= 1
            items.update(known["items"][i] for i in found)
    begin, stop = runs_of(np.cumsum(cover[:-1]) > 0)
    if not len(begin):
        return [], []
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    spans = [{"first_word": int(b), "end_word": int(s), "first_char": int(chars[first[b]]), "end_char": int(chars[end[s - 1]])}
             for b, s in zip(begin, stop)]
    return spans, sorted(items - {None})


def scan(shared) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sieves = {}
        for n, wanted in known["by_size"].items():
            sieves[n] = np.zeros(1 << SIEVE_BITS, bool)
            sieves[n][(wanted & np.uint64((1 << SIEVE_BITS) - 1)).astype(np.int64)] = True
        cache: dict[bytes, int] = {}
        for table in blocks(batches, limit=4 << 20):
            counts, spans, items = [], [], []
            for text in utf8(table):
                h = word_hashes(text, cache)
                candidates = [(at, n) for n, wanted in known["by_size"].items()
                              for at in in_set(window_hashes(h, n), wanted, sieves[n]).tolist()]
                found = verified(text, len(h), candidates, known) if candidates else ([], [])
                counts.append(len(h))
                spans.append(found[0])
                items.append(found[1])
            yield pa.RecordBatch.from_arrays(
                [table.column("key").combine_chunks(), table.column("doc_id").combine_chunks(), pa.array(counts, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([(x, pa.int64()) for x in (
                     "first_word", "end_word", "first_char", "end_char")]))), pa.array(items, pa.list_(pa.string()))],
                names=["key", "doc_id", "n_words", "spans", "items"])
    return run


def merged(spans: Column) -> Column:
    """Overlapping or touching spans (arrays of several scans, in order) as one each."""
    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        both = F.struct(last["first_word"].alias("first_word"), F.greatest(last["end_word"], x["end_word"]).alias("end_word"),
                        last["first_char"].alias("first_char"), F.greatest(last["end_char"], x["end_char"]).alias("end_char"))
        return F.when((F.size(done) == 0) | (last["end_word"] < x["first_word"]), F.concat(done, F.array(x))).otherwise(
            F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(both)))

    return F.aggregate(F.array_sort(F.flatten(spans)), F.array().cast(SPANS), add)


def found_spans(keyed: DataFrame, benchmark: DataFrame, item: str, n: int, slice_bytes: int) -> DataFrame:
    """(key, doc_id, n_words, spans, items) of documents (key, doc_id, text)."""
    spark = keyed.sparkSession
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    entries = staged(items.mapInArrow(item_windows(n), "item string, hash long, words int, digest binary").distinct(), "windows")
    size = entries.agg(F.sum(F.coalesce(F.octet_length("item"), F.lit(0)) + ENTRY_BYTES)).first()[0] or 0
    slices = max(1, math.ceil(size / slice_bytes))
    part = F.pmod(F.xxhash64("digest", "item"), F.lit(slices))
    if slices > 1:  # several scans need the same keys
        keyed = staged(keyed, "keyed_texts")
    parts = []
    for k in range(slices):
        known = spark.sparkContext.broadcast(hash_set(entries.filter(part == k).toArrow()))
        found = keyed.mapInArrow(scan(known), FOUND)
        if slices == 1:
            return found
        parts.append(staged(found, "found"))
        known.unpersist()
    every = parts[0]
    for more in parts[1:]:
        every = every.union(more)
    # As many rows per document as there are slices.
    return every.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                                    merged(F.collect_list("spans")).alias("spans"),
                                    F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, item: str = "item_id", n: int = WINDOW,
                  slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    ``spans`` are the maximal runs of hit words, in words and in code points (ends exclusive)."""
    ready(docs.sparkSession)
    keyed = texts(docs).select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    found = found_spans(keyed, benchmark, item, n, slice_bytes)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end_word"] - x["first_word"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"), "spans")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", item: str = "item_id",
                  n: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The documents without their hit words (``remove="spans"``: cut out of the text, from
    the first character of a span to its last), or without those that have any
    (``remove="documents"``). The columns stay as they are."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    ready(docs.sparkSession)
    # The rows travel as one struct, so that their column names cannot clash with these.
    rows = staged(docs.select(F.monotonically_increasing_id().alias("key"), F.struct(*docs.columns).alias("row")), "keyed")
    keyed = rows.select("key", F.lit(None).cast("long").alias("doc_id"), F.coalesce("row.text", F.lit("")).alias("text"))
    hits = found_spans(keyed, benchmark, item, n, slice_bytes).filter(F.size("spans") > 0).select("key", "spans")
    if remove == "documents":
        return rows.join(hits, "key", "left_anti").select("row.*")
    text = F.col("row.text")
    ends = F.concat(F.transform("spans", lambda s: s["first_char"]), F.array(F.length(text).cast("long")))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["end_char"]))
    kept = F.concat_ws("", F.zip_with(starts, ends, lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))))
    columns = [F.when(F.col("spans").isNull(), text).otherwise(kept).alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    return rows.join(hits, "key", "left").select(*columns)
