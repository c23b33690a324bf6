"""Exact substring dedup over a column-wise multi-document suffix construction.

A byte is removed when a 100-byte string that covers it also starts earlier in the corpus.

1. Anchors. Each 100-byte window has an anchor: the smallest hash of the 32-byte strings in
   it. Equal windows have equal anchors, so windows that repeat meet under one anchor.
   Consecutive windows with one anchor form a segment (at most 168 bytes). Tasks collapse
   segments of equal content within a block; what is not first there is a repeat already.
2. Segments meet by anchor. Anchors that occur once, also within their segment, are dropped
   (nothing repeats there). A
   segment whose content occurred earlier is a repeat as a whole; the first segments of
   each content go on as strings of a collection.
3. Collections. All strings of an anchor go to one task, which builds the collection's
   Burrows-Wheeler transform and common prefixes column by column: each round inserts one
   symbol of every string, from the right end, and merges the new entries into the two
   arrays, which live in external files that are read and written once per round. In the
   result, neighbours with common prefixes of 100 bytes or more are repeats of the one that
   starts first.
4. The repeats of a document are united and cut out of its text.

Defined cases: a null text is the empty text. Texts shorter than 100 bytes lose nothing.
Ties: rows of one id are one document, so a repeated row repeats nothing, and its spans hold
for both rows. A null id counts as smaller than all others. Runs of one byte or a short
period are cut into segments of 69 windows. Extra columns are ignored; an empty table gives
an empty result. Anchors and contents are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, id_filter, id_slot, in_filter, mix, ragged, ready, staged, texts

MATCH = 100
GRAM = 32
WINDOW = MATCH - GRAM + 1
#: Strings in one collection, at most, unless one anchor alone has more.
COLLECTION = 8_000
#: Bytes that are hashed at once.
PIECE = 1 << 20
#: Bytes of text that a task works on at once.
SLICE_BYTES = 4 << 20
NULL_ID = -(1 << 63)
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                              0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
SEGMENTS = "doc_id long, start int, windows int, anchor long, content long, repeat boolean, inner boolean"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every place: four 8-byte words, read unaligned."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).copy()
    n = len(data) - GRAM + 1
    h = words[:n] * ODD[0]
    for k in (1, 2, 3):
        h ^= h >> np.uint64(31)
        h += words[8 * k:8 * k + n]
        h *= ODD[k]
    h ^= h >> np.uint64(29)
    h *= ODD[4]
    h ^= h >> np.uint64(32)
    return h


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        h = np.minimum(h[:-n], h[n:])
        n *= 2
    return np.minimum(h[:n - width], h[width - n:]) if width > n else h


def segments_of(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of pieces of text that stand in ``data``: segment starts, window counts, anchors,
    content hashes, and whether the anchor stands in several places of the segment (which
    may then repeat itself)."""
    h = gram_hashes(data)
    low = sliding_min(h, WINDOW)
    cut = np.ones(len(low) + 1, bool)
    cut[1:-1] = low[1:] != low[:-1]
    cut[begins] = True
    over = np.maximum(ends - MATCH + 1, begins)  # from here on windows would leave the piece
    inside = np.zeros(len(low) + 1, np.int32)
    np.add.at(inside, begins, 1)
    np.add.at(inside, over, -1)
    cut[over] = True
    start = np.flatnonzero(cut)
    size = np.diff(start)
    valid = np.cumsum(inside)[start[:-1]] > 0
    start, size = start[:-1][valid], size[valid]
    if len(size) and size.max() > WINDOW:  # a short period repeats: bounded parts
        run, place = ragged(-(-size // WINDOW))
        start, size = start[run] + place * WINDOW, np.minimum(size[run] - place * WINDOW, WINDOW)
    last = start + size + MATCH - 1 - GRAM
    content = h[start] * ODD[0] + size.astype(np.uint64) * ODD[6] + h[last] * ODD[1]
    for k, odd in zip(range(1, 5), ODD[2:]):
        content += mix(h[np.minimum(start + k * GRAM, last)] ^ odd) * odd
    anchor = low[start]
    grams = np.ndarray((len(low), WINDOW), h.dtype, h, strides=(8, 8))
    head, tail = (grams[x] == anchor[:, None] for x in (start, start + size - 1))
    inner = (head.sum(1) > 1) | (tail.sum(1) > 1) | (start + head.argmax(1) != start + size - 1 + tail.argmax(1))
    return start, size, anchor, mix(content), inner


def pieces(ids: list[int], raw: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Documents, offsets and bytes of pieces, about PIECE bytes together; longer texts come
    in pieces that overlap by all but one byte of a window."""
    group: tuple[list[int], list[int], list[bytes]] = ([], [], [])
    size = 0
    for doc, text in zip(ids, raw):
        for at in range(0, len(text) - MATCH + 1, PIECE):
            part = text[at:at + PIECE + MATCH - 1]
            for x, value in zip(group, (doc, at, part)):
                x.append(value)
            size += len(part)
            if size >= PIECE:
                yield group
                group, size = ([], [], []), 0
    if size:
        yield group


def find_segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of all texts; of equal ones in a block, all but the first are repeats."""
    for table in blocks(batches, limit=SLICE_BYTES):
        table = table.sort_by("doc_id")
        found, owner = [], []
        for docs, offsets, parts in pieces(table.column("doc_id").to_pylist(),
                                           table.column("text").cast(pa.binary()).to_pylist()):
            ends = np.cumsum([len(x) for x in parts])
            begins = np.concatenate([[0], ends[:-1]])
            start, *rest = segments_of(np.frombuffer(b"".join(parts), np.uint8), begins, ends)
            part = np.searchsorted(begins, start, side="right") - 1
            found.append((start - begins[part] + np.array(offsets)[part], *rest))
            owner.append(np.array(docs, np.int64)[part])
        if not found:
            continue
        start, count, anchor, content, inner = (np.concatenate(x) for x in zip(*found))
        doc = np.concatenate(owner)
        key = anchor ^ content * ODD[3]
        order = np.argsort(key, kind="stable")  # rows stand by document and start
        doc, start, count, anchor, content, inner, key = (x[order] for x in (doc, start, count, anchor, content, inner, key))
        same = np.zeros(len(doc), bool)
        same[1:] = key[1:] == key[:-1]
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(doc))))
        repeat = (doc != doc[first]) | (start != start[first])
        for at in range(0, len(doc), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[part]), pa.array(start[part].astype(np.int32)), pa.array(count[part].astype(np.int32)),
                 pa.array(anchor[part].view(np.int64)), pa.array(content[part].view(np.int64)), pa.array(repeat[part]),
                 pa.array(inner[part])],
                names=["doc_id", "start", "windows", "anchor", "content", "repeat", "inner"])


def external(folder: str, name: str, kind: type, size: int) -> np.ndarray:
    """An array in a file of the given folder."""
    return np.memmap(os.path.join(folder, name), kind, "w+", shape=(size,))


def collection_order(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, start, group) of all places with MATCH or more bytes to come; places of one
    group agree in MATCH bytes.

    Column-wise construction over symbols of two bytes: a string takes part twice, cut into
    pairs from its end and from one byte before its end, so that every place begins a pair.
    Entry 0 to n-1 are the empty suffixes. The symbol stored at an entry is the one before
    its suffix, so the stable order of the stored symbols is the order of the suffixes that
    are one symbol longer; a round thus knows where each next suffix belongs. Both arrays
    are read from one external file and written to another, in turn. UTF-8 has no byte 255,
    so symbols are pairs plus one and 0 marks a beginning.
    """
    cut = [s[len(s) % 2:] for s in strings] + [s[(len(s) + 1) % 2:-1] for s in strings]
    n = len(cut)
    lengths = np.array([len(s) // 2 for s in cut])
    data = np.frombuffer(b"".join(cut), "<u2") + np.uint16(1)
    ends = np.cumsum(lengths)
    total = n + int(lengths.sum())
    with tempfile.TemporaryDirectory(prefix="collection-") as folder:
        symbols = [external(folder, f"bwt{k}", np.uint16, total) for k in (0, 1)]
        prefixes = [external(folder, f"lcp{k}", np.uint8, total) for k in (0, 1)]
        symbols[0][:n] = data[ends - 1]
        at, string = np.arange(n), np.empty(total, np.int32)
        size = n
        for length in range(1, int(lengths.max()) + 1):
            bwt, lcp = symbols[0][:size], prefixes[0][:size]
            active = np.flatnonzero(lengths >= length)
            string[at[active]] = active
            fresh = np.zeros(size, bool)
            fresh[at[active]] = True
            order = np.argsort(bwt, kind="stable")[size - np.count_nonzero(bwt):]
            fresh = fresh[order]
            places = np.flatnonzero(fresh)
            added = string[order[places]]
            places += n
            at[added] = places
            size = n + len(order)
            old = np.ones(size, bool)
            old[places] = False
            # common prefixes change for new entries and for those right after them
            touched = np.zeros(size + 1, bool)
            touched[places] = touched[places + 1] = True
            touched = np.flatnonzero(touched[:size])
            here, before = order[touched - n], order[np.maximum(touched - n - 1, 0)]
            inner = (touched > n) & (bwt[here] == bwt[before])
            values = np.zeros(len(touched), np.uint8)
            values[inner] = range_min(lcp, before[inner] + 1, here[inner] + 1) + 1
            merged = prefixes[1][:size]
            merged[old] = lcp
            merged[touched] = values
            merged = symbols[1][:size]
            merged[old] = bwt
            merged[places] = np.where(lengths[added] > length, data[np.maximum(ends[added] - length - 1, 0)], 0)
            symbols.reverse()
            prefixes.reverse()
        bwt, group = np.array(symbols[0][:size]), np.cumsum(prefixes[0][:size] < MATCH // 2)
    # Walk back from the empty suffixes to name the entries of long suffixes.
    order = np.argsort(bwt, kind="stable")[size - np.count_nonzero(bwt):]
    step = np.full(size, -1)
    step[order] = n + np.arange(len(order))
    at, out = np.arange(n), []
    whole = np.array([len(s) for s in strings])
    for length in range(1, int(lengths.max()) + 1):
        active = np.flatnonzero(lengths >= length)
        at[active] = step[at[active]]
        if length >= MATCH // 2:
            owner = active % len(strings)
            out.append((owner, whole[owner] - active // len(strings) - 2 * length, group[at[active]]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, int),) * 3


def range_min(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Minimum of values[first:end] for every pair (each range has an element)."""
    order = np.argsort(first, kind="stable")
    pairs = np.stack([first[order], end[order]], 1).ravel()
    out = np.empty(len(first), values.dtype)
    out[order] = np.minimum.reduceat(np.append(values, np.uint8(255)), pairs)[::2] if len(pairs) else 0
    return out


def repeats(strings: list[bytes], doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, place) of the MATCH-byte windows that start earlier elsewhere."""
    owner, offset, group = collection_order(strings)
    window_doc, place = doc[owner], start[owner] + offset
    order = np.lexsort((place, window_doc, group))
    group, window_doc, place = group[order], window_doc[order], place[order]
    later = np.zeros(len(group), bool)
    later[1:] = group[1:] == group[:-1]
    return window_doc[later], place[later]


def spans(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows united to (document, start, end) spans."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    cut = np.ones(len(doc), bool)
    cut[1:] = (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + MATCH)
    at = np.flatnonzero(cut)
    last = np.append(at, len(doc))[1:] - 1
    return doc[at], place[at], place[last] + MATCH


def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats among strings that arrive sorted by anchor: whole anchors make a collection."""

    def found(table: pa.Table) -> pa.RecordBatch:
        doc, start, end = spans(*repeats(table.column("string").to_pylist(), table.column("doc_id").to_numpy(),
                                         table.column("start").to_numpy().astype(np.int64)))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], names=["doc_id", "start", "end"])

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows >= COLLECTION:
            anchor = held.column("anchor").to_numpy()
            last = int(np.argmax(anchor == anchor[-1]))  # the last anchor may go on
            if last:
                yield found(held.slice(0, last))
                held = held.slice(last)
    if held is not None and held.num_rows:
        yield found(held)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        pa.default_memory_pool().release_unused()


def cut_strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted segments."""
    for batch in slices(batches):
        for text, doc, wanted in zip(batch.column("text").cast(pa.binary()).to_pylist(),
                                     batch.column("doc_id").to_pylist(), batch.column("wanted").to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([w["anchor"] for w in wanted], pa.int64()), pa.array([doc] * len(wanted), pa.int64()),
                 pa.array([w["start"] for w in wanted], pa.int32()),
                 pa.array([text[w["start"]:w["start"] + w["windows"] + MATCH - 1] for w in wanted], pa.binary())],
                names=["anchor", "doc_id", "start", "string"])


def cut_out(text: bytes, pieces: list[dict]) -> tuple[bytes, int, int]:
    """(what is left, removed bytes, maximal removed runs)."""
    left, at, removed, runs = [], 0, 0, 0
    for start, end in sorted((p["start"], p["end"]) for p in pieces):
        if start > at or not runs:
            left.append(text[at:start])
            runs += 1
            removed += end - start
            at = end
        elif end > at:
            removed += end - at
            at = end
    left.append(text[at:])
    return b"".join(left), removed, runs


def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        gone, runs, digests = [], [], []
        for text, digest, pieces in zip(batch.column("text").cast(pa.binary()).to_pylist(),
                                        batch.column("sha256").to_pylist(), batch.column("pieces").to_pylist()):
            removed = n = 0
            if text is not None:
                left, removed, n = cut_out(text, pieces or [])
                digest = hashlib.sha256(left).hexdigest()
            gone.append(removed)
            runs.append(n)
            digests.append(digest)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
             pa.array(digests, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def within(bitmap: bytes) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows whose id may be in the filter."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(in_filter(bitmap, batch.column("slot").to_numpy()))).drop_columns(["slot"])
    return run


def without_texts(bitmap: bytes) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts that surely lose nothing are replaced by their size and digest."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = in_filter(bitmap, batch.column("slot").to_numpy()).tolist()
            raw = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([t.decode() if k else None for t, k in zip(raw, keep)], pa.string()),
                 pa.array(list(map(len, raw)), pa.int64()),
                 pa.array([None if k else hashlib.sha256(t).hexdigest() for t, k in zip(raw, keep)], pa.string())],
                names=["doc_id", "text", "n_bytes", "sha256"])
    return run


def meeting(segments: DataFrame) -> DataFrame:
    """Segments of anchors that occur twice or more, with ``first`` (first of its content)
    and ``open`` (the anchor has several contents, or repeats within the segment)."""
    # Repeats found within a block are settled; a group of their own keeps them spread.
    meet = F.when(F.col("repeat"), F.xxhash64("doc_id", "start")).otherwise(F.col("anchor"))
    rows = segments.select("*", meet.alias("meet"))
    anchor = Window.partitionBy("repeat", "meet")
    by_content = anchor.orderBy("content", "doc_id", "start")
    same = Window.partitionBy("repeat", "meet", "content").orderBy("doc_id", "start")
    return (rows.withColumn("place", F.rank().over(same))
            .withColumn("before", F.lag("content").over(by_content)).withColumn("after", F.lead("content").over(by_content))
            .filter("repeat or inner or before is not null or after is not null")
            .withColumn("open", F.col("inner") | (F.min("content").over(anchor) < F.max("content").over(anchor)))
            .select("doc_id", "start", "windows", "anchor",
                    (~F.col("repeat") & (F.col("place") == 1)).alias("first"), "open"))


def removed_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end) byte spans of repeats; spans of a document may overlap."""
    rows = staged(meeting(docs.mapInArrow(find_segments, SEGMENTS)), "segments")
    whole = rows.filter("not first").select("doc_id", "start", (F.col("start") + F.col("windows") + MATCH - 1).alias("end"))
    wanted = rows.filter("first and open").distinct().groupBy("doc_id").agg(
        F.collect_list(F.struct("anchor", "start", "windows")).alias("wanted"))
    bitmap = id_filter(rows.filter("first and open"), "doc_id")
    sources = docs.select("doc_id", "text", id_slot(F.col("doc_id")).alias("slot")).mapInArrow(
        within(bitmap), "doc_id long, text string")
    strings = sources.join(wanted, "doc_id").mapInArrow(
        cut_strings, "anchor long, doc_id long, start int, string binary")
    inner = strings.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        search, "doc_id long, start int, end int")
    return staged(whole.union(inner), "spans")


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    ready(docs.sparkSession)
    rows = texts(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)))
    found = removed_spans(rows)
    per_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("pieces"))
    with_texts = rows.select("doc_id", "text", id_slot(F.col("doc_id")).alias("slot")).mapInArrow(
        without_texts(id_filter(found, "doc_id")), "doc_id long, text string, n_bytes long, sha256 string")
    out = with_texts.join(per_doc, "doc_id", "left").select("doc_id", "text", "n_bytes", "sha256", "pieces").mapInArrow(
        remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NULL_ID)))
