"""Byte-level BPE: ranked merges folded by Spark's higher-order functions.

Encoding has four steps:

1. A task cuts its documents into words with the tokenizer's pattern and gathers them in
   blocks of bounded size: the distinct words of a block, and each document as indices into
   them. Both are written to the shared folder as rows. A word that is itself an entry of the
   rank file has its id at once; there is nothing to fold.
2. The words of all blocks are brought together by word, so that Spark folds each distinct
   word of the corpus once (again only where a word's rows go on in the next batch). A word
   starts as an array of one-byte binaries; each step of the fold joins the leftmost
   neighbouring pair of the smallest rank, looked up in a literal rank map, until no pair
   has a rank. What is shuffled is one row per block and distinct word.
3. The words' ids go back to their blocks, packed per block (blocks are stored in buckets, so
   that only the ids are shuffled).
4. The indices are replaced by the ids; decoding concatenates the binary pieces of the ids.

The rank map is a literal (a scalar subquery over the rank file, whose size is that of the
vocabulary file): an array of small maps chosen by a hash, because a Spark map is searched
linearly. The fold keeps the ranks of all neighbouring pairs, so a merge costs two lookups
and a copy of the arrays; a word of n bytes costs at most n copies of n entries.

Defined cases: a null or empty text has no tokens (digests of zero bytes). Texts are
encoded whole, whatever their length. Repeated rows are encoded and returned each. Extra
columns are ignored. An empty table gives an empty result. Strings that look like special
tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path
from .common import blocks, ragged, ready, texts

BUCKETS = 1 << 15
NO_RANK = 2 ** 31 - 1
#: A block ends when it has this many distinct words, or words.
BLOCK_DISTINCT, BLOCK_WORDS = 400_000, 4_000_000
#: The same where the ids are returned: one task then holds a block's ids, those of copies included.
KEPT_WORDS = 2_000_000
#: Ids in one record batch of the result, about.
BATCH_IDS = 1 << 20
#: Bytes of text that are cut at once.
SLICE_BYTES = 2 << 20
#: Words in one record batch of a block's words.
WORD_ROWS = 10_000
#: Words of blocks that are folded in one row, about.
GATHERED = 50_000
#: Rows of a block: its slices of documents (texts: each document's number of a text; counts:
#: words per text; places: the words, packed), its words that are entries of the rank file (a row
#: without doc_ids; packed as ``spread`` does) and its other words (place, word).
BLOCK = "block long, doc_ids array<long>, texts array<int>, counts array<int>, places binary, place int, word binary"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>"


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: a base64 piece and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def rank_literal(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The rank map as one literal value: ``array<map<binary,int>>`` by hash bucket."""
    table = pa.table({"piece": pa.array(list(ranks), pa.binary()), "rank": pa.array(list(ranks.values()), pa.int32())})
    pieces = spark.createDataFrame(table).withColumn("bucket", _bucket(F.col("piece")))
    entries = pieces.groupBy("bucket").agg(F.collect_list(F.struct("piece", "rank")).alias("entries"))
    every = spark.range(BUCKETS).select((F.col("id") + 1).cast("int").alias("bucket")).join(entries, "bucket", "left")
    none = F.array().cast("array<struct<piece:binary,rank:int>>")
    row = every.agg(F.array_sort(F.collect_list(
        F.struct("bucket", F.coalesce("entries", none).alias("entries")))).alias("all"))
    return row.select(F.transform("all.entries", lambda e: F.map_from_entries(e))).scalar()


def _bucket(piece: Column) -> Column:
    return F.pmod(F.hash(piece), F.lit(BUCKETS)) + 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def encode_word(word: Column, literal: Column) -> Column:
    """Ids of one word (binary column), as a fold of ranked merges."""

    def rank(piece: Column) -> Column:
        return _let(piece, lambda p: F.coalesce(F.try_element_at(F.element_at(literal, _bucket(p)), p), F.lit(NO_RANK)))

    def merge(state: Column) -> Column:
        p, r = state["p"], state["r"]

        def at(i: Column) -> Column:
            """Join pieces i and i + 1 (from 0); the pairs beside them get new ranks."""
            def joined(both: Column) -> Column:
                pieces = F.transform(p, lambda x, k: F.when(k == i, both).otherwise(x))
                ranks = F.transform(r, lambda x, k: (
                    F.when(k == i - 1, rank(F.concat(F.element_at(p, i), both)))
                    .when(k == i + 1, rank(F.concat(both, F.element_at(p, i + 3)))).otherwise(x)))
                return F.struct(F.filter(pieces, lambda x, k: k != i + 1).alias("p"),
                                F.filter(ranks, lambda x, k: k != i).alias("r"))
            return _let(F.concat(F.element_at(p, i + 1), F.element_at(p, i + 2)), joined)

        return _let(F.array_min(r), lambda least: F.when(
            F.coalesce(least, F.lit(NO_RANK)) < NO_RANK,
            _let((F.array_position(r, least) - 1).cast("int"), at)).otherwise(state))

    n = F.octet_length(word)
    single = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(word, i, F.lit(1)))
    pairs = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1),
                                      lambda i: rank(F.substring(word, i, F.lit(2))))
                   ).otherwise(F.array().cast("array<int>"))
    steps = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))
    folded = F.aggregate(steps, F.struct(single.alias("p"), pairs.alias("r")),
                         lambda state, _: merge(state), lambda state: F.transform(state["p"], rank))
    return _let(rank(word), lambda whole: F.when(whole < NO_RANK, F.array(whole)).otherwise(folded))


def pack(numbers: np.ndarray) -> bytes:
    """32-bit numbers by byte planes, compressed: most high bytes are zero."""
    planes = np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", compression_level=6).compress(planes, asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(pa.decompress(packed[8:], size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def cut(pattern: str, ranks: dict[bytes, int], block_words: int = BLOCK_WORDS) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [field.split()[0] for field in BLOCK.split(", ")]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.int32(), pa.binary()]

    def rows(n: int, **columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[name], t) if name in columns else pa.nulls(n, t) for name, t in zip(names, types)], names=names)

    def block_rows(block: int, vocabulary: dict[str, int], slices: list[dict]) -> Iterator[pa.RecordBatch]:
        # Frequent words get small numbers, which pack well.
        count = np.bincount(np.concatenate([s["places"] for s in slices]), minlength=len(vocabulary))
        order = np.argsort(-count, kind="stable")
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order))
        for s in slices:
            yield rows(1, block=[block], **{k: [pack(number[v]) if k == "places" else v] for k, v in s.items()})
        known = list(vocabulary)
        words = [known[i].encode() for i in order.tolist()]
        ids = np.array([ranks.get(word, -1) for word in words], np.int32)
        whole = np.flatnonzero(ids >= 0)
        yield rows(1, block=[block], places=[pack(np.concatenate([[len(whole)], np.diff(whole, prepend=0), np.ones(len(whole), np.int32), ids[whole]]))])
        rest = np.flatnonzero(ids < 0).tolist()
        for at in range(0, len(rest), WORD_ROWS):
            part = rest[at:at + WORD_ROWS]
            yield rows(len(part), block=[block] * len(part), place=part, word=[words[i] for i in part])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        from pyspark import TaskContext

        words_of = regex.compile(pattern).findall
        block = TaskContext.get().partitionId() << 33
        vocabulary: dict[str, int] = {}
        slices, size = [], 0
        for table in blocks(batches, limit=SLICE_BYTES):
            numbers, counts, places = [], [], [np.empty(0, np.int32)]
            last = None  # neighbouring rows of one text, as mixing makes them, share its words
            for text in table.column("text").to_pylist():
                if text != last:
                    words = words_of(text)
                    for word in set(words).difference(vocabulary):
                        vocabulary[word] = len(vocabulary)
                    places.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
                    counts.append(len(words))
                    last = text
                size += len(words)
                numbers.append(len(counts) - 1)
            slices.append({"doc_ids": table.column("doc_id").to_pylist(), "texts": numbers, "counts": counts, "places": np.concatenate(places)})
            if len(vocabulary) >= BLOCK_DISTINCT or size >= block_words:
                yield from block_rows(block, vocabulary, slices)
                block, vocabulary, slices, size = block + 1, {}, [], 0
        if slices:
            yield from block_rows(block, vocabulary, slices)
    return run


def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (word, block, place), many as one row: the distinct words, and each place with the
    number of its word. The literal rank map is then copied once per such row, not per word."""
    def row(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        words = table.column("word").combine_chunks().dictionary_encode()
        columns = [words.dictionary, words.indices, *(table.column(c).combine_chunks() for c in ("block", "place"))]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(c)], c) for c in columns],
                                          names=["words", "word_of", "block", "place"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= GATHERED:
            yield row(held)
            held, size = [], 0
    if size:
        yield row(held)


def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of the distinct words dealt to their blocks, a row per block: the number of
    words, then the steps from place to place, the numbers of ids and the ids, packed."""
    for batch in batches:
        for b in range(batch.num_rows):
            row = batch.slice(b, 1)
            ids = row.column("ids").flatten()
            length = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            start = np.cumsum(length) - length
            block, place, word_of = (row.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("block", "place", "word_of"))
            order = np.lexsort((place, block))
            block, place, word_of = block[order], place[order], word_of[order]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]]).tolist()
            packed = []
            for lo, hi in zip(edges, edges[1:]):
                n = length[word_of[lo:hi]]
                run_of, offset = ragged(n)
                packed.append(pack(np.concatenate([[hi - lo], np.diff(place[lo:hi], prepend=0), n, flat[start[word_of[lo:hi]][run_of] + offset]])))
            yield pa.RecordBatch.from_arrays([pa.array(block[edges[:-1]]), pa.array(packed, pa.binary())], names=["block", "ids"])


def assemble(pieces: list[bytes], keep_ids: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Ids of a block's documents from ids of its words; decoding joins the pieces of the ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string()), ("ids", pa.list_(pa.int32()))])

    def run(slices: pa.Table, words: pa.Table) -> pa.Table:
        place, length, flat = [np.empty(0, np.int32)], [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        whole = slices.filter(pc.is_null(slices.column("doc_ids"))).column("places")
        slices = slices.filter(pc.is_valid(slices.column("doc_ids")))
        for packed in [*whole.to_pylist(), *words.column("ids").to_pylist()]:
            numbers = unpack(packed)
            n = numbers[0]
            place.append(np.cumsum(numbers[1:n + 1]))
            length.append(numbers[n + 1:2 * n + 1])
            flat.append(numbers[2 * n + 1:])
        place, length, flat = map(np.concatenate, (place, length, flat))
        # Words by place: their numbers of ids, and where their ids begin.
        lengths, start = np.zeros((2, len(place)), np.int64)
        lengths[place], start[place] = length, np.cumsum(length) - length
        flat = flat.astype("<u4")
        out: list[pa.RecordBatch] = []

        def encoded(places: np.ndarray) -> tuple:
            run_of, offset = ragged(lengths[places])
            ids = flat[start[places][run_of] + offset] if len(places) else np.empty(0, "<u4")
            decoded = b"".join(map(pieces.__getitem__, ids.tolist()))
            return (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest(),
                    ids.astype(np.int32) if keep_ids else None)

        for s in range(slices.num_rows):
            docs, text_of, counts = (slices.column(c)[s].values for c in ("doc_ids", "texts", "counts"))
            begin = np.concatenate([[0], np.cumsum(counts.to_numpy())])
            places = unpack(slices.column("places")[s].as_py())
            found, held, done, known = [], 0, 0, None
            for doc, text in enumerate(text_of.to_pylist()):
                if text != known:
                    row, known = encoded(places[begin[text]:begin[text + 1]]), text
                found.append(row)
                held += row[0]
                if held >= BATCH_IDS or doc + 1 == len(docs):
                    n, ids_sha, decoded_sha, ids = zip(*found)
                    out.append(pa.RecordBatch.from_arrays(
                        [docs.slice(done, len(found)), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                         pa.array(decoded_sha, pa.string()), pa.array(ids, pa.list_(pa.int32()))], schema=schema))
                    found, held, done = [], 0, doc + 1
        # What this block took and gave back goes to the system before the next one.
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches(out, schema)

    return run


def bucketed(rows: DataFrame) -> DataFrame:
    """``rows`` written to the shared folder in buckets by block, so that they are not shuffled
    again to meet the ids of their words. A task holds few blocks, so its files are few."""
    spark = rows.sparkSession
    path = scratch_path(spark, "bpe_blocks")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.option("path", path).option("compression", "zstd").bucketBy(n, "block").saveAsTable(name)
    return spark.table(name)


def byte_bpe(docs: DataFrame, rank_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids)."""
    spark = docs.sparkSession
    ready(spark)
    ranks = read_ranks(rank_path)
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    literal = rank_literal(spark, ranks)
    cut_up = bucketed(texts(docs).mapInArrow(cut(pattern, ranks, KEPT_WORDS if keep_ids else BLOCK_WORDS), BLOCK))
    by_word = cut_up.filter("word is not null").select("word", "block", "place").repartition("word").sortWithinPartitions("word")
    gathered = by_word.mapInArrow(gather, "words array<binary>, word_of array<int>, block array<long>, place array<int>")
    # explode of one element makes the literal a column; subqueries cannot stand in lambdas.
    with_ranks = gathered.select("*", F.explode(F.array(literal)).alias("ranks"))
    encoded = with_ranks.select("word_of", "block", "place", F.transform("words", lambda w: encode_word(w, F.col("ranks"))).alias("ids"))
    word_ids = encoded.mapInArrow(spread, "block long, ids binary")
    slices = cut_up.filter("word is null").select("block", "doc_ids", "texts", "counts", "places")
    rows = slices.groupBy("block").cogroup(word_ids.groupBy("block")).applyInArrow(assemble(pieces, keep_ids), SCHEMA)
    return rows if keep_ids else rows.drop("ids")
