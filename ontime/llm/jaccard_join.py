"""N-gram Jaccard join by a token-group matrix.

Documents are sets of hashed word shingles; two link when their Jaccard similarity is at
least 0.8. The result is each document's connected component, so within a set of documents
that is already known to be connected no further link is needed.

1. Sets. Equal sets become one class, represented by its smallest document.
2. Sieve. In the order of their hashes, two linked sets of sizes n and m share at least
   min(n // 8, m // 8) tokens among the first n - ceil(0.8 n) + n // 8 of each. A class
   with too few such tokens that occur in another class has no link and leaves here.
3. Groups. Similar classes are put in one group: each is compared with the smallest class
   that has the same min-hash, for a few hash functions, and groups are the components of
   the verified links.
4. Token-group matrix. A link between two groups can only use tokens that occur in several
   groups; classes with fewer than ceil(0.8 n) of them leave. For the others, a query class
   meets the groups (in blocks of bounded size) that hold one of its rarest such tokens (the
   prefix that every overlap must touch). A block stores the union of its members' tokens;
   only blocks whose union covers the overlap that a link needs are opened, and its members
   are compared exactly.

Steps 3 and 4 find a link between every two groups that have one, so the components are
exact. No group emits its pairs: a class is compared with a few others in step 3, and with
foreign groups only in step 4. Tokens with many documents are gathered per block of input
before they cross the shuffle.

Defined cases: a null text or one without words is an empty set, linked with nothing. Texts
of one to four words are one shingle of all their words. Repeated rows are members of one
class, and ties go to the smallest id. Rows of one id with different texts are members of
their own classes; where such an id represents two classes, one of them is looked up. Null ids count as members without an id of their own.
Extra columns are ignored; an empty table gives an empty result. Shingles are compared by
64-bit hashes, classes by 128-bit digests of their hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, blocks, id_filter, id_slot, in_filter, mix, ready, staged, texts, utf8
from .components import components

SHINGLE = 5
PERCENT = 80
#: The sieve looks at 1 / SIEVE of a set's tokens beyond the prefix that a link must touch.
SIEVE = 8
#: Hash functions of the grouping step.
SEEDS = 4
#: Members of a block of a group.
BLOCK_MEMBERS = 256
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                              0xA0761D6478BD642F)]
SETS = "doc_id long, n int, class binary, class_key long, prefix binary"


def needed(n: np.ndarray | int) -> np.ndarray | int:
    """Tokens that a set of n shares with any set it links to, at least."""
    return (PERCENT * n + 99) // 100


def shingle_sets(raw: list[bytes]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    known: dict[bytes, int] = {}
    for text in raw:
        words = text.translate(LOWER).split()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(SHINGLE, len(words))
        if not n:
            yield h
            continue
        windows = len(words) - n + 1
        out = np.full(windows, n, np.uint64)
        for k in range(n):
            out = (out ^ (out >> np.uint64(29))) * ODD[k] + h[k:k + windows]
        yield np.unique(mix(out))


def find_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in blocks(batches):
        sizes, classes, keys, prefixes = [], [], [], []
        for tokens in shingle_sets(utf8(table)):
            n = len(tokens)
            digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
            sizes.append(n)
            classes.append(digest)
            keys.append(int.from_bytes(digest[:8], "little", signed=True))
            prefixes.append(tokens[:n - needed(n) + max(1, n // SIEVE)].tobytes())
        yield pa.RecordBatch.from_arrays(
            [table.column("doc_id").combine_chunks(), pa.array(sizes, pa.int32()), pa.array(classes, pa.binary()),
             pa.array(keys, pa.int64()), pa.array(prefixes, pa.binary())],
            names=["doc_id", "n", "class", "class_key", "prefix"])


def by_token(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and token: the sets that have it, and the smallest and largest group."""
    for table in blocks(batches, "tokens"):
        sets = [np.frombuffer(t, np.int64) for t in table.column("tokens").to_pylist()]
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        tokens = np.concatenate(sets)
        ids, groups = table.column("id").to_numpy()[owner], table.column("part").to_numpy()[owner]
        order = np.lexsort((groups, tokens))
        tokens, ids, groups = tokens[order], ids[order], groups[order]
        start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.empty(0, int)
        end = np.append(start[1:], len(tokens))
        for at in range(0, len(start), 1 << 16):
            s, e = start[at:at + (1 << 16)], end[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[s]), pa.ListArray.from_arrays(
                    pa.array(np.append(s, e[-1]) - s[0], pa.int32()), pa.array(ids[s[0]:e[-1]])),
                 pa.array(groups[s]), pa.array(groups[e - 1])], names=["token", "ids", "low", "high"])


def shared_tokens(sets: DataFrame) -> DataFrame:
    """(id, shared) for sets (id, part, tokens): the tokens that also occur in another part."""
    rows = sets.mapInArrow(by_token, "token long, ids array<long>, low long, high long")
    same = Window.partitionBy("token")
    return (rows.withColumn("low", F.min("low").over(same)).withColumn("high", F.max("high").over(same))
            .filter("low < high").select("token", F.explode("ids").alias("id"))
            .groupBy("id").agg(F.collect_set("token").alias("shared")))


def full_sets(bitmap: bytes) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whole sets of the documents that may be in the filter, with their min-hashes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(bitmap, batch.column("slot").to_numpy())))
            for table in blocks([batch]):
                sets = list(shingle_sets(utf8(table)))
                keys = [[int(mix(s ^ ODD[k]).min().view(np.int64)) if len(s) else 0 for k in range(SEEDS)] for s in sets]
                raw = [s.tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [table.column("doc_id").combine_chunks(), pa.array(raw, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                     pa.array([hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary())],
                    names=["id", "tokens", "keys", "class"])
    return run


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose sets link."""
    for batch in batches:
        keep = [linked(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64))
                for x, y in zip(batch.column("a_tokens").to_pylist(), batch.column("b_tokens").to_pylist())]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def group_links(sets: DataFrame) -> DataFrame:
    """Verified links of each set with the smallest set of equal min-hash, per hash."""
    keyed = sets.select("id", F.posexplode("keys").alias("seed", "key"))
    pivots = keyed.groupBy("seed", "key").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    pairs = keyed.join(pivots, ["seed", "key"]).filter("id <> b").select(F.col("id").alias("a"), "b").distinct()
    tokens = sets.select("id", "tokens")
    both = (pairs.join(tokens.toDF("a", "a_tokens"), "a").join(tokens.toDF("b", "b_tokens"), "b"))
    return both.select("a", "b", "a_tokens", "b_tokens").mapInArrow(verify, "a long, b long")


def open_groups(key: tuple, queries: pa.Table, members: pa.Table) -> pa.Table:
    """Queries against one block of a group: the bound on the union, then the members. A
    group is connected already, so one link per query is enough."""
    out: list[tuple[int, int]] = []
    if queries.num_rows and members.num_rows:
        rows = members.column("tokens").to_pylist()
        sets = [np.frombuffer(t, np.int64) for t in rows]
        sizes, ids = members.column("n").to_numpy(), members.column("id").to_numpy()
        union, where = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        for query, n, tokens in zip(queries.column("id").to_pylist(), queries.column("n").to_pylist(),
                                    queries.column("tokens").to_pylist()):
            inside = np.isin(union, np.frombuffer(tokens, np.int64), assume_unique=True)
            if (100 + PERCENT) * inside.sum() < PERCENT * (n + sizes.min()):
                continue
            both = np.bincount(owner, weights=inside[where], minlength=len(sets)).astype(np.int64)
            hits = np.flatnonzero(100 * both >= PERCENT * (n + sizes - both))
            if len(hits):
                out.append((query, int(ids[hits[0]])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})


def cross_links(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Links between groups: one per query class and block of a group that has one."""
    part = sets.join(groups, F.col("id") == F.col("node"), "left").select(
        "id", "n", "tokens", F.coalesce("label", "id").alias("part"))
    shared = shared_tokens(part.select("id", "part", "tokens"))
    # Overlaps across groups consist of shared tokens only: the rest of a set plays no part.
    left = staged(part.select("id", "n", "part").join(shared, "id").filter(F.size("shared") >= F.ceil(F.col("n") * PERCENT / 100)),
                  "matrix")
    listed = left.select("id", "n", "part", F.explode("shared").alias("token"))
    spread = listed.groupBy("token").agg(F.count_distinct("part").alias("parts"))
    order = Window.partitionBy("id").orderBy("parts", "token")
    prefix = (listed.join(spread, "token").withColumn("place", F.row_number().over(order))
              .join(left.select("id", F.size("shared").alias("n_shared")), "id")
              .filter(F.col("place") <= F.col("n_shared") - F.ceil(F.col("n") * PERCENT / 100) + 1).filter("parts > 1")
              .select("id", "n", "part", "token", (F.col("n_shared") - F.col("place") + 1).alias("rest")))
    prefix = staged(prefix, "prefix")
    # The matrix: tokens by group, with the sizes of the members behind them and the most
    # tokens that any of them has from this one on.
    matrix = prefix.groupBy("token", F.col("part").alias("group")).agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("most"))
    # A link of sets of n and m tokens shares 80 (n + m) / 180 of them, all from the first
    # shared one on; so both sides must have as many left there.
    overlap = PERCENT * (F.col("n") + F.col("low"))
    met = (prefix.join(matrix, "token").filter("part > group")
           .filter((100 * F.col("n") >= PERCENT * F.col("low")) & (100 * F.col("high") >= PERCENT * F.col("n")))
           .filter(((100 + PERCENT) * F.col("rest") >= overlap) & ((100 + PERCENT) * F.col("most") >= overlap))
           .select("id", "group").distinct())
    as_bytes = left.select("id", "n", "part", "shared").mapInArrow(pack, "id long, n int, part long, tokens binary")
    rows = staged(as_bytes, "matrix_sets")
    sizes = rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS).cast("int").alias("blocks"))
    members = rows.join(sizes, "part").select(
        F.col("part").alias("group"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "n", "tokens")
    asked = (met.join(sizes.select(F.col("part").alias("group"), "blocks"), "group")
             .select("id", "group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
             .join(rows.select("id", "n", "tokens"), "id"))
    return (asked.select("group", "block", "id", "n", "tokens").groupBy("group", "block")
            .cogroup(members.groupBy("group", "block")).applyInArrow(open_groups, "a long, b long"))


def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = [np.sort(np.array(t, np.int64)).tobytes() for t in batch.column("shared").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("n"), batch.column("part"), pa.array(tokens, pa.binary())],
            names=["id", "n", "part", "tokens"])


def jaccard_join(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    ready(docs.sparkSession)
    rows = texts(docs)
    sets = staged(rows.mapInArrow(find_sets, SETS), "sets")
    classes = staged(sets.filter("n > 0").groupBy("class", "class_key", "n").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("members")), "classes")

    shared = shared_tokens(sets.filter("n > 0").select(
        F.col("class_key").alias("id"), F.col("class_key").alias("part"), F.col("prefix").alias("tokens")))
    few = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * PERCENT / 100) / SIEVE))
    alive = staged(classes.join(shared, F.col("class_key") == F.col("id")).filter(F.size("shared") >= few)
                   .filter("first is not null").select("first", "class", "n"), "alive")
    bitmap = id_filter(alive, "first")
    whole = rows.select("doc_id", "text", id_slot(F.col("doc_id")).alias("slot")).mapInArrow(
        full_sets(bitmap), "first long, tokens binary, keys array<long>, class binary")
    full = staged(whole.join(alive, ["first", "class"]).select(F.col("first").alias("id"), "n", "tokens", "keys")
                  .dropDuplicates(["id"]), "full_sets")

    links = staged(group_links(full), "links")
    groups = components(links)
    more = staged(cross_links(full, groups), "cross_links")
    labels = components(links.union(more))
    home = classes.select("class", F.col("first")).join(labels, F.col("first") == F.col("node"), "left").select(
        F.col("class").alias("of"), F.coalesce("label", "first").alias("component"))
    return (sets.select("doc_id", "n", "class").join(home, F.col("class") == F.col("of"), "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")))
