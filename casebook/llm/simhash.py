"""SimHash near-duplicates by pigeonring filtering.

A 64-bit fingerprint is cut into a ring of eight segments. Two fingerprints with at
most three differing bits have a start segment from which every chain of l consecutive
segments holds at most floor(3 * l / 8) differences: chains of one and two segments
none, of three to five at most one, of six and seven at most two. So the first two
segments agree, and of the next three at least two. Those four segments make a join
key; eight starts times three choices give 24 keys of 32 bits each. Within a key the
remaining chains are tested, then the full distance.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import common

SEED = 42
SEGMENTS, WIDTH, MOST = 8, 8, 3
#: A key's group up to this many fingerprints is compared pair by pair in memory.
BLOCK = 256
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _segment(k: int) -> int:
    return ((1 << WIDTH) - 1) << (WIDTH * (k % SEGMENTS))


def _chain(start: int, length: int) -> int:
    return sum(_segment(start + k) for k in range(length))


#: (start segment, bits that must agree) of every key.
KEYS = [
    (start, _segment(start) | _segment(start + 1) | _segment(start + a) | _segment(start + b))
    for start in range(SEGMENTS)
    for a, b in combinations((2, 3, 4), 2)
]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def fingerprint(data: bytes, words: int = 3) -> int:
    """SimHash of the lower-cased words' shingles; zero where there is no word."""
    tokens = data.translate(LOWER).split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*(tokens[k:] for k in range(words)))))
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(x, SEED) for x in shingles), np.uint64, len(shingles)
    )
    ones = np.zeros(64, np.int64)
    # Byte-wise sums of unpacked bits, few enough rows at a time to stay in cache.
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of every row; stored.

    Null and empty texts have fingerprint zero. Other columns are not read.
    """
    common.python_ready(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long"

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            found = np.fromiter(
                (fingerprint(x.as_py(), words) for x in texts), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"]
            )

    return common.stored(rows.mapInArrow(run, schema), "simhash", free=True)


def _in_ring(x: np.ndarray, start: int) -> np.ndarray:
    """Whether differences x keep to the budget of every chain from a start segment."""
    ok = np.bitwise_count(x) <= MOST
    for length in range(1, SEGMENTS):
        part = x & np.uint64(_chain(start, length))
        ok &= np.bitwise_count(part) <= MOST * length // SEGMENTS
    return ok


def _trees(fps: np.ndarray, start: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links from each fingerprint to the first of its cluster, for one small group."""
    near = _in_ring(fps[:, None] ^ fps[None, :], start)
    top = np.arange(len(fps))
    while True:
        lower = np.where(near, top[None, :], len(fps)).min(axis=1)
        if (lower == top).all():
            break
        top = np.minimum(lower, lower[lower])
    moved = top != np.arange(len(fps))
    return [(fps[moved], fps[top[moved]])]


def _linked(fps: np.ndarray, start: int, free: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what lies within reach in a group that agrees outside `free`.

    A large group is cut by its free bits, dealt to four parts: three differences leave
    one part alike, so every near pair meets in a smaller group.
    """
    if len(fps) < 2:
        return []
    if len(fps) <= BLOCK or len(free) < 8:
        return _trees(fps, start)
    links = []
    for part in np.array_split(np.array(free), MOST + 1):
        mask = np.uint64(sum(1 << int(b) for b in part))
        order = np.argsort(fps & mask, kind="stable")
        ranked = fps[order]
        edges = np.flatnonzero(np.diff(ranked & mask, prepend=~(ranked[:1] & mask)))
        rest = [b for b in free if b not in set(part.tolist())]
        for a, b in zip(edges, np.append(edges[1:], len(ranked))):
            links += _linked(ranked[a:b], start, rest)
    return links


def _group_links(keys: np.ndarray, which: np.ndarray, fps: np.ndarray) -> list:
    """Links of all groups in rows sorted by key."""
    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (which[1:] != which[:-1])])
    sizes = np.diff(np.append(first, len(keys)))
    links = []
    pairs = first[sizes == 2]
    x = fps[pairs] ^ fps[pairs + 1]
    for start in range(SEGMENTS):
        near = (which[pairs] // 3 == start) & _in_ring(x, start)
        links.append((fps[pairs[near] + 1], fps[pairs[near]]))
    for at, size in zip(first[sizes > 2], sizes[sizes > 2]):
        start, mask = KEYS[which[at]]
        free = [b for b in range(64) if not mask >> b & 1]
        links += _linked(fps[at : at + size], start, free)
    return links


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): links among distinct fingerprints that connect all within three bits.

    Clusters inside a key's group come out as trees, never as all their pairs.
    """
    common.python_ready(distinct.sparkSession)
    choices = F.array(*[
        F.struct(
            F.lit(k).cast("byte").alias("which"),
            F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(mask)))).alias("k"),
        )
        for k, (_, mask) in enumerate(KEYS)
    ])
    keyed = distinct.select("fp", F.explode(choices).alias("c")).select("c.k", "c.which", "fp")
    dealt = keyed.repartition("k").sortWithinPartitions("k", "which")

    def run(batches):
        left = None
        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "which", "fp")]
            rows = now if left is None else [np.concatenate(x) for x in zip(left, now)]
            keys = rows[0]
            # The last key may go on in the next batch.
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            left = [x[cut:] for x in rows]
            if cut:
                yield from emit([x[:cut] for x in rows])
        if left is not None and len(left[0]):
            yield from emit(left)

    def emit(rows):
        found = _group_links(rows[0], rows[1].astype(np.int64), rows[2].view(np.uint64))
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with a link.

    Alternates large and small stars (neighbours above a node move to its smallest
    neighbour, those below likewise) until every component is a star, which further
    rounds would not change; every round is stored, and what it shuffled leaves the disk.
    The number of rounds grows with the logarithm of the longest path. Links that are
    stars already take none.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = common.stored(edges.filter("u <> v").distinct(), "links", free=True)
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # As many rows as edges, some of them repeated.
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = common.stored(large, "large-stars", free=True)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v")))
        edges = common.stored(small.filter("u <> v").distinct(), "small-stars", free=True)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every u of the distinct links (u, v) has one v and is nobody's v."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.filter("up > 0 and up + down > 1").agg(F.count(F.lit(1))).first()[0]


def near_groups(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fp, component_id of every row: the smallest id reachable over links.

    Rows with one fingerprint are one node, so copies are never paired. Null ids keep
    null where no other row of the component has an id. Empty table: no rows.
    """
    rows = fingerprints(docs, words)
    nodes = common.stored(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes", free=True)
    near = links(nodes.select("fp"))
    roots = components(near)
    # Components are found on fingerprints; their smallest document id follows.
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = common.stored(named.withColumn("root", F.coalesce("root", "fp")), "simhash-roots", free=True)
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    final = common.stored(named.select("fp", "root").join(least, "root").select("fp", "component_id"), "simhash-components", free=True)
    return rows.join(final, "fp").select("doc_id", "fp", "component_id")


def kept_rows(docs: DataFrame, keepers: DataFrame) -> DataFrame:
    """The rows with the ids and text hashes (stay, t), each once, columns as they were."""
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("t"))
    same = F.col("row.doc_id").eqNullSafe(F.col("stay")) & (rows["t"] == keepers["t"])
    return rows.join(keepers, same).select("row", "stay", rows["t"]).dropDuplicates(["stay", "t"]).select("row.*")


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of every near group the row with the smallest id, columns as they were.

    Null ids come last. Among rows of that id the one with the smallest text hash stays.
    """
    hashed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("t")).alias("doc_id"), "text")
    rows = fingerprints(hashed)
    rank = F.struct(F.isnull("doc_id.doc_id").alias("void"), "doc_id.doc_id", "doc_id.t")
    nodes = common.stored(rows.groupBy("fp").agg(F.min(rank).alias("rep")), "simhash-nodes", free=True)
    named = nodes.join(components(links(nodes.select("fp"))).withColumnRenamed("node", "fp"), "fp", "left")
    best = named.groupBy(F.coalesce("root", "fp")).agg(F.min("rep").alias("rep"))
    return kept_rows(docs, common.stored(best.select(F.col("rep.doc_id").alias("stay"), "rep.t"), "simhash-keepers", free=True))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_groups(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
