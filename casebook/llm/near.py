"""Near-duplicates by the Jaccard similarity of word shingles, checked exactly.

Documents that may be near are found by the SimHash operator: fingerprints of their
shingles, linked by its pigeonring search, make a group of every component. At a
similarity of 0.8 about 15 % of a SimHash's bits differ, too many for keys on its
segments, so groups by minimum hashes stand beside: 192 of them in 32 bands of six, of
which a pair with similarity 0.8 shares one or more with odds of 0.99994. Only documents
of one group are ever compared, by their shingle sets. In each group all are first
compared with one leader, twice over, which joins families of copies in linear time;
what is joined is one component and needs no comparison any more. Only in groups that
still hold several components all pairs are compared. Such a group is cut into parts
and every pair of parts is a task's group, so no task holds a large one.

Null and empty texts have no shingle and are alike. A text of fewer words than a
shingle is one shingle. Texts with one set are one node, known by a 128-bit digest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import common, simhash

WORDS = 5
#: Least Jaccard similarity, as a fraction.
LEAST = (4, 5)
BANDS, ROWS = 32, 6
#: About so many documents of a band's group are a part; all pairs are compared by two parts.
PART = 128
_DRAWN = np.random.default_rng(simhash.SEED).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64)
_TIMES, _PLUS = _DRAWN[0] << np.uint64(1) | np.uint64(1), _DRAWN[1]


def shingles(data: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased words' shingles."""
    tokens = data.translate(simhash.LOWER).split()
    if len(tokens) <= words:
        found = {b" ".join(tokens)} if tokens else set()
    else:
        found = set(map(b" ".join, zip(*(tokens[k:] for k in range(words)))))
    hashes = (xxhash.xxh64_intdigest(x, simhash.SEED) for x in found)
    return np.unique(np.fromiter(hashes, np.uint64, len(found)))


def bands(found: np.ndarray) -> list[int]:
    """A signed key for every band of a shingle set's minimum hashes."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    # Few enough rows at a time to stay in cache.
    for at in range(0, len(found), 512):
        some = found[at : at + 512, None] * _TIMES + _PLUS
        np.minimum(least, some.min(axis=0), out=least)
    rows = least.reshape(BANDS, ROWS)
    return [simhash._signed(xxhash.xxh64_intdigest(rows[k].tobytes(), k)) for k in range(BANDS)]


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, t (hash of the text), node, fp (SimHash) and the band keys of every row; stored."""
    common.python_ready(docs.sparkSession)
    rows = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, t long, node binary, fp long, keys array<long>"

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            nodes, fps, keys = [], [], []
            for x in texts:
                data = x.as_py()
                found = shingles(data, words)
                fps.append(simhash._signed(simhash.fingerprint(data, words)))
                nodes.append(xxhash.xxh3_128_digest(found.tobytes(), words))
                keys.append(bands(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("t"), pa.array(nodes, pa.binary()),
                    pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "t", "node", "fp", "keys"],
            )

    return common.stored(rows.mapInArrow(run, schema), "near-sketches", free=True)


def rings(rows: DataFrame) -> DataFrame:
    """(node, k): nodes by the component of their fingerprints that pigeonring search links."""
    fps = common.stored(rows.select("fp", "node").distinct(), "near-fingerprints", free=True)
    roots = simhash.components(simhash.links(fps.select("fp").distinct()))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return named.select("node", F.xxhash64(F.lit("ring"), F.coalesce("root", "fp")).alias("k"))


def members(rows: DataFrame) -> DataFrame:
    """(k, node) of every group of two nodes or more, by fingerprint or band; stored."""
    keyed = rings(rows).union(rows.select("node", F.explode("keys").alias("k"))).distinct()
    shared = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k")
    return common.stored(keyed.join(shared, "k"), "near-members", free=True)


def shingle_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, found): the sorted shingle hashes of the wanted nodes, as bytes; stored."""
    texts = docs.select(F.xxhash64("text").alias("t"), "text")
    # Equal texts have one node: any of their rows will do. The join leaves rows dealt by
    # t, so texts do not move again.
    chosen = nodes.join(wanted, "node", "left_semi").select("node", "rep.t")
    taken = chosen.join(texts, "t").dropDuplicates(["t", "node"]).select("node", "text")

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            made = pa.array([shingles(x.as_py(), words).tobytes() for x in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), made], ["node", "found"])

    return common.stored(taken.mapInArrow(run, "node binary, found binary"), "near-sets", free=True)


def _near(a: np.ndarray, b: np.ndarray, least: tuple[int, int]) -> bool:
    """In whole numbers: both / (a + b - both) >= p / q."""
    p, q = least
    if min(len(a), len(b)) * q < max(len(a), len(b)) * p:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * (p + q) >= p * (len(a) + len(b))


def verified(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sets are near. Each is a row of its own, so one node in a
    third of all pairs makes no group; the join splits such a key."""
    first = sets.select(F.col("node").alias("a"), F.col("found").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("found").alias("y"))

    def run(batches):
        for batch in batches:
            x, y = (batch.column(c).to_pylist() for c in ("x", "y"))
            kept = [_near(np.frombuffer(m, np.uint64), np.frombuffer(n, np.uint64), least) for m, n in zip(x, y)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def alike(sets: list[np.ndarray], least: tuple[int, int] = LEAST) -> np.ndarray:
    """For each set the first one reachable over pairs that are near."""
    sizes = np.array([len(x) for x in sets], np.int64)
    _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    # Shingles of one set alone are in no intersection.
    shared = counts[ids] > 1
    ids, owner = ids[shared], owner[shared]
    edges = np.searchsorted(owner, np.arange(len(sets) + 1))
    both = np.diag(sizes)
    held = np.zeros(len(counts), bool)
    for k in range(len(sets)):
        own = ids[edges[k] : edges[k + 1]]
        held[own] = True
        later = slice(edges[k + 1], None)
        both[k] += np.bincount(owner[later][held[ids[later]]], minlength=len(sets))
        held[own] = False
    both = np.maximum(both, both.T)
    near = both * (least[0] + least[1]) >= least[0] * (sizes[:, None] + sizes[None, :])
    top = np.arange(len(sets))
    while True:
        lower = np.where(near, top[None, :], len(sets)).min(axis=1)
        if (lower == top).all():
            return top
        top = np.minimum(lower, lower[lower])


def _rooted(held: DataFrame, roots: DataFrame) -> DataFrame:
    """(k, node, root) of the groups that still hold several components."""
    named = held.join(roots, "node", "left").select("k", "node", F.coalesce("root", "node").alias("root"))
    several = named.groupBy("k").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return common.stored(named.join(several.select("k"), "k"), "near-open", free=True)


def links(docs: DataFrame, nodes: DataFrame, rows: DataFrame, words: int = WORDS, least: tuple[int, int] = LEAST) -> DataFrame:
    """(a, b): links among nodes that connect all near pairs that share a band.

    What a step linked goes on as a link of each node to its root, and only groups that
    are still open are looked at again.
    """
    held = members(rows)
    sets = shingle_sets(docs, nodes, held.select("node"), words)
    leader = held.groupBy("k").agg(F.min("node").alias("b"))
    pairs = held.join(leader, "k").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
    roots = simhash.components(verified(pairs, sets, least))
    left = _rooted(held, roots)
    # A second leader, of another component than the first.
    low = left.groupBy("k").agg(F.max(F.struct("root", "node")).alias("last"))
    pairs = left.join(low, "k").filter("root <> last.root")
    pairs = pairs.select(F.col("node").alias("a"), F.col("last.node").alias("b")).distinct()
    found = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = simhash.components(found.union(verified(pairs, sets, least)))
    rest = all_pairs(_rooted(left.select("k", "node"), roots), sets, least)
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(rest)


def all_pairs(left: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(a, b): trees that connect all near pairs within the groups of (k, node, root)."""
    parts = left.groupBy("k").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node"), "parts").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    dealt = left.join(parts, "k").join(sets, "node").select("k", "node", "found", own.alias("own"), other)
    group = F.xxhash64("k", F.least("own", "other"), F.greatest("own", "other")).alias("g")
    dealt = dealt.select(group, "node", "found").repartition("g").sortWithinPartitions("g", "node")

    def run(batches):
        key, names, kept = None, [], []
        for batch in batches:
            for g, node, x in zip(*(c.to_pylist() for c in batch.columns)):
                if g != key:
                    yield from emit(names, kept)
                    key, names, kept = g, [], []
                names.append(node)
                kept.append(np.frombuffer(x, np.uint64))
        yield from emit(names, kept)

    def emit(names, kept):
        if len(names) < 2:
            return
        top = alike(kept, least)
        pairs = [(names[k], names[t]) for k, t in enumerate(top.tolist()) if t != k]
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*pairs)], ["a", "b"])

    return dealt.mapInArrow(run, "a binary, b binary")


def keepers(docs: DataFrame, words: int = WORDS, least: tuple[int, int] = LEAST) -> DataFrame:
    """(stay, t): smallest id and the text hash of one row of every near group."""
    rows = sketches(docs, words)
    rank = F.struct(F.isnull("doc_id").alias("void"), "doc_id", "t")
    nodes = common.stored(rows.groupBy("node").agg(F.min(rank).alias("rep")), "near-nodes", free=True)
    roots = simhash.components(links(docs, nodes, rows, words, least))
    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = named.groupBy("root").agg(F.min("rep").alias("rep"))
    return common.stored(best.select(F.col("rep.doc_id").alias("stay"), "rep.t"), "near-keepers", free=True)


def one_of_each(docs: DataFrame, words: int = WORDS, least: tuple[int, int] = LEAST) -> DataFrame:
    """Of every near group the row with the smallest id, columns as they were.

    Null ids come last. Among rows of that id the one with the smallest text hash stays.
    """
    return simhash.kept_rows(docs, keepers(docs, words, least))
