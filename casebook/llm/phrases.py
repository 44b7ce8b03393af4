"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases, the phrases into phrases of phrases, and so on.
Where a phrase starts is decided by deterministic coin tossing: a symbol is relabelled by
the lowest bit in which it differs from the one before it, three times over, and labels
that are local maxima start phrases. Names are hashes of what a phrase spells, so equal
substrings get equal names wherever they lie, but for a few symbols at their ends. A
fingerprint keeps the smallest names of every level, a fixed number of each, and the
likeness of two fingerprints estimates the share of phrases that two texts have in
common: long texts fill the shares, most of which are high phrases; short texts have few
of these and are told by their low ones.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from casebook.llm import common

#: Names kept of each level, from the lowest; a phrase of the highest has about twenty bytes.
SHARES = (8, 16, 64)
#: A name's highest bits tell its level.
TAG = 30
#: Bytes parsed at a time, documents in a range of ids, and ranges at most (then wider).
CHUNK, RANGE, MOST_RANGES = 1 << 20, 2048, 1 << 16

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of each 64-bit number spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def _coin_table(bits: int) -> np.ndarray:
    """Label of (symbol, symbol before it): twice the lowest differing bit, plus that bit."""
    a, b = np.meshgrid(np.arange(1 << bits), np.arange(1 << bits), indexing="ij")
    differ = a ^ b
    low = np.bitwise_count((differ & -differ) - 1)
    label = 2 * low + ((a >> low) & 1)
    label[differ == 0] = 0
    return label.astype(np.uint8).ravel()


_TOSS8, _TOSS7 = _coin_table(8), _coin_table(7)


def _tossed(labels: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    pair = labels.astype(np.uint16) << np.uint16(bits)
    pair[1:] |= labels[:-1]
    pair[:1] |= labels[:1]
    return table[pair]


def _phrase_starts(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where phrases start; neighbours within a text differ, `first` marks texts' starts."""
    if symbols.dtype == np.uint8:
        labels = _tossed(symbols, _TOSS8, 8)
    else:
        differ = symbols.copy()
        differ[1:] ^= symbols[:-1]
        low = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1))
        labels = 2 * low + ((symbols >> low.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
        labels &= np.uint8(127)
    # A text's first symbol has nothing before it: its label must not tell what is.
    labels[first] = 0
    for _ in range(2):
        labels = _tossed(labels, _TOSS7, 7)
        labels[first] = 0
    start = np.zeros(len(labels), bool)
    start[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    # The last symbol of a text has no right neighbour; the next text's must not count.
    last = np.r_[first[1:] - 1, len(labels) - 1]
    start[last] = False
    start[first] = True
    return start


def _level(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of all texts, and where each text's start."""
    n = len(symbols)
    change = np.ones(n, bool)
    change[1:] = symbols[1:] != symbols[:-1]
    change[first] = True
    at = np.flatnonzero(change)
    run = np.diff(np.append(at, n)).astype(np.uint64)
    heads = symbols[at]
    first = np.searchsorted(at, first)
    start = _phrase_starts(heads, first)
    begin = np.flatnonzero(start)
    place = np.arange(len(heads), dtype=np.int64)
    place -= np.repeat(begin, np.diff(np.append(begin, len(heads))))
    spelled = _mixed(heads.astype(np.uint64) + run * _MIX[0] + place.astype(np.uint64) * _MIX[1])
    names = _mixed(np.add.reduceat(spelled, begin)) if len(begin) else spelled
    return names, np.searchsorted(begin, first)


def levels(data: np.ndarray, offsets: np.ndarray, upto: int = len(SHARES)) -> list:
    """(names, starts of texts) of levels 1 to `upto`; every text has a byte at least."""
    symbols, first = data, offsets[:-1]
    out = []
    for _ in range(upto):
        symbols, first = _level(symbols, first)
        out.append((symbols, first))
    return out


def sketches(texts: list[bytes]) -> list[np.ndarray]:
    """The smallest names of each text, SHARES of each level, ascending; none for an empty text."""
    out = [np.zeros(0, np.uint32) for _ in texts]
    full = [k for k, t in enumerate(texts) if t]
    if not full:
        return out
    sizes = np.array([len(texts[k]) for k in full])
    found = levels(np.frombuffer(b"".join(texts[k] for k in full), np.uint8), np.r_[0, np.cumsum(sizes)])
    keys = []
    for level, (symbols, first) in enumerate(found):
        owner = np.repeat(np.arange(len(full), dtype=np.uint64), np.diff(np.append(first, len(symbols))))
        name = _mixed(symbols + np.uint64(level)) >> np.uint64(64 - TAG)
        keys.append(owner << np.uint64(32) | np.uint64(level << TAG) | name)
    key = np.unique(np.concatenate(keys))
    group = key >> np.uint64(TAG)
    place = np.arange(len(key)) - np.searchsorted(group, group)
    key = key[place < np.array(SHARES)[(group & np.uint64(3)).astype(np.int64)]]
    edges = np.searchsorted(key >> np.uint64(32), np.arange(len(full) + 1))
    small = key.astype(np.uint32)
    for j, k in enumerate(full):
        out[k] = small[edges[j] : edges[j + 1]]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared phrases over the mean number of phrases (Dice), estimated from two sketches.

    Two empty texts are alike (1), an empty and another are not (0).
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared = seen = 0
    for level, most in enumerate(SHARES):
        x, y = a[a >> TAG == level], b[b >> TAG == level]
        union = np.union1d(x, y)
        if len(x) == most or len(y) == most:
            # Beyond its share a level says nothing, so only the smallest of both count.
            union = union[:most]
        shared += len(np.intersect1d(np.intersect1d(x, y), union))
        seen += len(union)
    return 2 * shared / (seen + shared)


def _hex(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the start of the next."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def _below(value: Column, cuts: list) -> Column:
    """How many of the ascending cuts lie below the value, by halving."""
    table = F.from_json(F.lit(json.dumps(cuts)), "array<bigint>")
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]

    def step(at: Column, size: Column) -> Column:
        reached = at + size
        # Beyond the last cut there is none to compare with.
        return F.when(F.coalesce(F.get(table, reached - 1) < value, F.lit(False)), reached).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step) if steps else F.lit(0)


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, text, part, carry: rows dealt and sorted so that each meets its next.

    The next document is the one before it in ascending order of ids; repeated ids go by
    text, null ids come last, and the last row's next is the first row. Ids are cut into
    ranges at quantiles. A range is sorted within one task, and the first row of the next
    range down comes along, marked as carried.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranges = max(1, min(-(-rows.count() // RANGE), MOST_RANGES))
    # As many numbers as there are ranges reach the driver and the executors.
    share = [k / ranges for k in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("doc_id", share, max(10_000, 4 * ranges)).alias("c")).first()["c"] if share else None
    cuts = sorted(set(cuts or []))

    # Range 0 is the highest; null ids form one below the lowest.
    part = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(len(cuts) - _below(F.col("doc_id"), cuts))
    dealt = rows.withColumn("part", part)
    tops = [(r["part"], r["top"]) for r in dealt.groupBy("part").agg(F.max("doc_id").alias("top")).orderBy("part").collect()]
    if not tops:
        return dealt.withColumn("carry", F.lit(False)).limit(0)
    # (part, its highest id) of each range goes to the range before it, the first to the last.
    before = {p: tops[k - 1][0] for k, (p, _) in enumerate(tops)}
    highest = rows.sparkSession.createDataFrame(
        [(p, before[p], top) for p, top in tops], f"part int, goes int, top {rows.schema['doc_id'].dataType.simpleString()}"
    )
    carried = (
        dealt.join(F.broadcast(highest), "part")
        .filter(F.col("doc_id").eqNullSafe(F.col("top")))
        .select("doc_id", "text", F.col("goes").alias("part"), F.lit(True).alias("carry"))
    )
    together = dealt.withColumn("carry", F.lit(False)).unionByName(carried)
    return together.repartitionById(ranges + 1, "part").sortWithinPartitions(
        "part", "carry", F.col("doc_id").desc_nulls_last(), "text"
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_chars, edited_sha256, both fingerprints, likenesses.

    Null texts are empty; an empty text's fingerprint is empty. Texts are read whole.
    """
    common.python_ready(docs.sparkSession)
    rows = neighbours(docs)

    def run(batches):
        pending, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "carry", "doc_id", "text"))):
                pending.append(row)
                size += len(row[3])
                if size >= CHUNK and len(pending) > 1:
                    yield from emit(pending)
                    pending, size = pending[-1:], len(pending[-1][3])
        yield from emit(pending)

    def emit(rows):
        """Results of all rows but the last, whose next is not known yet."""
        if len(rows) < 2:
            return
        texts = [r[3] for r in rows]
        own = [k for k in range(len(rows) - 1) if not rows[k][1]]
        if not own:
            return
        changed = [edited(texts[k], texts[k + 1]).encode() for k in own]
        plain, new = sketches([t.encode() for t in texts]), sketches(changed)
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array([rows[k][2] for k in own], id_type),
            "n_chars": pa.array([len(texts[k]) for k in own], pa.int64()),
            "edited_sha256": [hashlib.sha256(t).hexdigest() for t in changed],
            "fingerprint": [_hex(plain[k]) for k in own],
            "edited_fingerprint": [_hex(x) for x in new],
            "near_edited": pa.array([likeness(plain[k], x) for k, x in zip(own, new)], pa.float64()),
            "near_next": pa.array([likeness(plain[k], plain[k + 1]) for k in own], pa.float64()),
        })

    kind = rows.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    return rows.select("part", "carry", "doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
