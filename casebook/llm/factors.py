"""Substring dedup over bytes by longest-previous-factor arrays.

Put all places of all texts in the order of the bytes that follow them. The longest
factor that a place shares with an earlier document is shared with the nearest place
before or after it in that order whose document is smaller: its previous or next smaller
value. Where that factor has `width` bytes or more, a later copy starts, and it goes.

One order over a whole corpus would pass through one task, so places are split first by
what any two equal windows of `width` bytes must have in common: the anchor, the least of
the window's ANCHOR-byte hashes. Windows with one anchor follow one another and travel
together, as one segment of the text. Equal segments are merged where they are read and
again where they meet; the places of those that still differ are put in order, group by
group. An anchor met too often for a group hands its windows to groups of their own by a
longer stretch they have in common, and where that is frequent too, by all their bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import common

WIDTH, ANCHOR = 50, 8
#: Bytes of text read at a time, segments of a group, and windows put in order at a time.
CHUNK, GROUP = 1 << 22, 1 << 18
#: Every so many segments one is counted to find frequent anchors.
SAMPLE = 64

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_LOW = np.uint64(0xFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    x = (x ^ (x >> np.uint64(29))) * _A
    return x ^ (x >> np.uint64(32))


class Bytes:
    """Bytes that can be loaded eight at a time from any places."""

    def __init__(self, data: bytes, margin: int):
        self.size = len(data)
        held = data + bytes(margin + 8)
        self.low = np.ndarray(len(held) - 7, "<u8", held, strides=(1,))
        self.high = np.ndarray(len(held) - 7, ">u8", held, strides=(1,))

    def digests(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the `length` bytes from each place."""
        total = np.full(len(at), length, np.uint64)
        for j in range(0, length, 8):
            word = self.low[at + j]
            if length - j < 8:
                word = word << np.uint64(8 * (8 - length + j))
            total = (total ^ word) * _A
            total ^= total >> np.uint64(29)
        return _mixed(total)

    def words(self, at: np.ndarray, j: int, length: int) -> np.ndarray:
        """The j-th eight of `length` bytes from each place, as numbers in the order of bytes."""
        word = self.high[at + 8 * j].astype(np.uint64)
        left = length - 8 * j
        return word >> np.uint64(8 * (8 - left)) if left < 8 else word


class Shape:
    """Sizes that follow from the width of a window.

    levels are the ways to cut the windows of one anchor, by how far the anchor lies
    from their start: all together, two halves, one by one.
    """

    def __init__(self, width: int):
        if width < ANCHOR:
            raise ValueError(f"windows have at least {ANCHOR} bytes")
        self.width = width
        self.most = width - ANCHOR + 1
        self.row = -(-(width - 1 + self.most) // 8) * 8
        self.levels = [[0, self.most], sorted({0, -(-self.most // 2), self.most}), list(range(self.most + 1))]
        fits = np.arange(self.row) < np.arange(width, width + self.most)[:, None]
        #: By number of windows: which bytes of a row belong to the segment.
        self.masks = (fits * np.uint8(255)).astype(np.uint8).view(np.uint64)


class Segments:
    """Segments of some rows: row, start in the text, first window's distance to the anchor,
    number of windows, whether the row has an equal one, and the bytes, a row of the same
    size for each."""

    def __init__(self, row, start, far, count, twice, content):
        self.row, self.start, self.far, self.count = row, start, far, count
        self.twice, self.content = twice, content

    def __len__(self):
        return len(self.row)

    def of(self, chosen: np.ndarray) -> "Segments":
        return Segments(*(c[chosen] for c in (self.row, self.start, self.far, self.count, self.twice, self.content)))

    def digests(self) -> np.ndarray:
        total = self.count.astype(np.uint64)
        for j in range(self.content.shape[1]):
            total = (total ^ self.content[:, j]) * _A
            total ^= total >> np.uint64(29)
        return _mixed(total)


def anchored(data: Bytes, offsets: np.ndarray, shape: Shape):
    """(row, place, anchor's place, number of windows) of every segment of the texts."""
    n = data.size - shape.width + 1
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - shape.width + 1, 0)
    if n <= 0 or not windows.any():
        return [np.zeros(0, np.int64)] * 4
    assert ANCHOR == 8
    # Hash above, place below: the least one is the leftmost of the least hashes.
    least = (_mixed(data.low[: data.size - ANCHOR + 1] * _A) & ~_LOW) | np.arange(data.size - ANCHOR + 1, dtype=np.uint64)
    span = 1
    while 2 * span <= shape.most:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = shape.most - span
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    owner = np.repeat(np.arange(len(sizes)), windows)
    place = np.arange(len(owner)) + (offsets[:-1] - np.cumsum(windows) + windows)[owner]
    anchor = (least[place] & _LOW).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
    return owner[first], place[first], anchor[first], np.diff(np.r_[first, len(owner)])


def cut(row, place, anchor, count, edges: list[int]):
    """The segments cut at the distances `edges`: (row, place, anchor, count, lo, hi) pieces."""
    far = anchor - place
    near = far - count + 1
    for lo, hi in zip(edges, edges[1:]):
        a, b = np.maximum(near, lo), np.minimum(far, hi - 1)
        k = np.flatnonzero(a <= b)
        yield row[k], anchor[k] - b[k], anchor[k], b[k] - a[k] + 1, lo, hi


def keyed(data: Bytes, pieces, shape: Shape, level: int):
    """(pieces, keys): the key hashes what all windows of a piece have in common."""
    for row, place, anchor, count, lo, hi in pieces:
        key = data.digests(anchor - lo, shape.width - (hi - 1 - lo))
        yield (row, place, anchor, count), _mixed(key ^ np.uint64(1000 * level + lo))


def merged(found: Segments, doc: np.ndarray):
    """(kept, later, alike): of equal segments those of the smallest document, those beyond
    it, and which of the kept are equal.

    Segments come with ascending documents and rows. A row needs an equal segment once and
    is marked: what goes of it, goes wherever the row has it. Digests only bring equal
    segments together; they are merged by their bytes.
    """
    digest = found.digests()
    order = np.argsort(digest, kind="stable")
    digest, row, count = digest[order], found.row[order], found.count[order]
    same = (digest[1:] == digest[:-1]) & (count[1:] == count[:-1])
    check = np.flatnonzero(same)
    same[check] = (found.content[order[check]] == found.content[order[check + 1]]).all(axis=1)
    new = np.r_[True, ~same]
    of = doc[row]
    head = of[new][np.cumsum(new) - 1] if len(of) else of
    once = np.r_[True, row[1:] != row[:-1]] | new
    found.twice[order] |= ~once | np.r_[~once[1:], False]
    return order[once & (of == head)], order[once & (of > head)], np.cumsum(new)[once & (of == head)]


def suffix_order(data: Bytes, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): places sorted by their `width` bytes, and how many of these each place
    shares with the one before it. Word by word; only places still tied go on."""
    order = np.arange(len(at))
    lcp = np.zeros(len(at), np.int64)
    tied = np.r_[False, np.ones(max(len(at) - 1, 0), bool)]
    open_ = np.arange(len(at))
    for j in range(-(-width // 8)):
        if not len(open_):
            break
        run = np.cumsum(~tied[open_])
        word = data.words(at[order[open_]], j, width)
        turn = np.lexsort((word, run)) if j else np.argsort(word, kind="stable")
        order[open_], word = order[open_[turn]], word[turn]
        different = word[1:] ^ word[:-1]
        inner = np.flatnonzero(tied[open_])
        x = different[inner - 1]
        left = min(8, width - 8 * j)
        zeros = sum((x < np.uint64(1 << (8 * b))).astype(np.int64) for b in range(left))
        lcp[open_[inner]] = 8 * j + zeros
        tied[open_[inner]] = x == 0
        near = tied[open_] | np.r_[tied[open_][1:], False]
        open_ = open_[near]
    return order, lcp


def previous_factors(doc: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """By place in suffix order: bytes shared with a place of a smaller document, 0 if below least.

    Pointers to the nearest smaller value jump along one another: all places that a
    pointer passes have documents no smaller than its own.
    """
    if not len(doc):
        return np.zeros(0, np.int64)

    def nearest(doc, lcp):
        to, depth = np.arange(len(doc)) - 1, lcp.copy()
        active = np.flatnonzero(depth >= least)
        while True:
            active = active[(depth[active] >= least) & (to[active] >= 0)]
            active = active[doc[to[active]] >= doc[active]]
            if not len(active):
                return np.where((depth >= least) & (to >= 0), depth, 0)
            by = to[active]
            # Read before written: all jumps of a round start from the same state.
            depth[active], to[active] = np.minimum(depth[active], depth[by]), to[by]

    before = nearest(doc, np.r_[0, lcp[1:]])
    after = nearest(doc[::-1], np.r_[0, lcp[1:][::-1]])[::-1]
    return np.maximum(before, after)


def copied(found: Segments, doc: np.ndarray, shape: Shape):
    """(segment, first window, number of windows) runs of later copies in segments that differ.

    Half of an anchor's windows have a longer stretch in common; windows whose stretch
    no other segment has are left out before any order is made.
    """
    width = shape.width
    data = Bytes(found.content.tobytes(), shape.row)
    base = np.arange(len(found)) * shape.row
    pieces, keys = zip(*keyed(data, cut(np.arange(len(found)), base, base + found.far, found.count, shape.levels[1]), shape, 1))
    segment, place, _, count = (np.concatenate(c) for c in zip(*pieces))
    _, number, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    shared = times[number] > 1
    segment, place, count = segment[shared], place[shared], count[shared]
    owner = np.repeat(np.arange(len(segment)), count)
    at = np.arange(len(owner)) + (place - np.cumsum(count) + count)[owner]
    order, lcp = suffix_order(data, at, width)
    factor = previous_factors(doc[found.row[segment[owner[order]]]], lcp, width)
    goes = np.zeros(len(at), bool)
    goes[order] = factor >= width
    at = np.sort(at[goes])
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    # Rows of content lie apart by more than a window, so no run crosses them.
    return at[first] // shape.row, at[first] % shape.row, np.diff(np.r_[first, len(at)])


def _planes(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers as planes of bytes, compressed; the first as steps."""
    out = []
    for k, column in enumerate(columns):
        column = column.astype(np.int64)
        if k == 0:
            column = np.diff(column, prepend=np.int64(0))
        out.append(np.ascontiguousarray(column.view(np.uint8).reshape(-1, 8).T).tobytes())
    return zstandard.compress(b"".join(out), 3)


def _columns(blob: bytes, n: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(n, 8, -1)
    out = [np.ascontiguousarray(p.T).view(np.int64).ravel() for p in planes]
    out[0] = np.cumsum(out[0])
    return out


def _trimmed(content: np.ndarray, count: np.ndarray, shape: Shape) -> bytes:
    """The segments' bytes one after the other, without what fills their rows; compressed."""
    return zstandard.compress(content.view(np.uint8)[shape.masks[count - 1].view(np.uint8) > 0].tobytes(), 6)


def _filled(data: bytes, count: np.ndarray, shape: Shape) -> np.ndarray:
    rows = np.zeros((len(count), shape.row), np.uint8)
    rows[shape.masks[count - 1].view(np.uint8) > 0] = np.frombuffer(data, np.uint8)
    return rows.view(np.uint64)


def _by_bucket(doc, tag, start, count, twice, buckets: int):
    """(bucket, blob) of runs of windows that go, here or wherever the row has them, by bucket of rows."""
    bucket = tag % buckets
    order = np.lexsort((start, tag, doc, bucket))
    bucket = bucket[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(bucket))):
        k = order[a:b]
        yield int(bucket[a]), _planes(doc[k], tag[k], start[k], count[k], twice[k])


class Chunk:
    """Some rows by ascending document, their texts and their segments after merging."""

    def __init__(self, rows: list[tuple[int, int, bytes]], shape: Shape):
        # Rows alike in id and tag are one row.
        rows = sorted({(doc, tag): text for doc, tag, text in rows}.items())
        self.doc = np.array([k[0] for k, _ in rows], np.int64)
        self.tag = np.array([k[1] for k, _ in rows], np.int64)
        self.offsets = np.cumsum([0] + [len(t) for _, t in rows])
        self.data = Bytes(b"".join(t for _, t in rows), shape.row)
        self.shape = shape

    def segments(self, row, place, anchor, count) -> Segments:
        words = [self.data.low[place + 8 * j] for j in range(self.shape.row // 8)]
        content = np.stack(words, 1) & self.shape.masks[count - 1]
        return Segments(row, place - self.offsets[row], anchor - place, count, np.zeros(len(row), bool), content)

    def keyed(self, heavy: list[np.ndarray]):
        """(segments, keys, later segments): cut as finely as their keys are frequent."""
        waiting = [anchored(self.data, self.offsets, self.shape)]
        for level, edges in enumerate(self.shape.levels):
            ready, keys, again = [], [], []
            for piece in waiting:
                for part, key in keyed(self.data, cut(*piece, edges), self.shape, level):
                    often = np.isin(key, heavy[level]) if level < len(heavy) and len(heavy[level]) else np.zeros(len(key), bool)
                    again.append([c[often] for c in part])
                    ready.append([c[~often] for c in part])
                    keys.append(key[~often])
            row, place, anchor, count = (np.concatenate(c) for c in zip(*ready))
            key = np.concatenate(keys)
            order = np.argsort(row, kind="stable")
            found = self.segments(row[order], place[order], anchor[order], count[order])
            kept, later, _ = merged(found, self.doc)
            yield level, found.of(kept), key[order][kept], found.of(later)
            waiting = again
            if not sum(len(p[0]) for p in waiting):
                return


def _chunks(batches, shape: Shape):
    rows, size = [], 0
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
        for doc, tag, text in zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(), texts):
            rows.append((doc, tag, text.as_py()))
            size += len(rows[-1][2])
            if size >= CHUNK:
                yield Chunk(rows, shape)
                rows, size = [], 0
    if rows:
        yield Chunk(rows, shape)


def tagged(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, text): the tag is 32 bits of the text's hash, so that rows that repeat
    an id over different texts are told apart."""
    tag = F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), tag.alias("tag"), F.coalesce("text", F.lit("")).alias("text"))


def frequent_keys(rows: DataFrame, shape: Shape, limit: int) -> tuple[int, list[np.ndarray]]:
    """Number of segments, and the keys of levels 0 and 1 with more than about `limit` of them.

    Every SAMPLE-th segment of all texts is counted. The keys found only decide how rows
    are dealt, never what goes. There are at most two for `limit` segments.
    """

    def run(batches):
        total, turn = 0, TaskContext.get().partitionId()
        for chunk in _chunks(batches, shape):
            for _, found, key, _ in chunk.keyed([]):
                total += len(found)
                at = turn % SAMPLE
                place = found.start[at::SAMPLE] + chunk.offsets[found.row[at::SAMPLE]]
                pieces = keyed(
                    chunk.data,
                    cut(found.row[at::SAMPLE], place, place + found.far[at::SAMPLE], found.count[at::SAMPLE], shape.levels[1]),
                    shape, 1,
                )
                for level, keys in [(0, key[at::SAMPLE])] + [(1, k) for _, k in pieces]:
                    keys, n = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), level), pa.int32()), pa.array(keys.view(np.int64)), pa.array(n)], ["level", "key", "n"]
                    )
                turn += 1
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([0]), pa.array([total])], ["level", "key", "n"])

    counted = rows.mapInArrow(run, "level int, key long, n long").groupBy("level", "key").agg(F.sum("n").alias("n"))
    found = counted.filter((F.col("level") < 0) | (F.col("n") * SAMPLE > limit)).collect()
    total = sum(r["n"] for r in found if r["level"] < 0)
    heavy = [np.sort(np.array([r["key"] for r in found if r["level"] == k], np.int64).view(np.uint64)) for k in (0, 1)]
    return total, heavy


def later_copies(docs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, int]:
    """(bucket, blob) rows and the number of buckets: windows that go, by bucket of rows.

    A blob packs ids, tags, first windows, numbers of windows, and whether the row may have
    equal ones elsewhere. A row's bucket is its
    tag modulo the number of buckets, which grows with the input.
    """
    shape = Shape(width)
    common.python_ready(docs.sparkSession)
    rows = tagged(docs).filter("doc_id IS NOT NULL")
    total, heavy = frequent_keys(rows, shape, max(GROUP // 4, 2))
    groups = 1 + total // GROUP
    buckets = 8 + total // GROUP
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def split(batches):
        """A chunk's segments by group, and what goes within the chunk."""
        for chunk in _chunks(batches, shape):
            out = []
            for _, found, key, later in chunk.keyed(shared.value):
                group = (key % np.uint64(groups)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                edges = np.flatnonzero(np.diff(group[order], prepend=-1))
                for a, b in zip(edges, np.append(edges[1:], len(order))):
                    part = found.of(order[a:b])
                    head = _planes(chunk.doc[part.row], chunk.tag[part.row], part.start, part.far, part.count, part.twice)
                    out.append((int(group[order[a]]), None, head, _trimmed(part.content, part.count, shape)))
                places = (chunk.doc[later.row], chunk.tag[later.row], later.start, later.count, later.twice)
                out += [(-1, k, blob, None) for k, blob in _by_bucket(*places, buckets)]
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 4, kinds)], ["grp", "bucket", "blob", "content"]
            )

    def ordered(batches):
        held, at = [], None
        for batch in batches:
            for group, bucket, blob, content in zip(*(batch.column(c).to_pylist() for c in ("grp", "bucket", "blob", "content"))):
                if group < 0:
                    yield made([(bucket, blob)])
                    continue
                if group != at:
                    yield made(factored(held))
                    held, at = [], group
                held.append((blob, content))
        yield made(factored(held))

    def made(found):
        found = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["bucket", "blob"]
        )

    def factored(held):
        """What goes of a whole group."""
        if not held:
            return
        doc, tag, start, far, count, twice = (np.concatenate(c) for c in zip(*(_columns(blob, 6) for blob, _ in held)))
        content = _filled(b"".join(zstandard.decompress(c) for _, c in held), count, shape)
        order = np.lexsort((start, tag, doc))
        doc, tag, start, far, count, twice, content = (c[order] for c in (doc, tag, start, far, count, twice > 0, content))
        row = np.cumsum(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]) - 1
        first = np.flatnonzero(np.diff(row, prepend=-1))
        found = Segments(row, start, far, count, twice, content)
        kept, later, alike = merged(found, doc[first])
        yield from _by_bucket(doc[later], tag[later], start[later], count[later], twice[later], buckets)
        # One stands for all that are equal; what goes of it goes of each.
        head = np.flatnonzero(np.diff(alike, prepend=-1))
        segment, window, n = copied(found.of(kept[head]), doc[first], shape)
        times = np.diff(np.r_[head, len(kept)])[segment]
        pick = np.repeat(head[segment] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
        k = kept[pick]
        yield from _by_bucket(doc[k], tag[k], start[k] + np.repeat(window, times), np.repeat(n, times), twice[k], buckets)

    dealt = rows.mapInArrow(split, "grp int, bucket int, blob binary, content binary")
    # What goes within a chunk needs no group: it is spread by its bucket.
    dealt = dealt.repartition("grp", F.when(F.col("grp") < 0, F.col("bucket"))).sortWithinPartitions("grp")
    return dealt.mapInArrow(ordered, "bucket int, blob binary"), buckets


def without_later_copies(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_bytes, spans, kept: each text's bytes without its later copies.

    A byte goes if it lies in `width` consecutive bytes of its text that also start in a
    text with a smaller id, judged on the input. spans are the maximal runs that go,
    (start, length) in bytes; kept are the other bytes, which need not be whole
    characters. Null and empty texts have no bytes; texts shorter than a window keep all;
    rows with one id never take from one another, equal or not; rows with a null id keep
    all and take nothing. Texts of any length are read whole. An empty table gives no
    rows. Other columns are not read.

    Equal windows of one text that has a copy are found by a 64-bit hash.
    """
    found, buckets = later_copies(docs, width)
    found = common.stored(found, "later-copies")
    rows = tagged(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def packed(batches):
        """Texts compressed: they are moved once more than anything else of their size."""
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            blobs = pa.array([zstandard.compress(t.as_py(), 6) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), blobs], ["doc_id", "tag", "blob"])

    texts = rows.mapInArrow(packed, "doc_id long, tag long, blob binary").select(
        F.pmod("tag", F.lit(buckets)).cast("int").alias("bucket"), F.lit(1).alias("kind"), "doc_id", "tag", "blob"
    )
    runs = found.select(
        "bucket", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("tag"), "blob"
    )
    # A bucket's runs come before its texts, which then pass one by one.
    dealt = texts.unionByName(runs).repartition("bucket").sortWithinPartitions("bucket", "kind")

    def run(batches):
        at, blobs, places = None, [], [np.zeros(0, np.int64)] * 5
        for batch in batches:
            out = []
            for bucket, is_text, doc, tag, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "doc_id", "tag", "blob"))):
                if bucket != at:
                    at, blobs, places = bucket, [], [np.zeros(0, np.int64)] * 5
                if not is_text:
                    blobs.append(_columns(blob, 5))
                    continue
                if blobs:
                    places = [np.concatenate(c) for c in zip(*blobs)]
                    order = np.lexsort((places[1], places[0]))
                    places, blobs = [c[order] for c in places], []
                a, b = np.searchsorted(places[0], [doc, doc + 1]) if doc is not None else (0, 0)
                mine = a + np.flatnonzero(places[1][a:b] == tag)
                out.append((doc, *_kept(zstandard.decompress(blob), *(c[mine] for c in places[2:]), width)))
            ids, sizes, starts, lengths, kept = zip(*out) if out else [()] * 5
            offsets = np.cumsum([0] + [len(s) for s in starts])
            spans = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in (starts, lengths)], ["start", "length"]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    spans = "array<struct<start: long, length: long>>"
    out = dealt.mapInArrow(run, f"doc_id long, n_bytes long, spans {spans}, kept binary")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def _kept(text: bytes, start: np.ndarray, count: np.ndarray, twice: np.ndarray, width: int):
    """Bytes, starts and lengths of the runs that go, and the bytes that stay."""
    none = np.zeros(0, np.int64)
    if not len(start):
        return len(text), none, none, text
    size = len(text) + 1
    cover = np.bincount(start, minlength=size) - np.bincount(start + count - 1 + width, minlength=size)
    start, count = start[twice > 0], count[twice > 0]
    if len(start):
        data = Bytes(text, width)
        listed = np.repeat(start - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        wanted = np.unique(data.digests(np.unique(listed), width))
        for a in range(0, len(text) - width + 1, CHUNK):
            at = np.arange(a, min(a + CHUNK, len(text) - width + 1))
            # A window listed once for such a text goes wherever the text has it.
            at = at[np.isin(data.digests(at, width), wanted)]
            cover[at] += 1
            cover[at + width] -= 1
    goes = np.cumsum(cover)[:-1] > 0
    turns = np.flatnonzero(np.diff(np.r_[False, goes, False]))
    first, last = turns[::2], turns[1::2]
    return len(text), first, last - first, np.frombuffer(text, np.uint8)[~goes].tobytes()


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_later_copies(common.table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return rows.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS n_bytes FROM documents),
-- A thousand windows at a time, as a long text is slow to take parts of.
c AS (
  SELECT r, doc_id, c, substr(h, 2000 * c + 1, 2098) AS h, least(1000, n_bytes - 49 - 1000 * c) AS n FROM (
    SELECT *, unnest(range((n_bytes + 950) // 1000)) AS c FROM d WHERE doc_id IS NOT NULL)),
w AS (
  SELECT r, doc_id, 1000 * c + p AS p, substr(h, 2 * p + 1, 100) AS bytes FROM (
    SELECT r, doc_id, c, h, unnest(range(n)) AS p FROM c)),
f AS (SELECT bytes, min(doc_id) AS doc_id FROM w GROUP BY bytes HAVING count(*) > 1),
g AS (SELECT w.r, w.p FROM w JOIN f ON w.bytes = f.bytes AND w.doc_id > f.doc_id),
-- Windows that overlap or touch are one run.
m AS (SELECT r, p, coalesce(p > lag(p) OVER (PARTITION BY r ORDER BY p) + 50, TRUE) AS new FROM g),
s AS (SELECT r, p, sum(new::INT) OVER (PARTITION BY r ORDER BY p) AS run FROM m),
spans AS (SELECT r, min(p) AS a, max(p) + 50 AS b FROM s GROUP BY r, run),
k AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM spans),
t AS (
  SELECT d.r, count(k.a) AS n_spans, coalesce(sum(b - a), 0)::BIGINT AS n_removed,
         coalesce(string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a), '') AS head, coalesce(max(b), 0) AS tail
  FROM d LEFT JOIN k USING (r) GROUP BY d.r)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, n_removed, n_spans, sha256(unhex(head || substr(h, 2 * tail + 1))) AS kept_sha256
FROM d JOIN t USING (r)
"""
