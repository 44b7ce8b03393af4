"""Substring dedup by prefix-partitioned suffix trees over words.

Every window of `width` words is a suffix cut at that depth. Suffixes are split by
their first words into groups that fit in memory: one word where that is enough, two or
four where a prefix is frequent, the whole window where nothing shorter will do. Below a
prefix, the nodes at full depth are found by sorting path digests; a node with leaves in
several documents is a repeat, and the smallest of them keeps it. Runs of such windows
are the maximal repeats whose words go.

Leaves of one window are merged within a chunk of documents before anything moves, so a
passage that a third of all documents share reaches its group once a chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import common

WIDTH = 13
#: Prefix lengths in words and the bits their codes are counted by.
PREFIXES, BITS = (1, 2, 4), (12, 16, 16)
#: Leaves of a group, bytes of text in a chunk, and bits of a path digest: a group's
#: size bounds the chance that two windows in it are confused, 2^21 in 2^56.
GROUP, CHUNK, DIGEST_BITS = 1 << 21, 1 << 22, 56
#: Slots that ids are hashed to where it is noted which of them have several texts.
SLOTS = 1 << 20

_M = np.uint64(0x9E3779B97F4A7C15)
_N = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _N
    x = (x ^ (x >> np.uint64(29))) * _M
    return x ^ (x >> np.uint64(32))


class Chunk:
    """Hashed words of some documents, one after the other, and their windows.

    starts are the places of all windows; digests(n) hashes the first n words of each.
    """

    def __init__(self, texts: list[bytes], width: int):
        self.words = [t.split() for t in texts]
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.offsets = np.r_[0, np.cumsum(sizes)]
        distinct = dict.fromkeys(w for words in self.words for w in words)
        known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))
        number = {w: k for k, w in enumerate(distinct)}
        self.hashes = np.empty(int(self.offsets[-1]), np.uint64)
        for k, words in enumerate(self.words):
            self.hashes[self.offsets[k] : self.offsets[k + 1]] = known[
                np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            ]
        self.width = width
        windows = np.maximum(sizes - width + 1, 0)
        first = np.cumsum(windows) - windows
        self.owner = np.repeat(np.arange(len(texts)), windows)
        self.starts = np.arange(len(self.owner)) + (self.offsets[:-1] - first)[self.owner]

    def digests(self, n: int) -> np.ndarray:
        total = np.zeros(max(len(self.hashes) - n + 1, 0), np.uint64)
        for j in range(n):
            total = (total + self.hashes[j : len(self.hashes) - n + 1 + j]) * _M
        return _mixed(total)[self.starts] if len(self.starts) else np.zeros(0, np.uint64)

    def codes(self) -> list[np.ndarray]:
        return [(self.digests(n) >> np.uint64(64 - b)).astype(np.int64) for n, b in zip(PREFIXES, BITS)]


def _chunks(batches):
    """((id, tag) rows, texts) of some documents at a time, each text whole."""
    ids, texts, size = [], [], 0
    for batch in batches:
        data = batch.column("text").cast(pa.large_binary()).fill_null(b"")
        for k, tag, text in zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(), data):
            ids.append((k, tag))
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= CHUNK:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


class Partition:
    """Group of every suffix by a prefix as long as its frequency asks for.

    counts are of all suffixes by prefix length and code. Codes within the limit share
    groups of about that size; a code beyond it goes on to the next length, and past the
    last one to as many groups as it needs, dealt by the window's own digest.
    """

    def __init__(self, counts: list[np.ndarray], limit: int = GROUP):
        self.group, self.parts, at = [], None, 0
        for level, count in enumerate(counts):
            heavy = count > limit
            filled = np.cumsum(np.where(heavy, 0, count)) // limit
            self.group.append(np.where(heavy, -1, at + filled))
            at += int(filled[-1]) + 1
            if level == len(counts) - 1:
                parts = np.where(heavy, -(-count // limit), 0)
                self.parts = parts
                self.base = at + np.cumsum(parts) - parts
                at += int(parts.sum())
        self.groups = at

    def of(self, codes: list[np.ndarray], digests: np.ndarray) -> np.ndarray:
        out = self.group[0][codes[0]]
        for level in range(1, len(codes)):
            out = np.where(out < 0, self.group[level][codes[level]], out)
        deep = np.flatnonzero(out < 0)
        if len(deep):
            code = codes[-1][deep]
            spread = (digests[deep] % self.parts[code].astype(np.uint64)).astype(np.int64)
            out[deep] = self.base[code] + spread
        return out


def _packed(*columns: np.ndarray) -> bytes:
    """Columns as planes of bytes, compressed; the first is ascending and kept as steps."""
    planes = []
    for k, column in enumerate(columns):
        column = column.astype(np.uint64)
        if k == 0:
            column = np.diff(column, prepend=np.uint64(0))
        planes.append(np.ascontiguousarray(column.view(np.uint8).reshape(-1, 8).T).tobytes())
    return zstandard.compress(b"".join(planes), 1)


def _unpacked(blob: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(columns, 8, -1)
    out = [np.ascontiguousarray(p.T).view(np.uint64).ravel() for p in planes]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def _by_bucket(docs: np.ndarray, tags: np.ndarray, places: np.ndarray, buckets: int):
    """(bucket, packed documents, tags and places) for each bucket of documents."""
    bucket = np.mod(docs, buckets)
    order = np.lexsort((places, tags, docs, bucket))
    bucket, docs, tags, places = bucket[order], docs[order], tags[order], places[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(bucket))):
        yield int(bucket[a]), _packed(docs[a:b].view(np.uint64), tags[a:b], places[a:b])


def _repeats(node: np.ndarray, docs: np.ndarray, tags: np.ndarray):
    """(head, repeat) by leaf, sorted by node, document, tag: whether a row is the first leaf
    of its row under its node, in a node's smallest document or beyond it."""
    new = np.r_[True, node[1:] != node[:-1]]
    smallest = docs[new][np.cumsum(new) - 1]
    once = new | np.r_[True, (docs[1:] != docs[:-1]) | (tags[1:] != tags[:-1])]
    return once & (docs == smallest), once & (docs > smallest)


def _prime_from(n: int) -> int:
    """The smallest prime from n on: ids with a common step still spread over it."""
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def prefix_counts(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Suffixes of all documents by prefix length and code, a table of fixed size."""

    def run(batches):
        totals = [np.zeros(1 << b, np.int64) for b in BITS]
        for _, texts in _chunks(batches):
            for total, code in zip(totals, Chunk(texts, width).codes()):
                total += np.bincount(code, minlength=len(total))
        for level, total in enumerate(totals):
            code = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(code), level), pa.int32()), pa.array(code), pa.array(total[code])],
                ["level", "code", "n"],
            )

    found = rows.mapInArrow(run, "level int, code long, n long").groupBy("level", "code").agg(F.sum("n").alias("n"))
    counts = [np.zeros(1 << b, np.int64) for b in BITS]
    for r in found.collect():
        counts[r["level"]][r["code"]] = r["n"]
    return counts


def _tag() -> Column:
    """32 bits of a text's hash: rows that repeat an id over different texts are told apart."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))


def _slot() -> Column:
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(SLOTS))


def tagged(docs: DataFrame) -> DataFrame:
    """doc_id, text, tag. Only ids that have several texts need tags, and four random bytes
    with each leaf would fill a third of what moves; so tag is 0 outside the slots of such ids."""
    docs = docs.select("doc_id", "text")
    texts = docs.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    shared = texts.agg(F.min(_tag()).alias("least"), F.max(_tag()).alias("most")).filter("least < most")
    shared = common.stored(shared.select(_slot().alias("shared")).distinct(), "shared-ids")
    # Proven bound: SLOTS rows.
    rows = docs.join(F.broadcast(shared), _slot() == F.col("shared"), "left")
    return rows.select("doc_id", "text", F.when(F.col("shared").isNotNull(), _tag()).otherwise(0).alias("tag"))


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, int]:
    """(bucket, blob) rows and the number of buckets: repeats by bucket of documents.

    A blob packs documents, their texts' tags and the first places of windows in them that
    a smaller id has too, each distinct window of a row once. A document's bucket is its id modulo
    the number of buckets, which grows with the number of windows so that a bucket's
    repeats fit in memory. docs are as `tagged` gives them; doc_id is an integer; null ids
    are left out.
    """
    common.python_ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "tag", "text").filter("doc_id IS NOT NULL")
    counts = prefix_counts(rows, width)
    buckets = _prime_from(8 + 8 * int(counts[0].sum()) // GROUP)
    shared = docs.sparkSession.sparkContext.broadcast(Partition(counts))

    def leaves(batches):
        """A chunk's leaves by group, and the repeats that lie within the chunk."""
        partition = shared.value
        for ids, texts in _chunks(batches):
            chunk = Chunk(texts, width)
            if not len(chunk.starts):
                continue
            ids, tags = np.array(ids, np.int64).T
            digest = chunk.digests(width) >> np.uint64(64 - DIGEST_BITS)
            group = partition.of(chunk.codes(), digest)
            # By window, then row, then place; rows of the smallest document go on to the group.
            rank = np.argsort(np.lexsort((tags, ids)))
            order = np.lexsort((rank[chunk.owner], digest, group))
            digest, group, owner = digest[order], group[order], chunk.owner[order]
            place = chunk.starts[order] - chunk.offsets[owner]
            node = np.cumsum(np.r_[True, (digest[1:] != digest[:-1]) | (group[1:] != group[:-1])])
            head, here = _repeats(node, ids[owner], tags[owner])
            keys = np.flatnonzero(head)
            edges = np.flatnonzero(np.r_[True, group[keys][1:] != group[keys][:-1]])
            out = []
            for a, b in zip(edges, np.append(edges[1:], len(keys))):
                k = keys[a:b]
                blob = _packed(digest[k], ids[owner[k]].view(np.uint64), tags[owner[k]], place[k])
                out.append((int(group[k[0]]), None, blob))
            out += [(-1, k, blob) for k, blob in _by_bucket(ids[owner[here]], tags[owner[here]], place[here], buckets)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()))],
                ["grp", "bucket", "blob"],
            )

    def trees(batches):
        """Nodes of whole groups: leaves in documents beyond a node's smallest are repeats."""
        held, at = [], None
        for batch in batches:
            # Blobs are large: one at a time leaves Arrow.
            small = (batch.column(c).to_pylist() for c in ("grp", "bucket"))
            for group, bucket, blob in zip(*small, batch.column("blob")):
                if group < 0:
                    yield made([(bucket, blob.as_py())])
                    continue
                if group != at:
                    yield made(nodes(held))
                    held, at = [], group
                held.append(_unpacked(blob.as_py(), 4))
        yield made(nodes(held))

    def made(found):
        found = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["bucket", "blob"]
        )

    def nodes(held):
        if len(held) < 2:
            return
        digest, doc, tag, place = (np.concatenate(x) for x in zip(*held))
        held.clear()
        doc, tag = doc.view(np.int64), tag.view(np.int64)
        order = np.lexsort((tag, doc, digest))
        digest, doc, tag, place = digest[order], doc[order], tag[order], place[order]
        _, repeat = _repeats(digest, doc, tag)
        yield from _by_bucket(doc[repeat], tag[repeat], place[repeat], buckets)

    dealt = rows.mapInArrow(leaves, "grp int, bucket int, blob binary")
    # Repeats found within a chunk need no group: they are spread by their bucket.
    dealt = dealt.repartition("grp", F.when(F.col("grp") < 0, F.col("bucket"))).sortWithinPartitions("grp")
    return dealt.mapInArrow(trees, "bucket int, blob binary"), buckets


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept: each text without the words of its repeats.

    A repeat is a window of `width` words that also starts in a document with a smaller
    id, judged on the input. Kept words are joined by one space. Null and empty texts
    have no words; texts shorter than a window keep all; rows with one id never repeat one
    another, and each loses only what its own text repeats; rows with a null id keep all.
    Texts of any length are read whole. Other columns are not read.
    """
    docs = tagged(docs)
    found, buckets = repeated_windows(docs, width)
    # The leaves go before the texts move.
    found = common.stored(found, "repeats", free=True)
    kind = docs.schema["doc_id"].dataType.simpleString()
    own = F.pmod(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")), F.lit(buckets)).cast("int")
    texts = docs.select(own.alias("bucket"), F.lit(1).alias("kind"), "doc_id", "tag", "text", F.lit(None).cast("binary").alias("blob"))
    repeats = found.select(
        "bucket", F.lit(0).alias("kind"), F.lit(None).cast(kind).alias("doc_id"), F.lit(None).cast("long").alias("tag"),
        F.lit(None).cast("string").alias("text"), "blob",
    )
    # A bucket's repeats come before its texts, which then pass one by one.
    dealt = texts.unionByName(repeats).repartition("bucket").sortWithinPartitions("bucket", "kind")

    def run(batches):
        none = [np.zeros(0, np.int64)] * 3
        at, blobs, (docs, tags, places) = None, [], none
        for batch in batches:
            out = []
            rows = zip(
                *(batch.column(c).to_pylist() for c in ("bucket", "kind", "doc_id", "tag", "blob")),
                batch.column("text").cast(pa.large_binary()).fill_null(b""),
            )
            for bucket, is_text, doc, tag, blob, text in rows:
                if bucket != at:
                    at, blobs, (docs, tags, places) = bucket, [], none
                if not is_text:
                    blobs.append(_unpacked(blob, 3))
                    continue
                if blobs:
                    docs, tags, places = (np.concatenate(x).view(np.int64) for x in zip(*blobs))
                    order = np.argsort(docs, kind="stable")
                    docs, tags, places, blobs = docs[order], tags[order], places[order], []
                first, last = np.searchsorted(docs, [doc, doc + 1]) if doc is not None else (0, 0)
                mine = places[first:last][tags[first:last] == tag]
                out.append((doc, *_kept(text.as_py(), np.unique(mine), width)))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], batch.schema.field("doc_id").type), pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return dealt.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string")


def _kept(text: bytes, places: np.ndarray, width: int) -> tuple[int, int, bytes]:
    """Words, words that go, and the text of those that stay."""
    words = text.split()
    if not len(places):
        return len(words), 0, b" ".join(words)
    chunk = Chunk([text], width)
    digest = chunk.digests(width)
    places = places[places < len(digest)]
    # A window found once in a document goes wherever the document has it.
    start = np.flatnonzero(np.isin(digest, digest[places]))
    cover = np.zeros(len(words) + 1, np.int64)
    cover[start] += 1
    np.add.at(cover, start + width, -1)
    stays = np.cumsum(cover)[:-1] == 0
    kept = b" ".join(w for w, s in zip(words, stays.tolist()) if s)
    return len(words), int(len(words) - stays.sum()), kept


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT r, doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS q FROM d),
x AS (
  SELECT r, doc_id, q, string_agg(word, ' ') OVER o AS passage, count(*) OVER o AS n FROM w WHERE doc_id IS NOT NULL
  WINDOW o AS (PARTITION BY r ORDER BY q ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
f AS (SELECT passage, min(doc_id) AS doc_id FROM x WHERE n = 13 GROUP BY passage HAVING count(*) > 1),
g AS (
  SELECT DISTINCT r, q + i AS q FROM (
    SELECT x.r, x.q, unnest(range(13)) AS i FROM x JOIN f ON x.n = 13 AND x.passage = f.passage AND x.doc_id > f.doc_id)),
k AS (SELECT r, string_agg(word, ' ' ORDER BY q) AS kept FROM w ANTI JOIN g USING (r, q) GROUP BY r),
n AS (SELECT r, count(*) AS n_removed FROM g GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r) LEFT JOIN n USING (r)
"""
