"""Ranked lexical search over K2-treaps.

Documents are taken a range at a time. A range's grid has a row for every term and a
column for every document; the cell of a term in a document holds its impact. A
quadtree over the grid keeps in each node the greatest impact of its quadrant and where
it stands, and leaves that point out below: the tree is a heap by impact and a K2-tree
by place, with one node for each point. Nodes are stored level by level: which quadrants
follow, places within the quadrant, and how far the impact is below the parent's.

An item has a row for each of its terms. Its rows' paths descend together over ranges of
columns, the range with the greatest sum of bounds first, and stop where no range left
can reach the best documents found so far. Ranges are searched apart from one another;
the best of each are brought together at the end.
"""

from __future__ import annotations

import heapq
import itertools
import math
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from casebook.llm import common, resampling

TOP = 50
#: Bytes of text in a range, items searched at a time, column ranges followed at a time.
RANGE, ITEMS, FRONT = 1 << 23, 4096, 128

_BITS = np.array([bin(k).count("1") for k in range(16)], np.int64)


def _spread(x: np.ndarray) -> np.ndarray:
    """The low 32 bits of each number with a gap after each."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Level:
    """Nodes of one level in the order of their quadrants.

    below: the quadrants that follow, a bit each; first: the first of a node's children
    in the next level; row and column within the quadrant, and the impact.
    """

    def __init__(self, below, row, column, value):
        self.below, self.row, self.column, self.value = below, row, column, value
        self.first = np.cumsum(_BITS[below]) - _BITS[below]


def build(row: np.ndarray, column: np.ndarray, value: np.ndarray) -> list[Level]:
    """The treap of points in distinct cells, as levels from the top."""
    if not len(row):
        return []
    height = max(int(row.max()), int(column.max())).bit_length()
    code = _spread(row) << np.uint64(1) | _spread(column)
    order = np.argsort(code)
    code, row, column, value = code[order], row[order], column[order], value[order]
    levels, parents = [], None
    for depth in range(height, -1, -1):
        quadrant = code >> np.uint64(2 * depth)
        new = np.r_[True, quadrant[1:] != quadrant[:-1]]
        starts, node = np.flatnonzero(new), np.cumsum(new) - 1
        top = np.flatnonzero(value == np.maximum.reduceat(value, starts)[node])
        # The first of the greatest stands at the node, the others go on.
        top = top[np.r_[True, node[top][1:] != node[top][:-1]]]
        within = (1 << depth) - 1
        levels.append(Level(np.zeros(len(top), np.uint8), row[top] & within, column[top] & within, value[top]))
        here = quadrant[starts]
        if parents is not None:
            above = np.searchsorted(parents, here >> np.uint64(2))
            np.bitwise_or.at(levels[-2].below, above, (1 << (here & np.uint64(3)).astype(np.int64)).astype(np.uint8))
            levels[-2] = Level(levels[-2].below, levels[-2].row, levels[-2].column, levels[-2].value)
        parents = here
        left = np.ones(len(code), bool)
        left[top] = False
        code, row, column, value = code[left], row[left], column[left], value[left]
        if not len(code):
            break
    # Absent levels below hold no nodes; the height stays known.
    return levels + [Level(*[np.zeros(0, t) for t in (np.uint8, np.int64, np.int64, np.int64)])] * (height + 1 - len(levels))


def packed(levels: list[Level]) -> bytes:
    """The levels as bytes: sizes, quadrants, and planes of places and steps of impact."""
    sizes = np.array([len(levels), *(len(x.below) for x in levels)], np.int64)
    columns = [[], [], []]
    above = np.zeros(0, np.int64)
    for depth, level in enumerate(levels):
        start = np.repeat(above, _BITS[levels[depth - 1].below]) if depth else level.value * 0
        for held, x in zip(columns, (level.row, level.column, start - level.value if depth else level.value)):
            held.append(x.astype(np.uint32))
        above = level.value
    planes = [np.ascontiguousarray(np.concatenate(c).view(np.uint8).reshape(-1, 4).T).tobytes() if c else b"" for c in columns]
    below = np.concatenate([x.below for x in levels]).tobytes() if levels else b""
    return zstandard.compress(sizes.tobytes() + below + b"".join(planes), 1)


def unpacked(blob: bytes) -> list[Level]:
    data = np.frombuffer(zstandard.decompress(blob), np.uint8)
    n = int(data[:8].view(np.int64)[0])
    sizes = data[8 : 8 + 8 * n].view(np.int64)
    total, at = int(sizes.sum()), 8 + 8 * n
    below, at = data[at : at + total], at + total
    columns = [
        np.ascontiguousarray(data[at + 4 * total * k : at + 4 * total * (k + 1)].reshape(4, -1).T).view(np.uint32).ravel().astype(np.int64)
        for k in range(3)
    ]
    levels, above = [], None
    for depth, (a, b) in enumerate(itertools.pairwise(np.r_[0, np.cumsum(sizes)].tolist())):
        row, column, step = (c[a:b] for c in columns)
        value = np.repeat(above, _BITS[levels[-1].below]) - step if depth else step
        levels.append(Level(below[a:b], row, column, value))
        above = value
    return levels


class Front:
    """Column ranges of one level: their number, bounds, nodes of the item's rows, and the
    points left out above that lie in them (range, row, column, worth)."""

    def __init__(self, depth, number, nodes, points, bounds):
        order = np.argsort(-bounds, kind="stable")
        self.depth, self.number, self.nodes, self.bounds = depth, number[order], nodes[order], bounds[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.points = (place[points[0]], *points[1:])

    def split(self, n: int) -> tuple["Front", "Front | None"]:
        """The n ranges with the greatest bounds, and the others."""
        if len(self.number) <= n:
            return self, None
        halves = []
        for a, b in ((0, n), (n, len(self.number))):
            inside = (self.points[0] >= a) & (self.points[0] < b)
            points = (self.points[0][inside] - a, *(p[inside] for p in self.points[1:]))
            halves.append(Front(self.depth, self.number[a:b], self.nodes[a:b], points, self.bounds[a:b]))
        return halves[0], halves[1]


def _bounded(worth: np.ndarray, points) -> np.ndarray:
    """Sums over the rows of the greater of a node's and the points' worth, by range."""
    np.maximum.at(worth, (points[0], points[1]), points[3])
    return worth.sum(axis=1)


def best_columns(levels: list[Level], rows: np.ndarray, weights: np.ndarray, top: int, least: int):
    """Up to `top` (score, column) and all that tie with the last, each with `least` or more.

    A column's score sums weight times impact over the rows.
    """
    height = len(levels) - 1
    root = levels[0]
    nodes = np.zeros((1, len(rows)), np.int64)
    mine = np.flatnonzero(rows == root.row[0])
    points = (np.zeros(len(mine), np.int64), mine, np.repeat(root.column[0], len(mine)), weights[mine] * root.value[0])
    bounds = _bounded((weights * root.value[0])[None, :].copy(), points)
    turn = itertools.count()
    waiting = [(-int(bounds[0]), next(turn), Front(0, np.zeros(1, np.int64), nodes, points, bounds))]
    found, scores = [], []
    while waiting and -waiting[0][0] >= least:
        front, rest = heapq.heappop(waiting)[2].split(FRONT)
        if rest is not None:
            heapq.heappush(waiting, (-int(rest.bounds[0]), next(turn), rest))
        if front.depth == height:
            found += zip(front.bounds.tolist(), front.number.tolist())
            scores = heapq.nlargest(top, scores + front.bounds.tolist())
            if len(scores) == top:
                least = max(least, scores[-1])
            continue
        front = _descended(levels, front, rows, weights, height, least)
        if len(front.number):
            heapq.heappush(waiting, (-int(front.bounds[0]), next(turn), front))
    return [(score, column) for score, column in found if score >= least]


def _descended(levels: list[Level], front: Front, rows, weights, height: int, least: int) -> Front:
    """Both halves of every range, those whose bounds stay below least left out."""
    level, below = levels[front.depth], levels[front.depth + 1]
    left = height - front.depth - 1
    n, q = front.nodes.shape
    node = np.repeat(front.nodes, 2, axis=0)
    number = (2 * front.number[:, None] + np.arange(2)).ravel()
    quadrant = 2 * ((rows >> left) & 1)[None, :] + np.tile(np.arange(2), n)[:, None]
    held = np.where(node >= 0, level.below[np.maximum(node, 0)], 0).astype(np.int64) if len(level.below) else np.zeros((2 * n, q), np.int64)
    there = (held >> quadrant) & 1 == 1
    child = np.full((2 * n, q), -1, np.int64)
    child[there] = level.first[node[there]] + _BITS[held[there] & ((1 << quadrant[there]) - 1)]
    half, row = np.nonzero(there)
    kids = child[half, row]
    worth = np.zeros((2 * n, q), np.int64)
    worth[half, row] = weights[row] * below.value[kids]
    own = below.row[kids] == rows[row] & ((1 << left) - 1)
    half, row, kids = half[own], row[own], kids[own]
    of, pair, column, gain = front.points
    points = (
        np.r_[2 * of + ((column >> left) & 1), half], np.r_[pair, row],
        np.r_[column, (number[half] << left) | below.column[kids]], np.r_[gain, weights[row] * below.value[kids]],
    )
    bounds = _bounded(worth, points)
    stays = np.flatnonzero((bounds >= least) & (bounds > 0))
    place = np.full(2 * n, -1, np.int64)
    place[stays] = np.arange(len(stays))
    inside = place[points[0]] >= 0
    points = (place[points[0][inside]], *(p[inside] for p in points[1:]))
    return Front(front.depth + 1, number[stays], child[stays], points, bounds[stays])


#: Bytes that belong to terms: ASCII digits and letters, and all beyond ASCII.
TERM = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Terms with repeats of every text."""
    inside = TERM[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    starts[edges] = inside[edges]
    return np.diff(np.r_[0, np.cumsum(starts)][offsets])


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all terms with repeats."""

    def run(batches):
        n, total = 0, 0
        for batch in batches:
            data, offsets = common.utf8(batch.column("text"))
            for a, b in common.slices(offsets, RANGE):
                counts = term_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                n, total = n + int((counts > 0).sum()), total + int(counts.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], ["n", "total"])

    r = docs.select("text").mapInArrow(run, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return r[0] or 0, r[1] or 0


def index(docs: DataFrame) -> DataFrame:
    """(documents, terms, counts, grid): a row for every range of documents, stored.

    documents are the ids by column; terms the rows' terms, compressed, with the number
    of documents that hold each; grid the treap. Every term of every whole text is
    indexed. docs has doc_id and text; other columns are not read. Documents without
    terms are in no range.
    """
    common.python_ready(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    documents, terms = corpus_size(docs)
    arrow = to_arrow_type(docs.schema["doc_id"].dataType)

    def ranged(batches):
        """(ids, lists of texts) of about RANGE bytes."""
        ids, texts, size = [], [], 0
        for part, some in resampling.text_slices(batches, ["doc_id"]):
            ids, size = ids + part.column(0).to_pylist(), size + sum(map(len, some))
            texts.append(some)
            if size >= RANGE:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts

    def run(batches):
        for ids, texts in ranged(batches):
            known: dict[bytes, int] = {}
            cells, times, before = [], [], 0
            for part in texts:
                owner, word = resampling.words_of(part, known)
                # Texts are whole in their part, so no cell is counted in two of them.
                cell, n = np.unique((owner + before) << 32 | word, return_counts=True)
                cells.append(cell)
                times.append(n)
                before += len(part)
            cell, tf = np.concatenate(cells), np.concatenate(times)
            if not len(cell):
                continue
            column, row = cell >> 32, cell & 0xFFFFFFFF
            n = np.bincount(column, tf, minlength=len(ids)).astype(np.int64)
            m = 50 + 50 * n * documents // terms
            impact = 1_000_000_000 * tf // (1000 * tf + 20 * m[column])
            # Short texts and terms of great impact lie together, so quadrants are alike.
            columns = np.argsort(n, kind="stable")
            place = np.empty(len(ids), np.int64)
            place[columns] = np.arange(len(ids))
            greatest = np.zeros(len(known), np.int64)
            np.maximum.at(greatest, row, impact)
            rows = np.argsort(-greatest, kind="stable")
            turn = np.empty(len(known), np.int64)
            turn[rows] = np.arange(len(known))
            words = list(known)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([[ids[k] for k in columns.tolist()]], pa.list_(arrow)),
                    pa.array([zstandard.compress(b" ".join(words[k] for k in rows.tolist()), 1)], pa.binary()),
                    pa.array([zstandard.compress(np.bincount(turn[row], minlength=len(words)).tobytes(), 1)], pa.binary()),
                    pa.array([packed(build(turn[row], place[column], impact))], pa.binary()),
                ],
                ["documents", "terms", "counts", "grid"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    ranges = docs.mapInArrow(run, f"documents array<{kind}>, terms binary, counts binary, grid binary")
    return common.stored(ranges, "treaps"), documents


def _terms(blob: bytes) -> dict[bytes, int]:
    return {w: k for k, w in enumerate(zstandard.decompress(blob).split(b" "))}


def search(ranges: DataFrame, documents: int, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: each item's best documents, from rank 1.

    ranges and documents are what `index` gives. items has item_id and text; each of its
    rows is an item of its own. An item's terms count once each. Up to `top` documents
    with a score above 0 are ranked, equal scores by ascending doc_id, null last. Items
    without a term that some document holds have no rows.

    Items are searched in blocks of ITEMS, so that what is sent to tasks is bounded.
    """
    spark = ranges.sparkSession
    item_kind = items.schema["item_id"].dataType.simpleString()
    kind = ranges.schema["documents"].dataType.elementType.simpleString()
    empty = spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).toLocalIterator()
    blocks = iter(lambda: list(itertools.islice(rows, ITEMS)), [])
    return reduce(DataFrame.unionByName, (_searched(ranges, documents, block, top, item_kind) for block in blocks), empty)


def _searched(ranges: DataFrame, documents: int, items: list, top: int, item_kind: str) -> DataFrame:
    spark = ranges.sparkSession
    ids_type = ranges.schema["documents"].dataType.elementType
    arrow = to_arrow_type(ids_type)
    known: dict[bytes, int] = {}
    owner, word = resampling.words_of([r["text"].encode() for r in items], known)
    pairs = np.unique(owner << 32 | word)
    wanted = spark.sparkContext.broadcast((list(known), [(pairs[pairs >> 32 == k] & 0xFFFFFFFF) for k in range(len(items))]))

    def held(batches):
        total = np.zeros(len(wanted.value[0]), np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist()):
                at, counts = _terms(terms), np.frombuffer(zstandard.decompress(counts), np.int64)
                for k, w in enumerate(wanted.value[0]):
                    if w in at:
                        total[k] += counts[at[w]]
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], ["term", "n"])

    # One row for each term of the items.
    counted = ranges.select("terms", "counts").mapInArrow(held, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = {r["term"]: r["n"] for r in counted.collect()}
    weight = np.zeros(len(known), np.int64)
    for k, n in frequency.items():
        weight[k] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
    weights = spark.sparkContext.broadcast(weight)

    def run(batches):
        words, queries = wanted.value
        # By item: (score, whether the id is null, id), best first.
        best: list[list] = [[] for _ in queries]
        for batch in batches:
            for ids, terms, grid in zip(*(batch.column(c).to_pylist() for c in ("documents", "terms", "grid"))):
                at = _terms(terms)
                row = np.array([at.get(w, -1) for w in words], np.int64)
                levels = unpacked(grid)
                for k, query in enumerate(queries):
                    query = query[(row[query] >= 0) & (weights.value[query] > 0)]
                    if not len(query):
                        continue
                    least = -best[k][-1][0] if len(best[k]) == top else 1
                    found = best_columns(levels, row[query], weights.value[query], top, least)
                    if found:
                        new = [(-score, ids[c] is None, ids[c] if ids[c] is not None else 0) for score, c in found]
                        best[k] = heapq.nsmallest(top, best[k] + new)
        out = [(k, None if null else doc, -score) for k, some in enumerate(best) for score, null, doc in some]
        columns = zip(*out) if out else [()] * 3
        kinds = (pa.int32(), arrow, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["item", "doc_id", "score"])

    found = ranges.select("documents", "terms", "grid").mapInArrow(run, f"item int, doc_id {ids_type.simpleString()}, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(items)], f"item int, item_id {item_kind}")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges, documents = index(common.table(spark, sf_dir, "documents"))
    return search(ranges, documents, common.table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
g AS (SELECT count(*) AS documents, sum(len(terms))::BIGINT AS terms FROM d WHERE len(terms) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
f AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, g GROUP BY term, documents),
q AS (
  SELECT DISTINCT i, item_id, term FROM (
    SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)),
s AS (
  SELECT i, item_id, d.r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(d.terms) * documents) // g.terms))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN p USING (term) JOIN d USING (r), g
  GROUP BY i, item_id, d.r, doc_id),
k AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""
