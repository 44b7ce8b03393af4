"""K2-treaps and ranked search against plain scoring."""

import math
import re

import numpy as np
import pytest

from casebook.llm import treaps
from tests.llm.brute import LOWER

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def grid(rng, rows, columns, share, most):
    cells = rng.permutation(rows * columns)[: max(1, int(rows * columns * share))]
    return cells // columns, cells % columns, rng.integers(1, most, len(cells))


def points_of(levels):
    """Every point by walking the tree, and that no node exceeds its parent."""
    height, out = len(levels) - 1, {}

    def walk(depth, node, row, column, bound):
        level, left = levels[depth], height - depth
        assert level.value[node] <= bound
        out[(row << left) + level.row[node], (column << left) + level.column[node]] = level.value[node]
        child = level.first[node]
        for quadrant in range(4):
            if level.below[node] >> quadrant & 1:
                walk(depth + 1, child, 2 * row + quadrant // 2, 2 * column + quadrant % 2, level.value[node])
                child += 1

    walk(0, 0, 0, 0, math.inf)
    return out


@pytest.mark.parametrize("rows, columns, share", [(1, 1, 1), (1, 9, 1), (7, 1, 1), (40, 13, 0.3), (9, 70, 0.1), (64, 64, 1)])
def test_a_node_for_each_point_as_a_heap(rows, columns, share):
    rng = np.random.default_rng(rows)
    row, column, value = grid(rng, rows, columns, share, 20)
    levels = treaps.build(row, column, value)
    assert sum(len(x.below) for x in levels) == len(row)
    for held in (levels, treaps.unpacked(treaps.packed(levels))):
        assert points_of(held) == {(r, c): v for r, c, v in zip(row, column, value)}


@pytest.mark.parametrize("front", [1, 5, 128])
@pytest.mark.parametrize("seed", range(6))
def test_best_columns_against_all_columns(monkeypatch, seed, front):
    monkeypatch.setattr(treaps, "FRONT", front)
    rng = np.random.default_rng(seed)
    rows, columns = int(rng.integers(1, 90)), int(rng.integers(1, 90))
    row, column, value = grid(rng, rows, columns, rng.choice([0.05, 0.4, 1.0]), rng.choice([2, 1000]))
    dense = np.zeros((rows, columns), np.int64)
    dense[row, column] = value
    levels = treaps.build(row, column, value)
    some = rng.permutation(rows)[: rng.integers(1, 12)]
    weights = rng.integers(1, 9, len(some))
    scores = weights @ dense[some]
    for top, least in ((1, 1), (5, 1), (50, 1), (5, int(scores.max()))):
        got = sorted(treaps.best_columns(levels, some, weights, top, least))
        want = sorted(((s, c) for c, s in enumerate(scores.tolist()) if s >= max(least, 1)), reverse=True)
        edge = want[min(top, len(want)) - 1][0] if want else 0
        assert got == sorted(w for w in want if w[0] >= edge)


def plain(rows, items, top):
    docs = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in rows]
    docs = [(d, t) for d, t in docs if t]
    total = sum(len(t) for _, t in docs)
    frequency = {}
    for _, t in docs:
        for w in set(t):
            frequency[w] = frequency.get(w, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for d, t in docs:
            m, score = 50 + 50 * len(t) * len(docs) // total, 0
            for w in set(TERM.findall((text or "").translate(LOWER))) & set(t):
                weight = math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * frequency[w] + 1)))
                score += weight * (1000000000 * t.count(w) // (1000 * t.count(w) + 20 * m))
            if score:
                scores.append((-score, d is None, d if d is not None else 0))
        out += [(item, k + 1, None if n else d, -s) for k, (s, n, d) in enumerate(sorted(scores)[:top])]
    return sorted(map(str, out))


@pytest.mark.parametrize("size, items, top", [(1 << 23, 4096, 50), (3000, 2, 3), (1, 4, 1)])
def test_search_against_plain_scores(spark, odd, monkeypatch, size, items, top):
    monkeypatch.setattr(treaps, "RANGE", size)
    monkeypatch.setattr(treaps, "ITEMS", items)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{odd}/documents.parquet").collect()]
    rows += [(None, "again one"), (None, "again one"), (70, "again one"), (71, "One AGAIN")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    wanted = spark.read.parquet(f"{odd}/benchmark.parquet")
    ranges, documents = treaps.index(docs)
    got = treaps.search(ranges, documents, wanted, top).collect()
    want = plain(rows, [(r.item_id, r.text) for r in wanted.collect()], top)
    assert sorted(str(tuple(r)) for r in got) == want


def test_ids_may_be_texts_and_tables_empty(spark):
    docs = spark.createDataFrame([("b", "x y", 1), ("a", "X y", 2), (None, "x", 3), ("c", None, 4)], "doc_id string, text string, rank int")
    items = spark.createDataFrame([("i", "x"), ("j", "none")], "item_id string, text string")
    got = [tuple(r)[:3] for r in treaps.search(*treaps.index(docs), items).collect()]
    assert got == [("i", 1, None), ("i", 2, "a"), ("i", 3, "b")]
    assert treaps.search(*treaps.index(docs), items.limit(0)).count() == 0
    assert treaps.search(*treaps.index(docs.limit(0)), items).count() == 0


def test_term_counts_at_the_edges_of_texts():
    texts = ["", "a", "b c", " d", "é1", "-", "", "ef "]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    assert treaps.term_counts(data, offsets).tolist() == [len(TERM.findall(t)) for t in texts]
