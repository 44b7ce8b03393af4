"""Substring dedup over bytes against all windows."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casebook.llm import factors
from tests.llm import brute


def found(spark, rows, width=factors.WIDTH, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = factors.without_later_copies(docs, width).collect()
    return sorted((str(r.doc_id), r.n_bytes, tuple((s.start, s.length) for s in r.spans), bytes(r.kept)) for r in got)


def test_order_and_factors_against_sorting():
    rng = np.random.default_rng(3)
    raw = rng.integers(0, 2, 300).astype(np.uint8).tobytes() + b"\xff" * 40 + bytes(60)
    at = rng.permutation(320)
    data = factors.Bytes(raw, 64)
    padded = raw + bytes(64)
    order, lcp = factors.suffix_order(data, at, 50)
    cut = [padded[k : k + 50] for k in at[order]]
    assert cut == sorted(cut)
    shared = [0] + [next((i for i in range(50) if a[i] != b[i]), 50) for a, b in zip(cut, cut[1:])]
    assert lcp.tolist() == shared
    doc = rng.integers(0, 9, len(at))
    got = factors.previous_factors(doc, lcp, 5)
    for k in range(len(at)):
        best = 0
        for step, edge in ((-1, -1), (1, len(at))):
            depth, j = 50, k
            while j + step != edge:
                depth = min(depth, shared[max(j, j + step)])
                j += step
                if doc[j] < doc[k]:
                    best = max(best, depth)
                    break
        assert got[k] == (best if best >= 5 else 0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=40), min_size=2, max_size=6), st.integers(8, 12))
def test_equal_windows_have_equal_anchors(texts, width):
    shape = factors.Shape(width)
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(t) for t in data])
    joined = b"".join(data)
    row, place, anchor, count = factors.anchored(factors.Bytes(joined, shape.row), offsets, shape)
    seen = {}
    for k in range(len(row)):
        for at in range(place[k], place[k] + count[k]):
            assert offsets[row[k]] <= at and at + width <= offsets[row[k] + 1]
            assert seen.setdefault(joined[at : at + width], anchor[k] - at) == anchor[k] - at
    assert count.sum() == sum(max(0, len(t) - width + 1) for t in data)


@pytest.mark.parametrize("chunk, group", [(1 << 22, 1 << 18), (5000, 2000), (3000, 40)])
def test_against_all_windows(spark, small, odd, monkeypatch, chunk, group):
    monkeypatch.setattr(factors, "CHUNK", chunk)
    monkeypatch.setattr(factors, "GROUP", group)
    monkeypatch.setattr(factors, "SAMPLE", 64 if group > 2000 else 1)
    assert found(spark, small) == brute.byte_repeats(small)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{odd}/documents.parquet").collect()]
    assert found(spark, rows) == brute.byte_repeats(rows)


@pytest.mark.parametrize("width", [8, 13, 50])
def test_few_letters_repeated_ids_and_null_ids(spark, monkeypatch, width):
    monkeypatch.setattr(factors, "CHUNK", 700)
    monkeypatch.setattr(factors, "GROUP", 30)
    monkeypatch.setattr(factors, "SAMPLE", 1)
    rng = random.Random(width)
    passage = "".join(rng.choices("abc", k=60))
    rows = [(rng.choice([None, *range(12)]), "".join(rng.choices("ab" + "é" * (k % 2), k=rng.randint(0, 150)))) for k in range(40)]
    rows += [(k % 9, rng.choice("xyz") * k + passage[: 40 + k] + "".join(rng.choices("pq", k=k))) for k in range(20)]
    # One id over two texts: only the one with the passage loses it, and twice over.
    rows += [(1, passage), (5, passage + "-" + passage), (5, "of its own, " * 9), (5, None), (3, "z" * 500), (4, "z" * 300), (4, "z" * 300)]
    assert found(spark, rows, width) == brute.byte_repeats(rows, width)
    with pytest.raises(ValueError):
        factors.Shape(7)


def test_one_passage_in_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(factors, "CHUNK", 1 << 14)
    monkeypatch.setattr(factors, "GROUP", 500)
    rng = random.Random(1)
    passage = "".join(rng.choices("abcdefgh ", k=200))
    rows = [(k, "".join(rng.choices("ijklmnop ", k=80)) + (passage if k % 3 == 0 else "") + "".join(rng.choices("ijklmnop ", k=60))) for k in range(3000)]
    got = {r[0]: r for r in found(spark, rows, parts=8)}
    assert got["0"][2] == () and all(got[str(k)][2] == () for k in range(3000) if k % 3)
    for k in range(3, 3000, 3):
        # What goes is the passage, and a byte or two more where the surroundings agree by chance.
        (start, length), = got[str(k)][2]
        assert start <= 80 and start + length >= 280 and length < 210
