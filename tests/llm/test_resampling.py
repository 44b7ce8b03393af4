"""Importance resampling against a plain restatement with n-grams of several orders."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from casebook.llm import resampling
from tests.llm.brute import LOWER

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, ngrams, buckets):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[k : k + n]) for n in range(1, ngrams + 1) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def plain(rows, targets, ngrams, buckets, min_words, percent, seed):
    found = [(d, *grams(t, ngrams, buckets)) for d, t in rows]
    s = np.bincount([b for *_, g in found for b in g], minlength=buckets)
    t = np.bincount([b for x in targets for b in grams(x, ngrams, buckets)[1]], minlength=buckets)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    out = []
    for d, n, g in found:
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in g)
        out.append((d, n, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    return sorted(map(str, [(*r, k + 1 if k < percent * len(able) // 100 else None) for k, r in enumerate(able)] + [(*r, None) for r in out if r[1] < min_words]))


@pytest.mark.parametrize("ngrams, buckets, batch, percent", [(1, 10_000, 1 << 22, 10), (2, 500, 3000, 50), (4, 97, 1, 100)])
def test_against_plain_counts(spark, odd, monkeypatch, ngrams, buckets, batch, percent):
    monkeypatch.setattr(resampling, "BATCH", batch)
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    target = spark.read.parquet(f"{odd}/benchmark.parquet")
    got = resampling.resample(docs, target, ngrams, buckets, percent=percent).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain(rows, [r.text for r in target.collect()], ngrams, buckets, 20, percent, resampling.SEED)
    assert sorted(str(tuple(r)) for r in got) == want


def test_equal_scores_null_ids_and_one_hot_text(spark):
    rows = [(None, "word " * 25)] * 3 + [(k % 50, "word " * 25) for k in range(600)] + [(k, f"w{k} " * 21) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("word",)], "text string")
    got = resampling.resample(docs, target, percent=37).collect()
    want = plain(rows, ["word"], 1, resampling.BUCKETS, 20, 37, resampling.SEED)
    assert sorted(str(tuple(r)) for r in got) == want
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert ranks == list(range(1, 37 * 903 // 100 + 1))


def test_no_gram_crosses_a_text():
    texts = [b"a b", b"", b"c", b"d\x00e f"]
    owner, bucket, words = resampling.features(texts, 2, 1 << 31)
    want = [b"a", b"b", b"c", b"d", b"e", b"f", b"a b", b"d e", b"e f"]
    assert words.tolist() == [2, 0, 1, 3]
    assert owner.tolist() == [0, 0, 2, 3, 3, 3, 0, 3, 3]
    assert bucket.tolist() == [zlib.crc32(w) % (1 << 31) for w in want]
