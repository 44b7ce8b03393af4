"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text's terms are pairs of neighbouring byte classes (letters by themselves, signs by
themselves, capitals, digits and white space as one each), which tell prose from
shouting, tables and noise in any language, and steps of the share of words that repeat
the word before them. Log counts times inverse document frequency
are projected to the leading singular directions of a bounded labelled sample. Every
document is compared with all labelled vectors by exact cosine products, in blocks, and
its nearest neighbours vote, weighted by similarity.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import common

#: Documented bound: labelled rows the vectors are fitted on and broadcast for.
SAMPLE = 4096
DIMENSIONS, NEIGHBOURS, SHARPNESS, THRESHOLD = 64, 24, 8, 0.3
CLASSES = 64
TERMS = CLASSES * CLASSES
#: The last class is free: its pairs stand for shares of repeated words, of this weight.
REPEATS, REPEAT_TERM, REPEAT_WEIGHT = (0.02, 0.05, 0.1, 0.2, 0.4), TERMS - CLASSES, 8.0
#: Documents compared with all labelled vectors at a time.
BLOCK = 512


def _byte_classes() -> np.ndarray:
    """Class of every byte: 0 space, 1 other white space, 2 digit, 3 capital, 4 beyond ASCII."""
    classes = np.full(256, 4, np.uint16)
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    for k, b in enumerate(signs):
        classes[b] = 5 + k
    for b in range(26):
        classes[97 + b] = 5 + len(signs) + b
    classes[[b for b in range(33) if b != 32] + [127]] = 1
    classes[32] = 0
    classes[48:58] = 2
    classes[65:91] = 3
    return classes


BYTE_CLASS = _byte_classes()


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(n, TERMS) log counts of byte-class pairs of each text, read a stretch at a time."""
    n = len(offsets) - 1
    counts = np.zeros(n * TERMS, np.float32)
    step = 1 << 19
    for at in range(0, len(data) - 1, step):
        end = min(at + step, len(data) - 1)
        classes = BYTE_CLASS[data[at : end + 1]]
        owner = np.repeat(np.arange(n), np.diff(np.clip(offsets, at, end + 1)))
        inner = owner[1:] == owner[:-1]
        first, last = int(owner[0]), int(owner[-1])
        pair = (owner[:-1] - first) * TERMS + classes[:-1] * np.int64(CLASSES) + classes[1:]
        found = np.bincount(pair[inner], minlength=(last - first + 1) * TERMS)
        counts[first * TERMS : (last + 1) * TERMS] += found
    counts = np.log1p(counts).reshape(n, TERMS)
    raw = data.tobytes()
    for k in range(n):
        words = raw[offsets[k] : offsets[k + 1]].split()
        share = sum(map(eq, words, words[1:])) / max(len(words), 1)
        counts[k, REPEAT_TERM : REPEAT_TERM + len(REPEATS)] = REPEAT_WEIGHT * (share >= np.array(REPEATS))
    return counts


@dataclass
class Voters:
    """Labelled vectors (n, d), their labels, the term weights and the projection."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fit(counts: np.ndarray, labels: np.ndarray) -> Voters:
    """Term weights, leading singular directions and labelled vectors of a sample.

    counts are log counts (n, TERMS). Without rows every score will be 0.5.
    """
    n = len(counts)
    if not n:
        empty = np.zeros((0, 1), np.float32)
        return Voters(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), empty, np.zeros(0, np.float32), 0.5)
    weights = np.log((1 + n) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    rows = _unit(counts.astype(np.float32) * weights).astype(np.float32)
    width = min(DIMENSIONS, n, TERMS)
    # Range finder with power steps; the sample is bounded, so this is too.
    probe = np.random.default_rng(1).normal(size=(TERMS, width + 16)).astype(np.float32)
    for _ in range(4):
        probe, _r = np.linalg.qr(rows.T @ (rows @ probe))
    _u, _s, right = np.linalg.svd(rows @ probe, full_matrices=False)
    directions = (probe @ right[:width].T).astype(np.float32)
    return Voters(weights, directions, _unit(rows @ directions).astype(np.float32), labels.astype(np.float32), float(labels.mean()))


def vote(voters: Voters, counts: np.ndarray) -> np.ndarray:
    """Score of each row of log counts: the neighbours' labels, weighted by similarity."""
    vectors = _unit((counts * voters.weights) @ voters.directions).astype(np.float32)
    out = np.full(len(counts), voters.prior)
    k = min(NEIGHBOURS, len(voters.labels))
    for at in range(0, len(vectors) if k else 0, BLOCK):
        cosine = vectors[at : at + BLOCK] @ voters.vectors.T
        near = np.argpartition(cosine, len(voters.labels) - k, axis=1)[:, -k:]
        weight = np.clip(np.take_along_axis(cosine, near, axis=1), 0, 1).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        voted = (weight * voters.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
        # A text without a pair, or like nothing labelled, gets the labels' mean.
        out[at : at + BLOCK] = np.where(total > 1e-9, voted, voters.prior)
    return np.clip(out, 0, 1)


def learn(docs: DataFrame, labels: DataFrame) -> Voters:
    """Fit on at most SAMPLE labelled rows outside the held-out fifth.

    labels has doc_id and quality; rows with a null in either are left out. The rows
    with the smallest id hashes are taken. Only fixed-size term counts reach the driver.
    """
    common.python_ready(docs.sparkSession)
    usable = labels.filter((common.fold_of() != 0) & F.col("quality").isNotNull())
    chosen = (
        usable.groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    )
    # Proven bound: SAMPLE rows of an id and a label.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text")

    def run(batches):
        for batch in batches:
            data, offsets = common.utf8(batch.column("text"))
            for a, b in common.slices(offsets, 1 << 18):
                own = offsets[a : b + 1] - offsets[a]
                counts = term_counts(data[offsets[a] : offsets[b]], own).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(a, b - a), pa.array([r.tobytes() for r in counts], pa.binary())],
                    ["label", "counts"],
                )

    # Equal texts vote once, with the mean of their labels.
    found = rows.mapInArrow(run, "label double, counts binary")
    found = found.groupBy("counts").agg(F.avg("label").alias("label")).orderBy("counts").collect()
    counts = np.stack([np.frombuffer(r["counts"], np.float16) for r in found]) if found else np.zeros((0, TERMS))
    return fit(counts, np.array([r["label"] for r in found], np.float64))


def scores(docs: DataFrame, voters: Voters) -> DataFrame:
    """doc_id and score of every row, from whole texts; nothing else is read.

    Null and empty texts, and texts of one byte, score the labels' mean. Equal texts
    have equal scores.
    """
    common.python_ready(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    # About two megabytes, whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def run(batches):
        for batch in batches:
            data, offsets = common.utf8(batch.column("text"))
            found = np.zeros(batch.num_rows)
            for a, b in common.slices(offsets, 1 << 20):
                # Few rows at a time, as short texts have wide rows of counts too.
                for c in range(a, b, BLOCK):
                    d = min(b, c + BLOCK)
                    own = offsets[c : d + 1] - offsets[c]
                    found[c:d] = vote(shared.value, term_counts(data[offsets[c] : offsets[d]], own))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    voters = learn(docs, common.table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scores(docs, voters).select(
        "doc_id",
        F.coalesce(common.fold_of() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
