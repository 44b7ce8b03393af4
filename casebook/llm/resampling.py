"""Importance resampling towards a target distribution over hashed word n-grams.

Documents are weighed by how much likelier their features are in the target texts than
in the corpus, and a fixed share is drawn without replacement by adding Gumbel noise
that depends on the id alone. Texts are read a batch at a time: they are joined with
separator sentinels, one pass of a pattern finds the words of all of them, a search in
the documents' offsets tells whose each word is, n-grams that cross a document's end are
masked, and bincount does the rest.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm import common

#: Words of lower-cased texts: ASCII digits and letters, and all beyond ASCII.
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Stands between the texts of a batch; part of no word.
SENTINEL = b"\x00"
NGRAMS, BUCKETS, MIN_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: Bytes of text read at a time.
BATCH = 1 << 22


def words_of(texts: list[bytes], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, number) of every lower-cased word; known holds the words' numbers and grows."""
    joined = SENTINEL.join(texts).translate(LOWER)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    spans = np.fromiter(chain.from_iterable(m.span() for m in WORDS.finditer(joined)), np.int64).reshape(-1, 2)
    owner = np.searchsorted(offsets, spans[:, 0], side="right") - 1
    word = np.fromiter(
        (known.setdefault(joined[a:b], len(known)) for a, b in spans.tolist()), np.int64, len(spans)
    )
    return owner, word


def features(texts: list[bytes], ngrams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, bucket) of every n-gram of the texts, and the texts' numbers of words.

    An n-gram's bucket is the crc32 of its words joined by one space, modulo buckets.
    """
    known: dict[bytes, int] = {}
    owner, word = words_of(texts, known)
    distinct = list(known)
    gram, crc = word, np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct))
    owners, found = [owner], [crc[gram] % buckets]
    for n in range(2, ngrams + 1):
        # The n-gram at i is the shorter one at i and the word n - 1 places on.
        gram, last = gram[:-1], word[n - 1 :]
        pairs, gram = np.unique(gram * len(distinct) + last, return_inverse=True)
        before, after = np.divmod(pairs, max(len(distinct), 1))
        crc = np.fromiter(
            (zlib.crc32(b" " + distinct[w], int(c)) for c, w in zip(crc[before].tolist(), after.tolist())),
            np.int64, len(pairs),
        )
        inside = owner[: len(last)] == owner[n - 1 :]
        owners.append(owner[: len(last)][inside])
        found.append(crc[gram[inside]] % buckets)
    return np.concatenate(owners), np.concatenate(found), np.bincount(owner, minlength=len(texts))


def text_slices(batches, columns: list[str]):
    """(record batch without text, texts) of about BATCH bytes at a time, each text whole."""
    for batch in batches:
        data, offsets = common.utf8(batch.column("text"))
        data = data.tobytes()
        for a, b in common.slices(offsets, BATCH):
            edges = offsets[a : b + 1].tolist()
            yield batch.select(columns).slice(a, b - a), [data[x:y] for x, y in zip(edges, edges[1:])]


def bucket_counts(texts: DataFrame, ngrams: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket: a table of fixed size, summed up a task at a time."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for _, part in text_slices(batches, []):
            total += np.bincount(features(part, ngrams, buckets)[1], minlength=buckets)
        bucket = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(total[bucket])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed share in the target and the corpus."""
    size = len(corpus)
    ratio = (target + 1.0) * (corpus.sum() + float(size)) / ((corpus + 1.0) * (target.sum() + float(size)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, ngrams: int, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score): a row for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        gain = shared.value
        for rows, texts in text_slices(batches, ["doc_id"]):
            owner, bucket, n_words = features(texts, ngrams, len(gain))
            n_features = np.bincount(owner, minlength=len(texts))
            # Sums of integers far below 2^53 are exact in doubles.
            weight = np.bincount(owner, gain[bucket], minlength=len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    unit = (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return rows.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(unit))))


def resample(
    docs: DataFrame, target: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS,
    min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document.

    Features are all runs of 1 to ngrams words within one text. rank counts the drawn
    documents from 1, highest score first; it is null for the others. Of the documents
    with min_words words or more, percent in a hundred are drawn, rounded down. Equal
    scores go by ascending doc_id, null last, then by fewer features; rows that agree in
    all of these take ranks of their own. A null text has no words, a null id draws as an
    empty one. A rerun draws the same. An empty table gives no rows; without target texts
    the target's shares are even. Other columns are not read.

    Scores are put in order by ranges; only ranges that the draw reaches are ranked, each
    by itself from the count of those before it.
    """
    common.python_ready(docs.sparkSession)
    gain = gains(bucket_counts(docs, ngrams, buckets), bucket_counts(target, ngrams, buckets))
    # Ranges are cut by a first look at the rows, which should not read the texts again.
    rows = common.stored(weighed(docs, gain, ngrams, seed), "weighed").withColumn("able", F.col("n_words") >= min_words)
    order = [
        F.when(F.col("able"), F.col("score")).desc_nulls_last(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(),
    ]
    ranged = common.stored(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "resampling")
    # One row a partition.
    sizes = sorted((r["part"], r["n"]) for r in ranged.filter("able").groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    draws = percent * sum(n for _, n in sizes) // 100
    ends = np.cumsum([0] + [n for _, n in sizes]).tolist()
    reached = [(part, before) for (part, _), before in zip(sizes, ends) if before < draws]
    starts = docs.sparkSession.createDataFrame(reached, "part int, before long")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("before")
    marked = ranged.join(F.broadcast(starts), "part", "left")
    in_reach = F.col("able") & F.col("before").isNotNull()
    ranked = marked.filter(in_reach).withColumn("rank", place.cast("long"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    others = marked.filter(~in_reach).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).drop("part", "before", "able")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    rows = resample(docs, common.table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
q AS (
  SELECT unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
f AS (SELECT r, unnest(words) AS word FROM d),
steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k:
           CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS step),
hashed AS (
  SELECT word, xor(4294967295, list_reduce(
           [4294967295] || list_transform(range(strlen(word)), lambda i: ('0x' || substr(hex(word), 2 * i + 1, 2))::BIGINT),
           lambda c, b: xor(c // 256, step[xor(c % 256, b) + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM (SELECT word FROM f UNION ALL SELECT word FROM q)), steps),
s AS (SELECT bucket, count(*) AS n FROM f JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM q JOIN hashed USING (word) GROUP BY bucket),
gain AS (
  SELECT b.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + 10000)
           / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM q) + 10000))))::BIGINT AS gain
  FROM (SELECT DISTINCT bucket FROM hashed) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
w AS (SELECT r, sum(gain)::BIGINT AS weight FROM f JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY r),
k AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296 AS u
  FROM d LEFT JOIN w USING (r)),
scored AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln(u)))::BIGINT AS score FROM k),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS able
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
FROM placed
"""
