"""What several operators share: tables, stored steps, folds, bounded samples, text buffers."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.session import scratch_path

#: Words are runs of anything but these; the texts' only white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

#: Spark's setting for shuffle files to be removed where a query ends.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, name: str, free: bool = False) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage, outlives executors.

    With `free`, what was shuffled to make them leaves the disk as soon as they are written,
    rather than when the driver next collects garbage.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FREE, "false")
    try:
        if free:
            spark.conf.set(FREE, "true")
        rows.write.parquet(path)
    finally:
        if free:
            spark.conf.set(FREE, before)
    return spark.read.schema(rows.schema).parquet(path)


def python_ready(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, known) if x)


def words_in(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def fold_of(id_column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5


def bounded_sample(rows: DataFrame, label: str, limit: int, per_label: bool) -> list:
    """At most `limit` distinct (label, text) rows, for every label where per_label is set.

    The rows with the smallest text hashes are taken, each distinct text once for a
    label, so neither copies nor partitions sway the choice. Two narrow passes: the
    hashes first, then the texts of the chosen ones.
    """
    hashed = rows.select(F.col(label).alias("label"), F.xxhash64("text").alias("h"), "text")
    distinct = hashed.select("label", "h").distinct()
    if per_label:
        # By parts of the hash first, so that no label's rows meet in one task before
        # they are few.
        chosen = distinct.withColumn("part", F.pmod("h", F.lit(256)))
        for keys in (("label", "part"), ("label",)):
            place = F.row_number().over(Window.partitionBy(*keys).orderBy("h"))
            chosen = chosen.withColumn("place", place).filter(F.col("place") <= limit).drop("place")
        chosen = chosen.select("label", "h")
    else:
        chosen = distinct.orderBy("h", "label").limit(limit)
    # Proven bound: `limit` rows, or as many for each label.
    found = hashed.join(F.broadcast(chosen), ["label", "h"]).dropDuplicates(["label", "h"])
    return sorted(((r["label"], r["text"]) for r in found.select("label", "text").collect()),
                  key=lambda r: (str(r[0]), r[1]))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and its n + 1 offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int):
    """Row ranges of about `most` bytes each, one row at least."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield start, end
        start = end
