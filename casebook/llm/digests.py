"""Exact dedup against a persistent digest index.

The index is a Parquet table of (digest, keep_id), bucketed and sorted by digest, in a
folder that outlives sessions. New rows are reduced to one per digest, joined against
the index by a sort-merge anti-join that does not move the index, and appended.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm import common
from casebook.session import scratch_path

#: Buckets of a new index, and the folder in it that says how it was made.
BUCKETS, ABOUT = 64, "_index"


def text_digest(text) -> F.Column:
    """SHA-256 of the text with every run of white space replaced by one space."""
    plain = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), common.SPACES, " ")
    return F.unhex(F.sha2(plain, 256))


class DigestIndex:
    """First keeper of every digest seen so far.

    path: the index folder. Its bucket count and id type are stored beside the data
    when it is made; an existing index is opened with these, and asking for others is an
    error. Appends add files, so a bucket may hold several; `compact` writes a new index
    with one file a bucket. Used as a context, or closed, it leaves no table behind.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, id_type: str | None = None):
        known = self._known(spark, path)
        if known is None:
            known = {"buckets": buckets or BUCKETS, "id_type": id_type or "bigint"}
            spark.createDataFrame([tuple(known.values())], "buckets int, id_type string").coalesce(1).write.parquet(f"{path}/{ABOUT}")
        for name, asked in (("buckets", buckets), ("id_type", id_type)):
            if asked is not None and asked != known[name]:
                raise ValueError(f"the index at {path} has {name} {known[name]}, not {asked}")
        self.spark, self.path, self.buckets, self.id_type = spark, path, known["buckets"], known["id_type"]
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id {self.id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    @staticmethod
    def _known(spark: SparkSession, path: str) -> dict | None:
        try:
            return spark.read.parquet(f"{path}/{ABOUT}").first().asDict()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def close(self) -> None:
        """Drop the catalog entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def __enter__(self) -> "DigestIndex":
        return self

    def __exit__(self, *failure) -> None:
        self.close()

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def add(self, new: DataFrame) -> None:
        """Append the digests of `new` (digest, doc_id) that the index lacks.

        Of rows with one digest the smallest id becomes keeper; digests already known
        keep theirs, so a repeated batch changes nothing.
        """
        firsts = new.groupBy("digest").agg(F.min("doc_id").alias("keep_id"))
        fresh = firsts.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        fresh = common.stored(fresh, "fresh-digests", free=True)
        self._dealt(fresh).write.insertInto(self.name)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows with a task for each bucket, whatever the session's number of partitions.

        Tasks that hold parts of all buckets would write a file for each of them.
        """
        return rows.repartitionById(self.buckets, F.pmod(F.hash("digest"), F.lit(self.buckets)))

    def keepers(self) -> DataFrame:
        """The index read as plain files, for joins whose hot keys must be split."""
        return self.spark.read.schema(f"digest BINARY, keep_id {self.id_type}").parquet(self.path)

    def compact(self, path: str) -> "DigestIndex":
        packed = DigestIndex(self.spark, path, self.buckets, self.id_type)
        packed._dealt(self.rows()).write.insertInto(packed.name)
        return packed


def digest_rows(docs: DataFrame) -> DataFrame:
    """(digest, doc_id, n): rows counted by digest and id, narrow and stored.

    A null text counts as empty; null ids are an id of their own.
    """
    rows = docs.select(text_digest("text").alias("digest"), F.col("doc_id"))
    return common.stored(rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n")), "digests", free=True)


def exact_groups(docs: DataFrame, index: DigestIndex, batches: int = 2) -> DataFrame:
    """One row per input row: doc_id, digest, keep_id, group_size, kept.

    The rows enter the index in `batches` runs of ascending id, so that of equal texts
    the smallest id is the one that stays. Where a row is repeated with its id, one of
    them stays. A group that has only null ids has a null keeper, and one of it stays.
    An empty table gives no rows. Texts of any length are read whole and leave the row
    as a digest. Other columns are not read. The index may be closed afterwards.
    """
    rows = digest_rows(docs)
    share = [k / batches for k in range(1, batches)]
    cuts = rows.agg(F.percentile_approx("doc_id", share).alias("c")).first()["c"] if share else None
    edges = sorted(set(cuts or []))
    part = F.col("doc_id")
    for k in range(len(edges) + 1):
        batch = rows
        if k:
            batch = batch.filter(part > edges[k - 1])
        if k < len(edges):
            batch = batch.filter(part <= edges[k])
        index.add(batch)
    if edges:
        index.add(rows.filter(part.isNull()))
    sizes = rows.groupBy("digest").agg(F.sum("n").alias("group_size"))
    groups = common.stored(index.keepers().join(sizes, "digest"), "digest-groups", free=True)
    copies = F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))
    return (
        rows.join(groups, "digest")
        .select("doc_id", "digest", "keep_id", "group_size", copies.alias("copy"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))
        .drop("copy")
    )


def fresh_index(spark: SparkSession, id_type: str = "bigint") -> DigestIndex:
    """An empty index in the shared folder."""
    return DigestIndex(spark, scratch_path(spark, "digest-index"), id_type=id_type)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, each column as it was; repeated rows once."""
    id_key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    with fresh_index(docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()) as index:
        kept = exact_groups(docs, index).filter("kept").select("digest", id_key.alias("id"))
    # The join leaves rows dealt by both keys, so the window moves nothing.
    once = F.row_number().over(Window.partitionBy("digest", "id").orderBy("id"))
    return (
        docs.select(F.struct("*").alias("row"), text_digest("text").alias("digest"), id_key.alias("id"))
        .join(kept, ["digest", "id"])
        .withColumn("place", once).filter("place = 1")
        .select("row.*")
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    with fresh_index(spark) as index:
        rows = exact_groups(docs, index)
    return rows.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
