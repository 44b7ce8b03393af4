"""Bronze, quarantine, gold and document tables."""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from casebook import schemas, session, vocab

LEVELS = ("nation", "state", "city", "company", "site")
GOLD_FOLDERS = {
    "nation": "nation", "state": "states", "city": "cities",
    "company": "companies", "site": "sites",
}


def zone_path(lake: str, zone: str) -> str:
    return f"{lake.rstrip('/')}/zone={zone}"


def _read_zone(spark: SparkSession, lake: str, zone: str) -> DataFrame:
    # The stored schema names the partition columns as strings, so years are
    # not inferred as numbers; filters on them prune folders.
    return spark.read.schema(schemas.BRONZE_STORED).parquet(zone_path(lake, zone)).drop("batch")


def read_bronze(spark: SparkSession, lake: str) -> DataFrame:
    return _read_zone(spark, lake, vocab.BRONZE_ZONE)


def read_quarantine(
    spark: SparkSession, lake: str, newest_files: int | None = None
) -> DataFrame:
    """Quarantined rows with their file; optionally only the newest N files."""
    rows = _read_zone(spark, lake, vocab.QUARANTINE_ZONE).select(
        "*",
        F.col("_metadata.file_path").alias("file_key"),
        F.col("_metadata.file_modification_time").alias("_changed"),
    )
    if newest_files is not None:
        newest = (
            rows.groupBy("file_key").agg(F.max("_changed").alias("_changed"))
            .orderBy(F.desc("_changed"), "file_key").limit(newest_files)
            .select("file_key")
        )
        rows = rows.join(newest, "file_key", "left_semi")
    return rows.drop("_changed")


def peek_bronze(spark: SparkSession, lake: str, rows: int = 3) -> DataFrame:
    return read_bronze(spark, lake).select(
        "company_name", "company_slug", "city", "state"
    ).limit(rows)


def peek_quarantine(spark: SparkSession, lake: str, rows: int = 10) -> tuple[DataFrame, int]:
    """A look at the quarantine and how much there is."""
    held = _read_zone(spark, lake, vocab.QUARANTINE_ZONE)
    return held.limit(rows), held.count()


# Files that a task writing zones holds open at a time; beyond them its rows are sorted.
OPEN_FILES = 16
_OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"


def write_zones(
    routed: DataFrame, lake: str, max_rows_per_file: int = 0, batch: str | None = None
) -> None:
    """Append valid and quarantined rows in one pass.

    ``zone`` is the first partition column, so the rows are computed once and
    nothing is cached; no shuffle is needed, a task writes its own files. The
    last one is the batch: the same batch written again replaces its own rows
    and no others. Without a name the batch is new. A task keeps the few files of
    its partitions open and sorts no rows, unless they are more than ``OPEN_FILES``.
    """
    conf = routed.sparkSession.conf
    earlier = conf.get(_OPEN_FILES_SETTING)
    conf.set(_OPEN_FILES_SETTING, str(OPEN_FILES))
    try:
        (
            routed.withColumn("batch", F.lit(batch or uuid.uuid4().hex))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("zone", "partition_source", "partition_year", "batch")
            .option("maxRecordsPerFile", max_rows_per_file)
            .parquet(lake)
        )
    finally:
        conf.set(_OPEN_FILES_SETTING, earlier)


def gold_path(root: str, level: str) -> str:
    return f"{root.rstrip('/')}/{GOLD_FOLDERS[level]}"


def write_gold(gold: DataFrame, root: str, level: str) -> None:
    """Replace one level's JSON; city files are partitioned by state."""
    writer = gold.write.mode("overwrite").option("compression", "none")
    if level == "city":
        writer = writer.partitionBy("state")
    with session.freed(gold.sparkSession):
        writer.json(gold_path(root, level))


def read_gold(spark: SparkSession, root: str, level: str) -> DataFrame:
    """JSON lines of one level; blank and broken lines are skipped, which
    ``gold_line_counts`` reports."""
    return (
        spark.read.schema(schemas.GOLD[level])
        .option("mode", "DROPMALFORMED")
        .json(gold_path(root, level))
    )


def gold_line_counts(spark: SparkSession, root: str, level: str) -> DataFrame:
    """(file, lines, skipped): how many lines each gold file has, and how many of them
    ``read_gold`` leaves out as they are no JSON or not of the level's types. Blank lines
    do not count."""
    kinds = T.StructType([*schemas.GOLD[level].fields, T.StructField("_broken", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    lines = spark.read.text(gold_path(root, level)).select(
        F.col("_metadata.file_path").alias("file"), "value"
    ).where(F.trim("value") != "")
    broken = F.from_json("value", kinds, options)["_broken"]
    return lines.groupBy("file").agg(F.count("*").alias("lines"), F.count(broken).alias("skipped"))


def level_of_path(key: Column) -> Column:
    """Which roll-up a gold file belongs to, null for other files."""
    return F.coalesce(
        *[
            F.when(key.contains(f"/{folder}/"), F.lit(level))
            for level, folder in GOLD_FOLDERS.items()
        ]
    )


# Parts by key of a new document table; the folder names say of how many they are.
DOCUMENT_PARTS = 16


def document_part(parts: int) -> Column:
    return F.concat(F.pmod(F.xxhash64("PK"), F.lit(parts)).cast("string"), F.lit(f"-of-{parts}"))


def _in_parts(docs: DataFrame, parts: int) -> DataFrame:
    """Documents dealt by level and part, sorted by key within each."""
    dealt = docs.withColumn("pk_part", document_part(parts)).hint("rebalance", F.col("level"), F.col("pk_part"))
    return dealt.sortWithinPartitions("level", "pk_part", "PK", "SK")


def write_documents(docs: DataFrame, path: str, levels: Collection[str] | None = None) -> None:
    """Replace all documents, or those of the given levels. Entities that vanished
    from gold vanish here too."""
    with session.freed(docs.sparkSession):
        if levels is None:
            _in_parts(docs, DOCUMENT_PARTS).write.mode("overwrite").partitionBy("level", "pk_part").parquet(path)
            return
        for level in levels:
            own = _in_parts(docs.where(F.col("level") == level), DOCUMENT_PARTS).drop("level")
            own.write.mode("overwrite").partitionBy("pk_part").parquet(f"{path.rstrip('/')}/level={level}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DOCUMENTS_STORED).parquet(path)


def _document_parts(stored: DataFrame) -> int:
    """The number of parts a table was written with."""
    one = stored.select("pk_part").first()
    return int(one.pk_part.rsplit("-", 1)[1]) if one else DOCUMENT_PARTS


def find_stored_document(spark: SparkSession, path: str, pk: str, sk: str = "SUMMARY") -> DataFrame:
    """One document by key: one part of each level is opened, and within its files
    only the row groups whose keys enclose this one."""
    stored = read_documents(spark, path)
    part = spark.range(1).select(F.lit(pk).alias("PK")).select(document_part(_document_parts(stored))).first()[0]
    return find_document(stored.where(F.col("pk_part") == part), pk, sk).drop("pk_part")


def upsert_stored_documents(
    spark: SparkSession, path: str, changed: DataFrame, gone: DataFrame | None = None
) -> list[tuple[str, str]]:
    """Upsert into the stored table; returns the (level, part) folders written.

    Only parts that a changed key falls in are read and written. All documents of the
    keys ``gone`` (level, PK) go first. A later ``updatedAt`` wins.
    """
    stored = read_documents(spark, path)
    parts = _document_parts(stored)
    place = ["level", "pk_part"]
    with session.passing(spark):
        changed = session.stored(changed.withColumn("pk_part", document_part(parts)), "changed-documents")
        touched = changed.select(*place)
        if gone is not None:
            touched = touched.unionByName(gone.withColumn("pk_part", document_part(parts)).select(*place))
        # At most the number of levels times parts.
        found = sorted((r.level, r.pk_part) for r in touched.distinct().collect())
        if not found:
            return []
        current = stored.where(F.concat_ws("/", *place).isin(["/".join(f) for f in found]))
        if gone is not None:
            current = current.join(gone.select("level", "PK"), ["level", "PK"], "left_anti")
        merged = upsert_documents(current.select(*changed.columns), changed).drop("pk_part")
        merged = session.stored(merged, "merged-documents")
        writer = _in_parts(merged, parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        with session.freed(spark):
            writer.partitionBy(*place).parquet(path)
        left = {(r.level, r.pk_part) for r in merged.select("level", document_part(parts).alias("pk_part")).distinct().collect()}
        for level, part in set(found) - left:
            # All documents of the part are gone; an empty file takes their place.
            merged.drop("level").limit(0).write.mode("overwrite").parquet(f"{path.rstrip('/')}/level={level}/pk_part={part}")
        return found


def upsert_documents(current: DataFrame, changed: DataFrame) -> DataFrame:
    """Newest document per key; on a tie the changed one wins."""
    both = current.withColumn("_new", F.lit(0)).unionByName(
        changed.withColumn("_new", F.lit(1))
    )
    newest = Window.partitionBy("PK", "SK").orderBy(F.desc("updatedAt"), F.desc("_new"))
    return (
        both.withColumn("_rn", F.row_number().over(newest))
        .where("_rn = 1").drop("_rn", "_new")
    )


def document_keys(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("SK") == "SUMMARY").select("PK")


def find_document(docs: DataFrame, pk: str, sk: str = "SUMMARY") -> DataFrame:
    """One document by key; the equality reaches the Parquet scan."""
    return docs.where((F.col("PK") == pk) & (F.col("SK") == sk))


# --- Catalog tables ----------------------------------------------------------


def _ddl(fields) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def create_bronze_table(spark: SparkSession, lake: str, name: str = "reef") -> None:
    """External table over the bronze folder, then partition discovery."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schemas.BRONZE_STORED.fields)}) USING PARQUET "
        f"PARTITIONED BY (partition_source, partition_year, batch) "
        f"LOCATION '{zone_path(lake, vocab.BRONZE_ZONE)}'"
    )
    repair_partitions(spark, name)


def repair_partitions(spark: SparkSession, name: str = "reef") -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget the table; an external table's files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_silver_table(
    spark: SparkSession, location: str, database: str = "silver", table: str = "events"
) -> None:
    """Drop and create the silver table, partitioned by source and event year."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    drop_table(spark, f"{database}.{table}")
    fields = schemas.SILVER.fields
    spark.sql(
        f"CREATE TABLE {database}.{table} ({_ddl(fields)}, event_year string) USING PARQUET "
        f"OPTIONS (compression 'snappy') PARTITIONED BY (event_source, event_year) "
        f"LOCATION '{location}'"
    )
