"""Raw agency CSV files: admission, routing, header layouts, row reading.

Every header row decides how its own file is read, so files are grouped by
(source, dataset, header) and each group is one Spark CSV scan.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook import vocab
from casebook.functions import text as tx

LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


@dataclass(frozen=True)
class Layout:
    """Files of one dataset that share one header row; `quoted` are those with
    line breaks inside quotes."""

    source: str
    dataset: str
    header: tuple[str, ...]
    paths: tuple[str, ...]
    quoted: frozenset[str] = frozenset()


_SCHEME = r"^[A-Za-z0-9+.\-]+:/+"


def object_key(path: Column, root: str) -> Column:
    """The file's path below the landing root."""
    folder = re.sub(_SCHEME, "/", root).strip("/")
    plain = F.regexp_replace(path, _SCHEME, "/")
    return F.substring_index(plain, f"/{folder}/", -1)


def scanned_path(encoded: Column | None = None) -> Column:
    """The row's file. Scans report it URL-encoded, listings do not."""
    encoded = F.col("_metadata.file_path") if encoded is None else encoded
    return F.try_url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def is_admitted(key: Column) -> Column:
    """Output files of the lake itself are never taken in."""
    derived = reduce(
        lambda a, b: a | b, [key.endswith(s) for s in vocab.DERIVED_SUFFIXES]
    )
    return ~(key.startswith(f"{vocab.BRONZE_ZONE}/") | derived)


def is_notified(key: Column) -> Column:
    """Only files below the intake folder announce themselves."""
    return key.startswith(f"{vocab.INTAKE_ROOT}/")


def route(key: Column) -> Column:
    """Key -> struct(source, dataset) from its first two folders."""
    parts = F.split(key, "/")
    rooted = F.element_at(parts, 1).isin(*vocab.SOURCE_ROOTS)

    def segment(position: int, default: str) -> Column:
        found = F.nullif(F.try_element_at(parts, F.lit(position)), F.lit(""))
        return F.coalesce(F.when(rooted, found), F.lit(default))

    return F.struct(
        segment(2, vocab.UNKNOWN_SOURCE).alias("source"),
        segment(3, vocab.GENERIC_DATASET).alias("dataset"),
    )


def _routed(files: DataFrame, root: str) -> DataFrame:
    return (
        files.select("path", "length", object_key(F.col("path"), root).alias("key"))
        .where(is_admitted(F.col("key")) & (F.col("length") > 0))
        .select("path", "key", route(F.col("key")).alias("r"))
        .select("path", "key", "r.source", "r.dataset")
    )


def list_landing(spark: SparkSession, root: str) -> DataFrame:
    """Admitted files below ``root`` (a listing: file contents are not read)."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    )
    return _routed(files.select("path", "length"), root)


def stream_landing(
    spark: SparkSession, root: str, max_files: int = 1000
) -> DataFrame:
    """The same listing as an unbounded stream of newly arrived files."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(root)
    )
    routed = _routed(files.select("path", "length"), root)
    return routed.where(is_notified(F.col("key")))


def backfill_listing(spark: SparkSession, root: str) -> DataFrame:
    """Every historical CSV file, for a full re-ingest."""
    key = F.col("key")
    return list_landing(spark, root).where(
        key.startswith(f"{vocab.BACKFILL_ROOT}/") & key.endswith(".csv")
    )


class UnreadableFiles(ValueError):
    """Files without a header line: nothing of them could be taken in."""

    def __init__(self, paths: list[str]):
        super().__init__(f"{len(paths)} landing files have no header line, first: {paths[0]}")
        self.paths = paths


def _first_lines(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, bool, bool]]:
    """File -> its first line that is not blank, and whether quotes stay open at
    the end of that line and of any line.

    One pass of text splits through Spark's own file systems, reduced to a row
    per file before anything moves; a header may be of any length.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id())
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), scanned_path().alias("path"), place.alias("place"), "value",
        ((F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2 == 1).alias("open"),
    )
    filled = tx.trim(F.regexp_replace("value", "^\ufeff", "")) != ""
    first = F.min_by(F.struct("value", "open"), F.when(filled, F.col("place")))
    found = lines.groupBy("path").agg(first.alias("first"), F.bool_or("open").alias("broken"))
    rows = found.where("first is not null").collect()
    return {_plain(r.path): (r.first.value, r.first.open, r.broken) for r in rows}


def _plain(path: str) -> str:
    """The path without scheme, so that spellings of it compare equal."""
    return re.sub(_SCHEME, "/", path)


def _header_cells(spark: SparkSession, path: str, line: str, is_open: bool) -> tuple[str, ...]:
    if is_open:
        # A line break inside a quoted header: only a record reader can tell its end.
        row = spark.read.option("multiLine", True).option("escape", '"').csv(path).first()
        cells = ["" if c is None else c for c in row]
    else:
        csv.field_size_limit((1 << 31) - 1)
        cells = next(csv.reader([line]))
    return tuple(c.lstrip("\ufeff").strip() for c in cells)


def layouts(files: DataFrame, on_unreadable: str = "raise") -> list[Layout]:
    """Distinct layouts with their files: plan-time metadata, like a file index.

    A file without a header line is an error, or left out with
    ``on_unreadable="skip"``; either way nothing is lost in silence, as
    ``UnreadableFiles`` and ``unreadable`` name them.
    """
    spark = files.sparkSession
    listed = files.select("path", "source", "dataset").collect()
    if not listed:
        return []
    heads = _first_lines(spark, [f.path for f in listed])
    missing = sorted(f.path for f in listed if _plain(f.path) not in heads)
    if missing and on_unreadable == "raise":
        raise UnreadableFiles(missing)
    groups: dict[tuple, list[tuple[str, bool]]] = {}
    parsed: dict[str, tuple[str, ...]] = {}
    for f in listed:
        if _plain(f.path) not in heads:
            continue
        line, is_open, broken = heads[_plain(f.path)]
        if is_open or line not in parsed:
            header = _header_cells(spark, f.path, line, is_open)
            if not is_open:
                parsed[line] = header
        else:
            header = parsed[line]
        groups.setdefault((f.source, f.dataset, header), []).append((f.path, broken))
    return [
        Layout(*key, tuple(sorted(p for p, _ in found)), frozenset(p for p, broken in found if broken))
        for key, found in sorted(groups.items())
    ]


def unreadable(files: DataFrame) -> list[str]:
    """Listed files without a header line."""
    listed = [r.path for r in files.select("path").collect()]
    heads = _first_lines(files.sparkSession, listed) if listed else {}
    return sorted(p for p in listed if _plain(p) not in heads)


def read_rows(
    spark: SparkSession, layout: Layout, root: str, multiline: bool | None = None
) -> DataFrame:
    """Rows of one layout: ``c0..cN`` all strings in header order, plus ``key``
    and ``surplus``, the whole record where a row has more cells than the header.

    Columns are positional, so header names that differ only in case are fine.
    Empty cells are ``""``, never null. Files whose quotes span lines are read a
    record at a time, a task each, and their records dealt by a hash of their cells,
    so that what is made of them is the work of many tasks; all others split.
    ``multiline`` sets one way for all files.
    """
    names = [f"c{i}" for i in range(len(layout.header))]
    whole = "_record"
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, whole)])

    def scan(paths: list[str], across_lines: bool) -> DataFrame:
        found = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("multiLine", across_lines)
            .option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True)
            .option("maxCharsPerColumn", -1)
            .option("maxColumns", max(20480, 4 * len(names)))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", whole)
            .csv(paths)
            .select("*", F.col("_metadata.file_path").alias("_file"))
        )
        if across_lines:
            found = found.repartition(F.xxhash64(*names, whole))
        return found.withColumn("key", object_key(scanned_path(F.col("_file")), root)).drop("_file")

    spanning = [p for p in layout.paths if (p in layout.quoted if multiline is None else multiline)]
    single = [p for p in layout.paths if p not in set(spanning)]
    rows = reduce(
        DataFrame.unionByName,
        [scan(paths, across) for paths, across in ((single, False), (spanning, True)) if paths],
    )
    # A record of another length than the header comes with its text.
    unquoted = F.regexp_replace(whole, '"([^"]|"")*"', "")
    cells = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","))) + 1
    surplus = F.when(cells > len(names), tx.trim(F.col(whole)))
    return rows.select(
        *[F.coalesce(F.col(n), F.lit("")).alias(n) for n in names], "key", surplus.alias("surplus")
    )
