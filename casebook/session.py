"""Session settings and the few places that depend on the cluster."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Collection, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Dimension tables are a few MB; Catalyst compares their size (files count
    # threefold, as they unpack) with this before it broadcasts, and shuffles
    # them beyond it. Nothing is hinted past this check.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(
    app: str = "casebook",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own, as in tests; on a
    cluster that is an error, as executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="casebook-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Spark's setting for a query's shuffle files to leave the disk where the query ends,
#: rather than when the driver next collects garbage.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The most files that a task writing by columns keeps open; beyond them it sorts its rows.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

#: Rows from which a step that shuffles all of them goes by groups of parts.
GROUP_ROWS = 250_000

_open = threading.local()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The given settings for as long as the block runs."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def freed(spark: SparkSession):
    """Queries of the block leave no shuffle files behind. For frames that are run once:
    one that is run again would have to shuffle again."""
    return settings(spark, {FREE: "true"})


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables stored within the block leave the shared folder at its end, lasting ones apart."""
    outer = getattr(_open, "paths", None)
    _open.paths = []
    try:
        yield
    finally:
        mine, _open.paths = _open.paths, outer
        for name in mine:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(rows: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """The rows as a table in the shared folder, for what is read more than once."""
    return stored_in_turn([rows], name, lasting=lasting)


def stored_in_turn(
    parts: Sequence[DataFrame], name: str, by: Sequence[str] = (), lasting: bool = False
) -> DataFrame:
    """Frames of one schema as one table. What a part shuffles leaves the disk before
    the next part runs. ``by`` names columns whose values get folders of their own."""
    first = parts[0]
    spark = first.sparkSession
    path = scratch_path(spark, name)
    if not lasting and getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    for part in parts:
        with settings(spark, {FREE: "true", OPEN_FILES: "16"}):
            part.write.mode("append").option("compression", "zstd").partitionBy(*by).parquet(path)
    found = spark.read.schema(first.schema).parquet(path)
    # Columns of folders are read last.
    return found.select(*first.columns) if by else found


def groups(rows: int, parts: Collection, most: int | None = None) -> list[list]:
    """Parts dealt to groups, which a step works off one after another so that it never
    shuffles more than a group's rows at once. Fewer rows are a single group."""
    count = max(1, min(len(parts), rows // GROUP_ROWS, most or len(parts)))
    return [sorted(parts)[first::count] for first in range(count)]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is ever reused."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
