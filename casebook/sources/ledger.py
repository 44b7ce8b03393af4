"""Which landing files went into which batch, so that every file is taken in exactly once.

A batch is planned before any of its rows are written: its name, its files and the
moment that stands for its ingest. Its rows then go to folders named after it, over
whatever an attempt that died left there, and one entry says that it is done. A batch
planned but not done is taken in again under its name, with its files and its moment,
so a replay writes the same rows to the same folders.

``planned/batch=B`` and ``done/batch=B`` are Parquet folders of a row per file.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY = T.StructType([T.StructField("path", T.StringType()), T.StructField("ingested_at", T.TimestampType())])
_LISTED = T.StructType([*ENTRY.fields, T.StructField("batch", T.StringType())])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _folder(root: str, state: str, batch: str | None = None) -> str:
    return f"{root.rstrip('/')}/{state}" + (f"/batch={batch}" if batch else "")


def planned(spark: SparkSession, root: str) -> DataFrame:
    """(path, ingested_at, batch) of all files that are in a batch, done or not."""
    found = _read(spark, _folder(root, "planned"), _LISTED)
    return spark.createDataFrame([], _LISTED) if found is None else found


def pending(spark: SparkSession, root: str) -> list[str]:
    """Batches planned but not done, few at any time."""
    done = _read(spark, _folder(root, "done"), _LISTED)
    names = planned(spark, root).select("batch").distinct()
    if done is not None:
        names = names.join(done.select("batch").distinct(), "batch", "left_anti")
    return sorted(r.batch for r in names.collect())


def is_done(spark: SparkSession, root: str, batch: str) -> bool:
    return _read(spark, _folder(root, "done", batch), ENTRY) is not None


def plan(
    spark: SparkSession, root: str, batch: str, files: DataFrame, ingested_at: Column | None = None
) -> DataFrame:
    """(path, ingested_at) of the batch: what an earlier attempt planned, else planned now."""
    path = _folder(root, "planned", batch)
    earlier = _read(spark, path, ENTRY)
    if earlier is None or earlier.isEmpty():
        stamp = (F.current_timestamp() if ingested_at is None else ingested_at).cast("timestamp")
        entry = files.select("path").distinct().withColumn("ingested_at", stamp)
        entry.coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema(ENTRY).parquet(path)


def finish(spark: SparkSession, root: str, batch: str) -> None:
    entry = spark.read.schema(ENTRY).parquet(_folder(root, "planned", batch))
    entry.coalesce(1).write.mode("overwrite").parquet(_folder(root, "done", batch))
