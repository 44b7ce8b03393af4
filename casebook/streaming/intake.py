"""Structured Streaming around the batch jobs.

The file source's checkpoint is the log of files already seen. A batch is the
same code as a batch run; replays are harmless, since ids are deterministic and
silver keeps the latest version of each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from casebook import schemas
from casebook.operators import merge
from casebook.plans import pipeline
from casebook.sources import landing, tables


def run(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, once: bool
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    if once:
        query.awaitTermination()
    return query


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream: a new checkpoint is a new stream, whose
    batches start at 0 again and must not pass for another's."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id


def intake(
    spark: SparkSession, paths: pipeline.Paths, max_files: int = 1000, once: bool = True, **options
) -> StreamingQuery:
    """New landing files -> bronze and quarantine, a batch of files at a time.

    A batch is named after the stream and its number, so one that Spark hands
    over again after a failure replaces its own rows.
    """
    checkpoint = f"{paths.checkpoints}/intake"

    def handle(files: DataFrame, batch_id: int) -> None:
        session = files.sparkSession
        batch = f"intake-{stream_id(session, checkpoint)}-{batch_id}"
        pipeline.run_ingest(session, paths, files, batch=batch, **options)

    stream = landing.stream_landing(spark, paths.landing, max_files)
    return run(stream, handle, checkpoint, once)


def upsert(
    spark: SparkSession,
    paths: pipeline.Paths,
    max_files: int = 10_000,
    once: bool = True,
    us_dates: bool = False,
    keep_enrichment: bool = False,
) -> StreamingQuery:
    """New bronze files -> silver. Only files not merged before are read; the
    version with the newest ingest time wins, in whatever order they come."""
    checkpoint = f"{paths.checkpoints}/upsert"

    def handle(bronze: DataFrame, batch_id: int) -> None:
        session = bronze.sparkSession
        rows = merge.bronze_to_silver(bronze, us_dates)
        batch = f"upsert-{stream_id(session, checkpoint)}-{batch_id}"
        merge.merge_into_silver(session, rows, paths.silver, batch, keep_enrichment)

    stream = (
        spark.readStream.schema(schemas.BRONZE_STORED)
        .option("maxFilesPerTrigger", max_files)
        .parquet(tables.zone_path(paths.lake, "reef")).drop("batch")
    )
    return run(stream, handle, checkpoint, once)


def serve(
    spark: SparkSession, paths: pipeline.Paths, as_of, max_files: int = 10_000, once: bool = True
) -> StreamingQuery:
    """Changed gold files -> a refresh of their levels' documents."""

    def handle(files: DataFrame, batch_id: int) -> None:
        session = files.sparkSession
        changed = files.select(tables.level_of_path(files["path"]).alias("level"))
        # Five levels at most.
        levels = [r.level for r in changed.where("level is not null").distinct().collect()]
        pipeline.run_serving(session, paths, as_of, levels)

    stream = (
        spark.readStream.format("binaryFile").schema(landing.LISTING)
        .option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files)
        .load(paths.gold).select("path")
    )
    return run(stream, handle, f"{paths.checkpoints}/serve", once)
