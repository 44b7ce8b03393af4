"""Latest version per event, and the upsert into the silver table.

Silver is plain Parquet: ``data/version=N/event_source=S/event_year=Y/id_part=P``
plus one small manifest per version (``manifests/version=N``) that says which
version holds each partition. ``id_part`` is a hash of the event's id, so a batch
can only hit the parts its own ids fall in: no other partition is looked at, and
of those only the ones that hold an earlier version, or get a row, are rewritten.
A merge adds its manifest last, so readers of the previous version are never
disturbed and a job that dies half way leaves nothing visible. What a merge reads
besides data is one manifest and one marker named after its batch, however long
the table has lived. A large merge goes through its id parts a group at a time, as
no event is in two of them, so only one group's rows are ever shuffled at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from casebook import schemas, session
from casebook.functions import dates

# Columns an update leaves as they were.
KEPT_ON_UPDATE = ("quarantine_reason",)
# Decide between deliveries of one ingest time, smaller first.
TIES = ("event_source", "source_url", "event_title", "event_details")
ENRICHMENT = ("bedrock_event_title", "bedrock_event_description", "bedrock_verified")
NO_YEAR = NO_SOURCE = "none"
# Parts by id of a new table; an existing one keeps the number it was made with.
ID_PARTS = 8
PLACE = ("event_source", "event_year", "id_part")

MANIFEST = T.StructType(
    [
        T.StructField("event_source", T.StringType()),
        T.StructField("event_year", T.StringType()),
        T.StructField("id_part", T.StringType()),
        T.StructField("holder", T.LongType()),
        T.StructField("parts", T.LongType()),
        T.StructField("batch", T.StringType()),
    ]
)


def latest_per_event(
    rows: DataFrame,
    tie_breakers: Sequence[Column | str] = (),
    newest_by: str = "ingested_at",
    keys: Sequence[str] = ("event_id",),
) -> DataFrame:
    """One row per event: the newest ingest. Ties fall to the given columns.
    ``keys`` are the columns that tell events apart.

    ``row_number() = 1`` is planned with a group limit before the exchange, so
    a heavily re-delivered event shrinks to one row per input partition.
    """
    order = [F.col(newest_by).desc_nulls_last(), *tie_breakers]
    newest = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def _ties(value: dict[str, Column]) -> Column:
    """Comparable struct of a row's tie-breakers, null last, long texts as a hash."""
    parts = []
    for name in TIES[:2]:
        if name in value:
            parts += [value[name].isNull().alias(f"{name}_null"), value[name].alias(name)]
    texts = [value[name] for name in TIES[2:] if name in value]
    return F.struct(*parts, F.xxhash64(F.lit(0), *texts).alias("texts"))


def bronze_to_silver(bronze: DataFrame, us_dates: bool = False) -> DataFrame:
    """Deduplicated bronze rows with silver's types."""
    named = {c: F.col(c) for c in TIES} | {"event_source": F.col("partition_source")}
    rows = latest_per_event(bronze, [_ties(named).asc(), F.col("quarantine_reason").asc()])
    typed = {
        "event_source": F.col("partition_source"),
        "ingested_at": dates.iso_timestamp(F.col("ingested_at")),
        "event_date": dates.event_timestamp(F.col("event_date"), us_dates),
    }
    return rows.select(
        *[typed.get(c, F.col(c)).alias(c) for c in schemas.SILVER_COLUMNS]
    )


def merge_rows(
    current: DataFrame,
    incoming: DataFrame,
    keep_enrichment: bool = False,
    columns: Sequence[str] = schemas.SILVER_COLUMNS,
) -> DataFrame:
    """Upsert by ``event_id``; both sides hold each id once.

    A match takes every incoming value, nulls too, except the columns an
    update leaves alone, unless the incoming row is the older one: the newest
    ``ingested_at`` wins (null is oldest), however late it comes, and ties go
    by the same columns as within a batch. ``keep_enrichment`` keeps enriched
    texts where the incoming row has none. Presence is a flag, never a null
    test on data.
    """
    old = current.select(*columns).withColumn("_old", F.lit(True)).alias("o")
    new = incoming.select(*columns).withColumn("_new", F.lit(True)).alias("n")
    joined = old.join(new, F.col("o.event_id") == F.col("n.event_id"), "full_outer")
    is_new, is_old = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    before_at, after_at = F.col("o.ingested_at"), F.col("n.ingested_at")
    first = [_ties({c: F.col(f"{side}.{c}") for c in TIES if c in columns}) for side in "no"]
    newer = (
        F.when(before_at.eqNullSafe(after_at), first[0] <= first[1])
        .otherwise(before_at.isNull() | F.coalesce(after_at > before_at, F.lit(False)))
    )
    wins = is_new & (~is_old | newer)

    def merged(name: str) -> Column:
        before, after = F.col(f"o.{name}"), F.col(f"n.{name}")
        if name in KEPT_ON_UPDATE:
            return F.when(is_old, before).otherwise(after)
        if keep_enrichment and name in ENRICHMENT:
            keep = is_old & F.col("n.bedrock_event_title").isNull()
            return F.when(wins & ~keep, after).otherwise(before)
        return F.when(wins, after).otherwise(before)

    return joined.select(*[merged(c).alias(c) for c in columns])


REPEATED = "merge source holds an event_id more than once"


def assert_unique(rows: DataFrame) -> None:
    """A merge source with a repeated key is an error."""
    repeated = rows.groupBy("event_id").count().where("count > 1").limit(1)
    if not repeated.isEmpty():
        raise ValueError(REPEATED)


# --- Stored table ------------------------------------------------------------


def event_year(moment: Column) -> Column:
    return F.coalesce(F.year(moment).cast("string"), F.lit(NO_YEAR))


def id_part(parts: int) -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(parts)).cast("string")


def _lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """JSON lines below a path; None where there is no such path."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _manifest_path(table: str, version: int | str = "") -> str:
    return f"{table.rstrip('/')}/manifests" + (f"/version={version}" if version else "")


def _newest_path(table: str) -> str:
    return f"{table.rstrip('/')}/newest"


def _marker_path(table: str, batch: str) -> str:
    return f"{table.rstrip('/')}/batches/{hashlib.sha256(batch.encode()).hexdigest()}"


def versions(spark: SparkSession, table: str) -> list[int]:
    """Versions there are, from the names of the manifests' folders. For looking
    back only: a merge or a read of the newest version lists none of them."""
    if _lines(spark, _manifest_path(table), MANIFEST) is None:
        return []
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .load(_manifest_path(table))
    )
    number = F.regexp_extract("path", r"/version=(\d+)/", 1).cast("int")
    return [r.v for r in listed.select(number.alias("v")).distinct().orderBy("v").collect()]


def newest_version(spark: SparkSession, table: str) -> int:
    """Newest version, 0 for a new table.

    A note names it, written after the manifest. Where the note is behind, as
    after a merge that died in between, the manifests that follow are tried.
    """
    note = _lines(spark, _newest_path(table), "version long")
    found = None if note is None else note.first()
    version = found.version if found else 0
    while _lines(spark, _manifest_path(table, version + 1), MANIFEST) is not None:
        version += 1
    return version


def manifest(spark: SparkSession, table: str, version: int | None = None) -> list:
    """Entries of one version (default: the newest); empty for a new table.

    One entry per partition of the table, read from that version's folder alone.
    A version without rows has one entry without a holder.
    """
    version = version or newest_version(spark, table)
    lines = _lines(spark, _manifest_path(table, version), MANIFEST) if version else None
    return [] if lines is None else lines.collect()


def is_merged(spark: SparkSession, table: str, batch: str) -> bool:
    """Whether a batch is in the table already, so that a replay is skipped. Looks
    for the batch's own marker only."""
    return _lines(spark, _marker_path(table, batch), "version long") is not None


def _read_entries(spark: SparkSession, table: str, entries: Sequence) -> DataFrame:
    entries = [e for e in entries if e.holder is not None]
    if not entries:
        return spark.createDataFrame([], schemas.SILVER_STORED).select(
            *schemas.SILVER_COLUMNS, *PLACE[1:]
        )
    data = f"{table.rstrip('/')}/data"
    holders = sorted({e.holder for e in entries})
    wanted = [f"{e.holder}/{e.event_source or NO_SOURCE}/{e.event_year}/{e.id_part}" for e in entries]
    stored = (
        spark.read.schema(schemas.SILVER_STORED).option("basePath", data)
        .parquet(*[f"{data}/version={h}" for h in holders])
    )
    # Only partition columns, so this prunes folders and reads no other file.
    place = F.concat_ws("/", "version", F.coalesce("event_source", F.lit(NO_SOURCE)), *PLACE[1:])
    return stored.where(place.isin(wanted)).select(*schemas.SILVER_COLUMNS, *PLACE[1:])


def read_silver(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The table as of a version; the newest one by default."""
    return _read_entries(spark, table, manifest(spark, table, version)).drop(*PLACE[1:])


def earlier_places(
    spark: SparkSession, table: str, entries: Sequence, keys: DataFrame, parts: Collection[str]
) -> DataFrame:
    """Partitions that hold an earlier version of one of the keys. Only those of
    the given id parts are read, and of these three columns; the ids of a small
    batch are broadcast or Bloom-filtered."""
    possible = [e for e in entries if e.id_part in parts]
    return (
        _read_entries(spark, table, possible).select("event_id", *PLACE)
        .join(keys.select("event_id"), "event_id", "left_semi")
        .select(*PLACE).distinct()
    )


def changes(
    spark: SparkSession, table: str, version: int, columns: Sequence[str] = schemas.SILVER_COLUMNS
) -> DataFrame:
    """What a merge changed, as signed rows: -1 for an event as it was, 1 for it as it is.

    Only the partitions that the merge rewrote are read, in both versions. An event
    whose columns stayed the same has no row.
    """
    before = manifest(spark, table, version - 1) if version > 1 else []
    after = manifest(spark, table, version)
    kept = {(e.holder, *(e[c] for c in PLACE)) for e in after}
    gone = [e for e in before if (e.holder, *(e[c] for c in PLACE)) not in kept]
    new = [e for e in after if e.holder == version]
    shown = F.struct(*columns)
    signed = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")),
        F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")),
    )

    def found(group: Collection[str]) -> DataFrame:
        old, now = [_read_entries(spark, table, [e for e in side if e.id_part in group]) for side in (gone, new)]
        old, now = old.select("event_id", shown.alias("old")), now.select("event_id", shown.alias("new"))
        both = old.join(now, "event_id", "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))
        return (
            both.select(F.explode(signed).alias("s")).where("s.row is not null")
            .select("s.sign", "s.row.*")
        )

    rows = sum(_read_entries(spark, table, side).count() for side in (gone, new))
    groups = session.groups(rows, {e.id_part for e in (*gone, *new) if e.holder is not None})
    if len(groups) == 1:
        return found(groups[0])
    return session.stored_in_turn([found(group) for group in groups], "changes")


def _write_version(parts: Iterable[DataFrame], table: str, version: int) -> str:
    path = f"{table.rstrip('/')}/data/version={version}"
    mode = "overwrite"
    for rows in parts:
        # Rebalancing by the partition columns avoids a file per task and partition;
        # AQE splits the partitions that are large. Ids in order pack better.
        dealt = rows.hint("rebalance", *[F.col(c) for c in PLACE]).sortWithinPartitions(*PLACE, "event_id")
        with session.freed(rows.sparkSession):
            dealt.write.mode(mode).option("compression", "zstd").partitionBy(*PLACE).parquet(path)
        mode = "append"
    return path


def _note(spark: SparkSession, version: int, path: str) -> None:
    spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("overwrite").json(path)


def merge_into_silver(
    spark: SparkSession,
    incoming: DataFrame,
    table: str,
    batch: str | None = None,
    keep_enrichment: bool = False,
    id_parts: int = ID_PARTS,
) -> int | None:
    """Upsert typed, deduplicated rows; returns the version written, None where
    the batch is in the table already. A repeated event_id is an error. A batch
    that died before its marker was written is merged again, to the same rows."""
    if batch is not None and is_merged(spark, table, batch):
        return None
    before = newest_version(spark, table)
    entries = manifest(spark, table, before) if before else []
    version = before + 1
    parts = entries[0].parts if entries else id_parts
    incoming = incoming.withColumns(
        {"event_year": event_year(F.col("event_date")), "id_part": id_part(parts)}
    )
    with session.passing(spark):
        # The batch is worked out once; the keys, and each group of parts, are read from here.
        incoming = session.stored_in_turn([incoming], "incoming", by=["id_part"])
        with session.freed(spark):
            assert_unique(incoming.select("event_id"))
            places = incoming.groupBy(*PLACE).count().collect()
            found = {tuple(r)[:-1] for r in places}
            if entries:
                earlier = earlier_places(spark, table, entries, incoming, {place[2] for place in found})
                found |= {tuple(r) for r in earlier.collect()}
        hit = [e for e in entries if (e.event_source, e.event_year, e.id_part) in found]
        held = _read_entries(spark, table, hit).count() if hit else 0

        def merged(group: Collection[str]) -> DataFrame:
            mine = [e for e in hit if e.id_part in group]
            rows = incoming.where(F.col("id_part").isin(sorted(group)))
            if not mine:
                return rows
            both = merge_rows(_read_entries(spark, table, mine), rows, keep_enrichment)
            return both.withColumns({"event_year": event_year(F.col("event_date")), "id_part": id_part(parts)})

        groups = session.groups(held + sum(r["count"] for r in places), {place[2] for place in found})
        path = _write_version(map(merged, groups), table, version)
    # Old versions of a moved event are gone from `hit`, so a partition may have
    # become empty: list what was really written.
    written = (
        spark.read.schema(schemas.SILVER_STORED).parquet(path)
        .groupBy(*PLACE).count().collect()
    )
    kept = [(*(e[c] for c in PLACE), e.holder) for e in entries if e not in hit and e.holder is not None]
    listed = kept + [(*(r[c] for c in PLACE), version) for r in written]
    listed = [(*e, parts, batch) for e in listed] or [(None, None, None, None, parts, batch)]
    spark.createDataFrame(listed, MANIFEST).coalesce(1).write.json(_manifest_path(table, version))
    _note(spark, version, _newest_path(table))
    if batch is not None:
        _note(spark, version, _marker_path(table, batch))
    return version
