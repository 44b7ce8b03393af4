"""Raw rows of one layout -> conformed events, routed to their zone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import schemas, vocab
from casebook.functions import companies, dates, events, places
from casebook.functions import text as tx
from casebook.operators import resolve
from casebook.sources import landing

_MARK = "_f_"
SURPLUS = "_record"


def canonical_fields(
    header: tuple[str, ...],
    cells: list[Column],
    header_map: dict[str, tuple[str, ...]] | None,
) -> dict[str, Column]:
    """Canonical key -> cell. The first alias present in the file wins, even
    where its cell is empty; headers nobody maps are dropped. Without a map
    every header is lower-cased and a later duplicate wins."""
    by_header = dict(zip(header, cells))
    if header_map is None:
        return {name.lower(): cell for name, cell in by_header.items()}
    picked = {}
    for key, aliases in header_map.items():
        present = [a for a in aliases if a in by_header]
        if present:
            picked[key] = by_header[present[0]]
    return picked


def header_map_for(
    source: str, dataset: str, maps: dict | None = None
) -> dict[str, tuple[str, ...]] | None:
    """Exact, case-sensitive match; None means lower-cased headers."""
    return (vocab.HEADER_MAPS if maps is None else maps).get((source, dataset))


def layout_events(
    rows: DataFrame,
    layout: landing.Layout,
    ingested_at: Column | None = None,
    fix_saint_dot: bool = False,
    maps: dict | None = None,
) -> DataFrame:
    """One layout's rows with every column that needs no lookup.

    ``state`` and ``city`` may still be empty texts, which the check tells from
    missing ones; ``lookup_name`` is the company name to resolve.
    """
    header = layout.header
    cells = [F.col(f"c{i}") for i in range(len(header))]
    fields = canonical_fields(header, cells, header_map_for(layout.source, layout.dataset, maps))
    stamp = dates.iso_millis(F.current_timestamp() if ingested_at is None else ingested_at)

    # The raw JSON and the cleaned places become real columns first, so that the
    # expressions below refer to them instead of repeating them.
    computed = dict(fields)
    if "state" in fields:
        computed["state"] = places.state_code(fields["state"])
    if "city" in fields:
        computed["city"] = places.clean_city(fields["city"], fix_saint_dot)
    # Cells beyond the header have no name; their record stays in the raw JSON, so
    # that rows which differ only there stay apart.
    surplus = [(SURPLUS, F.col("surplus"))] if "surplus" in rows.columns else []
    base = rows.select(
        "key",
        events.raw_json([*dict(zip(header, cells)).items(), *surplus]).alias("_raw"),
        *[v.alias(_MARK + k) for k, v in computed.items()],
    )
    field = {k: F.col(_MARK + k) for k in fields}

    def own(key: str) -> Column:
        return field.get(key, F.lit(None).cast("string"))

    details = {k: v for k, v in field.items() if k != "bedrock_verified"}
    details["bedrock_verified"] = F.lit(False)
    source = layout.source.upper() or vocab.UNKNOWN_SOURCE
    name = own("company_name")
    given = {
        "event_id": events.event_id(F.col("_raw")),
        "event_source": F.lit(source),
        "source_url": F.col("key"),
        "ingested_at": stamp,
        "city_slug": F.coalesce(places.city_slug(own("state"), own("city")), own("city_slug")),
        "site_id": F.coalesce(companies.site_number(name), own("site_id")),
        "event_title": events.event_title(field),
        "event_description": own("description"),
        "event_details": events.details_json(details),
        "raw_data": F.col("_raw"),
        "bedrock_verified": F.lit(False),
    }
    columns = [c for c in schemas.BRONZE_COLUMNS if c != "quarantine_reason"]
    return base.select(
        *[given.get(c, own(c)).alias(c) for c in columns],
        companies.without_site_number(name).alias("lookup_name"),
        F.lit(source).alias("partition_source"),
        F.substring(stamp, 1, 4).alias("partition_year"),
    )


def settle(rows: DataFrame, company_lookup: DataFrame, city_keys: DataFrame) -> DataFrame:
    """Resolve companies, check the place, and route each row to its zone."""
    rows = rows.withColumnRenamed("company_slug", "given_slug")
    resolved = resolve.resolve_companies(rows, company_lookup, "lookup_name")
    checked = resolve.validate(resolved, city_keys)
    # A file's own slug only counts where there is no company name to resolve.
    slug = F.when(tx.empty_to_null(F.col("company_name")).isNull(), F.col("given_slug"))
    values = {"company_slug": F.coalesce("company_slug", slug)}
    kept = ("bedrock_verified", "quarantine_reason")
    reason = F.col("quarantine_reason")
    return checked.select(
        *[
            F.col(c) if c in kept else tx.empty_to_null(values.get(c, F.col(c))).alias(c)
            for c in schemas.BRONZE_COLUMNS
        ],
        F.when(reason.isNull(), vocab.BRONZE_ZONE).otherwise(vocab.QUARANTINE_ZONE).alias("zone"),
        "partition_source", "partition_year",
    )


def ingest_files(
    spark: SparkSession,
    files: DataFrame,
    root: str,
    company_lookup: DataFrame,
    city_keys: DataFrame,
    multiline: bool | None = None,
    **options,
) -> DataFrame | None:
    """Events of all listed files: one scan per header layout, united before the
    lookups, so each lookup is joined once however many layouts there are."""
    frames = [
        layout_events(landing.read_rows(spark, layout, root, multiline), layout, **options)
        for layout in landing.layouts(files)
    ]
    if not frames:
        return None
    return settle(reduce(DataFrame.unionByName, frames), company_lookup, city_keys)
