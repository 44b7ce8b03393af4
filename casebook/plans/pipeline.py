"""The ordered run: landing -> bronze/quarantine -> silver -> gold -> pages."""

from __future__ import annotations

import uuid
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import session
from casebook.functions import dates
from casebook.operators import (
    dimensions,
    documents,
    ingest,
    merge,
    quarantine,
    refresh,
    rollup,
    sitemap,
    sites,
)
from casebook.sources import landing, ledger, named_files, tables


@dataclass(frozen=True)
class Paths:
    """Where a lake keeps its parts, all below one root."""

    root: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def landing(self) -> str:
        return self._at("landing")

    @property
    def lake(self) -> str:
        return self._at("lake")

    @property
    def silver(self) -> str:
        return self._at("silver")

    @property
    def gold(self) -> str:
        return self._at("gold")

    @property
    def summary(self) -> str:
        """Counts, newest events and gold by key, for refreshes."""
        return self._at("summary")

    @property
    def documents(self) -> str:
        return self._at("documents")

    @property
    def site(self) -> str:
        """What the web server serves: the sitemap index and, below it, its files."""
        return self._at("site")

    @property
    def cities(self) -> str:
        return self._at("dimensions/cities")

    @property
    def companies(self) -> str:
        return self._at("dimensions/companies")

    @property
    def states(self) -> str:
        return self._at("dimensions/states")

    @property
    def curated(self) -> str:
        return self._at("dimensions/curated")

    @property
    def ledger(self) -> str:
        return self._at("ledger")

    @property
    def aliases(self) -> str:
        return self._at("dimensions/aliases")

    @property
    def checkpoints(self) -> str:
        return self._at("checkpoints")


def lookups(spark: SparkSession, paths: Paths) -> tuple[DataFrame, DataFrame]:
    """(company lookup, city keys) from the stored dimensions. They are Parquet
    tables, so Catalyst knows their size when it picks the join."""
    index = dimensions.read_aliases(spark, paths.aliases)
    cities = spark.read.parquet(paths.cities)
    return dimensions.company_lookup(index), dimensions.city_lookup(cities, index)


def build_dimensions(
    spark: SparkSession,
    paths: Paths,
    gazetteer: DataFrame | None = None,
    listings: DataFrame | None = None,
    curated: list[tuple[str, str, list[str]]] = (),
) -> None:
    """Rebuild the dimensions that have an input, and the alias index over all
    stored ones, so that an earlier load's aliases stay. Curated companies are
    added to those stored; one given again replaces its earlier row."""
    dimensions.write_dimension(dimensions.states(spark), paths.states)
    if gazetteer is not None:
        dimensions.load_cities(gazetteer, paths.cities)
    if listings is not None:
        dimensions.write_dimension(dimensions.listed_companies(listings), paths.companies)
    if curated:
        given = dimensions.curated_companies(spark, curated)
        earlier = dimensions.stored(spark, paths.curated)
        if earlier is not None:
            kept = earlier.join(given.select("slug"), "slug", "left_anti").select(given.columns).collect()
            # Hand-kept, hence few; collected, as their own folder is written anew.
            given = given.unionByName(spark.createDataFrame(kept, given.schema))
        dimensions.write_dimension(given, paths.curated)
    producers = (
        (paths.states, dimensions.state_aliases), (paths.cities, dimensions.city_aliases),
        (paths.companies, dimensions.listed_company_aliases),
        (paths.curated, dimensions.curated_aliases),
    )
    found = [(dimensions.stored(spark, path), aliases) for path, aliases in producers]
    index = dimensions.alias_index(*[aliases(dim) for dim, aliases in found if dim is not None])
    dimensions.write_dimension(index, paths.aliases)


def run_ingest(
    spark: SparkSession,
    paths: Paths,
    files: DataFrame | None = None,
    files_per_batch: int = 20_000,
    batch: str | None = None,
    **options,
) -> int:
    """Append every admitted file's rows to their zone; returns the file count.

    Without a list of files: first the batches that an earlier call planned and
    did not finish, then all files below the landing folder that no batch has
    yet. With one: these files, under the name given, so that the same call made
    again replaces what it wrote before.
    File names are plan-time metadata, so a large landing is worked off in
    batches: no task or driver ever holds more names than a batch has.
    """
    count = 0
    if files is None:
        listed = landing.list_landing(spark, paths.landing)
        for name in ledger.pending(spark, paths.ledger):
            mine = ledger.planned(spark, paths.ledger).where(F.col("batch") == name)
            count += take_in(spark, paths, name, listed.join(mine.select("path"), "path", "left_semi"), **options)
        known = ledger.planned(spark, paths.ledger).select("path")
        files = listed.join(known, "path", "left_anti")
    batch = batch or f"ingest-{uuid.uuid4().hex}"
    files = files.persist()
    try:
        new = files.count()
        batches = -(-new // files_per_batch)
        for number in range(batches):
            part = files.where(F.pmod(F.xxhash64("path"), F.lit(batches)) == number)
            take_in(spark, paths, f"{batch}-{number}-of-{batches}", part, **options)
    finally:
        files.unpersist()
    return count + new


def take_in(
    spark: SparkSession, paths: Paths, batch: str, files: DataFrame,
    ingested_at: Column | None = None, **options,
) -> int:
    """One batch of files -> zones, exactly once: planned, written under its name,
    then entered as done. Returns its number of files, 0 if it was done already."""
    if ledger.is_done(spark, paths.ledger, batch):
        return 0
    entry = ledger.plan(spark, paths.ledger, batch, files, ingested_at)
    found = entry.agg(F.count("*").alias("files"), F.max("ingested_at").alias("moment")).first()
    write_batch(spark, paths, batch, files, F.lit(found.moment), **options)
    ledger.finish(spark, paths.ledger, batch)
    return found.files


def write_batch(
    spark: SparkSession, paths: Paths, batch: str, files: DataFrame, ingested_at: Column, **options
) -> None:
    company_lookup, city_keys = lookups(spark, paths)
    routed = ingest.ingest_files(
        spark, files, paths.landing, company_lookup, city_keys, ingested_at=ingested_at, **options
    )
    if routed is not None:
        tables.write_zones(routed, paths.lake, batch=batch)


def run_backfill(spark: SparkSession, paths: Paths, **options) -> int:
    """Take every historical CSV file in again; silver stays one row per event."""
    files = landing.backfill_listing(spark, paths.landing)
    return run_ingest(spark, paths, files, **options)


def run_recovery(spark: SparkSession, paths: Paths, fixes: DataFrame) -> DataFrame:
    """Append corrected quarantine rows that now pass to bronze; returns the
    rows that still fail. The quarantine itself keeps its history."""
    _, city_keys = lookups(spark, paths)
    held = tables.read_quarantine(spark, paths.lake)
    checked = quarantine.recover(held, fixes, city_keys)
    tables.write_zones(quarantine.recovered(checked), paths.lake)
    return checked.where("quarantine_reason is not null")


def run_merge(
    spark: SparkSession,
    paths: Paths,
    bronze: DataFrame | None = None,
    batch: str | None = None,
    us_dates: bool = False,
    keep_enrichment: bool = False,
) -> int | None:
    """Upsert bronze (all of it, or just the given new rows) into silver."""
    if bronze is None:
        bronze = tables.read_bronze(spark, paths.lake)
    return merge.merge_into_silver(
        spark, merge.bronze_to_silver(bronze, us_dates), paths.silver, batch, keep_enrichment
    )


def run_gold(spark: SparkSession, paths: Paths, as_of: Column) -> None:
    with session.passing(spark):
        gold, _ = rollup.all_gold(merge.read_silver(spark, paths.silver), as_of)
        for level, frame in gold.items():
            tables.write_gold(frame, paths.gold, level)


def run_refresh(
    spark: SparkSession, paths: Paths, as_of: Column, facts: documents.Facts = documents.Facts()
) -> list[dict[str, DataFrame]]:
    """Bring the summary, and the documents where there are any, up to the newest silver.

    Each merge since is applied by itself: the keys of its changed events and no others.
    Returns, by merge, the keys built anew of each level. A summary that stands for no
    version, as after a refresh that died, is built again, and all documents with it.
    """
    newest = merge.newest_version(spark, paths.silver)
    before = refresh.stands_for(spark, paths.summary)
    if before is None:
        refresh.build(spark, paths.summary, merge.read_silver(spark, paths.silver), as_of, newest)
        serve_summary(spark, paths, as_of, facts)
        return []
    columns = [c for c in merge.schemas.SILVER_COLUMNS if c in refresh.NEEDED]
    done = []
    for version in range(before + 1, newest + 1):
        with session.passing(spark):
            changed = merge.changes(spark, paths.silver, version, columns)
            silver = merge.read_silver(spark, paths.silver, version)
            touched = refresh.refresh(spark, paths.summary, changed, silver, as_of, version)
        if touched:
            serve_changed(spark, paths, as_of, touched, facts)
        done.append(touched)
    return done


def _summary_documents(
    spark: SparkSession, paths: Paths, as_of: Column, gold: dict[str, DataFrame], silver: DataFrame,
    facts: documents.Facts,
) -> DataFrame:
    """Documents of the given gold rows; silver has at least their companies' events."""
    updated_at = dates.iso_millis(as_of.cast("timestamp"))
    company_sites = session.stored(sites.company_sites(silver), "company-sites")
    extra = {
        "company": {"sites": sites.site_lists(company_sites)},
        "site": {"siblings": sites.sibling_lists(sites.siblings(company_sites))},
    }
    docs = {
        level: facts.told(documents.BUILDERS[level](rows, updated_at, **extra.get(level, {})), level)
        for level, rows in gold.items()
    }
    pages = documents.site_page_documents(sites.site_pages(company_sites), updated_at)
    return documents.serving_table(docs | {"company_sites": pages})


def serve_summary(
    spark: SparkSession, paths: Paths, as_of: Column, facts: documents.Facts = documents.Facts()
) -> None:
    gold = {level: refresh.read_gold(spark, paths.summary, level) for level in tables.LEVELS}
    silver = merge.read_silver(spark, paths.silver)
    with session.passing(spark):
        tables.write_documents(_summary_documents(spark, paths, as_of, gold, silver, facts), paths.documents)


def serve_changed(
    spark: SparkSession, paths: Paths, as_of: Column, touched: dict[str, DataFrame],
    facts: documents.Facts = documents.Facts(),
) -> list[tuple[str, str]]:
    """Documents of the keys a refresh built anew; those of keys left without events go.

    A company's site list, and what its sites say of one another, follow from all its
    events, so a touched company's sites are all served again.
    """
    companies = touched["company"]
    gold = {}
    for level, keys in touched.items():
        rows = refresh.read_gold(spark, paths.summary, level)
        on = companies if level == "site" else keys
        gold[level] = rows.join(on, on.columns, "left_semi") if on.columns else rows
    silver = merge.read_silver(spark, paths.silver).join(companies, "company_slug", "left_semi")
    with session.passing(spark):
        docs = session.stored(_summary_documents(spark, paths, as_of, gold, silver, facts), "served-documents")
        # Every document of a touched key goes before its new ones come, pages included.
        gone = documents.keys_of({level: keys for level, keys in touched.items() if keys.columns})
        return tables.upsert_stored_documents(spark, paths.documents, docs, gone)


def run_serving(
    spark: SparkSession, paths: Paths, as_of: Column, levels: Collection[str] | None = None,
    facts: documents.Facts = documents.Facts(),
) -> None:
    """Gold files -> documents with site lists, siblings and what dimensions tell: all
    of them, or a refresh of the given levels, whose gold alone is read."""
    updated_at = dates.iso_millis(as_of.cast("timestamp"))
    wanted = [level for level in tables.LEVELS if levels is None or level in levels]
    if not wanted:
        return
    with session.passing(spark):
        extra: dict[str, dict[str, DataFrame]] = {}
        parts: dict[str, DataFrame] = {}
        if {"company", "site"} & set(wanted):
            found = sites.company_sites(merge.read_silver(spark, paths.silver))
            company_sites = session.stored(found, "company-sites")
            extra["company"] = {"sites": sites.site_lists(company_sites)}
            extra["site"] = {"siblings": sites.sibling_lists(sites.siblings(company_sites))}
            if "company" in wanted:
                pages = sites.site_pages(company_sites)
                parts["company_sites"] = documents.site_page_documents(pages, updated_at)
        docs = {
            level: facts.told(
                documents.BUILDERS[level](
                    tables.read_gold(spark, paths.gold, level), updated_at, **extra.get(level, {})
                ),
                level,
            )
            for level in wanted
        }
        table = documents.serving_table(docs | parts)
        tables.write_documents(table, paths.documents, None if levels is None else wanted)


def run_sitemaps(spark: SparkSession, paths: Paths, base_url: str, as_of: Column) -> None:
    keys = tables.document_keys(tables.read_documents(spark, paths.documents))
    pages = sitemap.urls(keys, base_url)
    files = sitemap.sitemap_files(sitemap.chunked(pages), as_of)
    index = sitemap.sitemap_index(sitemap.file_names(pages), base_url, as_of)
    named_files.write(sitemap.published(files, index), paths.site)


def run_pipeline(
    spark: SparkSession, paths: Paths, as_of: Column | None = None, base_url: str | None = None
) -> None:
    """Merge, roll up, publish. The first failing step stops the run."""
    day = F.current_timestamp() if as_of is None else as_of
    run_merge(spark, paths)
    run_gold(spark, paths, day)
    run_serving(spark, paths, day)
    if base_url is not None:
        run_sitemaps(spark, paths, base_url, day)
