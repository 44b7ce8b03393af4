"""Round trips through stored files: landing, zones, silver, gold, dimensions, catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import schemas, session, vocab
from casebook.functions import dates, events
from casebook.operators import dimensions, merge, quarantine, refresh, rollup
from casebook.plans import pipeline, queries_entities, views
from casebook.plans.queries_rollup import as_of
from casebook.plans.queries_serving import event_rows
from casebook.plans.views import query, table
from casebook.sources import landing, ledger, reference_files, tables
from casebook.streaming import intake

STAMP = "2025-06-01 00:00:00"


def _scratch(spark: SparkSession, name: str) -> str:
    return session.scratch_path(spark, name)


# --- Silver in batches ---------------------------------------------------------

_LATEST_EVENTS_SQL = """latest AS (SELECT * FROM (SELECT upper(event_type) AS event_source, strftime(ts, '%Y-%m-%d') AS event_date,
    user_id || '-' || strftime(ts, '%Y-%m-%d') AS event_id, event_type || ' ' || event_id AS event_title,
    row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d') ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S.%g') DESC,
      upper(event_type)) AS rn FROM events) WHERE rn = 1)"""


def _silver_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_source", F.date_format("event_date", "yyyy-MM-dd").alias("event_date")).agg(
        F.count("*").alias("events"), F.count_distinct("event_id").alias("ids"),
        F.max("event_title").alias("last_title"),
    )


@query(
    "upsert_out_of_order",
    f"WITH {_LATEST_EVENTS_SQL} SELECT event_source, event_date, count(*) AS events, "
    "count(DISTINCT event_id) AS ids, max(event_title) AS last_title FROM latest GROUP BY 1, 2",
)
def upsert_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in four batches, the newest ingest first: as if in one."""
    target = _scratch(spark, "out-of-order")
    rows = table(spark, sf_dir, "events")
    moment = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = rows.agg(F.percentile_approx(moment, [0.25, 0.5, 0.75]).alias("c")).first().c
    edges = [None, *sorted(cuts or []), None]
    for number in reversed(range(len(edges) - 1)):
        low, high = edges[number], edges[number + 1]
        batch = rows if low is None else rows.where(moment > low)
        batch = batch if high is None else batch.where(moment <= high)
        silver = merge.bronze_to_silver(event_rows(batch))
        merge.merge_into_silver(spark, silver, target, f"late-{number}")
    return _silver_counts(merge.read_silver(spark, target))


# --- Zones ---------------------------------------------------------------------


def _zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as routed rows: every fifth user's are held, views come without a source."""
    held = F.col("event_id").rlike("[05]-")
    rows = event_rows(table(spark, sf_dir, "events"))
    reason = F.when(held, F.concat(F.lit("Unknown City: "), "event_source"))
    return rows.withColumns({
        "quarantine_reason": reason,
        "zone": F.when(held, vocab.QUARANTINE_ZONE).otherwise(vocab.BRONZE_ZONE),
    })


_ZONED_SQL = """zoned AS (SELECT upper(event_type) AS partition_source, strftime(ts, '%Y') AS partition_year,
    user_id || '-' || strftime(ts, '%Y-%m-%d') AS event_id,
    CASE WHEN user_id % 5 = 0 THEN 'quarantine' ELSE 'reef' END AS zone FROM events)"""


@query(
    "zones_round_trip",
    f"WITH {_ZONED_SQL} SELECT zone, partition_source, partition_year, count(*) AS events, "
    "count(DISTINCT event_id) AS ids, count(*) FILTER (WHERE zone = 'quarantine') AS reasons FROM zoned GROUP BY 1, 2, 3 "
    "UNION ALL SELECT 'peek', NULL, NULL, least(3, count(*)), NULL, NULL FROM zoned WHERE zone = 'reef'",
)
def zones_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed rows written in one pass and both zones read again."""
    lake = _scratch(spark, "zones")
    tables.write_zones(_zoned(spark, sf_dir), lake)
    good = tables.read_bronze(spark, lake).withColumn("zone", F.lit("reef"))
    held = tables.read_quarantine(spark, lake).where("file_key is not null").withColumn("zone", F.lit("quarantine"))
    both = good.unionByName(held.drop("file_key"))
    none = F.lit(None)
    peeked = tables.peek_bronze(spark, lake).agg(F.count("*").alias("events")).select(
        F.lit("peek").alias("zone"), none.cast("string").alias("partition_source"),
        none.cast("string").alias("partition_year"), "events",
        none.cast("bigint").alias("ids"), none.cast("bigint").alias("reasons"),
    )
    counts = both.groupBy("zone", "partition_source", "partition_year").agg(
        F.count("*").alias("events"), F.count_distinct("event_id").alias("ids"),
        F.count("quarantine_reason").alias("reasons"),
    )
    return counts.unionByName(peeked)


@query(
    "quarantine_file_counts",
    f"WITH {_ZONED_SQL}, files AS (SELECT DISTINCT partition_source, partition_year FROM zoned WHERE zone = 'quarantine') "
    "SELECT count(*) AS total_files, least(2, count(*)) AS scanned_files FROM files",
)
def quarantine_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file a source and year; statistics over the newest two."""
    lake = _scratch(spark, "quarantine-files")
    tables.write_zones(_zoned(spark, sf_dir).repartition("partition_source", "partition_year", "zone"), lake)
    return quarantine.file_counts(
        tables.read_quarantine(spark, lake), tables.read_quarantine(spark, lake, newest_files=2)
    )


@query(
    "catalog_tables",
    f"WITH {_ZONED_SQL} SELECT partition_source, partition_year, count(*) AS events FROM zoned "
    "WHERE zone = 'reef' GROUP BY 1, 2",
)
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze as an external table; forgetting the table leaves its files."""
    lake = _scratch(spark, "catalog")
    tables.write_zones(_zoned(spark, sf_dir), lake)
    name = f"reef_{lake.rsplit('-', 1)[1]}"
    tables.create_bronze_table(spark, lake, name)
    tables.repair_partitions(spark, name)
    seen = spark.table(name).count()
    tables.drop_table(spark, name)
    tables.create_silver_table(spark, f"{lake}/deep", name, "events")
    assert spark.table(f"{name}.events").columns[-2:] == ["event_source", "event_year"]
    spark.sql(f"DROP DATABASE {name} CASCADE")
    rows = tables.read_bronze(spark, lake)
    assert rows.count() == seen
    return rows.groupBy("partition_source", "partition_year").agg(F.count("*").alias("events"))


@query(
    "recovery_append",
    f"WITH {_ZONED_SQL} SELECT zone, count(*) AS events, count(DISTINCT event_id) AS ids FROM ("
    "SELECT zone, event_id FROM zoned UNION ALL SELECT 'reef', event_id FROM zoned "
    "WHERE zone = 'quarantine' AND event_id IN (SELECT event_id FROM zoned WHERE zone = 'quarantine' "
    "AND partition_source = 'CLICK')) GROUP BY 1",
)
def recovery_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held events with a click get a known city, twice over, and reach bronze once."""
    paths = pipeline.Paths(_scratch(spark, "recovery"))
    tables.write_zones(_zoned(spark, sf_dir), paths.lake)
    pipeline.build_dimensions(spark, paths, gazetteer=queries_entities.gazetteer(spark, sf_dir))
    known = spark.read.parquet(paths.cities).orderBy("city_slug").select("state", "name").first()
    clicks = tables.read_quarantine(spark, paths.lake).where("event_source = 'CLICK'")
    fixes = clicks.select("event_id", F.lit(known["state"]).alias("state"), F.lit(known["name"]).alias("city"))
    pipeline.run_recovery(spark, paths, fixes.unionByName(fixes))
    good = tables.read_bronze(spark, paths.lake).select(F.lit("reef").alias("zone"), "event_id")
    held = tables.read_quarantine(spark, paths.lake).select(F.lit("quarantine").alias("zone"), "event_id")
    return good.unionByName(held).groupBy("zone").agg(
        F.count("*").alias("events"), F.count_distinct("event_id").alias("ids")
    )


# --- Gold and dimensions ---------------------------------------------------------


_GOLD_DIGEST_SQL = views.with_base(
    "SELECT 'city' AS level, city_slug AS key, count(*) AS total_events, count(DISTINCT company_slug) AS listed, "
    "count(DISTINCT event_source) AS sources FROM silver WHERE city_slug IS NOT NULL GROUP BY 2 UNION ALL "
    "SELECT 'state', state, count(*), count(DISTINCT city_slug), count(DISTINCT event_source) "
    "FROM silver WHERE state IS NOT NULL GROUP BY 2 UNION ALL "
    "SELECT 'nation', 'usa', count(*), count(DISTINCT state), count(DISTINCT event_source) FROM silver UNION ALL "
    "SELECT 'company', company_slug, count(*), NULL, count(DISTINCT event_source) FROM silver "
    "WHERE company_slug IS NOT NULL GROUP BY 2 UNION ALL "
    "SELECT 'site', company_slug || ' ' || site_id, count(*), NULL, NULL FROM silver "
    "WHERE company_slug IS NOT NULL AND site_id IS NOT NULL GROUP BY 2"
)


@query("gold_round_trip", _GOLD_DIGEST_SQL)
def gold_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All levels written as JSON, city files by state, over older files, and read again."""
    root = _scratch(spark, "gold")
    silver = session.stored(views.latest(spark, sf_dir).select(*refresh.NEEDED), "latest")
    gold, _ = rollup.all_gold(silver, as_of())
    tables.write_gold(gold["nation"].limit(0), root, "nation")
    for level, frame in gold.items():
        tables.write_gold(frame, root, level)
    return _gold_digest({level: tables.read_gold(spark, root, level) for level in gold})


@query(
    "gold_bad_lines",
    """SELECT level, count(*) FILTER (n <> 2) AS lines, count(*) FILTER (n < 2) AS skipped,
      count(*) FILTER (n > 2) AS read, coalesce(sum(total) FILTER (n > 2), 0)::BIGINT AS total_events
      FROM (SELECT level, o_orderkey % 7 AS n, o_custkey AS total FROM orders, (VALUES ('state'), ('city')) t(level))
      GROUP BY 1""",
)
def gold_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold files with lines cut short, with words for numbers and without anything:
    what is read, and what the report says was left out."""
    root, n = _scratch(spark, "gold"), F.col("o_orderkey") % 7
    total = F.col("o_custkey").cast("string")
    line = F.concat(F.lit('{"city":"A","total_events":'), F.when(n == 1, '"many"').otherwise(total), F.lit("}"))
    text = F.when(n == 0, F.substring_index(line, ":", 2)).when(n == 2, " ").otherwise(line)
    lines = table(spark, sf_dir, "orders").select(text.alias("value"), F.lit("TN").alias("state"))
    lines.drop("state").write.text(tables.gold_path(root, "state"))
    lines.write.partitionBy("state").text(tables.gold_path(root, "city"))

    def report(level: str) -> DataFrame:
        counts = tables.gold_line_counts(spark, root, level).agg(
            F.sum("lines").alias("lines"), F.sum("skipped").alias("skipped")
        )
        kept = tables.read_gold(spark, root, level).agg(
            F.count("*").alias("read"), F.coalesce(F.sum("total_events"), F.lit(0)).alias("total_events")
        )
        # Two single rows side by side, without a join.
        both = counts.unionByName(kept, allowMissingColumns=True)
        return both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns]).withColumn("level", F.lit(level))

    return report("state").unionByName(report("city"))


def _refreshed(spark: SparkSession, sf_dir: str, name: str) -> pipeline.Paths:
    """A lake whose silver first had some events elsewhere, with a summary and documents,
    then a batch that puts these events right, and a refresh."""
    paths = pipeline.Paths(_scratch(spark, name))
    hit = F.pmod(F.xxhash64("event_id"), F.lit(50)) == 0
    early = F.col("ingested_at") - F.expr("INTERVAL 1 DAY")
    with session.passing(spark):
        silver = session.stored(views.latest(spark, sf_dir).select(*schemas.SILVER_COLUMNS), "latest")
        late = session.stored(silver.where(hit), "late", lasting=True)
        first = silver.withColumns({
            "ingested_at": F.when(hit, F.coalesce(early, F.lit("2000-01-01").cast("timestamp"))).otherwise(F.col("ingested_at")),
            "city_slug": F.when(hit, F.lit("XX-elsewhere")).otherwise(F.col("city_slug")),
            "state": F.when(hit, F.lit("XX")).otherwise(F.col("state")),
            "company_slug": F.when(hit, F.lit("someone-else")).otherwise(F.col("company_slug")),
        })
        merge.merge_into_silver(spark, first, paths.silver)
    pipeline.run_refresh(spark, paths, as_of())
    late = late.withColumn("ingested_at", F.current_timestamp())
    merge.merge_into_silver(spark, late, paths.silver)
    pipeline.run_refresh(spark, paths, as_of())
    return paths


@query("entity_refresh", _GOLD_DIGEST_SQL)
def entity_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold by key after a refresh of what a batch changed: as if rolled up anew."""
    paths = _refreshed(spark, sf_dir, "refresh")
    return _gold_digest({level: refresh.read_gold(spark, paths.summary, level) for level in tables.LEVELS})


@query(
    "documents_stored_upsert",
    views.with_base(
        "SELECT pk, level, count(*) AS total_events, count(DISTINCT part) AS places FROM ("
        "SELECT 'STATE#' || state AS pk, 'state' AS level, city_slug AS part FROM silver WHERE state IS NOT NULL UNION ALL "
        "SELECT 'CITY#' || city_slug, 'city', NULL FROM silver WHERE city_slug IS NOT NULL UNION ALL "
        "SELECT 'NATION#USA', 'nation', city_slug FROM silver UNION ALL "
        "SELECT 'COMPANY#' || company_slug, 'company', NULL FROM silver WHERE company_slug IS NOT NULL UNION ALL "
        "SELECT 'SITE#' || company_slug || '_' || site_id, 'site', NULL FROM silver "
        "WHERE company_slug IS NOT NULL AND site_id IS NOT NULL) GROUP BY 1, 2"
    ),
)
def documents_stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents by key after a refresh: changed ones replaced, those of places
    that lost their last event gone, all others as they were."""
    paths = _refreshed(spark, sf_dir, "keyed-documents")
    docs = tables.read_documents(spark, paths.documents).where("SK = 'SUMMARY'")
    number = lambda p: F.coalesce(F.get_json_object("document", p).cast("bigint"), F.lit(0).cast("bigint"))
    return docs.select(
        F.col("PK").alias("pk"), "level", number("$.stats.totalEvents").alias("total_events"),
        number("$.stats.totalCities").alias("places"),
    )


def _gold_digest(gold: dict[str, DataFrame]) -> DataFrame:
    """(level, key, total_events, listed, sources) of every gold row."""
    keys = {
        "city": (F.col("city_slug"), "companies_directory"), "state": (F.col("state"), "cities_directory"),
        "nation": (F.lit("usa"), "states_directory"), "company": (F.col("company_slug"), None),
        "site": (F.concat_ws(" ", "company_slug", "site_id"), None),
    }
    rows = None
    for level, (key, directory) in keys.items():
        frame = gold[level]
        none = F.lit(None).cast("bigint")
        part = frame.select(
            F.lit(level).alias("level"), key.alias("key"), "total_events",
            (none if directory is None else F.size(directory).cast("bigint")).alias("listed"),
            (none if level == "site" else F.size("recentByEventSource").cast("bigint")).alias("sources"),
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query(
    "serving_refresh",
    views.with_base(
        "SELECT level, n AS documents, CASE level WHEN 'city' THEN '2002-06-01T00:00:00.000Z' "
        "ELSE '2001-12-31T00:00:00.000Z' END AS updated_at FROM ("
        "SELECT 'nation' AS level, 1::BIGINT AS n UNION ALL SELECT 'state', count(DISTINCT state) FROM silver UNION ALL "
        "SELECT 'city', count(DISTINCT city_slug) FROM silver UNION ALL "
        "SELECT 'company', (count(DISTINCT company_slug) + (SELECT coalesce(sum((n - 1) // 30), 0) FROM pairs))::BIGINT "
        "FROM silver UNION ALL SELECT 'site', (SELECT sum(n) FROM pairs)::BIGINT)",
        "pairs AS (SELECT company_slug, count(DISTINCT site_id) AS n FROM silver "
        "WHERE company_slug IS NOT NULL AND site_id IS NOT NULL GROUP BY 1)",
    ),
)
def serving_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, then a refresh after city files changed: other levels keep theirs."""
    paths = pipeline.Paths(_scratch(spark, "serving"))
    merge.merge_into_silver(spark, views.latest(spark, sf_dir).select(*schemas.SILVER_COLUMNS), paths.silver)
    pipeline.run_gold(spark, paths, as_of())
    intake.serve(spark, paths, as_of())
    with session.passing(spark):
        changed = session.stored(tables.read_gold(spark, paths.gold, "city"), "changed-cities")
        tables.write_gold(changed, paths.gold, "city")
    intake.serve(spark, paths, F.lit("2002-06-01").cast("timestamp"))
    docs = spark.read.parquet(paths.documents)
    return docs.groupBy("level", F.col("updatedAt").alias("updated_at")).agg(F.count("*").alias("documents"))


@query(
    "dimension_rebuild",
    f"WITH {queries_entities.GAZETTEER_SQL} SELECT DISTINCT alias_key, target FROM ("
    f"{queries_entities.CITY_ALIASES_SQL} UNION ALL SELECT 'house', 'COMPANY#house-co' "
    "UNION ALL SELECT 'the house', 'COMPANY#house-co' UNION ALL SELECT 'second', 'COMPANY#second-co')",
)
def dimension_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities first, then two curated loads: no load erases another's aliases."""
    paths = pipeline.Paths(_scratch(spark, "dimensions"))
    pipeline.build_dimensions(spark, paths, gazetteer=queries_entities.gazetteer(spark, sf_dir))
    pipeline.build_dimensions(spark, paths, curated=[("House", "house-co", ["The House"])])
    pipeline.build_dimensions(spark, paths, curated=[("Second", "second-co", [])])
    assert spark.read.parquet(paths.states).count() > 0
    index = dimensions.read_aliases(spark, paths.aliases)
    return index.where(~F.col("target").startswith("STATE#"))


@query(
    "gazetteer_scan",
    f"WITH {queries_entities.GAZETTEER_SQL} SELECT usps AS state, name || CASE kind WHEN 'Town' THEN ' town' "
    "ELSE ' metropolitan government (balance)' END AS full_name, c_custkey::VARCHAR AS geoid, "
    "c_custkey::VARCHAR || '.5' AS lat FROM lines",
)
def gazetteer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as tab-separated text with a preamble, read as a gazetteer."""
    path = _scratch(spark, "gazetteer")
    names = reference_files.GAZETTEER_COLUMNS
    rows = queries_entities.gazetteer(spark, sf_dir)
    lines = rows.select("line", F.concat_ws("\t", *names).alias("value"))
    _headed(lines, F.col("line"), ["places", "", "\t".join(names)]).write.text(path)
    found = reference_files.read_gazetteer(spark, path)
    return found.select(F.col("USPS").alias("state"), F.col("NAME").alias("full_name"), F.col("GEOID").alias("geoid"), F.col("INTPTLAT").alias("lat"))


@query(
    "listing_scan",
    "SELECT p_brand AS symbol, p_name || ', \"' || p_type || '\" Inc.' AS name, p_partkey AS price, "
    "CASE WHEN p_size % 5 <> 0 THEN p_type ELSE '' END AS sector FROM part",
)
def listing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a quoted CSV with commas and quotes inside, read as listings."""
    path = _scratch(spark, "listings")
    sector = F.when(F.col("p_size") % 5 != 0, F.col("p_type")).otherwise("")
    table(spark, sf_dir, "part").select(
        F.col("p_brand").alias(" Symbol"), F.concat("p_name", F.lit(', "'), "p_type", F.lit('" Inc.')).alias("Name"),
        F.col("p_partkey").cast("string").alias("Last Sale"), sector.alias("Sector"),
    ).write.option("header", True).option("escape", '"').csv(path)
    found = reference_files.read_listings(spark, path)
    return found.select(
        "symbol", "name", F.col("lastsale").cast("bigint").alias("price"), F.coalesce("sector", F.lit("")).alias("sector")
    )


# --- Landing files ---------------------------------------------------------------


def _headed(rows: DataFrame, key: Column, head: list[str]) -> DataFrame:
    """Text lines (value) dealt over as many files as tasks, each led by the head lines."""
    parts = rows.sparkSession.sparkContext.defaultParallelism
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    lines = rows.select(part.alias("part"), F.lit(len(head)).alias("at"), "value")
    heads = rows.sparkSession.range(parts).select(
        F.col("id").cast("int").alias("part"), F.posexplode(F.array(*map(F.lit, head))).alias("at", "value")
    )
    dealt = heads.unionByName(lines).repartitionById(parts, "part")
    return dealt.sortWithinPartitions("part", "at").select("value")


def _write_landing(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Orders as raw files of two layouts: quoted line breaks, and surplus cells."""
    orders = table(spark, sf_dir, "orders")
    orders = orders.repartition(spark.sparkContext.defaultParallelism)
    key = F.col("o_orderkey").cast("string")
    wide = orders.select(
        key.alias("ID"), F.concat(F.lit("Firm "), F.col("o_custkey").cast("string")).alias("Employer"),
        F.lit("Nowhere").alias("City"), F.lit("Ohio").alias("State"),
        F.concat(F.lit('line one\nline "two", '), "o_orderpriority").alias("Final Narrative"),
    )
    wide.write.option("header", True).option("escape", '"').csv(f"{root}/estuary/OSHA/severe-incident")
    extra = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(",MORE "), key)).otherwise("")
    # As text, so that the comma starts a cell of its own; a header leads every file.
    lines = orders.select("o_orderkey", F.concat(key, F.lit(","), "o_orderstatus", extra).alias("value"))
    _headed(lines, F.col("o_orderkey"), ["id,Note"]).write.text(f"{root}/estuary/fda/recalls")


@query(
    "landing_csv_ingest",
    """SELECT o_orderkey::VARCHAR AS id, 'OSHA' AS source, 'Firm ' || o_custkey AS company, NULL AS record,
        'line one' || chr(10) || 'line "two", ' || o_orderpriority AS description, 1::BIGINT AS copies FROM orders
      UNION ALL SELECT o_orderkey::VARCHAR, 'FDA', NULL,
        CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey || ',' || o_orderstatus || ',MORE ' || o_orderkey END, NULL, 1 FROM orders""",
)
def landing_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files through layouts, scan and ingest; no row or cell gets lost."""
    root = _scratch(spark, "landing")
    _write_landing(spark, sf_dir, root)
    paths = pipeline.Paths(_scratch(spark, "landing-lake"))
    pipeline.build_dimensions(spark, paths, gazetteer=queries_entities.gazetteer(spark, sf_dir))
    companies, cities = pipeline.lookups(spark, paths)
    routed = queries_entities.ingest.ingest_files(
        spark, landing.list_landing(spark, root), root, companies, cities, ingested_at=F.lit(STAMP).cast("timestamp")
    )
    tables.write_zones(routed, paths.lake)
    # Nowhere is no known city, so all is held.
    held = tables.read_quarantine(spark, paths.lake)
    raw = F.from_json("raw_data", "ID string, _record string")
    lower = F.from_json("raw_data", "id string")
    return held.groupBy(
        F.coalesce(raw["ID"], lower["id"]).alias("id"), F.col("event_source").alias("source"),
        F.col("company_name").alias("company"), raw["_record"].alias("record"), F.col("event_description").alias("description"),
    ).agg(F.count_distinct("event_id").alias("copies"))


@query(
    "landing_stream",
    """SELECT 'OSHA' AS source, count(DISTINCT o_orderkey) AS events, count(DISTINCT o_orderkey) AS ids FROM orders
      UNION ALL SELECT 'FDA', count(DISTINCT o_orderkey), count(DISTINCT o_orderkey) FROM orders""",
)
def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files as a stream of small batches, then a second run over none."""
    paths = pipeline.Paths(_scratch(spark, "landing-stream"))
    _write_landing(spark, sf_dir, paths.landing)
    pipeline.build_dimensions(spark, paths, gazetteer=queries_entities.gazetteer(spark, sf_dir))
    for _ in range(2):
        intake.intake(spark, paths, max_files=2, ingested_at=F.lit(STAMP).cast("timestamp"))
    held = tables.read_quarantine(spark, paths.lake)
    return held.groupBy(F.col("event_source").alias("source")).agg(
        F.count("*").alias("events"), F.count_distinct("event_id").alias("ids")
    )


@query(
    "replayed_intake",
    """SELECT 'OSHA' AS source, count(*) AS events, count(DISTINCT o_orderkey) AS ids, 1::BIGINT AS moments FROM orders
      UNION ALL SELECT 'FDA', count(*), count(DISTINCT o_orderkey), 1 FROM orders""",
)
def replayed_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that dies between its rows and its ledger entry, then a run that finds it
    unfinished beside new files: every row is there once, with the batch's first moment."""
    paths = pipeline.Paths(_scratch(spark, "replayed"))
    _write_landing(spark, sf_dir, paths.landing)
    pipeline.build_dimensions(spark, paths, gazetteer=queries_entities.gazetteer(spark, sf_dir))
    listed = landing.list_landing(spark, paths.landing)
    early = listed.where("source = 'OSHA'")
    for _ in range(2):
        entry = ledger.plan(spark, paths.ledger, "first", early, F.lit(STAMP).cast("timestamp"))
        pipeline.write_batch(spark, paths, "first", early, F.lit(entry.first().ingested_at))
    for _ in range(2):
        pipeline.run_ingest(spark, paths)
    held = tables.read_quarantine(spark, paths.lake)
    return held.groupBy(F.col("event_source").alias("source")).agg(
        F.count("*").alias("events"), F.count_distinct("event_id").alias("ids"),
        F.count_distinct("ingested_at").alias("moments"),
    )


@query(
    "backfill_scan",
    "SELECT o_orderpriority AS priority, count(*) AS events, count(DISTINCT o_orderkey) AS ids FROM orders GROUP BY 1",
)
def backfill_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical files are found and read; files elsewhere are not."""
    root = _scratch(spark, "backfill")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), "o_orderpriority")
    for folder in (f"{vocab.BACKFILL_ROOT}/fda/recalls", "estuary/fda/recalls"):
        orders.write.option("header", True).csv(f"{root}/{folder}")
    files = landing.backfill_listing(spark, root)
    (layout,) = landing.layouts(files)
    rows = landing.read_rows(spark, layout, root)
    return rows.groupBy(F.col("c1").alias("priority")).agg(F.count("*").alias("events"), F.count_distinct("c0").alias("ids"))


# --- Bad cells -------------------------------------------------------------------


@query(
    "bad_cells",
    "SELECT event_type, sum(CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN event_id % 100 ELSE -1.5 END)::DOUBLE AS total, "
    "count(*) FILTER (WHERE event_id % 4 >= 2) AS numbers, count(*) FILTER (WHERE event_id % 4 = 2) AS dates FROM events GROUP BY 1",
)
def bad_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that are no numbers or dates count as missing and spoil nothing."""
    number = F.col("event_id") % 4
    text = (
        F.when(number == 0, "NaN").when(number == 1, "1e999 Infinity")
        .when(number == 2, (F.col("event_id") % 100).cast("string")).otherwise(" -1.5 ")
    )
    day = F.when(number == 2, "2024-02-29").when(number == 3, "2023-02-30").otherwise("n/a")
    rows = table(spark, sf_dir, "events").select("event_type", text.alias("t"), dates.event_timestamp(day, False).alias("d"))
    return rows.groupBy("event_type").agg(
        F.sum(events.number_sum(F.col("t"))).alias("total"), F.count(events.number(F.col("t"))).alias("numbers"),
        F.count("d").alias("dates"),
    )
