"""Raw files to pages, on a small lake."""

import json

import pytest
from pyspark.sql import functions as F

from casebook.operators import dimensions, merge, quarantine, refresh, sitemap
from casebook.plans import pipeline
from casebook.sources import landing, tables
from casebook.streaming import intake
from tests import lake



def as_of():
    return lake.stamp("2026-01-01 00:00:00")


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    built = lake.build(spark, tmp_path_factory.mktemp("lake"))
    assert pipeline.run_ingest(
        spark, built, ingested_at=lake.stamp("2025-06-01 00:00:00")
    )
    pipeline.run_merge(spark, built)
    pipeline.run_gold(spark, built, as_of())
    pipeline.run_serving(spark, built, as_of())
    return built


def _by(rows, key):
    return {getattr(r, key): r for r in rows}


def test_dimensions(spark, paths):
    cities = _by(spark.read.parquet(paths.cities).collect(), "city_slug")
    assert set(cities) == {"OR-ridgemont", "KY-larkspur-dover", "NM-sandpoint", "ME-coldwater"}
    assert cities["NM-sandpoint"].copies == 2 and cities["NM-sandpoint"].place_type == "City"
    assert cities["ME-coldwater"].area.water_sqm is None
    firms = _by(spark.read.parquet(paths.companies).collect(), "slug")
    nimbus = firms["nimbus-inc"]
    assert (nimbus.sector, nimbus.market_cap) == ("Technology", "1800")
    assert nimbus.primary_ticker == "NMBSA" and set(nimbus.tickers) == {"NMBS", "NMBSA"}
    assert firms["marlow-corporation"].ipo_year is None
    index = dimensions.read_aliases(spark, paths.aliases)
    assert dimensions.find_alias(index, "halyard").first().target == "SLUG#halyard-com-inc"
    assert dimensions.find_alias(index, "KY-larkspur").first().target == "CITY#KY-larkspur-dover"
    assert dimensions.find_alias(index, "kentucky").first().target == "STATE#KY"


def test_listing_and_layouts(spark, paths):
    files = landing.list_landing(spark, paths.landing)
    assert {r.key for r in files.collect()} == {
        "estuary/OSHA/severe-incident/small.csv", "estuary/OSHA/odi-02-11/new.csv",
        "estuary/OSHA/odi-02-11/old.csv", "estuary/fda/recalls/a file.csv",
    }
    found = landing.layouts(files)
    assert len(found) == 4
    assert {(x.source, x.dataset) for x in found} == {
        ("OSHA", "severe-incident"), ("OSHA", "odi-02-11"), ("fda", "recalls"),
    }


def test_bronze_and_quarantine(spark, paths):
    good = tables.read_bronze(spark, paths.lake).collect()
    held = tables.read_quarantine(spark, paths.lake).collect()
    assert len(good) + len(held) == 5 + 2 + 1 + 1
    titles = _by(good, "event_title")
    assert set(titles) == {
        "Incident at Bluefern Mills LLC in RIDGEMONT, OR", "Incident at Kestrel Foods #771 in LARKSPUR, KY",
        "Incident at Quarry Nine Co in SANDPOINT, NM", "Incident at Bluefern Outlet in RIDGEMONT, OR",
        "2023 HALYARD Annual Safety Report", "2023 MARLOW Annual Safety Report",
        "2003 Unknown Company Annual Safety Report", "Incident at Pinyon - 9 in SANDPOINT, NM",
    }
    kestrel = titles["Incident at Kestrel Foods #771 in LARKSPUR, KY"]
    assert (kestrel.city_slug, kestrel.company_slug, kestrel.site_id) == (
        "KY-larkspur", "kestrel-foods", "771",
    )
    assert kestrel.partition_source == "OSHA" and kestrel.partition_year == "2025"
    assert kestrel.ingested_at == "2025-06-01T00:00:00.000Z"
    assert list(json.loads(kestrel.raw_data)) == [
        "ID", "EventDate", "Employer", "City", "State", "Nature", "Hospitalized", "Amputation",
        "Final Narrative",
    ]
    details = json.loads(kestrel.event_details)
    assert details["company_name"] == "Kestrel Foods #771" and details["bedrock_verified"] is False
    assert details["violation_code"] == "Cuts" and "state" not in details
    # A line break inside quotes stays inside its row.
    assert "\n" in titles["Incident at Quarry Nine Co in SANDPOINT, NM"].event_description
    # An empty first alias beats a filled second one.
    old = titles["2003 Unknown Company Annual Safety Report"]
    assert old.company_name is None and old.company_slug is None
    assert titles["2023 HALYARD Annual Safety Report"].company_slug == "halyard-com-inc"
    assert titles["2023 MARLOW Annual Safety Report"].company_slug == "marlow-corporation"
    pinyon = titles["Incident at Pinyon - 9 in SANDPOINT, NM"]
    assert (pinyon.event_source, pinyon.site_id) == ("FDA", "9")
    assert pinyon.source_url == "estuary/fda/recalls/a file.csv"
    assert held[0].quarantine_reason == "Unknown City: WINDMERE (KS-windmere)"
    rows, total = tables.peek_quarantine(spark, paths.lake)
    assert total == 1 and rows.count() == 1
    assert tables.peek_bronze(spark, paths.lake).count() == 3
    assert tables.read_quarantine(spark, paths.lake, newest_files=20).count() == 1


def test_silver_dates_and_idempotence(spark, paths):
    silver = merge.read_silver(spark, paths.silver)
    dates = {r.event_title: r.event_date for r in silver.collect()}
    assert dates["Incident at Bluefern Mills LLC in RIDGEMONT, OR"] is None
    assert str(dates["2023 HALYARD Annual Safety Report"]) == "2023-01-01 00:00:00"
    before = sorted(map(str, silver.collect()))
    pipeline.run_merge(spark, paths)
    assert sorted(map(str, merge.read_silver(spark, paths.silver).collect())) == before
    assert merge.versions(spark, paths.silver)[:2] == [1, 2]
    assert sorted(map(str, merge.read_silver(spark, paths.silver, 1).collect())) == before


def test_gold_and_documents(spark, paths):
    nation = tables.read_gold(spark, paths.gold, "nation").first()
    assert nation.total_events == 8 and nation.total_states == 4
    states = tables.read_gold(spark, paths.gold, "state").collect()
    assert sum(s.total_events for s in states) == 8
    city = _by(tables.read_gold(spark, paths.gold, "city").collect(), "city_slug")["NM-sandpoint"]
    assert city.state == "NM" and set(city.recentByEventSource) == {"OSHA", "FDA"}
    docs = spark.read.parquet(paths.documents)
    assert docs.groupBy("PK", "SK").count().where("count > 1").isEmpty()
    state = json.loads(tables.find_document(docs, "STATE#NM").first().document)
    assert state["name"] == "New Mexico" and state["stats"]["totalEvents"] == 4
    assert state["directory"][0] == {"slug": "NM-sandpoint", "name": "Sandpoint", "count": 4}
    assert set(state["recentByAgency"]) == {"OSHA", "FDA"}
    assert state["updatedAt"] == "2026-01-01T00:00:00.000Z"
    firm = json.loads(tables.find_document(docs, "COMPANY#kestrel-foods").first().document)
    assert firm["sites"][0]["slug"] == "771" and firm["recentEvents"][0]["agency"] == "OSHA"
    site = json.loads(tables.find_document(docs, "SITE#kestrel-foods_771").first().document)
    assert site["name"] == "Kestrel Foods #771 #771"


def test_sitemaps(spark, paths):
    pipeline.run_sitemaps(spark, paths, "https://example.org", as_of())
    there = spark.read.text(f"{paths.site}/sitemaps", wholetext=True).select("_metadata.file_name", "value").collect()
    files = {r.file_name for r in there}
    assert all(r.value.endswith("</urlset>") for r in there)
    assert files == {"states.xml", "cities.xml", "companies.xml", "sites.xml"}
    index = "\n".join(r.value for r in spark.read.text(f"{paths.site}/sitemap.xml").collect())
    assert index.count("<sitemap>") == 4 and "/sitemaps/cities.xml" in index


def test_chunks_fill_up_in_order(spark):
    keys = spark.range(1000).select(F.concat(F.lit("CITY#TN-"), F.col("id").cast("string")).alias("PK"))
    chunks = sitemap.chunked(sitemap.urls(keys, "https://example.org"), 300)
    sizes = {r.chunk: r["count"] for r in chunks.groupBy("chunk").count().collect()}
    assert sizes == {1: 300, 2: 300, 3: 300, 4: 100}


def test_recovery(spark, paths):
    _, city_keys = pipeline.lookups(spark, paths)
    held = tables.read_quarantine(spark, paths.lake)
    event = held.first().event_id
    fixes = spark.createDataFrame([(event, "SANDPOINT", "NM"), (event, "SANDPOINT", "NM")], "event_id string, city string, state string")
    checked = quarantine.recover(held, fixes, city_keys)
    assert checked.first().quarantine_reason is None and checked.first().city_slug == "NM-sandpoint"
    assert quarantine.recovered(checked).count() == 1
    groups = quarantine.top_groups(held).collect()
    assert groups[0]["count"] == 1 and groups[0].file_key


def test_stream_equals_batch(spark, paths, tmp_path):
    built = lake.build(spark, tmp_path)
    intake.intake(spark, built, max_files=2, ingested_at=lake.stamp("2025-06-01 00:00:00"))
    intake.upsert(spark, built, max_files=1)
    batch = merge.read_silver(spark, paths.silver)
    stream = merge.read_silver(spark, built.silver)
    assert sorted(map(str, stream.collect())) == sorted(map(str, batch.collect()))
    # Nothing new: another run changes nothing.
    count = len(merge.versions(spark, built.silver))
    intake.intake(spark, built)
    intake.upsert(spark, built)
    assert len(merge.versions(spark, built.silver)) == count
    # A later delivery of the same rows in a new file replaces, never adds.
    again = tmp_path / "lake" / "landing" / "estuary/OSHA/severe-incident/again.csv"
    again.write_text(lake.INCIDENTS)
    intake.intake(spark, built, ingested_at=lake.stamp("2025-07-01 00:00:00"))
    intake.upsert(spark, built)
    merged = merge.read_silver(spark, built.silver)
    assert merged.count() == stream.count()
    newest = merged.where("source_url like '%again.csv'").collect()
    assert len(newest) == 4 and {str(r.ingested_at) for r in newest} == {"2025-07-01 00:00:00"}
    pipeline.run_gold(spark, built, as_of())
    intake.serve(spark, built, as_of())
    assert spark.read.parquet(built.documents).where("level = 'nation'").count() == 1


def test_recovery_and_backfill_reach_silver(spark, tmp_path):
    built = lake.build(spark, tmp_path)
    stamp = lake.stamp("2025-06-01 00:00:00")
    assert pipeline.run_ingest(spark, built, files_per_batch=2, ingested_at=stamp) == 4
    pipeline.run_merge(spark, built)
    held = tables.read_quarantine(spark, built.lake)
    event = held.first().event_id
    fixes = spark.createDataFrame(
        [(event, "RIDGEMONT", "OR"), ("no such event", "SANDPOINT", "NM")],
        "event_id string, city string, state string",
    )
    assert pipeline.run_recovery(spark, built, fixes).count() == 0
    old = tmp_path / "lake" / "landing" / "Historical/OSHA/severe-incident/old.csv"
    old.parent.mkdir(parents=True)
    old.write_text(lake.INCIDENTS.replace("Bluefern Outlet", "Old Shop"))
    assert pipeline.run_backfill(spark, built, ingested_at=stamp)
    pipeline.run_merge(spark, built)
    silver = merge.read_silver(spark, built.silver)
    # Eight valid rows, the recovered one, and the one historical row that is new.
    assert silver.count() == 10
    assert silver.where(F.col("event_id") == event).first().city_slug == "OR-ridgemont"
    assert silver.where("company_name = 'Old Shop'").first().source_url.startswith("Historical/")


def test_backfill_lists_historical_files(spark, tmp_path):
    for name in ("Historical/OSHA/ita/a.csv", "Historical/OSHA/ita/a.txt", "estuary/OSHA/ita/b.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("id\n1\n")
    found = landing.backfill_listing(spark, f"file:{tmp_path}").collect()
    assert [(r.source, r.dataset, r.key) for r in found] == [
        ("OSHA", "ita", "Historical/OSHA/ita/a.csv")
    ]


def test_catalog_tables(spark, paths, tmp_path):
    tables.create_bronze_table(spark, paths.lake, "reef_check")
    assert spark.table("reef_check").count() == 8
    tables.repair_partitions(spark, "reef_check")
    tables.drop_table(spark, "reef_check")
    assert tables.read_bronze(spark, paths.lake).count() == 8
    tables.create_silver_table(spark, f"file:{tmp_path}/deep", "silver_check")
    assert spark.table("silver_check.events").columns[-2:] == ["event_source", "event_year"]


def _event(event_id, day, title, source="OSHA", stamp="2024-06-01"):
    return (event_id, source, stamp, day, title)


def _silver_rows(spark, *events):
    rows = spark.createDataFrame(list(events), "event_id string, event_source string, stamp string, day string, event_title string")
    own = {
        "ingested_at": F.col("stamp").cast("timestamp"), "event_date": F.col("day").cast("timestamp"),
        "event_id": F.col("event_id"), "event_source": F.col("event_source"), "event_title": F.col("event_title"),
    }
    return rows.select(*[own.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in merge.schemas.SILVER.fields])


def test_newest_ingest_wins_in_any_order(spark, tmp_path):
    new = _event("a", "2024-01-01", "new", stamp="2024-06-02")
    old = _event("a", "2023-01-01", "old", stamp="2024-06-01")
    for name, order in (("up", (old, new)), ("down", (new, old))):
        table = f"file:{tmp_path}/{name}"
        for row in order:
            merge.merge_into_silver(spark, _silver_rows(spark, row), table)
        assert [r.event_title for r in merge.read_silver(spark, table).collect()] == ["new"]
    tied = [_event("a", "2024-01-01", t) for t in ("x", "y")]
    ends = set()
    for k, order in enumerate((tied, tied[::-1])):
        table = f"file:{tmp_path}/tie{k}"
        for row in order:
            merge.merge_into_silver(spark, _silver_rows(spark, row), table)
        ends.add(merge.read_silver(spark, table).first().event_title)
    assert len(ends) == 1


def test_batches_sources_and_repeated_ids(spark, tmp_path):
    table = f"file:{tmp_path}/silver"
    assert merge.merge_into_silver(spark, _silver_rows(spark, _event("a", None, "no source", None)), table, "one-0") == 1
    assert merge.merge_into_silver(spark, _silver_rows(spark, _event("b", "2024-01-01", "t")), table, "one-0") is None
    assert merge.merge_into_silver(spark, _silver_rows(spark, _event("b", "2024-01-01", "t")), table, "two-0") == 2
    assert {r.event_id for r in merge.read_silver(spark, table).collect()} == {"a", "b"}
    assert {r.event_id for r in merge.read_silver(spark, table, 1).collect()} == {"a"}
    with pytest.raises(ValueError):
        merge.merge_into_silver(spark, _silver_rows(spark, *[_event("c", None, "t")] * 2), table)


def test_new_checkpoint_is_a_new_stream(spark, paths, tmp_path):
    built = lake.build(spark, tmp_path)
    intake.intake(spark, built, ingested_at=lake.stamp("2025-06-01 00:00:00"))
    intake.upsert(spark, built)
    count = merge.read_silver(spark, built.silver).count()
    (tmp_path / "lake" / "landing" / "estuary/fda/recalls/more.csv").write_text("Company_Name,CITY,State\nNew One,Sandpoint,NM\n")
    (tmp_path / "lake" / "checkpoints").rename(tmp_path / "earlier")
    intake.intake(spark, built, ingested_at=lake.stamp("2025-06-02 00:00:00"))
    intake.upsert(spark, built)
    assert merge.read_silver(spark, built.silver).count() == count + 1


def test_ingest_takes_a_file_in_once(spark, tmp_path):
    built = lake.build(spark, tmp_path)
    assert pipeline.run_ingest(spark, built) == 4
    rows = tables.read_bronze(spark, built.lake).count()
    assert pipeline.run_ingest(spark, built) == 0
    assert tables.read_bronze(spark, built.lake).count() == rows


def test_aliases_of_earlier_loads_stay(spark, tmp_path):
    built = lake.build(spark, tmp_path)
    before = {tuple(r) for r in dimensions.read_aliases(spark, built.aliases).collect()}
    pipeline.build_dimensions(spark, built, curated=[("Osprey Works", "osprey", []), ("Kestrel", "kestrel-foods", ["kestrel foods"])])
    after = {tuple(r) for r in dimensions.read_aliases(spark, built.aliases).collect()}
    assert after - before == {("osprey works", "COMPANY#osprey")}
    assert before - after == {("kestrel foods inc", "COMPANY#kestrel-foods")}
    assert spark.read.parquet(built.states).count() > 49


def _landing(spark, root, **files):
    for name, text in files.items():
        path = root / "landing" / "estuary" / "fda" / "recalls" / f"{name}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return landing.list_landing(spark, f"file:{root}/landing")


def test_long_rows_keep_their_cells(spark, tmp_path):
    files = _landing(spark, tmp_path, wide='id,City\n1,Austin,EXTRA1\n1,Austin,EXTRA2\n2\n3,"a,b"\n4,"a\nb",more\n')
    (layout,) = landing.layouts(files)
    assert layout.quoted == frozenset(layout.paths)
    rows = landing.read_rows(spark, layout, f"file:{tmp_path}/landing").orderBy("c0", "surplus").collect()
    assert [(r.c0, r.c1, r.surplus) for r in rows] == [
        ("1", "Austin", "1,Austin,EXTRA1"), ("1", "Austin", "1,Austin,EXTRA2"), ("2", "", None), ("3", "a,b", None),
        ("4", "a\nb", '4,"a\nb",more'),
    ]


def test_headers_of_any_length_and_place(spark, tmp_path):
    names = [f"column number {k} with a long name" for k in range(40_000)]
    files = _landing(
        spark, tmp_path, long=",".join(names) + "\n", late="\n" * (1 << 20) + "\ufeffid,City\n7,Waco\n", broken='id,"two\nlines"\n8,x\n',
    )
    found = {len(x.header): x for x in landing.layouts(files)}
    assert list(found[40_000].header) == names
    headers = {x.header for x in found.values()} | {x.header for x in landing.layouts(files)}
    assert ("id", "City") in headers and ("id", "two\nlines") in headers
    late = next(x for x in landing.layouts(files) if x.header == ("id", "City"))
    assert [(r.c0, r.c1) for r in landing.read_rows(spark, late, f"file:{tmp_path}/landing").collect()] == [("7", "Waco")]


def test_files_without_a_header_are_named(spark, tmp_path):
    files = _landing(spark, tmp_path, blank="\n\n  \n", fine="id\n1\n")
    with pytest.raises(landing.UnreadableFiles) as caught:
        landing.layouts(files)
    assert [p.rsplit("/", 1)[1] for p in caught.value.paths] == ["blank.csv"]
    assert len(landing.layouts(files, on_unreadable="skip")) == 1
    assert len(landing.unreadable(files)) == 1


def test_one_reply_and_digits_only(spark):
    from casebook.functions import events
    from casebook.operators import narrative

    rows = spark.createDataFrame([("a", None, None, False)], "event_id string, bedrock_event_title string, bedrock_event_description string, bedrock_verified boolean")
    replies = spark.createDataFrame([("a", "t2", "e", True), ("a", "t1", "e", True), ("a", "t0", "e", False)], "event_id string, title string, explanation string, is_valid boolean")
    assert [r.bedrock_event_title for r in narrative.enrich(rows, replies).collect()] == ["t1"]
    cells = spark.createDataFrame([("NaN", "1"), ("Infinity", " 2.5 "), ("-1e2", "x"), (None, "")], "a string, b string")
    assert [r.s for r in cells.select(events.number_sum(F.col("a"), F.col("b")).alias("s")).collect()] == [1.0, 2.5, -100.0, 0.0]


def test_every_site_is_in_some_document(spark, tmp_path):
    from casebook.operators import documents, sites

    rows = spark.range(100).select(
        F.lit("firm").alias("company_slug"), F.col("id").cast("string").alias("site_id"), F.col("id").alias("count"),
        F.lit("X").alias("city"), F.lit("NM").alias("state"),
    )
    pages = sites.site_pages(rows)
    assert [len(r.sites) for r in pages.orderBy("page").collect()] == [30, 30, 30, 10]
    assert pages.select(F.explode("sites.slug").alias("s")).distinct().count() == 100
    docs = documents.site_page_documents(pages, F.lit("now"))
    assert sorted(r.SK for r in docs.collect()) == [f"SITES#{k:08d}" for k in (2, 3, 4)]


def test_a_batch_taken_in_again_replaces_its_rows(spark, tmp_path):
    built = lake.build(spark, tmp_path)
    files = landing.list_landing(spark, built.landing)
    for stamp in ("2025-06-01 00:00:00", "2026-06-01 00:00:00"):
        # As a stream that is handed a batch again before its ledger entry was written.
        pipeline.run_ingest(spark, built, files, batch="stream-0", ingested_at=lake.stamp(stamp))
        good = tables.read_bronze(spark, built.lake)
        assert good.count() + tables.read_quarantine(spark, built.lake).count() == 9
        assert {r.ingested_at for r in good.select("ingested_at").collect()} == {"2025-06-01T00:00:00.000Z"}
        (tmp_path / "lake" / "ledger" / "done").rename(tmp_path / f"done-{stamp[:4]}")
    # Planned and unfinished: the next run finishes it and finds nothing else to do.
    assert pipeline.run_ingest(spark, built) == 4
    assert pipeline.run_ingest(spark, built) == 0
    assert tables.read_bronze(spark, built.lake).count() == 8


def test_cities_are_read_once_and_counted_on_the_way(spark, tmp_path):
    rows = [(1, "OR", "Ridge city"), (2, "OR", "Ridge town"), (3, "", "Nowhere"), (4, None, "x"), (5, "KY", "Lark city")]
    names = ("GEOID", "ANSICODE", "ALAND", "AWATER", "ALAND_SQMI", "AWATER_SQMI", "INTPTLAT", "INTPTLONG")
    gazetteer = spark.createDataFrame(rows, "line int, USPS string, NAME string").withColumns({n: F.lit("1") for n in names})
    gazetteer.write.parquet(f"{tmp_path}/gazetteer")
    stored = spark.read.parquet(f"{tmp_path}/gazetteer")
    plan = dimensions.cities(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    counts = dimensions.load_cities(stored, f"{tmp_path}/cities")
    assert counts == {"lines": 5, "skipped": 2, "imported": 2, "collisions": 1}
    assert {r.city_slug: r.copies for r in spark.read.parquet(f"{tmp_path}/cities").collect()} == {"OR-ridge": 2, "KY-lark": 1}


def test_refresh_builds_touched_keys_only(spark, tmp_path):
    built = pipeline.Paths(f"file:{tmp_path}/lake")

    def rows(*events):
        made = spark.createDataFrame(
            [(*e, f"title {e[0]}") for e in events],
            "event_id string, stamp string, day string, state string, city_slug string, company_slug string, site_id string, event_title string",
        )
        own = {
            "ingested_at": F.col("stamp").cast("timestamp"), "event_date": F.col("day").cast("timestamp"),
            "event_source": F.lit("OSHA"), "city": F.col("city_slug"), "company_name": F.col("company_slug"),
        }
        named = {c: F.col(c) for c in made.columns if c not in ("stamp", "day")} | own
        return made.select(*[named.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in merge.schemas.SILVER.fields])

    def whole(version):
        gold, _ = refresh.rollup.all_gold(merge.read_silver(spark, built.silver, version), as_of())
        return {level: sorted(map(str, frame.select(sorted(frame.columns)).collect())) for level, frame in gold.items()}

    def kept():
        found = {level: refresh.read_gold(spark, built.summary, level) for level in tables.LEVELS}
        return {level: sorted(map(str, frame.select(sorted(frame.columns)).collect())) for level, frame in found.items()}

    first = [(f"e{k}", "2024-01-01", f"2024-01-{k % 28 + 1:02}", f"S{k % 4}", f"S{k % 4}-c{k % 12}", f"firm-{k % 5}", str(k % 3)) for k in range(120)]
    merge.merge_into_silver(spark, rows(*first), built.silver)
    pipeline.run_refresh(spark, built, as_of())
    assert kept() == whole(1)
    # One event leaves the newest of its keys for a new city; one is new; one comes again unchanged.
    moved = ("e27", "2024-02-01", "2023-01-01", "S0", "S0-new", "firm-2", "0")
    new = ("x", "2024-02-01", "2024-03-01", "S1", "S1-c1", "firm-1", None)
    merge.merge_into_silver(spark, rows(moved, new, first[5]), built.silver)
    touched, = pipeline.run_refresh(spark, built, as_of())
    assert kept() == whole(2)
    keys = {level: {tuple(r) for r in frame.collect()} for level, frame in touched.items()}
    assert keys["city"] == {("S3-c3",), ("S0-new",), ("S1-c1",)}
    assert keys["state"] == {("S0",), ("S1",), ("S3",)} and keys["company"] == {("firm-2",), ("firm-1",)}
    assert keys["site"] == {("firm-2", "0")}
    docs = tables.read_documents(spark, built.documents).where("SK = 'SUMMARY'")
    assert docs.count() == sum(len(v) for v in kept().values())
    found = tables.find_stored_document(spark, built.documents, "CITY#S0-new")
    assert json.loads(found.first().document)["stats"]["totalEvents"] == 1
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(pk_part" in plan and "EqualTo(PK,CITY#S0-new)" in plan
    # A city that loses its last event goes from gold and from the documents.
    back = ("e27", "2024-03-01", "2024-01-28", "S3", "S3-c3", "firm-2", "0")
    merge.merge_into_silver(spark, rows(back), built.silver)
    pipeline.run_refresh(spark, built, as_of())
    assert kept() == whole(3)
    assert tables.find_stored_document(spark, built.documents, "CITY#S0-new").isEmpty()
    assert refresh.find_gold(spark, built.summary, "city", "S3-c3").first().total_events == 10
    assert pipeline.run_refresh(spark, built, as_of()) == []
    # A refresh that died leaves no version noted, and the next one builds all anew.
    refresh._note(spark, built.summary, None)
    pipeline.run_refresh(spark, built, as_of())
    assert kept() == whole(3) and refresh.stands_for(spark, built.summary) == 3
