"""Hot keys against brute force, and the plans that make them safe."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from casebook import session
from casebook.operators import insights, merge, resolve, rollup, sitemap, sites
from casebook.plans import catalog, views
from casebook.sources import landing, tables

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = (
    "event_id string, event_source string, state string, city_slug string, city string, "
    "company_slug string, company_name string, site_id string, event_date timestamp, "
    "event_title string, event_description string, bedrock_event_title string, "
    "bedrock_event_description string"
)


@pytest.fixture(scope="module")
def rows():
    """One city and one company hold a third of all events; some keys are null."""
    rng = random.Random(7)
    out = []
    for i in range(6000):
        hot = rng.random() < 1 / 3
        city = "TX-austin" if hot else rng.choice(["TX-waco", "TN-paris", None])
        firm = "walmart-inc" if hot else rng.choice(["acme", "globex", None])
        site = str(rng.randrange(40)) if hot else rng.choice(["1", "2", None])
        day = rng.choice([None, f"2025-01-{rng.randrange(1, 29):02d} 00:00:00"])
        out.append(
            dict(
                event_id=f"e{i:05d}", event_source=rng.choice(["OSHA", "FDA"]),
                state=city[:2] if city else "TN", city_slug=city,
                city=city[3:].upper() if city else None, company_slug=firm,
                company_name=firm, site_id=site, event_date=day, event_title=f"t{i}",
                event_description=None, bedrock_event_title=None, bedrock_event_description=None,
            )
        )
    return out


@pytest.fixture(scope="module")
def silver(spark, rows):
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    text = COLUMNS.replace("timestamp", "string")
    made = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], text)
    return made.withColumn("event_date", F.col("event_date").cast("timestamp")).repartition(8)


def _newest(items, top):
    dated = sorted((r for r in items if r["event_date"]), key=lambda r: r["event_id"])
    dated.sort(key=lambda r: r["event_date"], reverse=True)
    undated = sorted((r for r in items if not r["event_date"]), key=lambda r: r["event_id"])
    return [r["event_id"] for r in (dated + undated)[:top]]


@pytest.mark.parametrize("keys", [(), ("state",), ("city_slug",), ("company_slug",)])
def test_recents_from_candidates_equal_brute_force(silver, rows, keys):
    groups = defaultdict(list)
    for r in rows:
        if all(r[k] is not None for k in keys):
            groups[(*[r[k] for k in keys], r["event_source"])].append(r)
    wanted = {g: _newest(items, 5) for g, items in groups.items()}
    events = rollup.shown_events(silver)
    for source in (events, rollup.recent_candidates(events)):
        got = defaultdict(dict)
        for r in rollup.recent_events(source, keys).collect():
            got[(*[r[k] for k in keys], r.event_source)][r["rank"]] = r.event_id
        assert {g: [v[i] for i in sorted(v)] for g, v in got.items()} == wanted


def test_gold_equals_brute_force(silver, rows):
    as_of = F.lit("2026-01-01").cast("timestamp")
    gold, shared = rollup.all_gold(silver, as_of)
    city = {r.city_slug: r for r in gold["city"].collect()}
    by_city = defaultdict(list)
    for r in rows:
        if r["city_slug"]:
            by_city[r["city_slug"]].append(r)
    assert set(city) == set(by_city)
    for slug, items in by_city.items():
        firms = Counter(r["company_slug"] for r in items if r["company_slug"])
        assert city[slug].total_events == len(items)
        assert city[slug].total_companies == len(firms)
        listed = sorted(firms.items(), key=lambda kv: (-kv[1], kv[0]))
        assert [(d.slug, d["count"]) for d in city[slug].companies_directory] == listed
        for source, events in city[slug].recentByEventSource.items():
            mine = [r for r in items if r["event_source"] == source]
            assert [e.eventId for e in events] == _newest(mine, 5)
    nation = gold["nation"].collect()
    assert len(nation) == 1 and nation[0].total_events == len(rows)
    assert sum(r.total_events for r in gold["state"].collect()) == len(rows)
    assert gold["nation"].columns[:3] == ["total_events", "total_companies", "total_cities"]
    for frame in shared:
        frame.unpersist()


def test_nation_of_empty_table_is_one_row(spark, silver):
    gold, _ = rollup.all_gold(silver.where("false"), F.lit("2026-01-01").cast("timestamp"))
    row = gold["nation"].collect()
    assert len(row) == 1 and row[0].total_events == 0
    assert row[0].states_directory == [] and row[0].recentByEventSource == {}


def test_siblings_equal_brute_force(silver, rows):
    sizes = Counter(
        (r["company_slug"], r["site_id"]) for r in rows if r["company_slug"] and r["site_id"]
    )
    got = defaultdict(list)
    for r in sites.siblings(sites.company_sites(silver)).orderBy("rank").collect():
        got[(r.company_slug, r.site_id)].append((r.sibling_id, r.sibling_count))
    for (firm, site), _ in sizes.items():
        peers = [(s, n) for (f, s), n in sizes.items() if f == firm and s != site]
        assert got.get((firm, site), []) == sorted(peers, key=lambda p: (-p[1], p[0]))[:10]


def test_redelivered_event_keeps_newest(spark):
    """A third of all deliveries are of one event."""
    sent = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("ingested_at"),
    ).repartition(8)
    kept = merge.latest_per_event(sent)
    assert kept.count() == 6001
    assert kept.where("event_id = 'hot'").first().ingested_at == 8997


def test_merge_rejects_repeated_keys(spark):
    with pytest.raises(ValueError):
        merge.assert_unique(spark.createDataFrame([("a",), ("a",)], "event_id string"))


def test_resolution_without_broadcast_is_the_same(spark):
    """Beyond the size check the lookups shuffle; hot and null names stay whole."""
    names = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "Walmart Inc").when(F.col("id") % 3 == 1, F.concat(F.lit("Firm "), "id")).alias("n")
    )
    lookup = spark.createDataFrame([("walmart", "walmart-inc"), ("firm 4", "four")], "alias_key string, company_slug string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = Counter(r.company_slug for r in resolve.resolve_companies(names, lookup, "n").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert found == {"walmart-inc": 1000, "four": 1, None: 1999}


def test_sitemap_numbers_have_no_gaps(spark):
    keys = spark.range(2500).select(F.concat(F.lit("COMPANY#c"), F.col("id").cast("string")).alias("PK"))
    got = sitemap.chunked(sitemap.urls(keys, "https://example.org"), 1000).collect()
    assert Counter(r.chunk for r in got) == {1: 1000, 2: 1000, 3: 500}
    by_digest = sorted(got, key=lambda r: (r.digest, r.url))
    assert [r.chunk for r in by_digest] == sorted(r.chunk for r in got)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["dedupe_latest", "nation_recent5", "city_recent5", "top_companies_by_state", "site_siblings"]
)
def test_ranked_queries_limit_before_the_exchange(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF_DIR))
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_and_no_cross_joins(spark, name):
    if name == "stream_equals_batch":
        return
    plan = _plan(catalog.QUERIES[name](spark, SF_DIR))
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_scope_reaches_the_scan(spark, tmp_path):
    path = f"file:{tmp_path}/events"
    spark.createDataFrame([("a", "TX"), ("b", "TN")], "event_id string, state string").write.parquet(path)
    plan = _plan(insights.only_state(spark.read.parquet(path), "TX").select("event_id"))
    assert "EqualTo(state,TX)" in plan


def test_cube_is_a_hash_aggregate(spark, silver):
    plan = _plan(rollup.event_cube(silver))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def _files_read(frame) -> int:
    """Files the frame's scan opens once its partition filters have pruned folders."""
    run = frame._jdf.queryExecution()
    run.toRdd().count()
    leaves = run.executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numFiles").value() for k in range(leaves.size()))


def test_a_merge_looks_at_its_own_id_parts_only(spark, tmp_path):
    table = f"file:{tmp_path}/silver"

    def rows(ids, day, stamp):
        frame = spark.createDataFrame([(k,) for k in ids], "event_id string")
        own = {
            "event_id": F.col("event_id"), "event_source": F.lit("OSHA"),
            "event_date": F.lit(day).cast("timestamp"), "ingested_at": F.lit(stamp).cast("timestamp"),
        }
        return frame.select(*[own.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in merge.schemas.SILVER.fields])

    ids = [f"event {k}" for k in range(400)]
    for year in (2021, 2022, 2023):
        merge.merge_into_silver(spark, rows(ids[year - 2021 :: 3], f"{year}-05-01", "2024-01-01"), table, f"b{year}", id_parts=16)
    entries = merge.manifest(spark, table)
    assert len(entries) == 48 and {e.parts for e in entries} == {16}
    # One event moves from 2021 to 2024: its part alone is looked at, in every year.
    one = rows(ids[:1], "2024-05-01", "2024-02-01")
    part = one.select(merge.id_part(16).alias("p")).first().p
    possible = [e for e in entries if e.id_part == part]
    assert _files_read(merge._read_entries(spark, table, possible).select("event_id")) == 3
    assert _files_read(merge._read_entries(spark, table, entries).select("event_id")) == 48
    places = merge.earlier_places(spark, table, entries, one, {part})
    assert "PartitionFilters: [concat_ws" in places._jdf.queryExecution().toString()
    assert [tuple(r) for r in places.collect()] == [("OSHA", "2021", part)]
    assert merge.merge_into_silver(spark, one, table, "move") == 4
    after = merge.manifest(spark, table)
    assert {(e.event_year, e.id_part) for e in after if e.holder == 4} == {("2021", part), ("2024", part)}
    assert sum(e.holder != 4 for e in after) == 47
    silver = merge.read_silver(spark, table)
    assert silver.count() == 400 and silver.where("year(event_date) = 2024").count() == 1
    # A table keeps its number of parts, whatever a later merge would choose.
    merge.merge_into_silver(spark, rows(["new"], "2024-05-01", "2024-02-01"), table, id_parts=3)
    assert {e.parts for e in merge.manifest(spark, table)} == {16}


def test_newest_version_without_its_note(spark, tmp_path):
    table = tmp_path / "silver"
    row = spark.createDataFrame([("a",)], "event_id string").select(
        *[(F.col("event_id") if f.name == "event_id" else F.lit(None).cast(f.dataType)).alias(f.name) for f in merge.schemas.SILVER.fields]
    )
    for k in range(3):
        merge.merge_into_silver(spark, row, f"file:{table}", f"b{k}")
    assert merge.newest_version(spark, f"file:{table}") == 3
    # The note of a merge that died before writing it, and one that was never written.
    (table / "newest").rename(tmp_path / "late")
    assert merge.newest_version(spark, f"file:{table}") == 3
    assert merge.is_merged(spark, f"file:{table}", "b1") and not merge.is_merged(spark, f"file:{table}", "b3")


def test_deduplication_moves_no_row_by_its_text_id(spark):
    plan = _plan(views.latest(spark, SF_DIR).select("event_id", "event_details"))
    assert "Window" in plan and "hashpartitioning(event_id" not in plan


@pytest.mark.parametrize(
    "name",
    ["document_lookup", "documents_with_meta", "directory_orderings", "document_first_pages", "gold_round_trip"],
)
def test_events_are_deduplicated_once(spark, name):
    assert "lineitem.parquet" not in _plan(catalog.QUERIES[name](spark, SF_DIR))


def test_levels_share_stored_frames(spark, silver, monkeypatch):
    names = []
    stored = session.stored
    monkeypatch.setattr(session, "stored", lambda rows, name: (names.append(name), stored(rows, name))[1])
    gold, _ = rollup.all_gold(silver, F.lit("2026-01-01").cast("timestamp"))
    assert names == ["cube", "candidates", "coarse-candidates"]
    for level in ("nation", "state", "city", "company"):
        assert "/candidates-" not in _plan(gold[level]) and "/coarse-candidates-" in _plan(gold[level])


def test_zone_writes_keep_files_open_and_put_the_setting_back(spark, tmp_path, monkeypatch):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(name)
    named = tables.uuid.uuid4
    monkeypatch.setattr(tables.uuid, "uuid4", lambda: (seen.append(spark.conf.get(name)), named())[1])
    fields = "zone string, partition_source string, partition_year string, event_id string"
    rows = spark.createDataFrame([(z, "S", "2025", f"{z}{k}") for k in range(50) for z in ("reef", "quarantine")], fields)
    tables.write_zones(rows.coalesce(1), f"file:{tmp_path}/lake")
    assert seen == [str(tables.OPEN_FILES)] and spark.conf.get(name) == before
    counts = spark.read.parquet(f"file:{tmp_path}/lake").groupBy("zone").count().collect()
    assert sorted(tuple(r) for r in counts) == [("quarantine", 50), ("reef", 50)]
    with pytest.raises(Exception):
        tables.write_zones(rows.drop("zone"), f"file:{tmp_path}/broken")
    assert spark.conf.get(name) == before


def test_records_of_quoted_files_are_dealt(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"x\ny"\n2,z\n')
    path = f"file:{tmp_path}/a.csv"
    layout = landing.Layout("s", "d", ("id", "note"), (path,), frozenset([path]))
    rows = landing.read_rows(spark, layout, f"file:{tmp_path.parent}")
    assert "hashpartitioning" in _plan(rows)
    assert sorted((r.c0, r.c1, r.key) for r in rows.collect()) == [
        ("1", "x\ny", f"{tmp_path.name}/a.csv"), ("2", "z", f"{tmp_path.name}/a.csv")
    ]
    plain = landing.read_rows(spark, layout, f"file:{tmp_path.parent}", multiline=False)
    assert "hashpartitioning" not in _plan(plain)
