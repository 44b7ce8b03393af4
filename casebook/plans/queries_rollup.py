"""Roll-ups per level and the documents made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import session, vocab
from casebook.functions import dates
from casebook.operators import documents, rollup, sites
from casebook.plans import views
from casebook.plans.views import longs, query, sql_stamp, with_base

AS_OF_DAY = "2001-12-31"
STAMPED = f"{AS_OF_DAY}T00:00:00.000Z"


def as_of() -> Column:
    return F.lit(AS_OF_DAY).cast("timestamp")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.shown_events(views.latest(spark, sf_dir))


def _cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.event_cube(_events(spark, sf_dir))


def _recent(spark: SparkSession, sf_dir: str, keys: tuple[str, ...]) -> DataFrame:
    top = rollup.recent_events(_events(spark, sf_dir), keys)
    picked = top.select(
        *keys, "event_source", "rank", "event_id", "event_title", "event_description",
        dates.stamp(F.col("event_date")).alias("event_date"), "company_name",
    )
    return longs(picked, "rank")


def _recent_sql(*keys: str) -> str:
    part = ", ".join([*keys, "event_source"])
    where = " AND ".join(f"{k} IS NOT NULL" for k in [*keys, "event_source"])
    return with_base(
        f"SELECT {part}, rank, event_id, event_title, event_description, "
        f"{sql_stamp('event_date')} AS event_date, company_name FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY {part} "
        f"ORDER BY event_date DESC NULLS LAST, event_id) AS rank FROM shown WHERE {where}) "
        "WHERE rank <= 5"
    )


def _directory(spark: SparkSession, sf_dir: str, level: rollup.Level) -> DataFrame:
    rows = rollup.directory(_cube(spark, sf_dir), level)
    return longs(
        rollup.ranked(rows, level.keys, [F.desc("count"), F.asc("slug")]), "rank"
    )


def _directory_sql(keys: str, child: str, label: str, slug: str) -> str:
    prefix = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    where = f"{child} IS NOT NULL" + (f" AND {keys} IS NOT NULL" if keys else "")
    group = f"{prefix}{child}"
    return with_base(
        f"SELECT *, row_number() OVER ({part}ORDER BY count DESC, slug) AS rank FROM ("
        f"SELECT {prefix}{slug} AS slug, max({label}) AS name, count(*) AS count "
        f"FROM silver WHERE {where} GROUP BY {group})"
    )


@query(
    "city_stats",
    with_base(
        "SELECT city_slug, max(city) AS city, max(state) AS state, count(*) AS total_events, "
        "count(DISTINCT company_slug) AS total_companies FROM silver "
        "WHERE city_slug IS NOT NULL GROUP BY city_slug"
    ),
)
def city_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.city_stats(_cube(spark, sf_dir))


@query("city_directory", _directory_sql("city_slug", "company_slug", "company_name", "company_slug"))
def city_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _directory(spark, sf_dir, rollup.CITY)


@query("city_recent5", _recent_sql("city_slug"))
def city_recent5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recent(spark, sf_dir, ("city_slug",))


@query(
    "state_stats",
    with_base(
        "SELECT state, count(*) AS total_events, count(DISTINCT company_slug) AS total_companies, "
        "count(DISTINCT city_slug) AS total_cities FROM silver WHERE state IS NOT NULL GROUP BY state"
    ),
)
def state_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.state_stats(_cube(spark, sf_dir))


@query("state_directory", _directory_sql("state", "city_slug", "city", "city_slug"))
def state_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _directory(spark, sf_dir, rollup.STATE)


@query("state_recent5", _recent_sql("state"))
def state_recent5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recent(spark, sf_dir, ("state",))


@query(
    "company_stats",
    with_base(
        "SELECT company_slug, max(company_name) AS company_name, count(*) AS total_events, "
        f"{sql_stamp('max(event_date)')} AS last_active FROM silver "
        "WHERE company_slug IS NOT NULL GROUP BY company_slug"
    ),
)
def company_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.company_stats(_cube(spark, sf_dir))


@query("company_recent5", _recent_sql("company_slug"))
def company_recent5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recent(spark, sf_dir, ("company_slug",))


@query(
    "nation_totals",
    with_base(
        "SELECT count(*) AS total_events, count(DISTINCT company_slug) AS total_companies, "
        "count(DISTINCT city_slug) AS total_cities, count(DISTINCT state) AS total_states, "
        f"{sql_stamp('min(event_date)')} AS first_seen, {sql_stamp('max(event_date)')} AS last_seen, "
        "'2001-12-31' AS aggregation_date FROM silver"
    ),
)
def nation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = rollup.nation_totals(_cube(spark, sf_dir), as_of())
    return totals.withColumn("aggregation_date", F.col("aggregation_date").cast("string"))


@query("nation_directory", _directory_sql("", "state", "state", "lower(state)"))
def nation_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _directory(spark, sf_dir, rollup.NATION)


@query("nation_recent5", _recent_sql())
def nation_recent5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recent(spark, sf_dir, ())


# --- Documents, exploded to flat rows ----------------------------------------


def sql_display(text: str) -> str:
    """Display case of space-separated words of letters, digits and ``#``."""
    words = ", ".join(f"'{w}'" for w in vocab.ACRONYMS)
    return (
        f"array_to_string(list_transform(string_split(lower({text}), ' '), lambda w: "
        f"CASE WHEN upper(w) IN ({words}) THEN upper(w) ELSE upper(w[1]) || w[2:] END), ' ')"
    )


_NAMES_SQL = "names AS (SELECT * FROM (VALUES {}) AS v(code, full_name))".format(
    ", ".join(f"('{c}', '{n}')" for c, n in vocab.STATE_NAMES.items())
)


def _shared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cube and candidates, both from events that are deduplicated once."""
    events = session.stored(_events(spark, sf_dir), "shown-events")
    return rollup.event_cube(events), rollup.recent_candidates(events)


def _site_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = session.stored(_events(spark, sf_dir), "shown-events")
    return (
        rollup.event_cube(events, rollup.FINE_CELL),
        rollup.recent_candidates(events, cell=rollup.FINE_CELL),
    )


def _stamp() -> Column:
    return F.lit(STAMPED)


def exploded_recents(docs: DataFrame, *columns: str) -> DataFrame:
    """(source, position, event) rows of a document's map of recents."""
    by_source = docs.select(*columns, F.explode("recentByAgency").alias("agency", "list"))
    rows = by_source.select(
        *columns, "agency", F.posexplode("list").alias("position", "event")
    )
    return rows.select(
        *columns, "agency", F.col("position").cast("bigint").alias("position"),
        F.col("event.eventId").alias("event_id"), F.col("event.eventTitle").alias("event_title"),
        F.col("event.eventDescription").alias("event_description"),
        F.col("event.eventDate").alias("event_date"),
        F.col("event.companyName").alias("company_name"), F.col("event.city").alias("event_city"),
        F.col("event.agency").alias("event_agency"),
    )


def _recents_doc_sql(key: str, columns: str, tail: str) -> str:
    return with_base(
        f"SELECT {columns}, event_source AS agency, rank - 1 AS position, event_id, event_title, "
        f"event_description, {sql_stamp('event_date')} AS event_date, "
        f"{sql_display('company_name')} AS company_name, {sql_display('r.city')} AS event_city, "
        f"event_source AS event_agency FROM (SELECT *, row_number() OVER (PARTITION BY {key}, event_source "
        f"ORDER BY event_date DESC NULLS LAST, event_id) AS rank FROM shown WHERE {key} IS NOT NULL) r "
        f"{tail} WHERE rank <= 5",
        _NAMES_SQL,
        f"stats AS (SELECT {key}, max(city) AS top_city, max(state) AS top_state, count(*) AS total, "
        "count(DISTINCT company_slug) AS companies, count(DISTINCT city_slug) AS cities "
        f"FROM silver WHERE {key} IS NOT NULL GROUP BY {key})",
    )


@query(
    "city_documents",
    _recents_doc_sql(
        "city_slug",
        f"'CITY#' || r.city_slug AS pk, {sql_display('top_city')} AS name, "
        f"coalesce(full_name, {sql_display('top_state')}) AS state_name, "
        "total AS total_events, companies AS total_companies, companies AS listed",
        "JOIN stats ON r.city_slug = stats.city_slug LEFT JOIN names ON code = top_state",
    ),
)
def city_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = rollup.city_gold(*_shared(spark, sf_dir))
    docs = documents.city_documents(gold, _stamp()).select(
        F.col("PK").alias("pk"), "name", F.col("stateName").alias("state_name"),
        F.col("stats.totalEvents").alias("total_events"),
        F.col("stats.totalCompanies").alias("total_companies"),
        F.size("directory").cast("bigint").alias("listed"), "recentByAgency",
    )
    return exploded_recents(
        docs, "pk", "name", "state_name", "total_events", "total_companies", "listed"
    )


@query(
    "state_documents",
    _recents_doc_sql(
        "state",
        f"'STATE#' || r.state AS pk, coalesce(full_name, {sql_display('r.state')}) AS name, "
        "lower(r.state) AS slug, total AS total_events, cities AS total_cities, "
        "companies AS total_companies, cities AS listed",
        "JOIN stats ON r.state = stats.state LEFT JOIN names ON code = r.state",
    ),
)
def state_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = rollup.state_gold(*_shared(spark, sf_dir))
    docs = documents.state_documents(gold, _stamp()).select(
        F.col("PK").alias("pk"), "name", "slug",
        F.col("stats.totalEvents").alias("total_events"),
        F.col("stats.totalCities").alias("total_cities"),
        F.col("stats.totalCompanies").alias("total_companies"),
        F.size("directory").cast("bigint").alias("listed"), "recentByAgency",
    )
    return exploded_recents(
        docs, "pk", "name", "slug", "total_events", "total_cities", "total_companies", "listed"
    )


def _items(docs: DataFrame, *columns: str) -> DataFrame:
    rows = docs.select(*columns, F.posexplode("directory").alias("position", "item"))
    return longs(rows.select(*columns, "position", "item.*"), "position")


@query(
    "state_document_directory",
    with_base(
        "SELECT 'STATE#' || state AS pk, row_number() OVER (PARTITION BY state "
        "ORDER BY count DESC, slug) - 1 AS position, slug, "
        f"{sql_display('city')} AS name, count FROM (SELECT state, city_slug AS slug, max(city) AS city, "
        "count(*) AS count FROM silver WHERE state IS NOT NULL AND city_slug IS NOT NULL GROUP BY 1, 2)"
    ),
)
def state_document_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = rollup.state_gold(*_shared(spark, sf_dir))
    docs = documents.state_documents(gold, _stamp())
    return _items(docs.withColumnRenamed("PK", "pk").drop("slug", "name"), "pk")


@query(
    "city_document_directory",
    with_base(
        "SELECT 'CITY#' || city_slug AS pk, row_number() OVER (PARTITION BY city_slug "
        "ORDER BY count DESC, slug) - 1 AS position, slug, "
        f"{sql_display('company')} AS name, count FROM (SELECT city_slug, company_slug AS slug, "
        "max(company_name) AS company, count(*) AS count FROM silver "
        "WHERE city_slug IS NOT NULL AND company_slug IS NOT NULL GROUP BY 1, 2)"
    ),
)
def city_document_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = rollup.city_gold(*_shared(spark, sf_dir))
    docs = documents.city_documents(gold, _stamp())
    return _items(docs.withColumnRenamed("PK", "pk").drop("slug", "name"), "pk")


@query(
    "nation_document",
    with_base(
        "SELECT 'NATION#USA' AS pk, t.*, row_number() OVER (ORDER BY count DESC, slug) - 1 AS position, "
        f"slug, abbreviation, coalesce(full_name, {sql_display('abbreviation')}) AS name, count "
        "FROM (SELECT lower(state) AS slug, state AS abbreviation, count(*) AS count FROM silver "
        "WHERE state IS NOT NULL GROUP BY state) s LEFT JOIN names ON code = abbreviation "
        "JOIN totals t ON true",
        _NAMES_SQL,
        "totals AS (SELECT count(*) AS total_events, count(DISTINCT state) AS total_states, "
        "count(DISTINCT city_slug) AS total_cities, count(DISTINCT company_slug) AS total_companies "
        "FROM silver)",
    ),
)
def nation_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = rollup.nation_gold(*_shared(spark, sf_dir), as_of())
    docs = documents.nation_documents(gold, _stamp()).select(
        F.col("PK").alias("pk"), F.col("stats.totalEvents").alias("total_events"),
        F.col("stats.totalStates").alias("total_states"),
        F.col("stats.totalCities").alias("total_cities"),
        F.col("stats.totalCompanies").alias("total_companies"), "directory",
    )
    return _items(docs, "pk", "total_events", "total_states", "total_cities", "total_companies")


@query(
    "nation_gold_recents",
    with_base(
        f"SELECT event_source, rank - 1 AS position, event_id, event_title, {sql_stamp('event_date')} AS event_date, "
        "company_name AS company, city, state FROM (SELECT *, row_number() OVER (PARTITION BY event_source "
        "ORDER BY event_date DESC NULLS LAST, event_id) AS rank FROM shown) WHERE rank <= 5"
    ),
)
def nation_gold_recents(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = rollup.nation_gold(*_shared(spark, sf_dir), as_of())
    rows = gold.select(F.explode("recentByEventSource").alias("event_source", "list")).select(
        "event_source", F.posexplode("list").alias("position", "e")
    )
    return rows.select(
        "event_source", F.col("position").cast("bigint").alias("position"),
        F.col("e.eventId").alias("event_id"), F.col("e.eventTitle").alias("event_title"),
        F.col("e.eventDate").alias("event_date"), F.col("e.company").alias("company"),
        F.col("e.city").alias("city"), F.col("e.state").alias("state"),
    )


def _flat_events(docs: DataFrame, *columns: str) -> DataFrame:
    rows = docs.select(*columns, F.posexplode("recentEvents").alias("position", "e"))
    return rows.select(
        *columns, F.col("position").cast("bigint").alias("position"),
        F.col("e.eventId").alias("event_id"), F.col("e.eventTitle").alias("event_title"),
        F.col("e.eventDate").alias("event_date"), F.col("e.city").alias("city"),
        F.col("e.agency").alias("agency"),
    )


@query(
    "company_documents",
    with_base(
        f"SELECT 'COMPANY#' || f.company_slug AS pk, {sql_display('top_name')} AS name, total_events, "
        f"last_active, place - 1 AS position, event_id, event_title, {sql_stamp('event_date')} AS event_date, "
        f"{sql_display('city')} AS city, event_source AS agency FROM ("
        "SELECT *, row_number() OVER (PARTITION BY company_slug ORDER BY event_date DESC, event_id) AS place "
        "FROM (SELECT *, row_number() OVER (PARTITION BY company_slug, event_source "
        "ORDER BY event_date DESC, event_id) AS rank FROM shown WHERE company_slug IS NOT NULL) "
        "WHERE rank <= 5) f JOIN (SELECT company_slug, max(company_name) AS top_name, "
        f"count(*) AS total_events, {sql_stamp('max(event_date)')} AS last_active FROM silver "
        "WHERE company_slug IS NOT NULL GROUP BY 1) s ON f.company_slug = s.company_slug"
    ),
)
def company_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = rollup.company_gold(*_shared(spark, sf_dir))
    docs = documents.company_documents(gold, _stamp()).select(
        F.col("PK").alias("pk"), "name", F.col("stats.totalEvents").alias("total_events"),
        F.col("stats.lastActive").alias("last_active"), "recentEvents",
    )
    return _flat_events(docs, "pk", "name", "total_events", "last_active")


@query(
    "document_first_pages",
    with_base(
        "SELECT 'CITY#' || city_slug AS pk, least(count(DISTINCT company_slug), 30) AS listed, NULL::BIGINT AS recents "
        "FROM silver WHERE city_slug IS NOT NULL GROUP BY city_slug UNION ALL "
        "SELECT 'COMPANY#' || company_slug, NULL, least(sum(least(n, 5)), CASE WHEN bool_or(sited) THEN 5 ELSE 10 END)::BIGINT FROM ("
        "SELECT company_slug, event_source, count(*) AS n, bool_or(site_id IS NOT NULL) AS sited FROM silver "
        "WHERE company_slug IS NOT NULL GROUP BY 1, 2) GROUP BY 1"
    ),
)
def document_first_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = session.stored(_events(spark, sf_dir), "shown-events")
    cube, recents = rollup.event_cube(events), rollup.recent_candidates(events)
    none = F.lit(None).cast("bigint")
    lists = sites.site_lists(sites.company_sites(events))
    city = documents.first_page(
        documents.city_documents(rollup.city_gold(cube, recents), _stamp()), "city"
    )
    firm = documents.first_page(
        documents.company_documents(rollup.company_gold(cube, recents), _stamp(), lists), "company"
    )
    return city.select(
        F.col("PK").alias("pk"), F.size("directory").cast("bigint").alias("listed"), none.alias("recents")
    ).unionByName(
        firm.select(
            F.col("PK").alias("pk"), none.alias("listed"),
            F.size("recentEvents").cast("bigint").alias("recents"),
        )
    )


@query(
    "site_documents",
    with_base(
        "SELECT 'SITE#' || f.company_slug || '_' || f.site_id AS pk, top_name || ' #' || f.site_id AS name, "
        f"total_events, last_active, place - 1 AS position, event_id, event_title, "
        f"{sql_stamp('event_date')} AS event_date, {sql_display('city')} AS city, event_source AS agency FROM ("
        "SELECT *, row_number() OVER (PARTITION BY company_slug, site_id ORDER BY event_date DESC, event_id) "
        "AS place FROM shown WHERE company_slug IS NOT NULL AND site_id IS NOT NULL) f "
        "JOIN (SELECT company_slug, site_id, max(company_name) AS top_name, count(*) AS total_events, "
        f"{sql_stamp('max(event_date)')} AS last_active FROM silver WHERE company_slug IS NOT NULL "
        "GROUP BY 1, 2) s ON f.company_slug = s.company_slug AND f.site_id = s.site_id WHERE place <= 5"
    ),
)
def site_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = rollup.site_gold(*_site_frames(spark, sf_dir))
    docs = documents.site_documents(gold, _stamp()).select(
        F.col("PK").alias("pk"), "name", F.col("stats.totalEvents").alias("total_events"),
        F.col("stats.lastActive").alias("last_active"), "recentEvents",
    )
    return _flat_events(docs, "pk", "name", "total_events", "last_active")


# --- Sites -------------------------------------------------------------------


@query(
    "site_rollup",
    with_base(
        "SELECT company_slug, site_id, max(company_name) AS company_name, count(*) AS total_events, "
        f"{sql_stamp('max(event_date)')} AS last_active FROM silver "
        "WHERE company_slug IS NOT NULL AND site_id IS NOT NULL GROUP BY 1, 2"
    ),
)
def site_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.site_stats(rollup.event_cube(_events(spark, sf_dir), rollup.FINE_CELL))


_SITES_SQL = (
    "counted AS (SELECT company_slug, site_id, count(*) AS count, max(city) AS city, "
    "max(state) AS state FROM silver WHERE company_slug IS NOT NULL AND site_id IS NOT NULL GROUP BY 1, 2)"
)


@query("company_sites", with_base("SELECT * FROM counted", _SITES_SQL))
def company_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.company_sites(views.latest(spark, sf_dir))


@query(
    "company_site_page",
    with_base(
        "SELECT company_slug, rank - 1 AS position, site_id AS slug, '#' || site_id AS name, count, "
        "concat_ws(', ', city, state) AS subtitle FROM (SELECT *, row_number() OVER (PARTITION BY "
        "company_slug ORDER BY count DESC, site_id) AS rank FROM counted)",
        _SITES_SQL,
    ),
)
def company_site_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sites of every company, page after page."""
    pages = sites.site_pages(sites.company_sites(views.latest(spark, sf_dir)))
    rows = pages.select("company_slug", "page", F.posexplode("sites").alias("place", "s")).withColumn(
        "position", (F.col("page") - 1) * vocab.DIRECTORY_PAGE + F.col("place")
    )
    return longs(rows.select("company_slug", "position", "s.*"), "position")


@query(
    "site_siblings",
    with_base(
        "SELECT company_slug, site_id, rank, sibling_id, sibling_count FROM ("
        "SELECT a.company_slug, a.site_id, b.site_id AS sibling_id, b.count AS sibling_count, "
        "row_number() OVER (PARTITION BY a.company_slug, a.site_id ORDER BY b.count DESC, b.site_id) AS rank "
        "FROM counted a JOIN counted b ON a.company_slug = b.company_slug AND a.site_id <> b.site_id) "
        "WHERE rank <= 10",
        _SITES_SQL,
    ),
)
def site_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = sites.siblings(sites.company_sites(views.latest(spark, sf_dir)))
    return longs(pairs, "rank")


@query(
    "company_states",
    with_base(
        "SELECT DISTINCT company_slug, state FROM silver "
        "WHERE company_slug IS NOT NULL AND state IS NOT NULL"
    ),
)
def company_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = sites.company_states(_cube(spark, sf_dir))
    return lists.select("company_slug", F.explode("states").alias("state"))
