"""Reports, facets, rankings and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import session
from casebook.functions import dates
from casebook.operators import documents, insights, rollup, search
from casebook.plans import views
from casebook.plans.queries_rollup import STAMPED, as_of
from casebook.plans.views import longs, query, sql_stamp, table, with_base

_DAY_SQL = "TIMESTAMP '2001-12-31'"


@query(
    "state_summary",
    with_base(
        "SELECT state, count(*) AS total_events, count(DISTINCT company_slug) AS total_companies, "
        "count(DISTINCT city_slug) AS total_cities FROM silver WHERE state = 'BB' GROUP BY state"
    ),
)
def state_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.state_summary(insights.only_state(views.latest(spark, sf_dir), "BB"))


def _top_sql(*keys: str) -> str:
    names = ", ".join([*keys, "company_slug"])
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    where = " AND ".join(f"{k} IS NOT NULL" for k in [*keys, "company_slug"])
    return with_base(
        f"SELECT * FROM (SELECT *, row_number() OVER ({part}ORDER BY event_count DESC, company_slug) AS rank "
        f"FROM (SELECT {names}, count(*) AS event_count FROM silver WHERE {where} GROUP BY {names})) WHERE rank <= 10"
    )


@query("top_companies_by_state", _top_sql("state"))
def top_companies_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(insights.top_companies(views.latest(spark, sf_dir)), "rank")


@query("top_companies_by_city", _top_sql("city_slug"))
def top_companies_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(insights.top_companies(views.latest(spark, sf_dir), ("city_slug",)), "rank")


@query("top_companies_nation", _top_sql())
def top_companies_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(insights.top_companies(views.latest(spark, sf_dir), ()), "rank")


@query(
    "company_state_counts",
    with_base(
        "SELECT state, company_slug, count(*) AS events FROM silver "
        "WHERE state IS NOT NULL AND company_slug IS NOT NULL GROUP BY 1, 2"
    ),
)
def company_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = rollup.event_cube(views.latest(spark, sf_dir), ("state", "company_slug"))
    known = cube.where("state is not null and company_slug is not null")
    return known.groupBy("state", "company_slug").agg(F.sum("events").alias("events"))


@query(
    "recent20_by_state",
    with_base(
        f"SELECT state, rank, event_id, event_title, {sql_stamp('event_date')} AS event_date, company_slug, city "
        "FROM (SELECT *, row_number() OVER (PARTITION BY state ORDER BY event_date DESC, event_id) AS rank "
        "FROM silver WHERE state IS NOT NULL) WHERE rank <= 20"
    ),
)
def recent20_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = insights.recent_in_state(views.latest(spark, sf_dir))
    picked = rows.select(
        "state", "rank", "event_id", "event_title",
        dates.stamp(F.col("event_date")).alias("event_date"), "company_slug", "city",
    )
    return longs(picked, "rank")


@query(
    "trend_12m",
    with_base(
        f"""SELECT state, a AS last_12m, b AS previous_12m,
          CASE WHEN a > b THEN 'up' WHEN a < b THEN 'down' ELSE 'flat' END AS direction,
          CASE WHEN b > 0 THEN ((abs(a - b) * 200 + b) // (b * 2))::BIGINT END AS percentage FROM (
          SELECT state, count(*) FILTER (WHERE event_date >= {_DAY_SQL} - INTERVAL 12 MONTH) AS a,
            count(*) FILTER (WHERE event_date < {_DAY_SQL} - INTERVAL 12 MONTH) AS b FROM silver
          WHERE event_date >= {_DAY_SQL} - INTERVAL 24 MONTH AND event_date < {_DAY_SQL} GROUP BY state)"""
    ),
)
def trend_12m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.trend(views.latest(spark, sf_dir), ["state"], as_of())


@query(
    "severity_stats",
    with_base(
        "SELECT state, count(*) AS total_events, (sum(hospitalized) + sum(amputation))::DOUBLE AS total_injuries, "
        "sum(deaths)::DOUBLE AS total_fatalities, sum(hospitalized)::DOUBLE AS total_hospitalisations, "
        "NULL::DOUBLE AS total_fines, NULL::DOUBLE AS avg_fines FROM silver GROUP BY state"
    ),
)
def severity_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.severity_stats(views.latest(spark, sf_dir), ["state"])


@query(
    "safety_score",
    with_base(
        "SELECT company_slug, site_id, greatest(0.0, least(100.0, 100.0 - (5.0 * sum(deaths) + "
        "2.0 * sum(hospitalized) + 0.5 * count(*))))::DOUBLE AS score FROM silver GROUP BY company_slug, site_id"
    ),
)
def safety_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = insights.safety_scores(views.latest(spark, sf_dir), ["company_slug", "site_id"])
    return scores.select("company_slug", "site_id", "score")


_FACETS = {"fatalities": "deaths", "hospitalizations": "hospitalized", "amputations": "amputation"}


@query(
    "severity_facet",
    with_base(
        " UNION ALL ".join(
            f"SELECT '{name}' AS severity, event_source, count(*) AS events FROM silver WHERE {column} > 0 GROUP BY 2"
            for name, column in _FACETS.items()
        )
    ),
)
def severity_facet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = insights.severity_facets(views.latest(spark, sf_dir))
    return rows.groupBy("severity", "event_source").agg(F.count("*").alias("events"))


@query(
    "severity_only_amputations",
    with_base("SELECT event_id, company_slug, site_id FROM silver WHERE amputation > 0"),
)
def severity_only_amputations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = insights.severity_filter(views.latest(spark, sf_dir), "amputations")
    return rows.select("event_id", "company_slug", "site_id")


@query(
    "date_range_facet",
    with_base(
        " UNION ALL ".join(
            f"SELECT '{label}' AS range, state, count(*) AS events FROM silver WHERE "
            + (f"event_date >= {_DAY_SQL} - INTERVAL {years} YEAR" if years else "true")
            + " GROUP BY 2"
            for label, years in (("all", None), ("1", 1), ("5", 5), ("10", 10))
        )
    ),
)
def date_range_facet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = insights.range_facets(views.latest(spark, sf_dir), as_of())
    return rows.groupBy("range", "state").agg(F.count("*").alias("events"))


@query(
    "last_year_events",
    with_base(f"SELECT event_id, state FROM silver WHERE event_date >= {_DAY_SQL} - INTERVAL 1 YEAR"),
)
def last_year_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = insights.since_years(views.latest(spark, sf_dir), as_of(), 1)
    return rows.select("event_id", "state")


_CITY_DIRECTORY_SQL = (
    "listed AS (SELECT state, city_slug AS slug, max(city) AS name, count(*) AS count FROM silver "
    "WHERE state IS NOT NULL AND city_slug IS NOT NULL GROUP BY 1, 2)"
)


def _city_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.directory(rollup.event_cube(views.latest(spark, sf_dir)), rollup.STATE)


@query(
    "directory_search",
    with_base("SELECT * FROM listed WHERE contains(lower(name), 'build')", _CITY_DIRECTORY_SQL),
)
def directory_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.directory_search(_city_directory(spark, sf_dir), "Build")


_SEARCHED = ("Build", "ing", "G", "n ", "", "g 1", "zzz", "no such place")
_SEARCHED_SQL = ", ".join(f"('{t}')" for t in _SEARCHED)


@query(
    "directory_search_indexed",
    with_base(
        f"SELECT text, listed.* FROM listed JOIN (VALUES {_SEARCHED_SQL}) t(text) ON contains(lower(name), lower(text))",
        _CITY_DIRECTORY_SQL,
    ),
)
def directory_search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several texts, short ones and an empty one included, looked up in the index."""
    path = session.scratch_path(spark, "names")
    search.write_index(_city_directory(spark, sf_dir), path)
    return search.search(spark, path, _SEARCHED)


@query(
    "directory_all_pages",
    with_base(
        "SELECT city_slug, (rank - 1) // 30 + 1 AS page, (rank - 1) % 30 AS place, slug, name, count FROM ("
        "SELECT *, row_number() OVER (PARTITION BY city_slug ORDER BY count DESC, slug) AS rank FROM ("
        "SELECT city_slug, company_slug AS slug, max(company_name) AS name, count(*) AS count FROM silver "
        "WHERE city_slug IS NOT NULL AND company_slug IS NOT NULL GROUP BY 1, 2))",
    ),
)
def directory_all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every company of every city, page after page."""
    listed = rollup.directory(rollup.event_cube(views.latest(spark, sf_dir)), rollup.CITY)
    pages = insights.directory_pages(listed.drop("state"), ["city_slug"])
    rows = pages.select("city_slug", "page", F.posexplode("items").alias("place", "item"))
    return longs(rows.select("city_slug", "page", "place", "item.*"), "page", "place")


@query(
    "directory_page",
    with_base(
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY state ORDER BY count DESC, slug) AS rank "
        "FROM listed) WHERE rank <= 7",
        _CITY_DIRECTORY_SQL,
    ),
)
def directory_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(insights.directory_page(_city_directory(spark, sf_dir), ["state"], 7), "rank")


@query(
    "directory_orderings",
    with_base(
        " UNION ALL ".join(
            f"SELECT '{name}' AS ordering, rank, slug FROM (SELECT slug, row_number() OVER (ORDER BY {order}) AS rank "
            "FROM companies) WHERE rank <= 30"
            for name, order in (
                ("most_incidents", "count DESC, slug"), ("most_recent", "last_date DESC, slug"),
                ("highest_fines", "slug"), ("alphabetical", "name, slug"),
            )
        ),
        "companies AS (SELECT company_slug AS slug, max(company_name) AS name, count(*) AS count, "
        "max(event_date) AS last_date FROM silver WHERE company_slug IS NOT NULL GROUP BY 1)",
    ),
)
def directory_orderings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # All orders rank one stored list.
    listed = session.stored(insights.company_directory(views.latest(spark, sf_dir)), "company-directory")
    out = None
    for name, order in insights.ORDERINGS.items():
        top = rollup.ranked(listed, [], order(), 30).select(
            F.lit(name).alias("ordering"), F.col("rank").cast("bigint").alias("rank"), "slug"
        )
        out = top if out is None else out.unionByName(top)
    return out


@query(
    "directory_enriched",
    with_base(
        "SELECT d.city_slug, d.slug, d.name, d.count, industry AS subtitle FROM ("
        "SELECT city_slug, company_slug AS slug, max(company_name) AS name, count(*) AS count FROM silver "
        "WHERE city_slug IS NOT NULL AND company_slug IS NOT NULL GROUP BY 1, 2) d LEFT JOIN ("
        "SELECT replace(p_name, ' ', '-') AS slug, max(p_type) AS industry FROM part GROUP BY 1) i ON d.slug = i.slug"
    ),
)
def directory_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = rollup.directory(rollup.event_cube(views.latest(spark, sf_dir)), rollup.CITY)
    slug = F.replace("p_name", F.lit(" "), F.lit("-"))
    industries = table(spark, sf_dir, "part").groupBy(slug.alias("company_slug")).agg(
        F.max("p_type").alias("industry")
    )
    return insights.with_subtitle(listed, industries, "company_slug", "industry").select(
        "city_slug", "slug", "name", "count", "subtitle"
    )


@query(
    "documents_with_meta",
    with_base(
        "SELECT 'CITY#' || city_slug AS pk, customers, segment, md5(list) AS directory_md5 FROM ("
        "SELECT city_slug, string_agg(slug || '=' || coalesce(industry, ''), ';' ORDER BY count DESC, slug) AS list FROM ("
        "SELECT city_slug, company_slug AS slug, count(*) AS count FROM silver WHERE city_slug IS NOT NULL GROUP BY 1, 2) "
        "LEFT JOIN (SELECT replace(p_name, ' ', '-') AS slug, max(p_type) AS industry FROM part "
        "WHERE NOT starts_with(p_name, 'b') GROUP BY 1) USING (slug) GROUP BY 1) "
        "LEFT JOIN (SELECT city_slug, count(*) AS customers, max(c_mktsegment) AS segment FROM ("
        "SELECT chr(65 + n_nationkey) || chr(65 + n_regionkey) || '-' || replace(lower(c_mktsegment), ' ', '_') || '_' "
        "|| c_custkey % 4 AS city_slug, c_custkey % 4 AS number, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey) "
        "WHERE number <> 3 GROUP BY 1) USING (city_slug)"
    ),
)
def documents_with_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City documents that tell of their customers, companies with their industry; some
    cities and companies are in no dimension."""
    events = session.stored(rollup.shown_events(views.latest(spark, sf_dir)), "shown-events")
    gold = rollup.city_gold(rollup.event_cube(events), rollup.recent_candidates(events))
    known = views.customer_places(spark, sf_dir).where(~F.col("city").endswith(" 3"))
    cities = known.groupBy(F.col("city_slug").alias("slug")).agg(
        F.count("*").alias("customers"), F.max(F.substring_index("city", " ", 1)).alias("segment")
    )
    parts = table(spark, sf_dir, "part").where(~F.col("p_name").startswith("b"))
    industries = parts.select(F.replace("p_name", F.lit(" "), F.lit("-")).alias("slug"), F.col("p_type").alias("subtitle"))
    facts = documents.Facts({"city": cities}, {"city": industries})
    docs = facts.told(documents.city_documents(gold, F.lit(STAMPED)), "city")
    served = documents.serving_table({"city": docs}).withColumn("d", F.from_json(
        "document", "meta struct<customers: bigint, segment: string>, directory array<struct<slug: string, subtitle: string>>"
    ))
    listed = F.transform("d.directory", lambda i: F.concat(i["slug"], F.lit("="), F.coalesce(i["subtitle"], F.lit(""))))
    return served.select(
        F.col("PK").alias("pk"), "d.meta.customers", "d.meta.segment",
        F.md5(F.array_join(listed, ";").cast("binary")).alias("directory_md5"),
    )


@query(
    "company_recents",
    with_base(
        f"SELECT event_id, event_source, {sql_stamp('event_date')} AS event_date FROM silver "
        "WHERE company_slug = 'blue-anvil' AND event_source = 'FDA' ORDER BY silver.event_date DESC, event_id LIMIT 10"
    ),
)
def company_recents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = insights.company_recents(views.latest(spark, sf_dir), "blue-anvil", "FDA")
    return rows.select("event_id", "event_source", dates.stamp(F.col("event_date")).alias("event_date"))
