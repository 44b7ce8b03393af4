"""Documents as a table, page URLs, narratives and the streaming path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import schemas, session, vocab
from casebook.functions import dates
from casebook.operators import documents, merge, narrative, rollup, sitemap
from casebook.plans import views
from casebook.plans.queries_rollup import STAMPED, as_of
from casebook.plans.views import longs, query, table, with_base
from casebook.sources import named_files, tables
from casebook.streaming import intake

_BASE_URL = "https://example.org"


def _documents(spark: SparkSession, sf_dir: str, *levels: str) -> DataFrame:
    events = session.stored(rollup.shown_events(views.latest(spark, sf_dir)), "shown-events")
    cube, recents = rollup.event_cube(events), rollup.recent_candidates(events)
    gold = {
        "state": lambda: rollup.state_gold(cube, recents),
        "city": lambda: rollup.city_gold(cube, recents),
        "company": lambda: rollup.company_gold(cube, recents),
        "site": lambda: rollup.site_gold(
            rollup.event_cube(events, rollup.FINE_CELL), rollup.recent_candidates(events, cell=rollup.FINE_CELL)
        ),
    }
    return documents.serving_table(
        {n: documents.BUILDERS[n](gold[n](), F.lit(STAMPED)) for n in levels}
    )


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document keys of every level, straight from the events' own keys."""
    rows = views.latest(spark, sf_dir).select("state", "city_slug", "company_slug", "site_id")
    keys = F.array(
        F.concat(F.lit("STATE#"), "state"), F.concat(F.lit("CITY#"), "city_slug"),
        F.concat(F.lit("COMPANY#"), "company_slug"),
        F.concat(F.lit("SITE#"), "company_slug", F.lit("_"), "site_id"),
        F.lit(documents.NATION_KEY),
    )
    pairs = rows.select(F.explode(F.array_compact(keys)).alias("PK")).distinct()
    return pairs.withColumn("SK", F.lit(documents.SUMMARY))


_KEYS_SQL = """keys AS (SELECT DISTINCT pk FROM (
  SELECT 'STATE#' || state AS pk FROM silver UNION ALL SELECT 'CITY#' || city_slug FROM silver
  UNION ALL SELECT 'COMPANY#' || company_slug FROM silver
  UNION ALL SELECT 'SITE#' || company_slug || '_' || site_id FROM silver
  UNION ALL SELECT 'NATION#USA') WHERE pk IS NOT NULL)"""
_URLS_SQL = """urls AS (SELECT pk, CASE kind WHEN 'STATE' THEN 'states' WHEN 'CITY' THEN 'cities'
    WHEN 'COMPANY' THEN 'companies' ELSE 'sites' END AS stem,
    'https://example.org/' || lower(kind) || '/' || substr(pk, length(kind) + 2) AS url
  FROM (SELECT pk, string_split(pk, '#')[1] AS kind FROM keys) WHERE kind <> 'NATION')"""


@query(
    "document_keys",
    with_base("SELECT pk AS \"PK\" FROM keys", _KEYS_SQL),
)
def document_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.document_keys(_keys(spark, sf_dir))


@query(
    "document_lookup",
    with_base(
        "SELECT 'STATE#BB' AS pk, 'state' AS level, 'Bb' AS name, count(*)::VARCHAR AS total_events, "
        "count(DISTINCT city_slug)::VARCHAR AS total_cities FROM silver WHERE state = 'BB' HAVING count(*) > 0"
    ),
)
def document_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables.find_document(_documents(spark, sf_dir, "state", "company"), "STATE#BB")
    field = lambda p: F.get_json_object("document", p)
    return found.select(
        F.col("PK").alias("pk"), "level", field("$.name").alias("name"),
        field("$.stats.totalEvents").alias("total_events"),
        field("$.stats.totalCities").alias("total_cities"),
    )


@query(
    "serving_upsert",
    with_base(
        "SELECT pk, CASE WHEN starts_with(pk, 'STATE#') OR starts_with(pk, 'NATION#') THEN 'changed' ELSE 'current' END "
        "AS document, CASE WHEN starts_with(pk, 'STATE#') OR starts_with(pk, 'NATION#') THEN '2' ELSE '1' END "
        "AS updated_at FROM keys UNION ALL SELECT 'STATE#' || n_name, 'changed', '2' FROM nation",
        _KEYS_SQL,
    ),
)
def serving_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed state documents over the current table; new ones are added."""
    current = _keys(spark, sf_dir).withColumns({"document": F.lit("current"), "updatedAt": F.lit("1")})
    again = current.where(~F.col("PK").rlike("^(CITY|COMPANY|SITE)#")).select("PK", "SK")
    fresh = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("STATE#"), "n_name").alias("PK"), F.lit(documents.SUMMARY).alias("SK")
    )
    changed = again.unionByName(fresh).withColumns(
        {"document": F.lit("changed"), "updatedAt": F.lit("2")}
    )
    kept = tables.upsert_documents(current, changed)
    return kept.select(F.col("PK").alias("pk"), "document", F.col("updatedAt").alias("updated_at"))


@query(
    "level_of_path",
    """SELECT path, CASE WHEN contains(path, '/nation/') THEN 'nation' WHEN contains(path, '/states/') THEN 'state'
        WHEN contains(path, '/cities/') THEN 'city' WHEN contains(path, '/companies/') THEN 'company'
        WHEN contains(path, '/sites/') THEN 'site' END AS level
      FROM (SELECT 'coast/' || CASE o_orderkey % 6 WHEN 0 THEN 'nation' WHEN 1 THEN 'states' WHEN 2 THEN 'cities'
        WHEN 3 THEN 'companies' WHEN 4 THEN 'sites' ELSE 'other' END || '/part-' || o_orderkey AS path FROM orders)""",
)
def level_of_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = F.element_at(
        F.array(*[F.lit(f) for f in (*tables.GOLD_FOLDERS.values(), "other")]),
        (F.col("o_orderkey") % 6 + 1).cast("int"),
    )
    path = F.concat(F.lit("coast/"), folder, F.lit("/part-"), F.col("o_orderkey").cast("string"))
    rows = table(spark, sf_dir, "orders").select(path.alias("path"))
    return rows.withColumn("level", tables.level_of_path(F.col("path")))


@query(
    "empty_lists",
    """SELECT 'CITY#XX-' || n_nationkey AS pk, CASE WHEN n_nationkey % 3 = 0 THEN 0 ELSE 1 END::BIGINT AS sources,
      CASE WHEN n_nationkey % 3 = 0 THEN NULL WHEN n_nationkey % 2 = 1 THEN 'id-' || n_nationkey
        ELSE substr(sha256('city-2001-02-03--firm-' || n_regionkey || '-0'), 1, 16) END AS event_id,
      CASE WHEN n_nationkey % 3 = 0 THEN NULL WHEN n_nationkey % 2 = 1 THEN n_name ELSE 'Unknown Event' END AS title
      FROM nation""",
)
def empty_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities whose gold has a source without events, or none at all, and events without
    id and title: empty lists are dropped, such events get an id of their own and a title."""
    key = F.col("n_nationkey").cast("string")
    given = F.col("n_nationkey") % 2 == 1
    fields = {
        "eventId": F.when(given, F.concat(F.lit("id-"), key)), "eventTitle": F.when(given, F.col("n_name")).otherwise(""),
        "eventDate": F.lit("2001-02-03"), "companySlug": F.concat(F.lit("firm-"), F.col("n_regionkey").cast("string")),
    }
    kinds = schemas.GOLD["city"]
    lists = kinds["recentByEventSource"].dataType
    event = F.struct(*[fields.get(n, F.lit(None).cast("string")).alias(n) for n in lists.valueType.elementType.fieldNames()])
    full = F.when(F.col("n_nationkey") % 3 == 0, F.array().cast(lists.valueType)).otherwise(F.array(event))
    values = {
        "city_slug": F.concat(F.lit("XX-"), key), "city": F.col("n_name"), "state": F.lit("XX"),
        "companies_directory": F.array(), "total_events": F.lit(1), "total_companies": F.lit(0),
        "recentByEventSource": F.create_map(F.lit("OSHA"), full, F.lit("EPA"), F.array().cast(lists.valueType)),
    }
    gold = table(spark, sf_dir, "nation").select(*[values[f.name].cast(f.dataType).alias(f.name) for f in kinds.fields])
    docs = documents.city_documents(gold, F.lit(STAMPED))
    first = F.try_element_at(F.try_element_at("recentByAgency", F.lit("OSHA")), F.lit(1))
    return docs.select(
        F.col("PK").alias("pk"), F.size("recentByAgency").cast("bigint").alias("sources"),
        first["eventId"].alias("event_id"), first["eventTitle"].alias("title"),
    )


# --- Sitemap -----------------------------------------------------------------


@query("page_urls", with_base("SELECT stem, url FROM urls", _KEYS_SQL, _URLS_SQL))
def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitemap.urls(tables.document_keys(_keys(spark, sf_dir)), _BASE_URL)


_CHUNKS_SQL = (
    "chunks AS (SELECT stem, url, md5(url) AS digest, (row_number() OVER (PARTITION BY stem ORDER BY md5(url)) - 1) "
    "// 100 + 1 AS chunk FROM urls)"
)


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitemap.chunked(page_urls(spark, sf_dir), 100)


@query("sitemap_chunks", with_base("SELECT stem, url, digest, chunk FROM chunks", _KEYS_SQL, _URLS_SQL, _CHUNKS_SQL))
def sitemap_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(_chunks(spark, sf_dir), "chunk")


_FILES_SQL = """files AS (SELECT stem || CASE WHEN chunk > 1 THEN '-' || chunk ELSE '' END || '.xml' AS file, count(*) AS urls,
  '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) ||
  '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">' || chr(10) || string_agg('<url><loc>' || url ||
  '</loc><lastmod>2001-12-31</lastmod><changefreq>weekly</changefreq></url>', chr(10) ORDER BY digest)
  || chr(10) || '</urlset>' AS value FROM chunks GROUP BY stem, chunk)"""


@query("sitemap_files", with_base("SELECT * FROM files", _KEYS_SQL, _URLS_SQL, _CHUNKS_SQL, _FILES_SQL))
def sitemap_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitemap.sitemap_files(_chunks(spark, sf_dir), as_of())


@query(
    "sitemap_index",
    with_base(
        """SELECT 'sitemap.xml' AS file, '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) ||
          '<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">' || chr(10) ||
          string_agg('<sitemap><loc>https://example.org/sitemaps/' || file || '</loc><lastmod>2001-12-31</lastmod></sitemap>',
          chr(10) ORDER BY '<sitemap><loc>https://example.org/sitemaps/' || file || '</loc>') || chr(10) || '</sitemapindex>' AS value FROM files""",
        _KEYS_SQL, _URLS_SQL, _CHUNKS_SQL, _FILES_SQL,
    ),
)
def sitemap_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitemap.sitemap_index(sitemap_files(spark, sf_dir), _BASE_URL, as_of())


@query("sitemap_written", with_base("SELECT file, value FROM files", _KEYS_SQL, _URLS_SQL, _CHUNKS_SQL, _FILES_SQL))
def sitemap_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and index written under their names, then each file read where the index says,
    after an earlier run that left another file."""
    root = session.scratch_path(spark, "site")
    named_files.write(spark.createDataFrame([("sitemaps/old-9.xml", "old")], "file string, value string"), root)
    files = session.stored(sitemap_files(spark, sf_dir), "sitemap-files")
    named_files.write(sitemap.published(files, sitemap.sitemap_index(files, _BASE_URL, as_of())), root)
    index = spark.read.text(f"{root}/sitemap.xml", wholetext=True)
    named = index.select(F.explode(F.regexp_extract_all("value", F.lit(f"<loc>{_BASE_URL}/([^<]*)</loc>"), 1)).alias("path"))
    there = spark.read.text(f"{root}/sitemaps", wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), "value"
    )
    return there.join(named.select(F.element_at(F.split("path", "/"), -1).alias("file"), "path"), "file", "full").select(
        F.coalesce("file", "path").alias("file"), F.when(F.col("path").isNotNull(), F.col("value")).alias("value")
    )


@query("sitemap_file_names", with_base("SELECT file FROM files", _KEYS_SQL, _URLS_SQL, _CHUNKS_SQL, _FILES_SQL))
def sitemap_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitemap.file_names(page_urls(spark, sf_dir), 100)


@query("sitemap_totals", with_base("SELECT stem, count(*) AS urls, max(chunk) AS files FROM chunks GROUP BY 1", _KEYS_SQL, _URLS_SQL, _CHUNKS_SQL))
def sitemap_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _chunks(spark, sf_dir).groupBy("stem").agg(
        F.count("*").alias("urls"), F.max("chunk").alias("files")
    )
    return longs(totals, "files")


# --- Narratives --------------------------------------------------------------


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_FACTS_SQL = """'{' || chr(10) || '  "id": "' || event_id || '",' || chr(10) || '  "oshaId": "' || event_id || '",' || chr(10)
  || '  "eventDate": "' || strftime(event_date, '%Y-%m-%d %H:%M:%S') || '",' || chr(10)
  || '  "violationType": "' || violation_type || '",' || chr(10) || '  "location": {' || chr(10)
  || '    "city": "' || coalesce(city, '') || '",' || chr(10) || '    "state": "' || coalesce(state, '') || '"' || chr(10)
  || '  },' || chr(10) || '  "establishment": {' || chr(10) || '    "name": "' || company_name || '",' || chr(10)
  || '    "naics": "' || naics || '"' || chr(10) || '  },' || chr(10) || '  "injury": {' || chr(10)
  || '    "hospitalized": ' || hospitalized || ',' || chr(10) || '    "amputation": ' || amputation || ',' || chr(10)
  || '    "lossOfEye": 0,' || chr(10) || '    "narrative": "' || event_description || '",' || chr(10)
  || '    "nature": "",' || chr(10) || '    "bodyPart": "",' || chr(10) || '    "event": "",' || chr(10)
  || '    "source": ""' || chr(10) || '  }' || chr(10) || '}'"""


@query(
    "prompt_requests",
    with_base(
        f"""SELECT md5({_quoted(vocab.NARRATIVE_REQUEST_HEAD)} || {_FACTS_SQL} || {_quoted(vocab.NARRATIVE_REQUEST_TAIL)}) AS user_md5,
          event_id, event_id AS id, {views.sql_stamp('event_date')} AS event_date, violation_type,
          coalesce(city, '') AS city, coalesce(state, '') AS state, company_name AS name, naics::VARCHAR AS naics,
          hospitalized::BIGINT AS hospitalized, amputation::BIGINT AS amputation, 0::BIGINT AS loss_of_eye,
          event_description AS narrative, '' AS nature, 2::BIGINT AS messages, 'system,user' AS roles FROM silver"""
    ),
)
def prompt_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.latest(spark, sf_dir)
    asked = narrative.requests(rows.withColumn("event_date", dates.stamp(F.col("event_date"))))
    p = F.col("payload")
    return asked.select(
        "event_id", p["id"].alias("id"), p["eventDate"].alias("event_date"),
        p["violationType"].alias("violation_type"), p["location"]["city"].alias("city"),
        p["location"]["state"].alias("state"), p["establishment"]["name"].alias("name"),
        p["establishment"]["naics"].alias("naics"), p["injury"]["hospitalized"].alias("hospitalized"),
        p["injury"]["amputation"].alias("amputation"), p["injury"]["lossOfEye"].alias("loss_of_eye"),
        p["injury"]["narrative"].alias("narrative"), p["injury"]["nature"].alias("nature"),
        F.size("messages").cast("bigint").alias("messages"),
        F.array_join(F.col("messages.role"), ",").alias("roles"),
        F.md5(F.col("messages")[1]["content"].cast("binary")).alias("user_md5"),
    )


def _replies(rows: DataFrame) -> DataFrame:
    """Replies made from the events: some lack a part or are too long."""
    number = F.substring_index("event_id", "-", -1).cast("int")
    points = F.transform(F.sequence(F.lit(1), number), lambda i: i.cast("string"))
    reply = F.struct(
        F.when(number == 6, F.repeat("event_title", 9)).otherwise(F.col("event_title")).alias("title"),
        F.concat(F.lit("About "), "company_name").alias("explanation"),
        F.when(F.col("city").isNotNull(), F.lit("low")).alias("riskAssessment"),
        points.alias("keyPoints"),
    )
    text = F.when(F.col("state") == "AA", "not json").otherwise(F.to_json(reply))
    return rows.select("event_id", text.alias("reply"))


_REPLIES_SQL = """replies AS (SELECT event_id, state, string_split(event_id, '-')[2]::INT AS n, city,
    event_title AS title, 'About ' || company_name AS explanation FROM silver),
  valid AS (SELECT event_id, CASE WHEN state <> 'AA' THEN title END AS title,
    CASE WHEN state <> 'AA' THEN explanation END AS explanation,
    state <> 'AA' AND city IS NOT NULL AND n BETWEEN 3 AND 5 AS is_valid, n, state FROM replies)"""


@query(
    "reply_check",
    with_base(
        "SELECT event_id, CASE WHEN state = 'AA' THEN NULL WHEN n = 6 THEN repeat(title, 9) ELSE title END AS title, "
        "CASE WHEN state <> 'AA' THEN n END AS points, is_valid FROM valid",
        _REPLIES_SQL,
    ),
)
def reply_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = narrative.check_replies(_replies(views.latest(spark, sf_dir)))
    return checked.select("event_id", "title", F.size("keyPoints").alias("points"), "is_valid")


@query(
    "enriched_events",
    with_base(
        "SELECT s.event_id, CASE WHEN is_valid THEN v.title ELSE s.bedrock_event_title END AS bedrock_event_title, "
        "CASE WHEN is_valid THEN v.explanation ELSE s.bedrock_event_description END AS bedrock_event_description, "
        "is_valid OR bedrock_verified AS bedrock_verified FROM silver s JOIN valid v ON s.event_id = v.event_id",
        _REPLIES_SQL,
    ),
)
def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.latest(spark, sf_dir)
    filled = narrative.enrich(rows, narrative.check_replies(_replies(rows)))
    return filled.select(
        "event_id", "bedrock_event_title", "bedrock_event_description", "bedrock_verified"
    )


# --- Streaming ---------------------------------------------------------------


def event_rows(rows: DataFrame) -> DataFrame:
    """The events table as bronze rows: a user and a day name one event."""
    user, day = F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")
    own = {
        "event_id": F.concat_ws("-", user, day), "ingested_at": dates.iso_millis(F.col("ts")),
        "event_source": F.upper("event_type"), "event_date": day, "state": F.lit("TN"),
        "event_title": F.concat(F.col("event_type"), F.lit(" "), F.col("event_id").cast("string")),
        "event_details": F.col("props"), "raw_data": F.col("props"),
        "bedrock_verified": F.lit(False), "partition_source": F.upper("event_type"),
        "partition_year": F.date_format("ts", "yyyy"),
    }
    return rows.select(
        *[own.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.BRONZE.fields]
    )


@query(
    "stream_equals_batch",
    """SELECT event_source, event_date, count(*) AS events, count(DISTINCT event_id) AS ids, max(event_title) AS last_title
      FROM (SELECT upper(event_type) AS event_source, strftime(ts, '%Y-%m-%d') AS event_date,
        user_id || '-' || strftime(ts, '%Y-%m-%d') AS event_id, event_type || ' ' || event_id AS event_title,
        row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d') ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S.%g') DESC,
          upper(event_type)) AS rn FROM events) WHERE rn = 1 GROUP BY 1, 2""",
)
def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream, upserted batch by batch, then counted."""
    root = session.scratch_path(spark, "stream")
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parquet*")

    def upsert(rows: DataFrame, batch_id: int) -> None:
        merge.merge_into_silver(
            rows.sparkSession, merge.bronze_to_silver(event_rows(rows)), f"{root}/silver",
            f"upsert-{batch_id}",
        )

    intake.run(stream, upsert, f"{root}/checkpoint", once=True)
    silver = merge.read_silver(spark, f"{root}/silver")
    return silver.groupBy("event_source", F.date_format("event_date", "yyyy-MM-dd").alias("event_date")).agg(
        F.count("*").alias("events"), F.count_distinct("event_id").alias("ids"),
        F.max("event_title").alias("last_title"),
    )
