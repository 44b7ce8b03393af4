"""Ingest, dimensions, aliases and resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import schemas, session, vocab
from casebook.operators import dimensions, ingest, resolve
from casebook.plans import views
from casebook.plans.queries_functions import RAW_LISTING_SQL, raw_listings
from casebook.plans.views import query, table
from casebook.sources import landing

# --- Landing paths -----------------------------------------------------------


@query(
    "path_routing",
    """WITH keys AS (SELECT o_orderkey, CASE o_orderkey % 8
        WHEN 0 THEN 'estuary/OSHA/severe-incident/' || o_orderkey || '.csv'
        WHEN 1 THEN 'confluence/FDA/recalls/' || o_orderpriority || '/' || o_orderkey || '.csv'
        WHEN 2 THEN 'Historical/OSHA/' || o_orderkey || '.csv'
        WHEN 3 THEN 'reef/partition_source=OSHA/' || o_orderkey || '.csv'
        WHEN 4 THEN 'estuary/OSHA/ita/' || o_orderkey || '.json'
        WHEN 5 THEN 'uploads/' || o_orderkey || '.csv'
        WHEN 6 THEN 'Daily//ita/' || o_orderkey || '.txt'
        ELSE 'estuary/OSHA/ita/' || o_orderkey || '.parquet' END AS key FROM orders),
      cut AS (SELECT *, string_split(key, '/') AS p,
        string_split(key, '/')[1] IN ('estuary', 'confluence', 'Historical', 'Daily') AS rooted FROM keys)
      SELECT key, coalesce(CASE WHEN rooted THEN nullif(p[2], '') END, 'unknown') AS source,
        coalesce(CASE WHEN rooted THEN nullif(p[3], '') END, 'generic') AS dataset,
        NOT (starts_with(key, 'reef/') OR ends_with(key, '.parquet') OR ends_with(key, '.json')) AS admitted,
        starts_with(key, 'estuary/') AS notified FROM cut""",
)
def path_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("o_orderkey")
    name = order.cast("string")
    shapes = (
        ("estuary/OSHA/severe-incident/", name, ".csv"),
        ("confluence/FDA/recalls/", F.concat("o_orderpriority", F.lit("/"), name), ".csv"),
        ("Historical/OSHA/", name, ".csv"), ("reef/partition_source=OSHA/", name, ".csv"),
        ("estuary/OSHA/ita/", name, ".json"), ("uploads/", name, ".csv"),
        ("Daily//ita/", name, ".txt"), ("estuary/OSHA/ita/", name, ".parquet"),
    )
    key = F.coalesce(
        *[
            F.when(order % len(shapes) == i, F.concat(F.lit(head), mid, F.lit(tail)))
            for i, (head, mid, tail) in enumerate(shapes)
        ]
    )
    keyed = table(spark, sf_dir, "orders").select(key.alias("key"))
    return keyed.select(
        "key", landing.route(F.col("key")).alias("r"),
        landing.is_admitted(F.col("key")).alias("admitted"),
        landing.is_notified(F.col("key")).alias("notified"),
    ).select("key", "r.*", "admitted", "notified")


# --- Ingest ------------------------------------------------------------------

_HEADER = (
    "ID", "EventDate", "Employer", "Address1", "Address2", "City", "State", "Nature",
    "Hospitalized", "Final Narrative", "Unmapped",
)
_DATASET = ("OSHA", "severe-incident")

_CELLS_SQL = """cells AS (
  SELECT o_orderkey::VARCHAR AS c0, strftime(o_orderdate, '%Y-%m-%d') AS c1,
    c_mktsegment || CASE WHEN o_orderkey % 2 = 0 THEN ' Inc #' || c_custkey ELSE ' Corp' END AS c2,
    '' AS c3, o_orderpriority AS c4,
    CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'Pt ' || lower(c_mktsegment) END AS c5,
    CASE WHEN o_orderkey % 11 = 0 THEN 'on' ELSE lower(chr(65 + n_nationkey) || chr(65 + n_regionkey)) END AS c6,
    o_orderstatus AS c7, (o_orderkey % 3)::VARCHAR AS c8,
    CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'Order of ' || c_name END AS c9, 'x' AS c10,
    'estuary/OSHA/severe-incident/' || o_orderpriority || '.csv' AS key
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


def _landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of a raw file: positional text cells and the file's key."""
    orders = table(spark, sf_dir, "orders").repartition("o_orderkey")
    rows = (
        orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    order = F.col("o_orderkey")
    tail = F.when(order % 2 == 0, F.concat(F.lit(" Inc #"), F.col("c_custkey").cast("string")))
    cells = (
        order.cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.concat("c_mktsegment", F.coalesce(tail, F.lit(" Corp"))), F.lit(""),
        F.col("o_orderpriority"),
        F.when(order % 9 == 0, "").otherwise(F.concat(F.lit("Pt "), F.lower("c_mktsegment"))),
        F.when(order % 11 == 0, "on").otherwise(F.lower(views.code_letters())),
        F.col("o_orderstatus"), (order % 3).cast("string"),
        F.when(order % 4 == 0, "").otherwise(F.concat(F.lit("Order of "), "c_name")), F.lit("x"),
    )
    key = F.concat(F.lit("estuary/OSHA/severe-incident/"), "o_orderpriority", F.lit(".csv"))
    return rows.select(*[c.alias(f"c{i}") for i, c in enumerate(cells)], key.alias("key"))


def _segment_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company aliases: segments before G, as simplified names."""
    segments = table(spark, sf_dir, "customer").select(F.lower("c_mktsegment").alias("alias_key")).distinct()
    index = segments.where("alias_key < 'g'").select(
        "alias_key", F.concat(F.lit("SLUG#"), "alias_key", F.lit("-co")).alias("target")
    )
    return dimensions.company_lookup(index)


def _port_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A port per customer segment and nation, but none in region 2."""
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return rows.where("n_regionkey <> 2").select(
        F.concat(views.code_letters(), F.lit("-port_"), F.lower("c_mktsegment")).alias("city_key")
    ).distinct()


_INGESTED = (*schemas.BRONZE_COLUMNS, "zone", "partition_source", "partition_year")


@query(
    "ingest_events",
    f"""WITH {_CELLS_SQL}, ports AS (
      SELECT DISTINCT chr(65 + n_nationkey) || chr(65 + n_regionkey) || '-port_' || lower(c_mktsegment) AS city_key
      FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 2
    ), aliases AS (SELECT DISTINCT lower(c_mktsegment) AS alias_key FROM customer WHERE lower(c_mktsegment) < 'g'
    ), placed AS (SELECT *, upper(c6) AS st, CASE WHEN c5 = '' THEN NULL ELSE 'PORT ' || upper(c5[4:]) END AS city,
      regexp_extract(c2, '#(\\d+)$', 1) AS site,
      trim(regexp_replace(regexp_replace(lower(c2), '[#0-9]', '', 'g'), '\\b(inc|corp)\\b', '', 'g')) AS alias,
      '{{"ID":"' || c0 || '","EventDate":"' || c1 || '","Employer":"' || c2 || '","Address1":"","Address2":"' || c4 ||
      '","City":"' || c5 || '","State":"' || c6 || '","Nature":"' || c7 || '","Hospitalized":"' || c8 ||
      '","Final Narrative":"' || c9 || '","Unmapped":"x"}}' AS raw FROM cells
    ), keyed AS (SELECT *, st || '-' || replace(lower(city), ' ', '_') AS slug FROM placed
    ), reasoned AS (SELECT keyed.*, alias_key, CASE WHEN st = 'ON' THEN 'Invalid State: ON'
      WHEN slug IS NULL THEN 'Missing City/State'
      WHEN city_key IS NULL THEN 'Unknown City: ' || city || ' (' || slug || ')' END AS reason
      FROM keyed LEFT JOIN ports ON slug = city_key LEFT JOIN aliases ON alias = alias_key)
    SELECT sha256('{vocab.ID_SALT}' || raw) AS event_id, 'OSHA' AS event_source, key AS source_url,
      '2002-01-01T00:00:00.000Z' AS ingested_at, c1 AS event_date, st AS state, city, slug AS city_slug,
      c2 AS company_name, alias_key || '-co' AS company_slug, nullif(site, '') AS site_id,
      'Incident at ' || c2 || ' in ' || concat_ws(', ', city, st) AS event_title,
      nullif(c9, '') AS event_description,
      '{{"semantic_id":"' || c0 || '","company_name":"' || c2 || '","street":"","description":"' || c9 ||
      '","violation_code":"' || c7 || '","injuries_hospitalized":"' || c8 || '","bedrock_verified":false}}'
      AS event_details, raw AS raw_data, NULL::VARCHAR AS bedrock_event_title,
      NULL::VARCHAR AS bedrock_event_description, false AS bedrock_verified, reason AS quarantine_reason,
      CASE WHEN reason IS NULL THEN 'reef' ELSE 'quarantine' END AS zone, 'OSHA' AS partition_source,
      '2002' AS partition_year FROM reasoned""",
)
def ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = landing.Layout(*_DATASET, header=_HEADER, paths=())
    rows = ingest.layout_events(
        _landing_rows(spark, sf_dir), layout, F.lit("2002-01-01").cast("timestamp")
    )
    return ingest.settle(
        rows, _segment_aliases(spark, sf_dir), _port_cities(spark, sf_dir)
    ).select(*_INGESTED)


@query(
    "header_canonicalise",
    f"""WITH {_CELLS_SQL} SELECT c0 AS semantic_id, c1 AS event_date, c2 AS company_name, c3 AS street,
      c5 AS city, c6 AS state, c9 AS description, c7 AS violation_code, c8 AS injuries_hospitalized FROM cells""",
)
def header_canonicalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty first alias beats a filled second one; unmapped headers go."""
    cells = [F.col(f"c{i}") for i in range(len(_HEADER))]
    picked = ingest.canonical_fields(_HEADER, cells, ingest.header_map_for(*_DATASET))
    return _landing_rows(spark, sf_dir).select(*[v.alias(k) for k, v in picked.items()])


@query(
    "header_lowercase",
    f"""WITH {_CELLS_SQL} SELECT c0 AS id, c1 AS eventdate, c2 AS employer, c3 AS address1,
      c4 AS address2, c6 AS city FROM cells""",
)
def header_lowercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a map headers are lower-cased; of two equal ones the last stays."""
    header = ("ID", "EventDate", "Employer", "Address1", "Address2", "City", "CITY")
    cells = [F.col(f"c{i}") for i in range(len(header))]
    picked = ingest.canonical_fields(header, cells, ingest.header_map_for("osha", "severe-incident"))
    return _landing_rows(spark, sf_dir).select(*[v.alias(k) for k, v in picked.items()])


# --- Company resolution ------------------------------------------------------

_WORDS = ("ring", "bolt", "gear", "rod")


def _part_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings by full name, bolts by unspaced name, gears curated and listed, and
    rods only as a state's alias."""
    name = F.col("p_name")
    slug = F.replace(name, F.lit(" "), F.lit("-"))
    bare = F.replace(name, F.lit(" "), F.lit(""))
    entry = lambda key, target: F.struct(key.alias("alias_key"), target.alias("target"))
    listed = F.concat(F.lit("SLUG#"), slug)
    entries = (
        F.when(name.endswith("ring"), F.array(entry(name, listed)))
        .when(name.endswith("bolt"), F.array(entry(bare, listed)))
        .when(
            name.endswith("gear"),
            F.array(entry(name, listed), entry(name, F.concat(F.lit("COMPANY#house-"), slug))),
        )
        .when(name.endswith("rod"), F.array(entry(name, F.concat(F.lit("STATE#"), slug))))
    )
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    return names.select(F.explode(entries).alias("e")).select("e.*")


@query(
    "resolve_company",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, raw_name, CASE
        WHEN raw_name LIKE 'Big %' THEN NULL
        WHEN p_name LIKE '% ring' OR p_name LIKE '% bolt' THEN replace(p_name, ' ', '-')
        WHEN p_name LIKE '% gear' THEN 'house-' || replace(p_name, ' ', '-') END AS company_slug
      FROM (SELECT *, CASE l_linenumber % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name || ' Inc #' || p_size
        WHEN 2 THEN 'Big ' || p_name ELSE p_name || '  Store LLC' END AS raw_name
      FROM lineitem JOIN part ON l_partkey = p_partkey)""",
)
def resolve_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "lineitem").repartition("l_orderkey", "l_linenumber")
    rows = facts.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    line, name = F.col("l_linenumber") % 4, F.col("p_name")
    raw = (
        F.when(line == 0, F.upper(name))
        .when(line == 1, F.concat(name, F.lit(" Inc #"), F.col("p_size").cast("string")))
        .when(line == 2, F.concat(F.lit("Big "), name))
        .otherwise(F.concat(name, F.lit("  Store LLC")))
    )
    named = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", raw.alias("raw_name"))
    lookup = dimensions.company_lookup(_part_aliases(spark, sf_dir))
    return resolve.resolve_companies(named, lookup, "raw_name")


@query(
    "company_lookup",
    """SELECT p_name AS alias_key, replace(p_name, ' ', '-') AS company_slug FROM part WHERE p_name LIKE '% ring'
      UNION SELECT replace(p_name, ' ', ''), replace(p_name, ' ', '-') FROM part WHERE p_name LIKE '% bolt'
      UNION SELECT p_name, 'house-' || replace(p_name, ' ', '-') FROM part WHERE p_name LIKE '% gear'""",
)
def company_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.company_lookup(_part_aliases(spark, sf_dir))


# --- Company dimension -------------------------------------------------------

_ROWS_SQL = f"""{RAW_LISTING_SQL}, rows AS (SELECT *, p_partkey AS line, p_brand AS symbol,
  CASE WHEN p_size % 5 <> 0 THEN p_type END AS sector,
  CASE WHEN p_size % 3 <> 0 THEN p_size::VARCHAR END AS cap FROM slugged)"""


@query(
    "company_fold",
    f"""WITH {_ROWS_SQL} SELECT slug, arg_min(clean_name, line) AS name,
      arg_min(sector, line) FILTER (WHERE sector IS NOT NULL) AS sector, arg_min(p_type, line) AS industry,
      arg_min(cap, line) FILTER (WHERE cap IS NOT NULL) AS market_cap, NULL::VARCHAR AS ipo_year,
      arg_min(symbol, line) AS primary_ticker, count(DISTINCT symbol) AS tickers FROM rows GROUP BY slug""",
)
def company_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dimensions.listed_companies(raw_listings(spark, sf_dir))
    return dim.select(
        "slug", "name", "sector", "industry", "market_cap", "ipo_year", "primary_ticker",
        F.size("tickers").cast("bigint").alias("tickers"),
    )


@query(
    "listing_load_counts",
    f"""WITH {_ROWS_SQL} SELECT count(*) AS lines, count(*) FILTER (WHERE p_size % 7 = 0) AS skipped,
      count(DISTINCT slug) FILTER (WHERE p_size % 7 <> 0) AS companies FROM rows""",
)
def listing_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes that are a multiple of seven come without a symbol."""
    blank = F.col("lastsale").rlike(r"^\$(7|14|21|28|35|42|49)$")
    rows = raw_listings(spark, sf_dir).withColumn("symbol", F.when(~blank, F.col("symbol")).otherwise(" "))
    return dimensions.listing_load_counts(rows)


@query(
    "company_tickers",
    f"""WITH {_ROWS_SQL} SELECT slug, symbol, arg_max(share_type, line) AS type, arg_max(raw_name, line) AS raw_name,
      '$' || arg_max(p_size, line)::VARCHAR AS price, max(line)::VARCHAR AS volume FROM rows GROUP BY slug, symbol""",
)
def company_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dimensions.listed_companies(raw_listings(spark, sf_dir))
    rows = dim.select("slug", F.explode("tickers").alias("symbol", "t"))
    return rows.select("slug", "symbol", "t.type", "t.raw_name", "t.price", "t.volume")


_LISTED_ALIASES_SQL = """SELECT lower(symbol) AS alias_key, 'SLUG#' || slug AS target FROM rows
      UNION ALL SELECT replace(words, ' ', ''), 'SLUG#' || slug FROM rows WHERE words <> '' AND words <> slug"""


@query("company_aliases", f"WITH {_ROWS_SQL} SELECT DISTINCT * FROM ({_LISTED_ALIASES_SQL})")
def company_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dimensions.listed_companies(raw_listings(spark, sf_dir))
    return dimensions.alias_index(dimensions.listed_company_aliases(dim))


# --- City dimension ----------------------------------------------------------

GAZETTEER_SQL = """lines AS (SELECT c_custkey AS line, chr(65 + n_nationkey) || chr(65 + n_regionkey) AS usps,
    CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment || '-Davidson' ELSE c_mktsegment || ' Grove' END AS name,
    CASE c_custkey % 3 WHEN 1 THEN 'Town' ELSE 'Metropolitan government' END AS kind, c_custkey,
    c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey),
  slugs AS (SELECT *, usps || '-' || replace(lower(name), ' ', '_') AS city_slug FROM lines),
  first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city_slug ORDER BY line) AS rn,
    count(*) OVER (PARTITION BY city_slug) AS copies FROM slugs) WHERE rn = 1)"""


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as gazetteer lines; the customer key is the line number."""
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    name = F.when(key % 3 == 0, F.concat("c_mktsegment", F.lit("-Davidson"))).otherwise(
        F.concat("c_mktsegment", F.lit(" Grove"))
    )
    kind = F.when(key % 3 == 1, " town").otherwise(" metropolitan government (balance)")
    text = key.cast("string")
    return rows.select(
        key.alias("line"), views.code_letters().alias("USPS"), F.concat(name, kind).alias("NAME"),
        text.alias("GEOID"), F.lit("").alias("ANSICODE"), text.alias("ALAND"), F.lit(" ").alias("AWATER"),
        text.alias("ALAND_SQMI"), text.alias("AWATER_SQMI"), F.concat(text, F.lit(".5")).alias("INTPTLAT"),
        F.concat(F.lit("-"), text).alias("INTPTLONG"),
    )


@query(
    "city_dim_keep_first",
    f"""WITH {GAZETTEER_SQL} SELECT city_slug, kind AS place_type, name, usps AS state, c_custkey || '.5' AS lat,
      '-' || c_custkey AS lon, c_custkey::VARCHAR AS land_sqm, NULL::VARCHAR AS water_sqm,
      c_custkey::VARCHAR AS geoid, NULL::VARCHAR AS ansi, copies FROM first""",
)
def city_dim_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dimensions.cities(gazetteer(spark, sf_dir))
    return dim.select(
        "city_slug", "place_type", "name", "state", "location.lat", "location.lon",
        "area.land_sqm", "area.water_sqm", "census.geoid", "census.ansi", "copies",
    )


@query(
    "city_load_counts",
    f"""WITH {GAZETTEER_SQL} SELECT sum(copies)::BIGINT AS lines, 0::BIGINT AS skipped, count(*) AS imported,
      sum(copies - 1)::BIGINT AS collisions FROM first""",
)
def city_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.city_load_counts(gazetteer(spark, sf_dir))


@query(
    "observed_load_counts",
    f"""WITH {GAZETTEER_SQL} SELECT sum(copies)::BIGINT AS lines, 0::BIGINT AS skipped, count(*) AS imported,
      sum(copies - 1)::BIGINT AS collisions FROM first""",
)
def observed_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of a city load, observed while the dimension is written."""
    counts = dimensions.load_cities(gazetteer(spark, sf_dir), session.scratch_path(spark, "cities"))
    return spark.createDataFrame([counts], "lines long, skipped long, imported long, collisions long")


CITY_ALIASES_SQL = """SELECT replace(lower(name), ' ', '_') || '-' || lower(usps) AS alias_key,
      'CITY#' || city_slug AS target FROM first
    UNION ALL SELECT usps || '-' || lower(string_split(name, '-')[1]), 'CITY#' || city_slug FROM first
      WHERE contains(name, '-')"""


@query("city_aliases", f"WITH {GAZETTEER_SQL} {CITY_ALIASES_SQL}")
def city_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.city_aliases(dimensions.cities(gazetteer(spark, sf_dir)))


@query(
    "city_keys",
    f"WITH {GAZETTEER_SQL} SELECT city_slug AS city_key FROM first UNION SELECT alias_key FROM ({CITY_ALIASES_SQL})",
)
def city_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dimensions.cities(gazetteer(spark, sf_dir))
    return dimensions.city_lookup(dim, dimensions.city_aliases(dim))


_CURATED_SQL = """SELECT lower(s_name) AS alias_key, 'COMPANY#supplier-' || s_suppkey AS target FROM supplier
      UNION ALL SELECT 'sup ' || s_suppkey, 'COMPANY#supplier-' || s_suppkey FROM supplier"""


def _curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.concat(F.lit("supplier-"), key).alias("slug"),
        F.array(F.concat(F.lit(" SUP "), key)).alias("aliases"),
    )


@query("curated_aliases", _CURATED_SQL)
def curated_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.curated_aliases(_curated(spark, sf_dir))


@query(
    "alias_index",
    f"""WITH {_ROWS_SQL}, {GAZETTEER_SQL} SELECT DISTINCT * FROM ({_LISTED_ALIASES_SQL}
      UNION ALL {CITY_ALIASES_SQL} UNION ALL {_CURATED_SQL}
      UNION ALL SELECT lower(n_name), 'STATE#' || chr(65 + n_nationkey) || chr(65 + n_regionkey) FROM nation)""",
)
def alias_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"), views.code_letters().alias("abbr")
    )
    return dimensions.alias_index(
        dimensions.listed_company_aliases(dimensions.listed_companies(raw_listings(spark, sf_dir))),
        dimensions.city_aliases(dimensions.cities(gazetteer(spark, sf_dir))),
        dimensions.curated_aliases(_curated(spark, sf_dir)),
        dimensions.state_aliases(nations),
    )


@query("alias_lookup", f"SELECT * FROM ({_CURATED_SQL}) WHERE alias_key = 'sup 7'")
def alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.find_alias(dimensions.curated_aliases(_curated(spark, sf_dir)), "sup 7")
