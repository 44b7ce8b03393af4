"""Event-shaped views over the sales tables the checks run on.

Every row of lineitem becomes one delivery of an incident event: orders give
the date, parts the company and site, suppliers and nations the place. Order and
line number together name the event, so repeated pairs are re-deliveries.
``BASE_SQL`` states the same view for the side-by-side check.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casebook.functions import places
from casebook.functions import text as tx
from casebook.operators import merge

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, the SQL it must equal."""

    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its schema is looked up once per path."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def code_letters() -> Column:
    """Two letters from the nation and region keys."""
    return F.concat(
        F.char(F.col("n_nationkey") + 65), F.char(F.col("n_regionkey") + 65)
    )


TIES = ("l_partkey", "l_suppkey", "l_extendedprice")


@lru_cache(maxsize=8)
def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its order, customer, part, supplier and nation, columns as they were.

    Customers join the orders, not the lines, and the lines meet their orders first: they
    move once, while they are narrow, and then lie as their deduplication needs them.
    """
    t = lambda name: table(spark, sf_dir, name)
    heads = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = (
        t("lineitem").join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return rows.withColumn("ingested_at", F.col("l_shipdate").cast("timestamp"))


def _event_columns() -> list[Column]:
    flag = F.col("l_returnflag")
    state = F.when(F.col("n_nationkey") % 12 == 11, "US").otherwise(code_letters())
    city = F.when(
        F.col("s_suppkey") % 17 != 0,
        F.concat("c_mktsegment", F.lit(" "), (F.col("s_suppkey") % 4).cast("string")),
    )
    line = F.col("l_linenumber")
    return [
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.when(flag == "A", "OSHA").when(flag == "N", "FDA").otherwise("NHTSA").alias("event_source"),
        F.concat(F.lit("estuary/orders/"), "o_orderpriority").alias("source_url"),
        F.col("ingested_at"),
        F.col("o_orderdate").cast("timestamp").alias("event_date"),
        state.alias("state"),
        city.alias("city"),
        places.city_slug(state, city).alias("city_slug"),
        F.concat("p_name", F.lit(" #"), F.col("p_size").cast("string")).alias("company_name"),
        F.when(F.col("p_partkey") % 10 != 0, F.replace("p_name", F.lit(" "), F.lit("-"))).alias("company_slug"),
        F.col("p_size").cast("string").alias("site_id"),
        F.concat("p_type", F.lit(" at "), "p_name").alias("event_title"),
        F.concat(F.lit("Priority "), "o_orderpriority").alias("event_description"),
        F.to_json(
            F.struct(
                F.col("p_type").alias("violation_type"),
                F.col("p_size").cast("string").alias("naics_code"),
                (line % 3).cast("string").alias("injuries_hospitalized"),
                F.when(line == 7, "1").otherwise("").alias("injuries_amputation"),
                F.when((line == 1) & (flag == "R"), "1").otherwise("0").alias("total_deaths"),
            )
        ).alias("event_details"),
        F.to_json(F.struct("l_orderkey", "l_linenumber", "l_shipdate")).alias("raw_data"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("Urgent: "), "p_name"))
        .alias("bedrock_event_title"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Closed order")).alias("bedrock_event_description"),
        (F.col("o_orderstatus") == "F").alias("bedrock_verified"),
        F.concat(F.lit("seen in "), F.year("l_shipdate").cast("string")).alias("quarantine_reason"),
        *map(F.col, TIES),
    ]


@lru_cache(maxsize=8)
def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All deliveries of all events (the bronze role). Only the plan is kept."""
    return _joined(spark, sf_dir).select(*_event_columns())


@lru_cache(maxsize=8)
def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, its newest delivery (the silver role).

    Order and line stand for the event: they are what its id is made of, and no order is
    null here. The rows lie by order already, and the event's texts are made of the rows
    that are left.
    """
    rows = merge.latest_per_event(
        _joined(spark, sf_dir), [F.col(c).asc() for c in TIES], keys=("l_orderkey", "l_linenumber")
    )
    return rows.select(*_event_columns())


_COLUMNS_SQL = """
  SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS event_id,
    CASE l_returnflag WHEN 'A' THEN 'OSHA' WHEN 'N' THEN 'FDA' ELSE 'NHTSA' END AS event_source,
    'estuary/orders/' || o_orderpriority AS source_url,
    l_shipdate AS ingested_at, o_orderdate AS event_date, state, city,
    state || '-' || replace(lower(city), ' ', '_') AS city_slug,
    p_name || ' #' || p_size::VARCHAR AS company_name,
    CASE WHEN p_partkey % 10 <> 0 THEN replace(p_name, ' ', '-') END AS company_slug,
    p_size::VARCHAR AS site_id,
    p_type || ' at ' || p_name AS event_title,
    'Priority ' || o_orderpriority AS event_description,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Urgent: ' || p_name END AS bedrock_event_title,
    CASE WHEN o_orderstatus = 'F' THEN 'Closed order' END AS bedrock_event_description,
    o_orderstatus = 'F' AS bedrock_verified,
    'seen in ' || year(l_shipdate)::VARCHAR AS quarantine_reason,
    p_type AS violation_type, p_size AS naics,
    l_linenumber % 3 AS hospitalized, (l_linenumber = 7)::INT AS amputation,
    (l_linenumber = 1 AND l_returnflag = 'R')::INT AS deaths,
    l_partkey, l_suppkey, l_extendedprice
  FROM placed
"""

BASE_SQL = f"""
placed AS (
  SELECT *,
    CASE WHEN n_nationkey % 12 = 11 THEN 'US'
      ELSE chr(65 + n_nationkey) || chr(65 + n_regionkey) END AS state,
    CASE WHEN s_suppkey % 17 <> 0
      THEN c_mktsegment || ' ' || (s_suppkey % 4)::VARCHAR END AS city
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
), base AS ({_COLUMNS_SQL}), silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
      ORDER BY ingested_at DESC, l_partkey, l_suppkey, l_extendedprice) AS rn
    FROM base) WHERE rn = 1
), shown AS (
  SELECT * REPLACE (coalesce(bedrock_event_title, event_title) AS event_title,
    coalesce(bedrock_event_description, event_description) AS event_description)
  FROM silver
)"""


def with_base(sql: str, *steps: str) -> str:
    """``sql`` over the base views and further named steps."""
    return f"WITH {', '.join([BASE_SQL, *steps])}\n{sql}"


def sql_stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


# --- Dimensions --------------------------------------------------------------


def customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as gazetteer lines: a place per segment and last key digit."""
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    name = F.concat("c_mktsegment", F.lit(" "), (F.col("c_custkey") % 4).cast("string"))
    return rows.select(
        F.col("c_custkey").alias("line"),
        code_letters().alias("state"), name.alias("city"),
        F.concat(code_letters(), F.lit("-"), tx.underscored(name)).alias("city_slug"),
    )


def known_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry of the checks: all customer places but those numbered 3,
    which therefore count as unknown cities."""
    spots = customer_places(spark, sf_dir)
    return spots.where(~F.col("city").endswith(" 3")).select(F.col("city_slug").alias("city_key")).distinct()


KNOWN_SQL = """known AS (
  SELECT DISTINCT chr(65 + n_nationkey) || chr(65 + n_regionkey) || '-'
    || replace(lower(c_mktsegment || ' ' || (c_custkey % 4)::VARCHAR), ' ', '_') AS city_key
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE NOT ends_with(c_mktsegment || ' ' || (c_custkey % 4)::VARCHAR, ' 3')
)"""

CHECKED_SQL = """checked AS (
  SELECT base.* EXCLUDE (quarantine_reason),
    CASE WHEN state IS NULL OR length(state) <> 2 OR state IN ('US', 'ON', 'XX')
        THEN 'Invalid State: ' || coalesce(state, 'undefined')
      WHEN city_slug IS NULL THEN 'Missing City/State'
      WHEN city_key IS NULL THEN 'Unknown City: ' || city || ' (' || city_slug || ')'
    END AS quarantine_reason
  FROM {rows} AS base LEFT JOIN known ON city_slug = city_key
)"""
