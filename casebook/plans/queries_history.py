"""Deduplication, upsert, validation and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import vocab
from casebook.functions import dates
from casebook.operators import insights, merge, quarantine, resolve
from casebook.plans import views
from casebook.plans.views import query, sql_stamp, with_base

_DEDUPE = ("event_id", "event_source", "state", "city_slug", "company_slug", "site_id")


@query(
    "dedupe_latest",
    with_base(
        f"SELECT {', '.join(_DEDUPE)}, {sql_stamp('ingested_at')} AS ingested_at, "
        f"{sql_stamp('event_date')} AS event_date FROM silver"
    ),
)
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.latest(spark, sf_dir).select(
        *_DEDUPE, dates.stamp(F.col("ingested_at")).alias("ingested_at"),
        dates.stamp(F.col("event_date")).alias("event_date"),
    )


_MERGED = (
    "event_id", "event_source", "ingested_at", "event_date", "state", "city_slug",
    "company_slug", "event_title", "bedrock_event_title", "bedrock_verified", "quarantine_reason",
)
_CUT = "1999-01-01"


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = views.deliveries(spark, sf_dir)
    ties = [F.col(c).asc() for c in views.TIES]
    old = merge.latest_per_event(rows.where(F.col("ingested_at") < _CUT), ties)
    new = merge.latest_per_event(rows.where(F.col("ingested_at") >= _CUT), ties)
    return old, new


def _dates_as_text(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {c: dates.stamp(F.col(c)) for c in ("ingested_at", "event_date") if c in rows.columns}
    )


def _side_sql(name: str, test: str) -> str:
    return f"""{name} AS (
      SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id
        ORDER BY ingested_at DESC, l_partkey, l_suppkey, l_extendedprice) AS rn
      FROM base WHERE ingested_at {test} TIMESTAMP '{_CUT}') WHERE rn = 1)"""


def _merge_sql(keep: bool) -> str:
    def pick(c: str) -> str:
        both = "n.event_id IS NOT NULL"
        if c == "quarantine_reason":
            value = f"CASE WHEN o.event_id IS NOT NULL THEN o.{c} ELSE n.{c} END"
        elif keep and c.startswith("bedrock"):
            value = (
                f"CASE WHEN {both} AND NOT (o.event_id IS NOT NULL AND n.bedrock_event_title IS NULL)"
                f" THEN n.{c} ELSE o.{c} END"
            )
        else:
            value = f"CASE WHEN {both} THEN n.{c} ELSE o.{c} END"
        if c in ("ingested_at", "event_date"):
            value = sql_stamp(value)
        return f"{value} AS {c}"

    return with_base(
        f"SELECT {', '.join(pick(c) for c in _MERGED)} "
        "FROM older o FULL OUTER JOIN newer n ON o.event_id = n.event_id",
        _side_sql("older", "<"), _side_sql("newer", ">="),
    )


@query("merge_upsert", _merge_sql(False))
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _sides(spark, sf_dir)
    return _dates_as_text(merge.merge_rows(old, new, columns=_MERGED))


@query("merge_upsert_keep_enrichment", _merge_sql(True))
def merge_upsert_keep_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _sides(spark, sf_dir)
    return _dates_as_text(merge.merge_rows(old, new, keep_enrichment=True, columns=_MERGED))


def _checked(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    return resolve.validate(
        rows.drop("quarantine_reason"), views.known_cities(spark, sf_dir)
    )


_CHECKED_BASE = (views.KNOWN_SQL, views.CHECKED_SQL.format(rows="base"))
_CHECKED_SILVER = (views.KNOWN_SQL, views.CHECKED_SQL.format(rows="silver"))


@query(
    "validation_reasons",
    with_base(
        "SELECT coalesce(quarantine_reason, 'valid') AS reason, count(*) AS events "
        "FROM checked GROUP BY 1",
        *_CHECKED_BASE,
    ),
)
def validation_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _checked(spark, sf_dir, views.deliveries(spark, sf_dir))
    reason = F.coalesce("quarantine_reason", F.lit("valid"))
    return checked.groupBy(reason.alias("reason")).agg(F.count("*").alias("events"))


@query(
    "bronze_quarantine_split",
    with_base(
        "SELECT event_source AS partition_source, strftime(ingested_at, '%Y') AS partition_year, "
        "CASE WHEN quarantine_reason IS NULL THEN 'reef' ELSE 'quarantine' END AS zone, "
        "count(*) AS events, count(DISTINCT event_id) AS ids FROM checked GROUP BY 1, 2, 3",
        *_CHECKED_BASE,
    ),
)
def bronze_quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _checked(spark, sf_dir, views.deliveries(spark, sf_dir))
    zone = F.when(F.col("quarantine_reason").isNull(), vocab.BRONZE_ZONE).otherwise(
        vocab.QUARANTINE_ZONE
    )
    return checked.groupBy(
        F.col("event_source").alias("partition_source"),
        F.date_format("ingested_at", "yyyy").alias("partition_year"),
        zone.alias("zone"),
    ).agg(F.count("*").alias("events"), F.count_distinct("event_id").alias("ids"))


@query(
    "quarantine_groups_topn",
    with_base(
        "SELECT quarantine_reason, coalesce(company_name, 'Unknown') AS company_name, city, state, "
        "count(*) AS count, min(event_id) AS sample_id FROM checked "
        "WHERE quarantine_reason IS NOT NULL GROUP BY quarantine_reason, company_name, city, state "
        "ORDER BY count DESC, quarantine_reason NULLS LAST, company_name NULLS LAST, "
        "city NULLS LAST, state NULLS LAST LIMIT 100",
        *_CHECKED_BASE,
    ),
)
def quarantine_groups_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _checked(spark, sf_dir, views.deliveries(spark, sf_dir))
    return quarantine.top_groups(checked.where("quarantine_reason is not null"))


@query(
    "quarantine_recovery",
    with_base(
        "SELECT event_id, state, city_slug, company_name, "
        "coalesce(quarantine_reason, 'valid') AS outcome FROM rechecked",
        *_CHECKED_SILVER,
        """fixed AS (SELECT * EXCLUDE (quarantine_reason, state, city_slug), 'AA' AS state,
          'AA-' || replace(lower(city), ' ', '_') AS city_slug
          FROM checked WHERE starts_with(quarantine_reason, 'Invalid State'))""",
        """rechecked AS (SELECT fixed.*, CASE WHEN city_slug IS NULL THEN 'Missing City/State'
          WHEN city_key IS NULL THEN 'Unknown City: ' || city || ' (' || city_slug || ')' END
          AS quarantine_reason FROM fixed LEFT JOIN known ON city_slug = city_key)""",
    ),
)
def quarantine_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event held for its state gets the state AA and is checked again."""
    held = _checked(spark, sf_dir, views.latest(spark, sf_dir)).where(
        "quarantine_reason is not null"
    )
    fixes = held.where(F.col("quarantine_reason").startswith("Invalid State")).select(
        "event_id", F.lit("AA").alias("state")
    )
    again = quarantine.recover(held, fixes, views.known_cities(spark, sf_dir))
    return again.select(
        "event_id", "state", "city_slug", "company_name",
        F.coalesce("quarantine_reason", F.lit("valid")).alias("outcome"),
    )


@query(
    "review_queue",
    with_base(
        "SELECT company_name, count(*) AS events, min(event_id) AS sample_event_id FROM silver "
        "WHERE company_slug IS NULL AND company_name IS NOT NULL GROUP BY 1"
    ),
)
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.review_queue(views.latest(spark, sf_dir))
