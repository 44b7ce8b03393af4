"""Quarantine statistics and recovery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook import schemas, vocab
from casebook.functions import places
from casebook.operators import resolve

GROUP = ("quarantine_reason", "company_name", "city", "state")
FIXABLE = (
    "event_date", "state", "city", "city_slug", "company_name", "company_slug", "site_id",
    "event_title", "event_description", "event_details", "bedrock_event_title",
    "bedrock_event_description",
)


def groups(held: DataFrame) -> DataFrame:
    """Similar rows together: count, one sample id, one file. Nulls group too."""
    extra = [F.min("file_key").alias("file_key")] if "file_key" in held.columns else []
    return held.groupBy(*GROUP).agg(
        F.count("*").alias("count"), F.min("event_id").alias("sample_id"), *extra
    ).withColumn("company_name", F.coalesce("company_name", F.lit("Unknown")))


def top_groups(held: DataFrame, limit: int = vocab.QUARANTINE_GROUPS) -> DataFrame:
    order = [F.desc("count")] + [F.col(c).asc_nulls_last() for c in GROUP]
    return groups(held).orderBy(*order).limit(limit)


def file_counts(held: DataFrame, scanned: DataFrame) -> DataFrame:
    """How many quarantine files there are, and how many of them statistics read."""
    both = held.select("file_key", F.lit(False).alias("scanned")).unionByName(
        scanned.select("file_key", F.lit(True).alias("scanned"))
    )
    return both.agg(
        F.count_distinct(F.when(~F.col("scanned"), F.col("file_key"))).alias("total_files"),
        F.count_distinct(F.when(F.col("scanned"), F.col("file_key"))).alias("scanned_files"),
    )


def recover(held: DataFrame, fixes: DataFrame, city_keys: DataFrame) -> DataFrame:
    """Held rows with corrected fields, checked again.

    ``fixes`` has an event_id and any of the fixable columns; a null leaves the
    held value. Several fixes of one event are reduced to the smallest by their
    columns in order, so no row is multiplied. The slug follows a corrected city or state unless
    the fix brings its own. Rows that still fail keep a reason.
    """
    given = [c for c in fixes.columns if c in FIXABLE]
    once = fixes.groupBy("event_id").agg(F.min(F.struct(F.lit(0), *given)).alias("_fix"))
    side = once.select("event_id", *[F.col(f"_fix.{c}").alias(f"_fix_{c}") for c in given])
    rows = held.join(side, "event_id")
    for name in given:
        rows = rows.withColumn(name, F.coalesce(f"_fix_{name}", name))
    if "city_slug" not in given and {"city", "state"} & set(given):
        rows = rows.withColumn("city_slug", places.city_slug(F.col("state"), F.col("city")))
    rows = resolve.validate(rows.drop("quarantine_reason"), city_keys)
    return rows.select(*[f.name for f in schemas.BRONZE.fields if f.name in rows.columns])


def recovered(checked: DataFrame) -> DataFrame:
    """Rows that passed, ready to be appended to bronze."""
    return checked.where("quarantine_reason is null").withColumn(
        "zone", F.lit(vocab.BRONZE_ZONE)
    )
