"""Entity resolution and validation of incoming events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook import vocab
from casebook.functions import companies
from casebook.functions import text as tx


def resolve_companies(
    rows: DataFrame, lookup: DataFrame, name: str, try_unspaced: bool = True
) -> DataFrame:
    """Add ``company_slug``: exact alias, else simplified alias, else unspaced.

    The lookup is one small row per alias, so each step is a broadcast join as
    long as Catalyst sees it below the threshold; beyond it, the keys shuffle
    and AQE splits names that dominate.
    """
    exact = F.lower(tx.trim(F.col(name)))
    simple = companies.alias_key(tx.trim(F.col(name)))
    keyed = rows.withColumn("_k1", tx.empty_to_null(exact)).withColumn(
        "_k2", tx.empty_to_null(simple)
    )
    steps = ["_k1", "_k2"]
    if try_unspaced:
        keyed = keyed.withColumn("_k3", companies.unspaced(F.col("_k2")))
        steps.append("_k3")
    for step in steps:
        side = lookup.select(
            F.col("alias_key").alias(step), F.col("company_slug").alias(f"{step}_slug")
        )
        keyed = keyed.join(side, step, "left")
    slug = F.coalesce(*[F.col(f"{s}_slug") for s in steps])
    return keyed.withColumn("company_slug", slug).drop(
        *steps, *[f"{s}_slug" for s in steps]
    )


def _shown(value: Column) -> Column:
    """A missing value is printed as ``undefined`` in reasons."""
    return F.coalesce(value, F.lit("undefined"))


def quarantine_reason(state: Column, city: Column, slug: Column, known: Column) -> Column:
    """First failing check, null for a valid row."""
    bad_state = (
        state.isNull() | (F.length(state) != 2) | state.isin(*vocab.REJECTED_STATES)
    )
    return (
        F.when(F.coalesce(bad_state, F.lit(True)), F.concat(F.lit("Invalid State: "), _shown(state)))
        .when(tx.empty_to_null(slug).isNull(), F.lit("Missing City/State"))
        .when(~known, F.concat(F.lit("Unknown City: "), _shown(city), F.lit(" ("), slug, F.lit(")")))
    )


def validate(rows: DataFrame, city_keys: DataFrame) -> DataFrame:
    """Add ``quarantine_reason``; a city is known by its slug or by an alias.

    The alias key is built from the same state and city as the slug, so one
    left join against the union of both key sets answers either test.
    """
    known = city_keys.select(
        F.col("city_key").alias("city_slug"), F.lit(True).alias("_known")
    )
    checked = rows.join(known, "city_slug", "left")
    reason = quarantine_reason(
        F.col("state"), F.col("city"), F.col("city_slug"),
        F.coalesce(F.col("_known"), F.lit(False)),
    )
    return checked.withColumn("quarantine_reason", reason).drop("_known")
