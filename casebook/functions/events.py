"""Event identity, title and the JSON columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook import vocab
from casebook.functions import text as tx


DIGITS = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,2})?$"


def raw_json(fields: Sequence[tuple[str, Column]]) -> Column:
    """The file's row as JSON, headers in file order, empty cells kept as ``""``."""
    return F.to_json(F.struct(*[value.alias(header) for header, value in fields]))


def event_id(raw: Column, salt: str = vocab.ID_SALT) -> Column:
    return F.sha2(F.concat(F.lit(salt), raw), 256)


def event_title(fields: Mapping[str, Column]) -> Column:
    """Survey rows get a yearly report title, the rest say what happened where."""

    def given(key: str, default: str) -> Column:
        if key not in fields:
            return F.lit(default)
        return F.coalesce(tx.empty_to_null(fields[key]), F.lit(default))

    company = given("company_name", "Unknown Company")
    if any(key in fields for key in vocab.SURVEY_KEYS):
        year = F.substring(given("event_date", ""), 1, 4)
        return tx.trim(F.concat(year, F.lit(" "), company, F.lit(" Annual Safety Report")))
    place = F.concat_ws(
        ", ",
        *[tx.empty_to_null(fields[key]) for key in ("city", "state") if key in fields],
    )
    what = F.concat(given("violation_type", "Incident"), F.lit(" at "), company)
    return tx.trim(
        F.when(place != "", F.concat(what, F.lit(" in "), place)).otherwise(what)
    )


def details_json(fields: Mapping[str, Column]) -> Column:
    """Everything canonical that has no column of its own; nulls are left out."""
    return F.to_json(
        F.struct(
            *[v.alias(k) for k, v in fields.items() if k not in vocab.NOT_IN_DETAILS]
        )
    )


def with_details(rows: DataFrame, *keys: str, column: str = "details") -> DataFrame:
    """Add the named overflow fields as a struct of texts, parsed in one go."""
    fields = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    return rows.withColumn(column, F.from_json("event_details", fields))


def number(text: Column) -> Column:
    """A text in digits as a number, else null: ``NaN`` or ``Infinity`` in one
    cell would spoil every sum above it."""
    return F.when(tx.trim(text).rlike(DIGITS), text).try_cast("double")


def number_sum(*texts: Column) -> Column:
    """Sum of numeric texts, 0 for what is missing or not a number."""
    total = F.lit(0.0)
    for text in texts:
        total = total + F.coalesce(number(text), F.lit(0.0))
    return total
