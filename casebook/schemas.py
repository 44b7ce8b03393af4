"""Explicit schemas of every stored table."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = T.StringType()


def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(n, _TEXT) for n in names]


BRONZE_COLUMNS = (
    "event_id", "event_source", "source_url", "ingested_at", "event_date", "state",
    "city", "city_slug", "company_name", "company_slug", "site_id", "event_title",
    "event_description", "event_details", "raw_data", "bedrock_event_title",
    "bedrock_event_description", "bedrock_verified", "quarantine_reason",
)
_SPECIAL = {"bedrock_verified": T.BooleanType()}

BRONZE = T.StructType(
    [T.StructField(n, _SPECIAL.get(n, _TEXT)) for n in BRONZE_COLUMNS]
    + _texts("partition_source", "partition_year")
)

# As it lies in a zone: the batch that wrote a file is its innermost folder.
BRONZE_STORED = T.StructType(BRONZE.fields + _texts("batch"))

_SILVER_SPECIAL = {
    **_SPECIAL, "ingested_at": T.TimestampType(), "event_date": T.TimestampType(),
}
SILVER_COLUMNS = BRONZE_COLUMNS
SILVER = T.StructType(
    [T.StructField(n, _SILVER_SPECIAL.get(n, _TEXT)) for n in SILVER_COLUMNS]
)
SILVER_STORED = T.StructType(
    [f for f in SILVER.fields if f.name != "event_source"]
    + [T.StructField("version", T.LongType())]
    + _texts("event_source", "event_year", "id_part")
)

DIRECTORY_ITEM = T.StructType(
    _texts("slug", "name") + [T.StructField("count", T.LongType())]
)
_DIRECTORY = T.ArrayType(DIRECTORY_ITEM)


def _recents(*names: str) -> T.MapType:
    return T.MapType(_TEXT, T.ArrayType(T.StructType(_texts(*names))))


_EVENT_HEAD = ("eventId", "eventTitle", "eventDescription", "eventDate")
NATION_EVENT = (*_EVENT_HEAD, "company", "city", "state")
PLACE_EVENT = (*_EVENT_HEAD, "companySlug", "companyName", "city", "state")
COMPANY_EVENT = (*_EVENT_HEAD, "city", "state")


def _counts(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


GOLD = {
    "nation": T.StructType(
        _counts("total_events", "total_companies", "total_cities", "total_states")
        + _texts("first_seen", "last_seen")
        + [
            T.StructField("aggregation_date", T.DateType()),
            T.StructField("states_directory", _DIRECTORY),
            T.StructField("recentByEventSource", _recents(*NATION_EVENT)),
        ]
    ),
    "state": T.StructType(
        _texts("state")
        + _counts("total_events", "total_companies", "total_cities")
        + [
            T.StructField("cities_directory", _DIRECTORY),
            T.StructField("recentByEventSource", _recents(*PLACE_EVENT)),
        ]
    ),
    "city": T.StructType(
        _texts("city_slug", "city")
        + _counts("total_events", "total_companies")
        + [
            T.StructField("companies_directory", _DIRECTORY),
            T.StructField("recentByEventSource", _recents(*PLACE_EVENT)),
        ]
        + _texts("state")
    ),
    "company": T.StructType(
        _texts("company_slug", "company_name")
        + _counts("total_events")
        + _texts("last_active")
        + [T.StructField("recentByEventSource", _recents(*COMPANY_EVENT))]
    ),
    "site": T.StructType(
        _texts("company_slug", "site_id", "company_name")
        + _counts("total_events")
        + _texts("last_active")
        + [
            T.StructField(
                "recent_events",
                T.ArrayType(T.StructType(_texts("eventSource", *COMPANY_EVENT))),
            )
        ]
    ),
}

DOCUMENTS_STORED = T.StructType(_texts("PK", "SK", "document", "updatedAt", "level", "pk_part"))
ALIASES = T.StructType(_texts("alias_key", "target"))
NARRATIVE_REPLY = T.StructType(
    _texts("title", "explanation", "riskAssessment", "compliance")
    + [T.StructField("keyPoints", T.ArrayType(_TEXT))]
    + _texts("industryContext")
)
