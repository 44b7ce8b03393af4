"""Gold rows -> page documents keyed by (PK, SK)."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook import vocab
from casebook.functions import places
from casebook.functions import text as tx

SUMMARY = "SUMMARY"
NATION_KEY = "NATION#USA"
UNKNOWN_EVENT = "Unknown Event"


def _first_given(*values: Column) -> Column:
    return F.coalesce(*[tx.empty_to_null(v) for v in values])


def _item(slug: Column, name: Column, count: Column) -> Column:
    return F.struct(
        slug.alias("slug"), name.alias("name"), tx.whole_number(count).alias("count")
    )


def shaped_event(event: Column, index: Column, kind: str, source: Column, fields: set[str]) -> Column:
    """One recent event as pages show it. An event without an id gets a stable
    one from its level, date, title, company and place in the list."""

    def get(name: str) -> Column:
        return event[name] if name in fields else F.lit(None).cast("string")

    def shown(name: str) -> Column:
        return F.coalesce(get(name), F.lit(""))

    title = get("eventTitle")
    fallback = F.substring(
        F.sha2(
            F.concat_ws(
                "-", F.lit(kind), shown("eventDate"), shown("eventTitle"),
                shown("companySlug"), index.cast("string"),
            ),
            256,
        ),
        1, 16,
    )
    company = get("companyName") if "companyName" in fields else get("company")
    return F.struct(
        _first_given(get("eventId"), fallback).alias("eventId"),
        _first_given(title, F.lit(UNKNOWN_EVENT)).alias("eventTitle"),
        tx.empty_to_null(get("eventDescription")).alias("eventDescription"),
        tx.empty_to_null(get("eventDate")).alias("eventDate"),
        tx.empty_to_null(get("companySlug")).alias("companySlug"),
        tx.empty_to_null(tx.display_case(company)).alias("companyName"),
        tx.empty_to_null(tx.display_case(get("city"))).alias("city"),
        tx.empty_to_null(get("state")).alias("state"),
        source.alias("agency"),
    )


def _event_fields(gold: DataFrame, column: str) -> set[str]:
    kind = gold.schema[column].dataType
    array = kind.valueType if kind.typeName() == "map" else kind
    return set(array.elementType.fieldNames())


def recent_by_agency(gold: DataFrame, kind: str) -> Column:
    """source -> shaped events; sources upper-cased, empty lists dropped."""
    fields = _event_fields(gold, "recentByEventSource")
    filled = F.map_filter("recentByEventSource", lambda _, v: F.size(v) > 0)
    shaped = F.transform_values(
        filled,
        lambda k, v: F.transform(
            v, lambda e, i: shaped_event(e, i, kind, F.upper(k), fields)
        ),
    )
    # Sources that differ only in case share a key: their lists are joined.
    entries = F.map_entries(shaped)
    keys = F.array_distinct(F.transform(entries, lambda e: F.upper(e["key"])))
    return F.map_from_arrays(
        keys,
        F.transform(keys, lambda k: F.flatten(F.transform(
            F.filter(entries, lambda e: F.upper(e["key"]) == k), lambda e: e["value"]
        ))),
    )


def flat_recents(gold: DataFrame, kind: str) -> Column:
    """All sources' lists as one, newest first. The lists hold five per source;
    ``first_page`` shortens what a page shows."""
    fields = _event_fields(gold, "recentByEventSource")
    tagged = F.flatten(
        F.transform(
            F.map_entries("recentByEventSource"),
            lambda kv: F.transform(
                kv["value"], lambda e: F.struct(kv["key"].alias("source"), e.alias("event"))
            ),
        )
    )

    def newer(a: Column, b: Column) -> Column:
        da = F.coalesce(a["event"]["eventDate"], F.lit(""))
        db = F.coalesce(b["event"]["eventDate"], F.lit(""))
        ia, ib = a["event"]["eventId"], b["event"]["eventId"]
        return (
            F.when(da > db, -1).when(da < db, 1)
            .when(ia < ib, -1).when(ia > ib, 1).otherwise(0)
        )

    return F.transform(
        F.array_sort(tagged, newer),
        lambda x, i: shaped_event(x["event"], i, kind, F.upper(x["source"]), fields),
    )


def _keyed(gold: DataFrame, pk: Column, updated_at: Column, *columns: Column) -> DataFrame:
    return gold.select(
        pk.alias("PK"), F.lit(SUMMARY).alias("SK"), *columns, updated_at.alias("updatedAt")
    )


def nation_documents(gold: DataFrame, updated_at: Column) -> DataFrame:
    items = F.transform(
        "states_directory",
        lambda s: F.struct(
            F.lower(_first_given(s["slug"], s["name"])).alias("slug"),
            F.upper(s["name"]).alias("abbreviation"),
            places.state_name(s["name"]).alias("name"),
            tx.whole_number(s["count"]).alias("count"),
        ),
    )
    stats = F.struct(
        F.col("total_events").alias("totalEvents"), F.col("total_states").alias("totalStates"),
        F.col("total_cities").alias("totalCities"),
        F.col("total_companies").alias("totalCompanies"),
    )
    return _keyed(
        gold, F.lit(NATION_KEY), updated_at,
        F.lit("United States").alias("name"), F.lit("usa").alias("slug"),
        stats.alias("stats"), items.alias("directory"),
    )


def state_documents(gold: DataFrame, updated_at: Column) -> DataFrame:
    code = F.upper("state")
    items = F.transform(
        "cities_directory",
        lambda c: _item(
            _first_given(
                tx.strip_key_prefix(c["slug"], "CITY"),
                F.concat(code, F.lit("-"), tx.underscored(c["name"])),
            ),
            _first_given(tx.display_case(c["name"]), c["slug"]),
            c["count"],
        ),
    )
    stats = F.struct(
        F.col("total_events").alias("totalEvents"), F.col("total_cities").alias("totalCities"),
        F.col("total_companies").alias("totalCompanies"),
    )
    return _keyed(
        gold, F.concat(F.lit("STATE#"), code), updated_at,
        places.state_name(F.col("state")).alias("name"), F.lower(code).alias("slug"),
        code.alias("abbreviation"), stats.alias("stats"), items.alias("directory"),
        recent_by_agency(gold, "state").alias("recentByAgency"),
    )


def city_documents(gold: DataFrame, updated_at: Column) -> DataFrame:
    slug = tx.strip_key_prefix(F.col("city_slug"), "CITY")
    items = F.transform(
        "companies_directory",
        lambda c: _item(
            tx.strip_key_prefix(c["slug"], "COMPANY", "SLUG"),
            _first_given(tx.display_case(c["name"]), tx.display_case(c["slug"])),
            c["count"],
        ),
    )
    name = _first_given(
        tx.display_case(F.col("city")), tx.display_case(F.substring_index(slug, "-", -1))
    )
    stats = F.struct(
        F.col("total_events").alias("totalEvents"),
        F.col("total_companies").alias("totalCompanies"),
    )
    return _keyed(
        gold, F.concat(F.lit("CITY#"), slug), updated_at,
        name.alias("name"), slug.alias("slug"), F.upper("state").alias("state"),
        places.state_name(F.col("state")).alias("stateName"), stats.alias("stats"),
        items.alias("directory"), recent_by_agency(gold, "city").alias("recentByAgency"),
    )


def _activity() -> Column:
    return F.struct(
        F.col("total_events").alias("totalEvents"), F.col("last_active").alias("lastActive")
    )


def company_documents(
    gold: DataFrame, updated_at: Column, sites: DataFrame | None = None
) -> DataFrame:
    """``sites`` (company_slug, sites) adds the site list where a company has one."""
    slug = tx.strip_key_prefix(F.col("company_slug"), "COMPANY", "SLUG")
    name = _first_given(tx.display_case(F.col("company_name")), tx.display_case(slug))
    extra = []
    if sites is not None:
        gold = gold.join(sites, "company_slug", "left")
        extra = [F.col("sites")]
    return _keyed(
        gold, F.concat(F.lit("COMPANY#"), slug), updated_at,
        name.alias("name"), slug.alias("slug"), _activity().alias("stats"), *extra,
        flat_recents(gold, "company").alias("recentEvents"),
    )


def site_page_documents(pages: DataFrame, updated_at: Column) -> DataFrame:
    """The second and later pages of companies' sites, below the company's key."""
    slug = tx.strip_key_prefix(F.col("company_slug"), "COMPANY", "SLUG")
    return pages.where("page > 1").select(
        F.concat(F.lit("COMPANY#"), slug).alias("PK"),
        F.concat(F.lit("SITES#"), F.lpad(F.col("page").cast("string"), 8, "0")).alias("SK"),
        "page", "sites", updated_at.alias("updatedAt"),
    )


def site_documents(
    gold: DataFrame, updated_at: Column, siblings: DataFrame | None = None
) -> DataFrame:
    """``siblings`` (company_slug, site_id, siblings) adds the other sites."""
    slug = tx.strip_key_prefix(F.col("company_slug"), "COMPANY", "SLUG")
    company = _first_given(F.col("company_name"), slug)
    fields = _event_fields(gold, "recent_events")
    recents = F.transform(
        F.coalesce("recent_events", F.array().cast(gold.schema["recent_events"].dataType)),
        lambda e, i: shaped_event(e, i, "site", F.upper(e["eventSource"]), fields),
    )
    extra = []
    if siblings is not None:
        gold = gold.join(siblings, ["company_slug", "site_id"], "left")
        extra = [F.col("siblings")]
    return _keyed(
        gold, F.concat(F.lit("SITE#"), slug, F.lit("_"), "site_id"), updated_at,
        F.concat(company, F.lit(" #"), "site_id").alias("name"),
        F.col("site_id").alias("siteId"), slug.alias("companySlug"),
        company.alias("companyName"), _activity().alias("stats"), *extra,
        recents.alias("recentEvents"),
    )


class Facts(NamedTuple):
    """What dimensions add to documents, by level: ``meta`` has a frame (slug, further
    columns) whose columns become the document's ``meta``, ``subtitles`` a frame (slug,
    subtitle) for the items of its directory."""

    meta: dict[str, DataFrame] = {}
    subtitles: dict[str, DataFrame] = {}

    def told(self, docs: DataFrame, level: str) -> DataFrame:
        if level in self.meta:
            docs = with_meta(docs, self.meta[level])
        if level in self.subtitles:
            docs = with_subtitles(docs, self.subtitles[level])
        return docs


def _one_each(rows: DataFrame, value: Column) -> DataFrame:
    """One value a slug, the largest of several, so that no document multiplies."""
    known = rows.where("slug is not null")
    return known.groupBy(F.col("slug").alias("_slug")).agg(F.max(value).alias("_value"))


def with_meta(docs: DataFrame, dimension: DataFrame) -> DataFrame:
    """Documents with ``meta``, null where the dimension does not know the slug."""
    fields = [c for c in dimension.columns if c != "slug"]
    side = _one_each(dimension, F.struct(*[dimension[c] for c in fields]))
    joined = docs.join(side, docs["slug"] == F.col("_slug"), "left")
    return joined.select(*[docs[c] for c in docs.columns], F.col("_value").alias("meta"))


def with_subtitles(docs: DataFrame, subtitles: DataFrame) -> DataFrame:
    """Items of the directories with ``subtitle``, in their order. The items are joined one
    by one, so neither side needs to be small."""
    key = ["PK", "SK"]
    items = docs.select(*key, F.posexplode("directory").alias("_at", "_item"))
    side = _one_each(subtitles, F.col("subtitle"))
    told = items.join(side, F.col("_item.slug") == F.col("_slug"), "left").select(
        *key, "_at", F.struct("_item.*", F.col("_value").alias("subtitle")).alias("_item")
    )
    lists = told.groupBy(*key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", "_item"))), lambda x: x["_item"]).alias("_list")
    )
    empty = F.when(F.col("directory").isNotNull(), F.array().cast(lists.schema["_list"].dataType))
    return docs.join(lists, key, "left").withColumn("directory", F.coalesce("_list", empty)).drop("_list")


def keys_of(entities: dict[str, DataFrame]) -> DataFrame:
    """(level, PK) of entities given by their keys."""
    slug = tx.strip_key_prefix(F.col("company_slug"), "COMPANY", "SLUG")
    key = {
        "state": lambda: F.concat(F.lit("STATE#"), F.upper("state")),
        "city": lambda: F.concat(F.lit("CITY#"), tx.strip_key_prefix(F.col("city_slug"), "CITY")),
        "company": lambda: F.concat(F.lit("COMPANY#"), slug),
        "site": lambda: F.concat(F.lit("SITE#"), slug, F.lit("_"), "site_id"),
    }
    return reduce(DataFrame.unionByName, [
        rows.select(F.lit(level).alias("level"), key[level]().alias("PK")) for level, rows in entities.items()
    ])


BUILDERS = {
    "nation": nation_documents, "state": state_documents, "city": city_documents,
    "company": company_documents, "site": site_documents,
}


def first_page(docs: DataFrame, level: str) -> DataFrame:
    """What a page shows before it is expanded: the head of its lists."""
    heads = {}
    if "directory" in docs.columns:
        page = vocab.NATION_DIRECTORY_PAGE if level == "nation" else vocab.DIRECTORY_PAGE
        heads["directory"] = F.slice("directory", 1, page)
    if level == "company":
        page = F.lit(vocab.COMPANY_RECENTS_PAGE)
        if "sites" in docs.columns:
            has_sites = F.coalesce(F.size("sites") > 0, F.lit(False))
            page = F.when(has_sites, vocab.COMPANY_RECENTS_WITH_SITES).otherwise(page)
        heads["recentEvents"] = F.slice("recentEvents", F.lit(1), page)
    return docs.withColumns(heads) if heads else docs


# Kinds of documents that are kept with another level's.
PARTS = {"company_sites": "company"}


def serving_table(documents: dict[str, DataFrame]) -> DataFrame:
    """All levels in one table: key, level, the document as JSON, its time."""
    rows = None
    for level, docs in documents.items():
        level = PARTS.get(level, level)
        body = F.to_json(F.struct(*[c for c in docs.columns if c not in ("PK", "SK")]))
        part = docs.select(
            "PK", "SK", F.lit(level).alias("level"), body.alias("document"), "updatedAt"
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows
