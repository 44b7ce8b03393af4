"""Nation, state, city, company and site roll-ups of silver.

The levels share one shape: stats of a key, a directory of its children, and
the newest events per source. All counts come from one small cube (one row per
state, city, company and site), and all recents from one candidate set (the
newest events per cube cell and source), so silver is scanned twice for every
level together instead of three times per level. Many events are rolled up in groups
of cells, so that no step shuffles all of them at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casebook import session, vocab
from casebook.functions import dates

CELL = ("state", "city_slug", "company_slug")
FINE_CELL = (*CELL, "site_id")
LABELS = ("city", "company_name")
EVENT = (
    "event_source", "event_id", "event_title", "event_description", "event_date",
    "company_slug", "company_name", "city_slug", "city", "state", "site_id",
)


@dataclass(frozen=True)
class Level:
    """One roll-up: its key, its children and what an event of it shows."""

    name: str
    keys: tuple[str, ...]
    child: str | None
    child_label: str | None
    directory: str | None
    event: tuple[tuple[str, str], ...]


_HEAD = (
    ("eventId", "event_id"), ("eventTitle", "event_title"),
    ("eventDescription", "event_description"), ("eventDate", "event_date"),
)
_PLACE = (("city", "city"), ("state", "state"))
_COMPANY = (("companySlug", "company_slug"), ("companyName", "company_name"))

NATION = Level(
    "nation", (), "state", "state", "states_directory",
    (*_HEAD, ("company", "company_name"), *_PLACE),
)
STATE = Level(
    "state", ("state",), "city_slug", "city", "cities_directory",
    (*_HEAD, *_COMPANY, *_PLACE),
)
CITY = Level(
    "city", ("city_slug",), "company_slug", "company_name", "companies_directory",
    (*_HEAD, *_COMPANY, *_PLACE),
)
COMPANY = Level("company", ("company_slug",), None, None, None, (*_HEAD, *_PLACE))
SITE = Level("site", ("company_slug", "site_id"), None, None, None, (*_HEAD, *_PLACE))


def shown_events(silver: DataFrame, further: Sequence[str] = ()) -> DataFrame:
    """Roll-up columns (and further ones) only; enriched texts replace the raw ones."""
    return silver.select(
        *further,
        *[
            F.coalesce(f"bedrock_{c}", c).alias(c)
            if c in ("event_title", "event_description") else F.col(c)
            for c in EVENT
        ]
    )


def given(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    return rows


def event_cube(silver: DataFrame, cell: Sequence[str] = CELL) -> DataFrame:
    """Counts and date range per cell and its labels.

    The labels are grouping columns, not ``max`` aggregates: counts and dates
    have fixed width, so this pass over all events is a hash aggregate, and the
    sort that a text ``max`` needs happens later on the few rows of the cube.
    Partial sums run before the exchange, so a cell that holds a third of all
    events moves as one row per task.
    """
    return silver.groupBy(*cell, *LABELS).agg(
        F.count("*").alias("events"),
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
    )


def _total() -> Column:
    return F.sum("events").alias("total_events")


def city_stats(cube: DataFrame) -> DataFrame:
    return given(cube, CITY.keys).groupBy("city_slug").agg(
        F.max("city").alias("city"),
        F.max("state").alias("state"),
        _total(),
        F.count_distinct("company_slug").alias("total_companies"),
    )


def state_stats(cube: DataFrame) -> DataFrame:
    return given(cube, STATE.keys).groupBy("state").agg(
        _total(),
        F.count_distinct("company_slug").alias("total_companies"),
        F.count_distinct("city_slug").alias("total_cities"),
    )


def company_stats(cube: DataFrame) -> DataFrame:
    return given(cube, COMPANY.keys).groupBy("company_slug").agg(
        F.max("company_name").alias("company_name"),
        _total(),
        dates.stamp(F.max("last_date")).alias("last_active"),
    )


def site_stats(cube: DataFrame) -> DataFrame:
    """From a cube whose cells tell sites apart."""
    return given(cube, SITE.keys).groupBy(*SITE.keys).agg(
        F.max("company_name").alias("company_name"),
        _total(),
        dates.stamp(F.max("last_date")).alias("last_active"),
    )


def nation_totals(cube: DataFrame, as_of: Column) -> DataFrame:
    """Always exactly one row, also for an empty table."""
    return cube.agg(
        F.coalesce(F.sum("events"), F.lit(0).cast("bigint")).alias("total_events"),
        F.count_distinct("company_slug").alias("total_companies"),
        F.count_distinct("city_slug").alias("total_cities"),
        F.count_distinct("state").alias("total_states"),
        dates.stamp(F.min("first_date")).alias("first_seen"),
        dates.stamp(F.max("last_date")).alias("last_seen"),
    ).withColumn("aggregation_date", as_of.cast("date"))


def child_counts(cube: DataFrame, level: Level) -> DataFrame:
    """Events per key and child, events without a child included.

    Filtering on the key only keeps this reading of the cube equal to the one
    the stats use, so the two share one exchange.
    """
    counted = given(cube, level.keys).groupBy(*level.keys, level.child).agg(
        F.max(level.child_label).alias("name"), F.sum("events").alias("count")
    )
    slug = F.lower(level.child) if level.child == "state" else F.col(level.child)
    return counted.select(*level.keys, slug.alias("slug"), "name", "count")


def directory(cube: DataFrame, level: Level) -> DataFrame:
    """Long form of a directory: key, child slug, label, events of the child."""
    return child_counts(cube, level).where("slug is not null")


def ranked(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], top: int | None = None
) -> DataFrame:
    """First ``top`` rows per key (None: all) with their ``rank``. A limit is
    applied before the exchange as well, so hot keys arrive already short."""
    window = Window.partitionBy(*keys).orderBy(*order)
    if top is None:
        return rows.withColumn("rank", F.row_number().over(window))
    if not keys:
        # A global top-k: each task keeps its own best rows first.
        rows = rows.orderBy(*order).limit(top)
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top)


NEWEST = ("event_date", "event_id")


def newest_first() -> list[Column]:
    return [F.col("event_date").desc_nulls_last(), F.col("event_id").asc()]


def recent_events(
    events: DataFrame, keys: Sequence[str], top: int = vocab.RECENT_PER_SOURCE
) -> DataFrame:
    """Newest events per key and source, with their rank."""
    rows = given(events, (*keys, "event_source"))
    return ranked(rows, [*keys, "event_source"], newest_first(), top)


def recent_candidates(
    events: DataFrame, top: int = vocab.RECENT_PER_SOURCE, cell: Sequence[str] = CELL
) -> DataFrame:
    """Newest events per cube cell and source. The newest of any coarser key are
    among them, since every coarser group is a union of cells."""
    keys = [*cell, "event_source"]
    # A hash of the key leads, so that sorting compares numbers before it compares texts.
    return ranked(events.withColumn("_hash", F.xxhash64(*keys)), ["_hash", *keys], newest_first(), top).drop("rank", "_hash")


def _event_struct(level: Level) -> Column:
    return F.struct(
        *[
            (dates.stamp(F.col(c)) if c == "event_date" else F.col(c)).alias(name)
            for name, c in level.event
        ]
    )


def directory_arrays(rows: DataFrame, level: Level) -> DataFrame:
    """One array per key, most events first. An array holds one item per known
    child (states, registered cities, registered companies): its length follows
    the registry, not the number of events."""
    item = F.when(
        F.col("slug").isNotNull(), F.struct(F.negative("count").alias("o"), "slug", "name", "count")
    )
    in_order = F.transform(
        F.array_sort(F.collect_list(item)),
        lambda x: F.struct(x["slug"].alias("slug"), x["name"].alias("name"), x["count"].alias("count")),
    )
    return rows.groupBy(*level.keys).agg(in_order.alias(level.directory))


def recent_maps(recents: DataFrame, level: Level) -> DataFrame:
    """source -> newest events. A key gathers at most five rows per source, in
    one aggregate; the map is then cut out of that short list."""
    gathered = recents.groupBy(*level.keys).agg(
        F.array_sort(
            F.collect_list(
                F.struct("event_source", "rank", _event_struct(level).alias("event"))
            )
        ).alias("_recent")
    )
    sources = F.array_distinct(F.transform("_recent", lambda r: r["event_source"]))
    lists = F.transform(
        sources,
        lambda s: F.transform(
            F.filter("_recent", lambda r: r["event_source"] == s), lambda r: r["event"]
        ),
    )
    return gathered.select(
        *level.keys, F.map_from_arrays(sources, lists).alias("recentByEventSource")
    )


def recent_lists(events: DataFrame, level: Level, top: int) -> DataFrame:
    """One flat list per key, newest first, whatever the source."""
    rows = ranked(given(events, level.keys), level.keys, newest_first(), top)
    item = F.struct(
        "rank",
        F.struct(
            F.col("event_source").alias("eventSource"), _event_struct(level).alias("e")
        ).alias("event"),
    )
    names = [n for n, _ in level.event]
    return rows.groupBy(*level.keys).agg(
        F.transform(
            F.array_sort(F.collect_list(item)),
            lambda x: F.struct(
                x["event"]["eventSource"].alias("eventSource"),
                *[x["event"]["e"][n].alias(n) for n in names],
            ),
        ).alias("recent_events")
    )


def _or_empty(column: str, like: DataFrame) -> Column:
    kind = like.schema[column].dataType
    empty = F.create_map() if kind.typeName() == "map" else F.array()
    return F.coalesce(F.col(column), empty.cast(kind)).alias(column)


def _single_row(parts: Sequence[DataFrame]) -> DataFrame:
    """One-row frames put into one row: a union folded by ``first``, no join."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])


def assemble(stats: DataFrame, level: Level, recents: DataFrame, children: DataFrame | None) -> DataFrame:
    """stats, directory and recents side by side: each side has one row per key,
    so nothing fans out and no regrouping is needed."""
    parts = [directory_arrays(children, level)] if children is not None else []
    parts.append(recent_maps(recents, level))
    nested = [p.columns[-1] for p in parts]
    if level.keys:
        gold = stats
        for part in parts:
            gold = gold.join(part, list(level.keys), "left")
    else:
        gold = _single_row([stats, *parts])
    return gold.select(*stats.columns, *[_or_empty(c, gold) for c in nested])


def nation_gold(cube: DataFrame, candidates: DataFrame, as_of: Column) -> DataFrame:
    return assemble(
        nation_totals(cube, as_of), NATION, recent_events(candidates, ()),
        child_counts(cube, NATION),
    )


def state_gold(cube: DataFrame, candidates: DataFrame) -> DataFrame:
    return assemble(
        state_stats(cube), STATE, recent_events(candidates, STATE.keys),
        child_counts(cube, STATE),
    )


def city_gold(cube: DataFrame, candidates: DataFrame) -> DataFrame:
    """``state`` comes last: the files are partitioned by it."""
    gold = assemble(
        city_stats(cube), CITY, recent_events(candidates, CITY.keys),
        child_counts(cube, CITY),
    )
    return gold.select(*[c for c in gold.columns if c != "state"], "state")


def company_gold(cube: DataFrame, candidates: DataFrame) -> DataFrame:
    return assemble(
        company_stats(cube), COMPANY, recent_events(candidates, COMPANY.keys), None
    )


def site_gold(
    cube: DataFrame, candidates: DataFrame, top: int = vocab.RECENT_PER_SOURCE
) -> DataFrame:
    return site_stats(cube).join(recent_lists(candidates, SITE, top), list(SITE.keys), "left")


def coarse_candidates(candidates: DataFrame) -> DataFrame:
    """The newest by cells without sites, of candidates whose cells tell them apart: a
    small stored table that serves every level but the sites."""
    return session.stored(recent_candidates(candidates), "coarse-candidates")


def level_gold(name: str, cube: DataFrame, candidates: DataFrame, as_of: Column) -> DataFrame:
    if name == "nation":
        return nation_gold(cube, candidates, as_of)
    build = {"state": state_gold, "city": city_gold, "company": company_gold, "site": site_gold}
    return build[name](cube, candidates)


def levels_of(cube: DataFrame, candidates: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """Every level from a stored cube and stored candidates whose cells tell sites apart."""
    coarse = coarse_candidates(candidates)
    return {
        name: level_gold(name, cube, candidates if name == "site" else coarse, as_of)
        for name in ("nation", "state", "city", "company", "site")
    }


# Many events are rolled up in so many groups of cells, each of which reads silver.
CELL_GROUPS = 4


def by_cells(events: DataFrame, rows: int) -> list[DataFrame]:
    """The events in one frame, or in several where they are many; no cell is in two."""
    groups = session.groups(rows, range(CELL_GROUPS))
    if len(groups) == 1:
        return [events]
    group = F.pmod(F.xxhash64(*FINE_CELL), F.lit(CELL_GROUPS))
    return [events.where(group.isin(own)) for own in groups]


def all_gold(silver: DataFrame, as_of: Column) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Every level, and the two stored frames they share: no level reads silver again.
    Silver should be stored, as it is counted and read several times where it is large."""
    parts = by_cells(shown_events(silver), silver.count())

    def stored(rows: list[DataFrame], name: str) -> DataFrame:
        return session.stored(rows[0], name) if len(rows) == 1 else session.stored_in_turn(rows, name)

    cube = stored([event_cube(mine, FINE_CELL) for mine in parts], "cube")
    candidates = stored([recent_candidates(mine, cell=FINE_CELL) for mine in parts], "candidates")
    return levels_of(cube, candidates, as_of), [cube, candidates]
