"""Reports and facets over silver: rankings, scores, trends, searches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook import vocab
from casebook.functions import events
from casebook.operators import ranks, rollup

FATALITIES = ("total_deaths", "total_injury_deaths", "total_illness_deaths")
HOSPITALISATIONS = ("injuries_hospitalized",)
AMPUTATIONS = ("injuries_amputation",)
INJURIES = ("injuries_total", "injuries_hospitalized", "injuries_amputation", "injuries_eye_loss")
FINES = ("fine_amount",)
SEVERITIES = {
    "fatalities": FATALITIES, "hospitalizations": HOSPITALISATIONS, "amputations": AMPUTATIONS,
}


def state_summary(silver: DataFrame) -> DataFrame:
    """Events, companies and cities per state."""
    cube = rollup.event_cube(silver)
    return rollup.state_stats(cube)


def only_state(silver: DataFrame, state: str) -> DataFrame:
    """Scope to one state; the equality reaches the Parquet scan."""
    return silver.where(F.col("state") == state)


def top_companies(
    silver: DataFrame, keys: Sequence[str] = ("state",), top: int = vocab.TOP_COMPANIES
) -> DataFrame:
    """Companies with most events per key (no keys: nation-wide), ranked.

    The ranking runs over counts, and its limit also before the exchange.
    """
    rows = silver.where("company_slug is not null")
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    counts = rows.groupBy(*keys, "company_slug").agg(F.count("*").alias("event_count"))
    order = [F.desc("event_count"), F.asc("company_slug")]
    return rollup.ranked(counts, keys, order, top)


def recent_in_state(silver: DataFrame, top: int = vocab.RECENT_IN_STATE) -> DataFrame:
    rows = silver.where("state is not null")
    return rollup.ranked(rows, ["state"], rollup.newest_first(), top)


def since_years(silver: DataFrame, as_of: Column, years: int | None) -> DataFrame:
    """Events of the last N years before a given day; None keeps them all."""
    if years is None:
        return silver
    return silver.where(F.col("event_date") >= _years_before(as_of, years))


def _years_before(as_of: Column, years: int) -> Column:
    return (as_of - F.make_ym_interval(F.lit(years))).cast("timestamp")


def _detail(*keys: str) -> Column:
    return events.number_sum(*[F.col(f"details.{k}") for k in keys])


def severity_filter(silver: DataFrame, severity: str) -> DataFrame:
    keys = SEVERITIES[severity]
    return events.with_details(silver, *keys).where(_detail(*keys) > 0).drop("details")


def severity_facets(silver: DataFrame) -> DataFrame:
    """Every event once per severity it has, for all facets in one pass."""
    parsed = events.with_details(silver, *[k for keys in SEVERITIES.values() for k in keys])
    hits = F.array_compact(
        F.array(*[F.when(_detail(*keys) > 0, F.lit(name)) for name, keys in SEVERITIES.items()])
    )
    return parsed.withColumn("severity", F.explode(hits)).drop("details")


def range_facets(silver: DataFrame, as_of: Column, years: Sequence[int] = (1, 5, 10)) -> DataFrame:
    """Every event once per date range it falls in (``all`` included), one pass."""
    day = F.col("event_date")
    ranges = [
        F.when(day >= _years_before(as_of, n), F.lit(str(n))) for n in years
    ]
    return silver.withColumn("range", F.explode(F.array_compact(F.array(F.lit("all"), *ranges))))


def directory_search(directory: DataFrame, text: str) -> DataFrame:
    """Items whose name holds the text, whatever the case."""
    return directory.where(F.contains(F.lower("name"), F.lower(F.lit(text))))


def directory_page(directory: DataFrame, keys: Sequence[str], page: int) -> DataFrame:
    """The first page of each directory."""
    return rollup.ranked(directory, keys, [F.desc("count"), F.asc("slug")], page)


def directory_pages(
    directory: DataFrame, keys: Sequence[str], page: int = vocab.DIRECTORY_PAGE
) -> DataFrame:
    """(keys, page, items): all pages of each directory, most events first."""
    order = [F.desc("count"), F.asc("slug")]
    return ranks.pages(directory, keys, order, F.struct("slug", "name", "count"), page)


ORDERINGS = {
    "most_incidents": lambda: [F.desc("count"), F.asc("slug")],
    "most_recent": lambda: [F.col("last_date").desc_nulls_last(), F.asc("slug")],
    "highest_fines": lambda: [F.col("fines").desc_nulls_last(), F.asc("slug")],
    "alphabetical": lambda: [F.asc("name"), F.asc("slug")],
}


def ordered_directory(directory: DataFrame, by: str = "most_incidents") -> DataFrame:
    """A directory in one of the page orders (a range-partitioned sort)."""
    return directory.orderBy(*ORDERINGS[by]())


def company_directory(silver: DataFrame) -> DataFrame:
    """Companies with the fields every ordering needs."""
    known = events.with_details(silver.where("company_slug is not null"), *FINES)
    named = known.groupBy(F.col("company_slug").alias("slug"), "company_name").agg(
        F.count("*").alias("count"), F.max("event_date").alias("last_date"),
        F.sum(_optional_number(*FINES)).alias("fines"),
    )
    return named.groupBy("slug").agg(
        F.max("company_name").alias("name"), F.sum("count").alias("count"),
        F.max("last_date").alias("last_date"), F.sum("fines").alias("fines"),
    )


def _optional_number(*keys: str) -> Column:
    """Sum of the given overflow fields, null where none of them is a number."""
    given = F.coalesce(*[events.number(F.col(f"details.{k}")) for k in keys])
    return F.when(given.isNotNull(), _detail(*keys))


def severity_stats(silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Injuries, fatalities and fines per key; no fines on record stay null."""
    fields = dict.fromkeys((*INJURIES, *FATALITIES, *HOSPITALISATIONS, *FINES))
    parsed = events.with_details(silver, *fields)
    fine = _optional_number(*FINES)
    return parsed.groupBy(*keys).agg(
        F.count("*").alias("total_events"),
        F.sum(_detail(*INJURIES)).alias("total_injuries"),
        F.sum(_detail(*FATALITIES)).alias("total_fatalities"),
        F.sum(_detail(*HOSPITALISATIONS)).alias("total_hospitalisations"),
        F.sum(fine).alias("total_fines"),
        F.avg(fine).alias("avg_fines"),
    )


def safety_score(fatalities: Column, hospitalisations: Column, violations: Column) -> Column:
    """100 minus deductions, kept between 0 and 100."""
    lost = (
        fatalities * vocab.SCORE_PER_FATALITY
        + hospitalisations * vocab.SCORE_PER_HOSPITALISATION
        + violations * vocab.SCORE_PER_VIOLATION
    )
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.lit(vocab.SCORE_START) - lost))


def safety_scores(silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Score per key; every event counts as one violation."""
    stats = severity_stats(silver, keys)
    return stats.withColumn(
        "score",
        safety_score(
            F.col("total_fatalities"), F.col("total_hospitalisations"), F.col("total_events")
        ),
    )


def trend(silver: DataFrame, keys: Sequence[str], as_of: Column) -> DataFrame:
    """Events of the last 12 months against the 12 before, in one pass."""
    day = F.col("event_date")
    year = F.make_ym_interval(F.lit(1))
    end = as_of.cast("timestamp")
    middle, start = end - year, end - year - year
    recent = F.count(F.when((day >= middle) & (day < end), 1))
    before = F.count(F.when((day >= start) & (day < middle), 1))
    counts = silver.where((day >= start) & (day < end)).groupBy(*keys).agg(
        recent.alias("last_12m"), before.alias("previous_12m")
    )
    change = F.col("last_12m") - F.col("previous_12m")
    return counts.select(
        *keys, "last_12m", "previous_12m",
        F.when(change > 0, "up").when(change < 0, "down").otherwise("flat").alias("direction"),
        F.when(
            F.col("previous_12m") > 0,
            F.floor((F.abs(change) * 200 + F.col("previous_12m")) / (F.col("previous_12m") * 2)),
        ).alias("percentage"),
    )


def company_recents(silver: DataFrame, company: str, source: str | None = None, top: int = vocab.COMPANY_RECENTS_PAGE) -> DataFrame:
    """One company's newest events, of one source or of all."""
    rows = silver.where(F.col("company_slug") == company)
    if source is not None:
        rows = rows.where(F.col("event_source") == source)
    return rows.orderBy(*rollup.newest_first()).limit(top)


def with_subtitle(
    directory: DataFrame, dimension: DataFrame, key: str, subtitle: str
) -> DataFrame:
    """Directory items with a subtitle from a dimension (industry, state, ...)."""
    side = dimension.select(F.col(key).alias("slug"), F.col(subtitle).alias("subtitle"))
    return directory.join(side, "slug", "left")


def review_queue(silver: DataFrame) -> DataFrame:
    """Company names nothing resolved, with a count and one event to look at."""
    return (
        silver.where("company_slug is null and company_name is not null")
        .groupBy("company_name")
        .agg(F.count("*").alias("events"), F.min("event_id").alias("sample_event_id"))
    )


