"""City, company and state dimensions and the alias index over them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook import schemas, vocab
from casebook.functions import companies, places
from casebook.functions import text as tx


def _usable_place() -> Column:
    return F.coalesce((F.col("USPS") != "") & (F.col("NAME") != ""), F.lit(False))


def cities(gazetteer: DataFrame) -> DataFrame:
    """One row per city key, the first of its lines; ``copies`` counts them all.

    Both come out of one aggregate, so the gazetteer is read once and lines of one
    key shrink to a row per task before they move.
    """
    part = places.place_parts(F.col("NAME"))
    named = (
        gazetteer.where(_usable_place())
        .withColumn("place", part)
        .withColumn("slug_part", tx.underscored(F.col("place.name")))
        .withColumn("city_slug", F.concat(F.upper("USPS"), F.lit("-"), "slug_part"))
    )
    kept = F.struct("place", "slug_part", *[c for c in gazetteer.columns if c != "line"])
    first = named.groupBy("city_slug").agg(
        F.min_by(kept, "line").alias("first"), F.count("*").alias("copies")
    ).select("city_slug", "copies", "first.*")
    value = lambda c: tx.blank_to_null(F.col(c))
    return first.select(
        "city_slug",
        F.col("place.kind").alias("place_type"),
        F.col("place.name").alias("name"),
        F.col("USPS").alias("state"),
        F.struct(value("INTPTLAT").alias("lat"), value("INTPTLONG").alias("lon")).alias("location"),
        F.struct(
            value("ALAND").alias("land_sqm"), value("AWATER").alias("water_sqm"),
            value("ALAND_SQMI").alias("land_sqmi"), value("AWATER_SQMI").alias("water_sqmi"),
        ).alias("area"),
        F.struct(value("GEOID").alias("geoid"), value("ANSICODE").alias("ansi")).alias("census"),
        F.concat("slug_part", F.lit("-"), F.lower("USPS")).alias("alias_key"),
        places.simple_place_alias(F.col("place.name")).alias("simple_alias"),
        "copies",
    )


def city_load_counts(gazetteer: DataFrame) -> DataFrame:
    """What a city load takes in: lines, skipped, imported, and key collisions."""
    usable = _usable_place()
    name = places.place_parts(F.col("NAME"))["name"]
    key = F.when(usable, F.concat(F.upper("USPS"), F.lit("-"), tx.underscored(name)))
    per_key = gazetteer.groupBy(key.alias("city_slug")).agg(F.count("*").alias("n"))
    named = F.col("city_slug").isNotNull()
    return per_key.agg(
        F.sum("n").alias("lines"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("skipped"),
        F.count("city_slug").alias("imported"),
        F.coalesce(F.sum(F.when(named, F.col("n") - 1)), F.lit(0)).alias("collisions"),
    )


def city_aliases(dim: DataFrame) -> DataFrame:
    """Canonical alias of every city and the colloquial one where it has one."""
    target = F.concat(F.lit("CITY#"), "city_slug")
    keys = F.array_compact(
        F.array("alias_key", F.concat(F.upper("state"), F.lit("-"), "simple_alias"))
    )
    return dim.select(F.explode(keys).alias("alias_key"), target.alias("target"))


def listed_companies(listings: DataFrame) -> DataFrame:
    """One row per company slug, folded over its securities in file order.

    Two levels: first per (slug, symbol), which combines map-side and leaves
    one row per ticker; only those rows are gathered per company.
    """
    text = lambda c: tx.blank_to_null(F.col(c))
    symbol, raw = tx.trim(F.col("symbol")), tx.trim(F.col("name"))
    rows = (
        listings.withColumn("symbol", symbol).withColumn("raw_name", raw)
        .where("symbol <> '' and raw_name <> ''")
        .withColumn("clean_name", companies.listed_name(F.col("raw_name")))
        .withColumn("slug", tx.slugify(F.col("clean_name")))
        .select(
            "slug", "symbol", "line", "clean_name",
            text("sector").alias("sector"), text("industry").alias("industry"),
            text("country").alias("country"), text("marketcap").alias("market_cap"),
            text("ipoyear").alias("ipo_year"),
            F.struct(
                companies.share_type(F.col("raw_name")).alias("type"),
                "raw_name",
                text("lastsale").alias("price"),
                text("netchange").alias("net_change"),
                text("%change").alias("pct_change"),
                text("volume").alias("volume"),
                text("marketcap").alias("market_cap"),
            ).alias("quote"),
        )
    )

    def earliest(value: str) -> Column:
        return F.min_by(value, "line")

    def earliest_given(value: str) -> Column:
        # A null ordering value is skipped, so only rows with a value compete.
        return F.min_by(value, F.when(F.col(value).isNotNull(), F.col("line")))

    head = F.struct("clean_name", "industry", "country", "ipo_year")
    per_ticker = rows.withColumn("head", head).groupBy("slug", "symbol").agg(
        F.min("line").alias("line"),
        F.max_by("quote", "line").alias("quote"),
        earliest("head").alias("head"),
        earliest_given("sector").alias("sector"),
        F.min(F.when(F.col("sector").isNotNull(), F.col("line"))).alias("sector_line"),
        earliest_given("market_cap").alias("market_cap"),
        F.min(F.when(F.col("market_cap").isNotNull(), F.col("line"))).alias("cap_line"),
    )
    tickers = F.map_from_entries(
        F.transform(
            F.sort_array(F.collect_list(F.struct("line", "symbol", "quote"))),
            lambda t: F.struct(t["symbol"], t["quote"]),
        )
    )
    return (
        per_ticker.groupBy("slug")
        .agg(
            F.min_by("head", "line").alias("head"),
            F.min_by("sector", "sector_line").alias("sector"),
            F.min_by("market_cap", "cap_line").alias("market_cap"),
            tickers.alias("tickers"),
            F.min_by("symbol", "line").alias("primary_ticker"),
        )
        .select(
            "slug", F.col("head.clean_name").alias("name"), "sector",
            F.col("head.industry").alias("industry"), F.col("head.country").alias("country"),
            "market_cap", F.col("head.ipo_year").alias("ipo_year"), "tickers",
            "primary_ticker",
        )
    )


def listing_load_counts(listings: DataFrame) -> DataFrame:
    """What a listing load takes in: lines, skipped, and distinct companies."""
    usable = F.coalesce((tx.trim("symbol") != "") & (tx.trim("name") != ""), F.lit(False))
    slug = F.when(usable, tx.slugify(companies.listed_name(tx.trim(F.col("name")))))
    per_slug = listings.groupBy(slug.alias("slug")).agg(F.count("*").alias("n"))
    return per_slug.agg(
        F.sum("n").alias("lines"),
        F.coalesce(F.sum(F.when(F.col("slug").isNull(), F.col("n"))), F.lit(0)).alias("skipped"),
        F.count("slug").alias("companies"),
    )


def listed_company_aliases(dim: DataFrame) -> DataFrame:
    """Every ticker, and the cleaned name where it differs from the slug."""
    words = companies.listed_alias(F.col("name"))
    by_name = F.when((words != "") & (words != F.col("slug")), companies.unspaced(words))
    keys = F.concat(
        F.transform(F.map_keys("tickers"), F.lower), F.array_compact(F.array(by_name))
    )
    return dim.select(
        F.explode(keys).alias("alias_key"),
        F.concat(F.lit("SLUG#"), "slug").alias("target"),
    )


def states(spark: SparkSession) -> DataFrame:
    rows = [(c, n) for c, n in vocab.STATE_NAMES.items() if c not in vocab.UNSEEDED_STATES]
    return spark.createDataFrame(rows, "abbr string, name string")


def state_aliases(dim: DataFrame) -> DataFrame:
    return dim.select(
        tx.underscored(F.col("name")).alias("alias_key"),
        F.concat(F.lit("STATE#"), "abbr").alias("target"),
    )


CURATED = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("slug", T.StringType()),
        T.StructField("aliases", T.ArrayType(T.StringType())),
    ]
)


def curated_companies(
    spark: SparkSession, rows: Iterable[tuple[str, str, list[str]]]
) -> DataFrame:
    """Hand-kept companies: (name, slug, further aliases)."""
    given = spark.createDataFrame(list(rows), CURATED)
    return given.withColumn("slug", tx.trim(F.lower("slug")))


def curated_aliases(dim: DataFrame) -> DataFrame:
    keys = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    return dim.select(
        F.explode(F.transform(keys, lambda k: tx.trim(F.lower(k)))).alias("alias_key"),
        F.concat(F.lit("COMPANY#"), "slug").alias("target"),
    )


def alias_index(*producers: DataFrame) -> DataFrame:
    """All producers' aliases in one (alias_key, target) table."""
    index = producers[0].select("alias_key", "target")
    for more in producers[1:]:
        index = index.unionByName(more.select("alias_key", "target"))
    return index.where("alias_key is not null").distinct()


def find_alias(index: DataFrame, key: str) -> DataFrame:
    return index.where(F.col("alias_key") == key)


def company_lookup(index: DataFrame) -> DataFrame:
    """alias_key -> company slug. Smallest target wins, so curated beats listed."""
    kinds = ("COMPANY", "SLUG")
    only = index.where(F.col("target").rlike(f"(?i)^({'|'.join(kinds)})#"))
    return (
        only.groupBy("alias_key").agg(F.min("target").alias("target"))
        .select("alias_key", tx.strip_key_prefix(F.col("target"), *kinds).alias("company_slug"))
    )


def city_lookup(dim: DataFrame, index: DataFrame) -> DataFrame:
    """Every city key an event may carry: canonical slugs and alias keys."""
    return (
        dim.select(F.col("city_slug").alias("city_key"))
        .unionByName(
            index.where(F.col("target").startswith("CITY#"))
            .select(F.col("alias_key").alias("city_key"))
        )
        .distinct()
    )


def write_dimension(dim: DataFrame, path: str) -> None:
    """Dimensions are small and replaced as a whole."""
    dim.write.mode("overwrite").parquet(path)


def load_cities(gazetteer: DataFrame, path: str) -> dict[str, int]:
    """Write the city dimension; returns what the load took in. The counters are
    observed on the rows as they pass, so nothing is read or computed for them."""
    lines, keys = Observation("gazetteer lines"), Observation("city keys")
    counted = gazetteer.observe(
        lines, F.count("*").alias("lines"), F.count_if(~_usable_place()).alias("skipped")
    )
    dim = cities(counted).observe(
        keys, F.count("*").alias("imported"), F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("collisions")
    )
    write_dimension(dim, path)
    return {**lines.get, **keys.get}


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table, None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem):
            return None
        raise


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ALIASES).parquet(path)
