"""Files the dimensions are built from: gazetteer (TSV) and listings (CSV)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.functions import text as tx

GAZETTEER_COLUMNS = (
    "USPS", "GEOID", "ANSICODE", "NAME", "ALAND", "AWATER", "ALAND_SQMI",
    "AWATER_SQMI", "INTPTLAT", "INTPTLONG",
)
LISTING_COLUMNS = (
    "symbol", "name", "lastsale", "netchange", "%change", "marketcap", "country",
    "ipoyear", "volume", "sector", "industry",
)


def _position():
    """Sortable place of a row: file, split, then order within the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Place rows after the line that holds both ``USPS`` and ``NAME``.

    Lines before it are a preamble. The header line is the first match of the
    file, so it is found by a small aggregate and joined on the file name.
    """
    lines = (
        spark.read.text(path)
        .select(_position().alias("line"), tx.trim("value").alias("value"))
        .where("value <> ''")
        .select("line", F.transform(F.split("value", "\t"), tx.trim).alias("cells"))
    )
    header = (
        lines.where(
            F.array_contains("cells", "USPS") & F.array_contains("cells", "NAME")
        )
        .groupBy(F.col("line.file").alias("file"))
        .agg(F.min_by("cells", "line").alias("header"), F.min("line").alias("start"))
    )
    rows = lines.join(header, F.col("line.file") == F.col("file")).where("line > start")

    def cell(name: str):
        place = F.array_position("header", name).cast("int")
        return F.when(place > 0, F.try_element_at("cells", F.greatest(place, F.lit(1))))

    return rows.select("line", *[cell(c).alias(c) for c in GAZETTEER_COLUMNS])


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Listed securities; header names are lower-cased and lose their spaces."""
    reader = (
        spark.read.option("header", True).option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    )
    raw = reader.csv(path)
    names = [c.lstrip("\ufeff").strip().lower().replace(" ", "") for c in raw.columns]
    positions = [f"c{i}" for i in range(len(names))]
    table = raw.toDF(*positions).select("*", _position().alias("line"))
    return table.select(
        "line",
        *[
            (F.col(positions[names.index(c)]) if c in names else F.lit(None).cast("string"))
            .alias(c)
            for c in LISTING_COLUMNS
        ],
    )
