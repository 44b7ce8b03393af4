"""Page URLs, cut into sitemap files of bounded size, and their index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casebook import vocab
from casebook.functions import text as tx

# Key kind -> (URL folder, sitemap file stem).
PAGES = {
    "STATE": ("state", "states"), "CITY": ("city", "cities"),
    "COMPANY": ("company", "companies"), "SITE": ("site", "sites"),
}
BUCKET_DIGITS = 3
# Where the files lie below the site's root.
FOLDER = "sitemaps"


def page_url(pk: Column, base: str) -> Column:
    """URL of a key's page; null for keys without a page of their own."""
    return F.coalesce(
        *[
            F.when(
                pk.startswith(f"{kind}#"),
                F.concat(F.lit(f"{base}/{folder}/"), F.substr(pk, F.lit(len(kind) + 2))),
            )
            for kind, (folder, _) in PAGES.items()
        ]
    )


def page_stem(pk: Column) -> Column:
    return F.coalesce(
        *[F.when(pk.startswith(f"{kind}#"), F.lit(stem)) for kind, (_, stem) in PAGES.items()]
    )


def urls(keys: DataFrame, base: str) -> DataFrame:
    pk = F.col("PK")
    return keys.select(page_stem(pk).alias("stem"), page_url(pk, base).alias("url")).where(
        "url is not null"
    )


def chunked(pages: DataFrame, per_file: int = vocab.SITEMAP_URLS) -> DataFrame:
    """Give every URL its file number within its stem.

    URLs are numbered in order of their digest. The digest's first digits cut
    each stem into equal buckets whose sizes are summed up front, so no task
    ever ranks a whole stem, however many pages it has.
    """
    digest = F.md5(F.col("url").cast("binary"))
    rows = pages.withColumn("digest", digest).withColumn(
        "bucket", F.substring("digest", 1, BUCKET_DIGITS)
    )
    sizes = rows.groupBy("stem", "bucket").agg(F.count("*").alias("n"))
    # At most 16 ** BUCKET_DIGITS rows per stem.
    running = Window.partitionBy("stem").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        "stem", "bucket", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("stem", "bucket").orderBy("digest", "url")
    place = F.col("start") + F.row_number().over(inside) - 1
    return rows.join(starts, ["stem", "bucket"]).select(
        "stem", "url", "digest", (F.floor(place / per_file) + 1).alias("chunk")
    )


def file_name(stem: Column, chunk: Column) -> Column:
    """``cities.xml``, ``cities-2.xml``, ... The first file has no number."""
    return F.when(chunk == 1, F.concat(stem, F.lit(".xml"))).otherwise(
        F.concat(stem, F.lit("-"), chunk.cast("string"), F.lit(".xml"))
    )


def file_names(pages: DataFrame, per_file: int = vocab.SITEMAP_URLS) -> DataFrame:
    """The files the pages will fill, from the page counts alone."""
    counts = pages.groupBy("stem").agg(F.count("*").alias("n"))
    numbers = F.sequence(F.lit(1), F.ceil(F.col("n") / per_file).cast("int"))
    return counts.select("stem", F.explode(numbers).alias("chunk")).select(
        file_name(F.col("stem"), F.col("chunk")).alias("file")
    )


def url_element(url: Column, day: Column) -> Column:
    return F.concat(
        F.lit("<url><loc>"), tx.xml_escape(url), F.lit("</loc><lastmod>"),
        F.date_format(day, "yyyy-MM-dd"),
        F.lit("</lastmod><changefreq>weekly</changefreq></url>"),
    )


def sitemap_files(chunks: DataFrame, day: Column) -> DataFrame:
    """(file, value): one XML text per file. A file holds at most one chunk of
    URLs, which bounds what a task gathers."""
    item = F.struct("digest", url_element(F.col("url"), day).alias("xml"))
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(item)), lambda x: x["xml"]), "\n"
    )
    head = (
        '<?xml version="1.0" encoding="UTF-8"?>\n'
        '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n'
    )
    return (
        chunks.groupBy("stem", "chunk").agg(body.alias("body"), F.count("*").alias("urls"))
        .select(
            file_name(F.col("stem"), F.col("chunk")).alias("file"),
            F.concat(F.lit(head), "body", F.lit("\n</urlset>")).alias("value"),
            "urls",
        )
    )


def sitemap_index(files: DataFrame, base: str, day: Column) -> DataFrame:
    """(file, value) of the index: one line per sitemap file."""
    line = F.concat(
        F.lit(f"<sitemap><loc>{base}/{FOLDER}/"), "file", F.lit("</loc><lastmod>"),
        F.date_format(day, "yyyy-MM-dd"), F.lit("</lastmod></sitemap>"),
    )
    head = (
        '<?xml version="1.0" encoding="UTF-8"?>\n'
        '<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n'
    )
    lines = F.array_join(F.array_sort(F.collect_list(line)), "\n")
    return files.select("file").agg(
        F.concat(F.lit(head), lines, F.lit("\n</sitemapindex>")).alias("value")
    ).select(F.lit("sitemap.xml").alias("file"), "value")


def published(files: DataFrame, index: DataFrame) -> DataFrame:
    """(file, value) below the site's root: the files where the index says they are."""
    own = files.select(F.concat(F.lit(f"{FOLDER}/"), "file").alias("file"), "value")
    return own.unionByName(index.select("file", "value"))
