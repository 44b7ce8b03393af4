"""Substring search over a directory by an index of letter trigrams."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
# Follows every name, so that each of its places begins a trigram.
_END = "\0" * GRAM


def _grams(name: Column) -> Column:
    """The trigram at every place of a name; an empty name has one place."""
    padded = F.concat(name, F.lit(_END))
    places = F.sequence(F.lit(1), F.greatest(F.length(name), F.lit(1)))
    return F.transform(places, lambda i: F.substr(padded, i, F.lit(GRAM)))


def write_index(directory: DataFrame, path: str) -> None:
    """Postings (gram, at, item) of every place of every name, and how many each gram has.

    A posting holds its whole item, so a search joins nothing: the index is about as many
    times the directory as names have letters. Postings are sorted by gram, in files of
    equal size whatever gram they hold; a search opens only row groups that enclose its
    grams. Items without a name are not found by any text, hence not in the index.
    """
    items = directory.where("name is not null").select(
        F.struct("*").alias("item"), F.posexplode(_grams(F.lower("name"))).alias("pos", "gram")
    )
    postings = items.select("gram", (F.col("pos") + 1).alias("at"), "item")
    dealt = postings.repartitionByRange("gram", F.xxhash64("item")).sortWithinPartitions("gram")
    dealt.write.mode("overwrite").parquet(_postings(path))
    kept = directory.sparkSession.read.schema(postings.schema).parquet(_postings(path))
    sizes = kept.groupBy("gram").agg(F.count("*").alias("n"))
    ordered = sizes.repartitionByRange("gram").sortWithinPartitions("gram")
    ordered.write.mode("overwrite").parquet(_sizes(path))


def _postings(path: str) -> str:
    return f"{path.rstrip('/')}/postings"


def _sizes(path: str) -> str:
    return f"{path.rstrip('/')}/grams"


def _rarest(spark: SparkSession, path: str, texts: dict[str, str]) -> list[tuple[str, str, str, int]]:
    """(text, lower-cased, gram, the gram's place in it): of each text its rarest gram, or
    all of a text that is shorter. Texts with a gram that no name has are left out."""
    grams = {low: [low[i : i + GRAM] for i in range(len(low) - GRAM + 1)] for low in texts.values()}
    wanted = sorted({g for own in grams.values() for g in own})
    # At most as many rows as the given texts have letters.
    held = spark.read.parquet(_sizes(path)).where(F.col("gram").isin(wanted)).collect() if wanted else []
    sizes = {r.gram: r.n for r in held}
    found = []
    for text, low in texts.items():
        own = grams[low]
        if all(g in sizes for g in own):
            gram = min(own, key=sizes.__getitem__, default=low)
            found.append((text, low, gram, own.index(gram) if own else 0))
    return found


def search(spark: SparkSession, path: str, texts: Sequence[str]) -> DataFrame:
    """(text, the item's columns): for each given text the items whose name holds it,
    whatever the case; an item once a text.

    Candidates are the postings of the text's rarest trigram; texts of two letters or
    fewer take those that begin with the text. A candidate counts if the text is in the
    name and this posting is that of its first occurrence.
    """
    given = spark.createDataFrame([(t,) for t in dict.fromkeys(texts)], "text string")
    lowered = {r.text: r.low for r in given.select("text", F.lower("text").alias("low")).collect()}
    asked = _rarest(spark, path, lowered)
    postings = spark.read.parquet(_postings(path))
    parts = []
    for size in sorted({len(gram) for _, _, gram, _ in asked}):
        own = [row for row in asked if len(row[2]) == size]
        choice = spark.createDataFrame(own, "text string, low string, key string, offset int")
        parts.append(
            postings.where(_begins([gram for _, _, gram, _ in own], size))
            .join(F.broadcast(choice), F.substring("gram", 1, size) == F.col("key"))
            .where(F.position("low", F.lower("item.name")) == F.col("at") - F.col("offset"))
            .where(F.col("at") > F.col("offset"))
            .select("text", "item.*")
        )
    if not parts:
        return postings.where("false").select(F.lit("").alias("text"), "item.*")
    return reduce(DataFrame.unionByName, parts)


def _begins(keys: list[str], size: int) -> Column:
    """What of it the scan can use: equal grams, or first letters."""
    if size == GRAM:
        return F.col("gram").isin(sorted(set(keys)))
    if size == 0:
        return F.col("at") == 1
    return reduce(Column.__or__, [F.startswith("gram", F.lit(k)) for k in sorted(set(keys))])
