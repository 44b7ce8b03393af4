"""Mixing sources to target weights by Pareto order sampling.

Every document of a source has an expected number of copies, the source's target over
its size. The whole part is certain. For the rest a document is ranked by its random
odds over its inclusion odds, and the lowest ranked are taken until the source's words
reach the target. Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm import common

WEIGHTS, CAP, SEED = (5, 2, 1), 3, "mix"
#: Ranks are counted in this many buckets a source before any row is sorted.
BUCKETS = 1 << 16


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target): the words each source should give.

    sizes has (source, source_size), one row a source. Sources by code point, null
    last, weigh `weights` in turn and share the total; a target stops at `cap` times
    its source's size and the rest is shared anew. In order of cap over weight the
    sources that stop come first, so one running sum finds them all. One row a source
    is all that is ever sorted here.
    """
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int"))
    everything = Window.partitionBy()
    ranked = (
        sizes.withColumn("weight", turn)
        .withColumn("ceiling", F.col("source_size") * cap)
        .withColumn("ratio", F.col("ceiling") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
    )
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("ceiling").over(before), F.lit(0))) / (
        F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    leveled = ranked.withColumn("level", level).withColumn("stops", F.col("level") > F.col("ratio"))
    share = F.min(F.struct("ratio", F.col("source").isNull().alias("z"), "source", "level")).over(Window.partitionBy("stops"))
    target = F.when(F.col("stops"), F.col("ceiling").cast("double")).otherwise(share["level"] * F.col("weight"))
    return leveled.select("source", "source_size", target.alias("target"))


def random_unit(id_column: str = "doc_id", seed: str = SEED) -> Column:
    """A number between 0 and 1 that depends on the id alone; null has one too."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def pareto_rank(u: Column, inclusion: Column) -> Column:
    """Random odds over inclusion odds, brought to 0..1; null where nothing is left to draw."""
    odds = (u / (1 - u)) * ((1 - inclusion) / inclusion)
    return F.when(inclusion > 0, odds / (1 + odds))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """All columns of docs and `mix`: struct(size, source_size, target, copies, taken).

    docs has doc_id, source and text, and any other columns; one called mix is
    replaced. Null text has size 0, null source is a source of its own, equal ids draw
    equal numbers. A source without words has target 0. No row is dropped: what is not
    taken has 0 copies. A rerun takes the same copies. An empty table gives no rows. A
    text of any length is counted whole.

    Ranks are summed in fixed buckets first, whatever a source's share of the rows, and
    only the bucket in which a source reaches its target is sorted.
    """
    return _mixed(docs.drop("mix"), weights, cap, seed).select("row.*", "mix")


def repeated(docs: DataFrame) -> DataFrame:
    """The mixed documents, a row for every copy taken, with the columns of docs."""
    taken = _mixed(docs).filter("mix.copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("mix.copies")))).select("row.*")


def _mixed(docs: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """(row, mix): each row of docs as it was, and what the mix takes of it."""
    sized = docs.select(
        F.struct("*").alias("row"), "source", "doc_id",
        common.words_in(F.col("text")).alias("size"), random_unit(seed=seed).alias("u"),
    )
    narrow = common.stored(sized.select("source", "size", "u"), "mix-sizes")
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    facts = (
        targets(sources, weights, cap)
        .withColumn("whole", F.floor(ratio).cast("int"))
        .withColumn("inclusion", ratio - F.floor(ratio))
        .withColumn("room", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    facts = common.stored(facts.select(F.struct(*facts.columns).alias("facts")), "mix-sources")

    def placed(rows: DataFrame, facts: DataFrame) -> DataFrame:
        rank = pareto_rank(F.col("u"), F.col("facts.inclusion"))
        return (
            rows.join(facts, F.col("source").eqNullSafe(F.col("facts.source")))
            .withColumn("rank", rank)
            .withColumn("bucket", F.floor(F.col("rank") * BUCKETS).cast("int"))
        )

    summed = (
        placed(narrow, facts).filter(F.col("bucket").isNotNull())
        .groupBy("facts", "bucket").agg(F.sum("size").alias("words"))
    )
    upto = F.sum("words").over(Window.partitionBy("facts.source").orderBy("bucket"))
    border = (
        summed.withColumn("upto", upto)
        .filter(F.col("upto") > F.col("facts.room"))
        .groupBy("facts").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("b"))
        .select(F.col("facts.source").alias("s"), F.col("b.bucket").alias("cut"), "b.before")
    )
    facts = facts.join(border, F.col("facts.source").eqNullSafe(F.col("s")), "left").drop("s")
    facts = common.stored(facts, "mix-borders")

    rows = placed(sized, facts)
    at_border = F.coalesce(F.col("bucket") == F.col("cut"), F.lit(False))
    below = F.col("bucket").isNotNull() & F.coalesce(F.col("bucket") < F.col("cut"), F.lit(True))
    plain = rows.filter(~at_border).withColumn("drawn", below)
    order = Window.partitionBy("facts.source").orderBy("rank", "doc_id", "size")
    upto = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    # The row that crosses the target is taken where that ends nearer to it.
    nearest = F.col("upto") - F.col("size") / 2 <= F.col("facts.room")
    border_rows = rows.filter(at_border).withColumn("upto", upto).withColumn("drawn", nearest).drop("upto")
    copies = F.col("facts.whole") + F.col("drawn").cast("int")
    return plain.unionByName(border_rows).select(
        "row",
        F.struct(
            "size", "facts.source_size", "facts.target", copies.alias("copies"),
            (copies * F.col("size")).alias("taken"),
        ).alias("mix"),
    )


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496 AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, source_size * 3 AS ceiling, source_size * 3 / weight AS ratio, (sum(source_size) OVER ())::BIGINT AS total,
         (sum(weight) OVER ())::BIGINT AS weights
  FROM s),
l AS (
  SELECT *, (total - coalesce(sum(ceiling) OVER o, 0)::BIGINT)::DOUBLE / (weights - coalesce(sum(weight) OVER o, 0)::BIGINT) AS level
  FROM r WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         CASE WHEN level > ratio THEN ceiling::DOUBLE
              ELSE (first_value(level) OVER (PARTITION BY level > ratio ORDER BY ratio, source NULLS LAST)) * weight END AS target
  FROM l),
f AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS q FROM t),
g AS (
  SELECT d.doc_id, d.size, f.source, f.source_size, f.target, floor(q)::BIGINT AS whole, q - floor(q) AS inclusion,
         target - floor(q)::BIGINT * f.source_size AS room, u
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
h AS (
  SELECT *, CASE WHEN inclusion > 0 THEN (u / (1 - u)) * ((1 - inclusion) / inclusion) END AS odds FROM g),
k AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, inclusion > 0 ORDER BY odds / (1 + odds), doc_id, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM h)
SELECT doc_id, size, source_size, target,
       (whole + CASE WHEN inclusion > 0 AND before + size / 2 <= room THEN 1 ELSE 0 END) * size AS taken
FROM k
"""
