"""The corpus pipeline: the stages documents pass through, each stored before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import common, digests, langid, mixing, near, pieces


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the recurrent network was taught; `und` ones go."""
    return langid.accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the smallest id."""
    return digests.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike in 0.8 of their five-word shingles, the one with the smallest id:
    SimHash fingerprints linked by pigeonring search, and minimum hashes beside, then exact."""
    return near.one_of_each(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: up to three rows each, or none."""
    return mixing.repeated(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encoded documents: ids instead of text, n_pieces, and whether decoding gave the text back."""
    rows = docs.select("doc_id", "lang", "source", "n_chars", "text")
    encoded = pieces.encode(rows, pieces.model_path(), keep_text=False)
    return encoded.withColumn("n_pieces", F.size("ids").cast("long"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing_sources", mixing_sources),
    ("sentencepiece", sentencepiece),
]

#: Language ID and SentencePiece cannot be put in SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
