"""Requests for readable event narratives, and checking the replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook import schemas, vocab
from casebook.functions import events
from casebook.functions import text as tx

TITLE_LIMIT = 80
KEY_POINTS = (3, 5)


FACTS = (
    "semantic_id", "violation_type", "naics_code", "injuries_hospitalized",
    "injuries_amputation", "injuries_eye_loss", "violation_code", "violation_part",
    "event_code", "violation_source",
)


def _detail(key: str) -> Column:
    return F.col(f"details.{key}")


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _number(value: Column) -> Column:
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def payload() -> Column:
    """The facts of one event as a nested struct without gaps."""
    own = _text(tx.empty_to_null(F.coalesce(_detail("semantic_id"), F.col("event_id"))))
    return F.struct(
        own.alias("id"),
        own.alias("oshaId"),
        _text(F.col("event_date").cast("string")).alias("eventDate"),
        _text(_detail("violation_type")).alias("violationType"),
        F.struct(_text(F.col("city")).alias("city"), _text(F.col("state")).alias("state"))
        .alias("location"),
        F.struct(
            _text(F.col("company_name")).alias("name"), _text(_detail("naics_code")).alias("naics")
        ).alias("establishment"),
        F.struct(
            _number(_detail("injuries_hospitalized")).alias("hospitalized"),
            _number(_detail("injuries_amputation")).alias("amputation"),
            _number(_detail("injuries_eye_loss")).alias("lossOfEye"),
            _text(F.col("event_description")).alias("narrative"),
            _text(_detail("violation_code")).alias("nature"),
            _text(_detail("violation_part")).alias("bodyPart"),
            _text(_detail("event_code")).alias("event"),
            _text(_detail("violation_source")).alias("source"),
        ).alias("injury"),
    )


def indented_json(value: str) -> Column:
    """JSON over several lines, two spaces deep, ``"key": value``. The printer
    puts a space before colons; keys start their line, texts never do."""
    return F.regexp_replace(
        F.to_json(value, {"pretty": "true"}), r'(?m)^(\s*"[A-Za-z]+") : ', "$1: "
    )


def requests(rows: DataFrame) -> DataFrame:
    """One request per event: its facts and the two messages built from them."""
    parsed = events.with_details(rows, *FACTS)
    built = parsed.select("event_id", payload().alias("payload"))
    user = F.concat(
        F.lit(vocab.NARRATIVE_REQUEST_HEAD),
        indented_json("payload"),
        F.lit(vocab.NARRATIVE_REQUEST_TAIL),
    )
    message = lambda role, content: F.struct(
        F.lit(role).alias("role"), content.alias("content")
    )
    return built.select(
        "event_id", "payload",
        F.array(
            message("system", F.lit(vocab.NARRATIVE_SYSTEM_TEXT)), message("user", user)
        ).alias("messages"),
    )


def check_replies(replies: DataFrame) -> DataFrame:
    """(event_id, reply) -> parsed fields and ``is_valid``. A reply needs a title
    of at most 80 characters, an explanation, a risk text and 3 to 5 points."""
    parsed = replies.withColumn("r", F.from_json("reply", schemas.NARRATIVE_REPLY))
    fine = (
        F.length("r.title").between(1, TITLE_LIMIT)
        & (F.length("r.explanation") > 0)
        & (F.length("r.riskAssessment") > 0)
        & F.size("r.keyPoints").between(*KEY_POINTS)
    )
    return parsed.select(
        "event_id", "r.*", F.coalesce(fine, F.lit(False)).alias("is_valid")
    )


def enrich(rows: DataFrame, checked: DataFrame) -> DataFrame:
    """Valid replies fill the enriched title and description of their events.

    Of several valid replies to an event the one with the smallest title, then
    explanation, is used, so an event stays one row.
    """
    side = (
        checked.where("is_valid").groupBy("event_id")
        .agg(F.min(F.struct("title", "explanation")).alias("_reply"))
        .select("event_id", F.col("_reply.title").alias("_title"), F.col("_reply.explanation").alias("_text"))
    )
    joined = rows.join(side, "event_id", "left")
    return joined.select(
        *[
            {
                "bedrock_event_title": F.coalesce("_title", "bedrock_event_title"),
                "bedrock_event_description": F.coalesce("_text", "bedrock_event_description"),
                "bedrock_verified": F.col("_title").isNotNull() | F.col("bedrock_verified"),
            }.get(c, F.col(c)).alias(c)
            for c in rows.columns
        ]
    )
