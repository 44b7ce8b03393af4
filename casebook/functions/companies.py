"""Company and security names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook import vocab
from casebook.functions import text as tx

_SITE = r"[#\-]\s*(\d+)\s*$"


def site_number(company: Column) -> Column:
    """Digits after a trailing ``#`` or ``-``, else null."""
    return tx.empty_to_null(F.regexp_extract(company, _SITE, 1))


def without_site_number(company: Column) -> Column:
    """The name to look up: the site number cut off, trimmed."""
    return tx.trim(F.regexp_replace(company, _SITE, ""))


def alias_key(company: Column) -> Column:
    """Simplified key of an incoming company name."""
    letters = F.regexp_replace(F.lower(company), "[#0-9]", "")
    kept = F.regexp_replace(letters, tx.ascii_words(rf"(?i)\b({'|'.join(vocab.COMPANY_NOISE)})\b"), "")
    return tx.trim(tx.squeeze(F.replace(kept, F.lit("-"), F.lit(" "))))


def unspaced(key: Column) -> Column:
    return F.replace(key, F.lit(" "), F.lit(""))


def listed_name(security: Column) -> Column:
    """A listed security's name without its share class."""
    out = security
    for suffix in vocab.SHARE_SUFFIXES:
        # Only the first occurrence goes, so the head is matched lazily.
        out = F.regexp_replace(out, f"(?is)^(.*?){suffix}", "$1")
    return tx.trim(out)


def share_type(security: Column) -> Column:
    hits = F.coalesce(
        *[F.when(security.contains(kind), F.lit(kind)) for kind in vocab.SHARE_TYPES]
    )
    return F.coalesce(hits, F.lit(vocab.DEFAULT_SHARE_TYPE))


def listed_alias(name: Column) -> Column:
    """Words of a listed company's name, spaces still in."""
    lowered = F.regexp_replace(F.lower(name), tx.ascii_words(r"\.com\b"), "")
    bare = F.regexp_replace(lowered, tx.ascii_words(rf"(?i)\b({'|'.join(vocab.LEGAL_FORMS)})\b"), "")
    return tx.trim(tx.squeeze(F.regexp_replace(bare, r"[^a-z0-9\s]", "")))
