"""Plain text helpers, all as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook import vocab


def trim(text: Column) -> Column:
    """Trim every kind of white space, not only U+0020."""
    return F.btrim(text, F.lit(vocab.TRIM_CHARS))


def blank_to_null(text: Column) -> Column:
    """Missing, empty and all-blank text become null; the rest is trimmed."""
    return F.nullif(trim(text), F.lit(""))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def ascii_words(pattern: str) -> str:
    """The pattern with word boundaries of ASCII words, whatever the JVM takes
    ``\\b`` to mean: an accented letter is no part of a word."""
    word = "[A-Za-z0-9_]"
    return pattern.replace(r"\b", f"(?:(?<!{word})(?={word})|(?<={word})(?!{word}))")


def replace_each(text: Column, rules) -> Column:
    """Apply (pattern, replacement) pairs in order, case-insensitively."""
    return reduce(
        lambda out, rule: F.regexp_replace(out, "(?i)" + ascii_words(rule[0]), rule[1]), rules, text
    )


def squeeze(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def slugify(text: Column) -> Column:
    """Lower-case words joined by single hyphens."""
    hyphened = F.regexp_replace(F.lower(text), r"[.\s]", "-")
    kept = F.regexp_replace(hyphened, r"[^A-Za-z0-9_\-]+", "")
    return F.btrim(F.regexp_replace(kept, r"--+", "-"), F.lit("-"))


def underscored(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit(" "), F.lit("_"))


def strip_key_prefix(key: Column, *kinds: str) -> Column:
    """Drop a leading ``KIND#`` of any of the given kinds."""
    return F.regexp_replace(key, f"(?i)^({'|'.join(kinds)})#", "")


def display_case(text: Column) -> Column:
    """Title case for display, with known acronyms kept in capitals.

    A capital follows every word boundary (``O'Reilly``, ``At&T``), which
    ``initcap`` does not do.
    """
    spaced = F.lower(F.translate(trim(text), "-_", "  "))
    pieces = F.split(spaced, r"(?<![a-z0-9_])(?=[a-z0-9_])")
    cased = F.array_join(
        F.transform(
            pieces,
            lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p))),
        ),
        "",
    )
    return F.array_join(
        F.transform(
            F.split(cased, " "),
            lambda w: F.when(F.upper(w).isin(*vocab.ACRONYMS), F.upper(w)).otherwise(w),
        ),
        " ",
    )


def whole_number(value: Column) -> Column:
    """The leading integer of a text, 0 where there is none."""
    digits = F.regexp_extract(value.cast("string"), r"^\s*([+-]?\d+)", 1)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def xml_escape(text: Column) -> Column:
    """The five characters XML reserves."""
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for raw, escaped in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out
