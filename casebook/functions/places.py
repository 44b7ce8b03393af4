"""State and city names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook import vocab
from casebook.functions import text as tx


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in pairs.items() for part in pair])


CODE_OF_NAME = {name.upper(): code for code, name in vocab.STATE_NAMES.items()}
NAME_OF_CODE = {
    **vocab.STATE_NAMES,
    **{vocab.STATE_NAMES[code].upper(): vocab.STATE_NAMES[code] for code in vocab.NON_STATES},
}


def state_code(name: Column) -> Column:
    """Two letters pass, a known name becomes its code, anything else stays."""
    upper = F.upper(tx.trim(name))
    known = F.try_element_at(_literal_map(CODE_OF_NAME), upper)
    return F.when(F.length(upper) == 2, upper).otherwise(F.coalesce(known, upper))


def state_name(code: Column) -> Column:
    """Full name of a code, display-cased input where the code is unknown."""
    known = F.try_element_at(_literal_map(NAME_OF_CODE), F.upper(code))
    return F.coalesce(known, tx.display_case(code))


def city_tail(city: Column) -> Column:
    """Of a comma list, the last part with more than two non-digit characters."""
    parts = F.filter(F.transform(F.split(city, ","), tx.trim), lambda p: p != "")
    named = F.filter(
        parts, lambda p: F.length(tx.trim(F.regexp_replace(p, r"\d+", ""))) > 2
    )
    return F.when(city.contains(","), F.coalesce(F.try_element_at(named, F.lit(-1)), city)).otherwise(city)


_WORD = r"[^\d\s]{2,}"
_BROKEN = r"(?:\S*\d\S*|\S)"
# Gaps of a text that has both a digit and a plain word; each match starts where
# the one before ended.
_GAPS = rf"(?:^(?=.*\d)(?=(?:.*\s)?{_WORD}(?:\s|$))|(?!^)\G)(\S*)\s+"
_LAST_RUN = rf"^(?=.*\d)(?:.*?\s)??((?:{_WORD}\s)*{_WORD})(?:\s{_BROKEN})*\s*$"


def last_plain_words(city: Column) -> Column:
    """The last unbroken run of words without digits, where the text has digits.

    Written so that ``city`` is named once: it stands for a long chain of
    rewrites, which would otherwise run again for every mention.
    """
    return F.regexp_replace(F.regexp_replace(city, _GAPS, "$1 "), _LAST_RUN, "$1")


def clean_city(raw: Column, fix_saint_dot: bool = False) -> Column:
    """Upper-case city name without street, unit and zip noise.

    ``St.`` keeps its dot (``SAINT. LOUIS``) unless ``fix_saint_dot`` is set.
    Where nothing would be left, the upper-cased input stays.
    """
    upper = F.upper(tx.trim(raw))
    city = tx.trim(tx.replace_each(city_tail(upper), vocab.CITY_PREFIX_RULES))
    for nickname, name in vocab.CITY_NICKNAMES.items():
        city = F.regexp_replace(city, f"^{nickname}$", name)
    if fix_saint_dot:
        city = F.regexp_replace(city, tx.ascii_words(r"\b(STE?)\."), "$1")
    city = last_plain_words(tx.replace_each(city, vocab.CITY_WORD_RULES))
    kept = F.filter(F.array(city, upper), lambda c: c != "")
    return F.when(raw.isNotNull(), F.coalesce(F.try_element_at(kept, F.lit(1)), F.lit("")))


def city_slug(state: Column, city: Column) -> Column:
    """``TN-great_falls``; null where either part is missing."""
    return F.concat(
        tx.empty_to_null(state), F.lit("-"), tx.underscored(tx.empty_to_null(city))
    )


def place_parts(raw: Column) -> Column:
    """Gazetteer name -> struct(name, kind)."""
    plain = F.regexp_replace(raw, r"(?i) \(balance\)$", "")
    for short, full in vocab.PLACE_PREFIXES:
        plain = F.regexp_replace(plain, "(?i)^" + short.replace(".", r"\."), full)
    pattern = f"(?i)^(.*?) ({'|'.join(vocab.PLACE_KINDS)})$"
    kind = F.regexp_extract(plain, pattern, 2)
    name = F.when(kind != "", F.regexp_extract(plain, pattern, 1)).otherwise(plain)
    cased = F.concat(F.upper(F.substring(kind, 1, 1)), F.lower(kind.substr(F.lit(2), F.length(kind))))
    return F.struct(
        name.alias("name"),
        F.when(kind != "", cased).otherwise(vocab.DEFAULT_PLACE_KIND).alias("kind"),
    )


def simple_place_alias(name: Column) -> Column:
    """Colloquial short form of a hyphened or consolidated name, else null."""
    governments = "|".join(vocab.GOVERNMENT_KINDS)
    first = F.element_at(F.split(name, "-"), 1)
    short = tx.trim(F.regexp_replace(first, f"(?i) ({governments}) government.*", ""))
    eligible = name.contains("-") | name.contains(" government") | name.rlike(f"(?i){governments}")
    return F.when(
        eligible & (F.length(short) > 2) & (short != name), tx.underscored(short)
    )
