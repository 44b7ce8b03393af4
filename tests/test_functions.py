"""Every scalar against hand-derived values."""

import pytest
from pyspark.sql import functions as F

from casebook.functions import companies, dates, events, places
from casebook.functions import text as tx


def _place(c):
    p = places.place_parts(c)
    return F.concat_ws("|", p["name"], p["kind"], places.simple_place_alias(p["name"]))


CASES = {
    "clean_city": (places.clean_city, {
        "Denver": "DENVER", "ST LOUIS": "SAINT LOUIS", "STE 200 ATLANTA": "ATLANTA",
        "Mt. Juliet": "MOUNT JULIET", "100 N MAIN ST DENVER": "DENVER", "Denver, CO": "DENVER",
        "FL CITY": "CITY", "West Palm Bch 33401": "WEST PALM BEACH", "Bloom Township": "BLOOM",
        "PARK 70 WEST": "WEST", "St. Louis": "SAINT. LOUIS", "Ste. Genevieve": ". GENEVIEVE",
        "FT. WORTH": "FORT WORTH", "NYC": "NEW YORK", "Denver, CO 80202": "DENVER",
        "Suite 5, Long Bch": "LONG BEACH", "123 Springfield": "SPRINGFIELD",
        "PT ARTHUR": "PORT ARTHUR", "PO BOX 12 AKRON": "AKRON", "": "", None: None,
        "12345": "12345", " Denver　": "DENVER",
    }),
    "clean_city_fixed": (lambda c: places.clean_city(c, fix_saint_dot=True), {
        "St. Louis": "SAINT LOUIS",
    }),
    "state_code": (places.state_code, {
        "Colorado": "CO", " tx ": "TX", "Narnia": "NARNIA", "": "", None: None,
    }),
    "state_name": (places.state_name, {
        "TN": "Tennessee", "Guam": "Guam", "ZZ": "Zz", "district of columbia": "District of Columbia",
    }),
    "alias_key": (companies.alias_key, {
        "Test Company Inc": "test company", "Walmart": "walmart", "Walmart Supercenter": "walmart",
        "ABC Manufacturing LLC": "abc manufacturing", "Big Corp": "big",
        "FORD MOTOR CO": "ford motor", "WAL-MART STORES INC": "wal mart stores",
        "Acme, Inc.": "acme, .",
    }),
    "site_number": (companies.site_number, {
        "Walmart #1234": "1234", "Walmart-77": "77", "Acme - 9 ": "9", "7-ELEVEN": None,
        "Store #12B": None, "Shop#": None,
    }),
    "listed_name": (companies.listed_name, {
        "Amazon.com, Inc. Common Stock": "Amazon.com, Inc.",
        "Alphabet Inc. Class A Common Stock": "Alphabet Inc.",
        "Alphabet Inc. Class C Capital Stock": "Alphabet Inc. Capital Stock",
        "Home Depot, Inc. (The) Common Stock": "Home Depot, Inc. (The)",
        "XYZ Corp Warrants": "XYZ Corp",
    }),
    "slugify": (tx.slugify, {
        "Amazon.com, Inc.": "amazon-com-inc", "Home Depot, Inc. (The)": "home-depot-inc-the",
        "Ford Motor Company": "ford-motor-company",
    }),
    "share_type": (companies.share_type, {
        "Alphabet Inc. Class C Capital Stock": "Class C", "XYZ Corp Warrants": "Warrants",
        "Alphabet Inc. Class A Common Stock": "Common Stock", "Plain": "Common Stock",
    }),
    "listed_alias": (lambda c: companies.unspaced(companies.listed_alias(c)), {
        "Amazon.com, Inc.": "amazon", "Home Depot, Inc. (The)": "homedepotthe",
        "Ford Motor Company": "fordmotor", "XYZ Corp": "xyz",
    }),
    "display_case": (tx.display_case, {
        "GREAT FALLS": "Great Falls", "great_falls": "Great Falls", "walmart-inc": "Walmart Inc",
        "ABC OSHA LLC": "Abc OSHA LLC", "O'REILLY AT&T": "O'Reilly At&T",
        "LA VERGNE": "LA Vergne", "u.s. steel": "U.S. Steel", "": "", None: None,
    }),
    "event_date": (lambda c: dates.stamp(dates.event_timestamp(c)), {
        "2025": "2025-01-01 00:00:00", "2025-01-15": "2025-01-15 00:00:00",
        "2025-01-15T10:00:00.000Z": "2025-01-15 10:00:00",
        "2025-01-15 10:00:00": "2025-01-15 00:00:00", "01/15/2025": None, "T10:00": None,
        "": None, None: None, "2025-02-30": None, " 2025": None,
        "2025-01-15T10:00:00+05:00": "2025-01-15 05:00:00",
    }),
    "us_date": (lambda c: dates.stamp(dates.event_timestamp(c, us_dates=True)), {
        "01/15/2025": "2025-01-15 00:00:00", "1/5/2025 3:00 PM": "2025-01-05 00:00:00",
        "13/45/2025": None,
    }),
    "place": (_place, {
        "Knoxville city": "Knoxville|City", "St. Louis city": "Saint Louis|City",
        "Nashville-Davidson metropolitan government (balance)":
            "Nashville-Davidson|Metropolitan government|nashville",
        "Athens-Clarke County unified government (balance)":
            "Athens-Clarke County|Unified government|athens",
        "Carson City": "Carson|City", "Paradise CDP": "Paradise|Cdp",
        "Winston-Salem city": "Winston-Salem|City|winston", "Somewhere": "Somewhere|Place",
    }),
    "whole_number": (lambda c: tx.whole_number(c).cast("string"), {
        "12": "12", "7.9": "7", "x": "0", "": "0", None: "0", "-3 items": "-3",
    }),
    "key_prefix": (lambda c: tx.strip_key_prefix(c, "COMPANY", "SLUG"), {
        "COMPANY#walmart-inc": "walmart-inc", "slug#x": "x", "CITY#y": "CITY#y",
    }),
    "xml": (tx.xml_escape, {"a&b<c>'\"": "a&amp;b&lt;c&gt;&apos;&quot;"}),
}


@pytest.mark.parametrize("name", CASES)
def test_scalar(spark, name):
    function, values = CASES[name]
    rows = spark.createDataFrame(list(values.items()), "given string, wanted string")
    got = rows.withColumn("got", function(F.col("given")))
    assert got.where("not (got <=> wanted)").collect() == []


def test_raw_json_keeps_order_and_empty_cells(spark):
    row = spark.range(1).select(
        events.raw_json([("b", F.lit("")), ("A", F.lit('x"y/z')), ("a", F.lit("é"))]).alias("j")
    )
    assert row.first().j == '{"b":"","A":"x\\"y/z","a":"é"}'


def test_word_boundaries_are_ascii(spark):
    rows = spark.createDataFrame([("ÉST ST JEAN",), ("ST. ÉLOI",)], "c string")
    from casebook.functions import places

    assert [r.c for r in rows.select(places.clean_city(rows.c).alias("c")).collect()] == ["ÉSAINT SAINT JEAN", "SAINT. ÉLOI"]
