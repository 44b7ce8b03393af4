"""Pages ranked across tasks and the trigram index, against plain restatements."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from casebook.operators import documents, insights, ranks, search
from casebook.sources import tables


@pytest.fixture(scope="module")
def long_directory():
    """One firm holds a third of the sites, another has one site, some have no firm."""
    rng = random.Random(11)
    firms = [rng.choice(["hot"] * 4 + ["a", "b", "c", "d", None, "e", "f"]) for _ in range(4000)] + ["lone"]
    return [(firm, f"s{i:04d}", f"Site {i}", rng.choice([1, 1, 1, 2, 9])) for i, firm in enumerate(firms)]


def _wanted(rows):
    firms = defaultdict(list)
    for firm, slug, _, count in rows:
        firms[firm].append((-count, slug))
    return {(firm, slug): i + 1 for firm, own in firms.items() for i, (_, slug) in enumerate(sorted(own))}


def test_ranks_of_a_hot_key_equal_brute_force(spark, long_directory):
    rows = spark.createDataFrame(long_directory, "firm string, slug string, name string, count int")
    ranked = ranks.spread_ranks(rows.repartition(7), ["firm"], [F.desc("count"), F.asc("slug")])
    assert ranked.columns == [*rows.columns, "rank"]
    got = {(r.firm, r.slug): r["rank"] for r in ranked.collect()}
    assert got == _wanted(long_directory)


def test_ranks_without_keys_and_of_no_rows(spark):
    rows = spark.range(1000).repartition(5)
    got = ranks.spread_ranks(rows, [], [F.desc("id")]).collect()
    assert sorted((r["rank"], r.id) for r in got) == [(i + 1, 999 - i) for i in range(1000)]
    assert ranks.spread_ranks(rows.where("id < 0"), [], [F.desc("id")]).count() == 0


def test_a_hot_key_is_ranked_by_several_tasks(spark, tmp_path, long_directory):
    rows = spark.createDataFrame(long_directory, "firm string, slug string, name string, count int")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranks.spread_ranks(rows, ["firm"], [F.desc("count"), F.asc("slug")])
        stored = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in ranked.inputFiles()})
        sizes = [r["count"] for r in stored.groupBy("_range", "firm").count().collect()]
        assert max(sizes) < 4001 / 8 * 2
        assert {(r.firm, r.slug): r["rank"] for r in ranked.collect()} == _wanted(long_directory)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_every_item_is_on_one_page(spark, long_directory):
    rows = spark.createDataFrame(long_directory, "firm string, slug string, name string, count int")
    pages = insights.directory_pages(rows, ["firm"], 30).collect()
    place = _wanted(long_directory)
    seen = {}
    for p in pages:
        for i, item in enumerate(p["items"]):
            seen[p.firm, item.slug] = (p.page - 1) * 30 + i + 1
    assert seen == place and max(len(p["items"]) for p in pages) == 30


NAMES = ["", "a", "ab", "aba", "abab", "ABABAB", "aaaaaa", "Zinc Inc", "zinc inc.", "Ärzte GmbH", "ärzte", "\U0001f600 inc", None, "inc"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(5)
    names = NAMES + ["".join(rng.choice("aBc ") for _ in range(rng.randrange(12))) for _ in range(300)]
    names += ["Acme Hot Inc"] * 200
    rows = [(f"k{i % 400}", name, i) for i, name in enumerate(names)]
    directory = spark.createDataFrame(rows, "gram string, name string, at int")
    path = str(tmp_path_factory.mktemp("index"))
    search.write_index(directory, path)
    return directory, path


TEXTS = ["", "a", "AB", "aba", "abab", "c b", "inc", "zinc i", "Hot", "ä", "ärz", "\U0001f600", "\U0001f600 in", "nosuch", "\0", "c\0\0", "cc"]


def test_indexed_search_equals_the_scan(spark, index):
    directory, path = index
    found = search.search(spark, path, [*TEXTS, "aba"])
    assert found.columns == ["text", *directory.columns]
    got = defaultdict(list)
    for r in found.collect():
        got[r.text].append(r["at"])
    for text in TEXTS:
        wanted = sorted(r["at"] for r in insights.directory_search(directory, text).collect())
        assert sorted(got[text]) == wanted, text
    assert len(got["inc"]) > 200 and not got["nosuch"]


def test_search_of_nothing_and_in_nothing(spark, index, tmp_path):
    directory, path = index
    assert search.search(spark, path, []).count() == 0
    search.write_index(directory.where("false"), str(tmp_path))
    empty = search.search(spark, str(tmp_path), ["a", "", "abc"])
    assert empty.count() == 0 and empty.columns == ["text", *directory.columns]


@pytest.mark.parametrize("text, pushed", [("zinc", "In(gram"), ("zi", "StringStartsWith(gram"), ("", "EqualTo(at,1)")])
def test_a_search_pushes_its_grams_to_the_scan(spark, index, text, pushed):
    plan = search.search(spark, index[1], [text])._jdf.queryExecution().toString()
    filters = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert pushed in filters or pushed.replace("In(gram", "EqualTo(gram") in filters


def test_facts_of_dimensions_in_documents(spark):
    docs = spark.createDataFrame(
        [
            ("CITY#a", "SUMMARY", "a", [("f", 3), ("g", 2), ("f", 1)]), ("CITY#b", "SUMMARY", "b", []),
            ("CITY#c", "SUMMARY", "c", None), ("CITY#n", "SUMMARY", None, [(None, 1)]),
        ],
        "PK string, SK string, slug string, directory array<struct<slug: string, count: int>>",
    )
    cities = spark.createDataFrame(
        [("a", 5, "x"), ("a", 7, None), ("b", None, None), (None, 1, "y")], "slug string, population int, PK string"
    )
    firms = spark.createDataFrame([("f", "Food"), ("f", "Bread"), (None, "None"), ("h", "Hats")], "slug string, subtitle string")
    told = documents.Facts({"city": cities}, {"city": firms}).told(docs, "city")
    assert sorted(told.columns) == sorted([*docs.columns, "meta"])
    rows = {r.PK: r for r in told.collect()}
    assert len(rows) == 4
    assert [tuple(i) for i in rows["CITY#a"].directory] == [("f", 3, "Food"), ("g", 2, None), ("f", 1, "Food")]
    assert rows["CITY#b"].directory == [] and rows["CITY#c"].directory is None
    assert [tuple(i) for i in rows["CITY#n"].directory] == [(None, 1, None)]
    assert tuple(rows["CITY#a"].meta) == (7, None) and tuple(rows["CITY#b"].meta) == (None, None)
    assert rows["CITY#c"].meta is None and rows["CITY#n"].meta is None
    assert documents.Facts().told(docs, "city") is docs


def test_lines_that_reading_gold_leaves_out(spark, tmp_path):
    folder = tmp_path / "states"
    folder.mkdir()
    (folder / "a.json").write_text('{"state":"TN","total_events":3}\n\n{"state":"TX"\n{"state":"NM","total_events":"x"}\n')
    (folder / "b.json").write_text('{"state":"AL"}\n')
    counts = tables.gold_line_counts(spark, str(tmp_path), "state").collect()
    assert {r.file.rsplit("/", 1)[1]: (r["lines"], r.skipped) for r in counts} == {"a.json": (3, 2), "b.json": (1, 0)}
    assert sorted(r.state for r in tables.read_gold(spark, str(tmp_path), "state").collect()) == ["AL", "TN"]
