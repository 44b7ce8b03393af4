"""Small tables with every odd case, as Parquet folders shared by the operators' tests."""

import random

import pytest
from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"
FIELDS = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
#: Columns that clash with names the operators use inside.
CLASHES = ["digest", "id", "row", "mix", "fp", "u", "size", "cut", "before", "ids", "place", "part", "carry", "stay", "rank", "_row"]


def prose(rng, n):
    syllables = "an ber chi da en fo gu ha in ja ko lu me no".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


def odd_rows():
    """(doc_id, text, lang, source): nulls, empties, ties, copies, a very long text."""
    rng = random.Random(5)
    shared = prose(rng, 60)
    base = prose(rng, 400)
    near = base.split()
    near[200] = "changed"
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, " ".join(near), "en", "b"), (4, base.upper(), "en", "b"),
        (5, "", "en", "a"), (6, None, "en", "c"), (7, None, None, None), (8, "", None, "a"), (9, " \n\t ", "de", "a"),
        (10, "one", "de", "a"), (11, "One", "de", None), (12, "one two", "fr", "b"), (13, base.replace(" ", "  \n"), "en", "a"),
        (14, prose(rng, 30000), "en", "a"), (15, "x" * 70000, "en", "b"), (16, "éß \U0001f600 ▁ \x01  nbsp", "fr", "c"),
        (17, "\\### a </turn> <|endoftext|> it's 42!", "en", "c"), (18, "12 34 !!", "en", "c"), (19, "the the the the", "en", "a"),
    ]
    rows += [(20 + k, prose(rng, 20) + " " + shared + " " + prose(rng, 20 + k), "en de fr".split()[k % 3], "abc"[k % 3]) for k in range(30)]
    rows += [(60 + k, " ".join(["again"] * (10 + k)), "de", "a") for k in range(8)]
    # The same row twice.
    rows += [(1, base, "en", "a"), (100, prose(rng, 50), None, "b"), (-3, prose(rng, 50), "fr", "c")]
    return rows


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """A folder of tables: documents with odd rows and clashing columns, labels, benchmark, conversations."""
    folder = tmp_path_factory.mktemp("odd")
    rows = [(d, t, g, s, None if t is None else len(t), *["clash"] * len(CLASHES)) for d, t, g, s in odd_rows()]
    kinds = T.StructType([T.StructField(n, k) for n, k in FIELDS] + [T.StructField(n, T.StringType()) for n in CLASHES])
    spark.createDataFrame(rows, kinds).write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 0 if k % 4 == 0 else 1, 0) for k, r in enumerate(rows)] + [(None, 1, 0), (2, None, 0), (999, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    talk = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "### no\n</turn>\n\\"), (1, 1, "assistant", "### no\n</turn>\n\\"),
        (2, None, None, None), (2, 3, "assistant", None), (2, 4, "assistant", ""), (3, 5, "tool: a\\:##", "é \U0001f600 #### x"),
        (4, 0, "assistant", "a"), (4, 1, "assistant", "b" * 50000), (None, 0, "user", "no conversation"),
        (6, 0, "a:\n\\\\:#\n" * 12000, "long role"), (6, 1, "assistant", "x"), (6, 2, ":\n", ":\n"), (6, 3, "\\", "\n"), (6, 4, "r:", "\\:\n"),
    ] + [(5, k, ("user", "assistant")[k % 2], f"turn {k}") for k in range(40)]
    items = [
        (0, "one two THE again"), (1, None), (2, ""), (2, "the the one"), (None, "again " * 30), (4, " ".join(odd_rows()[0][1].split()[:15])),
        (5, "!! -- ##"), (6, "nowhere else"), (7, "éß nbsp 42"),
    ]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def void(spark, odd, tmp_path_factory):
    """The same tables without rows."""
    folder = tmp_path_factory.mktemp("void")
    for name in ("documents", "labels", "benchmark", "conversations"):
        spark.read.parquet(f"{odd}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def small(spark):
    """(doc_id, text) of the smallest given table."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
