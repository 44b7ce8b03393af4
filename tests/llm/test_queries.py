"""The registered queries: SQL, brute force, odd rows, empty tables."""

import glob

import duckdb
import pytest

import __spark_entry__ as entry
from casebook.llm import queries
from tests import side_by_side
from tests.llm.conftest import SF_DIR

NAMES = sorted(queries.QUERIES)
OPERATORS = range(1, 14)


def duck(folder):
    if folder == SF_DIR:
        return side_by_side.connect(folder)
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = path.rsplit("/", 1)[1].removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'")
    return con


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in OPERATORS] == [1] * len(OPERATORS)
    assert "pipeline" in names and set(queries.ORACLES) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
@pytest.mark.parametrize("where", ["given", "odd", "void"])
def test_sql(spark, odd, void, name, where):
    folder = {"given": SF_DIR, "odd": odd, "void": void}[where]
    found = side_by_side.differences(duck(folder), queries.QUERIES[name](spark, folder), queries.ORACLES[name])
    assert found is None, found


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables_give_no_rows(spark, void, name):
    rows = queries.QUERIES[name](spark, void).collect()
    # The conversation that the query adds is all there is.
    assert len(rows) == (1 if name.startswith("op2_") else 0)


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith(("op2_", "op11_"))])
def test_one_row_a_document(spark, odd, name):
    want = sorted(r.doc_id for r in spark.read.parquet(f"{odd}/documents.parquet").collect())
    assert sorted(r.doc_id for r in queries.QUERIES[name](spark, odd).collect()) == want


@pytest.mark.parametrize("name", [n for n in NAMES if n[:4] in ("op3_", "op4_", "op7_", "op8_")])
def test_reruns_agree(spark, odd, name):
    first, second = (sorted(map(str, queries.QUERIES[name](spark, odd).collect())) for _ in range(2))
    assert first == second
