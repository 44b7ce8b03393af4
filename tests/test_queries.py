"""Every registered query against its SQL on the smallest tables."""

import pytest

from casebook.plans import catalog
from tests import side_by_side

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return side_by_side.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    found = side_by_side.differences(
        duck, catalog.QUERIES[name](spark, SF_DIR), catalog.ORACLES[name]
    )
    assert found is None, found
