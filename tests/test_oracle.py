"""Every query against its SQL in DuckDB."""

from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")

from checks.compare import connect, difference  # noqa: E402
from checks.oracle import ORACLE  # noqa: E402
from checks.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    with connect(SF) as con:
        yield con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    assert difference(spark, duck, SF, name) is None
