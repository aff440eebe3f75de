"""Every query against its SQL counterpart."""

from __future__ import annotations

import pytest
from compare import connect, difference

from eventloom.plans.oracle import ORACLE
from eventloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None
