"""Every query of the library's own operators agrees with its SQL."""

import pytest

from tests.oracle import DATA, assert_agrees
from tideline.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_agrees_with_sql(spark, name):
    assert_agrees(spark, catalog.QUERIES[name], catalog.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() >= 0


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
