"""Every registered query against its SQL statement on DuckDB (sf0.001)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from terrace import catalog
from tools.compare import compare, duck

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL, con)
    assert r["status"] in ("MATCH", "rows-only"), r
    assert not r.get("types"), r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["sale_year", "urban_rural_flag", "property_type", "new_build"]


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
