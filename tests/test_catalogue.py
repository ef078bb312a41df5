"""Every catalogue query on the smallest tables against its reference SQL."""

import pytest

import __spark_entry__ as entry
from cyclelake.plans.catalog import entries
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
OWN = set(entries())
QUERIES = {name: fn for name, fn in entry.queries().items() if name in OWN}
TEXTS = {name: text for name, text in entry.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(TEXTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    ok, message = compare(spark, db, name, QUERIES[name], TEXTS.get(name), SF)
    assert ok and "types differ" not in message, message
