"""Every query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from haplospark.plans.catalog import REGISTRY
from haplospark.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    outcome = compare(spark, con, name, SF)
    assert outcome.startswith("ok "), outcome
    assert outcome != "ok 0 rows"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "Haplotype"
