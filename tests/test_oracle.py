"""Every registered query against its SQL on the smallest data."""

import pytest

import oracle
from kerbside.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = oracle.spark_rows(df)
    if name not in ORACLES:
        assert got[1]
        return
    assert got == oracle.duck_rows(con, ORACLES[name])
    assert not oracle.type_gaps(df, con, ORACLES[name])
