"""Every registered query with an oracle must match DuckDB on the smallest
scale (the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as ent
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
SQLS = ent.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(ent.queries())


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert "frequency" in df.columns


@pytest.mark.parametrize("name", sorted(SQLS))
def test_matches_oracle(spark, con, name):
    sdf = ent.queries()[name](spark, SF).toPandas()
    odf = con.execute(SQLS[name]).df()
    err = compare(sdf, odf)
    assert err is None, err
