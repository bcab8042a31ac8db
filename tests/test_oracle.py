"""Every value-checkable query equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from scripts.oracle_check import digest, duck
from tests.conftest import SF_SMALL

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLE[name])
    dcols = [c[0] for c in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "n_rows" in df.columns
