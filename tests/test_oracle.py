"""Every registered plan against its DuckDB twin on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from gavel.plans.catalog import ORACLE, QUERIES
from parity import digest, duck

from helpers import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_plan_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_plan_matches_duckdb(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(E.oracle_sql()[name])
    dcols = rel.columns
    assert sorted(scols) == sorted(dcols)
    drows = [tuple(r[dcols.index(c)] for c in scols) for r in rel.fetchall()]
    assert len(srows) == len(drows)
    assert digest(scols, srows)[0] == digest(scols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["category", "k", "pass_at_k"]
    assert df.count() > 0
