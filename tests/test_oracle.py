"""Every registered query equals its DuckDB oracle (sf0.001, whole tables)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from edustar.oracle import ORDER
from edustar.plans.catalog import QUERIES
from tools.compare import compare, duck, norm

KEYS = sorted(QUERIES)  # the training-data queries have their own tests


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) and set(KEYS) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF_SMALL)
    assert r["ok"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["risk_group", "code_presentation", "presentation_label"]
    assert df.count() == 12


@pytest.mark.parametrize("key", sorted(ORDER))
def test_cards_and_marts_come_in_their_order(spark, con, key):
    got = [tuple(map(norm, r)) for r in E.queries()[key](spark, SF_SMALL).collect()]
    res = con.execute(E.oracle_sql()[key])
    names = [c[0] for c in res.description]
    at = [names.index(c) for c in E.queries()[key](spark, SF_SMALL).columns]
    assert got == [tuple(norm(r[i]) for i in at) for r in res.fetchall()]
