"""Every registered query against its DuckDB oracle on the smallest data set."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import _rows, duck_connect

from memberlens.plans.oracle import ORACLE
from memberlens.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["memberId", "phone", "sex"]
