"""Correctness gate: every registered query against its DuckDB oracle (sf0.01)."""

import pytest

from tests.conftest import SF001


def _names():
    from paylens.plans.registry import QUERIES
    return list(QUERIES)


@pytest.fixture(scope="module")
def con():
    from tests.oracle_compare import duck
    return duck(SF001)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from paylens.plans.oracle import oracle_sql
    from paylens.plans.registry import QUERIES
    from tests.oracle_compare import rows_of
    df = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(srows) >= 1
        return
    cur = con.execute(sql)
    a, ac = rows_of(df.columns, srows)
    b, bc = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert ac == bc
    assert len(a) > 0, "an empty result would make the comparison vacuous"
    assert len(a) == len(b)
    assert sorted(a, key=repr) == sorted(b, key=repr)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["players"] > 0


def test_every_query_has_a_text():
    from paylens.plans.oracle import oracle_sql
    from paylens.plans.registry import QUERIES
    assert set(QUERIES) - set(oracle_sql()) == set()
