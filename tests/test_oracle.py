"""Every registered query equals its DuckDB oracle (row multiset, names)."""
import pytest

import __spark_entry__ as se
from ledgerline.plans.queries import QUERIES
from tests.conftest import SF_CHECK
from tools.compare import canon, spark_types

ORACLE = {k: v for k, v in se.oracle_sql().items() if k not in se.LLM_QUERIES}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["symbol", "date", "open", "high", "low", "close", "volume"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_CHECK)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(ORACLE[name])
    assert spark_types(df) == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    res = duck.execute(ORACLE[name])
    want = canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
