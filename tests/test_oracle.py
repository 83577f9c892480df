"""Every report against its SQL counterpart."""

import pytest

import __spark_entry__ as contract
from procurelens.plans.reports import REPORTS

ORACLES = contract.oracle_sql()
QUERIES = {name: contract.queries()[name] for name in REPORTS}


def _key(row):
    return tuple((v is None, "" if v is None else round(v, 3) if isinstance(v, float) else v) for v in row)


def test_every_report_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_report_matches_sql(name, spark, sf_dir, duck):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = [tuple(r) for r in frame.select(*columns).collect()]
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert sorted(got, key=_key) == sorted(want, key=_key)


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 1526
