"""The queries that SQL can express, over the whole small tables."""

import pytest

from procurelens.llm.queries import ORACLE_SQL, QUERIES


def _key(row):
    return tuple((v is None, "" if v is None else round(v, 3) if isinstance(v, float) else v) for v in row)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(name, spark, sf_dir, duck):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = [tuple(r) for r in frame.select(*columns).collect()]
    result = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert sorted(got, key=_key) == sorted(want, key=_key)
