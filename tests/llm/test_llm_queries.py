import os

import pytest

duckdb = pytest.importorskip("duckdb")

from siltmill.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(value):
    return "NULL" if value is None else repr(round(value, 6)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    df, cursor = queries.QUERIES[name](spark, SF), con.execute(queries.ORACLE[name])
    names = [c[0] for c in cursor.description]
    order = sorted(names)
    assert order == sorted(df.columns)
    assert sorted(tuple(plain(r[c]) for c in order) for r in df.collect()) == sorted(tuple(plain(dict(zip(names, r))[c]) for c in order) for r in cursor.fetchall())
