"""The queries of this package against their SQL, and all others for a result, over the smallest tables. NaN and null are kept apart."""

import math
import os
from collections import Counter

import duckdb
import pytest

from curaspark.llm.queries import MODULES

D = "/root/testdata/sf0.001"
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
SQL = {k: q for m in MODULES for k, q in m.SQL.items()}


def value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    return "null" if v is None else str(v)


def rows(columns, data):
    at = [columns.index(c) for c in sorted(columns)]
    return Counter(tuple(value(r[i]) for i in at) for r in data)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in os.listdir(D):
        con.execute(f"CREATE VIEW {t[:-8]} AS SELECT * FROM '{D}/{t}'")
    return con


@pytest.mark.skipif(not os.path.isdir(D), reason="needs the test tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    df = QUERIES[name](spark, D)
    got = rows(df.columns, df.collect())
    assert got
    if name in SQL:
        cur = db.execute(SQL[name])
        assert got == rows([c[0] for c in cur.description], cur.fetchall())
