"""Every query against its SQL, and all others for a result, over the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

D = "/root/testdata/sf0.001"
QUERIES, SQL = E.queries(), E.oracle_sql()
CORE = [n for n in QUERIES if QUERIES[n].__module__.startswith("curaspark.queries")]


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
@pytest.mark.parametrize("name", CORE)
def test_query(spark, db, name):
    df = QUERIES[name](spark, D)
    got = rows(df.columns, df.collect())
    assert got
    if name in SQL:
        cur = db.execute(SQL[name])
        assert got == rows([c[0] for c in cur.description], cur.fetchall())


def test_idtaxa_train_is_the_whole_job(monkeypatch):
    from curaspark.config import Params
    from curaspark.queries import models

    given = {}
    monkeypatch.setattr(models.C, "_bold", lambda spark, d: None)
    monkeypatch.setattr(models.classifier, "train", lambda df, **kw: given.update(kw) or (None, None, []))
    QUERIES["idtaxa_train"](None, D)
    assert (given["max_group_size"], given["max_iterations"]) == (Params().idtaxa_max_group_size, Params().idtaxa_max_iterations) == (10, 3)
