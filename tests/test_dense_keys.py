from collections import Counter

from pyspark.sql import functions as F

from curaspark.functions.text import rank_key
from curaspark.operators import dense_keys as D

SCHEMA = "genus string, family string, v int, key_field string, n_rows int, f string, k0 string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)


def stats(df, **kw):
    return D.dense_key_stats(df, {"genus": rank_key(F.col("genus")), "family": rank_key(F.col("family"))}, {"total": F.col("v")}, **kw)


ROWS = [("Aa", "Ff", 1), ("AA ", "ff ", 2), (" aa", None, None), (None, "none", 5), ("UNCLASSIFIED", "", 7), ("Bb", "Gg", 10**9)] * 5


def expected(rows):
    n, s = Counter(), Counter()
    for g, f, v in rows:
        for field, x in (("genus", g), ("family", f)):
            key = None if x is None or x.strip().lower() in ("", "none", "unclassified") else x.strip().capitalize()
            n[field, key] += 1
            s[field, key] += v or 0
    return {(f, k, c, s[f, k]) for (f, k), c in n.items()}


def test_against_counter_over_many_splits(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 2)
    df = table(spark, ROWS).repartition(7)
    assert {tuple(r) for r in stats(df).collect()} == expected(ROWS)


def test_beyond_the_dictionary(spark):
    assert {tuple(r) for r in stats(table(spark, ROWS), dictionary_keys=1).collect()} == expected(ROWS)


def test_heavy_keys_count_all_rows(spark):
    df = table(spark, [("Aa", None, 1)] * 2 + [(f"B{i}", "F", 1) for i in range(97)] + [(None, None, 1)])
    assert {tuple(r) for r in D.heavy_keys(stats(df), 0.02).collect()} == {("genus", "Aa"), ("family", "F")}


def test_empty(spark):
    assert stats(table(spark, [])).count() == 0 and D.heavy_keys(stats(table(spark, [])), 0.02).count() == 0


def test_all_keys_null(spark):
    assert {tuple(r) for r in stats(table(spark, [(None, None, 3)])).collect()} == {("genus", None, 1, 3), ("family", None, 1, 3)}
