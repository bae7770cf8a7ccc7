"""Joins whose left side may have a third of its rows under one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than 1/HOT of the left rows is hot. There are fewer than HOT such keys, so they can always be broadcast.
HOT = 1024


def _marked(left: DataFrame, right: DataFrame, on: list[str], n: str, rows: int) -> tuple[DataFrame, DataFrame]:
    is_hot = F.col(n) * HOT > rows
    return left.join(F.broadcast(right.filter(is_hot).withColumn("_hot", F.lit(True))), on, "left"), right.filter(~is_hot)


def hot_join(left: DataFrame, right: DataFrame, on: list[str], n: str, rows: int, how: str = "inner") -> DataFrame:
    """Join (inner or left) of left with right, which is unique in `on` and whose column n holds the left rows of each key.

    Keys with more than rows / HOT rows are broadcast and never shuffle; the others, each small, shuffle.
    """
    marked, rest = _marked(left, right, on, n, rows)
    cold = marked.filter("_hot is null").drop("_hot", *[c for c in right.columns if c not in on]).join(rest, on, how)
    return marked.filter("_hot").drop("_hot").unionByName(cold)


def hot_anti(left: DataFrame, right: DataFrame, on: list[str], n: str, rows: int) -> DataFrame:
    """The rows of left whose key right lacks; as hot_join()."""
    marked, rest = _marked(left, right.select(*on, n), on, n, rows)
    return marked.filter("_hot is null").drop("_hot", n).join(rest, on, "left_anti")
