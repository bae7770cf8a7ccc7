"""Per-key results without the imbalance that a few keys with most rows cause (problem 3)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.session import as_table, lookup_join

#: Most keys whose dictionary is sent to every task; beyond it the JVM's partial aggregation takes over.
DICTIONARY_KEYS = 1_000_000
#: The lower bits of a number; sums of 2^27 of them, and of the upper bits of 2^15 numbers (a batch has 10,000), are exact in doubles.
HALF = (1 << 26) - 1
#: Slots of one array block, the unit of the reduction.
BLOCK = 8192


def dense_key_stats(df: DataFrame, keys: dict[str, Column], sums: dict[str, Column], dictionary_keys: int = DICTIONARY_KEYS) -> DataFrame:
    """Row count and integer sums for each value of each key field: key_field, key_value, n_rows, one column per sum.

    Keys are dictionary-encoded. Every task adds its own input split into dense arrays (numpy bincount), so its work depends
    on its rows only and never on how they fall on keys. The arrays are cut into blocks and added up in two
    rounds, first by block and salt, then by block. A task's output is bounded by the dictionary, whatever the skew.

    Null keys are counted in a row with a null key_value. Null sums count 0. sums must be integers. An empty table gives no
    rows. Above `dictionary_keys` keys the same result comes from partial and final aggregation in the JVM.
    Columns of df other than those named play no part, whatever they are called.
    """
    fields = list(keys)
    flat = df.select(*[c.cast("string").alias(f"k{i}") for i, c in enumerate(keys.values())], *[F.coalesce(c.cast("bigint"), F.lit(0)).alias(f"s{i}") for i, c in enumerate(sums.values())])
    pairs = flat.select(F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"k{i}").alias("k")) for i in range(len(fields))])).alias("p")).select("p.*")
    found = pairs.filter("k is not null").distinct().limit(dictionary_keys + 1).toPandas()
    if len(found) > dictionary_keys:
        return _by_jvm(flat, fields, list(sums))
    words = [sorted(found.k[found.f == i]) for i in range(len(fields))]
    shared = df.sparkSession.sparkContext.broadcast(words)
    names = list(sums)
    n_sums, part_rows = len(names), "f int, b int, salt int, v array<array<bigint>>"

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        values = [pa.array(w, pa.string()) for w in shared.value]
        acc = [np.zeros((1 + n_sums, len(w) + 1), np.int64) for w in shared.value]
        for b in batches:
            weights = [b.column(len(values) + j).to_numpy(zero_copy_only=False) for j in range(n_sums)]
            for i, w in enumerate(values):
                code = pc.fill_null(pc.index_in(b.column(i), value_set=w), len(w)).to_numpy(zero_copy_only=False)
                acc[i][0] += np.bincount(code, minlength=len(w) + 1)
                for j in range(n_sums):
                    # bincount adds doubles: in two halves each of a batch's sums is exact.
                    low, high = weights[j] & HALF, weights[j] >> 26
                    for part, shift in ((low, 0), (high, 26)):
                        acc[i][1 + j] += np.bincount(code, weights=part, minlength=len(w) + 1).astype(np.int64) << shift
        out = []
        salt = TaskContext.get().partitionId() % 64
        for i, a in enumerate(acc):
            for k in range(math.ceil(a.shape[1] / BLOCK)):
                part = a[:, k * BLOCK : (k + 1) * BLOCK]
                if part[0].any():
                    out.append((i, k, salt, part.tolist()))
        if out:
            f, k, s, v = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(k, pa.int32()), pa.array(s, pa.int32()), pa.array(v, pa.list_(pa.list_(pa.int64())))], names=["f", "b", "salt", "v"])

    def add(rows: pd.DataFrame) -> np.ndarray:
        return sum(np.array([list(x) for x in v], np.int64) for v in rows.v)

    def halfway(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"f": [key[0]], "b": [key[1]], "salt": [0], "v": [add(rows).tolist()]})

    def final(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        f, k = int(key[0]), int(key[1])
        a = add(rows)
        words = (shared.value[f] + [None])[k * BLOCK : (k + 1) * BLOCK]
        out = pd.DataFrame({"key_field": fields[f], "key_value": words, "n_rows": a[0]} | {n: a[1 + j] for j, n in enumerate(names)})
        return out[out.n_rows > 0]

    made = flat.mapInArrow(accumulate, part_rows).groupBy("f", "b", "salt").applyInPandas(halfway, part_rows)
    return made.groupBy("f", "b").applyInPandas(final, "key_field string, key_value string, n_rows bigint" + "".join(f", {n} bigint" for n in names))


def _by_jvm(flat: DataFrame, fields: list[str], sums: list[str]) -> DataFrame:
    rows = flat.select(
        F.explode(F.array(*[F.struct(F.lit(f).alias("key_field"), F.col(f"k{i}").alias("key_value")) for i, f in enumerate(fields)])).alias("p"),
        *[F.col(f"s{j}") for j in range(len(sums))],
    )
    return rows.groupBy("p.key_field", "p.key_value").agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(f"s{j}").alias(n) for j, n in enumerate(sums)])


def heavy_keys(stats: DataFrame, share: float) -> DataFrame:
    """The keys of dense_key_stats that hold at least `share` of all rows, those with a null key included in 'all'.

    The rows of a field are summed up, one number a field, and joined back; no task holds all keys of a field.
    """
    whole = as_table(stats.groupBy("key_field", "key_value").agg(F.sum("n_rows").alias("n")))
    fields = whole.groupBy("key_field").agg(F.sum("n").alias("_all"))
    heavy = lookup_join(whole.filter("key_value is not null"), fields, "key_field", salt=F.col("key_value"))
    return heavy.filter(F.col("n") >= share * F.col("_all")).select("key_field", "key_value")
