"""Alignment of records with each other: all against a common centre, whose insertions are made room for once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curaspark.operators.similarity import overlap_path
from curaspark.session import as_table, spread


def laid_on(seq: str, centre: str) -> list[tuple[int, str]]:
    """What a sequence has at the centre's positions: (position, base) from 1, '-' left out; bases inserted behind position p come as (p, 'xy') in lower case.

    What hangs over an end of the centre is inserted before its first (0) or behind its last position.
    """
    out: list[tuple[int, str]] = []
    path = overlap_path(seq, centre)
    if not path:
        return [(0, seq.lower())] if seq else []
    inserted: dict[int, str] = {}
    first = next((i for i, _ in path if i >= 0), 0)
    inserted[path[0][1] if path[0][1] > 0 else 0] = seq[:first].lower()
    at, end = max(path[0][1], 0), first
    for i, j in path:
        if j >= 0:
            at = j + 1
        if i >= 0:
            end = i + 1
            if j >= 0:
                out.append((at, seq[i].upper()))
            else:
                inserted[at] = inserted.get(at, "") + seq[i].lower()
    inserted[at] = inserted.get(at, "") + seq[end:].lower()
    return out + [(p, s) for p, s in inserted.items() if s]


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("s", T.StringType())])))
def _laid(seqs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for s, c in seqs:
        yield pd.Series([None if x is None else laid_on(x, y) for x, y in zip(s, c)], dtype=object)


@F.pandas_udf(T.StringType())
def _rendered(laid: pd.Series, gaps: pd.Series, n: pd.Series) -> pd.Series:
    out = []
    for cells, room, size in zip(laid, gaps, n):
        if cells is None:
            out.append(None)
            continue
        base = ["-"] * (size + 1)
        behind = [""] * (size + 1)
        for c in cells:
            if c["s"].isupper():
                base[c["at"]] = c["s"]
            else:
                behind[c["at"]] = c["s"].upper()
        width = dict((g["at"], g["w"]) for g in room)
        # What hangs over the start ends at the first column; other insertions begin at theirs.
        row = [behind[0].rjust(width.get(0, 0), "-")]
        row += [base[p] + behind[p].ljust(width.get(p, 0), "-") for p in range(1, size + 1)]
        out.append("".join(row))
    return pd.Series(out, dtype=object)


def star_alignment(df: DataFrame, key: str, seq: str, core: str | None = None) -> DataFrame:
    """df with aligned: every sequence on common columns, '-' for none, all equally long; null for null sequences, all gaps for empty ones.

    The centre is the longest sequence, of equal ones that of least key; with `core` (a boolean column) the longest of the core, so core records fix the
    columns and the others are added to them. Each sequence is aligned with the centre by an overlap alignment with gaps, and every
    position gets as many columns behind it as the longest insertion there needs. One sequence and one number a position of it, both bounded by the longest
    sequence, go to the tasks; records never meet each other. aligned of df is replaced. An empty table gives no rows.
    """
    rows = df.drop("aligned").filter(F.col(seq).isNotNull())
    pick = F.struct(F.coalesce(F.col(core), F.lit(False)) if core else F.lit(True), F.length(seq), F.lit(0))
    best = rows.select(pick.alias("p"), F.col(key).alias("k"), F.upper(seq).alias("s"))
    top = best.agg(F.max("p").alias("p")).first()
    if top is None or top.p is None:
        return df.drop("aligned").withColumn("aligned", F.lit(None).cast("string"))
    centre = best.filter((F.col("p.col1") == F.lit(top.p[0])) & (F.col("p.col2") == F.lit(top.p[1]))).agg(F.min_by("s", "k").alias("s")).first().s
    laid = as_table(spread(df.drop("aligned")).withColumn("_laid", _laid(F.upper(seq), F.lit(centre))))
    each = laid.select(F.explode("_laid").alias("c")).filter(F.col("c.s") == F.lower("c.s"))
    room = each.groupBy("c.at").agg(F.max(F.length("c.s")).alias("w")).collect()  # at most one row for each position of the centre
    gaps = F.array(*[F.struct(F.lit(r["at"]).alias("at"), F.lit(r.w).alias("w")) for r in room]) if room else F.array().cast("array<struct<at:int,w:int>>")
    return laid.withColumn("aligned", _rendered("_laid", gaps, F.lit(len(centre)))).drop("_laid")
