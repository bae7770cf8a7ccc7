"""At most so many rows per contributor, the best by score, through radix selection of a cutoff (problem 4)."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curaspark.functions.text import BLANK, missing, rank_key
from curaspark.llm.skew import hot_join
from curaspark.session import as_table, counted_table, lookup_join

#: The score key of a row without a score; larger than that of any score.
NO_SCORE = 2**63 - 1


def score_key(score: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """Order-preserving 64 bits of a score from low to high, the best first; what is no such score (null and NaN as well) comes last.

    The keys have 63 bits and no sign, so a range may not reach from below 0 to above it.
    """
    if not low <= high or low < 0 < high:
        raise ValueError("the range of scores is empty or has scores below and above 0")

    @F.pandas_udf(T.LongType())
    def key(q: pd.Series) -> pd.Series:
        x = q.to_numpy(np.float64, na_value=np.nan)
        ok = (x >= low) & (x <= high)
        bits = (np.where(ok, x, low) + 0.0).view(np.int64)
        bits = np.where(bits < 0, np.int64(-(2**63)) - bits, bits)  # negative scores in their order below 0
        return pd.Series(np.where(ok, _top(high) - bits, NO_SCORE))

    return key(score.cast("double"))


def _top(high: float) -> int:
    bits = int(np.float64(high + 0.0).view(np.int64))
    return bits if bits >= 0 else -(2**63) - bits


def species_key(species: Column, genus: Column) -> Column:
    """'genus epithet' in lower case, however written; null for a missing species and for a placeholder.

    Markup, quotes, a subgenus in brackets, '_' and '+' for a blank make no difference. A name with a dot or a digit is a placeholder. A single
    word is an epithet of the row's genus, or nothing where that is missing or the same word.
    """
    usual = F.when(species.rlike("^[A-Za-z]+ [A-Za-z]+$"), F.lower(species))
    s = F.regexp_replace(F.lower(species), r"<[^>]*>|\([^)]*\)|[\"'“”„‘’«»]", "")
    s = F.btrim(F.regexp_replace(s, rf"(?:{BLANK}|[_+])+", " "))
    own = F.lower(rank_key(genus))
    two = F.when(s.contains(" "), F.substring_index(s, " ", 2)).when(own.isNotNull() & (own != s), F.concat_ws(" ", own, s))
    return F.coalesce(usual, F.when(~missing(species) & ~s.isin("", "none", "unclassified") & ~s.rlike(r"[.0-9]"), two))


def genus_key(genus: Column) -> Column:
    """A genus in lower case, null where missing."""
    return F.lower(rank_key(genus))


def _digit(key: Column, d: int) -> Column:
    """Byte d, from the highest, of a 64-bit key that is not negative."""
    return F.shiftrightunsigned(key, 8 * (7 - d)).bitwiseAND(F.lit(255))


def _select(rows: DataFrame, state: DataFrame, first: int) -> DataFrame:
    """who, cut, need, n: radix selection of the need-th smallest key of each who. rows: who, key, c (how many). state: who, need.

    Each pass counts the rows of the buckets still open by contributor and byte, and fixes the byte in whose bucket the cutoff lies. A
    contributor is done when its bucket holds one key, or no more than what is needed. need is then what may be taken of
    the rows at the cutoff and n how many there are, equal ones counted.
    """
    done, open_ = [], state.withColumn("prefix", F.lit(0).cast("bigint"))
    for d in range(first, 8):
        live = lookup_join(rows, open_, "who", salt=F.col("key")).filter(F.shiftrightunsigned("key", 8 * (8 - d)) == F.col("prefix")) if d > first else lookup_join(rows, open_, "who", salt=F.col("key"))
        hist = live.groupBy("who", "need", "prefix", _digit(F.col("key"), d).alias("b")).agg(F.sum("c").alias("c"), F.min("key").alias("low"), F.max("key").alias("cut"))
        cum = F.sum("c").over(W.partitionBy("who").orderBy("b"))  # at most 256 rows a contributor
        hit = hist.withColumn("cum", cum).filter("cum >= need and cum - c < need").withColumn("need", F.col("need") - (F.col("cum") - F.col("c")))
        hit = as_table(hit.select("who", "need", F.col("c").alias("n"), "low", "cut", F.shiftrightunsigned("cut", 8 * (7 - d)).alias("prefix")))
        over = (F.col("low") == F.col("cut")) | (F.col("n") == F.col("need"))
        done.append(hit.filter(over).select("who", "cut", "need", "n"))
        open_ = hit.filter(~over).select("who", "need", "prefix")
        if open_.isEmpty():
            break
    return reduce(DataFrame.unionByName, done)


def over_cap(df: DataFrame, who: Column, row_id: str, score: Column, cap: int | None = None, share: float | None = None, scores: tuple[float, float] = (0.0, 100.0)) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) of the contributors with more rows than they may have: row_id, who.

    A contributor may have `cap` rows, or the given share of all rows with a contributor (rounded down, one at least), or the smaller number of both. kept
    are its rows of highest score, the smaller row_id first among equals; scores outside of `scores`, null and
    NaN come last and are equal to each other. Rows without contributor are in neither, nor are those of contributors with no
    more than that. row_id must be a unique integer. An empty table gives two empty tables.

    Score and id are order-preserving 64-bit keys. Equal scores of a contributor are counted first, the cutoff score is found byte by
    byte on these counts, then the cutoff id byte by byte among the rows at that score. So only counts of at most 256 buckets a
    contributor are ever gathered, and rows are compared with their cutoff at the end.
    """
    if cap is None and share is None:
        raise ValueError("give a cap, a share or both")
    rows, total = counted_table(df.select(F.col(row_id).cast("bigint").alias("row_id"), who.alias("who"), score_key(score, *scores).alias("key")).filter("who is not null"))
    cap = min(c for c in (cap, None if share is None else max(1, int(share * total))) if c is not None)
    large = as_table(rows.groupBy("who").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cap))
    rows = as_table(hot_join(rows, large, ["who"], "n", total))
    need = large.select("who", F.lit(cap).cast("bigint").alias("need"))
    by_score = as_table(rows.groupBy("who", "key").agg(F.count(F.lit(1)).alias("c")))
    at_score = as_table(_select(by_score, need, 0).select("who", F.col("cut").alias("cut_score"), "need", F.col("n").alias("n_at")))
    # Contributors that may take only a part of the rows at their cutoff score: the ids decide.
    part = at_score.filter("n_at > need")
    ties = as_table(lookup_join(rows.drop("n"), part, "who", salt=F.col("row_id")).filter("key = cut_score").select("who", "row_id"))
    span = ties.agg(F.min("row_id").alias("a"), F.max("row_id").alias("b")).first()
    ids = None
    if span.a is not None:
        # Counted from the smallest, ids are not negative, and the leading bytes that all share need no pass.
        keys = ties.select("who", (F.col("row_id") - F.lit(span.a)).alias("key"), F.lit(1).alias("c"))
        ids = _select(keys, part.select("who", "need"), 8 - max(1, -(-(span.b - span.a).bit_length() // 8))).withColumn("cut", F.col("cut") + F.lit(span.a))
    cuts = at_score.select("who", "cut_score")
    cuts = cuts.join(ids.select("who", F.col("cut").alias("cut_id")), "who", "left") if ids is not None else cuts.withColumn("cut_id", F.lit(None).cast("bigint"))
    cuts = as_table(cuts.join(large, "who"))
    judged = hot_join(rows.drop("n"), cuts, ["who"], "n", total).withColumn("keep", (F.col("key") < F.col("cut_score")) | ((F.col("key") == F.col("cut_score")) & (F.col("cut_id").isNull() | (F.col("row_id") <= F.col("cut_id")))))
    judged = as_table(judged.select("row_id", "who", "keep"))
    return judged.filter("keep").drop("keep"), judged.filter("not keep").drop("keep")


def capped(df: DataFrame, who: Column, row_id: str, score: Column, cap: int | None = None, share: float | None = None, scores: tuple[float, float] = (0.0, 100.0)) -> DataFrame:
    """All rows of df but those beyond the cap or share of their contributor (see over_cap()); rows without contributor stay. Columns as in df."""
    _, dropped = over_cap(df, who, row_id, score, cap, share, scores)
    return df.join(dropped.select(F.col("row_id").alias(row_id)), row_id, "left_anti")
