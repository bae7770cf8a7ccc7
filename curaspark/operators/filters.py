"""Record and group filters. Each adds to `fate` the name of the stage that removes a record; survivors keep a null fate."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curaspark.functions import seq as Q
from curaspark.functions.text import RANKS
from curaspark.session import as_table

# The stages in their order; the last is the fate of what remains.
FATES = ["filter_unclassified", "filter_phmm_full", "filter_phmm_amplicon", "filter_duplicates", "filter_ambiguous", "filter_tax_outliers", "filter_redundant", "filter_seq_outliers", "select_final_sequences"]
FINAL = "final_database"
SOURCES = ["genbank", "bold", "mito", "genome", "internal"]
UNCLASSIFIED = "Unclassified"
#: Sequences of one task of the distance matrix; larger species are worked on in such blocks of rows against all.
BLOCK = 500


def removed(df: DataFrame, stage: str, condition: Column) -> DataFrame:
    """df with the stage as fate of the survivors that meet a condition (null counts as not met)."""
    now = F.col("fate") if "fate" in df.columns else F.lit(None).cast("string")
    return df.withColumn("fate", F.when(now.isNull() & F.coalesce(condition, F.lit(False)), F.lit(stage)).otherwise(now))


def alive(df: DataFrame) -> DataFrame:
    return df.filter("fate is null") if "fate" in df.columns else df


def unclassified(ranks: list[str], mode: str) -> Column:
    """Whether a lineage is unclassified: at all ranks, at any rank, or at the last ('terminal'); never for 'none'. Nulls count as unclassified."""
    blank = [F.coalesce(F.col(r), F.lit(UNCLASSIFIED)) for r in ranks]
    if mode == "all_ranks":
        return reduce(Column.__and__, [b == UNCLASSIFIED for b in blank])
    if mode == "any_ranks":
        return reduce(Column.__or__, [F.contains(b, F.lit(UNCLASSIFIED)) for b in blank])
    if mode == "terminal":
        return F.endswith(blank[-1], F.lit(UNCLASSIFIED))
    if mode == "none":
        return F.lit(False)
    raise ValueError(mode)


def filter_unclassified(df: DataFrame, mode: str = "all_ranks") -> DataFrame:
    return removed(df, "filter_unclassified", unclassified(RANKS, mode))


def filter_ambiguous(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Sequences with any letter of ambiguity, either case."""
    return removed(df, "filter_ambiguous", Q.is_ambiguous(F.col(seq)))


def filter_duplicates(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """All but the first record of each header. Only headers that occur twice go through a sort, so a header with a third of the rows is one
    aggregation: the first of a header is the least struct of `order`, which must be unique. Null headers are no duplicates."""
    first = alive(df).filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("_n")).agg(F.min(F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("_k")).filter("_k > 1")
    out = df.join(first, df[name] == first["_n"], "left")
    return removed(out, "filter_duplicates", F.col("_first").isNotNull() & (F.struct(*[F.col(c) for c in order]) != F.col("_first"))).drop("_n", "_first", "_k")


def mixed_clusters(members: DataFrame, cluster: str, seqid: str, rank: str, confidence: float = 0.8, returned: str = "consensus") -> DataFrame:
    """What clusters of sequences from several taxa hold. members: cluster, seqid, rank.

    Members with a rank that is null or Unclassified don't count. Of clusters with more than two classified members and at least two taxa over their distinct
    (seqid, taxon), the consensus is the most frequent taxon, none where several are equally frequent, and its confidence its share.
    returned: 'consensus' gives cluster, consensus, confidence, n_members, n_taxa; 'counts' gives cluster, taxon, n;
    'all' gives cluster, seqid, taxon, consensus, confidence of the members that differ from it, where confidence is reached.
    Taxa are counted before anything is gathered by cluster, so a large cluster is never in one task.
    """
    m = members.select(F.col(cluster).alias("cluster"), F.col(seqid).alias("seqid"), F.col(rank).alias("taxon")).filter((F.col("taxon") != UNCLASSIFIED) & F.col("cluster").isNotNull())
    counts = m.groupBy("cluster", "taxon", "seqid").agg(F.count(F.lit(1)).alias("k")).groupBy("cluster", "taxon").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("members"))
    top = counts.groupBy("cluster").agg(F.sum("members").alias("members"), F.sum("n").alias("n_members"), F.count(F.lit(1)).alias("n_taxa"), F.max("n").alias("most"), F.max_by("taxon", "n").alias("taxon_"))
    mixed = top.filter("members > 2 and n_taxa > 1")
    if returned == "counts":
        return counts.join(mixed.select("cluster"), "cluster", "left_semi").select("cluster", "taxon", "n")
    tied = counts.join(mixed.select("cluster", "most"), "cluster").filter("n = most").groupBy("cluster").agg(F.count(F.lit(1)).alias("firsts"), F.min("taxon").alias("first"))
    agreed = mixed.join(tied, "cluster").select("cluster", F.when(F.col("firsts") == 1, F.col("first")).alias("consensus"), F.round(F.col("most") / F.col("n_members"), 9).alias("confidence"), "n_members", "n_taxa")
    if returned == "consensus":
        return agreed
    if returned != "all":
        raise ValueError(returned)
    sure = agreed.filter(F.col("consensus").isNotNull() & (F.col("confidence") >= confidence))
    return m.join(sure.select("cluster", "consensus", "confidence"), "cluster").filter("taxon <> consensus").select("cluster", "seqid", "taxon", "consensus", "confidence").distinct()


def filter_tax_outliers(df: DataFrame, clusters: DataFrame, ranks: tuple[str, ...] = ("genus",), confidence: float = 0.8) -> DataFrame:
    """Records whose taxon differs from the consensus of their cluster at any of the ranks. clusters: seqid, cluster. Records are compared by equal seqid."""
    live = alive(df).select("seqid", *ranks).join(clusters, "seqid")
    out = reduce(DataFrame.unionByName, [mixed_clusters(live, "cluster", "seqid", r, confidence, "all").select("seqid") for r in ranks])
    marked = df.join(out.distinct().withColumn("_out", F.lit(True)), "seqid", "left")
    return removed(marked, "filter_tax_outliers", F.col("_out")).drop("_out")


def rank_hash(ranks: list[str]) -> Column:
    """Hash of a lineage down to a rank, the name under which its records go together."""
    return F.md5(F.concat_ws(";", *[F.coalesce(F.col(r), F.lit(UNCLASSIFIED)) for r in ranks]))


#: Length of the k-mers whose hashes stand for a sequence, and how many neighbours of them give one.
ANCHOR, WINDOW = 16, 16


@F.pandas_udf(T.ArrayType(T.LongType()))
def _minimizers(s: pd.Series) -> pd.Series:
    """The least hash of each WINDOW neighbouring k-mers of a sequence, each once. All of a sequence's are also those of any that holds it."""
    out = []
    with np.errstate(over="ignore"):
        for x in s:
            code = np.frombuffer(x.encode(), np.uint8).astype(np.uint64)
            n = len(code) - ANCHOR + 1
            if n < WINDOW:
                out.append([])
                continue
            h = np.zeros(n, np.uint64)
            for i in range(ANCHOR):
                h = h * np.uint64(0x100000001B3) + code[i : i + n]
            h ^= h >> np.uint64(31)
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            least = h[: n - WINDOW + 1].copy()
            for i in range(1, WINDOW):
                np.minimum(least, h[i : n - WINDOW + 1 + i], out=least)
            out.append(np.unique(least.astype(np.int64)).tolist())
    return pd.Series(out, dtype=object)


def _contained(one: DataFrame) -> DataFrame:
    """small, large: candidate pairs in a group of sequences long enough for minimizers. one: gid, id, s, l.

    A sequence's rarest minimizer in its group is its anchor; one with a minimizer that nothing else of the group has is contained in nothing. Only ids, lengths and
    hashes move; the pairs are those of the sequences that share the anchor and are longer.
    """
    own = as_table(one.select("gid", "id", "l", F.explode(_minimizers("s")).alias("h")))
    often = own.groupBy("gid", "h").agg(F.count(F.lit(1)).alias("k"))
    met = own.join(often, ["gid", "h"])
    anchor = met.groupBy("gid", "id").agg(F.min(F.struct("k", "h")).alias("a"), F.first("l").alias("small_l")).filter("a.k > 1").select("gid", "a.h", F.col("id").alias("small"), "small_l")
    return anchor.join(own.withColumnRenamed("id", "large"), ["gid", "h"]).filter("small_l < l").select("small", "large")


def absorbed(df: DataFrame, group: list[str], key: str, seq: str) -> DataFrame:
    """key, count, absorbed_by of each record: identical and contained sequences of a group are absorbed by the longest sequence that holds them.

    Of identical sequences the one with the least key stays, a contained one goes to its longest container (the least
    key among equals); reverse complements are not looked at. count is 1 plus what a survivor absorbed, directly or through what it absorbed; it is null
    for the absorbed, and absorbed_by null for survivors. Null sequences stay. Empty sequences are held by any other of the group.

    Distinct sequences meet over rare anchors (see _contained()), as numbers; their letters are fetched for the pairs that are left. Sequences shorter than
    ANCHOR + WINDOW - 1 are looked up among all parts of their length, one pass for each such length.
    """
    base = df.filter(F.col(seq).isNotNull()).select(*[F.coalesce(F.col(g).cast("string"), F.lit("\0")).alias(g) for g in group], F.col(key).alias("_k"), F.col(seq).alias("_s"))
    one = base.groupBy(*group, "_s").agg(F.min("_k").alias("_k"), F.count(F.lit(1)).alias("_n")).withColumn("l", F.length("_s"))
    one = as_table(one.withColumn("gid", F.xxhash64(*group)).withColumn("id", F.monotonically_increasing_id()).withColumnRenamed("_s", "s"))
    least = ANCHOR + WINDOW - 1
    held = [_contained(one.filter(F.col("l") >= least).select("gid", "id", "s", "l"))]
    lengths = one.filter(F.col("l") < least).select("l").distinct().orderBy("l").collect()  # fewer than least
    for size in (r.l for r in lengths):
        short = one.filter(F.col("l") == size).select("gid", F.col("id").alias("small"), F.col("s").alias("_a"))
        if size == 0:
            top = one.groupBy("gid").agg(F.min(F.struct((-F.col("l")).alias("m"), "_k", "id")).alias("t")).filter("t.m < 0").select("gid", F.col("t.id").alias("large"))
            held.append(short.join(top, "gid").select("small", "large"))
        else:
            parts = one.filter(F.col("l") > size).select("gid", F.col("id").alias("large"), F.explode(F.array_distinct(Q.kmers(F.col("s"), size))).alias("_a"))
            held.append(parts.join(short, ["gid", "_a"]).select("small", "large"))
    pairs = as_table(reduce(DataFrame.unionByName, held))
    small = one.select(F.col("id").alias("small"), F.struct(*group).alias("g1"), F.col("s").alias("s1"))
    large = one.select(F.col("id").alias("large"), F.struct(*group).alias("g2"), F.col("s").alias("s2"), "l", F.col("_k").alias("large_k"))
    sure = pairs.join(small, "small").join(large, "large").filter((F.col("g1") == F.col("g2")) & F.contains("s2", "s1"))
    best = sure.groupBy("small").agg(F.min(F.struct((-F.col("l")).alias("l"), F.col("large_k").alias("k"))).alias("b")).select(F.col("small").alias("id"), F.col("b.k").alias("large"))
    # The longest container of a sequence is itself contained in nothing, else that would be longer and hold it too.
    given = as_table(one.join(best, "id", "left").select(*group, F.col("s").alias("_s"), F.col("_k").alias("_first"), "_n", "large"))
    totals = given.groupBy(F.coalesce("large", "_first").alias("_k")).agg(F.sum("_n").alias("count"))
    rows = base.join(given.drop("_n"), [*group, "_s"])
    rows = rows.select("_k", F.when(F.col("large").isNotNull(), F.col("large")).when(F.col("_k") != F.col("_first"), F.col("_first")).alias("absorbed_by"))
    out = rows.join(totals, "_k", "left").select(F.col("_k").alias(key), F.when(F.col("absorbed_by").isNull(), F.col("count")).alias("count"), "absorbed_by")
    none = df.filter(F.col(seq).isNull()).select(key, F.lit(1).cast("bigint").alias("count"), F.lit(None).cast(dict(df.dtypes)[key]).alias("absorbed_by"))
    return out.unionByName(none)


def filter_redundant(df: DataFrame, key: str = "rid", seq: str = "seq") -> DataFrame:
    """Records absorbed by another of the same full lineage; survivors get their count in `copies`."""
    got = absorbed(alive(df), RANKS, key, seq)
    return removed(df.join(got, key, "left").withColumnRenamed("count", "copies"), "filter_redundant", F.col("absorbed_by").isNotNull()).drop("absorbed_by")


_CODE = np.full(256, 255, np.uint8)
for _i, _b in enumerate(b"ACGT"):
    _CODE[_b] = _CODE[_b + 32] = _i
_CODE[ord("-")] = 4


def aligned_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jukes-Cantor distances of aligned rows (codes 0..3, 4 for a gap, 255 for anything else) of a to those of b.

    Only the columns between both first and last letters count. A gap against a letter is a difference, a gap against a gap is no column; ambiguous
    letters are no column. Infinite from 3/4 differing sites on, and without a common column.
    """
    def spans(x: np.ndarray) -> np.ndarray:
        letter = x != 4
        first = np.where(letter.any(1), letter.argmax(1), x.shape[1])
        last = x.shape[1] - 1 - letter[:, ::-1].argmax(1)
        at = np.arange(x.shape[1])
        return (at >= first[:, None]) & (at <= last[:, None])

    ia, ib = spans(a) & (a != 255), spans(b) & (b != 255)
    f = np.float32
    columns = ia.astype(f) @ ib.astype(f).T - (ia & (a == 4)).astype(f) @ (ib & (b == 4)).astype(f).T
    same = sum((ia & (a == c)).astype(f) @ (ib & (b == c)).astype(f).T for c in range(4))
    with np.errstate(divide="ignore", invalid="ignore"):
        p = (columns - same) / columns
        d = -0.75 * np.log(1 - 4 * p.astype(np.float64) / 3)
    return np.where((columns > 0) & (p < 0.75), np.maximum(d, 0), np.inf)


def weighted_medians(d: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Median of each row's values, each repeated by its weight (the mean of the two middle ones for an even number)."""
    order = np.argsort(d, axis=1, kind="stable")
    cum = np.cumsum(weights[order], axis=1)
    total = cum[:, -1:]
    low, high = (total - 1) // 2, total // 2
    pick = lambda k: np.take_along_axis(d, np.take_along_axis(order, (cum <= k).sum(1, keepdims=True), 1), 1)[:, 0]
    with np.errstate(invalid="ignore"):
        a, b = pick(low), pick(high)
        return np.where(a == b, a, (a + b) / 2)


def centres(df: DataFrame, group: list[str], key: str, values: str, weight: str, kind: str = "dna", block: int = BLOCK) -> DataFrame:
    """group, centre, centre_values, median: the member of each group with the least weighted median distance to all members (the least key among equals).

    values: aligned sequences of equal length ('dna', Jukes-Cantor) or vectors ('vector', squared Euclidean distance). weight: how often a member counts.
    The distances of a group are worked out by blocks of rows against all its members and reduced to a median each, so no pair
    leaves a task and a large group is many tasks.
    """
    g = F.xxhash64(*group)
    sized = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    parts = df.join(sized, group).withColumn("_g", g).withColumn("_blocks", F.ceil(F.col("_size") / block).cast("int"))
    mine = F.pmod(F.xxhash64(F.col(key).cast("string")), F.col("_blocks")).cast("int")
    spread = parts.withColumn("_own", mine).withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    spread = spread.select(*group, "_g", "_b", (F.col("_own") == F.col("_b")).alias("_mine"), F.col(key).alias("_key"), F.col(values).alias("_v"), F.col(weight).cast("bigint").alias("_w"))

    def medians(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_key")
        own = rows[rows._mine]
        if own.empty:
            return pd.DataFrame({"_g": [], "_key": [], "median": []})
        if kind == "dna":
            x = _CODE[np.array([np.frombuffer(s.encode(), np.uint8) for s in rows._v])]
            d = aligned_distances(x[rows._mine.to_numpy()], x)
        else:
            x = np.array(rows._v.tolist(), np.float64)
            y = x[rows._mine.to_numpy()]
            d = np.maximum((y * y).sum(1)[:, None] + (x * x).sum(1)[None] - 2 * y @ x.T, 0)
        return pd.DataFrame({"_g": own._g, "_key": own._key, "median": weighted_medians(d, rows._w.to_numpy())})

    kinds = dict(df.dtypes)
    got = spread.groupBy("_g", "_b").applyInPandas(medians, f"_g bigint, _key {kinds[key]}, median double")
    best = got.groupBy("_g").agg(F.min(F.struct("median", "_key")).alias("b")).select("_g", F.col("b._key").alias("_key"), F.col("b.median").alias("median"))
    chosen = df.withColumn("_g", g).join(best, [df[key] == best["_key"], g == best["_g"]])
    return chosen.select(*group, F.col(key).alias("centre"), F.col(values).alias("centre_values"), "median")


@F.pandas_udf(T.DoubleType())
def pair_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jukes-Cantor distance of two aligned sequences of equal length; null where one is null, and where they are empty or not equally long."""
    out: list[float | None] = []
    for x, y in zip(a, b):
        same = x and y and len(x) == len(y)
        out.append(float(aligned_distances(_CODE[np.frombuffer(x.encode(), np.uint8)][None], _CODE[np.frombuffer(y.encode(), np.uint8)][None])[0, 0]) if same else None)
    return pd.Series(out, dtype="float64")


def filter_seq_outliers(df: DataFrame, key: str = "rid", aligned: str = "aligned", weight: str = "copies", threshold: float = 0.05) -> DataFrame:
    """Records further than a threshold from the centre of their species. Species that are Unclassified or have one distinct sequence are left alone."""
    live = alive(df).filter((F.col("species") != UNCLASSIFIED) & F.col(aligned).isNotNull())
    several = live.groupBy(*RANKS).agg(F.countDistinct(aligned).alias("k")).filter("k > 1").drop("k")
    centre = centres(live.join(several, RANKS, "left_semi"), RANKS, key, aligned, weight)
    centre = centre.select(*[F.col(r).alias(f"_{r}") for r in RANKS], F.col("centre_values").alias("_centre"))
    out = df.join(centre, [df[r].eqNullSafe(centre[f"_{r}"]) for r in RANKS], "left")
    far = F.nanvl(pair_distance("_centre", aligned), F.lit(None).cast("double")) > threshold
    return removed(out, "filter_seq_outliers", far).drop("_centre", *[f"_{r}" for r in RANKS])


def select_final(df: DataFrame, max_group_size: int = 1, method: str = "length", key: str = "rid", seq: str = "seq", prefer: str | None = "internal", seed: int = 0, exempt: bool = True) -> DataFrame:
    """Representatives: one of each species' identical sequences, then at most max_group_size per lineage; others get the fate.

    Internal records win first among identical ones; within a lineage the longest without gaps come first and internal ones among equals ('length'),
    or internal ones come first and the rest in a random order fixed by seed ('random'). The least key breaks ties. Lineages that end in Unclassified are exempt from the second
    step (with exempt). A lineage's rows are ranked by salted partial tops before the final ones meet, so no task sorts a large lineage.
    """
    live = alive(df)
    first = (F.col("source") == prefer).cast("int") if prefer and "source" in df.columns else F.lit(0)
    first = F.coalesce(first, F.lit(0))
    rows = live.select(F.col(key).alias("_k"), *RANKS, F.xxhash64("species", seq).alias("_h"), F.md5(F.concat_ws("|", F.coalesce("species", F.lit("")), F.coalesce(seq, F.lit("")))).alias("_m"), F.coalesce(Q.gapless_length(F.col(seq)), F.lit(0)).alias("_l"), first.alias("_i"))
    one = as_table(rows.groupBy("_m").agg(F.min(F.struct((-F.col("_i")).alias("i"), "_k", "_l", *RANKS)).alias("r")).select("r.*"))
    order = ["nl", "i", "_k"] if method == "length" else ["i", "x", "_k"]
    ranked = one.withColumn("nl", -F.col("_l")).withColumn("x", F.xxhash64(F.lit(seed), F.col("_k").cast("string")))
    free = ~F.lit(exempt) | ~F.endswith(F.coalesce("species", F.lit(UNCLASSIFIED)), F.lit(UNCLASSIFIED))
    salted = ranked.filter(free).withColumn("_s", F.pmod(F.xxhash64(F.col("_k").cast("string"), F.lit(1)), F.lit(64)))
    part = salted.withColumn("_r", F.row_number().over(W.partitionBy(*RANKS, "_s").orderBy(*order))).filter(F.col("_r") <= max_group_size)
    kept = part.withColumn("_r", F.row_number().over(W.partitionBy(*RANKS).orderBy(*order))).filter(F.col("_r") <= max_group_size).select(F.col("_k").alias("_kept"))
    kept = kept.unionByName(ranked.filter(~free).select(F.col("_k").alias("_kept")))
    out = df.join(kept, df[key] == kept["_kept"], "left")
    return removed(out, "select_final_sequences", F.col("_kept").isNull()).drop("_kept")
