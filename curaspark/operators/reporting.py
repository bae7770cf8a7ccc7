"""Reports: the fate of every record, taxa per step, key species, core sequences, summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curaspark.functions import headers
from curaspark.functions.text import RANKS
from curaspark.operators.filters import FATES, FINAL


def sources_and_fates(sources: DataFrame, fates: DataFrame) -> DataFrame:
    """name, source, fate: inner join on name. A name that occurs several times on both sides gives every combination; key on a unique id where that isn't wanted."""
    return sources.join(fates, "name").select("name", "source", "fate")


def record_table(df: DataFrame) -> DataFrame:
    """name, seqid, taxid, seven ranks, source, fate of records with their header taken apart."""
    return headers.parsed(df).select("name", "seqid", "taxid", *RANKS, "source", "fate")


def fate_summary(df: DataFrame, fates: list[str] | None = None) -> DataFrame:
    """fate, ord, removed, retained: a row 'input', then one for each fate in order (0 where none has it), last what is final.

    retained is what is left after a step. Rows with a null fate or one that is not listed count in the input only. One aggregation over df; the rest
    is over one row a fate.
    """
    order = [*(fates or FATES), FINAL]
    spark = df.sparkSession
    dim = spark.createDataFrame([(f, i) for i, f in enumerate(order, 1)], "fate string, ord int")
    per = df.groupBy("fate").agg(F.count(F.lit(1)).alias("n"))
    all_ = per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("input"))
    steps = dim.join(per, "fate", "left").withColumn("n", F.coalesce("n", F.lit(0))).join(F.broadcast(all_))
    before = F.coalesce(F.sum("n").over(W.orderBy("ord").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    last = F.col("fate") == FINAL
    rows = steps.select("fate", "ord", F.when(last, 0).otherwise(F.col("n")).alias("removed"), F.when(last, F.col("n")).otherwise(F.col("input") - before - F.col("n")).alias("retained"))
    first = all_.select(F.lit("input").alias("fate"), F.lit(0).alias("ord"), F.lit(0).cast("bigint").alias("removed"), F.col("input").alias("retained"))
    return first.unionByName(rows)


def taxa_summary(df: DataFrame) -> DataFrame:
    """step and the number of distinct values, null as one, of each rank: of all records ('input') and of each fate.

    Distinct (fate, rank, value) rows are found first, so a count never gathers the values of a step in one task.
    """
    pairs = df.select("fate", F.explode(F.array(*[F.struct(F.lit(r).alias("rank"), F.col(r).alias("value")) for r in RANKS])).alias("p")).select("fate", "p.rank", "p.value").distinct()
    wide = [F.sum(F.when(F.col("rank") == r, F.col("n"))).alias(r) for r in RANKS]
    per = pairs.groupBy("fate", "rank").agg(F.count(F.lit(1)).alias("n")).groupBy("fate").agg(*wide).withColumnRenamed("fate", "step")
    whole = pairs.select("rank", "value").distinct().groupBy("rank").agg(F.count(F.lit(1)).alias("n")).agg(*wide)
    return whole.filter(f"{RANKS[0]} is not null").select(F.lit("input").alias("step"), *RANKS).unionByName(per.select("step", *RANKS))


def key_sequences(df: DataFrame, species: list[str]) -> DataFrame:
    """Records of the key species, with key: names (runs of blanks as one) meet species, digits meet 'NCBI:<digits>'."""
    ids = [s.strip() for s in species if s and s.strip()]
    keys = df.sparkSession.createDataFrame([(k, " ".join(k.split())) for k in dict.fromkeys(ids)] or [("", "")], "key string, value string").filter("key <> ''")
    digits = F.col("key").rlike(r"^\d+$")
    tax = keys.filter(digits).select("key", F.concat(F.lit("NCBI:"), "value").alias("_v"))
    name = keys.filter(~digits).select("key", F.col("value").alias("_v"))
    return df.join(F.broadcast(tax), F.col("taxid") == F.col("_v")).drop("_v").unionByName(df.join(F.broadcast(name), F.col("species") == F.col("_v")).drop("_v"))


def key_species_summary(df: DataFrame, species: list[str], fates: list[str] | None = None, zero_unless_final: bool = False) -> DataFrame:
    """key, ranks and one column of counts per fate for each key species and lineage; a species without records has null ranks and zeros.

    zero_unless_final gives zeros and null ranks also for species that have records but none in the final database.
    """
    order = [*(fates or FATES), FINAL]
    rows = key_sequences(df, species)
    wide = rows.groupBy("key", *RANKS).agg(*[F.count(F.when(F.col("fate") == f, 1)).alias(f) for f in order])
    if zero_unless_final:
        wide = wide.withColumn("_t", F.sum(FINAL).over(W.partitionBy("key"))).filter("_t > 0").drop("_t")
    ids = list(dict.fromkeys(s.strip() for s in species if s and s.strip()))
    all_ = df.sparkSession.createDataFrame([(k,) for k in ids] or [("",)], "key string").filter("key <> ''")
    out = all_.join(wide, "key", "left")
    return out.withColumn("species", F.coalesce("species", F.when(~F.col("key").rlike(r"^\d+$"), F.regexp_replace("key", " +", " ")).otherwise(F.col("key")))).fillna(0, order)


def final_names(df: DataFrame, species: list[str]) -> DataFrame:
    """key, name (with a root) of the final sequences of the key species."""
    return key_sequences(df, species).filter(F.col("fate") == FINAL).select("key", headers.with_root(F.col("name")).alias("name"))


def core_sequences(df: DataFrame, length: str = "length", key: str = "rid", total: int = 1000, longest: int = 200) -> DataFrame:
    """df with is_core: the ceil(total / families) longest records of each family that are no shorter than the median, and the `longest` longest of all.

    Equal lengths go by the least key. A family's records are ranked by salted partial tops first; the top of all is a heap per partition; the
    median comes from counts of lengths. So a family with a third of the records is not sorted in one task.
    """
    rows = df.select(F.col(key).alias("_k"), F.col("family").alias("_f"), F.col(length).alias("_l"))
    n = rows.agg(F.count_distinct(F.coalesce("_f", F.lit("")))).first()[0]
    each = -(-total // max(n, 1))
    hist = rows.filter("_l is not null").groupBy("_l").agg(F.count(F.lit(1)).alias("c"))
    median = hist.agg(F.percentile("_l", 0.5, F.col("c")).alias("m")).first().m
    order = [F.desc("_l"), "_k"]
    part = rows.withColumn("_s", F.pmod(F.xxhash64(F.col("_k").cast("string")), F.lit(64))).withColumn("_r", F.row_number().over(W.partitionBy("_f", "_s").orderBy(*order))).filter(F.col("_r") <= each)
    top = part.withColumn("_r", F.row_number().over(W.partitionBy("_f").orderBy(*order))).filter((F.col("_r") <= each) & (F.col("_l") >= F.lit(median)))
    core = top.select("_k").unionByName(rows.orderBy(*order).limit(longest).select("_k")).distinct().withColumn("is_core", F.lit(True))
    return df.join(core, df[key] == core["_k"], "left").drop("_k").withColumn("is_core", F.coalesce("is_core", F.lit(False)))


def summarise(df: DataFrame, length: str = "length", taxid: str = "taxid", by: list[str] | None = None) -> DataFrame:
    """nseqs, nspecies (distinct taxids), mean_length and the quantiles q0, q25, q50, q75, q100 of the lengths, of all records or by columns.

    Quantiles interpolate. They come from counts of the lengths, so only distinct lengths are gathered.
    """
    by = by or []
    hist = df.groupBy(*by, F.col(length).alias("_l")).agg(F.count(F.lit(1)).alias("_c"))
    taxa = df.select(*by, F.col(taxid).alias("_t")).distinct().groupBy(*by).agg(F.count("_t").alias("nspecies"))
    got = hist.groupBy(*by).agg(F.sum("_c").alias("nseqs"), (F.sum(F.col("_l") * F.col("_c")) / F.sum(F.when(F.col("_l").isNotNull(), F.col("_c")))).alias("mean_length"), *[F.percentile("_l", q / 100, F.col("_c")).alias(f"q{q}") for q in (0, 25, 50, 75, 100)])
    on = reduce(Column.__and__, [got[b].eqNullSafe(taxa[b]) for b in by], F.lit(True))
    joined = got.join(taxa, on) if by else got.join(F.broadcast(taxa))
    return joined.select(*[got[b] for b in by], "nseqs", "nspecies", F.round("mean_length", 6).alias("mean_length"), *[f"q{q}" for q in (0, 25, 50, 75, 100)])


def merged_origins(df: DataFrame, origins: DataFrame) -> DataFrame:
    """df with origin: all origins of a record's taxid, sorted and joined by '/'. origins: seqid (unique), origin. Each taxid's origins are few."""
    tagged = df.join(origins, "seqid", "left")
    per = tagged.filter("origin is not null").select("taxid", "origin").distinct().groupBy("taxid").agg(F.array_join(F.array_sort(F.collect_list("origin")), "/").alias("origin"))
    return df.join(per, "taxid", "left").withColumn("origin", F.coalesce("origin", F.lit("")))


def top_hits(hits: DataFrame, identity: float = 95.0, coverage: float = 95.0, ties: str = "all") -> DataFrame:
    """Best subjects of each query from alignment hits: qseqid, sseqid, stitle, pident, qcovs, max_score, total_score, evalue.

    hits: qseqid, sseqid, stitle, pident, length, qstart, qend, qlen, slen, qcovs, bitscore, evalue. Identity is over the full length:
    pident * length / (length - (qend - qstart + 1) + the shorter of qlen and slen). Of hits of a pair that overlap on the query only those stay that are the best of an
    overlapping two (by bitscore, pident, qcovs); the rest adds up. Pairs above both thresholds are ranked by total score, best score, coverage and identity; equals all
    stay, or with ties='first' the one with the greatest subject.
    """
    align = F.col("qend") - F.col("qstart") + 1
    df = hits.withColumn("full", F.col("pident") * F.col("length") / (F.col("length") - align + F.least("qlen", "slen")))
    pair = ["qseqid", "sseqid", "stitle"]
    best = F.max(F.struct("bitscore", "pident", "qcovs", (-F.col("evalue")).alias("e"))).alias("m")
    df = df.groupBy(*pair, "qstart", "qend", "length", "full").agg(best).select(*pair, "qstart", "qend", "full", "m.bitscore", "m.pident", "m.qcovs", (-F.col("m.e")).alias("evalue"), F.xxhash64("qstart", "qend", "length", "full").alias("_id"))
    a, b = df.alias("a"), df.select(*pair, F.col("_id").alias("o_id"), F.col("qstart").alias("o_s"), F.col("qend").alias("o_e"), F.col("bitscore").alias("o_b"), F.col("pident").alias("o_p"), F.col("qcovs").alias("o_q")).alias("b")
    met = a.join(b, pair).filter("a._id <> b.o_id and a.qstart <= b.o_e and b.o_s <= a.qend")
    better = F.struct("a.bitscore", "a.pident", "a.qcovs") >= F.struct("b.o_b", "b.o_p", "b.o_q")
    judged = met.groupBy(*pair, "_id").agg(F.max(better).alias("wins"))
    has = judged.select(*pair).distinct().withColumn("_any", F.lit(True))
    kept = df.join(judged, [*pair, "_id"], "left").join(has, pair, "left").filter("_any is null or wins")
    per = kept.groupBy(*pair).agg(F.sum("full").alias("pident"), F.max("qcovs").alias("qcovs"), F.max("bitscore").alias("max_score"), F.sum("bitscore").alias("total_score"), F.min("evalue").alias("evalue"))
    per = per.withColumn("pident", F.round("pident", 6)).filter((F.col("pident") > identity) & (F.col("qcovs") > coverage))
    best = per.groupBy("qseqid").agg(F.max(F.struct("total_score", "max_score", "qcovs", "pident", *(["sseqid", "stitle"] if ties == "first" else []))).alias("_b"))
    same = reduce(Column.__and__, [F.col(c) == F.col(f"_b.{c}") for c in ["total_score", "max_score", "qcovs", "pident"] + (["sseqid", "stitle"] if ties == "first" else [])])
    return per.join(best, "qseqid").filter(same).drop("_b")


def assigned_species(top: DataFrame, genus: str = "genus", species: str = "species") -> DataFrame:
    """qseqid, genus, binomial of top_hits() with taxa: the genus and all its epithets, sorted and joined by '/'; null binomial where several genera tie."""
    one = top.filter(F.col(species).isNotNull()).select("qseqid", F.col(genus).alias("genus"), F.regexp_extract(species, r"([^ ]*)$", 1).alias("spp")).distinct()
    per = one.groupBy("qseqid").agg(F.array_join(F.array_sort(F.collect_set("spp")), "/").alias("spp"), F.count_distinct("genus").alias("n"))
    genera = one.select("qseqid", "genus").distinct()
    return genera.join(per, "qseqid").select("qseqid", "genus", F.when(F.col("n") == 1, F.concat_ws(" ", "genus", "spp")).alias("binomial"))
