"""Genetic codes of records, reading frames and proteins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curaspark.functions import seq as Q
from curaspark.functions.text import RANKS

CODES = ["gencode", "mtgencode", "plgencode", "hdgencode"]
# Which code a kind of marker is read by.
CODE_OF_TYPE = {"nuclear": "gencode", "mitochondrial": "mtgencode", "plastid": "plgencode", "hydrogen": "hdgencode"}


def assign_codes(records: DataFrame, gencodes: DataFrame) -> DataFrame:
    """records (seqid, taxid, seven ranks) with the four genetic codes, rank_matches and match_tax_id.

    A taxid 'NCBI:<n>' takes the codes of that taxon; rank_matches is then null. Other records take those of the taxon with most equal ranks among taxa that
    share a rank with them: of equal ones the match over the lower rank, then the smallest tax_id. Taxa stand for
    all with the same codes and lineage down to the rank compared (the smallest tax_id does). 'Unclassified' and null are equal to nothing. Codes are null where fewer than two ranks agree.

    The matching runs over the distinct lineages, so records never multiply and a lineage of many records is matched once.
    """
    g = gencodes.select("tax_id", *[F.when(~F.lower(c).isin("unclassified"), F.col(c)).alias(c) for c in RANKS], *CODES)
    number = F.regexp_extract("taxid", r"^NCBI:(\d+)$", 1).try_cast("int")
    exact = g.groupBy(F.col("tax_id").alias("_n")).agg(*[F.max(c).alias(f"_x_{c}") for c in CODES])
    df = records.withColumn("_n", number).join(exact, "_n", "left")
    of = df.filter("_x_gencode is null").select(*RANKS).distinct()
    own = of.select(*[F.when(~F.lower(c).isin("unclassified"), F.col(c)).alias(f"s_{c}") for c in RANKS], F.struct(*RANKS).alias("lin"))
    found = []
    for level in range(len(RANKS), 0, -1):
        rank, group = RANKS[level - 1], RANKS[:level]
        one = g.filter(F.col(rank).isNotNull())
        if level < len(RANKS):
            one = one.groupBy(*group, *CODES).agg(F.min(F.struct("tax_id", *RANKS[level:])).alias("m")).select("m.*", *group, *CODES)
        same = sum((F.coalesce((F.col(c) == F.col(f"s_{c}")).cast("int"), F.lit(0)) for c in RANKS), F.lit(0))
        found.append(own.join(one, F.col(f"s_{rank}") == F.col(rank)).select("lin", same.alias("matches"), F.lit(level).alias("level"), "tax_id", *CODES))
    best = reduce(DataFrame.unionByName, found).groupBy("lin").agg(F.max(F.struct("matches", "level", (-F.col("tax_id")).alias("t"), *CODES)).alias("b"))
    best = best.filter("b.matches >= 2").select(*[F.col(f"lin.{c}").alias(f"_l_{c}") for c in RANKS], "b")
    on = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_l_{c}")) for c in RANKS])
    out = df.join(best, on, "left")
    no = F.col("_x_gencode").isNull()
    codes = {c: F.when(no, F.col(f"b.{c}")).otherwise(F.col(f"_x_{c}")) for c in CODES}
    out = out.withColumns(codes | {"rank_matches": F.when(no, F.col("b.matches")), "match_tax_id": F.when(no, -F.col("b.t")).otherwise(F.col("_n")).cast("int")})
    return out.select(*records.columns, *CODES, "rank_matches", "match_tax_id")


def modal_code(records: DataFrame, marker_type: str) -> int:
    """The one most frequent genetic code of a kind of marker; raises where several are equally frequent or there is none."""
    top = records.filter(F.col(CODE_OF_TYPE[marker_type]).isNotNull()).groupBy(F.col(CODE_OF_TYPE[marker_type]).alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "c").limit(2).collect()
    if not top or (len(top) > 1 and top[0].n == top[1].n):
        raise ValueError("there is no single most frequent genetic code")
    return int(top[0].c)


def frames(df: DataFrame, seq: str = "seq", code: int | str = 5) -> DataFrame:
    """Six rows per record: frame, frame_seq, protein, stops (positions of stop codons in the protein). Records with the same name and
    sequence come once if df has a name. code: a genetic code for all, or the column that holds each record's."""
    df = df.dropDuplicates(["name", seq]) if "name" in df.columns else df
    out = df.withColumn("_f", F.explode(Q.six_frames(F.upper(seq)))).withColumn("frame", F.col("_f.frame")).withColumn("frame_seq", F.col("_f.seq")).drop("_f")
    out = out.withColumn("protein", Q.translated(F.col("frame_seq"), code if isinstance(code, int) else F.col(code)))
    return out.withColumn("stops", Q.stop_positions(F.col("protein")))


def reading_frames(df: DataFrame, seq: str, code: int, try_rc: bool = True, draws: str = "majority") -> DataFrame:
    """df with reading_frame: the only frame without stop codon, forward first, then (negative) of the reverse complement.

    Null where no frame is free of stops; where several are (a draw), the most frequent frame of all records (smallest of equal ones) or, with draws='remove', null.
    A frame too short for a codon has no stop. Null sequences have no frame.
    """
    def pick(counts: list[Column], sign: int) -> Column:
        free = sum((F.when(c == 0, 1).otherwise(0) for c in counts), F.lit(0))
        only = F.coalesce(*[F.when(c == 0, F.lit(sign * i)) for i, c in enumerate(counts, 1)])
        return F.when(free == 1, only).when(free > 1, F.lit(0))

    out = df.withColumn("_s", Q.stop_counts(F.col(seq), code))
    at = [F.get("_s", F.lit(i)) for i in range(6)]
    forward, reverse = pick(at[:3], 1), pick(at[3:], -1)
    out = out.withColumn("reading_frame", F.coalesce(forward, reverse) if try_rc else forward).drop("_s")
    if draws == "remove":
        return out.withColumn("reading_frame", F.nullif("reading_frame", F.lit(0)))
    counts = out.filter("reading_frame is not null and reading_frame > 0").groupBy("reading_frame").agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.max_by("reading_frame", F.struct("n", -F.col("reading_frame"))).alias("f")).first().f
    return out.withColumn("reading_frame", F.when(F.col("reading_frame") == 0, F.lit(top).cast("int")).otherwise(F.col("reading_frame")))


def codon_filtered(df: DataFrame, seq: str, code: int, try_rc: bool = True, draws: str = "majority") -> DataFrame:
    """Records with a reading frame; those read backwards come as their reverse complement, the frame as a positive number."""
    out = reading_frames(df, seq, code, try_rc, draws).filter("reading_frame is not null")
    return out.withColumn(seq, F.when(F.col("reading_frame") < 0, Q.revcomp(F.col(seq))).otherwise(F.col(seq))).withColumn("reading_frame", F.abs("reading_frame"))


def codon_entropy(df: DataFrame, key: str, seq: str) -> DataFrame:
    """key, pos1, pos2, pos3: entropy (natural logarithm) of the bases at each codon position of a sequence that begins in frame. key is unique. Positions without base are null."""
    n = F.length(seq)
    at = df.filter(n > 0).select(key, F.posexplode(F.split(F.col(seq), "")).alias("i", "b")).withColumn("p", F.col("i") % 3 + 1)
    shares = at.groupBy(key, "p", "b").agg(F.count(F.lit(1)).alias("n")).withColumn("s", F.col("n") / F.sum("n").over(W.partitionBy(key, "p")))
    out = shares.groupBy(key).agg(*[F.sum(F.when(F.col("p") == p, -F.col("s") * F.ln("s"))).alias(f"pos{p}") for p in (1, 2, 3)])
    return out.select(key, *[F.round(F.col(f"pos{p}") + 0.0, 9).alias(f"pos{p}") for p in (1, 2, 3)])


def alignment_entropy(df: DataFrame, seq: str, max_gaps: float = 0.2, count_gaps: bool = False, alphabet: str = "ACGT") -> DataFrame:
    """pos (from 1), counts of each letter, bases, prop_gaps, ent of each column of an alignment; ent is null above max_gaps. Other signs than the alphabet's and '-' count as bases only in `bases`."""
    if not 0 <= max_gaps <= 1:
        raise ValueError("max_gaps lies between 0 and 1")
    at = df.filter(F.col(seq).isNotNull()).select(F.posexplode(F.split(F.upper(seq), "")).alias("pos", "b"))
    per = at.groupBy("pos").agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col("b") == a, 1)).alias(f"n_{a if a != '-' else 'gap'}") for a in alphabet + "-"])
    letters = [f"n_{a}" for a in alphabet] + ["n_gap"] * count_gaps
    total = sum((F.col(c) for c in letters), F.lit(0))
    ent = sum((F.when(F.col(c) > 0, -(F.col(c) / total) * F.ln(F.col(c) / total)).otherwise(0.0) for c in letters), F.lit(0.0))
    share = F.col("n_gap") / F.col("n")
    return per.select((F.col("pos") + 1).alias("pos"), *[c for c in per.columns if c.startswith("n_")], (F.col("n") - F.col("n_gap")).alias("bases"), share.alias("prop_gaps"), F.when((share <= max_gaps) & (total > 0), F.round(ent, 9)).alias("ent"))
