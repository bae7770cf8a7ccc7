"""From source rows to harmonised records: targets, synonyms, matching to the reference taxonomy, headers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.functions import headers, seq
from curaspark.functions.text import RANKS
from curaspark.operators.taxonomy import COLUMN_OF, UPWARD
from curaspark.session import BROADCAST_ROWS, at_most, lookup_join

# Run sites and identification methods that mark a row as taken from elsewhere.
MINED = "GenBank|NCBI"
BY_SEQUENCE = "BIN|(B|b)arcode|DNA|BOLD|(T|t)ree|(S|s)equence"
DOWNWARD = list(reversed(UPWARD))


def on_target(df: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows of df with one of the targets (name, rank) at the target's rank. A row that meets several targets comes once."""
    for rank in DOWNWARD:
        names = targets.filter(F.col("rank") == rank).select(F.col("name").alias("_t")).filter("_t is not null").distinct().withColumn(f"_on_{rank}", F.lit(True))
        df = lookup_join(df.withColumn("_t", F.col(COLUMN_OF[rank])), names, "_t", "left").drop("_t")
    marks = [f"_on_{r}" for r in DOWNWARD]
    return df.filter(reduce(Column.__or__, [F.coalesce(m, F.lit(False)) for m in marks])).drop(*marks)


def extract_bold(bold: DataFrame, targets: DataFrame, marker: str = "COI-5P", idmethod_filter: bool = False, min_length: int = 100, max_length: int = 2000) -> DataFrame:
    """processid, bold_taxid, seven ranks, nuc (without gaps) of the distinct rows of a marker that are on target.

    Rows without sequence or without run site are left out, as are those mined from other archives and, with idmethod_filter, those identified by their
    sequence (or by an unknown method). The length that counts is the given nuc_basecount, bounds included.
    """
    df = bold.filter((F.col("marker_code") == marker) & F.col("nuc").isNotNull() & ~F.col("sequence_run_site").rlike(MINED))
    if idmethod_filter:
        df = df.filter(~F.col("identification_method").rlike(BY_SEQUENCE))
    df = df.filter(F.col("nuc_basecount").cast("int").between(min_length, max_length))
    return on_target(df, targets).select("processid", "bold_taxid", *RANKS, F.translate("nuc", "-", "").alias("nuc")).distinct()


def resolve_synonyms(df: DataFrame, synonyms: DataFrame) -> DataFrame:
    """df with synonyms at the seven ranks replaced from the kingdom down, each below its already replaced parents; <rank>_old holds what was replaced.

    synonyms: synonym, tax_name, rank, parent_taxon, grandparent_taxon. A name is replaced where parent and, from the class down, grandparent agree
    (null agrees with null). Of several names for the same synonym and parents the first in order counts, so rows never multiply. 'None' is null.
    Where a species does not begin with its genus, the first word of the species becomes the genus and genus_old is the former one.
    """
    df = df.withColumns({c: F.when(F.col(c) != "None", F.col(c)) for c in RANKS})
    small = at_most(synonyms, BROADCAST_ROWS)
    for i, rank in enumerate(DOWNWARD):
        c, keys = RANKS[i], ["synonym"] + ["parent_taxon"] * (i >= 1) + ["grandparent_taxon"] * (i >= 2)
        one = synonyms.filter((F.col("rank") == rank) & F.col("synonym").isNotNull()).groupBy(*keys).agg(F.min("tax_name").alias("_new")).filter("_new is not null")
        one = one.select(*[F.col(k).alias(f"_{k}") for k in keys], "_new")
        on = F.col(c) == F.col("_synonym")
        for k, up in zip(keys[1:], (RANKS[i - 1], RANKS[i - 2])):
            on = on & F.col(up).eqNullSafe(F.col(f"_{k}"))
        df = df.join(F.broadcast(one) if small else one, on, "left").withColumn(f"{c}_old", F.when(F.col("_new").isNotNull(), F.col(c))).withColumn(c, F.coalesce("_new", c)).drop("_new", *[f"_{k}" for k in keys])
    astray = F.col("species").isNotNull() & ~F.startswith("species", "genus")
    first = F.regexp_extract("species", r"^\w+(?= )", 0)
    old = F.when(astray, F.col("genus"))
    return df.withColumn("genus_old", old).withColumn("genus", F.when(astray, F.when(first != "", first)).otherwise(F.col("genus")))


def synonym_changes(resolved: DataFrame) -> DataFrame:
    """The distinct lineages, new and old, of resolve_synonyms()."""
    return resolved.select(*RANKS, *[f"{c}_old" for c in RANKS]).distinct()


def identified(df: DataFrame) -> DataFrame:
    """df with identification and its rank, the lowest rank that is filled (species where none is), and those of its parent and grandparent."""
    lowest = F.coalesce(*[F.when(F.col(COLUMN_OF[r]).isNotNull(), F.lit(r)) for r in UPWARD], F.lit("species"))
    up = F.create_map(*[F.lit(x) for a, b in zip(UPWARD, UPWARD[1:]) for x in (a, b)])
    value = F.create_map(*[x for r in UPWARD for x in (F.lit(r), F.col(COLUMN_OF[r]))])
    df = df.withColumn("identification_rank", lowest).withColumn("parent_rank", F.element_at(up, F.col("identification_rank")))
    df = df.withColumn("grandparent_rank", F.element_at(up, F.col("parent_rank")))
    return df.withColumns({"identification": F.element_at(value, F.col("identification_rank")), "parent": F.element_at(value, F.col("parent_rank")), "grandparent": F.element_at(value, F.col("grandparent_rank"))})


def match_lineage(df: DataFrame, parents: DataFrame) -> DataFrame:
    """identified() rows joined to taxonomy.lineage_parents: tax_id, and the taxonomy's seven ranks where it matches.

    Rank and name of the identification must be equal, those of parent and grandparent equal or both null. Of several taxa the smallest tax_id counts. taxid is
    'NCBI:<tax_id>' for a match, else 'BOLD:<bold_taxid>' with the row's own ranks, null ranks as 'Unclassified'.
    """
    keys = {"rank": "identification_rank", "tax_name": "identification", "parent_taxon": "parent", "grandparent_taxon": "grandparent"}
    one = parents.groupBy(*keys).agg(F.min(F.struct("tax_id", *RANKS)).alias("_m")).select(*[F.col(k).alias(f"_{k}") for k in keys], "_m")
    on = reduce(Column.__and__, [F.col(v) == F.col(f"_{k}") if k in ("rank", "tax_name") else F.col(v).eqNullSafe(F.col(f"_{k}")) for k, v in keys.items()])
    got = df.join(one, on, "left").withColumn("tax_id", F.col("_m.tax_id"))
    ranks = {c: F.coalesce(F.when(F.col("_m").isNotNull(), F.col(f"_m.{c}")).otherwise(F.col(c)), F.lit("Unclassified")) for c in RANKS}
    taxid = F.when(F.col("_m").isNotNull(), F.concat(F.lit("NCBI:"), F.col("tax_id").cast("string"))).otherwise(F.concat(F.lit("BOLD:"), F.coalesce(F.col("bold_taxid").cast("string"), F.lit("NA"))))
    return got.withColumns(ranks | {"taxid": taxid}).drop("_m", *[f"_{k}" for k in keys])


def matching_taxids(matched: DataFrame) -> DataFrame:
    """taxon_name, bold_taxid, ncbi_taxid, rank: the distinct pairs of ids of the matched rows."""
    return matched.filter("tax_id is not null").select(F.col("identification").alias("taxon_name"), "bold_taxid", F.col("tax_id").alias("ncbi_taxid"), F.col("identification_rank").alias("rank")).distinct()


def placeholders(df: DataFrame, placeholder: bool = True, digits: bool = True) -> DataFrame:
    """df with a species that has a dot, and any rank that has a digit, as 'Unclassified'."""
    if placeholder:
        df = df.withColumn("species", F.when(F.contains("species", F.lit(".")), "Unclassified").otherwise(F.col("species")))
    if digits:
        df = df.withColumns({c: F.when(F.col(c).rlike(r"\d"), "Unclassified").otherwise(F.col(c)) for c in RANKS})
    return df


def named(df: DataFrame, acc: str, taxid: str) -> DataFrame:
    """df with name, the header of its records."""
    return df.withColumn("name", headers.header(F.col(acc), F.col(taxid), [F.col(c) for c in RANKS]))


def harmonise_bold(bold_targets: DataFrame, synonyms: DataFrame, parents: DataFrame, placeholder: bool = True, digits: bool = True) -> DataFrame:
    """name, seqid, taxid, seven ranks, seq of extracted rows: synonyms resolved, matched to the taxonomy, placeholders out, header made."""
    df = placeholders(match_lineage(identified(resolve_synonyms(bold_targets, synonyms)), parents), placeholder, digits)
    return named(df, "processid", "taxid").select("name", F.col("processid").alias("seqid"), "taxid", *RANKS, F.col("nuc").alias("seq"))


def join_ranked_lineage(df: DataFrame, taxid: str, filled_lineage: DataFrame) -> DataFrame:
    """df with the seven ranks of taxonomy.own_rank_filled for its integer taxid, 'Unclassified' where there is none. Rank columns of df are replaced."""
    lineage = filled_lineage.select(F.col("tax_id").alias("_t"), *RANKS)
    out = df.drop(*RANKS).withColumn("_t", F.col(taxid).cast("int")).join(lineage, "_t", "left").drop("_t")
    return out.withColumns({c: F.coalesce(c, F.lit("Unclassified")) for c in RANKS})


def import_internal(records: DataFrame, min_length: int = 100, max_length: int = 2000) -> DataFrame:
    """name, seqid, taxid, ranks, seq of a user's own records (name, seq). Raises on a header of wrong form or a repeated seqid.

    Gaps go; ids without 'INTERNAL:' or 'NCBI:' get 'INTERNAL:'; sequences outside the bounds (included) are left out.
    """
    form = r"^[A-Za-z0-9_\-.]+\|[A-Za-z0-9:_\-.]+;\w+;\w+;\w+;\w+;\w+;\w+;[\w .\-]+$"
    ok = F.assert_true(F.col("name").rlike(form), F.concat(F.lit("header of wrong form: "), F.coalesce("name", F.lit("null"))))
    df = records.filter(ok.isNull()).withColumn("name", F.regexp_replace("name", r"\|(?!INTERNAL:|NCBI:)", "|INTERNAL:")).withColumn("seq", seq.dealigned(F.col("seq")))
    df = headers.parsed(df)
    again = df.groupBy("seqid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seqid").limit(5).collect()
    if again:
        raise ValueError(f"repeated seqid: {', '.join(r.seqid for r in again)}")
    return df.filter(F.length("seq").between(min_length, max_length)).select("name", "seqid", "taxid", *RANKS, "seq")


def combine_sources(**sources: DataFrame) -> DataFrame:
    """All rows of the sources, each with its source's name in `source`; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("source", F.lit(k)) for k, df in sources.items()])


def source_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("n_seqs"))
