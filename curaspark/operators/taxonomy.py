"""Taxonomy tables: names with ranks, synonyms, ranked lineages, parents, genetic codes, trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.functions.text import RANKS, filled, trimmed
from curaspark.operators import hierarchy as H
from curaspark.session import lookup_join

# The ranks from species upward.
UPWARD = ["species", "genus", "family", "order", "class", "phylum", "kingdom"]
COLUMN_OF = {"order": "order_name", "class": "class_name"} | {r: r for r in UPWARD if r not in ("order", "class")}
RANK_OF = {v: k for k, v in COLUMN_OF.items()}


def latest(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """tax_id and columns of each tax_id's row with the latest loaded_at (null last); of equal ones the greatest values. No null tax_id."""
    best = F.max(F.struct("loaded_at", *columns)).alias("b")
    return nodes.filter("tax_id is not null").groupBy("tax_id").agg(best).select("tax_id", *[F.col(f"b.{c}").alias(c) for c in columns])


def node_ranks(nodes: DataFrame) -> DataFrame:
    """tax_id, rank of the latest rows; ranks trimmed, in lower case, null where empty."""
    rank = F.lower(trimmed(F.col("rank")))
    return latest(nodes, ["rank"]).select("tax_id", F.when(rank != "", rank).alias("rank"))


def tax_names(names: DataFrame) -> DataFrame:
    """tax_id, tax_name: the scientific name, of several the first in order. Nodes without one are left out."""
    return names.filter("name_class = 'scientific name' and tax_id is not null and name_txt is not null").groupBy("tax_id").agg(F.min("name_txt").alias("tax_name"))


def taxid_name_rank(taxnames: DataFrame, ranks: DataFrame) -> DataFrame:
    """tax_id, tax_name, rank; a name without node keeps a null rank."""
    return taxnames.join(ranks, "tax_id", "left").select("tax_id", "tax_name", "rank")


def synonyms(names: DataFrame, tnr: DataFrame) -> DataFrame:
    """tax_id, name_txt, unique_name, name_class of synonyms with the tax_name and rank they stand for."""
    return names.filter("name_class = 'synonym'").join(tnr, "tax_id", "left")


def synonyms_with_parents(syn: DataFrame, parents: DataFrame) -> DataFrame:
    """synonym, tax_name, rank, parent_taxon, grandparent_taxon of the synonyms at one of the seven ranks, for resolving names below them."""
    return syn.filter(F.col("rank").isin(UPWARD)).join(parents.select("tax_id", "parent_taxon", "grandparent_taxon"), "tax_id", "left").select(F.col("name_txt").alias("synonym"), "tax_name", "rank", "parent_taxon", "grandparent_taxon")


def synonym_names(names: DataFrame) -> DataFrame:
    """Other names of taxa that have a synonym: synonym, synonym_taxid, tax_name (the scientific one)."""
    other = names.filter("name_class <> 'scientific name'").join(names.filter("name_class = 'synonym'").select("tax_id").distinct(), "tax_id", "left_semi")
    return other.join(tax_names(names), "tax_id").select(F.col("name_txt").alias("synonym"), F.col("tax_id").alias("synonym_taxid"), "tax_name")


def resolve_names(df: DataFrame, column: str, syn: DataFrame) -> DataFrame:
    """df with a column's synonyms replaced by their names (synonym, tax_name; of several the first in order); other values stay."""
    one = syn.filter("synonym is not null").groupBy("synonym").agg(F.min("tax_name").alias("_name")).withColumnRenamed("synonym", "_key")
    return lookup_join(df.withColumn("_key", F.col(column)), one, "_key", "left").withColumn(column, F.coalesce("_name", column)).drop("_key", "_name").select(*df.columns)


def name_to_taxid(df: DataFrame, column: str, taxnames: DataFrame) -> DataFrame:
    """df with tax_id of the taxon that a column names; of several ids the smallest, null without one."""
    one = taxnames.groupBy(F.col("tax_name").alias("_key")).agg(F.min("tax_id").alias("tax_id"))
    return df.drop("tax_id").withColumn("_key", F.col(column)).join(one, "_key", "left").drop("_key")


def ranked_lineage(nodes: DataFrame, taxnames: DataFrame) -> DataFrame:
    """tax_id, tax_name and the names of its ancestors at the seven ranks, null where there is none; the taxon's own rank column is null.

    From the preorder sweep of operators.hierarchy, which carries the names, so no join meets a name that a third of all taxa have above
    them. Taxa on or below a cycle have no lineage and are left out; so are taxa without scientific name, which as ancestors are passed over.
    """
    last = H.latest_nodes(nodes)
    sizes, _ = H.subtree_sizes(last)
    ranges = H.preorder(last, sizes).join(taxnames.select(F.col("tax_id").cast("bigint").alias("id"), F.col("tax_name").alias("name")), "id", "left")
    tree = H.paths(ranges)
    above = F.slice(F.col("path_ranks"), F.lit(1), F.col("depth"))

    def at(rank: str) -> Column:
        place = F.array_position(above, rank)
        return F.when(place > 0, F.get("path_names", (place - 1).cast("int"))).alias(COLUMN_OF[rank])

    return tree.select(F.col("id").cast("int").alias("tax_id"), F.get("path_names", F.col("depth")).alias("tax_name"), *[at(r) for r in reversed(UPWARD)]).filter("tax_name is not null")


def own_rank_filled(ranked: DataFrame, tnr: DataFrame) -> DataFrame:
    """tax_id and seven ranks, that of the taxon itself filled with its own name. Where the rank is unknown (null) all seven are null."""
    df = ranked.join(tnr.select("tax_id", "tax_name", "rank"), ["tax_id", "tax_name"], "left")
    return df.select("tax_id", *[F.when(F.col("rank") == RANK_OF[c], F.col("tax_name")).when(F.col("rank").isNotNull(), F.col(c)).alias(c) for c in RANKS])


def lineage_parents(ranked: DataFrame, tnr: DataFrame) -> DataFrame:
    """Taxa at one of the seven ranks, none below a species: own rank filled, with parent and grandparent rank and name (null above a kingdom)."""
    df = ranked.filter("species is null").join(tnr.select("tax_id", "tax_name", "rank"), ["tax_id", "tax_name"], "left").filter(F.col("rank").isin(UPWARD))
    df = df.withColumns({c: F.when(F.col("rank") == RANK_OF[c], F.col("tax_name")).otherwise(F.col(c)) for c in RANKS})
    up = {a: b for a, b in zip(UPWARD, UPWARD[1:])}
    parent = F.create_map(*[F.lit(x) for kv in up.items() for x in kv])
    value = F.create_map(*[y for r in UPWARD for y in (F.lit(r), F.col(COLUMN_OF[r]))])
    df = df.withColumn("parent_rank", F.element_at(parent, F.col("rank")))
    df = df.withColumn("grandparent_rank", F.element_at(parent, F.col("parent_rank")))
    return df.withColumn("parent_taxon", F.element_at(value, F.col("parent_rank"))).withColumn("grandparent_taxon", F.element_at(value, F.col("grandparent_rank")))


def gencodes(ranked: DataFrame, nodes: DataFrame) -> DataFrame:
    """tax_id, tax_name, rank, seven ranks ('Unclassified' where null, runs of blanks as one, own rank filled) and the four genetic codes of taxa at one of the seven ranks."""
    codes = ["gencode", "mtgencode", "plgencode", "hdgencode"]
    last = latest(nodes, ["rank", *codes]).withColumn("rank", F.lower(trimmed(F.col("rank")))).filter(F.col("rank").isin(UPWARD))
    df = ranked.withColumns({c: F.regexp_replace(F.coalesce(c, F.lit("Unclassified")), " +", " ") for c in RANKS}).join(last, "tax_id")
    return df.select("tax_id", "tax_name", "rank", *[F.when(F.col("rank") == RANK_OF[c], F.col("tax_name")).otherwise(F.col(c)).alias(c) for c in RANKS], *codes)


def below(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """target (tax_id), tax_id of every taxon below the targets and the targets themselves, by their nested-set ranges. targets: tax_id."""
    tree = H.hierarchy(nodes)
    inside = H.descendants(tree, targets).select(F.col("tax_id").alias("target"), F.col("descendant").alias("tax_id"))
    return inside.unionByName(tree.join(targets.select("tax_id").distinct(), "tax_id", "left_semi").select(F.col("tax_id").alias("target"), "tax_id"))


#: Ranks of a target package below which names are looked up, from the highest.
TARGET_RANKS = ["kingdom", "phylum", "class", "order", "family", "subfamily", "tribe", "genus", "species"]
# Ranks from the highest, those between the target ranks included.
ALL_RANKS = ["superkingdom", "kingdom", "subkingdom", "superphylum", "phylum", "subphylum", "superclass", "class", "subclass", "infraclass", "cohort", "superorder", "order", "suborder", "infraorder", "parvorder", "superfamily", "family", "subfamily", "tribe", "subtribe", "genus", "subgenus", "species"]


def resolve_target(taxon: str, rank: str | None, nodes: DataFrame, names: DataFrame) -> tuple[int, str, str]:
    """(tax_id, scientific name, rank) of a target given as a tax id (digits) or a scientific name, at a rank if one is given.

    Raises where nothing or more than one taxon is meant, and where a tax id has another rank than the given one.
    """
    tnr = taxid_name_rank(tax_names(names), node_ranks(nodes))
    taxon = taxon.strip()
    if taxon.isdigit():
        got = tnr.filter(F.col("tax_id") == int(taxon)).limit(2).collect()
        if not got:
            raise ValueError(f"{taxon} is no tax id with a name")
        if rank and got[0]["rank"] != rank.lower():
            raise ValueError(f"tax id {taxon} is of rank {got[0]['rank']}, not {rank}")
    else:
        same = tnr.filter(F.col("tax_name") == taxon)
        got = (same.filter(F.col("rank") == rank.lower()) if rank else same).limit(2).collect()
        if not got:
            raise ValueError(f"no taxon is named {taxon}" + f" at rank {rank}" * bool(rank))
        if len(got) > 1:
            raise ValueError(f"{taxon} names several taxa; give a rank or a tax id")
    return got[0].tax_id, got[0].tax_name, got[0]["rank"]


def target_names(tax_id: int, name: str, rank: str, nodes: DataFrame, names: DataFrame) -> DataFrame:
    """name, rank to look a target up by: its name and synonyms where its rank is one of TARGET_RANKS, else the names and synonyms of all
    taxa below it at the next rank that is."""
    tnr = taxid_name_rank(tax_names(names), node_ranks(nodes))
    spark = nodes.sparkSession
    if rank in TARGET_RANKS:
        wanted = spark.createDataFrame([(tax_id,)], "tax_id int")
    else:
        if rank not in ALL_RANKS:
            raise ValueError(f"rank {rank} has no place among the known ranks")
        lower = [r for r in ALL_RANKS[ALL_RANKS.index(rank) + 1 :] if r in TARGET_RANKS]
        rank = lower[0]
        wanted = below(nodes, spark.createDataFrame([(tax_id,)], "tax_id int")).join(tnr.filter(F.col("rank") == rank).select("tax_id"), "tax_id", "left_semi").select("tax_id")
    own = tnr.join(wanted, "tax_id", "left_semi").select(F.col("tax_name").alias("name"))
    other = names.filter("name_class = 'synonym'").join(wanted, "tax_id", "left_semi").select(F.col("name_txt").alias("name"))
    return own.unionByName(other).distinct().withColumn("rank", F.lit(rank))


def filter_by_tax(df: DataFrame, rank: str, values: list[str]) -> DataFrame:
    """The rows of df whose rank column has one of the values."""
    wanted = df.sparkSession.createDataFrame([(v,) for v in dict.fromkeys(values)] or [(None,)], "_v string")
    return df.join(F.broadcast(wanted) if len(values) <= 200_000 else wanted, df[rank] == wanted["_v"], "left_semi")


def grafted(df: DataFrame, acc: str, ranks: list[str]) -> DataFrame:
    """newick: the tree of the lineages in df, down to the last of ranks, with the accessions grafted on as its tips (signs that Newick uses as '_').

    A taxon's tips are joined before the taxa are, so the text of a taxon is as long as what lies below it.
    """
    safe = lambda c: F.regexp_replace(c, r"[\s(),:;\[\]']+", "_")
    one = df.filter(F.col(acc).isNotNull()).select(*[safe(F.coalesce(filled(F.col(r)), F.lit("Unclassified"))).alias(r) for r in ranks], safe(F.col(acc)).alias("_a")).distinct()
    now = one.groupBy(*ranks).agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list("_a")), ","), F.lit(")")).alias("t"))
    for k in range(len(ranks), 0, -1):
        named = now.withColumn("s", F.struct(F.col(ranks[k - 1]).alias("a"), F.concat("t", F.col(ranks[k - 1])).alias("l")))
        joined = F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x.l), ",")
        now = named.groupBy(*ranks[: k - 1]).agg(F.concat(F.lit("("), joined, F.lit(")")).alias("t"))
    return now.filter("t <> '()'").select(F.concat("t", F.lit(";")).alias("newick"))


def newick(df: DataFrame, ranks: list[str], counts: bool = False) -> DataFrame:
    """The tree of the lineages in df as one Newick text (column newick): a row of text per kingdom joined in order of names.

    Levels are folded from the lowest rank upward, one aggregation each; a missing rank is 'Unclassified'. With counts every name ends in
    _n. The text of a level is as long as the names below it, so it is meant for taxa, not for records.
    """
    def safe(c: Column) -> Column:
        return F.regexp_replace(F.coalesce(c, F.lit("Unclassified")), r"[\s(),:;\[\]']+", "_")

    now = df.select(*[safe(F.coalesce(filled(F.col(r)), F.lit("Unclassified"))).alias(r) for r in ranks]).groupBy(*ranks).agg(F.count(F.lit(1)).alias("n")).withColumn("t", F.lit(""))
    for k in range(len(ranks), 0, -1):
        label = F.concat(F.when(F.col("t") != "", F.concat(F.lit("("), F.col("t"), F.lit(")"))).otherwise(""), F.col(ranks[k - 1]), F.concat(F.lit("_"), F.col("n").cast("string")) if counts else F.lit(""))
        now = now.withColumn("s", F.struct(F.col(ranks[k - 1]).alias("a"), label.alias("l"))).groupBy(*ranks[: k - 1]).agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x.l), ",").alias("t"), F.sum("n").alias("n"))
    return now.filter("n is not null").select(F.concat(F.lit("("), F.col("t"), F.lit(");")).alias("newick"))


def exclude_taxa(df: DataFrame, key: str, taxonomy: DataFrame, flag: Column) -> DataFrame:
    """df without the rows whose key names a taxon (tax_name of taxonomy) that bears a flag, such as unplaced or infraspecific. A name of several taxa goes only where all of them bear it."""
    bad = taxonomy.groupBy(F.col("tax_name").alias("_key")).agg(F.min(flag.cast("int")).alias("f")).filter("f = 1").select("_key")
    return df.join(bad, df[key] == bad["_key"], "left_anti")


def map_by_id_then_name(df: DataFrame, taxid: str, name: str, by_id: DataFrame, by_name: DataFrame, by_synonym: DataFrame) -> DataFrame:
    """df with mapped_name: of a synonym, else of the id, else of the name. by_id: id, mapped; by_name: name, mapped; by_synonym: synonym, mapped; of several the first in order."""
    def one(t: DataFrame, key: str, as_: str) -> DataFrame:
        return t.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_{as_}")).agg(F.min("mapped").alias(f"_m_{as_}"))

    out = df.withColumn("_id", F.col(taxid)).withColumn("_name", F.col(name)).withColumn("_syn", F.col(name))
    for t, key, as_ in ((by_id, "id", "id"), (by_name, "name", "name"), (by_synonym, "synonym", "syn")):
        out = out.join(one(t, key, as_), f"_{as_}", "left")
    return out.withColumn("mapped_name", F.coalesce("_m_syn", "_m_id", "_m_name")).select(*df.columns, "mapped_name")
