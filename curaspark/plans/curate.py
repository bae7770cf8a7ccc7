"""The whole run: records of the sources through all filters to the final database and its reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.config import Params, marker
from curaspark.functions import seq as Q
from curaspark.functions.text import RANKS
from curaspark.operators import alignment, classifier, filters, ingest, primers, profiles, reporting, similarity, taxonomy, translation
from curaspark.operators.profiles import Profile
from curaspark.session import as_table, lookup_join
from curaspark.sources import sinks
from curaspark.sources import text as T
from curaspark.sources.sinks import format_output


@dataclass
class Result:
    records: DataFrame  # every input record with its fate
    final: DataFrame  # name, seq as they go out
    fate_summary: DataFrame
    taxa_summary: DataFrame
    source_counts: DataFrame


def with_ids(df: DataFrame) -> DataFrame:
    """df with ord, a number that rises with the order of sources and their rows, and a unique rid: source, accession, a hash of header and sequence, and that number. Written as a table, so ids stay as they are however often a stage runs."""
    h = F.hex(F.xxhash64(*[F.coalesce(c, F.lit("")) for c in ("source", "name", "seq")]))
    return as_table(df.withColumn("ord", F.monotonically_increasing_id()).withColumn("rid", F.concat_ws("|", F.coalesce("source", F.lit("")), F.coalesce("seqid", F.lit("")), h, F.hex("ord"))))


def finished(df: DataFrame) -> DataFrame:
    """df with the fate of the survivors set to the final database."""
    return df.withColumn("fate", F.coalesce("fate", F.lit(filters.FINAL)))


def limits(p: Params) -> dict:
    return {"max_evalue": p.phmm_max_evalue, "min_score": p.phmm_min_score, "min_acc": p.phmm_min_acc, "max_gap": p.phmm_max_gap, "min_cov": p.phmm_min_cov, "min_length": p.phmm_min_length, "max_hits": p.phmm_max_hits}


def model_filters(df: DataFrame, p: Params, gencodes: DataFrame | None, profile: Profile, amplicon: tuple[Profile, dict] | None) -> DataFrame:
    """df after the filters by the full and the amplicon's model, with hit_protein."""
    size = df.count()
    live = filters.alive(df)
    if gencodes is not None:
        column = translation.CODE_OF_TYPE[marker(p.marker)["type"]]
        coded = translation.assign_codes(live.select("rid", "taxid", *RANKS), gencodes).select("rid", F.coalesce(F.col(column).cast("int"), F.col("gencode").cast("int"), F.lit(p.default_code)).alias("code"))
    else:
        coded = live.select("rid", F.lit(p.default_code).alias("code"))
    frames = translation.frames(live.select("rid", "seq").join(coded, "rid"), "seq", "code").select("rid", "frame", "protein", "stops")
    hits = as_table(profiles.search(frames.withColumn("searched", F.translate("protein", "*", "X")), "searched", profile, size))
    df = as_table(profiles.filter_phmm_full(df, hits, "rid", **limits(p)))
    if amplicon is None:
        return df
    model, info = amplicon
    found = profiles.search(filters.alive(df).select("rid", F.lit(1).alias("frame"), F.length("seq").alias("bases"), F.translate("hit_protein", "*", "X").alias("protein")), "protein", model, size)
    return as_table(profiles.filter_phmm_amplicon(df, found, "rid", trim=p.trim_to_amplicon, primer_info=info, remove_primers=p.remove_primers, min_cov=p.amplicon_min_cov, min_length=p.amplicon_min_length))


def curate(sources: dict[str, DataFrame], params: Params | None = None, gencodes: DataFrame | None = None, profile: Profile | None = None, amplicon: tuple[Profile, dict] | None = None) -> Result:
    """Run all stages over records (name, seqid, taxid, seven ranks, seq) of the sources, by name.

    Every record keeps a row; the first stage that removes it is its fate. Without profile the model filters are passed over and there is no filter of distant
    sequences; with one, gencodes (taxonomy.gencodes) give each record's genetic code. Of equal headers the first record in the order of sources and
    files stays. With aligned_output the final sequences are aligned with each other, the core sequences fixing the columns. Lineage is cut after the model filters and after the clusters.
    """
    p = params or Params()
    df = with_ids(ingest.combine_sources(**sources))
    df = ingest.placeholders(df, p.placeholder_as_unclassified, p.digits_as_unclassified)
    df = filters.filter_unclassified(df, p.remove_unclassified)
    if profile is not None:
        df = model_filters(df, p, gencodes, profile, amplicon)
    df = filters.filter_duplicates(df, "name", ["ord"])
    if p.remove_ambiguous:
        df = filters.filter_ambiguous(df)
    df = as_table(df)
    clusters = similarity.clusters(filters.alive(df), "rid", "seq", p.cluster_threshold).select(F.col("representative").alias("cluster"), F.col("member").alias("rid"))
    tagged = filters.filter_tax_outliers(df.withColumnRenamed("seqid", "_seqid").withColumnRenamed("rid", "seqid"), clusters.withColumnRenamed("rid", "seqid"), p.cluster_rank, p.cluster_confidence)
    df = as_table(tagged.withColumnRenamed("seqid", "rid").withColumnRenamed("_seqid", "seqid"))
    df = as_table(filters.filter_redundant(df))
    if profile is not None:
        df = profiles.align_to_profile(df, "hit_protein", "seq", profile)
        df = as_table(filters.filter_seq_outliers(df, threshold=p.dist_threshold)).drop("aligned")
    df = filters.select_final(df, p.max_group_size, p.selection_method, seed=p.seed)
    df = as_table(finished(df.drop("copies", "hit_protein")))
    last = df.filter(F.col("fate") == filters.FINAL).withColumn("seq", Q.clean_dna(F.col("seq")))
    if p.aligned_output:
        core = reporting.core_sequences(last.withColumn("length", F.length("seq")), key="rid")
        last = alignment.star_alignment(core, "rid", "seq", "is_core").withColumn("seq", F.col("aligned"))
    return Result(df, format_output(last, p.add_root, p.aligned_output), reporting.fate_summary(df), reporting.taxa_summary(df), ingest.source_counts(df))


@dataclass
class Taxonomy:
    """Tables of a taxonomy dump that a run reads."""

    nodes: DataFrame
    names: DataFrame
    ranked: DataFrame
    filled: DataFrame
    parents: DataFrame
    synonyms: DataFrame
    gencodes: DataFrame


def read_taxonomy(nodes: DataFrame, names: DataFrame) -> Taxonomy:
    """nodes and names as sources.text reads them; a loaded_at of its own is added where nodes has none."""
    nodes = nodes if "loaded_at" in nodes.columns else nodes.withColumn("loaded_at", F.lit(None).cast("timestamp"))
    taxnames = taxonomy.tax_names(names)
    tnr = as_table(taxonomy.taxid_name_rank(taxnames, taxonomy.node_ranks(nodes)))
    ranked = as_table(taxonomy.ranked_lineage(nodes, taxnames))
    parents = as_table(taxonomy.lineage_parents(ranked, tnr))
    synonyms = as_table(taxonomy.synonyms_with_parents(taxonomy.synonyms(names, tnr), parents))
    return Taxonomy(nodes, names, ranked, as_table(taxonomy.own_rank_filled(ranked, tnr)), parents, synonyms, as_table(taxonomy.gencodes(ranked, nodes)))


def run(spark: SparkSession, inputs: dict[str, str], params: Params, out: str | None = None) -> Result:
    """A whole run from files. inputs, all but nodes and names optional: nodes, names (dumps), bold (package), genbank, mito, genome (flat files), internal (FASTA), profile
    (model), seed (its alignment), by path.

    The target (target_taxon, target_rank) is resolved in the dump; without one all records count. Records of flat files are those of taxa below the target, within
    the bounds of length; those of the package are on target by name. Both primers with a seed give the amplicon's model. Where `out` is a path the final sequences
    (compressed with compressed_output), the records, the reports, those of key_species, and with train_idtaxa a classifier, are written there.
    """
    p, mark = params, marker(params.marker)
    tax = read_taxonomy(T.read_nodes(spark, inputs["nodes"]), T.read_names(spark, inputs["names"]))
    below = targets = code = None
    if p.target_taxon:
        tax_id, name, rank = taxonomy.resolve_target(p.target_taxon, p.target_rank, tax.nodes, tax.names)
        targets = as_table(taxonomy.target_names(tax_id, name, rank, tax.nodes, tax.names))
        below = as_table(taxonomy.below(tax.nodes, spark.createDataFrame([(tax_id,)], "tax_id int")).select("tax_id"))
    sources = {}
    if "bold" in inputs:
        package = T.read_bold(spark, T.find_bold(spark, inputs["bold"]))
        if targets is None:
            targets = as_table(reduce(DataFrame.unionByName, [package.select(F.col(taxonomy.COLUMN_OF[r]).alias("name"), F.lit(r).alias("rank")) for r in taxonomy.UPWARD]).filter("name is not null").distinct())
        on = ingest.extract_bold(package, targets, mark["bold_code"], p.bold_idmethod_filter, p.min_length_input, p.max_length_input)
        sources["bold"] = ingest.harmonise_bold(on, tax.synonyms, tax.parents, p.placeholder_as_unclassified, p.digits_as_unclassified)
    for kind in ("genbank", "mito", "genome"):
        if kind in inputs:
            read = T.read_genbank(spark, inputs[kind], strict=False).filter("failed is null").filter(F.length("seq").between(p.min_length_input, p.max_length_input)).select("acc", "taxid", "seq")
            if below is not None:
                read = lookup_join(read.withColumn("tax_id", F.col("taxid").try_cast("int")), below, "tax_id").drop("tax_id")
            read = ingest.join_ranked_lineage(read, "taxid", tax.filled).withColumn("taxid", F.concat(F.lit("NCBI:"), "taxid"))
            sources[kind] = ingest.named(read, "acc", "taxid").select("name", F.col("acc").alias("seqid"), "taxid", *RANKS, "seq")
    if "internal" in inputs:
        sources["internal"] = ingest.import_internal(T.read_fasta(spark, inputs["internal"]), p.min_length_input, p.max_length_input)
    if not sources:
        raise ValueError("no source of records is given")
    text = lambda path: "\n".join(r.value for r in spark.read.text(path).collect())  # noqa: E731  (a model and its seed are small files)
    profile = profiles.read_profile(text(inputs["profile"])) if "profile" in inputs else None
    amplicon = None
    if p.primer_fwd and "seed" in inputs:
        sample = reduce(DataFrame.unionByName, [s.select("taxid", *RANKS) for s in sources.values()])
        code = translation.modal_code(translation.assign_codes(sample, tax.gencodes), mark["type"])
        rows = [r.seq for r in T.read_stockholm(spark, inputs["seed"]).orderBy("name").collect()]
        amplicon = primers.amplicon_profile(rows, p.primer_fwd, p.primer_rev, code, p.pad_fwd, p.pad_rev)
    result = curate(sources, p, tax.gencodes, profile, amplicon)
    if out:
        write(result, p, out)
    return result


def write(result: Result, p: Params, out: str) -> None:
    """All outputs of a run into a folder."""
    sinks.write_fasta(result.final, f"{out}/final", compress=p.compressed_output)
    result.records.write.mode("overwrite").parquet(f"{out}/records")
    for name, df in (("fate_summary", result.fate_summary), ("taxa_summary", result.taxa_summary), ("source_counts", result.source_counts)):
        sinks.write_table(df, f"{out}/{name}")
    if p.key_species:
        sinks.write_table(reporting.key_species_summary(result.records, list(p.key_species)), f"{out}/key_species")
    if p.train_idtaxa:
        final = result.records.filter(F.col("fate") == filters.FINAL)
        model, problems, groups = classifier.train(final, "rid", "seq", p.idtaxa_max_group_size, p.idtaxa_max_iterations, p.idtaxa_allow_group_removal, p.seed)
        sinks.write_model(model, problems, groups, classifier.tree_children(final), f"{out}/idtaxa")
