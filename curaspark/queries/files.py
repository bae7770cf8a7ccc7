"""Queries of sources and sinks: whole tables are written to files of a format in the shared folder and read again. Also queries of trees, targets and alignments."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark import schemas
from curaspark.functions import headers
from curaspark.functions import seq as Q
from curaspark.functions.text import RANKS
from curaspark.operators import alignment, filters, ingest, reporting, similarity, taxonomy, translation
from curaspark.queries import curation as C
from curaspark.queries import sqltext as S
from curaspark.queries import table, taxonomy_ingest
from curaspark.session import shared_dir
from curaspark.sources import sinks
from curaspark.sources import text as T


def _at(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def _lines(df: DataFrame, line: Column, name: str) -> str:
    path = _at(df.sparkSession, name)
    df.select(line.alias("value")).write.text(path)
    return path


def _tabbed(columns: list[str], sep: str = "\t") -> Column:
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def _sequences(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.col("bold_row_id").cast("string"), F.lit("|"), F.coalesce("processid", F.lit("NA")))
    return table(spark, d, "bold_db_targets").select(name.alias("name"), F.coalesce("nuc", F.lit("")).alias("seq"))


def fasta_files(spark: SparkSession, d: str) -> DataFrame:
    """All sequences through compressed FASTA."""
    path = _at(spark, "fasta")
    sinks.write_fasta(_sequences(spark, d), path, compress=True)
    return T.read_fasta(spark, path)


def wrapped_fasta(spark: SparkSession, d: str) -> DataFrame:
    """All sequences through FASTA with 60 bases a line and Windows line ends, found by the file's first sign."""
    df = _sequences(spark, d)
    path = _lines(df, F.concat(F.lit(">"), "name", F.lit("\r\n"), F.regexp_replace("seq", "(.{60})", "$1\r\n")), "fasta")
    return T.read_any(spark, path)


def other_formats(spark: SparkSession, d: str) -> DataFrame:
    """All sequences through FASTQ, EMBL, GFA, Stockholm and Clustal."""
    df = _sequences(spark, d).filter("seq <> ''")
    name, seq = F.col("name"), F.col("seq")
    made = {
        "fastq": F.concat(F.lit("@"), name, F.lit("\n"), seq, F.lit("\n+\n"), F.regexp_replace(seq, ".", "I")),
        "embl": F.concat(F.lit("ID   "), name, F.lit("; SV 1;\nXX\nSQ   Sequence;\n     "), F.regexp_replace(seq, "(.{10})", "$1 "), F.lit("        10\n//")),
        "gfa": F.concat(F.lit("S\t"), name, F.lit("\t"), seq),
        "stockholm": F.concat(name, F.lit("   "), F.translate(seq, "-", ".")),
        "clustal": F.concat(name, F.lit("      "), seq),
    }
    out = None
    for kind, line in made.items():
        got = T.READERS[kind](spark, _lines(df, line, kind)).select(F.lit(kind).alias("format"), "name", "seq")
        out = got if out is None else out.unionByName(got)
    return out


def nodes_dump(spark: SparkSession, d: str) -> DataFrame:
    """nodes through its dump format."""
    df = table(spark, d, "nodes")
    columns = [c.split()[0] for c in schemas.NODES.split(", ")]
    return T.read_nodes(spark, _lines(df, F.concat(_tabbed(columns, "\t|\t"), F.lit("\t|")), "nodes"))


def names_dump(spark: SparkSession, d: str) -> DataFrame:
    """taxon_names through its dump format."""
    df = table(spark, d, "taxon_names")
    return T.read_names(spark, _lines(df, F.concat(_tabbed(["tax_id", "name_txt", "unique_name", "name_class"], "\t|\t"), F.lit("\t|")), "names"))


def ranked_dump(spark: SparkSession, d: str) -> DataFrame:
    """Ranked lineages through their dump format; ranks that are missing in it are null."""
    df = table(spark, d, "lineage").select(F.col("row_id").cast("int").alias("tax_id"), F.col("species").alias("tax_name"), *RANKS, F.lit("").alias("domain_realm"))
    columns = [c.split()[0] for c in schemas.RANKEDLINEAGE.split(", ")]
    return T.read_rankedlineage(spark, _lines(df, F.concat(_tabbed(columns, "\t|\t"), F.lit("\t|")), "ranked"))


def taxid_names(spark: SparkSession, d: str) -> DataFrame:
    """Ids and names through the full-lineage dump."""
    df = table(spark, d, "taxon_names").withColumn("lineage", F.lit("a; b; "))
    return T.read_taxidnames(spark, _lines(df, F.concat(_tabbed(["tax_id", "name_txt", "lineage"], "\t|\t"), F.lit("\t|")), "fullname"))


def bold_package(spark: SparkSession, d: str) -> DataFrame:
    """bold_db_targets through a BOLD package in a folder."""
    names = {"class": "class_name", "order": "order_name", "taxid": "bold_taxid"}
    columns = ["extra", *schemas.BOLD_USED]
    df = table(spark, d, "bold_db_targets").select(F.lit("x").alias("extra"), *[F.col(names.get(c, c)).alias(c) for c in schemas.BOLD_USED])
    path = _at(spark, "bold")
    head = spark.createDataFrame([("\t".join(columns),)], "value string")
    tidy = df.select(*[F.translate(F.col(c).cast("string"), "\t\r\n", "   ").alias(c) for c in columns])  # a value holds no separator
    head.unionByName(tidy.select(_tabbed(columns).alias("value"))).coalesce(1).write.text(path)
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(str(f.getPath()) for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(path)) if "part-" in str(f.getPath()))
    fs.rename(jvm.org.apache.hadoop.fs.Path(part), jvm.org.apache.hadoop.fs.Path(f"{path}/BOLD_Public.tsv"))
    return T.read_bold(spark, T.find_bold(spark, path))


def genbank_flat(spark: SparkSession, d: str) -> DataFrame:
    """Sequences through flat files, with why a record fails."""
    df = table(spark, d, "bold_db_targets").filter("nuc is not null")
    taxon = F.when(F.col("bold_taxid").isNotNull(), F.concat(F.lit('                     /db_xref="taxon:'), F.col("bold_taxid").cast("string"), F.lit('"\n'))).otherwise("")
    body = F.regexp_replace(F.lower(F.translate("nuc", "-", "")), "(.{10})", "$1 ")
    rec = F.concat(F.lit("LOCUS       X\nVERSION     "), F.concat(F.lit("AB"), F.col("bold_row_id").cast("string"), F.lit(".1")), F.lit("\nFEATURES\n"), taxon, F.lit("ORIGIN      \n        1 "), body, F.lit("\n//"))
    return T.read_genbank(spark, _lines(df, rec, "genbank"), strict=False).select("acc", "taxid", "name", "seq", "failed")


def failed_records(spark: SparkSession, d: str) -> DataFrame:
    """Accessions of all rows, as asked for, that have no record or a failed one."""
    wanted = table(spark, d, "bold_db_targets").select(F.concat(F.lit("AB"), F.col("bold_row_id").cast("string"), F.lit(".1")).alias("acc"))
    return T.failed_accessions(wanted, genbank_flat(spark, d))


def domain_hits(spark: SparkSession, d: str) -> DataFrame:
    """Domain tables: names with frame and stops, typed numbers, '-' as null."""
    df = table(spark, d, "bold_db_targets").withColumn("n", F.coalesce(F.length("nuc"), F.lit(0)))
    i = F.col("bold_row_id")
    target = F.concat(F.lit("rec!?!?"), i.cast("string"), F.lit("_frame="), F.when(i % 2 == 0, -1).otherwise(2).cast("string"), F.lit("_sc="), F.when(i % 3 == 0, "").when(i % 3 == 1, "7").otherwise("5|12"))
    cells = [target, F.lit("-"), F.col("n"), F.lit("model"), F.lit("-"), F.lit(230), F.lit("1e-20"), i / 8, F.lit(0.5), F.lit(1), F.lit(2), F.lit("1e-21"), F.lit("2e-21"), i / 4, F.lit("-"), F.lit(3), F.lit(200), F.lit(4), F.col("n") - 1, F.lit(2), F.col("n"), F.lit(0.93), F.lit("-")]
    path = _lines(df, F.concat_ws("  ", *[c.cast("string") for c in cells]), "domtbl")
    hits = T.read_domtblout(spark, path)
    return hits.select("target_name", "frame", F.array_join("stops", "|").alias("stops"), "target_len", "score", "bias", "ali_to", "acc", "description")


def small_files(spark: SparkSession, d: str) -> DataFrame:
    """Clusters, counts, targets and key species through their files: kind, a, b."""
    df = table(spark, d, "lineage").filter("seqid is not null").select(F.col("row_id").cast("string").alias("r"), "genus")
    clusters = T.read_clusters(spark, _lines(df, F.concat_ws("\t", "r", F.concat(F.lit("m"), "r")), "clusters")).select(F.lit("cluster").alias("kind"), F.col("representative").alias("a"), F.col("sequence_name").alias("b"))
    counts = T.read_counts(spark, _lines(df, F.concat(F.lit(">s"), "r", F.lit("\t"), "r"), "counts")).select(F.lit("count").alias("kind"), F.col("name").alias("a"), F.col("count").cast("string").alias("b"))
    targets = T.read_targets(spark, _lines(df, F.concat(F.lit("T"), "r", F.lit(", Family ")), "targets")).select(F.lit("target").alias("kind"), F.col("name").alias("a"), F.col("rank").alias("b"))
    keys = T.read_key_species(spark, _lines(df, F.concat(F.lit(" K"), "r", F.lit("  \n")), "keys")).select(F.lit("key").alias("kind"), F.col("value").alias("a"), F.lit("").alias("b"))
    return clusters.unionByName(counts).unionByName(targets).unionByName(keys)


def open_tree_tables(spark: SparkSession, d: str) -> DataFrame:
    """taxon_names through the Open Tree synonym table."""
    df = table(spark, d, "taxon_names").filter("name_class = 'synonym'").select("tax_id", "name_txt")
    line = F.concat_ws("\t|\t", "name_txt", F.col("tax_id").cast("string"), F.lit("synonym"), F.concat("name_txt", F.lit(" (synonym for Aus "), F.col("tax_id").cast("string"), F.lit(")")), F.lit("src"))
    return T.read_ott_synonyms(spark, _lines(df, F.concat(line, F.lit("\t|\t")), "ott"))


def open_tree_taxa(spark: SparkSession, d: str) -> DataFrame:
    """nodes through the Open Tree taxonomy table, taxa without certain place left out, a row for each source id."""
    df = table(spark, d, "nodes").filter("tax_id is not null").select(F.col("tax_id").cast("string").alias("t")).distinct()
    flags = F.when(F.col("t").endswith("3"), "hidden").when(F.col("t").endswith("5"), "sibling_higher").otherwise("")
    rank = F.when(F.col("t").endswith("7"), "no rank - terminal").otherwise("species")
    line = F.concat_ws("\t|\t", "t", F.lit("1"), F.concat(F.lit("Aus "), "t"), rank, F.concat(F.lit("ncbi:"), "t", F.lit(",gbif:9")), F.lit(""), flags)
    return T.read_ott_taxonomy(spark, _lines(df, F.concat(line, F.lit("\t|\t")), "ott"))


def lineage_folders(spark: SparkSession, d: str) -> DataFrame:
    """All sequences written by the hash of their lineage down to the family, read again with that hash."""
    df = C._bold(spark, d).select(F.col("rid").cast("string").alias("name"), "seq", *RANKS)
    path = _at(spark, "lineages")
    sinks.write_by_lineage(df, path, RANKS[:5])
    rec = spark.read.option("lineSep", "\n>").text(path)
    body = F.regexp_replace("value", "^>", "")
    name = F.substring_index(body, "\n", 1)
    return rec.select(name.alias("name"), F.regexp_replace(F.substr(body, F.length(name) + 1), r"\s", "").alias("seq"), F.col("lineage_hash").cast("string").alias("lineage_hash"))


def record_table(spark: SparkSession, d: str) -> DataFrame:
    """Headers of all records taken apart, with source and fate."""
    df = C._fated(spark, d)
    df = ingest.named(df.withColumn("acc", F.col("row_id").cast("string")), "acc", "taxid").select("name", "source", "fate")
    return reporting.record_table(df)


def report_files(spark: SparkSession, d: str) -> DataFrame:
    """The summary of fates through its delimited file."""
    path = _at(spark, "report")
    sinks.write_table(reporting.fate_summary(C._fated(spark, d)), path)
    return spark.read.schema("fate string, ord int, removed bigint, retained bigint").option("header", True).csv(path)


def frames_once(spark: SparkSession, d: str) -> DataFrame:
    """Frames of records that carry names: equal names with equal sequences come once."""
    df = C._bold(spark, d).select(F.concat_ws(";", "family", "genus").alias("name"), "seq")
    return translation.frames(df, "seq", C.CODE).groupBy("name", "frame").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("protein")).alias("residues"))


def target_names(spark: SparkSession, d: str) -> DataFrame:
    """Names and synonyms by which the order of least id is looked up, resolved by its name."""
    nodes, names = table(spark, d, "nodes"), table(spark, d, "taxon_names")
    tnr = taxonomy.taxid_name_rank(taxonomy.tax_names(names), taxonomy.node_ranks(nodes))
    first = tnr.filter("rank = 'order'").agg(F.min_by("tax_name", "tax_id").alias("n")).first().n
    return taxonomy.target_names(*taxonomy.resolve_target(first, "Order", nodes, names), nodes, names)


def records_of_taxa(spark: SparkSession, d: str) -> DataFrame:
    """lineage's rows of the three most frequent families."""
    df = table(spark, d, "lineage").select("row_id", "family").filter(~F.coalesce(F.lower(F.trim("family")).isin("", "none", "unclassified"), F.lit(True)))
    top = [r.family for r in df.groupBy("family").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "family").limit(3).collect()]
    return taxonomy.filter_by_tax(df, "family", top)


def grafted_tree(spark: SparkSession, d: str) -> DataFrame:
    """The tree of the orders of nodes' targets with all synonyms as tips."""
    df = table(spark, d, "ncbi_synonyms_filtered").select(F.col("synonym").alias("acc"), F.col("parent_taxon").alias("kingdom"))
    return taxonomy.grafted(df, "acc", ["kingdom"])


def _even(spark: SparkSession, d: str) -> DataFrame:
    """Sequences of plain letters, with family and length: those of one family and length are taken as aligned."""
    return C._bold(spark, d).filter("seq rlike '^[ACGT]+$'").select("rid", "family", F.length("seq").alias("n"), "seq", F.lit(1).alias("w"))


def dna_centres(spark: SparkSession, d: str) -> DataFrame:
    """The centre of the sequences of each family and length by median Jukes-Cantor distance."""
    got = filters.centres(_even(spark, d), ["family", "n"], "rid", "seq", "w")
    return got.select("family", "n", "centre", F.round("median", 6).alias("median"))


def centre_distances(spark: SparkSession, d: str) -> DataFrame:
    """Jukes-Cantor distance of every sequence to the first of its family and length."""
    df = _even(spark, d)
    first = df.groupBy("family", "n").agg(F.min(F.struct("rid", "seq")).alias("f")).select("family", "n", F.col("f.seq").alias("first"))
    return df.join(first, ["family", "n"]).select("rid", F.round(filters.pair_distance("first", "seq"), 6).alias("distance"))


def aligned_families(spark: SparkSession, d: str) -> DataFrame:
    """All sequences of the rarest kingdom aligned with each other: what is left without gaps, and whether all rows are equally long."""
    df = C._bold(spark, d).select("rid", "kingdom", "seq")
    rare = df.groupBy("kingdom").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "kingdom").first().kingdom
    out = alignment.star_alignment(df.filter(F.col("kingdom") == rare), "rid", "seq")
    long_ = out.agg(F.min(F.length("aligned")).alias("a"), F.max(F.length("aligned")).alias("b")).select((F.col("a") == F.col("b")).alias("even"))
    return out.join(F.broadcast(long_)).select("rid", Q.dealigned(F.col("aligned")).alias("seq"), "even")


def lca_of_pairs(spark: SparkSession, d: str) -> DataFrame:
    """How often a rank is the lowest that linked sequences share, per percent of their identity."""
    return similarity.lca_probabilities(C._bold(spark, d), "rid", "seq", RANKS, 0.8)


def random_sequences(spark: SparkSession, d: str) -> DataFrame:
    """As many random sequences of 50 bases as bold_db_targets has rows, by the lengths of their letters' runs."""
    return Q.random_seqs(spark, table(spark, d, "bold_db_targets").count(), 50).select("name", F.length(F.regexp_replace("seq", "[ACGT]", "x")).alias("length"))


QUERIES = {
    f.__name__: f
    for f in (
        fasta_files, wrapped_fasta, other_formats, nodes_dump, names_dump, ranked_dump, taxid_names, bold_package, genbank_flat, failed_records, domain_hits, small_files, open_tree_tables, open_tree_taxa,
        lineage_folders, record_table, report_files, frames_once, target_names, records_of_taxa, grafted_tree, dna_centres, centre_distances, aligned_families, lca_of_pairs, random_sequences,
    )
}

# --- SQL
_SEQS = "SELECT bold_row_id || '|' || coalesce(processid, 'NA') AS name, coalesce(nuc, '') AS seq FROM bold_db_targets"


def _dumped(columns: str, source: str) -> str:
    """Columns 'name type, ...' of a table as they come back from a dump: blanks at the ends go, empty text is null."""
    cells = [c.split() for c in columns.split(", ")]
    return "SELECT " + ", ".join(f"nullif(trim({n}, ' '), '') AS {n}" if t == "string" else f"{n}::INTEGER AS {n}" for n, t in cells) + f" FROM {source}"


_EVEN = f"{C._BOLD}, x AS (SELECT rid, family, len(seq) AS n, seq FROM bo WHERE regexp_full_match(seq, '[ACGT]+'))"
_JC = "CASE WHEN hamming({0}, {1}) / {2} >= 0.75 THEN 'inf'::DOUBLE ELSE -0.75 * ln(1 - 4 * (hamming({0}, {1}) / {2}) / 3) + 0.0 END"
_GB = "(SELECT 'AB' || bold_row_id || '.1' AS acc, bold_taxid::VARCHAR AS taxid, upper(replace(nuc, '-', '')) AS seq FROM bold_db_targets WHERE nuc IS NOT NULL)"
_FAILED = "CASE WHEN taxid IS NULL THEN 'no_taxon' WHEN seq = '' THEN 'no_sequence' WHEN NOT regexp_full_match(seq, '[GATCRYMKSWHBVDN]+') THEN 'odd_letters' END"
_NODE = "(SELECT DISTINCT tax_id::VARCHAR AS t FROM nodes WHERE tax_id IS NOT NULL)"
SQL = {
    "fasta_files": _SEQS,
    "wrapped_fasta": _SEQS,
    "other_formats": f"SELECT f.format, s.name, s.seq FROM ({_SEQS}) s CROSS JOIN (SELECT unnest(['fastq', 'embl', 'gfa', 'stockholm', 'clustal']) AS format) f WHERE s.seq <> ''",
    "nodes_dump": _dumped(schemas.NODES, "nodes"),
    "names_dump": _dumped(schemas.NAMES, "taxon_names"),
    "ranked_dump": _dumped(schemas.RANKEDLINEAGE, "(SELECT *, row_id AS tax_id, species AS tax_name, '' AS domain_realm FROM lineage)"),
    "taxid_names": "SELECT tax_id, nullif(trim(name_txt, ' '), '') AS tax_name FROM taxon_names",
    "bold_package": "SELECT " + ", ".join("nuc_basecount" if c == "nuc_basecount" else f"nullif(translate({n}::VARCHAR, chr(9) || chr(13) || chr(10), '   '), '') AS {n}" for c in schemas.BOLD_USED for n in [{"class": "class_name", "order": "order_name", "taxid": "bold_taxid"}.get(c, c)]) + " FROM bold_db_targets",
    "genbank_flat": f"SELECT acc, taxid, concat_ws('|', acc, taxid) AS name, seq, {_FAILED} AS failed FROM {_GB}",
    "failed_records": f"SELECT 'AB' || bold_row_id || '.1' AS acc FROM bold_db_targets WHERE 'AB' || bold_row_id || '.1' NOT IN (SELECT acc FROM {_GB} WHERE {_FAILED} IS NULL)",
    "domain_hits": "SELECT 'rec ' || bold_row_id AS target_name, CASE WHEN bold_row_id % 2 = 0 THEN -1 ELSE 2 END AS frame, CASE bold_row_id % 3 WHEN 0 THEN '' WHEN 1 THEN '7' ELSE '5|12' END AS stops,"
    " coalesce(len(nuc), 0)::DOUBLE AS target_len, bold_row_id / 4 AS score, NULL::DOUBLE AS bias, (coalesce(len(nuc), 0) - 1)::DOUBLE AS ali_to, 0.93::DOUBLE AS acc, NULL::VARCHAR AS description FROM bold_db_targets",
    "small_files": "WITH r AS (SELECT row_id::VARCHAR AS r FROM lineage WHERE seqid IS NOT NULL) SELECT 'cluster' AS kind, r AS a, 'm' || r AS b FROM r UNION ALL SELECT 'count', 's' || r, r FROM r UNION ALL SELECT 'target', 'T' || r, 'family' FROM r UNION ALL SELECT 'key', 'K' || r, '' FROM r",
    "open_tree_tables": "SELECT tax_id::VARCHAR AS tax_id, 'Aus ' || tax_id AS tax_name, name_txt AS synonym FROM taxon_names WHERE name_class = 'synonym'",
    "open_tree_taxa": f"SELECT t AS tax_id, '1' AS parent_taxid, 'Aus ' || t AS tax_name, CASE WHEN t LIKE '%7' THEN 'terminal' ELSE 'species' END AS rank, CASE WHEN t LIKE '%5' THEN 'sibling_higher' END AS flags, s.source, CASE WHEN s.source = 'ncbi' THEN t ELSE '9' END AS id"
    f" FROM {_NODE}, (SELECT unnest(['ncbi', 'gbif']) AS source) s WHERE t NOT LIKE '%3'",
    "lineage_folders": f"WITH {C._BOLD} SELECT rid::VARCHAR AS name, seq, md5(concat_ws(';', kingdom, phylum, class_name, order_name, family)) AS lineage_hash FROM bo",
    "record_table": f"""WITH {C._LIN}, n AS (SELECT regexp_replace(concat_ws(';', row_id || '|' || coalesce(taxid, 'NA'), {", ".join(RANKS)}), ' +', ' ', 'g') AS name, source, row_id FROM lin)
SELECT name, split_part(split_part(name, ';', 1), '|', 1) AS seqid, substr(split_part(name, ';', 1), len(split_part(split_part(name, ';', 1), '|', 1)) + 2) AS taxid, {", ".join(f"split_part(name, ';', {i}) AS {r}" for i, r in enumerate(RANKS, 2))}, source,
[{", ".join(f"'{f}'" for f in [*filters.FATES, filters.FINAL])}][row_id % 10 + 1] AS fate FROM n""",
    "report_files": C.SQL["fate_summary"],
    "frames_once": f"WITH {C._BOLD}, o AS (SELECT DISTINCT family || ';' || genus AS name, seq FROM bo) SELECT name, f AS frame, count(*) AS n, sum(greatest(len(seq) - (abs(f) - 1), 0) // 3)::BIGINT AS residues FROM o, (SELECT unnest([1, 2, 3, -1, -2, -3]) AS f) GROUP BY ALL",
    "target_names": f"""WITH r AS (SELECT tax_id, lower({S.trimmed("rank")}) AS rank FROM nodes WHERE tax_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY tax_id ORDER BY loaded_at DESC NULLS LAST, rank DESC NULLS LAST) = 1),
o AS (SELECT min(n.tax_id) AS tax_id FROM taxon_names n JOIN r USING (tax_id) WHERE n.name_class = 'scientific name' AND r.rank = 'order')
SELECT DISTINCT name, 'order' AS rank FROM (SELECT min(name_txt) AS name FROM taxon_names WHERE name_class = 'scientific name' AND tax_id IN (SELECT tax_id FROM o) UNION ALL SELECT name_txt FROM taxon_names WHERE name_class = 'synonym' AND tax_id IN (SELECT tax_id FROM o))""",
    "records_of_taxa": "WITH f AS (SELECT row_id, family FROM lineage WHERE NOT coalesce(lower(trim(family)) IN ('', 'none', 'unclassified'), true)) SELECT * FROM f WHERE family IN (SELECT family FROM f GROUP BY family ORDER BY count(*) DESC, family LIMIT 3)",
    "dna_centres": f"WITH {_EVEN}, p AS (SELECT a.family, a.n, a.rid, median({_JC.format('a.seq', 'b.seq', 'a.n')}) AS m FROM x a JOIN x b ON a.family = b.family AND a.n = b.n GROUP BY ALL) SELECT family, n, rid AS centre, round(m, 6) AS median FROM p QUALIFY row_number() OVER (PARTITION BY family, n ORDER BY m, rid) = 1",
    "centre_distances": f"WITH {_EVEN}, f AS (SELECT family, n, arg_min(seq, rid) AS first FROM x GROUP BY ALL) SELECT rid, round({_JC.format('first', 'seq', 'n')}, 6) AS distance FROM x JOIN f USING (family, n)",
    "aligned_families": f"WITH {C._BOLD} SELECT rid, seq, true AS even FROM bo WHERE kingdom = (SELECT kingdom FROM bo GROUP BY kingdom ORDER BY count(*), kingdom LIMIT 1)",
    "random_sequences": "SELECT CASE WHEN i = 0 THEN 'Seq' ELSE 'Seq_' || i END AS name, 50 AS length FROM range((SELECT count(*) FROM bold_db_targets)) t(i)",
}
