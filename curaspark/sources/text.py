"""Readers of sequence and taxonomy files. Each splits files by record and parses in the JVM, so large files are read in parallel."""

from __future__ import annotations

import io
import re
import tarfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curaspark import schemas

# Flags of taxa without a certain place in the Open Tree taxonomy.
UNPLACED = ["incertae_sedis", "major_rank_conflict", "unplaced", "environmental", "inconsistent", "extinct", "hidden", "hybrid", "not_otu", "viral", "barren"]


def _records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    return spark.read.option("lineSep", sep).text(path)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """name, seq of each record; wrapped lines are joined, Windows line ends and blanks around go. A record without sequence has the empty one.

    Files (plain or compressed) are split at '>' that begins a line. What stands before the first '>' of a file is left out.
    """
    body = F.regexp_replace(F.col("value"), "^>", "")
    head = F.substring_index(body, "\n", 1)
    rest = F.when(F.contains(body, F.lit("\n")), F.substr(body, F.length(head) + 2)).otherwise("")
    # Only the first record of a file may lack the separator in front of its '>'.
    return _records(spark, path, "\n>").filter(F.trim("value") != "").filter(~F.rlike("value", F.lit(r"^\s+$"))).select(F.trim(F.regexp_replace(head, "\r", "")).alias("name"), F.regexp_replace(rest, r"\s", "").alias("seq"))


def read_dmp(spark: SparkSession, path: str, schema: str) -> DataFrame:
    r"""Rows of a taxonomy dump with '\t|\t' between and '\t|' behind its fields; empty fields are null."""
    fields = StructType.fromDDL(schema)
    part = F.split(F.regexp_replace("value", r"\t\|\s*$", ""), r"\t\|\t", -1)
    cells = [F.nullif(F.trim(F.get(part, F.lit(i))), F.lit("")) for i in range(len(fields))]
    return spark.read.text(path).filter(F.trim("value") != "").select(*[c.try_cast(f.dataType).alias(f.name) if f.dataType.typeName() != "string" else c.alias(f.name) for c, f in zip(cells, fields)])


def read_rankedlineage(spark: SparkSession, path: str) -> DataFrame:
    return read_dmp(spark, path, schemas.RANKEDLINEAGE)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    return read_dmp(spark, path, schemas.NODES)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    return read_dmp(spark, path, schemas.NAMES)


def read_taxidnames(spark: SparkSession, path: str) -> DataFrame:
    """tax_id, tax_name of a full-lineage dump."""
    return read_dmp(spark, path, schemas.FULLNAMELINEAGE).select("tax_id", "tax_name")


def read_genbank(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """acc (VERSION), taxid, name ('acc|taxid'), seq in upper case, failed of the records of a flat file.

    failed is null or why the record gives no sequence: 'no_version', 'no_taxon', 'several_taxa', 'no_sequence', 'odd_letters'. With strict a record that
    names several taxa or has letters that are no nucleotides raises. What follows the last '//' is left out.
    """
    v = F.col("value")
    acc = F.regexp_extract(v, r"(?m)^VERSION\s+(\S+)", 1)
    taxa = F.array_distinct(F.regexp_extract_all(v, F.lit(r'db_xref="taxon:(\d+)"'), F.lit(1)))
    origin = F.regexp_extract(v, r"(?s)\nORIGIN[^\n]*\n(.*)$", 1)
    seq = F.upper(F.regexp_replace(origin, r"[\s\d]", ""))
    df = _records(spark, path, "\n//").filter(F.contains("value", F.lit("LOCUS"))).select(F.nullif(acc, F.lit("")).alias("acc"), taxa.alias("_taxa"), seq.alias("seq"))
    failed = (
        F.when(F.col("acc").isNull(), "no_version").when(F.size("_taxa") == 0, "no_taxon").when(F.size("_taxa") > 1, "several_taxa").when(F.col("seq") == "", "no_sequence").when(~F.col("seq").rlike("^[GATCRYMKSWHBVDN]+$"), "odd_letters")
    )
    df = df.withColumn("failed", failed)
    if strict:
        bad = F.raise_error(F.concat(F.lit("record "), F.coalesce("acc", F.lit("?")), F.lit(": "), F.col("failed")))
        df = df.withColumn("failed", F.when(F.col("failed").isin("several_taxa", "odd_letters"), bad).otherwise(F.col("failed")))
    return df.select("acc", F.get("_taxa", F.lit(0)).alias("taxid"), F.concat_ws("|", "acc", F.get("_taxa", F.lit(0))).alias("name"), "seq", "failed")


def failed_accessions(wanted: DataFrame, records: DataFrame) -> DataFrame:
    """acc of what was asked for (acc) but has no sequence in records."""
    return wanted.select("acc").distinct().join(records.filter("failed is null"), "acc", "left_anti")


def read_bold(spark: SparkSession, path: str) -> DataFrame:
    """The used columns of a BOLD package (tab-separated, with header), all strings but nuc_basecount; class and order become class_name and order_name."""
    df = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    lacking = [c for c in schemas.BOLD_USED if c not in df.columns]
    if lacking:
        raise ValueError(f"columns are missing: {', '.join(lacking)}")
    names = {"class": "class_name", "order": "order_name", "taxid": "bold_taxid"}
    return df.select(*[F.col(c).try_cast("int").alias(c) if c == "nuc_basecount" else F.col(c).alias(names.get(c, c)) for c in schemas.BOLD_USED])


def find_bold(spark: SparkSession, path: str) -> str:
    """Path of the table of a BOLD package: `path` itself where it is a .tsv, else the one .tsv in the folder, else the table in a .tar.gz (the path itself or the
    one in the folder), which is unpacked into the shared folder. Raises where there is none."""
    from curaspark.session import shared_dir

    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        raise FileNotFoundError(path)
    files = [str(f.getPath()) for f in fs.listStatus(at)] if fs.getFileStatus(at).isDirectory() else [path]
    for end in (".tsv", ".tar.gz"):
        found = sorted(f for f in files if f.endswith(end))
        if len(found) > 1:
            raise ValueError(f"{path} holds several packages: {', '.join(found)}")
        if found and end == ".tsv":
            return found[0]
        if found:
            to = f"{shared_dir(spark)}/bold-{uuid.uuid4().hex}.tsv"
            _unpack(fs, jvm, found[0], to)
            return to
    raise FileNotFoundError(f"{path} holds no BOLD package")


def _unpack(fs, jvm, archive: str, to: str) -> None:
    """The one .tsv of an archive, copied piece by piece as it is unpacked."""
    source = fs.open(jvm.org.apache.hadoop.fs.Path(archive))

    class Reader(io.RawIOBase):
        def read(self, n: int = -1) -> bytes:
            return bytes(source.readNBytes(n if n >= 0 else 1 << 20))

    target = jvm.org.apache.hadoop.fs.Path(to)
    out = target.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).create(target)
    try:
        with tarfile.open(fileobj=Reader(), mode="r|gz") as t:
            member = next((m for m in t if m.isfile() and m.name.endswith(".tsv")), None)
            if member is None:
                raise FileNotFoundError(f"{archive} holds no .tsv")
            data = t.extractfile(member)
            while piece := data.read(1 << 22):
                out.write(piece)
    finally:
        out.close()
        source.close()


def read_ott_taxonomy(spark: SparkSession, path: str, filter_unplaced: bool = True) -> DataFrame:
    """tax_id, parent_taxid, tax_name, rank, flags, source, id of an Open Tree taxonomy table: a row for each of a taxon's source ids (null where it has none).

    With filter_unplaced taxa that bear a flag of UNPLACED are left out and 'no rank - terminal' becomes 'terminal'.
    """
    df = read_dmp(spark, path, "tax_id string, parent_taxid string, tax_name string, rank string, sourceinfo string, uniqname string, flags string").filter("tax_id <> 'uid'")
    if filter_unplaced:
        df = df.filter(~F.coalesce(F.col("flags").rlike("|".join(UNPLACED)), F.lit(False))).withColumn("rank", F.when(F.col("rank") == "no rank - terminal", "terminal").otherwise(F.col("rank")))
    each = df.withColumn("s", F.explode_outer(F.split("sourceinfo", ",")))
    return each.select("tax_id", "parent_taxid", "tax_name", "rank", "flags", F.get(F.split("s", ":"), F.lit(0)).alias("source"), F.get(F.split("s", ":"), F.lit(1)).alias("id"))


def read_ott_synonyms(spark: SparkSession, path: str) -> DataFrame:
    """tax_id, tax_name, synonym of an Open Tree synonym table; the taxon is named in the unique name, as in 'Aus bus (synonym for Aus cus)'."""
    df = read_dmp(spark, path, "synonym string, tax_id string, type string, uniqname string, sourceinfo string").filter("tax_id <> 'uid'")
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace("uniqname", "^.*for ", ""), r"\).*$", ""), r"\(.*$", "")
    return df.select("tax_id", F.trim(name).alias("tax_name"), "synonym")


def one_value(text: str) -> str:
    """The one value that a list in brackets repeats, as in '[COI, COI]'; raises where there are several or none."""
    values = set(re.findall(r"[^\s,\[\]]+", text))
    if len(values) != 1:
        raise ValueError(f"not one value: {text}")
    return values.pop()


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """Distinct name, rank of a file without header; ranks in lower case."""
    return spark.read.schema("name string, rank string").option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path).filter("name is not null").withColumn("rank", F.lower("rank")).distinct()


def read_key_species(spark: SparkSession, path: str) -> DataFrame:
    """value: one species or taxid a line, trimmed, no empty lines."""
    return spark.read.text(path).select(F.trim("value").alias("value")).filter("value <> ''")


def read_domtblout(spark: SparkSession, path: str) -> DataFrame:
    """Typed domain hits: comments out, '-' null, '!?!?' in names and descriptions back to a blank. frame and stops are taken from names '<name>_frame=<f>_sc=<a|b>'."""
    fields = StructType.fromDDL(schemas.DOMTBLOUT)
    part = F.split(F.trim("value"), r"\s+", len(fields))
    cells = []
    for i, f in enumerate(fields):
        c = F.nullif(F.get(part, F.lit(i)), F.lit("-"))
        cells.append((F.regexp_replace(c, r"!\?!\?", " ") if f.dataType.typeName() == "string" else c.try_cast("double").try_cast(f.dataType)).alias(f.name))
    return framed_names(spark.read.text(path).filter(~F.startswith("value", F.lit("#")) & (F.trim("value") != "")).select(*cells))


def framed_names(df: DataFrame) -> DataFrame:
    """df with target_name split into target_name, frame and stops (array of positions)."""
    full = F.when(F.col("description").isNotNull(), F.concat_ws(" ", "target_name", "description")).otherwise(F.col("target_name"))
    stops = F.nullif(F.regexp_extract(full, r"_sc=(.*)$", 1), F.lit(""))
    return df.withColumns({
        "stops": F.coalesce(F.split(stops, r"\|").cast("array<int>"), F.array().cast("array<int>")),
        "frame": F.regexp_extract(full, r"_frame=(-?\d+)", 1).try_cast("int"),
        "target_name": F.regexp_extract(full, r"^(.*?)(?:_frame=.*)?$", 1),
    })


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("representative string, sequence_name string").option("sep", "\t").csv(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """name (without '>'), count."""
    return spark.read.schema("name string, count int").option("sep", "\t").csv(path).withColumn("name", F.regexp_replace("name", "^>", ""))


# --- other formats, as name and seq

def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """name, seq of four-line records, from files of any size: the lines of each block of a file are numbered in their task's order, the numbers of lines before a block
    are added, one number a block, and four lines that follow each other are a record, wherever blocks begin."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("o"))
    lines = lines.withColumn("i", F.row_number().over(W.partitionBy("f", "b").orderBy("o")) - 1)
    before = lines.groupBy("f", "b").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.sum("n").over(W.partitionBy("f").orderBy("b")) - F.col("n")).drop("n")
    at = lines.join(before, ["f", "b"]).select("f", (F.col("i") + F.col("before")).alias("i"), F.regexp_replace("value", "\r", "").alias("l"))
    g = at.groupBy("f", F.floor(F.col("i") / 4).alias("r")).agg(F.max(F.when(F.col("i") % 4 == 0, F.col("l"))).alias("h"), F.max(F.when(F.col("i") % 4 == 1, F.col("l"))).alias("seq"))
    return g.filter(F.startswith("h", F.lit("@"))).select(F.substr("h", F.lit(2)).alias("name"), "seq")


def read_embl(spark: SparkSession, path: str) -> DataFrame:
    """name (ID), seq."""
    v = F.col("value")
    body = F.regexp_extract(v, r"(?s)\nSQ[^\n]*\n(.*)$", 1)
    return _records(spark, path, "\n//").filter(F.rlike(v, F.lit(r"(?m)^ID\s"))).select(F.regexp_extract(v, r"(?m)^ID\s+([^\s;]+)", 1).alias("name"), F.regexp_replace(body, r"[\s\d]", "").alias("seq"))


def read_gfa(spark: SparkSession, path: str) -> DataFrame:
    """name, seq of segment lines; '*' is no sequence."""
    part = F.split("value", "\t")
    return spark.read.text(path).filter(F.startswith("value", F.lit("S\t"))).select(F.get(part, F.lit(1)).alias("name"), F.get(part, F.lit(2)).alias("seq")).filter("seq <> '*'")


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """name, seq of the FASTA part behind '##FASTA'."""
    whole = spark.read.text(path, wholetext=True)
    rec = whole.select(F.explode(F.split(F.concat(F.lit("\n"), F.regexp_extract("value", r"(?s)##FASTA\s*\n(.*)$", 1)), "\n>")).alias("r")).filter(F.trim("r") != "")
    head = F.substring_index("r", "\n", 1)
    return rec.select(F.trim(head).alias("name"), F.regexp_replace(F.substr("r", F.length(head) + 1), r"\s", "").alias("seq"))


def _aligned(spark: SparkSession, path: str, line: str) -> DataFrame:
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("f"), F.posexplode(F.split("value", r"\r?\n")).alias("i", "l"))
    rows = lines.select("f", "i", F.regexp_extract("l", line, 1).alias("name"), F.regexp_extract("l", line, 2).alias("s")).filter("name <> ''")
    return rows.groupBy("f", "name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x.s), "").alias("seq")).select("name", "seq")


def read_stockholm(spark: SparkSession, path: str) -> DataFrame:
    """name, seq of an alignment; its blocks are joined in order, '.' becomes '-'. An alignment is one piece."""
    return _aligned(spark, path, r"^([^#\s/]\S*)\s+(\S+)\s*$").withColumn("seq", F.translate("seq", ".", "-"))


def read_clustal(spark: SparkSession, path: str) -> DataFrame:
    """name, seq of an alignment; the heading and the lines of marks are left out."""
    return _aligned(spark, path, r"^(?!CLUSTAL|MUSCLE)(\S+)\s+([A-Za-z\-*.]+)(?:\s+\d+)?\s*$")


READERS = {"fasta": read_fasta, "fastq": read_fastq, "genbank": lambda s, p: read_genbank(s, p, False).filter("failed is null").select(F.col("acc").alias("name"), "seq"), "embl": read_embl, "gfa": read_gfa, "gff": read_gff, "stockholm": read_stockholm, "clustal": read_clustal}
# How files of each format begin.
SIGNS = [("fasta", ">"), ("fastq", "@"), ("genbank", "LOCUS"), ("embl", "ID "), ("gff", "##gff"), ("stockholm", "# STOCKHOLM"), ("clustal", "CLUSTAL"), ("clustal", "MUSCLE"), ("gfa", "H\t"), ("gfa", "S\t")]


def sniff(spark: SparkSession, path: str) -> str:
    """The format of a file by its first line that is not empty."""
    first = spark.read.text(path).filter(F.trim("value") != "").limit(1).collect()
    for name, sign in SIGNS:
        if first and first[0].value.startswith(sign):
            return name
    raise ValueError(f"{path}: no known format")


def read_any(spark: SparkSession, path: str, mask: bool = False, case: str | None = None) -> DataFrame:
    """name, seq of a file of any known format. mask: letters other than A, C, G, T and gaps as N; case: 'lower' or 'upper'."""
    df = READERS[sniff(spark, path)](spark, path)
    seq: Column = F.col("seq")
    if mask:
        seq = F.regexp_replace(seq, "[^ACGTacgt-]", "N")
    if case:
        seq = {"lower": F.lower, "upper": F.upper}[case](seq)
    return df.withColumn("seq", seq)
