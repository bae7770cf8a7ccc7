import gzip

import pytest
from pyspark.sql import functions as F

from curaspark.config import MARKERS, Params, marker
from curaspark.operators import ingest
from curaspark.plans.curate import curate
from curaspark.sources import sinks
from curaspark.sources import text as X
from curaspark.streaming import ingest as stream


def pairs(df):
    return sorted((r.name if isinstance(r.name, str) else r["name"], r.seq) for r in df.select("name", "seq").collect())


@pytest.mark.parametrize("split", [16, 1 << 20])
def test_fasta(spark, tmp_path, split):
    f = tmp_path / "a.fasta"
    f.write_text(">a|1;K b c\nACGT\nAC\n>b > x\r\nTT\r\n\n>c\n>d\nGG")
    (tmp_path / "b.fasta").write_text(">e\nAA\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        assert pairs(X.read_fasta(spark, str(tmp_path))) == [("a|1;K b c", "ACGTAC"), ("b > x", "TT"), ("c", ""), ("d", "GG"), ("e", "AA")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_fasta_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("x;K", "AC-G"), ("y;K", None), ("z;K", "")], "name string, seq string")
    for compress in (False, True):
        sinks.write_fasta(df, str(tmp_path / str(compress)), compress=compress)
        assert pairs(X.read_fasta(spark, str(tmp_path / str(compress)))) == [("x;K", "AC-G"), ("y;K", ""), ("z;K", "")]
    out = sinks.format_output(df)
    assert out.filter("name = 'x;Root;K'").first().seq == "ACG"
    sinks.write_by_lineage(df.withColumn("kingdom", F.lit("K")), str(tmp_path / "by"), ["kingdom"])
    assert len(list((tmp_path / "by").glob("lineage_hash=*"))) == 1


def test_dmp(spark, tmp_path):
    f = tmp_path / "names.dmp"
    f.write_text("1\t|\troot\t|\t\t|\tscientific name\t|\n2\t|\ta # b, c\t|\tu\t|\tsynonym\t|\nx\t|\tbad id\t|\t\t|\tsynonym\t|\n")
    assert [tuple(r) for r in X.read_names(spark, str(f)).collect()] == [(1, "root", None, "scientific name"), (2, "a # b, c", "u", "synonym"), (None, "bad id", None, "synonym")]


GB = """LOCUS A1
VERSION     {acc}
  /db_xref="taxon:{tax}"
{more}ORIGIN
        1 acgtn acgt
       61 ac
//
"""


def test_genbank(spark, tmp_path):
    f = tmp_path / "x.gb"
    f.write_text(GB.format(acc="A1.1", tax=7, more='  /db_xref="taxon:7"\n') + "LOCUS B\nVERSION     B1.1\n  /db_xref=\"taxon:8\"\n//\n" + "LOCUS C\nVERSION C1.1\n")
    got = {r.acc: (r.taxid, r.seq, r.failed) for r in X.read_genbank(spark, str(f)).collect()}
    assert got["A1.1"] == ("7", "ACGTNACGTAC", None) and got["B1.1"][2] == "no_sequence"
    want = spark.createDataFrame([("A1.1",), ("B1.1",), ("Z",)], "acc string")
    assert {r.acc for r in X.failed_accessions(want, X.read_genbank(spark, str(f))).collect()} == {"B1.1", "Z"}
    f.write_text(GB.format(acc="A1.1", tax=7, more='  /db_xref="taxon:9"\n'))
    with pytest.raises(Exception, match="several_taxa"):
        X.read_genbank(spark, str(f)).collect()
    assert X.read_genbank(spark, str(f), strict=False).first().failed == "several_taxa"


FORMATS = {
    "fasta": (">a\nAC\n>b\nGT\n", [("a", "AC"), ("b", "GT")]),
    "fastq": ("@a\nAC\n+\nII\n@b\nGT\n+\nII\n", [("a", "AC"), ("b", "GT")]),
    "genbank": (GB.format(acc="A1.1", tax=7, more=""), [("A1.1", "ACGTNACGTAC")]),
    "embl": ("ID   X1; SV 1\nSQ   Sequence 4 BP;\n     acgt 4\n//\n", [("X1", "acgt")]),
    "gff": ("##gff-version 3\nx\ty\n##FASTA\n>a\nAC\nGT\n>b\nT\n", [("a", "ACGT"), ("b", "T")]),
    "stockholm": ("# STOCKHOLM 1.0\n#=GF ID x\na/1-4  AC.\nb  A.G\n\na/1-4  TT\nb  --\n//\n", [("a/1-4", "AC-TT"), ("b", "A-G--")]),
    "clustal": ("CLUSTAL W\n\na  AC-\nb  ACG\n   ** \n\na  T\nb  T\n", [("a", "AC-T"), ("b", "ACGT")]),
    "gfa": ("H\tVN\nS\ta\tACGT\nS\tb\t*\nL\ta\n", [("a", "ACGT")]),
}


@pytest.mark.parametrize("name", FORMATS)
def test_any_format(spark, tmp_path, name):
    body, want = FORMATS[name]
    f = tmp_path / "x"
    f.write_text(body)
    assert X.sniff(spark, str(f)) == name and pairs(X.read_any(spark, str(f))) == want
    z = tmp_path / "x.gz"
    z.write_bytes(gzip.compress(body.encode()))
    assert pairs(X.read_any(spark, str(z), mask=True, case="lower")) == [(n, "".join(c if c in "acgt-" else "n" for c in s.lower())) for n, s in want]


def test_unknown_format(spark, tmp_path):
    (tmp_path / "x").write_text("hello\n")
    with pytest.raises(ValueError):
        X.sniff(spark, str(tmp_path / "x"))


def test_small_readers(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Aus, Genus\nAus,genus\nB,family\n")
    assert sorted(map(tuple, X.read_targets(spark, str(tmp_path / "t.csv")).collect())) == [("Aus", "genus"), ("B", "family")]
    (tmp_path / "k").write_text(" Aus bus \n\n7215\n")
    assert [r.value for r in X.read_key_species(spark, str(tmp_path / "k")).collect()] == ["Aus bus", "7215"]
    (tmp_path / "b.tsv").write_text("\t".join(X.schemas.BOLD_USED) + "\textra\n" + "\t".join(["p", "1", *"KPCOFGS", "COI-5P", "AC\"G", "3", "lab", "None"]) + "\tz\n")
    r = X.read_bold(spark, str(tmp_path / "b.tsv")).first()
    assert r.class_name == "C" and r.nuc == 'AC"G' and r.nuc_basecount == 3
    (tmp_path / "d").write_text("# c\na|1;K!?!?x_frame=-2_sc=3|9 - 200 q - 230 1e-9 80.5 0 1 1 1e-9 1e-9 80 0 1 230 2 190 1 200 0.95 -\nb_frame=1_sc= - 10 q - 230 1 1 0 1 1 1 1 1 0 1 2 1 2 1 2 0.5 -\n")
    a, b = X.read_domtblout(spark, str(tmp_path / "d")).orderBy("target_name").collect()
    assert a.target_name == "a|1;K x" and a.frame == -2 and a.stops == [3, 9] and a.query_len == 230.0 and a.description is None and b.stops == [] and b.frame == 1
    (tmp_path / "c").write_text(">n\t3\n")
    assert tuple(X.read_counts(spark, str(tmp_path / "c")).first()) == ("n", 3)


def test_parameters():
    assert marker("coi") is MARKERS["COI"]
    for bad in ({"remove_unclassified": "x"}, {"selection_method": "x"}, {"min_length_input": 9, "max_length_input": 1}, {"primer_fwd": "A"}):
        with pytest.raises(ValueError):
            Params(**bad)
    with pytest.raises(ValueError):
        marker("28S")


def test_internal(spark):
    row = lambda name, n=5: (name, "A-" + "C" * n)
    df = spark.createDataFrame([row("ABC|123;K;P;C;O;F;G;G fake-s."), row("D|NCBI:4;K;P;C;O;F;G;S", 1)], "name string, seq string")
    got = ingest.import_internal(df, 3, 6).collect()
    assert [(r.seqid, r.taxid, r.seq) for r in got] == [("ABC", "INTERNAL:123", "ACCCCC")]
    with pytest.raises(Exception, match="wrong form"):
        ingest.import_internal(spark.createDataFrame([row("bad header")], "name string, seq string")).collect()
    with pytest.raises(ValueError, match="repeated"):
        ingest.import_internal(spark.createDataFrame([row("A|1;K;P;C;O;F;G;S"), row("A|2;K;P;C;O;F;G;S")], "name string, seq string"))


def test_every_record_has_one_fate(spark):
    from curaspark.functions.text import RANKS

    lin = ["K", "P", "C", "O", "F", "G", "G s"]
    rows = [(f"x{i}|1;" + ";".join(lin), f"x{i}", "1", *lin, "ACGTTGCA" * 20 + "ACGT"[i % 4]) for i in range(6)]
    rows += [rows[0], ("u|1;", "u", "1", *["Unclassified"] * 7, "ACGT"), ("n|1;" + ";".join(lin), "n", "1", *lin, "ACGTN" * 30)]
    df = spark.createDataFrame(rows, "name string, seqid string, taxid string, " + ", ".join(f"{r} string" for r in RANKS) + ", seq string")
    out = curate({"bold": df})
    fates = {r.fate: r.n for r in out.records.groupBy("fate").count().withColumnRenamed("count", "n").collect()}
    assert sum(fates.values()) == len(rows) and fates["filter_unclassified"] == 1 and fates["filter_ambiguous"] == 1 and fates["filter_duplicates"] == 1 and fates["final_database"] == 1
    s = {r.fate: r for r in out.fate_summary.collect()}
    assert s["input"].retained == len(rows) and s["final_database"].retained == out.final.count()
    assert "final_database" in sinks.fates_chart(out.fate_summary)


def test_stream(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "1.fasta").write_text(">a\nAC\nGT\n>b\nTT\n")
    (src / "2.fasta").write_text(">a\nACGT\n>c\nGG\n")
    q = stream.start(stream.new_names(stream.fasta_stream(spark, str(src))), lambda df, i: df.select("name", "seq").write.mode("overwrite").parquet(f"{out}/{i}"), str(tmp_path / "ck"), once=True)
    q.awaitTermination()
    assert pairs(spark.read.parquet(*map(str, out.iterdir()))) == [("a", "ACGT"), ("b", "TT"), ("c", "GG")]
