"""Alignment, searches, nucleotide models, targets, trees, readers of other tables, and a whole run from files."""

import random
import tarfile

import pytest
from pyspark.sql import functions as F

from curaspark.config import Params
from curaspark.functions import seq as Q
from curaspark.functions.text import RANKS
from curaspark.operators import alignment, classifier, dense_keys, profiles, similarity, taxonomy
from curaspark.plans import curate as plan
from curaspark.session import as_table, lookup_join, scratch, shared_dir
from curaspark.sources import sinks
from curaspark.sources import text as X

RNG = random.Random(11)
BASE = "".join(RNG.choice("ACGT") for _ in range(300))


def test_alignment_keeps_every_letter(spark):
    rows = [(0, BASE, True), (1, BASE[:100] + "TTTT" + BASE[100:], False), (2, BASE[:150] + BASE[153:], True), (3, BASE[40:], False), (4, "GGG" + BASE, False), (5, None, True), (6, "", False), (7, BASE.lower(), False)]
    df = spark.createDataFrame(rows, "id int, seq string, core boolean").withColumn("aligned", F.lit("clash"))
    got = {r.id: r.aligned for r in alignment.star_alignment(df, "id", "seq", "core").collect()}
    assert got[5] is None and len({len(s) for s in got.values() if s is not None}) == 1
    assert all(got[i].replace("-", "") == s.upper() for i, s, _ in rows if s is not None)
    n = len(got[0])
    assert n == 300 + 4 + 3 and sum(a != b for a, b in zip(got[0], got[2])) == 3 and got[6] == "-" * n and got[7] == got[0]
    assert alignment.star_alignment(df.limit(0), "id", "seq").count() == 0


def test_seeded_search(spark):
    other = "".join(RNG.choice("ACGT") for _ in range(300))
    db = spark.createDataFrame([("a", BASE), ("b", BASE[:120] + BASE[123:]), ("c", other), ("n", None)], "name string, seq string")
    q = spark.createDataFrame([("q", BASE[50:250]), ("o", other[:90]), ("e", "")], "name string, seq string")
    got = {(r.qseqid, r.sseqid): r for r in similarity.seeded_search(q, db, min_coverage=0.9).collect()}
    assert set(got) == {("q", "a"), ("q", "b"), ("o", "c")}
    assert got["q", "a"].pident == 100 and got["q", "a"].qcovs == 100 and 98 < got["q", "b"].pident < 99


def test_lca_of_own_pairs(spark):
    lin = ["K", "P", "C", "O", "F", "G"]
    rows = [(i, *lin, f"G s{i // 2}", BASE[i:]) for i in range(4)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{r} string" for r in RANKS) + ", seq string")
    got = {(r.identity, r["rank"]): r.n for r in similarity.lca_probabilities(df, "id", "seq", RANKS).collect()}
    assert got == {(1.0, "species"): 1, (1.0, "genus"): 2}


def test_nucleotide_models():
    model = profiles.build_profile("m", [BASE[:90]] * 3, letters="ACGT")
    s = profiles.Search(model)
    assert profiles.model_row(BASE[:90], s, 50) == BASE[:90]
    short = profiles.model_row(BASE[:45] + BASE[48:90], s, 50)
    assert len(short) == 90 and "---" in short and short.replace("-", "") == BASE[:45] + BASE[48:90]
    assert profiles.model_row(BASE[:45] + BASE[46:90], s, 50) is None and profiles.model_row(BASE[:45] + BASE[46:90], s, 50, check_frame=False) is not None
    assert profiles.model_row(BASE[:45] + BASE[48:90], s, 50, max_indel=3, min_length=60) is None
    assert profiles.model_row("", s) is None and profiles.model_row("A" * 50, s) is None
    assert profiles.binding_position(BASE[30:50], model, min_score=100)["start"] is None
    at = profiles.binding_position(BASE[30:50], model, min_score=5)
    assert (at["start"], at["end"], at["orientation"]) == (31, 50, "forward")
    back = profiles.binding_position(BASE[30:50].translate(str.maketrans("ACGT", "TGCA"))[::-1], model, min_score=5)
    assert (back["start"], back["end"], back["orientation"]) == (31, 50, "reverse")
    assert profiles.binding_position("", model)["start"] is None
    rows = [BASE[6:30] + BASE[33:80], BASE[6:30] + BASE[33:79] + "-"]
    out = profiles.padded_alignment(rows, model)
    assert all(len(r) == 90 for r in out) and out[0] == "-" * 6 + BASE[6:30] + "---" + BASE[33:80] + "-" * 10
    with pytest.raises(ValueError):
        profiles.padded_alignment(["A" * 40], model)


def test_fitted_table(spark):
    model = profiles.build_profile("m", [BASE[:90]] * 3, letters="ACGT")
    df = spark.createDataFrame([(1, BASE[:90]), (2, "ACGT"), (3, None)], "id int, seq string")
    assert [tuple(r) for r in profiles.fitted_to_profile(df, "seq", model, min_score=50).collect()] == [(1, BASE[:90], BASE[:90])]


NODES = [(1, None, "no rank"), (2, "1", "order"), (3, "2", "infraorder"), (4, "3", "family"), (5, "3", "family"), (6, "4", "genus"), (7, "6", "species"), (8, "1", "order")]
NAMES = [(2, "Ordo", "scientific name"), (3, "Infra", "scientific name"), (4, "Aidae", "scientific name"), (4, "Oldidae", "synonym"), (5, "Bidae", "scientific name"), (6, "Aus", "scientific name"), (7, "Aus bus", "scientific name"), (8, "Infra", "scientific name"), (1, "root", "scientific name")]


def dump(spark):
    nodes = spark.createDataFrame(NODES, "tax_id int, parent string, rank string").withColumn("loaded_at", F.lit(None).cast("timestamp"))
    return nodes, spark.createDataFrame(NAMES, "tax_id int, name_txt string, name_class string")


def test_targets(spark):
    nodes, names = dump(spark)
    assert taxonomy.resolve_target("4", None, nodes, names) == (4, "Aidae", "family")
    assert taxonomy.resolve_target("Infra", "Infraorder", nodes, names) == (3, "Infra", "infraorder")
    for bad in (("99", None), ("4", "genus"), ("Nobody", None), ("Infra", None), ("Aidae", "order")):
        with pytest.raises(ValueError):
            taxonomy.resolve_target(*bad, nodes, names)
    own = {tuple(r) for r in taxonomy.target_names(4, "Aidae", "family", nodes, names).collect()}
    assert own == {("Aidae", "family"), ("Oldidae", "family")}
    lower = {tuple(r) for r in taxonomy.target_names(3, "Infra", "infraorder", nodes, names).collect()}
    assert lower == {("Aidae", "family"), ("Oldidae", "family"), ("Bidae", "family")}
    with pytest.raises(ValueError):
        taxonomy.target_names(1, "root", "no rank", nodes, names)


def test_trees_and_filters(spark):
    df = spark.createDataFrame([("a1", "K", "P"), ("a2", "K", "P"), ("b", "K", None), ("b", "K", None), (None, "K", "P")], "acc string, kingdom string, phylum string")
    assert taxonomy.grafted(df, "acc", ["kingdom", "phylum"]).first().newick == "(((a1,a2)P,(b)Unclassified)K);"
    assert taxonomy.filter_by_tax(df, "phylum", ["P", "Q"]).count() == 3 and taxonomy.filter_by_tax(df, "phylum", []).count() == 0


def test_random_sequences(spark):
    got = Q.random_seqs(spark, 3, 40).collect()
    assert [r.name for r in got] == ["Seq", "Seq_1", "Seq_2"] and all(len(r.seq) == 40 and set(r.seq) <= set("ACGT") for r in got)
    assert got == Q.random_seqs(spark, 3, 40).collect() != Q.random_seqs(spark, 3, 40, seed=1).collect() and len({r.seq for r in got}) == 3


def test_genetic_codes_are_whole():
    assert all(len(c) == 64 for c in Q.GENETIC_CODES.values()) and set(range(26, 34)) <= set(Q.GENETIC_CODES)


def test_open_tree_tables(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("uid\t|\tparent_uid\t|\tname\t|\trank\t|\tsourceinfo\t|\tuniqname\t|\tflags\t|\t\n5\t|\t1\t|\tAus\t|\tgenus\t|\tncbi:7,gbif:8\t|\t\t|\t\t|\t\n6\t|\t1\t|\tBus\t|\tno rank - terminal\t|\t\t|\t\t|\thidden\t|\t\n")
    got = sorted(tuple(r) for r in X.read_ott_taxonomy(spark, str(tmp_path / "t.tsv")).select("tax_id", "tax_name", "source", "id").collect())
    assert got == [("5", "Aus", "gbif", "8"), ("5", "Aus", "ncbi", "7")]
    assert X.read_ott_taxonomy(spark, str(tmp_path / "t.tsv"), False).count() == 3
    (tmp_path / "s.tsv").write_text("name\t|\tuid\t|\ttype\t|\tuniqname\t|\tsourceinfo\t|\t\nOld\t|\t5\t|\tsynonym\t|\tOld (synonym for Aus)\t|\tx\t|\t\n")
    assert [tuple(r) for r in X.read_ott_synonyms(spark, str(tmp_path / "s.tsv")).collect()] == [("5", "Aus", "Old")]
    assert X.one_value("[COI, COI]") == "COI"
    with pytest.raises(ValueError):
        X.one_value("[a, b]")


def test_fastq_of_several_blocks(spark, tmp_path):
    """Records are whole wherever the file is cut."""
    rows = [(f"r{i} x", "ACGT" * (1 + i % 9)) for i in range(2000)]
    (tmp_path / "a.fastq").write_text("".join(f"@{n}\n{s}\n+\n{'@' * len(s)}\n" for n, s in rows))
    had = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert sorted(map(tuple, X.read_fastq(spark, str(tmp_path / "a.fastq")).collect())) == sorted(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", had)


def test_alignments_of_several_files_do_not_mix(spark, tmp_path):
    for f in "ab":
        (tmp_path / f"{f}.sto").write_text(f"# STOCKHOLM 1.0\nx AC{f.upper()}\ny A.C\n//\n")
    assert sorted(map(tuple, X.read_stockholm(spark, str(tmp_path)).collect())) == [("x", "ACA"), ("x", "ACB"), ("y", "A-C"), ("y", "A-C")]


def test_packages(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        X.find_bold(spark, str(tmp_path))
    (tmp_path / "BOLD_Public.x.tsv").write_text("a\tb\n1\t2\n")
    with tarfile.open(tmp_path / "BOLD_Public.x.tar.gz", "w:gz") as t:
        t.add(tmp_path / "BOLD_Public.x.tsv", "BOLD_Public.x.tsv")
    assert X.find_bold(spark, str(tmp_path)).endswith("BOLD_Public.x.tsv")
    unpacked = X.find_bold(spark, str(tmp_path / "BOLD_Public.x.tar.gz"))
    assert spark.read.option("sep", "\t").option("header", True).csv(unpacked).first().b == "2"


def test_scratch_tables_go(spark):
    with scratch(spark) as keep:
        a, b = as_table(spark.range(5)), keep(as_table(spark.range(7)))
        assert a.count() == 5
    assert b.count() == 7
    with pytest.raises(Exception):
        spark.read.parquet(a._table_path).count()
    assert shared_dir(spark) in b._table_path


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookups_beyond_the_bound_are_not_broadcast(spark):
    """Small files can hold many rows: 16 copies of each went to the driver, as Spark goes by the size of the files."""
    small, big = as_table(spark.range(5).withColumn("x", F.col("id") * 2)), as_table(spark.range(40).withColumn("id", F.col("id") % 8))
    for how, n in (("inner", 25), ("left", 40), ("left_anti", 15)):
        for salt in (None, F.rand(1)):
            got = lookup_join(big, small, "id", how, salt, most=4)
            assert "Broadcast" not in _plan(got) and got.count() == n
    assert "BroadcastHashJoin" in _plan(lookup_join(big, small, "id", most=5))


@pytest.mark.parametrize("removal", [True, False])
def test_training_broadcasts_no_records(spark, monkeypatch, removal):
    plans = []
    for name in ("as_table", "counted_table"):
        monkeypatch.setattr(classifier, name, lambda df, f=getattr(classifier, name): (plans.append(_plan(df)), f(df))[1])
    monkeypatch.setattr(classifier, "lookup_join", lambda *a, **k: lookup_join(*a, **k, most=-1))
    rows = [(f"{s}{i}", "K", "P", "C", "O", "F", s, f"{s} s", BASE[30 * i :]) for s in "ab" for i in range(3)] + [("o", "K", "P", "C", "O", "F", "c", "c s", BASE)]
    df = spark.createDataFrame(rows, "rid string, " + ", ".join(f"{r} string" for r in RANKS) + ", seq string")
    _, problems, groups = classifier.train(df, max_iterations=2, allow_group_removal=removal)
    assert problems.count() and groups.count()
    assert any("SortMergeJoin" in x for x in plans) and not any("BroadcastHashJoin" in x for x in [*plans, _plan(groups)])


def test_training_makes_no_table_of_kmers(spark, monkeypatch):
    """Nodes that one task trains and judges give the problems of a model's table, ties and ambiguous letters included, and no k-mers go to disk."""
    made = []
    for name in ("as_table", "counted_table"):
        monkeypatch.setattr(classifier, name, lambda df, f=getattr(classifier, name): (made.extend(df.columns), f(df))[1])
    rng = random.Random(3)
    base = ["".join(rng.choice("ACGT") for _ in range(150)) for _ in range(3)]
    rows = [(f"r{i}", "K", "P", "C", "O", f"F{i % 2}", f"G{i % 5}", f"s{i % 7}", "".join(rng.choice("ACGTN") if rng.random() < 0.1 else c for c in base[rng.choice((i % 2, 2))])) for i in range(60)]
    rows += [(f"t{i}", "K", "P", "C", "O", "F0", "G0", f"t{i % 3}", base[0]) for i in range(6)] + [("short", "K", "P", "C", "O", "F1", "G9", "s9", "ACG"), ("none", "K", "P", "C", "O", "F1", "G9", "s8", None)]
    df = spark.createDataFrame(rows, "rid string, " + ", ".join(f"{r} string" for r in RANKS) + ", seq string")
    got = set(map(tuple, classifier.train(df, max_iterations=1, with_model=False)[1].collect()))
    assert got and "g" not in made and "grams" not in made
    monkeypatch.setattr(classifier, "NODE", 0)
    assert set(map(tuple, classifier.train(df, max_iterations=1, with_model=False)[1].collect())) == got and "g" in made


def test_dense_sums_are_exact(spark):
    """Numbers beyond 2^53, where doubles lose the last digits."""
    big = 2**53 + 1
    df = spark.createDataFrame([("a", big), ("a", 1), ("b", -big), ("b", None)], "k string, n bigint")
    got = {r.key_value: r.s for r in dense_keys.dense_key_stats(df, {"k": F.col("k")}, {"s": F.col("n")}).collect()}
    assert got == {"a": big + 1, "b": -big}


def test_problem_groups_are_all_kept(spark):
    """More problem groups than any list should be cut to: one wrong record in each of many lineages."""
    rows = [(f"r{i}", "K", "P", "C", "O", f"F{i}", "G", "s", BASE[:40]) for i in range(10_001)]
    df = spark.createDataFrame(rows, "rid string, " + ", ".join(f"{r} string" for r in RANKS) + ", seq string")
    _, problems, groups = classifier.train(df, max_iterations=1)
    # all sequences are alike, so all records choose one family and every other family is a group of problems
    assert problems.count() == groups.count() == 10_000


def test_model_through_files(spark, tmp_path):
    other = "".join(RNG.choice("ACGT") for _ in range(300))
    rows = [(f"a{i}", "K", "P", "C", "O", "F", "G", "a", BASE) for i in range(3)] + [(f"b{i}", "K", "P", "C", "O", "F", "H", "b", other) for i in range(3)]
    df = spark.createDataFrame(rows, "rid string, " + ", ".join(f"{r} string" for r in RANKS) + ", seq string")
    sinks.write_model(*classifier.train(df), classifier.tree_children(df), str(tmp_path / "m"))
    model, tree = sinks.read_model(spark, str(tmp_path / "m"))
    q = spark.createDataFrame([("x", other[20:]), ("y", "")], "rid string, seq string")
    got = {r.rid: (r.path, r.confidence) for r in classifier.classify(q, model, tree).collect()}
    assert got["x"] == ("Root;K;P;C;O;F;H;b", 1.0) and got["y"][0] == "Root;K;P;C;O;F"


def test_a_run_from_files(spark, tmp_path):
    """Everything from dumps, a package, a flat file and own records to files, with a target and aligned output."""
    line = lambda *x: "\t|\t".join(map(str, x)) + "\t|\n"
    fill = ["", "0", "1", "5", "1", "5", "1", "0", "0", "", "11", "0", "0", "", "0"]
    (tmp_path / "nodes.dmp").write_text("".join(line(i, p or i, r, *fill) for i, p, r in NODES))
    (tmp_path / "names.dmp").write_text("".join(line(i, n, "", c) for i, n, c in NAMES))
    cols = "processid taxid kingdom phylum class order family genus species marker_code nuc nuc_basecount sequence_run_site identification_method".split()
    bold = [("P1", 70, "None", "None", "None", "Ordo", "Aidae", "Aus", "Aus bus", "COI-5P", BASE, 300, "Lab", "Morphology"), ("P2", 71, "None", "None", "None", "None", "Cidae", "Cus", "Cus dus", "COI-5P", BASE, 300, "Lab", "Morphology")]
    (tmp_path / "bold").mkdir()
    (tmp_path / "bold" / "BOLD_Public.tsv").write_text("\n".join("\t".join(map(str, r)) for r in [cols, *bold]) + "\n")
    flat = lambda acc, tax, s: f"LOCUS       {acc}\nVERSION     {acc}.1\nFEATURES\n     /db_xref=\"taxon:{tax}\"\nORIGIN\n        1 {s.lower()}\n//\n"
    (tmp_path / "gb").write_text(flat("AB1", 7, BASE[3:]) + flat("AB2", 8, BASE) + flat("AB3", 7, "ACGT"))
    (tmp_path / "own.fasta").write_text(f">ZZ|9;Life;Phy;Cla;Ordo;Aidae;Aus;Aus cus\n{BASE[:200]}TTT{BASE[200:]}\n")
    inputs = {k: str(tmp_path / v) for k, v in (("nodes", "nodes.dmp"), ("names", "names.dmp"), ("bold", "bold"), ("genbank", "gb"), ("internal", "own.fasta"))}
    p = Params(target_taxon="Aidae", aligned_output=True, compressed_output=True, key_species=("Aus bus",), train_idtaxa=True, cluster_threshold=0.9)
    out = plan.run(spark, inputs, p, str(tmp_path / "out"))
    assert {(r.source, r.n_seqs) for r in out.source_counts.collect()} == {("bold", 1), ("genbank", 1), ("internal", 1)}
    records = {r.seqid: (r.taxid, r.family, r.fate) for r in out.records.collect()}
    assert records["P1"][1] == "Aidae" and set(records) == {"P1", "AB1.1", "ZZ"}
    final = X.read_fasta(spark, str(tmp_path / "out" / "final")).collect()
    assert len({len(r.seq) for r in final}) == 1 and all(";Root;" in r.name for r in final) and {r.seq.replace("-", "") for r in final} == {BASE, BASE[:200] + "TTT" + BASE[200:]}
    assert all((tmp_path / "out" / n).exists() for n in ("records", "fate_summary", "taxa_summary", "source_counts", "key_species", "idtaxa"))
    with pytest.raises(ValueError):
        plan.run(spark, {"nodes": inputs["nodes"], "names": inputs["names"]}, Params())
