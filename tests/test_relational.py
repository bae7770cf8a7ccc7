from pyspark.sql import functions as F

from curaspark.functions.text import RANKS
from curaspark.operators import classifier, filters, ingest, reporting, translation

LIN = ", ".join(f"{r} string" for r in RANKS)
SYN = "synonym string, tax_name string, rank string, parent_taxon string, grandparent_taxon string"


def test_synonyms_go_down_the_ranks_and_never_multiply(spark):
    syn = spark.createDataFrame([
        ("Oldorder", "Neworder", "order", "C", "P"), ("Oldfam", "Newfam", "family", "Neworder", "C"), ("Oldfam", "Newfam", "family", "Neworder", "C"), ("Oldgen", "Newgen", "genus", "Otherfam", "Neworder"),
        ("Nullphyl", "Newphyl", "phylum", None, None),
    ], SYN)
    df = spark.createDataFrame([
        ("K", "P", "C", "Oldorder", "Oldfam", "Oldgen", None), ("K", "P", "C", "X", "Oldfam", None, None), (None, "Nullphyl", "None", None, None, None, None), ("K", "P", "C", "O", "F", "Cus", "Aus bus"), ("K", "P", "C", "O", "F", "Aus", "Aus bus"),
    ], LIN).coalesce(1)
    a, b, c, d, e = ingest.resolve_synonyms(df, syn).collect()
    assert (a.order_name, a.family, a.genus, a.family_old) == ("Neworder", "Newfam", "Oldgen", "Oldfam")
    assert (b.family, b.family_old) == ("Oldfam", None) and (c.phylum, c.class_name) == ("Newphyl", None)
    assert (d.genus, d.genus_old) == ("Aus", "Cus") and (e.genus, e.genus_old) == ("Aus", None)


def test_match_is_null_safe(spark):
    parents = spark.createDataFrame([(1, "kingdom", "K", None, None, "K", None), (2, "phylum", "P", "K", None, "K", "P"), (3, "phylum", "P", "L", None, "L", "P")], "tax_id int, rank string, tax_name string, parent_taxon string, grandparent_taxon string, kingdom string, phylum string")
    parents = parents.select("*", *[F.lit(None).cast("string").alias(r) for r in RANKS[2:]])
    df = spark.createDataFrame([(10, "K", "P"), (11, "K", None), (12, None, None), (13, "Z", "P")], "bold_taxid int, kingdom string, phylum string").select("*", *[F.lit(None).cast("string").alias(r) for r in RANKS[2:]])
    got = {r.bold_taxid: (r.taxid, r.kingdom, r.species) for r in ingest.match_lineage(ingest.identified(df), parents).collect()}
    assert got == {10: ("NCBI:2", "K", "Unclassified"), 11: ("NCBI:1", "K", "Unclassified"), 12: ("BOLD:12", "Unclassified", "Unclassified"), 13: ("BOLD:13", "Z", "Unclassified")}


def test_extraction_rules(spark):
    base = dict(processid="p", bold_taxid=1, marker_code="COI-5P", nuc="AC-GT", nuc_basecount=150, sequence_run_site="Lab", identification_method="Morphology", genus="Aus", family="F")
    rows = [base, base, base | {"sequence_run_site": None}, base | {"sequence_run_site": "Mined from GenBank"}, base | {"nuc": None}, base | {"processid": "q", "sequence_run_site": "None"}, base | {"processid": "r", "nuc_basecount": 99}, base | {"processid": "s", "genus": "Bus", "family": "G"}]
    kind = "processid string, bold_taxid int, marker_code string, nuc string, nuc_basecount int, sequence_run_site string, identification_method string, genus string, family string"
    df = spark.createDataFrame([tuple(r.values()) for r in rows], kind).withColumns({r: F.lit("x") for r in ("kingdom", "phylum", "class_name", "order_name", "species")})
    targets = spark.createDataFrame([("Aus", "genus"), ("F", "family"), ("Aus", "genus"), (None, "genus")], "name string, rank string")
    got = ingest.extract_bold(df, targets).collect()
    assert sorted((r.processid, r.nuc) for r in got) == [("p", "ACGT"), ("q", "ACGT")]


def test_consensus_needs_a_share(spark):
    def run(taxa, confidence=0.8):
        df = spark.createDataFrame([("c", f"s{i}", t) for i, t in enumerate(taxa)], "cluster string, seqid string, genus string")
        return sorted(r.seqid for r in filters.mixed_clusters(df, "cluster", "seqid", "genus", confidence, "all").collect())

    assert run("AAAAB") == ["s4"] and run("AAAB") == [] and run("AB") == [] and run("AABB", 0.5) == []
    assert run(["A", "A", "A", "A", "B", "Unclassified", None]) == ["s4"] and run([]) == []


def test_removal_is_by_equal_ids(spark):
    rows = [(f"AB1.{i}", "A") for i in range(1, 5)] + [("AB1.10", "A"), ("AB1", "B")]
    df = spark.createDataFrame(rows, "seqid string, genus string")
    out = filters.filter_tax_outliers(df, df.select("seqid", F.lit("c").alias("cluster")), ("genus",), 0.8)
    assert {r.seqid for r in out.filter("fate is not null").collect()} == {"AB1"}


def test_selection(spark):
    rows = [("a", "S", "AC-GT", "bold"), ("b", "S", "ACGTA", "bold"), ("c", "S", "ACGTC", "internal"), ("d", "S", "ACGTC", "bold"), ("e", "Unclassified", "A", "bold"), ("f", "Unclassified", "C", "bold"), ("g", None, None, "bold")]
    df = spark.createDataFrame(rows, "rid string, species string, seq string, source string").withColumns({r: F.lit("x") for r in RANKS[:-1]})
    keep = lambda **k: {r.rid for r in filters.select_final(df, **k).filter("fate is null").collect()}
    assert keep() == {"c", "e", "f", "g"} and keep(max_group_size=2) == {"b", "c", "e", "f", "g"}
    assert len(keep(method="random", seed=3)) == 4 and "c" in keep(method="random", seed=3)


def test_reports_on_an_empty_table(spark):
    df = spark.createDataFrame([], LIN + ", fate string, taxid string, name string")
    assert {r.retained for r in reporting.fate_summary(df).collect()} == {0}
    assert reporting.key_species_summary(df, ["Aus  bus", "72"]).select("species", "final_database").collect() == [("Aus bus", 0), ("72", 0)] and reporting.taxa_summary(df).count() == 0


def test_codes_by_lineage(spark):
    g = spark.createDataFrame([(1, "K", "P", "C", "O", "F", "G", "G a", "1", "5"), (2, "K", "P", "C", "O", "F", "H", "H b", "1", "2"), (3, "K", "P", "C", "O", "F", "G", "Unclassified", "1", "4")], "tax_id int, " + LIN + ", gencode string, mtgencode string").withColumns({"plgencode": F.lit("11"), "hdgencode": F.lit(None).cast("string")})
    rows = [("NCBI:2",) + ("K", "P", "C", "O", "F", "G", "G a"), ("BOLD:1", "K", "P", "C", "O", "F", "G", "G a"), ("NCBI:99", "K", "P", "C", "O", "F", "H", "x"), ("BOLD:2", "Z", *["Unclassified"] * 6), ("BOLD:3", "K", "P", *["Unclassified"] * 5)]
    got = translation.assign_codes(spark.createDataFrame(rows, "taxid string, " + LIN), g).collect()
    assert {r.taxid: (r.mtgencode, r.rank_matches, r.match_tax_id) for r in got} == {"NCBI:2": ("2", None, 2), "BOLD:1": ("5", 7, 1), "NCBI:99": ("2", 6, 2), "BOLD:2": (None, None, None), "BOLD:3": ("5", 2, 1)}


def test_classifier(spark):
    import random

    rng = random.Random(1)
    base = {s: "".join(rng.choice("ACGT") for _ in range(300)) for s in "abcd"}
    mutate = lambda s: "".join(rng.choice("ACGT") if rng.random() < 0.02 else c for c in s)
    rows = [(f"{s}{i}", "K", "P", "C", "O", "F", "G" if s < "c" else "H", s, mutate(base[s])) for s in base for i in range(6)]
    df = spark.createDataFrame([*rows, ("wrong", "K", "P", "C", "O", "F", "H", "d", mutate(base["a"]))], "rid string, " + LIN + ", seq string")
    model, problems, _ = classifier.train(df, max_group_size=10, max_iterations=2)
    assert {r.id for r in problems.collect()} == {"wrong"}
    got = classifier.classify(spark.createDataFrame([("x", mutate(base["b"])), ("y", mutate(base["d"]))], "rid string, seq string"), model, classifier.tree_children(df)).collect()
    assert {r.rid: r.path.split(";")[-1] for r in got} == {"x": "b", "y": "d"}
