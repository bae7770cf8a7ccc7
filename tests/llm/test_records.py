import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from curaspark.functions.text import RANKS
from curaspark.llm import canonical, capping, truth

LINEAGE = "row_id bigint, seqid string, taxid string, " + ", ".join(f"{r} string" for r in RANKS) + ", source string, quality double, loaded_at timestamp"
#: Names that the operators use themselves.
CLASH = ["acc", "tax", "who", "key", "n", "filled", "trust", "n_rows", "value", "field", "tax_name", "cut", "need"]
T0 = datetime(2020, 1, 1)


def lineage(spark, rows):
    df = spark.createDataFrame(rows, LINEAGE)
    return df.withColumns({c: F.lit("clash") for c in CLASH})


def row(i, seqid, taxid, ranks=("K",) * 7, source="bold", q=50.0, day=0):
    return (i, seqid, taxid, *ranks, source, q, None if day is None else T0 + timedelta(days=day))


def trust(spark, pairs=(("internal", 40), ("genbank", 30), ("bold", 10))):
    return spark.createDataFrame(list(pairs), "source string, trust int")


@pytest.mark.parametrize(
    ("writing", "want"),
    [("KD6152248.1", "KD6152248"), ("kd 6152248", "KD6152248"), ("gb:KD6152248.2 ", "KD6152248"), ("KD615​2248", "KD6152248"), ("KD６１５２２４８.１", "KD6152248"), ("KD615224O.1", "KD6152240"), ("KDO152248", "KD0152248"),
     ("RFHDG57811–17", "RFHDG5781117"), ("RFHDG57811_17.COI-5P", "RFHDG5781117"), ("BOLD:RFHDG578I1 - 17", "RFHDG5781117"), ("LAB 21 654442O11\t", "LAB21654442011"), ("lab-21-654442011", "LAB21654442011"), ("", None), (" . ", None), (None, None)],
)
def test_accessions(spark, writing, want):
    df = spark.createDataFrame([(writing,)], "s string")
    assert df.select(truth.accession(F.col("s"))).first()[0] == want


@pytest.mark.parametrize(("writing", "want"), [("NCBI:00048175", "NCBI:48175"), ("bold：12 ", "BOLD:12"), ("INTERNAL: 5", "INTERNAL:5"), ("taxon:9", "NCBI:9"), ("txid9", "NCBI:9"), ("9", "NCBI:9"), ("ncbi_9", "NCBI:9"), ("x", None), ("", None), (None, None)])
def test_taxa(spark, writing, want):
    assert spark.createDataFrame([(writing,)], "s string").select(truth.taxon(F.col("s"))).first()[0] == want


def test_dominating_rows_by_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        ranks = [rng.choice(["X", "Y", None, "None", " "]) for _ in RANKS]
        rows.append(row(i, rng.choice([f"AB000000{k}.{i % 3}" for k in range(9)] + [None]), rng.choice(["NCBI:1", "taxon:01", "BOLD:1", None]), ranks, rng.choice(["bold", "genbank", "mito", None]), day=rng.randrange(6)))
    table = dict(bold=10, genbank=30)
    groups = defaultdict(list)
    for r in rows:
        if r[1] and r[2]:
            filled = sum(x is not None and x.strip().lower() not in ("", "none", "unclassified") for x in r[3:10])
            groups[r[1].split(".")[0], r[2].replace("taxon:0", "NCBI:")].append((r[0], (filled, r[12], table.get(r[10], -1))))
    want = {i for g in groups.values() if len(g) > 1 for i, a in g if all(all(x >= y for x, y in zip(a, b)) and a != b for j, b in g if j != i)}
    out = truth.survivors(lineage(spark, rows), trust(spark, list(table.items()))).collect()
    assert want and {r.representative_row_id for r in out if r.dominates} == want
    assert sum(r.n_rows for r in out) == len(rows) and len({(r.acc, r.tax) for r in out if r.acc and r.tax}) == len(groups)


def test_truth_is_voted_and_weighted(spark):
    rows, i = [], 0
    # genbank is nearly always right where bold and internal differ, so it wins a tie of one against one in the last record
    for k in range(40):
        for source, value in (("genbank", "Right"), ("mito", "Right"), ("bold", "Wrong" if k % 4 else "Right")):
            i += 1
            rows.append(row(i, f"AB{k:07d}", "1", ("K", "P", "C", "O", value, "G", None), source))
    rows += [row(900, "ZZ0000001", "1", ("K", None, "C", "O", "Bad", "G", None), "bold", day=9), row(901, "ZZ0000001", "1", ("K", "P", "C", "O", "Good", "G", "s"), "genbank")]
    out = {r.acc: r for r in truth.survivors(lineage(spark, rows), trust(spark, [("bold", 40), ("genbank", 10), ("mito", 10)])).collect()}
    assert all(out[f"AB{k:07d}"].family == "Right" for k in range(40))
    z = out["ZZ0000001"]
    # the values are voted on one by one; as a row the later one of the more trusted source outvotes the complete one
    assert z.family == "Good" and z.phylum == "P" and z.species == "S" and z.n_rows == 2 and z.representative_row_id == 900 and not z.dominates


def test_survivors_of_odd_tables(spark):
    assert truth.survivors(lineage(spark, []), trust(spark)).count() == 0
    rows = [row(1, None, None, (None,) * 7, None, None, None), row(2, "AB0000001", None), row(3, "AB0000001", "1", (None,) * 7, day=None), row(4, "AB0000001", "1", (None,) * 7, day=None)]
    out = truth.survivors(lineage(spark, rows), trust(spark, [])).collect()
    assert sorted(r.n_rows for r in out) == [1, 1, 2] and not any(r.dominates for r in out)
    copies = [row(i, "AB0000001", "1") for i in range(50)]
    (r,) = truth.survivors(lineage(spark, copies), trust(spark)).collect()
    assert r.n_rows == 50 and r.representative_row_id == 0 and not r.dominates


def brute_cap(rows, who, cap):
    groups = defaultdict(list)
    for r in rows:
        if (w := who(r)) is not None:
            q = r[11]
            groups[w].append((-(q if q is not None and q == q and 0 <= q <= 100 else -1.0), r[0]))
    return {i for g in groups.values() if len(g) > cap for _, i in sorted(g)[:cap]}, {i for g in groups.values() for _, i in sorted(g)[cap:]}


@pytest.mark.parametrize("offset", [0, -40, 2**40])
def test_cap_by_brute_force(spark, offset):
    rng = random.Random(2)
    values = [None, float("nan"), -1.0, 999.0, 0.0, -0.0, 100.0, 55.5] + [round(rng.random() * 100, 2) for _ in range(40)] + [rng.random() * 100 for _ in range(40)]
    rows = [row(i + offset, "a", "b", ("K",) * 6 + (rng.choice(["Aa bb"] * 6 + ["Cc dd", "Ee ff", None, "Aa sp.", "aa_bb"]),), q=rng.choice(values)) for i in range(400)]
    who = lambda r: None if r[9] is None or "." in r[9] else r[9].lower().replace("_", " ")
    df = lineage(spark, rows)
    kept, dropped = capping.over_cap(df, capping.species_key(F.col("species"), F.col("genus")), "row_id", F.col("quality"), 7)
    a, b = brute_cap(rows, who, 7)
    assert {r.row_id for r in kept.collect()} == a and {r.row_id for r in dropped.collect()} == b
    out = capping.capped(df, capping.species_key(F.col("species"), F.col("genus")), "row_id", F.col("quality"), 7)
    assert {r.row_id for r in out.collect()} == {r[0] for r in rows} - b and set(out.columns) == set(df.columns)


def test_cap_with_equal_scores_and_without_broadcast(spark, monkeypatch):
    from curaspark import session

    monkeypatch.setattr(session.lookup_join, "__defaults__", ("inner", None, 0))
    rows = [row(i, "a", "b", ("K",) * 6 + ("Aa bb",), q=5.0) for i in range(90)] + [row(100 + i, "a", "b", ("K",) * 6 + ("Aa cc",), q=None) for i in range(9)]
    kept, dropped = capping.over_cap(lineage(spark, rows), F.lower("species"), "row_id", F.col("quality"), 5)
    assert {r.row_id for r in kept.collect()} == {0, 1, 2, 3, 4, 100, 101, 102, 103, 104} and dropped.count() == 89


def test_cap_of_odd_tables(spark):
    key = capping.species_key(F.col("species"), F.col("genus"))
    kept, dropped = capping.over_cap(lineage(spark, []), key, "row_id", F.col("quality"), 3)
    assert kept.count() == 0 and dropped.count() == 0
    few = lineage(spark, [row(1, None, None, (None,) * 7, q=None), row(2, "a", "b")])
    kept, _ = capping.over_cap(few, key, "row_id", F.col("quality"), 3)
    assert kept.count() == 0 and capping.capped(few, key, "row_id", F.col("quality"), 3).count() == 2


@pytest.mark.parametrize(
    ("species", "genus", "want"),
    [("Aa bb", "X", "aa bb"), (" AA  BB ", None, "aa bb"), ("<i>Aa bb</i>", None, "aa bb"), ("Aa (Aa) bb", None, "aa bb"), ('"Aa bb"', None, "aa bb"), ("Aa+bb", None, "aa bb"), ("bb", " AA", "aa bb"), ("bb", "None", None), ("Aa", "aa", None),
     ("Aa sp. 3", "Aa", None), ("Aa b2", "Aa", None), ("Unclassified", "Aa", None), (" none", "Aa", None), ("", "Aa", None), (None, "Aa", None)],
)
def test_species_keys(spark, species, genus, want):
    df = spark.createDataFrame([(species, genus)], "s string, g string")
    assert df.select(capping.species_key(F.col("s"), F.col("g"))).first()[0] == want


def test_long_lists_are_joined(spark):
    """The table of deletions gives what the broadcast dictionary gives."""
    syn = spark.createDataFrame([(a, b, "family", c) for a, b, c in NAMES], "synonym string, tax_name string, rank string, parent_taxon string")
    values = ["hukoriidae", "Hukoriidae", "Hukor.", "Qoutahtruidae", "Oldidae", "Quothatruidae / Hukoriidae", "Quothatruidae / Xestyvijoidae", "pravetroidae", "zzz", "", None, "Huk0r11dae", "x" * 50_000] + ["hukoriids"] * 3000
    rows = [(i, v, p) for i, v in enumerate(values) for p in ((None, "O1", "o2 ") if i < 20 else (None,))]
    df = spark.createDataFrame(rows, "i int, family string, order_name string")
    key = lambda r: (r.i, r.tax_name or "", r.status)
    small, large = ([*map(key, canonical.mapped(df, syn, "i", "family", "order_name", most=m).collect())] for m in (10**6, 1))
    assert sorted(small) == sorted(large) and len(small) == len(rows)
    assert canonical.mapped(df.limit(0), syn, "i", "family", "order_name", most=1).count() == 0


def discovered(votes, trusts):
    """Truth discovery of truth.reliability() over {field: {value: {source: n}}} in plain Python; values tie to the greatest."""
    import math

    total = defaultdict(int)
    for field in votes.values():
        for by in field.values():
            for s, n in by.items():
                total[s] += n
    most = max([*trusts.values(), 1])
    prior = {s: 0.95 * trusts.get(s, 0) / most for s in total}
    weights, met = {s: 1 + 0.1 * p for s, p in prior.items()}, []
    while True:
        best = {f: max((round(sum(n * weights[s] for s, n in by.items()), 9), v) for v, by in values.items())[1] for f, values in votes.items()}
        if best in met:
            return weights, best
        met.append(best)
        agree = defaultdict(int)
        for f, v in best.items():
            for s, n in votes[f][v].items():
                agree[s] += n
        weights = {s: -math.log(min(max((total[s] - agree[s] + truth.PRIOR_CLAIMS * (1 - prior[s])) / (total[s] + truth.PRIOR_CLAIMS), 1e-6), 0.999)) for s in total}


def test_truth_discovery_over_many_sources(spark):
    """300 sources, none left out, by brute force."""
    rng = random.Random(7)
    good = {f"s{i}": rng.random() for i in range(300)}
    rows = [row(10 * k + j, f"AB{k:07d}", "1", ("K", "P", "C", "O", "Fam" if rng.random() < good[s] else rng.choice(["Gam", "Ham"]), "G", "s"), s) for k in range(250) for j, s in enumerate(rng.sample(list(good), 9))]
    votes = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
    for r in rows:
        votes[r[1]][r[7]][r[10]] += 1
    votes = {f: v for f, v in votes.items() if len(v) > 1}
    trusts = {s: rng.randrange(1, 50) for s in list(good)[:200]}
    weights, best = discovered(votes, trusts)
    out = {r.acc: r for r in truth.survivors(lineage(spark, rows), trust(spark, list(trusts.items()))).collect()}
    assert {f: out[f].family for f in best} == best and len(best) > 200
    flat = [(f, "1", 4, v, s, n, T0) for f, vs in votes.items() for v, by in vs.items() for s, n in by.items()]
    df = spark.createDataFrame(flat, "acc string, tax string, field int, value string, source string, n bigint, last timestamp")
    got, _ = truth.reliability(df, truth._trusts(trust(spark, list(trusts.items()))))
    got = {r.source: r.weight for r in got.collect()}
    assert len(got) == 300 and all(abs(got[s] - w) < 1e-9 for s, w in weights.items())


def test_representatives_come_by_learned_weights(spark):
    """A criterion that mostly agrees with the others outvotes one that mostly doesn't, though a plain vote would tie."""
    kinds = {1 << 7: 500, 1 << 3 | 1 << 4: 400, 1 << 2 | 1 << 1: 30}  # first two against the third; second alone against first alone
    w = truth.criteria_weights(kinds)
    assert min(w) > 0 and w[0] > w[2] and w[1] > w[2]
    assert truth.criteria_weights({}) == [1.0] * 3
    rows = [row(100 + k, f"AB{k:07d}", "1", ("K",) * 7, "genbank", day=5) for k in range(60)] + [row(200 + k, f"AB{k:07d}", "1", ("K",) * 6 + (None,), "bold", day=1) for k in range(60)]
    # in the last record the complete row is older and of less trust
    rows += [row(900, "ZZ0000001", "1", ("K",) * 7, "bold", day=1), row(901, "ZZ0000001", "1", ("K",) * 6 + (None,), "genbank", day=5)]
    out = {r.acc: r for r in truth.survivors(lineage(spark, rows), trust(spark)).collect()}
    assert out["AB0000001"].dominates and out["AB0000001"].representative_row_id == 101
    assert out["ZZ0000001"].representative_row_id == 901 and not out["ZZ0000001"].dominates


@pytest.mark.parametrize("span", [(0.0, 100.0), (0.0, 60.0), (-9.0, -1.0), (-9.0, 0.0)])
def test_scores_of_any_range_keep_their_order(spark, span):
    rng = random.Random(3)
    xs = [rng.uniform(-12, 110) for _ in range(300)] + [0.0, -0.0, -1.0, -9.0, 60.0, 100.0, float("nan"), None, 5e-324]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, q double")
    got = {r.i: r.k for r in df.select("i", capping.score_key(F.col("q"), *span).alias("k")).collect()}
    ok = [i for i, x in enumerate(xs) if x is not None and span[0] <= x <= span[1]]
    assert all(k >= 0 for k in got.values()) and all(got[i] == capping.NO_SCORE for i in got if i not in ok)
    assert all((xs[i] > xs[j]) == (got[i] < got[j]) and (xs[i] == xs[j]) == (got[i] == got[j]) for i in ok for j in ok)


def test_scores_on_both_sides_of_zero():
    with pytest.raises(ValueError):
        capping.score_key(F.col("q"), -5.0, 60.0)


def test_cap_by_share(spark):
    rows = [row(i, "a", "b", ("K",) * 6 + ("Aa bb" if i < 70 else f"Cc {chr(97 + i % 26)}",), q=float(i)) for i in range(100)]
    kept, dropped = capping.over_cap(lineage(spark, rows), F.lower("species"), "row_id", F.col("quality"), share=0.1)
    assert sorted(r.row_id for r in kept.collect()) == list(range(60, 70)) and dropped.count() == 60
    kept, _ = capping.over_cap(lineage(spark, rows), F.lower("species"), "row_id", F.col("quality"), cap=4, share=0.1)
    assert sorted(r.row_id for r in kept.collect()) == [66, 67, 68, 69]
    with pytest.raises(ValueError):
        capping.over_cap(lineage(spark, rows), F.lower("species"), "row_id", F.col("quality"))


NAMES = [("Oldidae", "Hukoriidae", "O1"), ("Oldidae", "Prepacaidae ", "O2"), ("Xestyvijoidae Tiburo, 1901", "Quothatruidae", "O2"), ("PRAVETROIIDAE", "Lovorilaidae", "O1"), (None, "Lovorilaidae", "O1")]


@pytest.fixture(scope="module")
def index():
    return canonical.NameIndex([(a, b.strip(), c) for a, b, c in NAMES])


@pytest.mark.parametrize(
    ("value", "parent", "want"),
    [("hukoriidae", None, "Hukoriidae"), ("Hukoriidae Megit, 1984", None, "Hukoriidae"), ("Hukoriidae Megit 1886", "O1", "Hukoriidae"), ("O1: Hukoriidae", None, "Hukoriidae"), ("cf. Huksriidae", None, "Hukoriidae"), ("Hukoriidae?", None, "Hukoriidae"), ("Fam.: Hukoriidae", None, "Hukoriidae"),
     ("Hukоriidае", None, "Hukoriidae"), ("Huk0r11dae", None, "Hukoriidae"), ("Huköriidae", None, "Hukoriidae"), ("Huko-riidae", None, "Hukoriidae"), ("Hu koriidae", None, "Hukoriidae"), ("hukoriids", None, "Hukoriidae"), ("hukoriid flies", None, "Hukoriidae"), ("Hukori.", None, "Hukoriidae"),
     ("Hukoriidae;Hukoriinae", None, "Hukoriidae"), ("Hukoriidæ", None, "Hukoriidae"), ("Quothatruidae / Xestyvijoidae", "O2", "Quothatruidae"), ("Quothatruidae / Hukoriidae", None, None), ("Xestyvijoidae", "O2", "Quothatruidae"), ("Xestyvijoidae", "O1", None), ("pravetroidae", None, "Lovorilaidae"),
     ("Oldidae", None, None), ("Oldidae", "O2", "Prepacaidae"), ("Qoutahtruidae", None, "Quothatruidae"), ("unknown", None, None), ("?", None, None), ("000", None, None), ("Zestaphooidea", None, None), ("x" * 100_000, None, None), ("", None, None)],
)
def test_meant_names(index, value, parent, want):
    assert index.look(value, parent) == want


def test_candidates_are_all_within_the_bound(index):
    """Symmetric deletes find every listed word within two edits."""
    rng = random.Random(4)
    for word in [e[0] for e in index.entries] * 15:
        w = list(word)
        for _ in range(2):
            p = rng.randrange(len(w))
            what = rng.randrange(4)
            if what == 0:
                del w[p]
            elif what == 1:
                w.insert(p, rng.choice("abcdefghij"))
            elif what == 2:
                w[p] = rng.choice("abcdefghij")
            elif p:
                w[p - 1], w[p] = w[p], w[p - 1]
        form = "".join(w)
        if canonical.weighted_distance(form, word)[0] <= 2:
            near = {index.entries[i][0] for d in canonical.deletions(canonical.key(form), 2) for i in index.deletes.get(d, ())}
            assert word in near


@pytest.mark.parametrize(("a", "b", "edits"), [("abc", "abc", 0), ("abc", "acb", 1), ("abc", "ab", 1), ("abc", "abbc", 1), ("abc", "axc", 1), ("", "ab", 2), ("kitten", "sitting", 3)])
def test_distance(a, b, edits):
    n, cost = canonical.weighted_distance(a, b)
    assert n == edits and cost <= edits and canonical.weighted_distance(b, a)[0] == edits


def test_every_name_comes_by_the_dictionary(index):
    """No route beside symmetric deletes: with an empty dictionary nothing is found, with it endings, cut ends and scanned letters are."""
    assert index.look("hukoriids", None) == index.look("Hukor.", None) == index.look("hukorlldae", None) == "Hukoriidae"
    import pickle

    empty = pickle.loads(pickle.dumps(index))
    empty.deletes.clear()
    assert all(empty.look(v, None) is None for v in ("hukoriids", "Hukor.", "hukorlldae", "Huksriidae", "hukoriidae"))


def test_costs_are_bounded():
    assert canonical.accepted("abcdefgh", "abcdxxgh") == 2.0 and canonical.accepted("abcdef", "abxxef") is None  # 2 of 6 letters are more than a quarter
    assert canonical.accepted("abcdefgh", "xxxdefgh") is None
    assert canonical.accepted("hukor", "hukoriidae") == canonical.CUT_COST


@pytest.mark.parametrize(("often", "want"), [((1, 1), None), ((2, 1), "Bexidae"), ((1, 3), "Boxidae")])
def test_frequency_decides_ties(often, want):
    """Two names are equally near; the one listed more often is meant, and none where they are listed alike."""
    rows = [(None, "Bexidae", "O")] * often[0] + [(None, "Boxidae", "O")] * often[1]
    assert canonical.NameIndex(rows).look("bxxidae", None) == want


def test_mapped_table(spark):
    syn = spark.createDataFrame([(a, b, "Family ", c, None) for a, b, c in NAMES] + [("g", "Gg", "genus", "Hukoriidae", None)], "synonym string, tax_name string, rank string, parent_taxon string, grandparent_taxon string")
    rows = [(1, "Hukoriidae", "O1"), (2, "hukoriidae ", None), (3, "hukoriidae ", "None"), (4, None, "O1"), (5, "None", "O1"), (6, "junk", "O1"), (7, "Hukoriidae ", "o1 "), (8, "Hukoriidae", "O2")]
    df = spark.createDataFrame([(*r, "c", "c", "c") for r in rows], "i int, family string, order_name string, tax_name string, status string, synonym string")
    got = {r.i: (r.tax_name, r.status) for r in canonical.mapped(df, syn, "i", "family", "order_name").collect()}
    h = "Hukoriidae"
    by_tables = {r.i: (r.tax_name, r.status) for r in canonical.mapped(df, syn, "i", "family", "order_name", most=1).collect()}
    assert by_tables == got
    assert got == {1: (h, "exact"), 2: (h, "mapped"), 3: (h, "mapped"), 4: (None, "missing"), 5: (None, "missing"), 6: (None, "unmatched"), 7: (h, "mapped"), 8: (h, "exact")}
    assert canonical.mapped(df.limit(0), syn, "i", "family", "order_name").count() == 0
    assert {r.status for r in canonical.mapped(df, syn.limit(0), "i", "family", "order_name").collect()} == {"missing", "unmatched"}
