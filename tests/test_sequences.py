import itertools
import math
import os
import random
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from curaspark.functions import seq as Q
from curaspark.operators import filters, primers, profiles, similarity, translation


def col(spark, c, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "s string").select(c(F.col("s"))).collect()]


def test_revcomp_and_cleaning(spark):
    assert col(spark, Q.revcomp, "AACGTR", "acgn-", None) == ["YACGTT", "-ncgt", None]
    assert col(spark, Q.clean_dna, "ac-g.uX", "") == ["ACGTN", ""]
    assert col(spark, Q.is_ambiguous, "acgt", "acgn", "ACGU", None) == [False, True, True, None]


def test_translation(spark):
    assert col(spark, lambda s: Q.translated(s, 1), "ATGTARTAA", "TTYNNNTG", "", None, "AC") == ["M**", "FX", "", None, ""]
    assert col(spark, lambda s: Q.translated(s, 5), "AGAATA") == ["SM"]
    assert col(spark, lambda s: Q.translated(s, F.lit(99)), "ATG") == [None]
    assert [len(set(t)) <= 21 and len(t) == 64 for t in Q.GENETIC_CODES.values()] == [True] * len(Q.GENETIC_CODES)


def test_frames_and_stops(spark):
    df = spark.createDataFrame([("n", "ATGTAACC"), ("n", "ATGTAACC")], "name string, seq string")
    got = {r.frame: (r.frame_seq, r.protein, r.stops) for r in translation.frames(df, "seq", 1).collect()}
    assert got[1] == ("ATGTAA", "M*", [2]) and got[2] == ("TGTAAC", "CN", []) and got[-1] == ("GGTTAC", "GY", []) and len(got) == 6


def test_reading_frame_rules(spark):
    # free of stops in one, several and no forward frame
    df = spark.createDataFrame([(0, "ATGATGATGA"), (1, "TAATTGATTGA"), (2, None), (3, "A")], "i int, seq string")
    got = {r.i: r.reading_frame for r in translation.reading_frames(df, "seq", 1, draws="remove").collect()}
    assert got[2] is None and got[3] is None and set(got) == {0, 1, 2, 3}


def test_jukes_cantor(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.75,)], "p double")
    a, b, c = (r[0] for r in df.select(Q.jukes_cantor(F.col("p"))).collect())
    assert a == 0 and math.isclose(b, -0.75 * math.log(0.6)) and c == float("inf")


def test_aligned_distances():
    enc = lambda *s: filters._CODE[np.array([np.frombuffer(x.encode(), np.uint8) for x in s])]
    x = enc("--ACGTACGT", "TTACGAACGT", "--ACG-ACGT", "--ACGNACGT")
    d = filters.aligned_distances(x, x)
    jc = lambda p: -0.75 * math.log(1 - 4 * p / 3)
    assert d[0, 0] == 0 and math.isclose(d[0, 1], jc(1 / 8), rel_tol=1e-5) and math.isclose(d[0, 2], jc(1 / 8), rel_tol=1e-5) and d[0, 3] == 0


def test_weighted_medians():
    rng = np.random.default_rng(1)
    d, w = rng.random((5, 9)), rng.integers(1, 5, 9)
    assert np.allclose(filters.weighted_medians(d, w), [np.median(np.repeat(r, w)) for r in d])


def test_centres_in_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 2, rng.random(3).tolist(), int(rng.integers(1, 4))) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, g int, v array<double>, w int")
    got = {r.g: r.centre for r in filters.centres(df, ["g"], "k", "v", "w", "vector", block=7).collect()}
    for g in (0, 1):
        own = [r for r in rows if r[1] == g]
        med = {a[0]: np.median(np.repeat([sum((x - y) ** 2 for x, y in zip(a[2], b[2])) for b in own], [b[3] for b in own])) for a in own}
        assert got[g] == min(med, key=lambda k: (round(med[k], 12), k))


def test_absorbed_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    base = "".join(rng.choice(list("ACGT"), 200))
    seqs = [base[3:35], base[7:38], base[:31], base[100:131] + base[140:171], base, base, base[10:120], base[20:60], base[30:40], "", "ACGT" * 20, None, base[:199] + "N", base[5:45]] + ["".join(rng.choice(list("ACGT"), 50)) for _ in range(5)]
    rows = [(i, "a" if i % 7 else None, s) for i, s in enumerate(seqs)]
    got = {r.k: (r["count"], r.absorbed_by) for r in filters.absorbed(spark.createDataFrame(rows, "k int, g string, s string"), ["g"], "k", "s").collect()}
    assert set(got) == set(range(len(rows)))
    for k, g, s in rows:
        own = [(i, t) for i, h, t in rows if h == g and t is not None]
        if s is None:
            assert got[k] == (1, None)
            continue
        first = min(i for i, t in own if t == s)
        over = sorted((-len(t), i) for i, t in own if s in t and t != s)
        want = over[0][1] if over else (None if first == k else first)
        if want is not None and over:
            want = min(i for i, t in own if t == dict(own)[want])
        assert got[k][1] == want
    assert sum(c for c, _ in got.values() if c) == len(rows)


def test_pairs_with_gaps_are_aligned():
    """Identity near a diagonal, by a plain recurrence over all cells."""
    rng = np.random.default_rng(8)
    pairs = []
    for _ in range(40):
        a = "".join(rng.choice(list("ACGT"), 120))
        x = list(a)
        for _ in range(int(rng.integers(0, 4))):
            p = int(rng.integers(0, len(x)))
            x[p : p + int(rng.integers(0, 3))] = rng.choice(list("ACGT"), int(rng.integers(0, 3))).tolist()
        cut = int(rng.integers(0, 20))
        pairs.append((a, "".join(x)[cut:], -cut))

    def plain(a, b):
        v = [[(0, 0, 0)] * (len(b) + 1) for _ in range(len(a) + 1)]
        top = (0, 0, 0)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                hit = a[i - 1] == b[j - 1]
                moves = [(v[i - 1][j - 1], 1 if hit else -1, hit)] + [(v[i - 1][j], -2, 0)] * (i > 1) + [(v[i][j - 1], -2, 0)] * (j > 1)
                v[i][j] = max((p[0] + s, p[1] + m, p[2] + 1) for p, s, m in moves)
                if i == len(a) or j == len(b):
                    top = max(top, v[i][j])
        return top[1] / top[2]

    got, _ = similarity.banded_identity([p[0] for p in pairs], [p[1] for p in pairs], [p[2] for p in pairs])
    assert np.allclose(got, [plain(a, b) for a, b, _ in pairs])


def test_components_by_brute_force(spark):
    rng = np.random.default_rng(9)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5001 + i) for i in range(50)]
    root = {x: x for e in edges for x in e}
    while True:
        new = dict(root)
        for a, b in edges:
            new[a] = new[b] = min(new[a], new[b])
        if new == root:
            break
        root = new
    got = {r.u: r.v for r in similarity.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: r for x, r in root.items() if x != r}
    assert similarity.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_clusters_with_insertions_and_deletions(spark):
    """Records that differ from their base by inserted or deleted bases are in its cluster, whatever they have in common with others."""
    rng = np.random.default_rng(10)
    rows = []
    for b in range(8):
        base = "".join(rng.choice(list("ACGT"), 600))
        rows.append((b * 100, base))
        for j in range(1, 10):
            x = list(base)
            for p in sorted(rng.integers(50, 550, 2).tolist(), reverse=True):
                if rng.random() < 0.5:
                    del x[p : p + int(rng.integers(1, 4))]
                else:
                    x[p:p] = rng.choice(list("ACGT"), int(rng.integers(1, 4))).tolist()
            rows.append((b * 100 + j, "".join(x)))
    got = {r.member: r.representative for r in similarity.clusters(spark.createDataFrame(rows, "k int, s string"), "k", "s").collect()}
    assert all(len({got[b * 100 + j] for j in range(10)}) == 1 for b in range(8)) and len(set(got.values())) == 8


def test_clusters(spark):
    rng = np.random.default_rng(4)
    bases = ["".join(rng.choice(list("ACGT"), 400)) for _ in range(6)]
    rows = []
    for b, s in enumerate(bases):
        for j in range(8):
            x = list(s[: 400 - j * 3])
            for p in rng.integers(0, len(x), 3):
                x[p] = "ACGT"[("ACGT".index(x[p]) + 1) % 4]
            rows.append((b * 100 + j, "".join(x)))
    rows += [(900, None), (901, ""), (902, rows[0][1])]
    got = {r.member: r.representative for r in similarity.clusters(spark.createDataFrame(rows, "k int, s string"), "k", "s").collect()}
    assert set(got) == {k for k, _ in rows} and got[902] == got[0] and got[900] == 900
    parts = [{k for k in got if got[k] == r} for r in set(got.values())]
    assert all(len({k // 100 for k in p if k < 900}) <= 1 for p in parts)
    assert sum(len({got[b * 100 + j] for j in range(8)}) == 1 for b in range(6)) >= 5
    assert similarity.clusters(spark.createDataFrame([], "k int, s string"), "k", "s").count() == 0


def test_short_records_inside_a_long_one_share_its_cluster(spark):
    rng = np.random.default_rng(7)
    long = "".join(rng.choice(list("ACGT"), 8000))
    rows = [(0, long)]
    for i in range(1, 31):
        at = int(rng.integers(0, 7800))
        x = list(long[at : at + 200])
        for p in rng.choice(200, 4, replace=False):
            x[p] = "ACGT"[("ACGT".index(x[p]) + 1) % 4]
        rows.append((i, "".join(x)))
    got = {r.member: r.representative for r in similarity.clusters(spark.createDataFrame(rows, "k int, s string"), "k", "s").collect()}
    assert got == {k: 0 for k, _ in rows}


def plain_overlap(a, b):
    """Score of the best overlap alignment by the plain recurrence."""
    n, m = len(a), len(b)
    h = np.zeros((n + 1, m + 1))
    e = np.full((n + 1, m + 1), -np.inf)
    f = np.full((n + 1, m + 1), -np.inf)
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            e[i, j] = max(e[i - 1, j] - 2, h[i - 1, j] - 10)
            f[i, j] = max(f[i, j - 1] - 2, h[i, j - 1] - 10)
            h[i, j] = max(h[i - 1, j - 1] + (5 if a[i - 1] == b[j - 1] else -4), e[i, j], f[i, j])
    return max(h[n].max(), h[:, m].max())


def test_overlap_identity():
    assert similarity.overlap_identity("ACGTACGT", "ACGTACGT") == 1
    assert math.isnan(similarity.overlap_identity("", "A"))
    s = "ACGTTGCAAGGCTTAACCGGATAT"
    assert math.isclose(similarity.overlap_identity(s, s[:10] + s[12:]), 1 - 2 / 24)
    assert math.isclose(similarity.overlap_identity(s, s[:10] + "GG" + s[10:]), 1 - 2 / 26)
    assert similarity.overlap_identity(s[:15], s[5:]) == 1
    assert plain_overlap(s, s) == 120


def test_profile_search_finds_planted_domains(spark):
    rng = np.random.default_rng(5)
    letters = list(profiles.AMINO)
    base = "".join(rng.choice(letters, 60))
    p = profiles.build_profile("m", [base] * 3)
    s = profiles.Search(p)
    a = s.align("".join(rng.choice(letters, 15)) + base[5:55] + "".join(rng.choice(letters, 9)))
    # A local alignment may run on by a few letters that agree by chance.
    assert 12 <= a["ali_from"] <= 17 and 2 <= a["hmm_from"] <= 7 and 54 <= a["hmm_to"] <= 59
    assert all((at, k) in a["path"] for at, k in zip(range(18, 60), range(8, 50)))
    x = base[:30] + base[34:]
    score, post = s.forward(x)
    best = s.best([x, base[:20], "W" * 5])
    assert score >= best[0] - 1e-6 and post.sum(1).max() <= 1 + 1e-6 and best[0] > best[1] > best[2]
    df = spark.createDataFrame([(1, base), (2, "".join(rng.choice(letters, 80))), (3, None), (4, "")], "k int, p string")
    hits = profiles.search(df, "p", p, 100.0, 20.0).collect()
    assert [h.k for h in hits] == [1] and hits[0].hmm_from == 1 and hits[0].hmm_to == 60 and hits[0].acc > 0.9 and hits[0].evalue_i < 1e-10
    assert profiles.on_columns(x, s).count("-") == 4
    assert len(p.part(11, 20)) == 10


def test_profile_text_round_trip():
    p = profiles.build_profile("m", ["ACDEF", "ACD-F"])
    f = lambda v: " ".join("*" if x <= 0 else f"{-math.log(x):.5f}" for x in v)
    body = [f"COMPO {f(profiles.BACKGROUND)}", f(profiles.BACKGROUND), f(p.moves[0])]
    for i, m in enumerate(p.match, 1):
        body += [f"{i} {f(m)} {i} x - - -", f(profiles.BACKGROUND), f(p.moves[i])]
    text = "\n".join(["HMMER3/f", "NAME m", f"LENG {len(p)}", "STATS LOCAL FORWARD -4.0 0.70", "HMM  A C", "  m->m"] + body + ["//"])
    q = profiles.read_profile(text)
    assert q.stats == (-4.0, 0.70) and np.allclose(q.match, p.match, atol=1e-4) and np.allclose(q.moves, p.moves, atol=1e-4)


def test_primers():
    assert primers.expanded("AYT") == ["ACT", "ATT"] and len(primers.expanded("NNI")) == 64
    with pytest.raises(ValueError):
        primers.expanded("N" * 20)
    rng = np.random.default_rng(6)
    dna = "".join(rng.choice(list("ACGT"), 180))
    while "*" in (prot := Q.protein_of(dna.encode(), 1).decode()):
        dna = dna.replace("TAA", "TCA").replace("TAG", "TCG").replace("TGA", "TCA")
    fwd, rev = dna[30:48], dna[120:141].translate(str.maketrans("ACGT", "TGCA"))[::-1]
    for a, b in ((fwd, rev), (rev, fwd)):
        rows, info, (first, last) = primers.trim_seed([prot] * 4, a, b, 1, 3, 6)
        assert (first, last) == (11, 47) and rows[0] == prot[10:47] and info["offset_start"] == 0 and info["offset_end"] == 0
        assert (info["plen_start"], info["plen_end"]) == (18, 21) and (info["pad_start"], info["pad_end"]) == ((3, 6) if a == fwd else (6, 3))
    with pytest.raises(ValueError):
        primers.trim_seed([prot] * 2, fwd, fwd, 1)


def test_kmer_distance_against_counts(spark):
    from collections import Counter

    seqs = ["ACGTACGTTT", "AAAAAAA", "ACG", None]
    df = spark.createDataFrame(list(enumerate(seqs)), "k int, s string")
    models = ["ACGTACGA", "AAAAA"]
    got = {(r.k, r.model): r.distance for r in similarity.kmer_distance(df, "k", "s", models, 3).collect()}
    for (k, s), (j, m) in itertools.product(enumerate(seqs[:3]), enumerate(models)):
        a, b = (Counter(x[i : i + 3] for i in range(len(x) - 2)) for x in (s, m))
        assert math.isclose(got[k, j], 1 - sum((a & b).values()) / max(1, min(sum(a.values()), sum(b.values()))), abs_tol=1e-9)
    assert {r.k: r.model for r in similarity.closest_model(similarity.kmer_distance(df, "k", "s", models, 3), "k").collect()} == {0: 0, 1: 1, 2: 0}


def test_best_window(spark):
    model = "ACGTTGCA" * 5
    s = "T" * 100 + model + "T" * 100
    got = similarity.best_window(spark.createDataFrame([(1, s), (2, "ACGT")], "k int, s string"), "k", "s", model, 40, 4).collect()
    assert model in {r.k: r.seq for r in got}[1] and {r.k: r.seq for r in got}[2] == "ACGT"


def test_hits_are_aligned_together_as_one_by_one(monkeypatch):
    """Sequences of any length are worked out together with the results of each alone and of a plain sum over all cells."""
    rng = random.Random(5)
    p = profiles.build_profile("m", ["".join(rng.choice(profiles.AMINO) for _ in range(30))])
    s = profiles.Search(p)
    monkeypatch.setattr(profiles, "_SPAN", 3.0)  # many blocks
    texts = ["".join(rng.choice(profiles.AMINO) for _ in range(n)) for n in (1, 7, 45, 12)] + ["".join(profiles.AMINO[k] for k in p.match.argmax(1))]
    for text, a, (score, post) in zip(texts, s.align_all(texts), s.forward_all(texts)):
        assert a == s.align(text)
        c, n = s.encode(text), len(p)
        m, i, d = [{} for _ in range(3)]
        for t in range(len(c)):
            for k in range(n):
                came = 2**s.enter + sum(x.get((t - 1, k - 1), 0.0) * 2.0 ** w[k] for x, w in ((m, s.mm), (i, s.im), (d, s.dm)))
                m[t, k] = came * 2.0 ** s.odds[c[t], k]
                i[t, k] = m.get((t - 1, k), 0.0) * 2.0 ** s.mi[k + 1] + i.get((t - 1, k), 0.0) * 2.0 ** s.ii[k + 1]
                d[t, k] = m.get((t, k - 1), 0.0) * 2.0 ** s.md[k] + d.get((t, k - 1), 0.0) * 2.0 ** s.dd[k] if k else 0.0
        assert abs(score - (math.log2(sum(m.values())) + sum(s._length(len(c))))) < 1e-6
        assert post.shape == (len(c), n) and 0 < post.sum() <= len(c) + 1e-6
    best = s.best(texts)
    assert all((s.reaching(texts, x) == (best >= x)).all() for x in [0.0, *best])


def test_pairs_without_room_for_a_link_are_left_out_early(spark):
    """Lengths and shift rule out no pair that would be linked, and do rule out others before their sequences meet."""
    rng = random.Random(9)
    base = "".join(rng.choice("ACGT") for _ in range(120))
    rows = []
    for _ in range(150):
        i, j = rng.randint(0, 60), rng.randint(60, 120)
        a = base[i:j]
        cut_ = rng.randint(0, 30)
        b = base[cut_:] if rng.random() < 0.5 else base[cut_:70] + "ACGTACG"[: rng.randint(0, 7)] + base[70:]
        rows.append((a, b, i - cut_, len(a), len(b)))
    rows.append((base, base, 100, 120, 120))
    df = spark.createDataFrame(rows, "s1 string, s2 string, shift int, n1 int, n2 int")
    for t in (0.5, 0.97):
        got = df.select(similarity._near(t, 0.8).alias("room"), similarity.overlap_share("s1", "s2", "shift", F.lit(t), F.lit(0.8)).alias("i")).collect()
        assert any(r.i >= t for r in got) and not any(r.i >= t and not r.room for r in got) and not all(r.room for r in got)


def test_kmers_of_near_pairs_do_not_stay(spark, monkeypatch):
    """The table of k-mers is gone once the pairs are there."""
    made = []
    table = similarity.counted_table
    monkeypatch.setattr(similarity, "counted_table", lambda df: made.append(table(df)) or made[-1])
    s = "".join(random.Random(4).choice("ACGT") for _ in range(80))
    got = similarity.near_pairs(spark.createDataFrame([(1, s), (2, s[:75]), (3, s[::-1])], "id int, s string"), "id", "s", 0.9).collect()
    assert [(r.id_a, r.id_b) for r in got] == [(2, 1)]
    path = made[0][0]._table_path.removeprefix("file:")
    assert "h" in made[0][0].columns and not os.path.exists(path)


def test_near_pairs_move_no_kmers(spark, monkeypatch):
    """Pairs in many passes are those of brute force, and no table has as many rows as there are k-mers."""
    made = []
    for name in ("as_table", "counted_table"):
        monkeypatch.setattr(similarity, name, lambda df, f=getattr(similarity, name): made.append(f(df)) or made[-1])
    rows_of = lambda x: x[1] if isinstance(x, tuple) else x.count()
    monkeypatch.setattr(similarity, "scratch", contextmanager(lambda s: (yield lambda df: df)))
    monkeypatch.setattr(similarity, "PASS_KMERS", 100)
    monkeypatch.setattr(similarity, "PASS_LETTERS", 2000)
    rng = random.Random(6)
    base = [*("".join(rng.choice("ACGT") for _ in range(220)) for _ in range(2)), "ACGTTGCAACGTAG" * 9]
    texts = []
    for i in range(40):
        s = base[i % 3][rng.randint(0, 40) :]
        texts.append("".join(rng.choice("ACGTN") if rng.random() < 0.02 else c for c in s)[: rng.randint(60, 200)])
    for per_seq in (2000, 30):
        made.clear()
        got = similarity.near_pairs(spark.createDataFrame(list(enumerate(texts)), "id int, s string"), "id", "s", 0.8, per_seq=per_seq)
        sizes = [rows_of(x) for x in made]
        kmers, total = {}, 0
        for i, s in enumerate(texts):
            for h, at in similarity._lowest_kmers.func(pd.Series([s]), pd.Series([14]), pd.Series([per_seq]))[0]:
                kmers.setdefault(h, []).append((-len(s), i, at))
                total += 1
        shifts = {}
        for own in kmers.values():
            _, c, c_at = min(own)
            for _, i, at in own:
                if i != c:
                    shifts.setdefault((i, c), []).append(c_at - at)
        best = {p: max((x.count(v), v) for v in set(x))[1] for p, x in shifts.items()}
        cols = [pd.Series(x) for x in zip(*[(texts[a], texts[b], v, 0.8, 0.8) for (a, b), v in best.items()])]
        want = {p: i for p, i in zip(best, similarity.overlap_share.func(*cols)) if i >= 0.8}
        assert want and {(r.id_a, r.id_b): r.identity for r in got.collect()} == want
        assert max(sizes) < total / 4


def test_identities_together_equal_those_one_by_one():
    """Records that are aligned with a key together get exactly the identity of each alone, ties and ambiguous letters included."""
    rng = random.Random(8)
    for _ in range(6):
        key = "".join(rng.choice("ACGTRN") for _ in range(rng.randint(1, 90)))
        texts = ["".join(rng.choice("ACGT") for _ in range(rng.randint(1, 100))) for _ in range(15)] + [key[i:j] + "AC" + key[k:] for i, j, k in ((0, 20, 20), (5, 30, 40), (0, 0, 10))] + ["", key * 2]
        got, want = similarity.identities_to(texts, key), [similarity.overlap_identity(x, key) for x in texts]
        assert all(a == b or (math.isnan(a) and math.isnan(b)) for a, b in zip(got, want))
