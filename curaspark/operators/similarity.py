"""Sequences against sequences: clusters by shared k-mers, overlap identity, k-mer distances."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curaspark.functions import seq as Q
from curaspark.functions.seq import IUPAC
from curaspark.operators.hierarchy import _lookup
from curaspark.session import PARTS, as_table, counted_table, lean, lookup_join, scratch, spread, table_part

# Match and mismatch of two bases, gap opening and extension of the overlap alignment.
MATCH, MISMATCH, GAP_OPEN, GAP_EXTEND = 5.0, -4.0, 8.0, 2.0
#: Diagonals to each side of the one that two sequences meet on, so the largest sum of inserted or deleted bases of a comparison with gaps.
BAND = 12
#: Most k-mers with their centres, and most letters of centres, that a task of near_pairs() holds at a time; beyond them it takes several passes.
PASS_KMERS, PASS_LETTERS = 4_000_000, 64_000_000
#: K-mers that a task gathers before it sums them up, and pairs that it compares at a time.
_GATHERED, _TOGETHER = 2_000_000, 4096


def _substitution() -> np.ndarray:
    """Scores of IUPAC letters: the mean over the bases that two letters stand for, rounded to whole numbers for different letters."""
    letters = list(IUPAC)
    out = np.zeros((16, 16))
    for i, a in enumerate(letters):
        for j, b in enumerate(letters):
            mean = np.mean([MATCH if x == y else MISMATCH for x in IUPAC[a] for y in IUPAC[b]])
            out[i, j] = mean if a in "ACGT" and b in "ACGT" else np.round(mean)
    out[15, :] = out[:, 15] = MISMATCH
    return out


_SCORES = _substitution()


def overlap_path(pattern: str, subject: str) -> list[tuple[int, int]]:
    """Columns (position in pattern, position in subject), from 0, -1 for a gap, of the best overlap alignment; end gaps are free and left out.

    Affine gaps; rows are worked out at once, gaps along a row by a running maximum.
    """
    a, b = Q._LETTER[np.frombuffer(pattern.encode(), np.uint8)], Q._LETTER[np.frombuffer(subject.encode(), np.uint8)]
    n, m = len(a), len(b)
    if not n or not m:
        return []
    h = np.zeros(m + 1)
    e = np.full(m + 1, -np.inf)
    slope = GAP_EXTEND * np.arange(m + 1)
    came = np.zeros((n + 1, m + 1), np.int8)  # 0 diagonal, 1 up, 2 left; +4 up gap goes on, +8 left gap goes on
    edge = np.zeros(n + 1)
    for i in range(1, n + 1):
        longer = e - GAP_EXTEND
        opened = h - GAP_OPEN - GAP_EXTEND
        e = np.maximum(longer, opened)
        diag = np.concatenate([[0.0], h[:-1] + _SCORES[a[i - 1], b]])
        best = np.maximum(diag, e)
        best[0] = 0.0
        f = np.concatenate([[-np.inf], np.maximum.accumulate(best + slope)[:-1] - slope[1:] - GAP_OPEN])
        h = np.maximum(best, f)
        h[0] = 0.0
        c = np.where(f > best, 2, np.where(e > diag, 1, 0)).astype(np.int8)
        c[longer > opened] += 4
        came[i] = c
        edge[i] = h[m]
    j, i = int(h.argmax()), n
    if edge.max() > h[j]:
        i, j = int(edge.argmax()), m
    path: list[tuple[int, int]] = []
    up = False
    while i > 0 and j > 0:
        c = came[i, j]
        if up or c & 3 == 1:
            path.append((i - 1, -1))
            up = bool(c & 4)
            i -= 1
        elif c & 3 == 2:
            k = j - 1
            # A gap along the row goes back to the cell that the running maximum came from.
            path.append((-1, j - 1))
            while k > 0 and came[i, k] & 3 == 2:
                path.append((-1, k - 1))
                k -= 1
            j = k
        else:
            path.append((i - 1, j - 1))
            i, j = i - 1, j - 1
    return path[::-1]


def overlap_identity(pattern: str, subject: str) -> float:
    """1 - (mismatches + gap bases) / length of the aligned pattern, in the best overlap alignment (end gaps are free); NaN for an empty sequence."""
    path = overlap_path(pattern, subject)
    a, b = Q._LETTER[np.frombuffer(pattern.encode(), np.uint8)], Q._LETTER[np.frombuffer(subject.encode(), np.uint8)]
    wrong = sum(i < 0 or j < 0 or a[i] != b[j] for i, j in path)
    return 1 - wrong / len(path) if path else float("nan")


#: Patterns that are aligned with a subject together.
TOGETHER = 128


def identities_to(patterns: list[str], subject: str) -> list[float]:
    """overlap_identity() of each pattern with one subject, worked out together, antidiagonal by antidiagonal, without tables of a path: every cell carries the columns and the wrong ones of the path that
    overlap_path() would go back from it.
    """
    out = [float("nan")] * len(patterns)
    order = sorted((i for i, x in enumerate(patterns) if x and subject), key=lambda i: len(patterns[i]))
    for at in range(0, len(order), TOGETHER):
        part = order[at : at + TOGETHER]
        for i, x in zip(part, _identities([patterns[i] for i in part], subject)):
            out[i] = x
    return out


def _identities(patterns: list[str], subject: str) -> list[float]:
    b = Q._LETTER[np.frombuffer(subject.encode(), np.uint8)].astype(np.intp)
    size, rows, m = np.array([len(x) for x in patterns]), len(patterns), len(b)
    n = int(size.max())
    a = np.full((n, rows), 15, np.intp)
    for k, x in enumerate(patterns):
        a[: len(x), k] = Q._LETTER[np.frombuffer(x.encode(), np.uint8)]
    kind = np.int16 if max(n, m) < 4000 else np.int32
    column, wrong = 1 << 32, 1 << 32 | 1
    if max(n, m) < 16_000:
        column, wrong = 1 << 16, 1 << 16 | 1
    count = np.int32 if column == 1 << 16 else np.int64
    used, b = np.unique(b, return_inverse=True)
    score = np.concatenate([_SCORES[a, c] for c in used]).astype(kind)
    step = np.concatenate([column + (a != c) for c in used]).astype(count)

    def chosen(yes: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """np.where(), bit by bit, which is faster."""
        mask = np.negative(yes.view(np.int8)).astype(count)
        mask &= x ^ y
        mask ^= y
        return mask

    new = lambda kind, value=0: np.full((n + 1, rows), value, kind)
    none = kind(-20_000)
    # Scores h, best (without a gap along the row), e and f of the two antidiagonals before, by row; counts of the paths that end in a cell, and of those in an upward gap.
    h, h1, h2, best, e, f, e1, f1 = new(kind), new(kind), new(kind), new(kind), new(kind, none), new(kind, none), new(kind, none), new(kind, none)
    c, c1, c2, u, u1 = new(count), new(count), new(count), new(count), new(count)
    best1 = new(kind)
    open_, extend = kind(GAP_OPEN), kind(GAP_EXTEND)
    all_ = np.arange(rows)
    last, last_c, edge, edge_c = np.zeros(rows, kind), np.zeros(rows, count), np.zeros(rows, kind), np.zeros(rows, count)
    for d in range(2, n + m + 1):
        h2, h1, h = h1, h, h2
        c2, c1, c = c1, c, c2
        best1, best, e1, e, f1, f, u1, u = best, best1, e, e1, f, f1, u, u1
        lo, hi = max(1, d - m), min(n, d - 1)
        own, up = slice(lo, hi + 1), slice(lo - 1, hi)
        i = np.arange(lo, hi + 1)
        cell = b[d - i - 1] * n + i - 1
        longer, opened = e1[up] - extend, h1[up] - (open_ + extend)
        goes_on = longer > opened
        np.maximum(longer, opened, out=e[own])
        diag = h2[up] + score.take(cell, axis=0)
        is_up = e[own] > diag
        np.maximum(diag, e[own], out=best[own])
        np.maximum(f1[own], best1[own] - open_, out=f[own])
        np.subtract(f[own], extend, out=f[own])
        is_left = f[own] > best[own]
        np.maximum(best[own], f[own], out=h[own])
        np.add(chosen(goes_on, u1[up], c1[up]), count(wrong), out=u[own])
        from_up = chosen(is_up, u[own], c2[up] + step.take(cell, axis=0))
        c[own] = chosen(is_left, c1[own] + count(wrong), from_up)
        # Row and column 0 are free: paths end there.
        if d <= n:
            h[d], best[d], c[d], u[d], f[d], e[d] = 0, 0, 0, 0, none, none
        h[0], best[0], c[0], u[0], e[0] = 0, 0, 0, 0, none
        here = np.flatnonzero((size >= lo) & (size <= hi))
        if len(here):
            better = here[h[size[here], here] > last[here]]
            last[better], last_c[better] = h[size[better], better], c[size[better], better]
        if d > m:
            better = all_[(size >= d - m) & (h[d - m] > edge)]
            edge[better], edge_c[better] = h[d - m, better], c[d - m, better]
    got = np.where(edge > last, edge_c, last_c).astype(np.int64)
    columns, bad = got // column, got % column
    return [1 - int(w) / int(k) if k else float("nan") for w, k in zip(bad, columns)]


@F.pandas_udf(T.DoubleType())
def overlap_identities(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else overlap_identity(x, y) for x, y in zip(a, b)], dtype="float64")


def key_identity(keys: DataFrame, db: DataFrame, most: int = 10_000) -> DataFrame:
    """key, key_species, name, species, pid of every record of db (name, species, seq) against every key record (name, species, seq).

    The keys are a short list by nature and go to every task, at most `most` of them; db is read once. Each pair is one alignment, so
    the work is keys times records.
    """
    rows = keys.select("name", "species", "seq").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} key records")
    listed = [(r.name if isinstance(r.name, str) else r["name"], r.species, r.seq) for r in rows]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for key, species, s in listed:
                given = [x is not None and s is not None for x in b.seq]
                got = iter(identities_to([x for x, ok in zip(b.seq, given) if ok], s) if any(given) else [])
                pid = [next(got) if ok else None for ok in given]
                yield b[["name", "species"]].assign(key=key, key_species=species, pid=pid)

    # Alignment costs far more than moving the records, so they go to a few times more equal tasks than there are cores.
    even = db.select("name", "species", "seq").repartition(4 * db.sparkSession.sparkContext.defaultParallelism)
    return even.mapInPandas(run, "name string, species string, key string, key_species string, pid double").select("key", "key_species", "name", "species", "pid")


def identical_to_keys(pids: DataFrame) -> DataFrame:
    """The records with identity 1 to a key of another species and accession."""
    acc = lambda c: F.split_part(c, F.lit("|"), F.lit(1))
    return pids.filter((F.col("pid") == 1) & (F.col("species") != F.col("key_species")) & (acc(F.col("name")) != acc(F.col("key"))))


def _mixed(key: np.ndarray) -> np.ndarray:
    """Hashes of k-mers; different ones have different hashes."""
    with np.errstate(over="ignore"):
        h = key * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ h >> np.uint64(32)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("at", T.IntegerType())])))
def _lowest_kmers(s: pd.Series, k: pd.Series, m: pd.Series) -> pd.Series:
    """The m k-mers of lowest hash of each sequence, with their position; k-mers with other letters than A, C, G, T are left out."""
    out = []
    for x, kk, mm in zip(s, k, m):
        code = Q._LETTER[np.frombuffer((x or "").encode(), np.uint8)].astype(np.uint64)
        n = len(code) - kk + 1
        if n < 1:
            out.append([])
            continue
        key, bad = np.zeros(n, np.uint64), np.zeros(n, bool)
        for i in range(kk):
            part = code[i : i + n]
            key = key * np.uint64(4) + (part & np.uint64(3))
            bad |= part > 3
        h = _mixed(key)
        good = np.flatnonzero(~bad)
        good = good[np.argsort(h[good], kind="stable")]
        good = good[np.sort(np.unique(h[good], return_index=True)[1])[:mm]]
        out.append(list(zip(h[good].astype(np.int64).tolist(), good.tolist())))
    return pd.Series(out, dtype=object)


def _kmers_of(texts: list[str], k: int, per_seq: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k-mer, position, index of the text) of all texts together, as _lowest_kmers() has them of each, by text and position."""
    own = [(x or "").encode() for x in texts]
    code = Q._LETTER[np.frombuffer(b"\n".join(own), np.uint8)]
    size = np.array([len(x) for x in own])
    start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    part, part_bad, key, bad, n, done, width = (code & 3).astype(np.uint64), code > 3, None, None, k, 0, 1
    while n:  # k-mers of 1, 2, 4 ... letters, and of those of them that add up to k
        if n & 1:
            if key is None:
                key, bad = part, part_bad
            else:
                m = max(0, min(len(key), len(part) - done))
                key, bad = key[:m] << np.uint64(2 * width) | part[done : done + m], bad[:m] | part_bad[done : done + m]
            done += width
        n >>= 1
        if n:
            m = max(0, len(part) - width)
            part, part_bad, width = part[:m] << np.uint64(2 * width) | part[width:], part_bad[:m] | part_bad[width:], 2 * width
    at = np.flatnonzero(~bad)
    row = np.searchsorted(start, at, "right") - 1
    key, at = key[at], at - start[row]
    # Of a k-mer that a text has several times the first one counts.
    rank = key if 2 * k + len(own).bit_length() <= 64 else np.unique(key, return_inverse=True)[1].astype(np.uint64)
    both = row.astype(np.uint64) << np.uint64(64 - len(own).bit_length()) | rank
    ordered = np.sort(both)
    again = np.flatnonzero(np.isin(both, ordered[1:][ordered[1:] == ordered[:-1]]))
    keep = np.ones(len(key), bool)
    keep[again] = False
    keep[again[np.unique(both[again], return_index=True)[1]]] = True
    for i in np.flatnonzero(size - k + 1 > per_seq):
        mine = np.flatnonzero(keep & (row == i))
        keep[mine[np.argsort(_mixed(key[mine]), kind="stable")[per_seq:]]] = False
    return key[keep], at[keep], row[keep]


#: Bits of the three sums that one number of the banded alignment holds: score, matches, columns.
_SUM = 21
_LOW = (1 << _SUM) - 1


def banded_identity(a: list[str], b: list[str], shifts: list[int], band: int = BAND) -> tuple[np.ndarray, np.ndarray]:
    """(identity, columns) of the best overlap alignment of each pair, within `band` diagonals to each side of the one where position i of a meets i + shift of b.

    End gaps are free; a match scores 1, a mismatch -1, a gap -2 a base. Identity is matches over aligned columns, inner gaps included. All pairs are worked out together,
    row by row; score, matches and columns add up in one number, so of equal scores the one with more matches counts.
    """
    n, width = len(a), 2 * band + 1
    la, lb, shift = np.array([len(x) for x in a]), np.array([len(x) for x in b]), np.array(shifts)
    x = np.full((n, max(la, default=0)), 1, np.uint8)
    y = np.full((n, max(lb, default=0) + 1), 2, np.uint8)
    for i, (s, t) in enumerate(zip(a, b)):
        x[i, : len(s)] = np.frombuffer(s.encode(), np.uint8)
        y[i, : len(t)] = np.frombuffer(t.encode(), np.uint8)
    number = lambda score, match: (score << 2 * _SUM) + (match << _SUM) + 1
    hit, miss, gap = number(1, 1), number(-1, 0), number(-2, 0)
    none = -(1 << 61)
    off = np.arange(width) - band
    slope = gap * np.arange(width)
    v = np.zeros((n, width), np.int64)
    top = np.zeros(n, np.int64)
    rows = np.arange(n)[:, None]
    for i in range(x.shape[1]):
        j = i + shift[:, None] + off
        inside = (j >= 0) & (j < lb[:, None]) & (i < la)[:, None]
        same = x[:, i, None] == y[rows, np.clip(j, 0, y.shape[1] - 1)]
        # v holds the row above: on its diagonal the cell of j - 1, to the right of that the cell of j; cells before the first letters are 0.
        diag = np.where(j == 0, 0, v) + np.where(same, hit, miss)
        up = np.concatenate([v[:, 1:], np.full((n, 1), none)], 1) + gap
        best = np.where(inside, np.maximum(diag, up if i else none), none)
        best = np.maximum.accumulate(best - slope, 1) + slope
        best = np.where(inside, best, none)
        last = inside & ((j == lb[:, None] - 1) | (i == la - 1)[:, None])
        top = np.maximum(top, np.where(last, best, none).max(1, initial=none))
        v = np.where(inside, best, np.where(j < 0, 0, none))
    columns, matches = top & _LOW, top >> _SUM & _LOW
    return np.where(columns > 0, matches / np.maximum(columns, 1), 0.0), columns


def _shares(a: pd.Series, b: pd.Series, shift: pd.Series, threshold: pd.Series, coverage: pd.Series) -> pd.Series:
    """Identity of the overlap of two sequences near a diagonal, 0 where the overlap is less than `coverage` of the shorter one.

    Pairs that reach the threshold on the diagonal itself are done; the others are aligned in the band with gaps.
    """
    out, rest = np.zeros(len(a)), []
    for i, (x, y, s, t, c) in enumerate(zip(a, b, shift, threshold, coverage)):
        u, v = np.frombuffer(x.encode(), np.uint8), np.frombuffer(y.encode(), np.uint8)
        lo, hi = max(0, -s), min(len(u), len(v) - s)
        if hi > lo and hi - lo >= c * min(len(u), len(v)):
            out[i] = float((u[lo:hi] == v[lo + s : hi + s]).mean())
        if out[i] < t:
            rest.append(i)
    rest.sort(key=lambda i: len(a.iloc[i]))  # pairs of like length together
    for at in range(0, len(rest), 512):
        part = rest[at : at + 512]
        got, columns = banded_identity([a.iloc[i] for i in part], [b.iloc[i] for i in part], [int(shift.iloc[i]) for i in part])
        for i, identity, n in zip(part, got, columns):
            if n >= coverage.iloc[i] * min(len(a.iloc[i]), len(b.iloc[i])):
                out[i] = max(out[i], identity)
    return pd.Series(out)


@F.pandas_udf(T.DoubleType())
def overlap_share(a: pd.Series, b: pd.Series, shift: pd.Series, threshold: pd.Series, coverage: pd.Series) -> pd.Series:
    """_shares() of columns."""
    return _shares(a, b, shift, threshold, coverage)


def components(edges: DataFrame) -> DataFrame:
    """u, v: of each node of an undirected graph that has an edge, but for the least of its component, the least node of its component. edges: u, v (numbers).

    Large-star and small-star steps: every node hands its larger neighbours, then its smaller ones, to the least of them, until nothing changes; the rounds are about the
    logarithm of the size. A node with a third of all edges is met by _lookup().
    """
    now, n = counted_table(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    state = None
    while n:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large, k = counted_table(_lookup(both, "u", least, 2 * n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _lookup(large, "u", least, k).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        now, n = counted_table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, (n, now.agg(F.bit_xor(F.xxhash64("u", "v"))).first()[0])
        if state == before:
            break
    return now


def _near(threshold: float, coverage: float) -> Column:
    """Whether an overlap of n1 and n2 letters within the band of a shift can have that identity and coverage: at least so large a share of its columns are pairs of letters."""
    overlap = F.least(F.col("n1"), F.col("n2") - F.col("shift")) - F.greatest(F.lit(0), -F.col("shift"))
    return overlap + BAND >= threshold * coverage * F.least("n1", "n2")


def _overlap(n1: np.ndarray, n2: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Letters of n1 that face letters of n2 at a shift."""
    return np.minimum(n1, n2 - shift) - np.maximum(0, -shift)


def clusters(df: DataFrame, key: str, seq: str, threshold: float = 0.97, coverage: float = 0.8, k: int = 14, per_seq: int = 2000) -> DataFrame:
    """representative, member of all records: linear-time clustering over shared k-mers.

    Each distinct sequence gives its per_seq k-mers of lowest hash. For each k-mer the longest sequence (the least key among equals) is the centre, and the
    others are compared with it: overlap_share() of at least threshold near the diagonal that most shared k-mers lie on. Sequences that such links connect are a
    cluster, so no link is lost; its longest sequence (the least key among equals) represents it. Identical sequences share a cluster. Null sequences represent themselves.

    Per k-mer only the centre is kept (an aggregation), so a k-mer of a third of all records costs no pairs; centres of such k-mers, and centres that many
    sequences meet, are broadcast with their sequence. per_seq takes in
    practically all k-mers of sequences up to 2000 bases; k-mers carry the sequence's place in the order of centres, a number, instead of its id.
    """
    kind = dict(df.dtypes)[key]
    base = df.filter(F.col(seq).isNotNull()).select(F.col(key).alias("id"), F.upper(Q.dealigned(F.col(seq))).alias("s"))
    distinct = base.groupBy("s").agg(F.min("id").alias("first")).withColumn("n", F.length("s"))
    # Numbers rise with the sorted partitions, so the least of them is the longest sequence, the least key among equals.
    one = as_table(distinct.orderBy(F.desc("n"), "first").withColumn("id", F.monotonically_increasing_id()))
    with scratch(df.sparkSession) as keep:  # the k-mers go once the pairs are there
        grams, rows = counted_table(spread(one).select("id", "n", F.explode(_lowest_kmers("s", F.lit(k), F.lit(per_seq))).alias("g")).select("id", "n", "g.h", "g.at"))
        centre = grams.groupBy("h").agg(F.min(F.struct("id", "at", "n")).alias("c"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("h", F.col("c.id").alias("centre"), F.col("c.at").alias("c_at"), F.col("c.n").alias("n2"))
        met = _lookup(grams, "h", centre, rows).filter("centre is not null and centre <> id")
        pairs = met.groupBy("id", "centre", (F.col("c_at") - F.col("at")).alias("shift")).agg(F.count(F.lit(1)).alias("k"), F.first("n").alias("n1"), F.first("n2").alias("n2"))
        best = pairs.groupBy("id", "centre").agg(F.max(F.struct("k", "shift")).alias("b"), F.first("n1").alias("n1"), F.first("n2").alias("n2")).select("id", "centre", "b.shift", "n1", "n2")
        # Sequences only meet where their lengths and the shift leave room for a link.
        best, rows = counted_table(best.filter(_near(1.0, coverage)).drop("n1", "n2"))
        keep(best)
    near = _lookup(best.join(one.select("id", F.col("s").alias("s1")), "id"), "centre", one.select(F.col("id").alias("centre"), F.col("s").alias("s2")), rows).withColumn("i", overlap_share("s1", "s2", "shift", F.lit(threshold), F.lit(coverage)))
    linked = as_table(near.filter(F.col("i") >= threshold).select("id", "centre"))
    roots = components(linked.select(F.col("id").alias("u"), F.col("centre").alias("v"))).select(F.col("u").alias("id"), F.col("v").alias("root"))
    reps = one.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    reps, rows = counted_table(reps.select("s", "root"))
    reps = _lookup(reps, "root", one.select(F.col("id").alias("root"), F.col("first").alias("representative")), rows).select("s", "representative")
    out = base.join(reps, "s").select("representative", F.col("id").alias("member"))
    none = df.filter(F.col(seq).isNull()).select(F.col(key).cast(kind).alias("representative"), F.col(key).alias("member"))
    return out.unionByName(none)


def kmer_profile(df: DataFrame, key: str, seq: str, k: int = 5) -> DataFrame:
    """key, kmer, n: how often each k-mer occurs in a sequence; none for a null or shorter one."""
    return df.filter(F.col(seq).isNotNull()).select(key, F.explode(Q.kmers(F.upper(seq), k)).alias("kmer")).groupBy(key, "kmer").agg(F.count(F.lit(1)).alias("n"))


def kmer_distance(df: DataFrame, key: str, seq: str, models: list[str], k: int = 5) -> DataFrame:
    """key, model (index from 0), distance of each sequence to each of a few model sequences: 1 - shared k-mers / k-mers of the shorter one."""
    spark = df.sparkSession
    m = spark.createDataFrame([(i, s) for i, s in enumerate(models)], "model int, s string")
    prof = kmer_profile(m, "model", "s", k).withColumnRenamed("n", "m")
    size = {i: max(len(s) - k + 1, 1) for i, s in enumerate(models)}
    total = F.create_map(*[F.lit(x) for kv in size.items() for x in kv])
    own = kmer_profile(df, key, seq, k)
    shared = own.join(F.broadcast(prof), "kmer").groupBy(key, "model").agg(F.sum(F.least("n", "m")).alias("c"))
    all_ = df.filter(F.col(seq).isNotNull()).select(key, F.greatest(F.length(seq) - (k - 1), F.lit(1)).alias("w")).withColumn("model", F.explode(F.array(*[F.lit(i) for i in size])))
    return all_.join(shared, [key, "model"], "left").select(key, "model", F.round(1 - F.coalesce("c", F.lit(0)) / F.least("w", F.element_at(total, F.col("model"))), 9).alias("distance"))


def closest_model(distances: DataFrame, key: str, threshold: float | None = None) -> DataFrame:
    """key, model, distance of the nearest model (the first of equal ones), within a threshold if given."""
    best = distances.groupBy(key).agg(F.min(F.struct("distance", "model")).alias("b")).select(key, "b.model", "b.distance")
    return best.filter(F.col("distance") <= threshold) if threshold is not None else best


def chunks(df: DataFrame, key: str, seq: str, size: int) -> DataFrame:
    """key, chunk (from 0), seq: long sequences in pieces of `size` bases, the last one shorter."""
    n = F.ceil(F.length(seq) / size).cast("int")
    return df.filter(F.length(seq) > 0).select(key, F.col(seq).alias("_s"), F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk")).select(key, "chunk", F.substr("_s", F.col("chunk") * size + 1, F.lit(size)).alias("seq"))


def best_window(df: DataFrame, key: str, seq: str, model: str, size: int, k: int = 5) -> DataFrame:
    """key, seq: of a long sequence the chunk that is nearest to a model with the chunks beside it; others as they are."""
    parts = chunks(df, key, seq, size).withColumn("id", F.struct(key, "chunk"))
    near = kmer_distance(parts.select("id", "seq"), "id", "seq", [model], k)
    best = near.select(F.col(f"id.{key}").alias(key), "id.chunk", "distance").groupBy(key).agg(F.min(F.struct("distance", "chunk")).alias("b")).select(key, F.col("b.chunk").alias("c"))
    got = df.join(best, key, "left")
    cut = F.substr(seq, F.greatest((F.col("c") - 1) * size + 1, F.lit(1)), (F.least(F.col("c"), F.lit(1)) + 2) * size)
    return got.select(key, F.when((F.length(seq) > 3 * size) & F.col("c").isNotNull(), cut).otherwise(F.col(seq)).alias("seq"))


def lca_shares(pairs: DataFrame, ranks: list[str], step: float = 0.01) -> DataFrame:
    """identity, rank, n, share: of pairs of records (identity, a.rank and b.rank as <rank>_a, <rank>_b) how often a rank is the lowest that both share, per step of identity.

    'none' stands for pairs that share no rank. ranks go from the highest to the lowest.
    """
    from pyspark.sql import Window as W

    same = F.coalesce(*[F.when(F.col(f"{r}_a") == F.col(f"{r}_b"), F.lit(r)) for r in reversed(ranks)], F.lit("none"))
    got = pairs.select(F.round(F.floor(F.col("identity") / step) * step, 6).alias("identity"), same.alias("rank")).groupBy("identity", "rank").agg(F.count(F.lit(1)).alias("n"))
    return got.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy("identity")), 9))


def _blocks(batches: Iterator[pa.RecordBatch], k: int, per_seq: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(k-mer, position, number of the sequence) of batches of (num, s), some sequences at a time."""
    for b in batches:
        num = b.column(0).to_numpy()
        texts, begin, letters = b.column(1).to_pylist(), 0, 0
        for i, s in enumerate(texts):
            letters += len(s)
            if letters > 500_000 or i + 1 == len(texts):
                key, at, row = _kmers_of(texts[begin : i + 1], k, per_seq)
                yield key, at, num[begin + row]
                begin, letters = i + 1, 0


def _extremes(key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each k-mer once with its least lo and largest hi."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    return (key[first], np.minimum.reduceat(lo[order], first), np.maximum.reduceat(hi[order], first)) if len(key) else (key, lo, hi)


def near_pairs(df: DataFrame, key: str, seq: str, threshold: float, coverage: float = 0.8, k: int = 14, per_seq: int = 2000) -> DataFrame:
    """id_a, id_b, identity: linked pairs of records, a k-mer's longest sequence against the others that have it, as in clusters().

    Pairs are between distinct sequences, each standing for its record of least key; the number of pairs follows the number of k-mers, not of pairs of records.

    K-mers never leave the task that reads their sequence: tasks sum up (k-mer, first and last sequence), and look their k-mers up in the table of those that several sequences have, PASS_KMERS of it
    at a time. Sequences are numbered in the order of centres, so number and position in one integer decide. Sequences meet likewise: PASS_LETTERS of the centres' at a time.
    """
    spark = df.sparkSession
    base = df.filter(F.col(seq).isNotNull()).select(F.col(key).alias("id"), F.upper(Q.dealigned(F.col(seq))).alias("s"))
    with lean(spark), scratch(spark) as keep:
        one = as_table(base.groupBy("s").agg(F.min("id").alias("id")).orderBy(F.desc(F.length("s")), "id").withColumn("num", F.monotonically_increasing_id()))
        counts = {r.p: r.n for r in one.groupBy(F.shiftright("num", 33).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
        starts = np.cumsum([0, *(counts.get(p, 0) for p in range(max(counts, default=0)))]).tolist()
        one = one.withColumn("num", F.get(F.array(*map(F.lit, starts)), F.shiftright("num", 33).cast("int")) + F.col("num").bitwiseAND((1 << 33) - 1))
        texts = spread(one.select("num", "s"))
        bits = int(one.agg(F.max(F.octet_length("s"))).first()[0] or 0).bit_length()

        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts, n, out = [], 0, lambda x: pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), pa.array(x[1]), pa.array(x[2])], ["h", "lo", "hi"])
            for h, at, num in _blocks(batches, k, per_seq):
                own = num << bits | at
                parts.append((h, own, own))
                n += len(h)
                if n > _GATHERED:
                    parts = [_extremes(*map(np.concatenate, zip(*parts)))]
                    n = len(parts[0][0])
                    if n > _GATHERED // 2:
                        yield out(parts[0])
                        parts, n = [], 0
            if parts:
                yield out(_extremes(*map(np.concatenate, zip(*parts))))

        # Both parts are read by ranges of a hash, so tables are cut once their size is known.
        cut = lambda c: F.pmod(F.xxhash64(c), F.lit(PARTS)).cast("int").alias("part")
        shared = texts.mapInArrow(ends, "h bigint, lo bigint, hi bigint").groupBy("h").agg(F.min("lo").alias("c"), F.max("hi").alias("hi")).filter(F.shiftright("c", bits) < F.shiftright("hi", bits))
        centres, rows = counted_table(shared.select("h", "c", cut("h")))
        passes, path = max(1, -(-rows // PASS_KMERS)), centres._table_path

        def meet(i: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = table_part(path, i, passes, "h")
            known, centre = table["h"].to_numpy(), table["c"].to_numpy()
            for h, at, num in _blocks(batches, k, per_seq):
                h = h.view(np.int64)
                x = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                ok = known[x] == h if len(known) else np.zeros(len(h), bool)
                own, c = num[ok], centre[x[ok]]
                c, shift = c >> bits, (c & (1 << bits) - 1) - at[ok]
                order = np.lexsort((shift, c, own))
                order = order[own[order] != c[order]]
                own, c, shift = own[order], c[order], shift[order]
                first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (c[1:] != c[:-1]) | (shift[1:] != shift[:-1])])[: len(own)])
                n = np.diff(np.append(first, len(own)))
                yield pa.RecordBatch.from_arrays([pa.array(own[first]), pa.array(c[first]), pa.array(shift[first].astype(np.int32)), pa.array(n.astype(np.int32))], ["num", "c", "shift", "k"])

        met = reduce(DataFrame.unionByName, [as_table(texts.mapInArrow(partial(meet, i), "num bigint, c bigint, shift int, k int")) for i in range(passes)])
        best = met.groupBy("num", "c", "shift").agg(F.sum("k").alias("k")).groupBy("num", "c").agg(F.max(F.struct("k", "shift")).alias("b"))
        best = as_table(best.groupBy("num").agg(F.collect_list(F.struct("c", "b.shift")).alias("pairs")))
        others = as_table(lookup_join(one, best.select(F.explode("pairs.c").alias("num")).distinct(), "num").select(F.col("id").alias("id_b"), "s", "num", cut("num")))
        turns, at = max(1, -(-int(others.agg(F.sum(F.octet_length("s"))).first()[0] or 0) // PASS_LETTERS)), others._table_path
        n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        meeting = one.withColumnRenamed("id", "id_a").repartition(n, "num").join(best.repartition(n, "num").hint("merge"), "num").select("id_a", "s", "pairs")

        def score(i: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = table_part(at, i, turns, "num")
            known, size = table["num"].to_numpy(), pc.utf8_length(table["s"]).to_numpy()
            for b in batches:
                pairs, n1 = pc.list_flatten(b.column("pairs")), pc.utf8_length(b.column("s")).to_numpy()
                row, c, shift = pc.list_parent_indices(b.column("pairs")).to_numpy(), pairs.field("c").to_numpy(), pairs.field("shift").to_numpy().astype(np.int64)
                x = np.minimum(np.searchsorted(known, c), max(len(known) - 1, 0))
                here = np.flatnonzero(known[x] == c) if len(known) else np.zeros(0, int)
                row, x, shift = row[here], x[here], shift[here]
                # Sequences only meet where their lengths and the shift leave room for a link.
                room = np.flatnonzero(_overlap(n1[row], size[x], shift) + BAND >= threshold * coverage * np.minimum(n1[row], size[x]))
                for begin in range(0, len(room), _TOGETHER):
                    z = room[begin : begin + _TOGETHER]
                    s1, s2 = b.column("s").take(pa.array(row[z])).to_pandas(), table["s"].take(pa.array(x[z])).to_pandas()
                    same = lambda v, z=z: pd.Series(np.full(len(z), v))
                    got = _shares(s1, s2, pd.Series(shift[z]), same(threshold), same(coverage)).to_numpy()
                    good = np.flatnonzero(got >= threshold)
                    yield pa.RecordBatch.from_arrays([b.column("id_a").take(pa.array(row[z][good])), table["id_b"].take(pa.array(x[z][good])).combine_chunks(), pa.array(got[good])], ["id_a", "id_b", "identity"])

        kind = base.schema["id"].dataType.simpleString()
        linked = [as_table(meeting.mapInArrow(partial(score, i), f"id_a {kind}, id_b {kind}, identity double")) for i in range(turns)]
        return reduce(DataFrame.unionByName, map(keep, linked))


def lca_probabilities(df: DataFrame, key: str, seq: str, ranks: list[str], threshold: float = 0.5, step: float = 0.01) -> DataFrame:
    """identity, rank, n, share of lca_shares() over the near_pairs() of the records, so the pairs are made here."""
    pairs = near_pairs(df, key, seq, threshold)
    a = df.select(F.col(key).alias("id_a"), *[F.col(r).alias(f"{r}_a") for r in ranks])
    b = df.select(F.col(key).alias("id_b"), *[F.col(r).alias(f"{r}_b") for r in ranks])
    return lca_shares(pairs.join(a, "id_a").join(b, "id_b"), ranks, step)


def seeded_search(queries: DataFrame, db: DataFrame, key: str = "name", seq: str = "seq", k: int = 11, min_identity: float = 0.8, min_coverage: float = 0.0, per_seq: int = 2000) -> DataFrame:
    """qseqid, sseqid, pident (percent), length, qcovs (percent): hits of all queries in all records of db, found over shared k-mers and aligned with gaps near their diagonal.

    A query meets a record on the diagonal of most shared k-mers. Hits have min_identity and cover min_coverage of the query. K-mers that many records have are met by _lookup's
    way for hot keys only on the side of the queries; the result has one row a pair, as many as there are hits.
    """
    q = queries.filter(F.col(seq).isNotNull()).select(F.col(key).alias("qseqid"), F.upper(Q.dealigned(F.col(seq))).alias("s1"))
    s = db.filter(F.col(seq).isNotNull()).select(F.col(key).alias("sseqid"), F.upper(Q.dealigned(F.col(seq))).alias("s2"))
    gq = spread(q).select("qseqid", F.explode(_lowest_kmers("s1", F.lit(k), F.lit(per_seq))).alias("g")).select("qseqid", "g.h", F.col("g.at").alias("qa"))
    gs = spread(s).select("sseqid", F.explode(_lowest_kmers("s2", F.lit(k), F.lit(per_seq))).alias("g")).select("sseqid", "g.h", F.col("g.at").alias("sa"))
    met = gq.join(gs, "h").groupBy("qseqid", "sseqid", (F.col("sa") - F.col("qa")).alias("shift")).agg(F.count(F.lit(1)).alias("k"))
    best = as_table(met.groupBy("qseqid", "sseqid").agg(F.max(F.struct("k", "shift")).alias("b")).select("qseqid", "sseqid", "b.shift"))

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at : at + 512]
                identity, n = banded_identity(part.s1.tolist(), part.s2.tolist(), part["shift"].astype(int).tolist())
                covered = 100 * np.minimum(n / part.s1.str.len().clip(lower=1).to_numpy(), 1.0)
                yield pd.DataFrame({"qseqid": part.qseqid, "sseqid": part.sseqid, "pident": 100 * identity, "length": n, "qcovs": covered})

    kinds = {**dict(q.dtypes), **dict(s.dtypes)}
    hits = spread(best.join(q, "qseqid").join(s, "sseqid")).mapInPandas(align, f"qseqid {kinds['qseqid']}, sseqid {kinds['sseqid']}, pident double, length bigint, qcovs double")
    return hits.filter((F.col("pident") >= 100 * min_identity) & (F.col("qcovs") >= 100 * min_coverage))
