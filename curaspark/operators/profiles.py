"""Profile hidden Markov models: reading, building, searching, and the filters that read their hits."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.functions.seq import revcomp
from curaspark.operators.filters import removed
from curaspark.session import spread

# Amino acids in the order of the public profile format and their background frequencies.
AMINO = "ACDEFGHIKLMNPQRSTVWY"
BACKGROUND = np.array([0.0787945, 0.0151600, 0.0535222, 0.0668298, 0.0397062, 0.0695071, 0.0229198, 0.0590092, 0.0594422, 0.0963728, 0.0237718, 0.0414386, 0.0482904, 0.0395639, 0.0540978, 0.0683364, 0.0540687, 0.0673417, 0.0114135, 0.0304133])
_NONE = -1e9
#: Binary digits that the factors of a block of a running sum may take up.
_SPAN = 200.0
#: Proteins that are scored together, and hits that are aligned together.
SCORED, ALIGNED = 256, 128


@dataclass(frozen=True)
class Profile:
    """match: M x letters probabilities (20 amino acids, or the 4 bases for a model of nucleotides); moves: (M + 1) x 7 probabilities m>m, m>i, m>d, i>m, i>i, d>m, d>d, row 0 for the begin state; stats: location and slope of forward scores."""

    name: str
    match: np.ndarray
    moves: np.ndarray
    stats: tuple[float, float]
    letters: str = AMINO

    def __len__(self) -> int:
        return len(self.match)

    def part(self, start: int, end: int) -> Profile:
        """The model of match states start..end, counted from 1."""
        if not 1 <= start <= end <= len(self):
            raise ValueError("the range lies outside the model")
        return replace(self, match=self.match[start - 1 : end], moves=self.moves[start - 1 : end + 1])


def read_profile(text: str) -> Profile:
    """The first model of a text in the public ASCII format (probabilities as negative natural logarithms, '*' for 0)."""
    lines = text.splitlines()
    head = {x.split()[0]: x.split()[1:] for x in lines if x and x[0].isalpha()}
    stats = next(((float(v[3]), float(v[4])) for v in (x.split() for x in lines) if v[:3] == ["STATS", "LOCAL", "FORWARD"]), None)
    letters = AMINO if head.get("ALPH", ["amino"])[0].lower() == "amino" else "ACGT"
    number = lambda xs: [0.0 if x == "*" else math.exp(-float(x)) for x in xs]
    at = next(i for i, x in enumerate(lines) if x.startswith("HMM "))
    body = [x.split() for x in lines[at + 2 :]]
    if body[0][0] == "COMPO":
        body = body[1:]
    moves, match, i = [number(body[1][:7])], [], 2
    while body[i][0] != "//":
        match.append(number(body[i][1 : 1 + len(letters)]))
        moves.append(number(body[i + 2][:7]))
        i += 3
    m = np.array(match)
    if len(m) != int(head["LENG"][0]):
        raise ValueError("the model's length is not as stated")
    return Profile(head["NAME"][0], m, np.array(moves), stats or default_stats(len(m)), letters)


def default_stats(length: int) -> tuple[float, float]:
    """Location and slope of forward scores where none are given: a slope of ln 2 and a location that falls with the model's length."""
    return -math.log2(max(length, 2)) + 3.0, math.log(2)


def background(letters: str) -> np.ndarray:
    return BACKGROUND if letters == AMINO else np.full(len(letters), 1 / len(letters))


def build_profile(name: str, rows: list[str], symfrac: float = 0.5, pseudo: float = 2.0, letters: str = AMINO) -> Profile:
    """A model of aligned proteins, or with letters='ACGT' of aligned nucleotides: columns with at least `symfrac` letters are match states, emissions get background pseudocounts and moves flat ones."""
    x = [r.upper().replace(".", "-") for r in rows]
    keep = [c for c in range(len(x[0])) if sum(r[c] != "-" for r in x) >= symfrac * len(x)]
    if not keep:
        raise ValueError("no column has enough letters")
    match = np.array([[sum(r[c] == a for r in x) for a in letters] for c in keep], float) + pseudo * background(letters)
    match /= match.sum(1, keepdims=True)
    n = len(keep)
    moves = np.tile(np.array([9.0, 0.5, 0.5, 1.0, 1.0, 1.0, 1.0]), (n + 1, 1))
    for r in x:
        last, state = 0, "m"
        at = 0
        for c in range(len(r)):
            if at < n and c == keep[at]:
                now = "m" if r[c] != "-" else "d"
                moves[last, {"mm": 0, "md": 2, "dm": 5, "dd": 6, "im": 3, "id": 3}[state + now]] += 1
                at += 1
                last, state = at, now
            elif r[c] != "-" and state != "d":
                moves[last, 1 if state == "m" else 4] += 1
                state = "i"
    for a, b in ((0, 3), (3, 5), (5, 7)):
        moves[:, a:b] /= moves[:, a:b].sum(1, keepdims=True)
    moves[n, :] = [1, 0, 0, 1, 0, 1, 0]
    return Profile(name, match, moves, default_stats(n), letters)


class Search:
    """Local search with a profile; scores in bits, sequences of proteins with X for unknown and stop."""

    def __init__(self, p: Profile):
        self.p, m = p, len(p)
        with np.errstate(divide="ignore"):
            odds = np.log2(p.match / background(p.letters))
            t = np.maximum(np.log2(p.moves), _NONE)
        self.odds = np.vstack([np.maximum(odds.T, -30), np.zeros((1, m))])  # letters x states; the last is for any other letter
        self.mm, self.mi, self.md, self.im, self.ii, self.dm, self.dd = (np.ascontiguousarray(t[:, i]) for i in range(7))
        self.enter = math.log2(2 / (m * (m + 1)))
        self.run = np.concatenate([[0.0], np.cumsum(self.dd[1:m])])  # of deletions before state k
        letter = np.full(256, len(p.letters), np.int8)
        for i, a in enumerate(p.letters.encode()):
            letter[a] = letter[a + 32] = i
        self.letter = letter

    def encode(self, s: str) -> np.ndarray:
        return self.letter[np.frombuffer(s.encode(), np.uint8)]

    @staticmethod
    def _length(n: int) -> tuple[float, float]:
        """Cost of all flanking letters of a sequence of n against the null model, and of the moves at both ends."""
        return n * math.log2(n / (n + 2)) if n else 0.0, 2 * math.log2(2 / (n + 2))

    def _deleted(self, m: np.ndarray) -> np.ndarray:
        """Best score of each deletion state after match scores m (last axis: states)."""
        d = np.full_like(m, _NONE)
        n = m.shape[-1]
        d[..., 1:] = np.maximum.accumulate(m[..., :-1] + self.md[1:n] - self.run[1:], -1) + self.run[1:]
        return d

    def _padded(self, seqs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters of the sequences, one row each, -1 behind their ends; lengths."""
        x = [self.encode(s) for s in seqs]
        size = np.array([len(c) for c in x], int)
        codes = np.full((len(x), size.max(initial=0)), -1, np.int64)
        for i, c in enumerate(x):
            codes[i, : len(c)] = c
        return codes, size

    def best(self, seqs: list[str]) -> np.ndarray:
        """Score of the best local alignment of each sequence, worked out for all of them together, position by position."""
        return self._best(seqs, np.float64)

    def reaching(self, seqs: list[str], least: float) -> np.ndarray:
        """Which sequences have a best score of at least `least`: by scores of single precision, where these are within their error of it by best()."""
        top = self._best(seqs, np.float32)
        size = np.array([len(s) for s in seqs])
        # Roundings of all additions on a path, each of numbers no larger than the sum of these.
        error = 1e-7 * (3 * size + len(self.p)) * (np.abs(top) + np.abs(self.odds).max() + abs(self.enter) + np.abs(self.run).max() + size)
        near = np.flatnonzero(np.abs(top - least) <= error)
        out = top >= least
        if len(near):
            out[near] = self.best([seqs[i] for i in near]) >= least
        return out

    def _best(self, seqs: list[str], kind: type) -> np.ndarray:
        """best() in numbers of a kind. Arrays hold a row a state, so all moves are between whole rows.

        Runs of deletions are followed as far as one may still beat a fresh beginning, by running maxima over twice as many states a step.
        """
        n = len(self.p)
        codes, size = self._padded(seqs)
        # The last column of odds is for padding.
        odds = np.hstack([self.odds.T, np.full((n, 1), _NONE)]).astype(kind)
        mm, im, dm, mi, ii = (x.astype(kind)[:, None] for x in (self.mm[1:n], self.im[1:n], self.dm[1:n], self.mi[1 : n + 1], self.ii[1 : n + 1]))
        lead, run, enter = (self.md[1:n] - self.run[1:]).astype(kind)[:, None], self.run[1:].astype(kind)[:, None], kind(self.enter)
        m, i_, came, other, e, top = (np.full((n, len(codes)), _NONE, kind) for _ in range(6))
        d, spare = (np.full((max(n - 1, 0), len(codes)), _NONE, kind) for _ in range(2))
        opened, longer = (self.md[1:n].max() + self.dm[1:n].max(), self.dd[1:n].max()) if n > 1 else (0.0, 0.0)
        for at in range(codes.shape[1]):
            came[0] = enter
            up, other_ = came[1:], other[1:]
            np.add(m[:-1], mm, out=up)
            np.add(i_[:-1], im, out=other_)
            np.maximum(up, other_, out=up)
            np.add(d[: n - 1] if at else _NONE, dm, out=other_)  # d holds states 0 to n - 2 of the row above, moved on by one
            np.maximum(up, other_, out=up)
            np.maximum(up, enter, out=up)
            np.add(m, mi, out=other)
            np.add(i_, ii, out=i_)
            np.maximum(i_, other, out=i_)
            np.take(odds, codes[:, at], axis=1, out=e, mode="wrap")
            np.add(came, e, out=m)
            np.maximum(m, kind(_NONE), out=m)
            np.maximum(top, m, out=top)
            if n > 2:
                # Deletion state k is entered from match state k - 1; the one before state k + 1 stands in row k of d.
                d[0] = _NONE
                np.add(m[: n - 2], lead[: n - 2], out=d[1:])
                step, gain = 1, float(m.max()) + opened - self.enter + 0.01
                while step < n - 1 and gain + (step - 1) * longer >= 0:
                    spare[:step] = d[:step]
                    np.maximum(d[step:], d[:-step], out=spare[step:])
                    d, spare, step = spare, d, 2 * step
                np.add(d[1:], run[: n - 2], out=d[1:])
                d[0] = _NONE
        return top.max(0, initial=_NONE).astype(float) + np.array([sum(self._length(k)) for k in size.tolist()])

    def _parts(self, seqs: list[str], states: int) -> Iterator[list[int]]:
        """The indexes of sequences in groups whose tables of so many numbers a letter and state take some 64 MB."""
        order, part, longest = sorted(range(len(seqs)), key=lambda i: len(seqs[i])), [], 0
        for i in order:
            longest = max(longest, len(seqs[i]) + 1)
            if part and (len(part) + 1) * longest * len(self.p) * states * 8 > 1 << 26:
                yield part
                part = []
            part.append(i)
        if part:
            yield part

    def align(self, s: str) -> dict | None:
        """Coordinates of the best local alignment: ali_from, ali_to, hmm_from, hmm_to, and the path of (letter, state) from 0."""
        return self.align_all([s])[0]

    def align_all(self, seqs: list[str]) -> list[dict | None]:
        """align() of each sequence, worked out together, position by position."""
        n, out = len(self.p), [None] * len(seqs)
        shift = lambda a: np.concatenate([np.full((len(a), 1), _NONE), a[:, :-1]], 1)
        odds = np.vstack([self.odds, np.full((1, n), _NONE)])
        for part in self._parts(seqs, 3):
            codes, size = self._padded([seqs[i] for i in part])
            ms, is_, ds = (np.full((codes.shape[1] + 1, len(part), n), _NONE) for _ in range(3))
            for at in range(codes.shape[1]):
                came = np.maximum(np.maximum(shift(ms[at]) + self.mm[:n], shift(is_[at]) + self.im[:n]), np.maximum(shift(ds[at]) + self.dm[:n], self.enter))
                is_[at + 1] = np.maximum(ms[at] + self.mi[1 : n + 1], is_[at] + self.ii[1 : n + 1])
                ms[at + 1] = came + odds[codes[:, at]]
                ds[at + 1] = self._deleted(ms[at + 1])
            for j, i in enumerate(part):
                if size[j]:
                    k = size[j] + 1
                    out[i] = self._traced(codes[j], ms[:k, j], is_[:k, j], ds[:k, j])
        return out

    def _traced(self, c: np.ndarray, ms: np.ndarray, is_: np.ndarray, ds: np.ndarray) -> dict:
        at, k = np.unravel_index(ms.argmax(), ms.shape)
        path, state = [], "m"
        end = (int(at), int(k) + 1)
        while True:
            if state == "m":
                path.append((int(at) - 1, int(k)))
                v = ms[at][k] - self.odds[c[at - 1]][k]
                at -= 1
                if abs(v - self.enter) < 1e-6 or k == 0:
                    break
                k -= 1
                options = [("m", ms[at][k] + self.mm[k + 1]), ("i", is_[at][k] + self.im[k + 1]), ("d", ds[at][k] + self.dm[k + 1])]
                state = max(options, key=lambda o: o[1])[0]
            elif state == "i":
                at -= 1
                state = "m" if ms[at][k] + self.mi[k + 1] >= is_[at][k] + self.ii[k + 1] else "i"
            else:
                k -= 1
                state = "m" if ms[at][k] + self.md[k + 1] >= ds[at][k] + self.dd[k + 1] else "d"
        path.reverse()
        return {"ali_from": path[0][0] + 1, "ali_to": end[0], "hmm_from": path[0][1] + 1, "hmm_to": end[1], "path": path}

    def forward(self, s: str) -> tuple[float, np.ndarray]:
        """Score over all local alignments and the posterior probability of each (letter, state) match."""
        return self.forward_all([s])[0]

    def _chained(self, x: np.ndarray, dd: np.ndarray) -> np.ndarray:
        """y with y[k] = x[k] + y[k - 1] * 2^dd[k] (last axis), as running sums over blocks in which the product of the factors stays a number."""
        y, a, n = np.empty_like(x), 0, x.shape[1]
        while a < n:
            s = np.concatenate([[0.0], np.cumsum(dd[a + 1 :])])
            b = a + int(np.searchsorted(-s, _SPAN, side="right"))
            s = s[: b - a]
            y[:, a:b] = np.cumsum(x[:, a:b] * np.exp2(-s), 1)
            if a:
                y[:, a:b] += (y[:, a - 1] * 2.0 ** dd[a])[:, None]
            y[:, a:b] *= np.exp2(s)
            a = b
        return y

    def forward_all(self, seqs: list[str]) -> list[tuple[float, np.ndarray]]:
        """forward() of each sequence, worked out together, position by position, in probabilities that are scaled every few positions."""
        n, out = len(self.p), [(0.0, np.zeros((0, len(self.p))))] * len(seqs)
        power = lambda x: np.exp2(np.maximum(x, -2000.0))
        mm, mi, md, im, ii, dm = (power(x) for x in (self.mm, self.mi, self.md, self.im, self.ii, self.dm))
        odds = np.vstack([np.exp2(self.odds), np.zeros((1, n))])
        back_dd = np.concatenate([[0.0], self.dd[1:n][::-1]])
        for part in self._parts(seqs, 2):
            codes, size = self._padded([seqs[i] for i in part])
            rows, longest = len(part), codes.shape[1]
            m, i_, d = (np.zeros((rows, n)) for _ in range(3))
            ms, scale, here = np.empty((longest, rows, n)), np.empty((longest, rows)), np.zeros(rows)
            for at in range(longest):
                came = np.repeat(np.exp2(self.enter - here)[:, None], n, 1)
                came[:, 1:] += m[:, :-1] * mm[1:n] + i_[:, :-1] * im[1:n] + d[:, :-1] * dm[1:n]
                i_ = m * mi[1 : n + 1] + i_ * ii[1 : n + 1]
                m = came * odds[codes[:, at]]
                d = np.zeros((rows, n))
                d[:, 1:] = self._chained(m[:, :-1] * md[1:n], self.dd[1:n])
                ms[at], scale[at] = m, here
                if at % 8 == 7:
                    f = np.frexp(np.maximum(np.maximum(m.max(1), i_.max(1)), np.maximum(d.max(1), np.exp2(self.enter - here))))[1]
                    m, i_, d = (x * np.ldexp(1.0, -f)[:, None] for x in (m, i_, d))
                    here = here + f
            with np.errstate(divide="ignore"):
                sums = np.log2(ms.sum(2)) + scale
            peak = sums.max(0, initial=-np.inf)
            total = peak + np.log2(np.exp2(sums - peak).sum(0))
            # Backward: what follows a match at a state, 1 for leaving at once.
            back, bi, here = np.ones((rows, n)), np.zeros((rows, n)), np.zeros(rows)
            for at in range(longest - 1, -1, -1):
                to = np.zeros((rows, n))
                one = np.exp2(-here)[:, None]
                if at < longest - 1:
                    to[:, :-1] = (back * odds[codes[:, at + 1]])[:, 1:]
                    bd = self._chained((to * dm[1 : n + 1])[:, ::-1], back_dd)[:, ::-1]
                    back = one + to * mm[1 : n + 1] + bi * mi[1 : n + 1]
                    back[:, :-1] += bd[:, 1:] * md[1:n]
                    bi = to * im[1 : n + 1] + bi * ii[1 : n + 1]
                ms[at] *= back
                ms[at] *= np.exp2(np.clip(scale[at] + here - total, -1000, 1000))[:, None]
                if at % 8 == 0:
                    f = np.frexp(np.maximum(back.max(1), bi.max(1)))[1]
                    back, bi = (x * np.ldexp(1.0, -f)[:, None] for x in (back, bi))
                    here = here + f
            np.minimum(ms, 1.0, out=ms)
            for j, i in enumerate(part):
                k = int(size[j])
                out[i] = float(total[j] + sum(self._length(k))), ms[:k, j]
        return out

    def evalue(self, score: float, size: float) -> float:
        """Expected number of sequences among `size` that reach a score by chance."""
        mu, slope = self.p.stats
        return size * min(1.0, math.exp(-slope * (score - mu)))


HITS = "target_len int, query_len int, score double, evalue_i double, hmm_from int, hmm_to int, ali_from int, ali_to int, env_from int, env_to int, acc double"


def search(df: DataFrame, protein: str, profile: Profile, size: float, min_score: float = 0.0) -> DataFrame:
    """df's rows whose protein has a local alignment of at least min_score bits, with target_len, query_len, score, evalue_i, the coordinates and acc.

    One domain a protein. All proteins of a batch are scored together; those that pass are aligned, scored over all alignments (score) and
    given acc, the mean posterior probability of the aligned letters. env is the stretch of letters with a posterior of at least 0.1 in all,
    size: the number of sequences that evalue_i refers to. Scores are close to, not equal to, those of other programs. Null and empty proteins have no hit.
    """
    names = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Search(profile)
        for b in batches:
            b = b[b[protein].notna() & (b[protein] != "")]
            b = b.iloc[b[protein].str.len().argsort(kind="stable")]  # like lengths together
            hit = [s.reaching(b[protein].iloc[at : at + SCORED].tolist(), min_score) for at in range(0, len(b), SCORED)]
            found = b[np.concatenate(hit)] if hit else b
            for at in range(0, len(found), ALIGNED):
                part = found.iloc[at : at + ALIGNED]
                texts, out = part[protein].tolist(), []
                for p, a, (score, post) in zip(texts, s.align_all(texts), s.forward_all(texts)):
                    mass = np.flatnonzero(post.sum(1) >= 0.1)
                    lo, hi = (mass[0] + 1, mass[-1] + 1) if len(mass) else (a["ali_from"], a["ali_to"])
                    out.append((len(p), len(profile), score, s.evalue(score, size), a["hmm_from"], a["hmm_to"], a["ali_from"], a["ali_to"], min(lo, a["ali_from"]), max(hi, a["ali_to"]), float(np.mean([post[x] for x in a["path"]]))))
                yield pd.concat([part.reset_index(drop=True), pd.DataFrame(out, columns=[x.split()[0] for x in HITS.split(", ")])], axis=1)[[*names, *[x.split()[0] for x in HITS.split(", ")]]]

    kinds = ", ".join(f"`{c}` {k}" for c, k in df.dtypes)
    return spread(df).mapInPandas(run, f"{kinds}, {HITS}")


def best_hits(hits: DataFrame, name: str = "name") -> DataFrame:
    """The hit of highest score of each name over all frames; of equal scores the least E-value, then frame and position. An aggregation, so a name with many hits is no burden."""
    cols = [c for c in hits.columns if c != name]
    order = F.struct(F.col("score"), -F.col("evalue_i"), -F.col("frame"), -F.col("env_from"), -F.col("env_to"))
    return hits.groupBy(name).agg(F.max_by(F.struct(*cols), order).alias("h")).select(name, "h.*")


def full_hits(hits: DataFrame, name: str = "name", max_evalue: float = 1e-10, min_score: float = 50.0, min_acc: float = 0.85, max_gap: int = 5, min_cov: float = 0.1, min_length: int = 100, max_hits: int | None = None) -> DataFrame:
    """The best hit of each name with gaps, coverage, padded envelope, nucleotide coordinates (nuc_from, nuc_to, nuc_len), one flag per criterion and `retained`.

    hits: env_from, env_to, hmm_from, hmm_to, target_len, query_len, score, evalue_i, acc, frame, stops (array). A stop codon counts inside the
    unpadded envelope. Both ends of sequence and model must be more than max_gap away for a gap to count. max_hits has no effect unless given (needs domain_total).
    """
    h = best_hits(hits, name)
    c = F.col
    h = h.withColumns({
        "env_start_gap": c("env_from") - 1, "env_end_gap": c("target_len") - c("env_to"), "hmm_start_gap": c("hmm_from") - 1, "hmm_end_gap": c("query_len") - c("hmm_to"),
        "hmm_coverage": (c("hmm_to") - c("hmm_from") + 1) / c("query_len"), "stop_codon_hit": F.coalesce(F.exists("stops", lambda x: x.between(c("env_from"), c("env_to"))), F.lit(False)),
        "penv_from": F.greatest(F.lit(1), c("env_from") - 1), "penv_to": F.least(c("target_len"), c("env_to") + 1),
    })
    h = h.withColumn("nuc_from", c("penv_from") * 3 - (3 - F.abs("frame"))).withColumn("nuc_to", c("penv_to") * 3 + F.abs("frame") - 1)
    h = h.withColumn("nuc_len", c("nuc_to") - c("nuc_from") + 1)
    fails = {
        "fail_max_evalue": c("evalue_i") > max_evalue, "fail_min_score": c("score") < min_score, "fail_min_acc": c("acc") < min_acc,
        "fail_max_gap_start": (c("hmm_start_gap") > max_gap) & (c("env_start_gap") > max_gap), "fail_max_gap_end": (c("hmm_end_gap") > max_gap) & (c("env_end_gap") > max_gap),
        "fail_stop_codon": c("stop_codon_hit"), "fail_min_length": c("nuc_len") < min_length, "fail_min_cov": c("hmm_coverage") < min_cov,
    } | ({"fail_max_hits": c("domain_total") > max_hits} if max_hits is not None else {})
    return h.withColumns(fails).withColumn("retained", ~reduce(Column.__or__, [F.coalesce(c(f), F.lit(True)) for f in fails]))


def cut(seq: Column, frame: Column, start: Column, end: Column) -> Column:
    """Bases start..end of the strand that a frame is read on."""
    return F.substr(F.when(frame < 0, revcomp(seq)).otherwise(seq), start.cast("int"), (end - start + 1).cast("int"))


def filter_phmm_full(df: DataFrame, hits: DataFrame, key: str = "name", seq: str = "seq", **limits) -> DataFrame:
    """df with fate 'filter_phmm_full' for records without a retained hit; retained ones are cut to it (seq) and, if hits have proteins, get its protein and phmm columns."""
    h = full_hits(hits, key, **limits)
    kept = h.filter("retained").select(key, F.col("frame").alias("_f"), F.col("nuc_from").alias("_a"), F.col("nuc_to").alias("_b"), *([F.substr("protein", F.col("penv_from").cast("int"), (F.col("penv_to") - F.col("penv_from") + 1).cast("int")).alias("hit_protein")] if "protein" in h.columns else []))
    out = df.join(kept, key, "left")
    return removed(out, "filter_phmm_full", F.col("_f").isNull()).withColumn(seq, F.when(F.col("_f").isNotNull(), cut(F.col(seq), F.col("_f"), F.col("_a"), F.col("_b"))).otherwise(F.col(seq))).drop("_f", "_a", "_b")


def removal_audit(df: DataFrame, hits: DataFrame, key: str = "name", **limits) -> DataFrame:
    """key, removal_type ('excluded_hit' or 'no_hit') and the flags of all records that filter_phmm_full removes."""
    h = full_hits(hits, key, **limits)
    flags = [c for c in h.columns if c.startswith("fail_")]
    bad = h.filter(~F.col("retained")).select(key, F.lit("excluded_hit").alias("removal_type"), *flags)
    none = df.select(key).distinct().join(h.select(key), key, "left_anti").select(key, F.lit("no_hit").alias("removal_type"), *[F.lit(None).cast("boolean").alias(f) for f in flags])
    return bad.join(df.select(key).distinct(), key, "left_semi").unionByName(none)


def amplicon_hits(hits: DataFrame, bases: str = "bases", name: str = "name", primer_info: dict | None = None, remove_primers: bool = False, trim: bool = False, min_cov: float = 0.95, min_length: int = 100) -> DataFrame:
    """The best hit of each name against the amplicon's model, forced to the model's ends, with nuc_from, nuc_to, nuc_len, phmm_cov, amp_cov and `retained`.

    primer_info: offset_start, offset_end, plen_start, plen_end, pad_start, pad_end. With remove_primers the primers' bases are cut off, else kept with padding. Length
    counts only where records are trimmed. amp_cov is the share of the ideal amplicon and filters nothing.
    """
    p = dict.fromkeys(["offset_start", "offset_end", "plen_start", "plen_end", "pad_start", "pad_end"], 0) | (primer_info or {})
    c, zero = F.col, F.lit(0)
    h = best_hits(hits, name)
    h = h.withColumn("hmm_start_gap", c("hmm_from") - 1).withColumn("hmm_end_gap", c("query_len") - c("hmm_to"))
    h = h.withColumn("force_from", F.greatest(c("ali_from") - c("hmm_start_gap"), F.lit(1))).withColumn("force_to", F.least(c("ali_to") + c("hmm_end_gap"), c("target_len")))
    h = h.withColumn("start_gap", c("hmm_start_gap") - (c("ali_from") - c("force_from"))).withColumn("end_gap", c("hmm_end_gap") - (c("force_to") - c("ali_to")))
    if remove_primers:
        start = c("force_from") * 3 - 2 + F.greatest(zero, p["plen_start"] + p["offset_start"] - c("start_gap") * 3)
        end = c("force_to") * 3 - F.greatest(zero, p["plen_end"] - p["offset_end"] - c("end_gap") * 3)
        ideal = c("query_len") * 3 - p["offset_start"] + p["offset_end"] - p["plen_start"] - p["plen_end"]
    else:
        start = c("force_from") * 3 - 2 + F.least(zero, p["offset_start"] + c("start_gap") * 3 - p["pad_start"])
        end = c("force_to") * 3 + F.greatest(zero, p["offset_end"] - c("end_gap") * 3 + p["pad_end"])
        ideal = c("query_len") * 3 - p["offset_start"] + p["offset_end"] + p["pad_start"] + p["pad_end"]
    h = h.withColumn("nuc_from", F.greatest(F.lit(1), start)).withColumn("nuc_to", F.least(c(bases), end)).withColumn("nuc_len", c("nuc_to") - c("nuc_from") + 1)
    h = h.withColumn("phmm_cov", (c("hmm_to") - c("hmm_from") + 1) / c("query_len")).withColumn("amp_cov", c("nuc_len") / ideal)
    ok = c("phmm_cov") >= min_cov
    return h.withColumn("retained", F.coalesce(ok & (c("nuc_len") >= min_length) if trim else ok, F.lit(False)))


def filter_phmm_amplicon(df: DataFrame, hits: DataFrame, key: str = "name", seq: str = "seq", trim: bool = False, **limits) -> DataFrame:
    """df with fate 'filter_phmm_amplicon' for records without a retained hit; others are cut to it with trim. hits need `bases`, the record's length."""
    kept = amplicon_hits(hits, name=key, trim=trim, **limits).filter("retained").select(key, F.col("nuc_from").alias("_a"), F.col("nuc_to").alias("_b"))
    out = removed(df.join(kept, key, "left"), "filter_phmm_amplicon", F.col("_a").isNull())
    if trim:
        out = out.withColumn(seq, F.when(F.col("_a").isNotNull(), F.substr(seq, F.col("_a").cast("int"), (F.col("_b") - F.col("_a") + 1).cast("int"))).otherwise(F.col(seq)))
    return out.drop("_a", "_b")


def on_columns(protein: str, search_: Search) -> str:
    """A protein on the columns of its model, '-' where it has none: the alignment of records by a model instead of with each other."""
    a = search_.align(protein) if protein else None
    out = ["-"] * len(search_.p)
    for at, k in a["path"] if a else []:
        out[k] = protein[at]
    return "".join(out)


def align_to_profile(df: DataFrame, protein: str, seq: str, profile: Profile) -> DataFrame:
    """df with aligned: the codons of each record (in frame 1, protein its translation) on the model's columns, three bases a column, '---' for none; all rows are equally long. Null where protein is."""
    from pyspark.sql import types as T

    @F.pandas_udf(T.StringType())
    def run(p: pd.Series, s: pd.Series) -> pd.Series:
        both = [bool(x) and bool(y) for x, y in zip(p, s)]
        aligned = iter(Search(profile).align_all([x for x, ok in zip(p, both) if ok]))
        out = []
        for y, ok in zip(s, both):
            if not ok:
                out.append(None)
                continue
            row = ["---"] * len(profile)
            for at, k in next(aligned)["path"]:
                codon = y[3 * at : 3 * at + 3].upper()
                row[k] = codon if len(codon) == 3 else "---"
            out.append("".join(row))
        return pd.Series(out, dtype=object)

    return df.withColumn("aligned", run(protein, seq))


def binding_position(primer: str, profile: Profile, try_reverse: bool = True, min_score: float = 10.0) -> dict:
    """primer, start, end (columns of a model of nucleotides, from 1), score, orientation of the better of the primer and its complement.

    start, end and orientation are null where neither scores more than min_score; scores are in bits and hold the costs of the model's ends. Inosine and ambiguous letters score nothing.
    """
    from curaspark.functions.seq import COMPLEMENT_FROM, COMPLEMENT_TO

    plain_ = primer.upper().replace("-", "").replace("I", "N").replace("U", "T")
    tried = {"forward": plain_} | ({"reverse": plain_.translate(str.maketrans(COMPLEMENT_FROM, COMPLEMENT_TO))[::-1]} if try_reverse else {})
    s = Search(profile)
    scores = dict(zip(tried, s.best(list(tried.values()))))
    way = max(scores, key=lambda k: (scores[k], k == "forward"))
    if not plain_ or scores[way] <= min_score:
        return {"primer": primer, "start": None, "end": None, "score": float(scores[way]), "orientation": None}
    hit = s.align(tried[way])
    return {"primer": primer, "start": hit["hmm_from"], "end": hit["hmm_to"], "score": float(scores[way]), "orientation": way}


def model_row(seq: str, search_: Search, min_score: float = 100.0, min_length: int = 1, max_indel: int | None = None, check_frame: bool = True) -> str | None:
    """A nucleotide sequence on its model's columns ('-' for none; inserted bases are left out), null where it fits badly.

    It fits where the score is at least min_score, the runs of matched columns, those parted by gaps of fewer than max_indel bases counted as one, reach min_length, and
    with check_frame all inner gaps and insertions are multiples of 3.
    """
    s = seq.upper().replace("-", "").replace(".", "")
    if not s or search_.best([s])[0] < min_score:
        return None
    path = search_.align(s)["path"]
    runs, now = [], 1
    for (i, k), (j, m) in zip(path, path[1:]):
        lost, more = m - k - 1, j - i - 1
        if check_frame and (lost % 3 or more % 3):
            return None
        if lost or more:
            if max_indel is not None and max(lost, more) >= max_indel:
                runs.append(now)
                now = 0
        now += 1
    if max([*runs, now]) < min_length:
        return None
    row = ["-"] * len(search_.p)
    for i, k in path:
        row[k] = s[i]
    return "".join(row)


def fitted_to_profile(df: DataFrame, seq: str, profile: Profile, **limits) -> DataFrame:
    """The rows of df whose sequence fits a model of nucleotides, with `aligned`, its model_row(). Null sequences don't fit. limits: see model_row()."""
    from pyspark.sql import types as T

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        search_ = Search(profile)
        return pd.Series([None if x is None else model_row(x, search_, **limits) for x in s], dtype=object)

    return spread(df).withColumn("aligned", run(seq)).filter("aligned is not null")


def padded_alignment(rows: list[str], profile: Profile, pad: str = "-", check_frame: bool = True, min_score: float = 10.0) -> list[str]:
    """The rows of a small alignment with columns of `pad` put in where the model has columns that the alignment lacks, so both have the same columns.

    The alignment's most frequent letters are placed on the model. With check_frame missing inner columns must come in threes; columns that the model lacks stay.
    """
    from collections import Counter

    up = [r.upper().replace(".", "-") for r in rows]
    most = "".join(Counter(r[c] for r in up if r[c] != "-").most_common(1)[0][0] if any(r[c] != "-" for r in up) else "-" for c in range(len(up[0])))
    kept = [c for c, x in enumerate(most) if x != "-"]
    s = Search(profile)
    consensus = "".join(most[c] for c in kept)
    if not consensus or s.best([consensus])[0] < min_score:
        raise ValueError("the alignment does not fit the model")
    path = s.align(consensus)["path"]
    before = {kept[path[0][0]]: path[0][1]}
    for (i, k), (j, m) in zip(path, path[1:]):
        if m - k > 1:
            if check_frame and (m - k - 1) % 3:
                raise ValueError("columns are missing in other numbers than threes")
            before[kept[j]] = m - k - 1
    behind = len(profile) - 1 - path[-1][1]
    return ["".join(pad * before.get(c, 0) + x for c, x in enumerate(r)) + pad * behind for r in up]
