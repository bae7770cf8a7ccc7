"""Primers on a model's seed alignment: expansion, frames, place, orientation, and the amplicon's part of the alignment. All of it is small and runs in the driver."""

from __future__ import annotations

from collections import Counter
from itertools import product

import numpy as np

from curaspark.functions.seq import COMPLEMENT_FROM, COMPLEMENT_TO, IUPAC, protein_of
from curaspark.operators.profiles import AMINO, Profile, build_profile

_COMPLEMENT = str.maketrans(COMPLEMENT_FROM, COMPLEMENT_TO)
#: Most concrete sequences of a degenerate primer.
MOST = 100_000


def expanded(primer: str) -> list[str]:
    """All sequences that a degenerate primer stands for; inosine counts as N."""
    sets = [IUPAC[b] for b in primer.upper().replace("I", "N").replace("U", "T")]
    if np.prod([float(len(s)) for s in sets]) > MOST:
        raise ValueError(f"the primer stands for more than {MOST} sequences")
    return ["".join(x) for x in product(*sets)]


def orientations(fwd: str, rev: str) -> dict[str, str]:
    """fwd, rev and their reverse complements fwd_rc, rev_rc."""
    rc = lambda s: s.upper().translate(_COMPLEMENT)[::-1]
    return {"fwd": fwd.upper(), "rev": rev.upper(), "fwd_rc": rc(fwd), "rev_rc": rc(rev)}


def primer_proteins(fwd: str, rev: str, code: int) -> list[tuple[str, int, str]]:
    """(primer, frame, protein) of all concrete sequences of all orientations in the three forward frames, stops as X; each once."""
    out = {(name, f, protein_of(s[f - 1 :].encode(), code).decode().replace("*", "X")) for name, p in orientations(fwd, rev).items() for s in expanded(p) for f in (1, 2, 3)}
    return sorted(x for x in out if x[2])


def consensus(rows: list[str]) -> np.ndarray:
    """Share of each amino acid and gap ('-', last) in each column of an alignment; other letters count in no share."""
    letters = AMINO + "-"
    x = [r.upper().replace(".", "-") for r in rows]
    return np.array([[sum(r[c] == a for r in x) / len(x) for a in letters] for c in range(len(x[0]))])


def placed(protein: str, shares: np.ndarray) -> tuple[int, float]:
    """(start column from 1, mean share of its letters) of the best place of a protein fragment, without gaps; the first of equal ones. X agrees with nothing."""
    letters = AMINO + "-"
    index = [letters.find(a) for a in protein]
    n = len(shares) - len(index) + 1
    if n < 1:
        return 0, 0.0
    score = np.zeros(n)
    for k, i in enumerate(index):
        if i >= 0:
            score += shares[k : k + n, i]
    at = int(score.argmax())
    return at + 1, float(score[at]) / len(index)


def trim_seed(rows: list[str], fwd: str, rev: str, code: int, pad_fwd: int = 0, pad_rev: int = 0) -> tuple[list[str], dict[str, int], tuple[int, int]]:
    """(rows of the amplicon, primer_info, (first, last column)) of a seed alignment.

    Each orientation's concrete proteins are placed on the alignment; per frame the most frequent place counts (of equal ones that of the higher agreement), per
    orientation the frame with the highest mean agreement. The pair with the higher mean agreement, (fwd, rev_rc) or (rev, fwd_rc), gives
    start and end; equal means raise, and so does a start behind the end.
    """
    shares = consensus(rows)
    best: dict[str, tuple[float, int, int, int]] = {}
    for name in ("fwd", "rev", "fwd_rc", "rev_rc"):
        for f in (1, 2, 3):
            got = [(p, *placed(p, shares)) for n, g, p in primer_proteins(fwd, rev, code) if n == name and g == f]
            if not got:
                continue
            count = Counter(at for _, at, _ in got)
            mean = lambda at: float(np.mean([a for _, x, a in got if x == at]))
            at = max(count, key=lambda x: (count[x], mean(x), -x))
            best[name] = max(best.get(name, (-1.0, 0, 0, 0)), (mean(at), -f, at, len(got[0][0])))
    same = (best["fwd"][0] + best["rev_rc"][0]) / 2
    opposite = (best["rev"][0] + best["fwd_rc"][0]) / 2
    if same == opposite:
        raise ValueError("the primers fit the alignment equally well in both orientations")
    (_, f1, at1, len1), (_, f2, at2, len2) = (best["fwd"], best["rev_rc"]) if same > opposite else (best["rev"], best["fwd_rc"])
    first, last = at1, at2 + len2 - 1
    if first >= last:
        raise ValueError("the primers' start lies behind their end")
    start, end = (len(fwd), len(rev)) if same > opposite else (len(rev), len(fwd))
    pads = (pad_fwd, pad_rev) if same > opposite else (pad_rev, pad_fwd)
    info = {"offset_start": -(-f1 - 1), "offset_end": (end - (-f2 - 1)) % 3, "plen_start": start, "plen_end": end, "pad_start": pads[0], "pad_end": pads[1]}
    return [r[first - 1 : last] for r in rows], info, (first, last)


def amplicon_profile(rows: list[str], fwd: str, rev: str, code: int, pad_fwd: int = 0, pad_rev: int = 0) -> tuple[Profile, dict[str, int]]:
    """The model of the amplicon's part of a seed alignment, and its primer_info."""
    part, info, _ = trim_seed(rows, fwd, rev, code, pad_fwd, pad_rev)
    return build_profile("amplicon", part), info
