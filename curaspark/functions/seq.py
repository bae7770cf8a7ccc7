"""Column expressions on nucleotide sequences. All run in the JVM but translation, which is vectorised over Arrow batches."""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# IUPAC nucleotides, their complements, and the public genetic codes in the order TTT, TTC, TTA, TTG, TCT, ...
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "M": "AC", "K": "GT", "S": "CG", "W": "AT", "H": "ACT", "B": "CGT", "V": "ACG", "D": "AGT", "N": "ACGT"}
COMPLEMENT_FROM = "ACGTURYMKSWHBVDNacgturymkswhbvdn"
COMPLEMENT_TO = "TGCAAYRKMSWDVBHNtgcaayrkmswdvbhn"
AMBIGUOUS = "[RYSWKMBDHVNIUryswkmbdhvniu]"
BASES = "TCAG"
GENETIC_CODES = {
    1: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    2: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSS**VVVVAAAADDEEGGGG",
    3: "FFLLSSSSYY**CCWWTTTTPPPPHHQQRRRRIIMMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    4: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    5: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSSSSVVVVAAAADDEEGGGG",
    6: "FFLLSSSSYYQQCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    9: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNNKSSSSVVVVAAAADDEEGGGG",
    10: "FFLLSSSSYY**CCCWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    11: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    12: "FFLLSSSSYY**CC*WLLLSPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    13: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSSGGVVVVAAAADDEEGGGG",
    14: "FFLLSSSSYYY*CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNNKSSSSVVVVAAAADDEEGGGG",
    16: "FFLLSSSSYY*LCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    21: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNNKSSSSVVVVAAAADDEEGGGG",
    22: "FFLLSS*SYY*LCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    23: "FF*LSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    24: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSSKVVVVAAAADDEEGGGG",
    25: "FFLLSSSSYY**CCGWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    26: "FFLLSSSSYY**CC*WLLLAPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    27: "FFLLSSSSYYQQCCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    28: "FFLLSSSSYYQQCCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    29: "FFLLSSSSYYYYCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    30: "FFLLSSSSYYEECC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    31: "FFLLSSSSYYEECCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    32: "FFLLSSSSYY*WCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    33: "FFLLSSSSYYY*CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSSKVVVVAAAADDEEGGGG",
}


def codon_of(code: int, codon: str) -> str:
    """Amino acid of a codon, X where its ambiguity leaves more than one."""
    table = GENETIC_CODES[code]
    got = {table[16 * BASES.index(a) + 4 * BASES.index(b) + BASES.index(c)] for a, b, c in product(*(IUPAC.get(x, "") for x in codon))}
    return got.pop() if len(got) == 1 else "X"


def ambiguous_codons(code: int) -> dict[str, str]:
    """The codons with an ambiguous base that still name one amino acid (or stop)."""
    return {c: a for c in map("".join, product(IUPAC, repeat=3)) if not set(c) <= set(BASES) and (a := codon_of(code, c)) != "X"}


def revcomp(s: Column) -> Column:
    """Reverse complement; signs that are no nucleotides stay."""
    return F.reverse(F.translate(s, COMPLEMENT_FROM, COMPLEMENT_TO))


def dealigned(s: Column) -> Column:
    """Without gaps."""
    return F.translate(s, "-.", "")


def gapless_length(s: Column) -> Column:
    return F.length(dealigned(s))


def clean_dna(s: Column) -> Column:
    """Upper case, U as T, without gaps; what is no nucleotide becomes N."""
    return F.regexp_replace(F.translate(F.upper(s), "U-.", "T"), "[^ACGTRYMKSWHBVDN]", "N")


def is_ambiguous(s: Column) -> Column:
    """Whether a letter other than A, C, G, T (of either case) occurs: any IUPAC ambiguity, inosine or uracil."""
    return s.rlike(AMBIGUOUS)


def frame(s: Column, f: int) -> Column:
    """Reading frame 1, 2, 3, or -1, -2, -3 of the reverse complement, cut to whole codons."""
    t = F.substring(s if f > 0 else revcomp(s), abs(f), 1_000_000_000)
    return F.substring(t, F.lit(1), (F.length(t) - F.length(t) % 3).cast("int"))


def six_frames(s: Column) -> Column:
    """Array of (frame, seq) for the six frames."""
    return F.array(*[F.struct(F.lit(f).alias("frame"), frame(s, f).alias("seq")) for f in (1, 2, 3, -1, -2, -3)])


@lru_cache(None)
def _codon_table(code: int) -> np.ndarray:
    """Amino acids of all codons of 15 IUPAC letters and one for anything else, 16 ** 3 entries."""
    letters = "".join(IUPAC) + "?"
    return np.frombuffer("".join(codon_of(code, c) if "?" not in c else "X" for c in map("".join, product(letters, repeat=3))).encode(), np.uint8)


_LETTER = np.full(256, 15, np.uint16)
for _i, _b in enumerate("".join(IUPAC).encode()):
    _LETTER[_b] = _LETTER[_b + 32] = _i
_COMPLEMENT = np.arange(256, dtype=np.uint8)
_COMPLEMENT[list(COMPLEMENT_FROM.encode())] = list(COMPLEMENT_TO.encode())


def protein_of(s: bytes, code: int) -> bytes:
    """Protein of the whole codons of a sequence."""
    x = _LETTER[np.frombuffer(s, np.uint8)[: len(s) // 3 * 3]].reshape(-1, 3)
    return _codon_table(code)[x[:, 0] * 256 + x[:, 1] * 16 + x[:, 2]].tobytes()


@F.pandas_udf(T.StringType())
def _translate(s: pd.Series, code: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or c is None or c != c or int(c) not in GENETIC_CODES else protein_of(x.encode(), int(c)).decode() for x, c in zip(s, code)], dtype=object)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _stops(s: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else np.flatnonzero(np.frombuffer(x.encode(), np.uint8) == 42) + 1 for x in s], dtype=object)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _stop_counts(s: pd.Series, code: pd.Series) -> pd.Series:
    def six(x: str, c: int) -> list[int]:
        b = x.encode()
        r = _COMPLEMENT[np.frombuffer(b, np.uint8)][::-1].tobytes()
        return [protein_of(y[i:], c).count(b"*") for y in (b, r) for i in (0, 1, 2)]

    return pd.Series([None if x is None else six(x, int(c)) for x, c in zip(s, code)], dtype=object)


def translated(s: Column, code: int | Column) -> Column:
    """Protein of the whole codons of a sequence by a genetic code: '*' for a stop, X for an ambiguity without one meaning. Null for null and
    for an unknown code. Vectorised in Arrow batches: a lambda over codons runs uncompiled in the JVM and took a hundred times as long."""
    return _translate(s, F.lit(code) if isinstance(code, int) else code.cast("int"))


def stop_positions(protein: Column) -> Column:
    """Positions from 1 of the stops in a protein."""
    return _stops(protein)


def stop_counts(s: Column, code: int) -> Column:
    """Array of the numbers of stop codons in frames 1, 2, 3, -1, -2, -3."""
    return _stop_counts(s, F.lit(code))


def jukes_cantor(p: Column) -> Column:
    """Jukes-Cantor distance of a share of differing sites; infinite from 3/4 on."""
    return F.when(p < 0.75, -0.75 * F.ln(1 - 4 * p / 3)).otherwise(F.lit(float("inf")))


def kmers(s: Column, k: int) -> Column:
    """Array of all k-mers, repeated ones included."""
    n = F.length(s) - (k - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(s, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def random_seqs(spark: SparkSession, n: int, length: int, alphabet: str = "ACGT", seed: int = 0) -> DataFrame:
    """name (Seq, Seq_1, Seq_2, ...), seq of n random sequences, each fixed by seed and number."""
    letters = F.array(*[F.lit(a) for a in alphabet])
    letter = lambda i: F.element_at(letters, (F.pmod(F.xxhash64(F.lit(seed), F.col("id"), i), F.lit(len(alphabet))) + 1).cast("int"))
    seq = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(length)), letter), "") if length > 0 else F.lit("")
    return spark.range(n).select(F.when(F.col("id") == 0, "Seq").otherwise(F.concat(F.lit("Seq_"), F.col("id").cast("string"))).alias("name"), seq.alias("seq"))


def acc_to_hex(acc: Column) -> Column:
    """An accession as lower-case hexadecimal digits."""
    return F.lower(F.hex(F.encode(acc, "UTF-8")))


def hex_to_acc(h: Column) -> Column:
    """The inverse of acc_to_hex; null for what is no hexadecimal text."""
    return F.decode(F.unhex(h), "UTF-8")
