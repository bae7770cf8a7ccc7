"""Typed names to the entries of a reference list: symmetric deletes and weighted Damerau-Levenshtein (problem 2)."""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspark.functions.text import BLANK, capital, missing
from curaspark.llm.skew import hot_join
from curaspark.session import as_table, at_most, counted_table, spread

#: Most entries of the deletion dictionary that is broadcast (some 120 a name, 100 bytes each); a larger one is a table that is joined.
MAX_DELETIONS = 1_000_000
#: Most edits of an accepted name, and the largest weighted cost as a share of the listed name's length.
EDITS, COST_SHARE = 2, 0.25
#: A name cut short is one edit of this cost, from so many letters on.
CUT_COST, CUT_FROM = 1.5, 5

# Letters of other scripts that look like Latin ones, letters with two Latin ones, digits typed for letters.
LOOKALIKES = str.maketrans("авеёкмнорстухіјѕԁһԛԝαβεικνορτυχ", "abeekmhopctyxijsdhqwabeiknoptux")
LIGATURES = str.maketrans({"æ": "ae", "œ": "oe", "ß": "ss", "ø": "o", "ł": "l", "đ": "d"})
DIGITS = str.maketrans("01345", "oieas")
QUALIFIERS = r"(?:family|fam|familia|familie|cf|aff|near|nr|prob|probably|possibly|poss|sp|det|ex)"
CLOSE_KEYS = {frozenset(p) for p in ("qw we er rt ty yu ui io op as sd df fg gh hj jk kl zx xc cv vb bn nm qa ws ed rf tg yh uj ik ol az sx dc fv gb hn jm".split())}
SOUND_ALIKE = {frozenset(p) for p in ("iy", "ck", "cs", "sz", "fv", "ae", "oe", "ei", "ou", "ao", "kq", "uv", "dt", "bp", "mn")}
#: What a letter that scanners take for another one costs; it is no edit.
LOOKS_COST = 0.2


def plain(s: str) -> str:
    """Lower case, Latin letters for look-alikes, no accents and no marks without width."""
    s = unicodedata.normalize("NFKC", s).lower()
    if not s.isascii():
        s = unicodedata.normalize("NFD", s.translate(LOOKALIKES).translate(LIGATURES))
        s = "".join(c for c in s if unicodedata.category(c) not in ("Mn", "Cf"))
    return " ".join(s.split())


def readings(value: str) -> list[list[str]]:
    """What a typed value may say: alternatives (of 'A / B', all must agree), each a list of words to look up in turn."""
    s = plain(value)
    s = re.sub(r"\[[^\]]*\]|\([^)]*\)|[\"'“”„‘’«»`]", " ", s)
    s = re.sub(r"^[a-z]+\s*:\s*(?=[a-z0-9])", "", s.strip())
    s = s.split(";")[0]
    out = []
    for part in re.split(r"\s*(?:/|&|\bor\b)\s*", s):
        part = re.sub(r",.*$", "", part)
        part = re.sub(r"\b(?:s\.?\s?l\.?|s\.?\s?str\.?|sensu\s+\w+|auctt?\.?)\s*$", "", part)
        part = re.sub(rf"^(?:{QUALIFIERS}\b\.?:?\s*)+", "", part.strip())
        part = re.sub(rf"\s*\b{QUALIFIERS}\.?\s*$", "", part)
        part = part.strip(" ?!*.,:-_")
        words = part.split()
        if not words:
            continue
        forms = ["".join(words)] if len(words) < 4 else []
        if len(words) > 1:
            forms.append(words[0])
            if re.fullmatch(r"\d{4}", words[-1]) and len(words) > 2:
                forms.append("".join(words[:-2]))
        forms = [re.sub(r"[^a-z0-9]", "", f) for f in forms]
        forms += [f.translate(DIGITS) for f in forms if re.search(r"\d", f)]
        out.append([f for f in dict.fromkeys(forms) if f and not f.isdigit()])
    return [x for x in out if x]


def deletions(word: str, most: int) -> set[str]:
    """word and all that is left of it after deleting up to `most` letters."""
    out = {word}
    for n in range(1, min(most, len(word) - 1) + 1):
        out.update("".join(word[i] for i in range(len(word)) if i not in cut) for cut in map(set, combinations(range(len(word)), n)))
    return out


def key(word: str) -> str:
    """A word as the deletion dictionary sees it: letters that scanners take for each other as one."""
    return word.replace("l", "i")


def dictionary_keys(word: str, edits: int) -> set[str]:
    """The keys of a listed word: its deletions, and its beginnings, which are deletions of an end in one piece."""
    k = key(word)
    return deletions(k, edits) | {k[:n] for n in range(CUT_FROM, len(k))}


def weighted_distance(a: str, b: str) -> tuple[int, float]:
    """(edits, cost) of turning a into b by insertions, deletions, substitutions, swaps of neighbours and one end of b that a lacks.

    Costs: a swap 0.6, a letter doubled or undone 0.5, a neighbouring key 0.7, letters that sound alike 0.6, any vowel for
    a vowel 0.8, l for i 0.2 and no edit, an end cut off CUT_COST where it is more than one letter, else 1. The cost is the least of those with the fewest edits.
    """
    prev2: list[tuple[int, float]] = []
    prev = [(0, 0.0)]
    for j in range(1, len(b) + 1):
        prev.append((prev[-1][0] + 1, prev[-1][1] + (0.5 if j > 1 and b[j - 1] == b[j - 2] else 1.0)))
    for i in range(1, len(a) + 1):
        now = [(i, prev[0][1] + (0.5 if i > 1 and a[i - 1] == a[i - 2] else 1.0))]
        for j in range(1, len(b) + 1):
            x, y = a[i - 1], b[j - 1]
            if x == y:
                now.append(prev[j - 1])
                continue
            pair = frozenset((x, y))
            if pair == _LI:
                best = (prev[j - 1][0], prev[j - 1][1] + LOOKS_COST)
            else:
                sub = 0.6 if pair in SOUND_ALIKE else 0.7 if pair in CLOSE_KEYS else 0.8 if x in "aeiouy" and y in "aeiouy" else 1.0
                best = (prev[j - 1][0] + 1, prev[j - 1][1] + sub)
            less = (prev[j][0] + 1, prev[j][1] + (0.5 if i > 1 and x == a[i - 2] else 1.0))
            more = (now[j - 1][0] + 1, now[j - 1][1] + (0.5 if j > 1 and y == b[j - 2] else 1.0))
            best = min(best, less, more)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, (prev2[j - 2][0] + 1, prev2[j - 2][1] + 0.6))
            now.append(best)
        prev2, prev = prev, now
    cut = min(((n + 1, c + CUT_COST) for n, c in prev[CUT_FROM:-2]), default=prev[-1])
    return min(prev[-1], cut)


_LI = frozenset("li")


def accepted(form: str, word: str, edits: int = EDITS) -> float | None:
    """The cost of a listed word for a form, null beyond the bounds."""
    n, cost = weighted_distance(form, word)
    return round(cost, 6) if n <= edits and cost <= COST_SHARE * len(word) else None


#: A listed word: (word, how often it is listed, what it means: canonical name and parent).
Entry = tuple[str, int, frozenset[tuple[str, str]]]


def choose(scored: list[tuple[float, Entry]], parent: str | None) -> str | None:
    """The name that is meant among words with their costs: the least cost decides, of equal costs the word listed most often; none where
    that leaves several names. Words known below other parents only don't count, but one that is spelled so exactly keeps others from counting."""
    if not scored:
        return None
    if min(c for c, _ in scored) == 0:
        scored = [(c, e) for c, e in scored if c == 0]
    best: list[tuple[tuple[float, int], set[str]]] = []
    for cost, (_, often, meanings) in scored:
        names = {n for n, p in meanings if parent is None or p == parent}
        if names:
            best.append(((cost, -often), names))
    least = min((rank for rank, _ in best), default=None)
    names = set().union(*(n for rank, n in best if rank == least))
    return names.pop() if len(names) == 1 else None


def meant(answers: list[list[tuple[float, Entry]]], parent: str | None) -> str | None:
    """The one name of all readings of a value that say one. answers: for each reading the words of all its forms, with their costs."""
    found = {name for scored in answers if (name := choose(scored, parent))}
    return found.pop() if len(found) == 1 else None


def bare(name: str) -> str:
    """A listed name without author and year, in plain letters."""
    return re.sub(r"[^a-z0-9]", "", (plain(name).split() or [""])[0])


def entries(rows: list[tuple[str | None, str, str]]) -> list[Entry]:
    """The words of a list of (synonym, name, parent); repeated rows count as reference frequency."""
    meanings: dict[str, set[tuple[str, str]]] = defaultdict(set)
    often: dict[str, int] = defaultdict(int)
    for synonym, name, parent in rows:
        for word in (bare(name), bare(synonym or "")):
            if word:
                meanings[word].add((name, parent))
                often[word] += 1
    return [(w, often[w], frozenset(m)) for w, m in meanings.items()]


class NameIndex:
    """The deletion dictionary of a reference list, made once and broadcast."""

    def __init__(self, rows: list[tuple[str | None, str, str]], edits: int = EDITS):
        """rows: synonym, name, parent."""
        self.edits = edits
        self.entries = entries(rows)
        self.exact = {n for _, n, _ in rows}
        self.longest = max((len(w) for w, _, _ in self.entries), default=0)
        self.deletes: dict[str, list[int]] = defaultdict(list)
        for i, (word, _, _) in enumerate(self.entries):
            for d in dictionary_keys(word, edits):
                self.deletes[d].append(i)
        self._caches()

    def _caches(self) -> None:
        self.look = lru_cache(1 << 18)(self._look)
        self.words = lru_cache(1 << 18)(self._words)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("look", "words")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._caches()

    def _words(self, form: str) -> list[tuple[float, Entry]]:
        """Listed words within the bounds of a form, with their costs."""
        if len(form) > self.longest + self.edits:
            return []  # further than the bound from every listed word
        near = {i for d in deletions(key(form), self.edits) for i in self.deletes.get(d, ())}
        return [(cost, self.entries[i]) for i in near if (cost := accepted(form, self.entries[i][0], self.edits)) is not None]

    def _look(self, value: str, parent: str | None) -> str | None:
        return meant([[w for form in forms for w in self.words(form)] for forms in readings(value)], parent)


def listed(synonyms: DataFrame) -> DataFrame:
    """The families of ncbi_synonyms_filtered: synonym, tax_name, parent_taxon, blanks trimmed; rows without a name are left out."""
    tidy = lambda c: F.btrim(F.regexp_replace(F.coalesce(c, F.lit("")), rf"{BLANK}+", " "))
    rows = synonyms.filter(F.lower(F.trim("rank")) == "family").select("synonym", tidy("tax_name").alias("tax_name"), capital(tidy("parent_taxon")).alias("parent_taxon"))
    return rows.filter("tax_name <> ''")


def _tidy_parent(p: str | None) -> str | None:
    return None if p is None or " ".join(p.split()).lower() in ("", "none", "unclassified") else " ".join(p.split()).capitalize()


def canonical_names(df: DataFrame, value: str, parent: str, names: DataFrame, most: int = MAX_DELETIONS) -> DataFrame:
    """df with tax_name: the canonical name that `value` means, null where it means none or more than one. names: see listed().

    Where `parent` is not missing, only names below that parent count. A missing value means none. A value that is exactly
    canonical means itself. The dictionary of the list's deletions is broadcast while it has at most `most` entries; each task then looks a value up
    once, nothing shuffles, and a value with a third of the rows is no burden. Beyond that it is a table (see _joined()) that gives the same.
    df must have no column tax_name of its own (it is replaced). An empty table gives no rows.
    """
    if not at_most(names, most // 50):
        return _joined(df, value, parent, names)
    index = NameIndex([(r.synonym, r.tax_name, r.parent_taxon) for r in names.collect()])  # at most `most` / 50 rows
    if sum(map(len, index.deletes.values())) > most:
        return _joined(df, value, parent, names)
    shared = df.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("string")
    def look(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        index = shared.value
        for values, parents in batches:
            yield pd.Series([None if v is None else (v if v in index.exact else index.look(v, _tidy_parent(p))) for v, p in zip(values, parents)], dtype=object)

    return spread(df).withColumn("tax_name", F.when(~missing(F.col(value)), look(F.col(value), F.col(parent))))


def _joined(df: DataFrame, value: str, parent: str, names: DataFrame) -> DataFrame:
    """canonical_names() for a list of any length: words, deletions and distinct values are tables, joined over equal deletions.

    A value is looked up once for all its rows; the answers come back by a join in which values with many rows are broadcast.
    """
    words_of = F.pandas_udf(lambda s: s.map(lambda x: bare(x or "")), "string")
    words = names.select(F.explode(F.array(words_of("tax_name"), words_of("synonym"))).alias("word"), F.struct("tax_name", "parent_taxon").alias("m")).filter("word <> ''")
    words = as_table(words.groupBy("word").agg(F.count(F.lit(1)).alias("often"), F.collect_set("m").alias("meanings")))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(d, w) for w in b.word for d in dictionary_keys(w, EDITS)], columns=["d", "word"])

    deletes = words.select("word").mapInPandas(keyed, "d string, word string")
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0
    asked, total = counted_table(df.select(F.col(value).alias("v"), F.col(parent).alias("p")).filter(~missing(F.col("v"))))
    counts = as_table(asked.groupBy("v", "p").agg(F.count(F.lit(1)).alias("n")))
    exact = names.select(F.col("tax_name").alias("v")).distinct()

    def formed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(v, i, f, d) for v in b.v for i, forms in enumerate(readings(v)) for f in forms if len(f) <= longest + EDITS for d in deletions(key(f), EDITS)]
            yield pd.DataFrame(rows, columns=["v", "i", "form", "d"])

    @F.pandas_udf("double")
    def cost(forms: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([accepted(f, w) for f, w in zip(forms, found)], dtype="float64")

    forms = counts.select("v").distinct().join(exact, "v", "left_anti").mapInPandas(formed, "v string, i int, form string, d string")
    near = forms.join(deletes, "d").select("v", "i", "form", "word").distinct().withColumn("cost", cost("form", "word")).filter("cost is not null")
    near = near.join(words, "word").groupBy("v", "i").agg(F.collect_list(F.struct("cost", "word", "often", "meanings")).alias("words"))

    @F.pandas_udf("string")
    def decide(parents: pd.Series, answers: pd.Series) -> pd.Series:
        out = []
        for p, answer in zip(parents, answers):
            scored = [[(w["cost"], (w["word"], w["often"], frozenset((m["tax_name"], m["parent_taxon"]) for m in w["meanings"]))) for w in a["words"]] for a in answer]
            out.append(meant(scored, _tidy_parent(p)))
        return pd.Series(out, dtype=object)

    answers = near.groupBy("v").agg(F.collect_list(F.struct("words")).alias("answers"))
    told = counts.join(answers, "v").select("v", "p", "n", decide("p", "answers").alias("tax_name"))
    own = counts.join(exact, "v", "left_semi").select("v", "p", "n", F.col("v").alias("tax_name"))
    told = as_table(told.unionByName(own).filter("tax_name is not null").withColumn("k", F.struct(F.coalesce("v", F.lit("")), F.coalesce("p", F.lit("\0")))).select("k", "n", "tax_name"))
    rows = df.drop("tax_name").withColumn("k", F.struct(F.coalesce(value, F.lit("")), F.coalesce(parent, F.lit("\0"))))
    return hot_join(rows, told, ["k"], "n", max(total, 1), "left").drop("k", "n")


def mapped(df: DataFrame, synonyms: DataFrame, row_id: str, value: str, parent: str, most: int = MAX_DELETIONS) -> DataFrame:
    """row_id, value, tax_name, status of each row: exact, mapped, missing, or unmatched (the report of misses)."""
    out = canonical_names(df.select(row_id, value, parent), value, parent, listed(synonyms), most)
    status = F.when(missing(F.col(value)), "missing").when(F.col("tax_name").isNull(), "unmatched").when(F.col("tax_name") == F.col(value), "exact").otherwise("mapped")
    return out.select(row_id, value, "tax_name", status.alias("status"))
