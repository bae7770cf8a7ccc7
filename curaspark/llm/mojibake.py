"""Texts that were read in a wrong character encoding: found and restored by character n-gram models (problem 8)."""

from __future__ import annotations

import codecs
import html
import math
import re
import unicodedata
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.session import as_table, spread

# Encodings that texts are wrongly read in (with what makes 'latin' one of two), and those they were written in.
READ_IN = [
    "latin", "cp1250", "iso8859-2", "cp1251", "koi8-r", "mac-roman", "cp437", "cp850", "cp852", "cp866", "cp1253", "cp1254", "cp932", "gbk",
]
WRITTEN_IN = ["utf-8", *READ_IN, "euc-jp", "big5", "euc-kr"]
_MULTIBYTE = {"cp932", "gbk"}
#: Steps of a chain. All steps but the last of a longer one end in UTF-8, as texts are damaged when they are stored and read again.
DEPTH = 3
#: Most n-grams of each order that a model holds, the most frequent ones. Rarer trigrams are judged by bigrams and single characters, whose counts stay whole.
MAX_GRAMS = 2_000_000
#: Gains (natural logarithms of likelihood ratios) are counted in steps of this width up to TOP steps; texts beyond are garbled at any margin.
STEP, TOP = 0.5, 120
#: Texts that stand for what is known beforehand, and the means with which the gains of clean and of garbled ones fall off exponentially.
PRIOR_TEXTS, PRIOR_CLEAN, PRIOR_GARBLED = 20.0, 1.5, 40.0
#: Occurrences, as shares of the corpus, from which the context of one and of two characters outweighs shorter ones.
TRUST = (1e-4, 2e-5)
#: Log-likelihood of a sign that no writer means, such as a C1 control.
NEVER = -12.0
#: Log-likelihood of the loss of a character's bytes in a rereading.
LOSS = -7.0
#: What a further step of a chain has to gain.
STEP_COST = 2.0
#: A chain that falls so far behind the best one of a text's current islands is given up; it begins again where it next gains.
BEAM = 25.0
#: Windows without any gain, windows with one, and islands whose results a worker keeps; the results of an island are some tens of kilobytes.
CALM, KEPT, FEW = 1 << 17, 1 << 15, 1 << 13
#: Signs that a text may hold, as far as smoothing goes.
SIGNS = 2e4
_LOST, _UNSEEN = "�", "\U000e0080"
_ISLAND = re.compile(r"[^\x00-\x7f](?:[^ \t\r\n\f\v　]*[^\x00-\x7f])?")
_ENTITY = re.compile(r"&[A-Za-z]{2,8}\d{0,2};|&#\d{2,6};")
#: Signs that a text in UTF-8 is likely to hold: Latin, Greek, Cyrillic, accents, punctuation, symbols, kana, Han, wide forms, pictures.
_LIKELY = re.compile(
    "[\x00-\x7f\xa0-ɏʰ-˿̀-ͯͰ-ϿЀ-ѯҐґḀ-ỿ -➿　-ヿ一-鿿＀-￯\U0001f300-\U0001faff]*"
)
_DIGITS = str.maketrans("123456789\t\r\n", "000000000   ")
#: Raw characters to each side of an island that its context is taken from.
_SIDE = 5


def _tables() -> tuple[dict[str, dict[int, int]], dict[str, str]]:
    """Encoding maps and decoding tables of single-byte encodings; a byte without a sign stands for the control of its number."""
    enc, dec = {}, {}
    for name in READ_IN:
        if name in _MULTIBYTE:
            continue
        sign = [bytes([i]).decode("cp1252" if name == "latin" else name, "replace") for i in range(256)]
        sign = [chr(i) if s == _LOST else s for i, s in enumerate(sign)]
        dec[name] = "".join(sign)
        enc[name] = {ord(s): i for i, s in enumerate(sign)}
        for i in range(128, 160):
            enc[name].setdefault(i, i)
    return enc, dec


_ENCODE, _DECODE = _tables()


def _encoded(s: str, y: str, errors: str = "strict") -> bytes | None:
    try:
        if y in _MULTIBYTE:
            return s.encode(y, errors)
        return codecs.charmap_encode(s, errors, _ENCODE[y] if errors == "strict" else _ENCODE[y] | {ord("?"): 63})[0]
    except UnicodeError:
        return None


def _decoded(b: bytes, x: str, errors: str = "strict") -> str | None:
    try:
        return codecs.charmap_decode(b, errors, _DECODE[x])[0] if x in _DECODE else b.decode(x, errors)
    except UnicodeError:
        return None


def _signs(y: str) -> str:
    """All signs that an encoding can encode, as the inside of a set of a regular expression."""
    codes = sorted(_ENCODE[y]) if y in _ENCODE else [c for c in range(0x10000) if not 0xD800 <= c < 0xE000 and _encoded(chr(c), y) is not None]
    return "".join(re.escape(chr(c)) for c in codes)


#: Maximal runs of signs that an encoding can encode; one that bears a combining mark which it can't encode belongs to none.
_MARKS = "̀-ͯ᪰-᫿᷀-᷿⃐-⃿゙゚︠-︯"
_RUNS = {y: re.compile(f"[{_signs(y)}]+(?![{_MARKS}])") for y in READ_IN}


def reread(s: str, read_in: str, written_in: str) -> str | None:
    """s as it would be had it been read in `written_in` instead of `read_in`; null where the bytes don't allow that."""
    b = _encoded(s, read_in)
    return None if b is None else _decoded(b, written_in)


@lru_cache(FEW)
def rereadings(s: str, depth: int = DEPTH) -> tuple[tuple[tuple, str], ...]:
    """(chain, text) of all rereadings that change s, over one step or, where a step ends in UTF-8, up to `depth` steps.

    A UTF-8 reading whose bytes are partly lost counts as a chain of its own ('utf-8?'), with replacement characters for the loss.
    """
    return tuple(r for y in READ_IN for r in _rereadings_in(s, y, depth))


def _rereadings_in(s: str, y: str, depth: int = DEPTH) -> list[tuple[tuple, str]]:
    """The rereadings of s whose first step takes it as read in y."""
    out: list[tuple[tuple, str]] = []
    b = _encoded(s, y)
    if b is None:
        return out
    for x in WRITTEN_IN:
        if x == y:
            continue
        t = _decoded(b, x)
        if t is None:
            if x == "utf-8":
                out.append((((y, "utf-8?"),), b.decode("utf-8", "replace")))
        elif t != s:
            out.append((((y, x),), t))
            if x == "utf-8" and depth > 1:
                out += [(((y, x), *chain), u) for chain, u in rereadings(t, depth - 1)]
    return out


@lru_cache(FEW)
def variants(core: str, read_in: str | None = None) -> tuple[tuple[str, tuple[tuple, ...]], ...]:
    """(folded text, chains that give it) of each rereading of an island, or of a run in one by one encoding."""
    by: dict[str, list[tuple]] = {}
    for chain, t in rereadings(core) if read_in is None else _rereadings_in(core, read_in):
        by.setdefault(t, []).append(chain)
    return tuple((folded(t), tuple(_SAME.setdefault(c, c) for c in chains)) for t, chains in by.items())


#: Every chain once, as results name few of them often.
_SAME: dict[tuple, tuple] = {}


@lru_cache(FEW)
def places(core: str, read_in: str | None = None) -> dict[tuple, int]:
    """The place in variants() of each chain; one with a loss is there only if it says so."""
    return {c: i for i, (t, chains) in enumerate(variants(core, read_in)) for c in chains if _LOST not in t or c[-1][1] == "utf-8?"}


@lru_cache(KEPT)
def cuts(s: str) -> tuple[tuple[str, int, int], ...]:
    """(encoding, start, end) of the maximal runs with signs beyond ASCII that an encoding can encode, for encodings that can't encode all of s.

    Writing without blanks, such as Japanese, puts clean and garbled signs into one island; the runs end where an encoding's signs end.
    """
    return tuple((y, *m.span()) for y in READ_IN for m in _RUNS[y].finditer(s) if len(m[0]) < len(s) and not m[0].isascii())


@lru_cache(KEPT)
def looks_reread(s: str) -> bool:
    """Whether s bears structural marks: a replacement character, a control, or a run whose bytes happen to be UTF-8 in some encoding."""
    if _LOST in s or any("\x80" <= c < "\xa0" for c in s):
        return True
    for y in READ_IN:
        for r in _RUNS[y].findall(s):
            if not r.isascii() and (t := reread(r, y, "utf-8")) is not None and t != r and _LIKELY.fullmatch(t):
                return True
    return False


def folded(s: str) -> str:
    """Text as the model sees it: composed, any digit as 0, any blank as a space."""
    return unicodedata.normalize("NFC", s).translate(_DIGITS)


_folded_side = lru_cache(1 << 16)(folded)


def islands(text: str) -> list[tuple[int, int]]:
    """Where the stretches between blanks lie that begin and end with a sign beyond ASCII."""
    return [m.span() for m in _ISLAND.finditer(text)]


class CharModel:
    """Interpolated trigrams of characters (Witten-Bell like weights), smoothed down to single characters.

    tri, bi, uni: counts of n-grams; after and first: counts of the contexts of two and of one character.
    """

    def __init__(self, tri: dict[str, int], bi: dict[str, int], after: dict[str, int], uni: dict[str, int], first: dict[str, int]):
        self.tables = tri, bi, after, uni, first
        self.tri, self.bi, self.after, self.uni, self.first = self.tables
        self.total = sum(uni.values()) + 1
        # Contexts seen seldom against the size of the corpus say little: some are of garbled texts that passed for clean.
        self.trust2, self.trust3 = max(4.0, self.total * TRUST[0]), max(2.0, self.total * TRUST[1])
        self.logp = lru_cache(1 << 18)(self._logp)
        self.lost = lru_cache(1 << 14)(self._lost)
        self.high: dict[str, list[str]] = defaultdict(list)
        for g in bi:
            if g[1] > "\x7f" and g[1] != _LOST:
                self.high[g[0]].append(g[1])

    def __reduce__(self):
        return CharModel, self.tables

    @classmethod
    def of(cls, tri: dict[str, int]) -> CharModel:
        """The model of trigram counts from which none were dropped."""
        parts = [Counter() for _ in range(4)]
        for g, n in tri.items():
            for c, k in zip(parts, (g[1:], g[:2], g[2], g[1])):
                c[k] += n
        return cls(tri, *map(dict, parts))

    def _share(self, g: str) -> float:
        p = (self.uni.get(g[2], 0) + 0.02) / (self.total + SIGNS)
        p = (self.bi.get(g[1:], 0) + self.trust2 * p) / (self.first.get(g[1], 0) + self.trust2)
        return (self.tri.get(g, 0) + self.trust3 * p) / (self.after.get(g[:2], 0) + self.trust3)

    def _logp(self, g: str) -> float:
        c = g[2]
        if c == _LOST:
            return LOSS
        if "\x80" <= c < "\xa0" or "" <= c < "豈":
            return NEVER
        return math.log(self._share(g))

    def score(self, before: str, core: str, behind: str) -> float:
        """Log-likelihood of core and the two characters behind it, given the two before; all folded."""
        s = before + core + behind
        logp = self.logp
        return sum(logp(s[i - 2 : i + 1]) for i in range(2, len(s)))

    def beats(self, before: str, core: str, behind: str, own: float) -> float:
        """By how much the score exceeds own, 0 where it doesn't; read only as far as that is open."""
        s = before + core + behind
        logp = self.logp
        for i in range(2, len(s)):
            own -= logp(s[i - 2 : i + 1])
            if own >= 0:
                return 0.0
        return -own

    def _lost(self, before: str, behind: str) -> float:
        """Log-likelihood ratio of a replacement character for any lost sign beyond ASCII to one that the writer meant, between two characters to each side."""
        unseen = math.exp(self.score(before, _UNSEEN, behind))
        some = sum((math.exp(self.score(before, c, behind)) for c in self.high.get(before[-1:], ())), SIGNS * unseen)
        meant = math.log(self._share(before + _LOST)) + math.log(self._share(before[-1:] + _LOST + behind[:1])) + math.log(self._share(_LOST + behind[:2]))
        return math.log(some) - meant


Span = tuple[float, tuple, int, int]


class Restorer:
    """Finds the spans of a text that a rereading makes likelier by more than the margin, and rereads them.

    rates: share of clean held-out texts above the margin and share of planted garbled texts below it, as measured when it was fitted.
    """

    def __init__(self, model: CharModel, margin: float, rates: tuple[float, float] = (math.nan, math.nan)):
        self.model, self.margin, self.rates = model, margin, rates
        self.starts = lru_cache(KEPT)(self._starts)
        self.positive = lru_cache(KEPT)(self._positive)
        self.scored = lru_cache(FEW)(lambda before, core, behind, read_in: {})
        self.seen = lru_cache(KEPT)(self._seen)
        self.calm: set[str] = set()

    def __reduce__(self):
        return Restorer, (self.model, self.margin, self.rates)

    def _usable(self, text: str) -> bool:
        """Whether a rereading has only signs that the model knows; a lossy one may have lost signs as well."""
        known = self.model.uni
        return all(c in known or c == _LOST for c in set(text) if c > "\x7f")

    @staticmethod
    def _all_lost(text: str) -> bool:
        return _LOST in text and all(c == _LOST for c in set(text) if c > "\x7f")

    def _starts(self, core: str, read_in: str | None) -> list[tuple[str, list[tuple]]]:
        """(text, chains) of the rereadings that may begin a span: all signs are known; blanks and runs that would be all loss begin none."""
        out = []
        for t, chains in variants(core, read_in):
            if self._usable(t) and ((read_in is None and not core.isspace()) or not self._all_lost(t)):
                out.append((t, [c for c in chains if _LOST not in t or c[-1][1] == "utf-8?"]))
        return out

    def _positive(self, before: str, core: str, behind: str, read_in: str | None) -> tuple[tuple, ...]:
        """The chains that gain on an island, or on a run in one, and may begin a span."""
        starts = self.starts(core, read_in)
        if not starts:
            return ()
        own, out = self.model.score(before, folded(core), behind), []
        for t, chains in starts:
            gain = self.model.beats(before, t, behind, own)
            if gain > 0:
                out += [c for c in chains if gain > STEP_COST * (len(c) - 1)]
        return tuple(out)

    def gain(self, chain: tuple, before: str, core: str, behind: str, read_in: str | None) -> float | None:
        """Log-likelihood ratio of a chain on an island or a run in one; null where it can't be applied or changes nothing. A loss in a run never gains by itself."""
        i = places(core, read_in).get(chain)
        if i is None:
            return None
        got = self.scored(before, core, behind, read_in)
        if i not in got:
            t = variants(core, read_in)[i][0]
            if "own" not in got:
                got["own"] = self.model.score(before, folded(core), behind)
            ratio = self.model.score(before, t, behind) - got["own"] if self._usable(t) else None
            got[i] = min(ratio, 0.0) if ratio is not None and read_in is not None and self._all_lost(t) else ratio
        return None if got[i] is None else got[i] - STEP_COST * (len(chain) - 1)

    def _seen(self, window: str) -> tuple:
        """Of a window (an island with _SIDE characters to each side): context, chains that gain, and (encoding, start, end, context, chains) of its runs."""
        at = lambda i: (_folded_side(window[i - _SIDE : i])[-2:], _folded_side(window[i : i + _SIDE])[:2])
        end = len(window) - _SIDE
        core, before, behind = window[_SIDE:end], at(_SIDE)[0], at(end)[1]
        pieces = []
        for y, i, j in cuts(core):
            b, e = at(_SIDE + i)[0], at(_SIDE + j)[1]
            pieces.append((y, i, j, b, e, self.positive(b, core[i:j], e, y)))
        return before, behind, self.positive(before, core, behind, None), pieces

    def spans(self, text: str, least: float = 0.0, enough: float = math.inf) -> list[Span]:
        """(gain, chain, start, end): the best part, of more than `least`, of every run of islands that a chain gains on; only the first whose gain is `enough`, where there is one.

        Per chain the gains of consecutive islands add up; an island that the chain can't be applied to ends a run, one that it
        leaves as it is adds nothing. Of an island that the chain's encoding can encode only in runs, each run counts for itself; the first may
        end a run and the last begin one.
        """
        parts = islands(text)
        padded = f"{' ' * _SIDE}{text}{' ' * _SIDE}"
        windows = [padded[a : b + 2 * _SIDE] for a, b in parts]
        if self.calm.issuperset(windows):
            return []
        out: list[Span] = []
        run: dict[tuple, tuple[float, int, float, int]] = {}  # chain to sum, start, best sum, its end

        def add(now: dict, chain: tuple, gain: float, start: int, end: int, joins: bool = True, goes_on: bool = True) -> None:
            had = run.get(chain) if joins else None
            total, start, top, at = had or (0.0, start, 0.0, 0)
            total += gain
            if total > top:
                top, at = total, end
            if total > 0 and goes_on:
                now[chain] = (total, start, top, at)
            elif top > least:
                out.append((top, chain, start, at))
            if top >= enough:
                done.append((top, chain, start, at))

        done: list[Span] = []
        for (a, b), window in zip(parts, windows):
            if not run and window in self.calm:
                continue
            before, behind, positive, pieces = self.seen(window)
            if not positive and not any(p[5] for p in pieces):
                if len(self.calm) >= CALM:
                    self.calm.clear()
                self.calm.add(window)
                if not run:
                    continue
            core, now, used = text[a:b], {}, set()
            whole = places(core)
            for chain in {*positive, *run}:
                gain = self.gain(chain, before, core, behind, None)
                if gain is not None:
                    used.add(chain)
                    add(now, chain, gain, a, b)
            for y, i, j, before, behind, positive in pieces:
                live = [c for c in run if c[0][0] == y and c not in whole] if i == 0 else []
                for chain in {*positive, *live}:
                    gain = self.gain(chain, before, core[i:j], behind, y)
                    if gain is not None:
                        used.add(chain)
                        add(now, chain, gain, a + i, a + j, i == 0, a + j == b)
            if done:
                return done
            for chain, (total, start, top, at) in run.items():
                if chain in used:
                    continue
                if len(chain) == 1 and chain[0][1] != "utf-8?" and reread(core, *chain[0]) == core:
                    now[chain] = (total, start, top, at)
                elif top > least:
                    out.append((top, chain, start, at))
            if len(now) > 1:
                worst = max(r[0] for r in now.values()) - BEAM
                for chain in [c for c, r in now.items() if r[0] < worst]:
                    _, start, top, at = now.pop(chain)
                    if top > least:
                        out.append((top, chain, start, at))
            run = now
        out += [(top, chain, start, at) for chain, (_, start, top, at) in run.items() if top > least]
        return out

    def lost(self, text: str) -> float:
        """The largest log-likelihood ratio of the text's replacement characters: lost signs to ones that the writer meant."""
        best = 0.0
        for m in re.finditer(f"{_LOST}+", text):
            before = _folded_side(f"     {text[max(0, m.start() - _SIDE) : m.start()]}")[-2:]
            behind = _folded_side(f"{text[m.end() : m.end() + _SIDE]}     ")[:2]
            best = max(best, self.model.lost(before, behind))
        return best

    def evidence(self, text: str) -> float:
        """The largest gain of any span of a text, or ratio of a replacement character in it; read only until it is past all margins."""
        plain = unescaped(text)
        if plain.isascii():
            return 0.0
        best = max((s[0] for s in self.spans(plain, enough=TOP * STEP)), default=0.0)
        return max(best, self.lost(plain)) if _LOST in plain else best

    def restore(self, text: str | None) -> tuple[bool, str | None]:
        """(garbled, restored). restored is the text with every span reread that clears the margin, null where the text is not garbled.

        All spans that don't overlap are reread at once, the largest gains first, and the text is read again until none clears
        the margin or a text comes back, so however many spans there are the rounds are few.
        """
        plain = unescaped(text) if text else ""
        if plain.isascii():
            return False, None
        found, met = _LOST in plain and self.lost(plain) > self.margin, set()
        while plain not in met:
            met.add(plain)
            taken: list[tuple[int, int, tuple]] = []
            for gain, chain, start, end in sorted(self.spans(plain, self.margin), key=lambda s: (-s[0], s[2], s[3], s[1])):
                i = bisect_left(taken, (start, end))
                if (i == 0 or taken[i - 1][1] <= start) and (i == len(taken) or end <= taken[i][0]):
                    taken.insert(i, (start, end, chain))
            if not taken:
                break
            found = True
            out, at = [], 0
            for start, end, chain in taken:
                out.append(plain[at:start])
                at = start
                for m in _ISLAND.finditer(plain, start, end):
                    out += [plain[at : m.start()], self._apply(m[0], chain)]
                    at = m.end()
            plain = "".join(out) + plain[at:]
        return (True, plain) if found else (False, None)

    @staticmethod
    def _apply(core: str, chain: tuple) -> str:
        for y, x in chain:
            if x == "utf-8?":
                core = (_encoded(core, y, "replace") or b"").decode("utf-8", "replace")
            else:
                core = reread(core, y, x) or core
        return core


def unescaped(text: str) -> str:
    """text with character entities beyond ASCII as characters."""
    if "&" not in text or not _ENTITY.search(text):
        return text
    return _ENTITY.sub(lambda m: s if (s := html.unescape(m.group()))[0] > "\x7f" else m.group(), text)


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def _fold(text: str) -> int:
    """The half that a text belongs to; equal texts are in the same."""
    return _hash(text) & 1


def _count_grams(texts: list[str]) -> Counter:
    """Trigrams of folded texts, two spaces around each."""
    s = "  ".join(["", *map(folded, texts), ""])
    a = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if len(a) < 3:
        return Counter()
    got = pc.value_counts(pa.array(a[:-2] << 42 | a[1:-1] << 21 | a[2:]))
    m = (1 << 21) - 1
    keys, n = got.field("values").to_pylist(), got.field("counts").to_pylist()
    return Counter({chr(k >> 42) + chr(k >> 21 & m) + chr(k & m): c for k, c in zip(keys, n)})


def _marked(text: str) -> bool:
    return any(looks_reread(text[a:b]) for a, b in islands(text))


def garbled(s: str, written_in: str, read_in: str) -> str | None:
    """s as it is when it was written in one encoding and read in another; null where that can't be or loses a sign."""
    b = _encoded(s, written_in) if written_in != "utf-8" and (written_in in _ENCODE or written_in in _MULTIBYTE) else None
    try:
        b = s.encode(written_in) if b is None else b
    except (UnicodeError, LookupError):
        return None
    t = _decoded(b, read_in)
    return t if t is not None and t != s and reread(t, read_in, written_in) == s else None


def planted(text: str) -> str | None:
    """A stretch of a text in which one to four islands, or every eighth time the whole text, were garbled; how, a hash of the text tells.

    Null where no pair of encodings garbles it. Half of the pairs tried first were written in UTF-8.
    """
    parts = islands(text)
    if not parts:
        return None
    h = _hash(text) >> 1
    first = h % len(parts)
    last = min(len(parts) - 1, first + (h >> 11) % 4)
    a, b = (0, len(text)) if (h >> 8) % 8 == 0 else (parts[first][0], parts[last][1])
    others = [("utf-8", y) for y in READ_IN], [(x, y) for x in WRITTEN_IN[1:] for y in READ_IN if x != y]
    for pairs in others if h >> 16 & 1 else others[::-1]:
        for k in range(len(pairs)):
            bad = garbled(text[a:b], *pairs[(h + k) % len(pairs)])
            if bad is not None:
                return text[max(0, a - 40) : a] + bad + text[b : b + 40]
    return None


def _rows(columns: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = {"kind": pa.int32(), "g": pa.string(), "n": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[x]) for c, x in zip(columns, names)], names=names)


def _first_counts(df: DataFrame, text: str) -> DataFrame:
    """kind (the half), g, n: trigram counts of the texts without structural marks. Counted in every task, added up by the JVM."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter(), Counter()
        for b in batches:
            halves: tuple[list, list] = [], []
            for t in b.column(0).to_pylist():
                if t and not _marked(t):
                    halves[_fold(t)].append(t)
            for c, texts in zip(total, halves):
                c.update(_count_grams(texts))
        for i, c in enumerate(total):
            yield _rows([[i] * len(c), list(c), list(c.values())], ["kind", "g", "n"])

    return spread(df.select(text)).mapInArrow(count, "kind int, g string, n bigint").groupBy("kind", "g").agg(F.sum("n").alias("n"))


def _judged(df: DataFrame, text: str, halves: list[Restorer]) -> DataFrame:
    """kind, g, n: trigram counts of all texts by the step of their gain (kind from 0), by a model of the other half; and numbers of texts by g.

    kind -1: texts without structural marks whose gain is in step g; kind -2: planted ones; kind -3: texts with marks.
    """
    shared = df.sparkSession.sparkContext.broadcast(halves)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        step = lambda gain: min(TOP, math.ceil(gain / STEP))
        grams: dict[int, Counter] = defaultdict(Counter)
        seen: Counter = Counter()
        for b in batches:
            texts = defaultdict(list)
            for t in b.column(0).to_pylist():
                if not t:
                    continue
                r = models[1 - _fold(t)]
                k = step(r.evidence(t))
                if k < TOP:
                    texts[k].append(t)
                if t.isascii():
                    continue
                if _marked(t):
                    seen[-3, "0"] += 1
                else:
                    seen[-1, str(k)] += 1
                    bad = planted(t)
                    if bad is not None:
                        seen[-2, str(step(r.evidence(bad)))] += 1
            for k, own in texts.items():
                grams[k].update(_count_grams(own))
        for k, c in grams.items():
            yield _rows([[k] * len(c), list(c), list(c.values())], ["kind", "g", "n"])
        if seen:
            yield _rows([[k for k, _ in seen], [g for _, g in seen], list(seen.values())], ["kind", "g", "n"])

    return spread(df.select(text)).mapInArrow(judge, "kind int, g string, n bigint").groupBy("kind", "g").agg(F.sum("n").alias("n"))


def _models(counts: DataFrame, weights: list[Column]) -> list[CharModel]:
    """A model for each weight of counts (g and what the weights need), from the trigrams and all their shorter parts, added up by the JVM."""
    orders = [F.col("g"), F.substring("g", 2, 2), F.substring("g", 1, 2), F.substring("g", 3, 1), F.substring("g", 2, 1)]
    parts = F.explode(F.array(*[F.struct(F.lit(i).alias("o"), e.alias("k")) for i, e in enumerate(orders)])).alias("x")
    sums = [f"n{i}" for i in range(len(weights))]
    rows = counts.select(parts, *[w.alias(s) for w, s in zip(weights, sums)]).groupBy("x.o", "x.k").agg(*[F.sum(s).alias(s) for s in sums])
    rows = as_table(rows.withColumn("n", sum((F.col(s) for s in sums), F.lit(0))).filter("n > 0"))
    tables: list[list[dict[str, int]]] = [[{} for _ in orders] for _ in weights]
    for some in ("o = 0", "o > 0"):
        got = rows.filter(some).orderBy(F.desc("n"), "o", "k").limit(MAX_GRAMS).toPandas()
        for i, s in enumerate(sums):
            for o, k, n in zip(got.o.tolist(), got.k.tolist(), got[s].tolist()):
                if n:
                    tables[i][o][k] = n
    return [CharModel(*t) for t in tables]


def best_margin(clean: dict[int, int], garbled_: dict[int, int], marked: int) -> tuple[float, float, float]:
    """(margin, share of clean texts above it, share of garbled ones below it): the margin with the fewest errors to be expected.

    clean and garbled_: held-out and planted texts by the step of their gain. Garbled texts are as frequent as texts with structural marks are, plus
    one of a thousand. Nothing is cut off: some of the clean ones are garbled without marks, but they count alike at all margins
    below their gain. PRIOR_TEXTS further texts of either kind steady the margin where there are few.
    """
    n, m = sum(clean.values()), sum(garbled_.values())
    prior = (marked + 0.001 * n + 0.1) / (marked + n + 1)
    above, below, options = n, 0, []
    for k in range(TOP):
        above -= clean.get(k, 0)
        below += garbled_.get(k, 0)
        margin = k * STEP
        false = (above + PRIOR_TEXTS * math.exp(-margin / PRIOR_CLEAN)) / (n + PRIOR_TEXTS)
        missed = (below + PRIOR_TEXTS * (1 - math.exp(-margin / PRIOR_GARBLED))) / (m + PRIOR_TEXTS)
        options.append((prior * missed + (1 - prior) * false, margin, above / max(n, 1), below / max(m, 1)))
    return min(options)[1:]


def fit(df: DataFrame, text: str) -> Restorer:
    """A restorer trained on all texts of df, in two passes.

    First models come from each half of the texts without structural marks. Each then judges the texts of the other half, so all are held out,
    and a copy of each with a planted garbled part; the margin is the one with the fewest errors on both. The final model is of all texts
    that stay below the margin.
    """
    first = _first_counts(df, text)
    halves = _models(first, [F.when(F.col("kind") == i, F.col("n")).otherwise(0) for i in (0, 1)])
    judged = as_table(_judged(df, text, [Restorer(m, 0.0) for m in halves]))
    seen: dict[int, dict[int, int]] = {-1: {}, -2: {}, -3: {}}
    for r in judged.filter("kind < 0").collect():  # at most 2 * TOP + 3 rows
        seen[r.kind][int(r.g)] = r.n
    margin, *rates = best_margin(seen[-1], seen[-2], sum(seen[-3].values()))
    (model,) = _models(judged.filter(F.col("kind").between(0, int(margin / STEP))), [F.col("n")])
    return Restorer(model, margin, tuple(rates))


def restored(df: DataFrame, row_id: str, text: str, restorer: Restorer) -> DataFrame:
    """row_id, garbled, restored of every row: whether the text or a part of it was read in a wrong encoding, and the text with these parts restored.

    restored is null for texts that are not garbled; where a part can't be restored it stays as it is, so a replacement character
    remains one. Null, empty and ASCII texts are not garbled. Whole texts are read. One narrow pass without shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(restorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = shared.value
        for b in batches:
            out = [r.restore(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in out], pa.bool_()), pa.array([y for _, y in out], pa.string())], names=[row_id, "garbled", "restored"])

    kind = dict(df.dtypes)[row_id]
    return spread(df.select(row_id, text)).mapInArrow(run, f"`{row_id}` {kind}, garbled boolean, restored string")
